"""Queries on area codes where customer keys pass 100,000 and 1,000,000."""

import os

import duckdb
import pytest
from conftest import SMALL
from test_queries import QUERIES, same

from zonalis.plans.registry import TABLES, runner

NAMES = ["concordance_allocation", "concordance_totals", "hierarchy_checks", "boundary_checks", "code_checks", "parent_codes", "state_of_code"]


@pytest.fixture(scope="module")
def large(tmp_path_factory):
    folder = tmp_path_factory.mktemp("large")
    con = duckdb.connect()
    for t in TABLES:
        if t != "customer":
            os.symlink(f"{SMALL}/{t}.parquet", folder / f"{t}.parquet")
    con.execute(f"""copy (select * from '{SMALL}/customer.parquet' union all
        select * replace (c_custkey * 797 + 99000 as c_custkey) from '{SMALL}/customer.parquet' union all
        select * replace (c_custkey * 13 + 1000000 as c_custkey) from '{SMALL}/customer.parquet') to '{folder}/customer.parquet'""")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return str(folder), con


@pytest.mark.parametrize("name", NAMES)
def test_large_keys(spark, large, name):
    folder, con = large
    same(runner(QUERIES[name])(spark, folder).toPandas(), con.execute(QUERIES[name].sql).df())

"""The registered queries against their SQL at the smallest size."""

import pytest
from compare import canon
from conftest import SMALL

from zonalis.llm import queries


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_against_sql(spark, duck, name):
    got, want = queries.QUERIES[name](spark, SMALL).toPandas(), duck.execute(queries.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and len(got) == len(want)
    g, w = canon(got), canon(want)
    assert not (g != w).any().any()


def test_all_are_registered():
    import __spark_entry__ as e
    names = e.queries()
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(queries.QUERIES) <= set(names) and "pipeline" in names

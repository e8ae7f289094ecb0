"""Zip archives read a member a task."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from zonalis.sources import archives, documents


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    base = tmp_path_factory.mktemp("zips")
    (base / "deeper").mkdir()
    for where, members in ((base / "a.zip", 12), (base / "deeper" / "b.ZIP", 3)):
        with zipfile.ZipFile(where, "w", zipfile.ZIP_DEFLATED) as z:
            for i in range(members):
                z.writestr(f"in/G{i:02}_SA2.csv", "id,name\r\n" + "".join(f'{j},"é {i}"\n' for j in range(1_000 if i == 5 else 4)))
            z.writestr("facts.json", '{"n": 7}\n{"n": 8}')
            z.writestr("empty.csv", "")
            z.writestr("notes.txt", "not read")
    (base / "readme.md").write_text("no archive")
    return base


def test_a_task_for_every_member(spark, folder, monkeypatch):
    lines = archives.read_zip_lines(spark, str(folder))
    assert lines.rdd.getNumPartitions() == 12 + 3 + 4
    per = {(r["path"].rsplit("/", 1)[1], r["member"]): (r["n"], r["last"]) for r in lines.groupBy("path", "member").agg(
        F.count(F.lit(1)).alias("n"), F.max("line_no").alias("last")).collect()}
    assert per["a.zip", "in/G05_SA2.csv"] == (1_001, 1_000) and per["b.ZIP", "in/G02_SA2.csv"] == (5, 4) and per["a.zip", "facts.json"] == (2, 1)
    assert len(per) == 12 + 3 + 2  # an empty member has no lines
    rows = documents.zip_csv(lines, ["id", "name"])
    assert rows.count() == 11 * 4 + 1_000 + 3 * 4 and rows.filter("name = 'é 5'").count() == 1_000
    assert sorted(r["n"] for r in documents.zip_json(lines, "n int").collect()) == [7, 7, 8, 8]


def test_the_old_reader_agrees(spark, folder):
    one = archives.read_zip_lines(spark, str(folder / "a.zip"))
    content = bytearray((folder / "a.zip").read_bytes())
    other = documents.zip_lines(spark.createDataFrame([(str(folder / "a.zip"), content)], "path string, content binary"))
    key = lambda df: sorted(map(tuple, df.select("path", "member", "line_no", "line").collect()))
    assert key(one) == key(other)
    assert {r["member"] for r in archives.read_zip_lines(spark, f"file://{folder}/a.zip", table_id="g03").collect()} == {"in/G03_SA2.csv"}
    assert {r["path"] for r in archives.read_zip_lines(spark, f"file://{folder}").select("path").distinct().collect()} == {f"file://{folder}/a.zip", f"file://{folder}/deeper/b.ZIP"}


def test_batches_are_bounded(folder, monkeypatch):
    monkeypatch.setattr(archives, "BATCH_LINES", 100)
    reader = archives.ZipReader({"path": str(folder / "a.zip")})
    member = next(m for m in reader.partitions() if m.member == "in/G05_SA2.csv")
    sizes = [len(b) for b in reader.read(member)]
    assert sizes == [100] * 10 + [1]
    monkeypatch.setattr(archives, "BATCH_CHARS", 60)
    assert max(len(b) for b in reader.read(member)) < 12


def test_no_archive(spark, tmp_path):
    assert archives.read_zip_lines(spark, str(tmp_path)).count() == 0
    with pytest.raises(Exception, match="nowhere"):
        archives.read_zip_lines(spark, str(tmp_path / "nowhere")).count()
    with zipfile.ZipFile(io.BytesIO(), "w") as z:
        assert archives.chosen_members(z.namelist(), "G01") == []


def test_written_archives_are_read_back(spark, tmp_path):
    rows = [(f"a{i % 3}", f"m{i % 2}.csv", f"{i:04},x") for i in range(500)] + [("a9", "m0.csv", "é,y"), (None, "m0.csv", "lost"), ("a9", "m0.csv", None)]
    df = spark.createDataFrame(rows, "archive string, member string, line string")
    assert archives.write_zips(df, str(tmp_path / "z"), heads={"m0.csv": "id,name"}) == 4
    back = archives.read_zip_lines(spark, str(tmp_path / "z"))
    assert back.filter("member = 'm0.csv' AND line_no = 0 AND line = 'id,name'").count() == 4
    got = sorted((r["path"].rsplit("/", 1)[1][:-4], r["member"], r["line"]) for r in back.filter("line <> 'id,name'").collect())
    assert got == sorted(r for r in rows if None not in r)

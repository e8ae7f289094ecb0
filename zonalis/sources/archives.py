"""Zip archives as a data source: a partition per member, lines in bounded batches.

Archives are opened through pyarrow's file systems, which seek: a task reads the archive's
directory and then its own member, never the whole archive.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "path string, member string, line_no long, line string"
BATCH_LINES, BATCH_CHARS = 10_000, 4_000_000


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def chosen_members(names: list[str], table_id: str | None) -> list[str]:
    """Of an archive's csv and json members all, or with `table_id` the first csv whose name
    holds it, else the first whose name holds SA2."""
    if table_id is None:
        return [n for n in names if n.lower().endswith((".csv", ".json"))]
    csvs = [n for n in names if n.endswith(".csv")]
    hits = [n for n in csvs if table_id.upper() in n.upper()] or [n for n in csvs if "SA2" in n.upper()]
    return hits[:1]


@dataclass
class Member(InputPartition):
    path: str
    member: str


class ZipMembers(DataSource):
    """Options: `path`, an archive or a folder of archives (folders within are searched); `table_id`,
    as for chosen_members; `encoding`, utf-8 if not given."""

    @classmethod
    def name(cls) -> str:
        return "zip_members"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ZipReader:
        return ZipReader(dict(self.options))


class ZipReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.table_id, self.encoding = options["path"], options.get("table_id"), options.get("encoding", "utf-8")

    def _archives(self) -> list[str]:
        system, path = _opened(self.path)
        found = system.get_file_info(path)
        if found.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        if found.type == fs.FileType.File:
            return [self.path]
        inside = system.get_file_info(fs.FileSelector(path, recursive=True))
        lead = self.path[: len(self.path.rstrip("/")) - len(path.rstrip("/"))] if self.path.rstrip("/").endswith(path.rstrip("/")) else ""
        return sorted(lead + f.path for f in inside if f.type == fs.FileType.File and f.path.lower().endswith(".zip"))

    def partitions(self) -> list[Member]:
        """Only the archives' directories are read here."""
        out = []
        for archive in self._archives():
            system, path = _opened(archive)
            with system.open_input_file(path) as file, zipfile.ZipFile(file) as z:
                out += [Member(archive, n) for n in chosen_members(z.namelist(), self.table_id)]
        return out

    def read(self, partition: Member) -> Iterator[pa.RecordBatch]:
        if partition is None or not getattr(partition, "member", None):
            return
        system, path = _opened(partition.path)
        with system.open_input_file(path) as file, zipfile.ZipFile(file) as z, z.open(partition.member) as raw:
            held: list[str] = []
            first = size = 0
            for line in io.TextIOWrapper(raw, encoding=self.encoding, newline=None):
                held.append(line.rstrip("\n"))
                size += len(line)
                if len(held) >= BATCH_LINES or size >= BATCH_CHARS:
                    yield self._batch(partition, first, held)
                    first, held, size = first + len(held), [], 0
            if held:
                yield self._batch(partition, first, held)

    @staticmethod
    def _batch(partition: Member, first: int, lines: list[str]) -> pa.RecordBatch:
        n = len(lines)
        return pa.RecordBatch.from_arrays(
            [pa.array([partition.path] * n, pa.string()), pa.array([partition.member] * n, pa.string()), pa.array(range(first, first + n), pa.int64()), pa.array(lines, pa.string())],
            names=["path", "member", "line_no", "line"])


def read_zip_lines(spark: SparkSession, path: str, *, table_id: str | None = None) -> DataFrame:
    """(path, member, line_no, line) of csv and json members, a task per member."""
    spark.dataSource.register(ZipMembers)
    reader = spark.read.format("zip_members").option("path", path)
    return (reader.option("table_id", table_id) if table_id else reader).load()


def write_zips(rows: DataFrame, path: str, *, heads: dict[str, str] | None = None) -> int:
    """Write (archive, member, line) as `archive`.zip files of text members under path and return how
    many.  A member's lines follow each other in the order of `line`; heads gives first lines by member.
    Lines stream from the sorted rows into the file; a task that runs again writes the same archive anew."""
    heads = heads or {}

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = member = z = out = stream = None

        def close() -> None:
            if out is not None:
                if stream is not None:
                    stream.close()
                z.close()
                out.close()

        done = []
        for batch in batches:
            for name, part, line in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if name != archive:
                    close()
                    system, where = _opened(f"{path.rstrip('/')}/{name}.zip")
                    system.create_dir(where.rsplit("/", 1)[0], recursive=True)
                    out, stream = system.open_output_stream(where), None
                    z = zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED)
                    archive, member = name, None
                    done.append(name)
                if part != member:
                    if stream is not None:
                        stream.close()
                    stream, member = z.open(part, "w", force_zip64=True), part
                    if part in heads:
                        stream.write(f"{heads[part]}\n".encode())
                stream.write(f"{line}\n".encode())
        close()
        yield pa.RecordBatch.from_arrays([pa.array(done, pa.string())], names=["archive"])

    texts = rows.select(*[F.col(c).cast("string").alias(c) for c in ("archive", "member", "line")]).dropna()
    return texts.repartition("archive").sortWithinPartitions("archive", "member", "line").mapInArrow(pack, "archive string").count()

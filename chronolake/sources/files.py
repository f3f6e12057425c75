"""Every file of an archive laid out as root/package/version/path, as a Spark data source.

Spark's own file sources leave out empty files and names that begin with a dot or an underscore; in a package these say
something (an empty LICENSE, a folder of workflows). Here the driver lists packages and versions, tasks list the
files of their versions and read each at most once. A file that isn't asked for is never opened: ``find`` (a regular
expression over paths) and filters on package, version and path (=, in, starts, ends, contains) are looked at
before. Stores are reached through Arrow's file systems (local, HDFS, S3, GCS).

Files go out in batches of some ``BATCH`` bytes, a larger file by itself. A version without files has no rows; files
that don't lie below a version belong to none and have no rows either.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, StringContains, StringEndsWith, StringStartsWith

SCHEMA = "package string, version string, path string, size long, content_bytes binary"
BATCH, NAMES = 8 << 20, ("package", "version", "path")
_ARROW = pa.schema([("package", pa.string()), ("version", pa.string()), ("path", pa.string()), ("size", pa.int64()), ("content_bytes", pa.binary())])
#: What a filter asks of a value; null equals nothing.
_ASKS = {
    EqualTo: lambda v, x: v == x,
    In: lambda v, x: v in x,
    StringStartsWith: lambda v, x: v.startswith(x),
    StringEndsWith: lambda v, x: v.endswith(x),
    StringContains: lambda v, x: x in v,
}


class Versions(InputPartition):
    """Some (package, version) whose files one task lists and reads."""

    def __init__(self, own: list[tuple[str, str]]):
        self.own = own


class ArchiveReader(DataSourceReader):
    def __init__(self, options):
        self.root, self.find = options["path"].rstrip("/"), re.compile(options.get("find", ""))
        self.parts, self.named = int(options.get("parts", "64")), options.get("content", "true") != "true"
        self.asked: list[tuple[str, type, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if type(f) in _ASKS and f.attribute in [(n,) for n in NAMES]:
                self.asked.append((f.attribute[0], type(f), f.value))
            else:
                yield f

    def wanted(self, column: str, value: str) -> bool:
        return all(_ASKS[kind](value, x) for c, kind, x in self.asked if c == column)

    def _store(self) -> tuple[pafs.FileSystem, str]:
        return pafs.FileSystem.from_uri(self.root)

    def partitions(self) -> list[InputPartition]:
        fs, root = self._store()
        below = lambda at: sorted(i.base_name for i in fs.get_file_info(pafs.FileSelector(at)) if i.type == pafs.FileType.Directory)
        packages = [p for p in below(root) if self.wanted("package", p)]
        with ThreadPoolExecutor(32) as pool:
            own = [(p, v) for p, versions in zip(packages, pool.map(lambda p: below(f"{root}/{p}"), packages), strict=True) for v in versions if self.wanted("version", v)]
        n = max(1, min(self.parts, len(own)))
        return [Versions(own[i::n]) for i in range(n)]

    def read(self, partition: Versions) -> Iterator[pa.RecordBatch]:
        fs, root = self._store()
        rows, held = [], 0
        for package, version in partition.own:
            top = f"{root}/{package}/{version}/"
            for info in sorted(fs.get_file_info(pafs.FileSelector(top, recursive=True)), key=lambda i: i.path):
                path = info.path.split(top, 1)[-1]
                if info.type != pafs.FileType.File or not self.find.search(path) or not self.wanted("path", path):
                    continue
                content = None if self.named else self.content(fs, info)
                rows.append((package, version, path, info.size, content))
                held += len(content or b"") + 200
                if held >= BATCH:
                    yield self._batch(rows)
                    rows, held = [], 0
        if rows:
            yield self._batch(rows)

    def content(self, fs: pafs.FileSystem, info: pafs.FileInfo) -> bytes:
        if not info.size:
            return b""
        with fs.open_input_stream(info.path) as f:
            return f.read()

    @staticmethod
    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_ARROW)], schema=_ARROW)


class Archive(DataSource):
    """Options: path; find; parts (tasks at most); content (false: names and sizes alone)."""

    @classmethod
    def name(cls) -> str:
        return "archive_files"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(self.options)


def files(spark: SparkSession, path: str, find: str = "", content: bool = True, parts: int = 64) -> DataFrame:
    """package, version, path, size, content_bytes (null without ``content``) of the files whose path ``find`` is found in."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Archive)
    return spark.read.format("archive_files").option("find", find).option("content", str(content).lower()).option("parts", parts).load(path)

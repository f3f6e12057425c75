"""Several tables that change together: ordered writes, a marker last, redone by batch id.

A batch writes its parts of every table to folders of its own and then, last and in one file, the marker: which folder holds each
bucket of each table from now on. Readers go by the newest marker alone, so a batch is seen whole or not
at all, in all tables at once. A batch that failed between is done again under its id: what it left is written over, and an id
whose marker is there is skipped. A bucket's older folders stay until ``vacuum``, so readers of before aren't
disturbed. One batch writes at a time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MARKERS = "_batches"
MARKER = "seq long, batch string, table string, bucket int, folder string"


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


class Store:
    """``keys``: each table's column that its buckets go by."""

    def __init__(self, spark: SparkSession, path: str, keys: dict[str, str], buckets: int = 16):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), keys, buckets

    def _names(self) -> list[str]:
        fs, p = _path(self.spark, f"{self.path}/{MARKERS}")
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def _marked(self, name: str) -> list[tuple[str, int, str]]:
        rows = self.spark.read.json(f"{self.path}/{MARKERS}/{name}", MARKER).filter("table is not null")
        return [(r.table, r.bucket, r.folder) for r in rows.collect()]  # a row for each table and bucket

    def current(self) -> list[tuple[str, int, str]]:
        """(table, bucket, folder), as the newest marker has them."""
        names = [n for n in self._names() if n.endswith(".json")]
        return self._marked(names[-1]) if names else []

    def has(self, batch: str) -> bool:
        return any(n.endswith(f"-{batch}.json") for n in self._names())

    def read(self, table: str, buckets: list[int] | None = None) -> DataFrame | None:
        """A table's rows (of some buckets), or None where it has none."""
        folders = sorted(f for t, b, f in self.current() if t == table and (buckets is None or b in buckets))
        return self.spark.read.option("mergeSchema", "true").parquet(*(f"{self.path}/{f}" for f in folders)) if folders else None

    def bucket(self, table: str):
        return F.pmod(F.xxhash64(F.col(self.keys[table]).cast("string")), F.lit(self.buckets)).cast("int")

    def touched(self, df: DataFrame, table: str) -> list[int]:
        """The buckets that ``df``'s keys fall in."""
        return sorted(r.b for r in df.select(self.bucket(table).alias("b")).distinct().collect())

    def commit(self, batch: str, writes: list[tuple[str, DataFrame | None, list[int] | None]], wiped: list[str] | None = None, before_marker: Callable[[], None] | None = None) -> bool:
        """Writes (table, rows, the buckets that these rows replace; None: all, []: none), in this order, over the tables without
        those in ``wiped``, then the marker. False, and nothing done, where the batch has been committed."""
        if self.has(batch):
            return False
        now = [k for k in self.current() if k[0] not in (wiped or [])]
        for table, rows, over in writes:
            now = [(t, b, f) for t, b, f in now if t != table or (over is not None and b not in over)]
            if rows is None:
                continue
            folder = f"{table}/batch-{batch}"
            rows.withColumn("s_bucket", self.bucket(table)).write.mode("overwrite").partitionBy("s_bucket").parquet(f"{self.path}/{folder}")
            fs, p = _path(self.spark, f"{self.path}/{folder}")
            for s in fs.listStatus(p):
                name = s.getPath().getName()
                if name.startswith("s_bucket="):
                    now.append((table, int(name.split("=")[1]), f"{folder}/{name}"))
        if before_marker:
            before_marker()
        seq = 1 + max((int(n.split("-")[0]) for n in self._names() if n.endswith(".json")), default=0)
        rows = [(seq, batch, t, b, f) for t, b, f in sorted(now)] or [(seq, batch, None, None, None)]
        name = f"{self.path}/{MARKERS}/{seq:012}-{batch}"
        self.spark.createDataFrame(rows, MARKER).coalesce(1).write.mode("overwrite").json(f"{name}.tmp")
        fs, p = _path(self.spark, f"{name}.tmp")
        if not fs.rename(p, _path(self.spark, f"{name}.json")[1]):
            raise OSError(f"marker {name} can't be put in place")
        return True

    def upsert(self, batch: str, fresh: list[tuple[str, DataFrame]], wiped: list[str] | None = None, before_marker: Callable[[], None] | None = None) -> bool:
        """Each table's rows replace those of their keys; buckets without such a key stay as they are."""
        writes = []
        for table, rows in fresh:
            over, key = self.touched(rows, table), self.keys[table]
            old = None if table in (wiped or []) else self.read(table, over)
            if old is not None:
                rows = old.join(rows.select(key).distinct(), key, "left_anti").unionByName(rows, allowMissingColumns=True)
            writes.append((table, rows, over))
        return self.commit(batch, writes, wiped, before_marker)

    def vacuum(self) -> list[str]:
        """Removes folders that the newest marker doesn't name; their names."""
        used, gone = {f for _, _, f in self.current()}, []
        for table in self.keys:
            fs, p = _path(self.spark, f"{self.path}/{table}")
            for batch in fs.listStatus(p) if fs.exists(p) else []:
                for s in fs.listStatus(batch.getPath()):
                    name = f"{table}/{batch.getPath().getName()}/{s.getPath().getName()}"
                    if "s_bucket=" in name and name not in used:
                        fs.delete(s.getPath(), True)
                        gone.append(name)
        return sorted(gone)

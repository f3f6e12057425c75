"""Incremental upserts as a stream: every batch of arriving snapshots replaces its packages' rows and
recomputes their series from the stored snapshots, so an older version that comes late needs no
watermark."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolake.operators.series import keep_one
from chronolake.sources.archive import read_table, replace_packages, write_table
from chronolake.sources.shared import written
from chronolake.sources.store import Store


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def upsert_batch(batch: DataFrame, snapshots: str, results: str, series: Callable[[DataFrame], DataFrame], keys: list[str], seq: str, buckets: int = 16) -> None:
    """Adds a batch to the stored snapshots (of equal keys the last arrival counts) and recomputes the
    results of its packages. The results are written last: a batch that fails is done again whole."""
    spark = batch.sparkSession
    if batch.isEmpty():
        return
    packages = batch.select("package").distinct()
    if _exists(spark, snapshots):
        old = read_table(spark, snapshots).join(packages, "package", "left_semi")
        replace_packages(spark, snapshots, keep_one(old.unionByName(batch, allowMissingColumns=True), keys, [F.desc(seq)]), keys, buckets=buckets)
    else:
        write_table(keep_one(batch, keys, [F.desc(seq)]), snapshots, buckets=buckets)
    own = read_table(spark, snapshots).join(packages, "package", "left_semi")
    fresh = series(own)
    if _exists(spark, results):
        replace_packages(spark, results, fresh, ["package"], buckets=buckets)
    else:
        write_table(fresh, results, buckets=buckets)


def ordered_batch(batch: DataFrame, batch_id: str, store: Store, series: Callable[[DataFrame], DataFrame], keys: list[str], seq: str) -> None:
    """The same into the tables ``snapshots`` and ``results`` of a store: both are seen together, results last, and a batch that
    has its marker isn't taken again."""
    if store.has(batch_id) or batch.isEmpty():
        return
    batch = written(batch, "arrivals")
    old = store.read("snapshots", store.touched(batch, "snapshots"))
    packages = batch.select("package").distinct()
    if old is not None:
        batch = old.join(packages, "package", "left_semi").unionByName(batch, allowMissingColumns=True)
    own = written(keep_one(batch, keys, [F.desc(seq)]), "snapshots")
    store.upsert(batch_id, [("snapshots", own), ("results", series(own))])


def run_ordered(stream: DataFrame, store: Store, checkpoint: str, series: Callable[[DataFrame], DataFrame], keys: list[str], seq: str):
    """Processes what has arrived into the store and stops. One stream writes to a store: its batch numbers are the ids."""
    query = stream.writeStream.foreachBatch(lambda b, i: ordered_batch(b, f"stream-{i}", store, series, keys, seq)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def run(stream: DataFrame, snapshots: str, results: str, checkpoint: str, series: Callable[[DataFrame], DataFrame], keys: list[str], seq: str):
    """Processes what has arrived and stops (run again for what comes later)."""
    write = stream.writeStream.foreachBatch(lambda b, _: upsert_batch(b, snapshots, results, series, keys, seq))
    query = write.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query

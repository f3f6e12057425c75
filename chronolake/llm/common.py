"""What the operators share: tables, the shared folder, staging, row keys and ranks."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a temporary folder of its own; a cluster has no
    folder that could stand in for it, so there it is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def staged_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Writes a table into the shared folder and rereads it: lineage ends there, and its files
    outlive any executor."""
    path = staged_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parts(batches, rows: int = 500):
    """Record batches cut to ``rows`` rows at most, so that a task builds its results for few texts at a
    time. Spark bounds the batches themselves by bytes. At the end of the task Arrow's free memory goes
    back to the system, as the worker process stays."""
    try:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                yield batch.slice(at, rows)
    finally:
        pa.default_memory_pool().release_unused()


def give_back() -> None:
    """Free memory of a worker process goes back to the system, as far as the C library lets it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


_held: dict[str, object] = {}


def held(name: str, make: Callable):
    """What a worker process keeps for its next task: one thing at a time, so that those of a pipeline's
    stages don't add up."""
    if name not in _held:
        _held.clear()
        _held[name] = make()
    return _held[name]


def before(rows: DataFrame, key: str, value: str, within: str | None = None, wide: int = 4096) -> DataFrame:
    """``rows`` with ``before``: the sum of ``value`` over all rows of a smaller ``key`` (a long of at
    least 0; a row for each key, and for each ``within``). Counted in two levels, so that no task orders
    more than ``wide`` keys; only sums of ``wide`` keys are ordered together."""
    by = [within] if within else []
    at = rows.withColumn("b_part", F.expr(f"`{key}` div {wide}"))
    sums = at.groupBy(*by, "b_part").agg(F.sum(value).alias("b_sum"))
    of = Window.partitionBy(*by).orderBy("b_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*by, "b_part", F.coalesce(F.sum("b_sum").over(of), F.lit(0)).alias("b_start"))
    own = Window.partitionBy(*by, "b_part").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    at = at.withColumn("b_own", F.coalesce(F.sum(value).over(own), F.lit(0))).join(sums, [*by, "b_part"])
    return at.withColumn("before", F.col("b_start") + F.col("b_own")).drop("b_part", "b_own", "b_start")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


SENT = 1_000_000


def sent(keys: DataFrame, weight: str | None = None) -> DataFrame:
    """Keys (a written table) to be sent to every task, if there are ``SENT`` at most (or the sum of
    ``weight``, SQL, is); more are left to a shuffle."""
    n = (keys.agg(F.sum(F.expr(weight))).first()[0] or 0) if weight else keys.count()
    return F.broadcast(keys) if n <= SENT else keys


def one_of_each(rows: DataFrame, key: str, kept: DataFrame) -> DataFrame:
    """A row of ``rows`` for each ``key`` in ``kept`` (key, n: how many rows have it). Only rows of keys
    that several have are shuffled, one of each task's."""
    once, more = kept.filter("n = 1").select(key), kept.filter("n > 1").select(key)
    once = rows.join(sent(once), key, "left_semi")
    again = rows.join(sent(more), key, "left_semi").dropDuplicates([key])
    return once.unionByName(again)

"""Tables laid out for lookups by key, by a set of keys, or by the start of a key.

A layout is a copy of the table, sorted by one column into parts by range, with the lowest and highest key of
each part beside it (a row for each part). A lookup finds its parts there and opens their files alone; row
groups within them are skipped by their statistics, and by bloom filters for exact keys. A key that has a large
part of all rows lies in several parts, as the sort goes on by further columns. What a second column is looked
up by is a second layout.

Keys are compared as text, byte by byte. Null keys are kept in a layout but found by no lookup.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PARTS = 64


def write(df: DataFrame, path: str, order: list[str], parts: int = PARTS) -> None:
    """A layout of ``df`` at ``path``: looked up by the first column of ``order``, rows sorted by all of them. Its
    ranges are written last and name the rows they are of, so that a layout that isn't whole is never read, and
    one that is written anew is read as it was until then."""
    key, name = order[0], f"rows-{uuid.uuid4().hex}"
    ranged = df.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()).sortWithinPartitions("part", *order)
    ranged.write.option(f"parquet.bloom.filter.enabled#{key}", "true").partitionBy("part").parquet(f"{path}/{name}")
    k = F.col(key).cast("string")
    spans = df.sparkSession.read.parquet(f"{path}/{name}").groupBy("part").agg(F.min(k).alias("low"), F.max(k).alias("high"), F.count("*").alias("n"))
    spans.withColumn("key", F.lit(key)).withColumn("rows", F.lit(name)).coalesce(1).write.mode("overwrite").parquet(f"{path}/ranges")  # a row for each part


def ranges(spark: SparkSession, path: str) -> DataFrame:
    """part, low, high, n, key, rows."""
    return spark.read.parquet(f"{path}/ranges")


def _parts(spark: SparkSession, path: str, wanted: Column) -> tuple[str, DataFrame]:
    """The key column and the rows of the parts that ``wanted`` (over low and high) is true of."""
    own = ranges(spark, path).select("part", "key", "rows", F.coalesce(wanted, F.lit(False)).alias("hit")).collect()  # a row for each part
    if not own:
        raise ValueError(f"{path} holds no rows")
    base = f"{path}/{own[0].rows}"
    places = [f"{base}/part={r.part}" for r in own if r.hit]
    # a place is needed for the schema where no part is asked for
    rows = spark.read.option("basePath", base).parquet(*(places or [f"{base}/part={own[0].part}"])).drop("part")
    return own[0].key, rows if places else rows.limit(0)


def by_key(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The rows of one key."""
    column, rows = _parts(spark, path, (F.col("low") <= key) & (F.col("high") >= key))
    return rows.filter(F.col(column).cast("string") == key)


def by_prefix(spark: SparkSession, path: str, prefix: str) -> DataFrame:
    """The rows whose key starts with ``prefix``."""
    column, rows = _parts(spark, path, (F.col("high") >= prefix) & ((F.col("low") < prefix) | F.col("low").startswith(prefix)))
    return rows.filter(F.col(column).cast("string").startswith(prefix))


def by_keys(spark: SparkSession, path: str, keys: DataFrame | Iterable[str]) -> DataFrame:
    """The rows of a set of keys (a table's first column, of any size, or values). The parts that have none of them
    aren't opened."""
    if not isinstance(keys, DataFrame):
        keys = spark.createDataFrame([(k,) for k in keys], "key string")
    wanted = keys.select(F.col(keys.columns[0]).cast("string").alias("k")).filter("k is not null").distinct()
    spans = [(r.part, r.low, r.high) for r in ranges(spark, path).filter("low is not null").collect()]
    at = F.array(*(F.struct(F.lit(p).alias("part"), F.lit(a).alias("low"), F.lit(b).alias("high")) for p, a, b in spans))
    hit = wanted.withColumn("at", at).select("k", F.explode(F.expr("filter(at, r -> r.low <= k and r.high >= k)")).alias("r"))
    some = {r.part for r in hit.select("r.part").distinct().collect()}  # a row for each part at most
    column, rows = _parts(spark, path, F.col("part").isin(list(some)) if some else F.lit(False))
    return rows.join(wanted, F.col(column).cast("string") == F.col("k"), "left_semi")

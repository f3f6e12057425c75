"""The driver's tables in the roles that the operators expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as versions of a customer: package, seq, released and the version text year.month.nth."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").alias("package"),
        F.col("o_orderkey").alias("seq"),
        F.col("o_orderdate").cast("date").alias("released"),
        F.concat_ws(".", F.year("o_orderdate"), F.month("o_orderdate"), F.col("o_orderkey") % 100).alias("version"),
        F.col("o_totalprice").alias("size"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderstatus")).alias("marker"),
    )


def with_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Those versions with exports (parts), deps (suppliers) and signals (parts returned)."""
    li = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("seq"))
    sets = li.agg(F.collect_set("l_partkey").alias("exports"), F.collect_set("l_suppkey").alias("deps"), F.collect_set(F.when(F.col("l_returnflag") == "R", F.col("l_partkey"))).alias("signals"))
    return order_versions(spark, sf_dir).join(sets, "seq", "left")

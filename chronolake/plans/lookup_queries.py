"""Queries of lookups, isolated metric groups and version order, with their oracles."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from chronolake.functions import isolation, version
from chronolake.operators import authors
from chronolake.plans.tables import table
from chronolake.sources import lookup, shared


def _spans(spark, sf_dir):
    """Customers as authors of the priorities they order with."""
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    rows = o.select(F.lower("c_name").alias("author_key"), F.col("o_orderpriority").alias("package"), F.col("o_orderdate").cast("date").alias("released"), F.col("o_orderkey").cast("string").alias("version"))
    return authors.spans(rows, "author_key", "package", "released", "version", [])


def _opened(found, spark, path):
    """The rows, with whether the lookup opened a quarter of the layout's files at most."""
    whole = lookup.ranges(spark, path).first().rows
    few = 4 * len(found.inputFiles()) <= len(spark.read.parquet(f"{path}/{whole}").inputFiles())
    return found.withColumn("few_files", F.lit(few))


def lookup_by_author(spark, sf_dir):
    """The author page: all rows whose author starts so."""
    path = shared.new_path(spark, "spans-by-author")
    lookup.write(_spans(spark, sf_dir), path, ["author_key", "package"], 32)
    return _opened(lookup.by_prefix(spark, path, "customer#00000001"), spark, path)


def lookup_by_package(spark, sf_dir):
    """The package page: the reverse layout, whose five keys lie in several parts each."""
    path = shared.new_path(spark, "spans-by-package")
    lookup.write(_spans(spark, sf_dir), path, ["package", "author_key"], 32)
    return _opened(lookup.by_key(spark, path, "3-MEDIUM"), spark, path).drop("few_files")


def lookup_by_keys(spark, sf_dir):
    """The rows of the authors with the highest balances and of one that there isn't."""
    path = shared.new_path(spark, "spans-of-keys")
    lookup.write(_spans(spark, sf_dir), path, ["author_key", "package"], 32)
    rich = table(spark, sf_dir, "customer").filter("c_acctbal > 9900").select(F.lower("c_name").alias("k"))
    return lookup.by_keys(spark, path, rich.unionByName(spark.createDataFrame([("nobody",)], "k string")))


def _props(text: str):
    """Strict: numbers that can be divided by 25 aren't allowed."""
    k = json.loads(text)["k"]
    if k % 25 == 0:
        raise ValueError(f"k is {k}")
    yield (k,)


def isolated_metrics(spark, sf_dir):
    """Users' events as files of snapshots: a parser that raises on some events, a plan that raises on one user, and one
    that never does."""
    e = table(spark, sf_dir, "events")
    files = e.select(F.lit("users").alias("package"), F.col("user_id").cast("string").alias("version"), F.lpad(F.col("event_id").cast("string"), 12, "0").alias("path"), F.col("props").alias("content"), "value")
    keys = ["package", "version"]
    total = isolation.Parser("total", _props, "k long", lambda r: r.groupBy(*keys).agg(F.sum("k").alias("total_k"), F.max("k").alias("most_k")))
    least = files.agg(F.min(F.col("version").cast("long"))).first()[0]
    sign = F.when(F.col("version") == str(least), F.raise_error(F.lit("no sign"))).otherwise(F.lit("ok"))
    signed = isolation.Plan("signed", lambda f: f.groupBy(*keys).agg(F.max(sign).alias("sign"), F.count("*").alias("n_signed")))
    plain = isolation.Plan("plain", lambda f: f.groupBy(*keys).agg(F.count("*").alias("n_files")))
    df = isolation.measured(files, [total, signed, plain], keys)
    return df.select("version", "total_k", "most_k", "n_signed", "n_files", F.col("`.error.total`").alias("error_total"), F.col("`.error.signed`").isNotNull().alias("failed_signed"), F.col("`.error.plain`").alias("error_plain"))


def _named(o):
    """Versions as they are written in the wild: with suffixes, dashes, long numbers."""
    kinds = ("1.{}", "1.{}_2", "1.{}rc1", "1-{}", "v1.{}", "1.{}.20240101123")
    text = F.element_at(F.array(*(F.format_string(k.replace("{}", "%d"), F.col("o_orderkey") % 120) for k in kinds)), (F.col("o_orderkey") % 6 + 1).cast("int"))
    return o.select(F.col("o_custkey").alias("package"), F.col("o_orderkey").alias("seq"), text.alias("version"))


def version_order(spark, sf_dir):
    """Where each such version stands among its package's."""
    v = _named(table(spark, sf_dir, "orders"))
    w = lookup_window("package").orderBy(version.padded_key("version"), "version", "seq")
    return v.withColumn("nth", F.row_number().over(w))


def lookup_window(by):
    from pyspark.sql import Window

    return Window.partitionBy(by)


_SPANS = """
WITH r AS (SELECT lower(c_name) AS author_key, o_orderpriority AS package, CAST(o_orderdate AS DATE) AS released, o_orderkey AS v FROM orders JOIN customer ON o_custkey = c_custkey),
s AS (SELECT author_key, package, CAST(arg_min(v, (released, v)) AS VARCHAR) AS first_version, min(released) AS first_seen, CAST(arg_max(v, (released, v)) AS VARCHAR) AS last_version, max(released) AS last_seen, count(DISTINCT v) AS n_versions FROM r GROUP BY 1, 2)
"""

QUERIES = {
    "lookup_by_author": (lookup_by_author, _SPANS + "SELECT *, true AS few_files FROM s WHERE starts_with(author_key, 'customer#00000001')"),
    "lookup_by_package": (lookup_by_package, _SPANS + "SELECT * FROM s WHERE package = '3-MEDIUM'"),
    "lookup_by_keys": (lookup_by_keys, _SPANS + "SELECT * FROM s WHERE author_key IN (SELECT lower(c_name) FROM customer WHERE c_acctbal > 9900)"),
    "isolated_metrics": (
        isolated_metrics,
        "WITH e AS (SELECT CAST(user_id AS VARCHAR) AS version, lpad(CAST(event_id AS VARCHAR), 12, '0') AS path, CAST(json_extract(props, '$.k') AS BIGINT) AS k, user_id FROM events), "
        "g AS (SELECT version, any_value(user_id) AS u, count(*) AS n, sum(k) AS s, max(k) AS m, arg_min(path || ': ValueError: k is ' || k, path) FILTER (WHERE k % 25 = 0) AS bad FROM e GROUP BY 1), l AS (SELECT min(u) AS least FROM g) "
        "SELECT version, CASE WHEN bad IS NULL THEN CAST(s AS BIGINT) END AS total_k, CASE WHEN bad IS NULL THEN m END AS most_k, CASE WHEN u <> least THEN n END AS n_signed, n AS n_files, bad AS error_total, u = least AS failed_signed, CAST(NULL AS VARCHAR) AS error_plain FROM g, l",
    ),
    "version_order": (
        version_order,
        "WITH k AS (SELECT o_custkey AS package, o_orderkey AS seq, replace(['1.{}', '1.{}_2', '1.{}rc1', '1-{}', 'v1.{}', '1.{}.20240101123'][CAST(o_orderkey % 6 + 1 AS INTEGER)], '{}', CAST(o_orderkey % 120 AS VARCHAR)) AS version FROM orders), "
        "d AS (SELECT *, regexp_replace(regexp_replace(replace(version, '-', '.'), '([0-9]+)', '000000000\\1', 'g'), '0*([0-9]{10})', '\\1', 'g') AS key FROM k) "
        "SELECT package, seq, version, CAST(row_number() OVER (PARTITION BY package ORDER BY key, version, seq) AS INTEGER) AS nth FROM d",
    ),
}

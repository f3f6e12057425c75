"""Queries of stored state: contents over batches, ordered writes, growth, retention of manifests, distinct sketches."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronolake.operators import contents_state, quality, retention
from chronolake.plans.tables import order_versions, table
from chronolake.sources import growth, shared
from chronolake.sources.store import Store


def _after_batches(spark, sf_dir):
    """Documents as records of fifty packages: two batches of one generation, then some packages in a new one."""
    d = table(spark, sf_dir, "documents").withColumn("n", F.col("doc_id") % 50)
    rows = lambda where, algo: d.filter(where).select(
        F.concat(F.lit("p"), F.col("n")).alias("package"), F.col("doc_id").cast("string").alias("name"), F.lit("1").alias("version"), F.col("doc_id").alias("seq"), F.sha2("text", 256).alias("content_fp"),
        F.when(F.col("lang") != "en", F.col("lang")).alias("schema_fp"), F.lit(algo).alias("fp_algo_version"), F.lit(False).alias("internal"), (F.col("doc_id") % 2 == 0).alias("is_current"),
        F.col("n_chars").alias("length"), F.substring("text", 1, 5).alias("notes"), F.col("source").alias("origin_dir"), F.col("n_chars").cast("string").alias("row_sketch"),
    )
    store = contents_state.open_state(spark, shared.new_path(spark, "contents"))
    for batch, where, algo in (("a", "n < 25", 1), ("b", "n >= 25", 1), ("c", "n < 10", 2), ("c", "n >= 10", 3)):  # the last is c again: nothing happens
        contents_state.ingest(store, batch, rows(where, algo), ["package", "name", "version"], ["length", "notes", "origin_dir"], "row_sketch")
    contents_state.collect(store, "collection")
    return store


def stored_contents(spark, sf_dir):
    """Contents that three batches and a collection leave: which record each came from first."""
    return _after_batches(spark, sf_dir).read("contents").select("content_fp", "schema_fp", "fp_algo_version", "length", "seq")


def stored_links(spark, sf_dir):
    """Links of all packages with the generation of what they name, and how many identities there are."""
    store = _after_batches(spark, sf_dir)
    own = store.read("contents").select("content_id", "content_fp", "fp_algo_version")
    names = store.read("identities").select("package", "name", "origin_dir")
    return store.read("links").join(own, "content_id", "left").join(names, ["package", "name"], "left").select("package", "name", "notes", "content_fp", "fp_algo_version", "origin_dir")


def ordered_writes(spark, sf_dir):
    """Versions and their markers in two tables: a batch that fails before its marker, done again; a wipe and redo of one table."""
    v = order_versions(spark, sf_dir).select("package", "version", "seq", "size")
    store = Store(spark, shared.new_path(spark, "ordered"), {"versions": "package", "marks": "package"}, 8)
    early, late = v.filter("seq % 4 < 3"), v.filter("seq % 4 = 3")
    marks = lambda df, b: df.groupBy("package").agg(F.count("*").alias("n"), F.lit(b).alias("batch"))

    def fails():
        raise InterruptedError("before the marker")

    store.upsert("1", [("versions", early), ("marks", marks(early, "1"))])
    try:
        store.upsert("2", [("versions", late), ("marks", marks(late, "2"))], before_marker=fails)
    except InterruptedError:
        pass
    store.upsert("2", [("versions", late), ("marks", marks(late, "2"))])
    store.upsert("2", [("versions", early)])  # is done already
    store.upsert("3", [("marks", marks(v.filter("size > 200000"), "3"))], wiped=["marks"])
    store.vacuum()
    n = store.read("versions").groupBy("package").agg(F.count("*").alias("n_versions"), F.sum("size").alias("size"))
    return n.join(store.read("marks"), "package", "left").select("package", "n_versions", "size", F.col("n").alias("n_marked"), "batch")


def grown_table(spark, sf_dir):
    """Appends whose columns change their types: numbers, then text, then flags; one column declared."""
    o = table(spark, sf_dir, "orders").withColumn("package", F.col("o_custkey").cast("string"))
    path = shared.new_path(spark, "grown")
    part = lambda i: o.filter(F.col("o_orderkey") % 4 == i)
    growth.append(part(0).select("package", "o_orderkey", (F.col("o_orderkey") % 100).cast("int").alias("a"), (F.col("o_orderkey") % 2 == 0).alias("b"), F.col("o_orderstatus").alias("c")), path, buckets=4)
    growth.append(part(1).select("package", "o_orderkey", F.col("o_orderpriority").alias("a"), (F.col("o_orderkey") % 7).alias("b"), F.lit("17").alias("c")), path, buckets=4)
    growth.append(part(2).select("package", "o_orderkey", F.col("o_totalprice").cast("decimal(12,2)").alias("d")), path, buckets=4)
    growth.append(part(3).select("package", "o_orderkey", (F.col("o_orderkey") % 3 == 0).alias("a"), F.col("o_orderkey").alias("d"), F.array("o_orderstatus").alias("e")), path, buckets=4)
    return growth.read(spark, path, {"c": "bigint", "f": "double"})


def _manifest(spark, rows):
    return rows.select(F.to_json(F.struct(*rows.columns)).alias("manifest"))


def _release(spark, sf_dir, where, series="orders"):
    """A manifest of the orders that ``where`` holds for, and what is measured of them."""
    o = table(spark, sf_dir, "orders").filter(where)
    one = o.agg(F.lit(series).alias("series"), F.countDistinct("o_custkey").alias("n_packages"), F.count("*").alias("n_versions"), F.struct(F.count_if(F.col("o_orderstatus") == "F").alias("done"), F.count_if(F.col("o_orderstatus") == "O").alias("open")).alias("tables"))
    return _manifest(spark, one), retention.measured(o.select(F.col("o_custkey").alias("package")))


CHECKS = [("orders", "n_packages", 0.99, 5.0), ("orders", "n_versions", 0.9, 0.0), ("orders", "tables.done", 0.5, 100.0), ("orders", "tables.open", 0.98, 0.0), ("orders", "tables.never", 0.9, 0.0)]


def retention_of_manifests(spark, sf_dir):
    """Every kind of violation and of passing, each under the name of its case."""
    checks = spark.createDataFrame(CHECKS, retention.CHECK)
    full, counted = _release(spark, sf_dir, "true")
    less, few = _release(spark, sf_dir, "o_orderstatus <> 'F' or o_orderkey % 3 = 0")
    none, bad = spark.createDataFrame([], "manifest string"), spark.createDataFrame([("not JSON",)], "manifest string")
    other, _ = _release(spark, sf_dir, "true", "texts")
    derived = retention.baseline("orders", none, counted, {"done": table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'")}, checks)
    cases = {
        "same": retention.violations("orders", full, full, checks, "t1"),
        "less": retention.violations("orders", less, full, checks, "t1"),
        "rebuilt": retention.violations("orders", less, full, checks, "t1", True),
        "first": retention.violations("orders", full, none, checks),
        "lost": retention.violations("orders", full, bad, checks, "t1"),
        "lost texts": retention.violations("texts", full, none, checks, "t1"),
        "nothing now": retention.violations("orders", none, less, checks, "t1"),
        "derived": retention.violations("orders", less, derived, checks, "t1"),
        "audit same": retention.audit("orders", counted, full),
        "audit fewer": retention.audit("orders", few, full),
        "audit more": retention.audit("orders", counted, less),
        "audit none": retention.audit("orders", few, none),
        "preflight": retention.preflight(spark, {"orders": (few, full), "texts": (counted, full), "more": (counted, other)}),
    }
    out = None
    for name, df in cases.items():
        one = df.select(F.lit(name).alias("case_name"), *df.columns)
        out = one if out is None else out.unionByName(one)
    return out


def distinct_estimates(spark, sf_dir):
    """Distinct keys of several tables from sketches by bucket, one of which is refreshed: are they within 2 % of exact?"""
    out = None
    for name, key in (("lineitem", "l_partkey"), ("orders", "o_custkey"), ("events", "event_id"), ("documents", "text")):
        df = table(spark, sf_dir, name)
        stored = quality.distinct_sketches(df.filter(F.xxhash64(F.col(key).cast("string")) % 2 == 0), key, 16)
        bucket = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(16))
        odd = list(range(1, 16, 2))
        now = quality.refreshed_sketches(stored, df.filter(bucket.isin(odd)), key, odd, 16)
        exact = df.agg(F.countDistinct(key).alias("exact"))
        one = quality.distinct_estimate(now).join(exact).select(F.lit(name).alias("table_name"), "n_rows", "exact", (F.abs(F.col("n_distinct") - F.col("exact")) <= 0.02 * F.col("exact")).alias("within"))
        out = one if out is None else out.unionByName(one)
    return out


_RECORDS = """
WITH r AS (SELECT doc_id, doc_id % 50 AS n, 'p' || (doc_id % 50) AS package, CAST(doc_id AS VARCHAR) AS name, sha256(text) AS content_fp, CASE WHEN lang <> 'en' THEN lang ELSE '' END AS schema_fp, n_chars, substr(text, 1, 5) AS notes, source FROM documents),
g AS (SELECT *, 1 AS algo, CASE WHEN n < 25 THEN 1 ELSE 2 END AS batch FROM r UNION ALL SELECT *, 2, 3 FROM r WHERE n < 10),
c AS (SELECT content_fp, schema_fp, algo, arg_min(n_chars, (batch, doc_id)) AS length, arg_min(doc_id, (batch, doc_id)) AS seq FROM g GROUP BY 1, 2, 3),
l AS (SELECT *, CASE WHEN n < 10 THEN 2 ELSE 1 END AS generation FROM r)
"""
_RETAINED = """
WITH f AS (SELECT count(DISTINCT o_custkey) AS p, count(*) AS v, count(*) FILTER (WHERE o_orderstatus = 'F') AS d, count(*) FILTER (WHERE o_orderstatus = 'O') AS o FROM orders),
l AS (SELECT count(DISTINCT o_custkey) AS p, count(*) AS v, count(*) FILTER (WHERE o_orderstatus = 'F') AS d, count(*) FILTER (WHERE o_orderstatus = 'O') AS o FROM orders WHERE o_orderstatus <> 'F' OR o_orderkey % 3 = 0),
k AS (SELECT * FROM (VALUES ('n_packages', 0.99, 5.0), ('n_versions', 0.9, 0.0), ('tables.done', 0.5, 100.0), ('tables.open', 0.98, 0.0)) AS t(path, ratio, allowance)),
b AS (SELECT path, ratio::DOUBLE AS ratio, allowance::DOUBLE AS allowance, CASE path WHEN 'n_packages' THEN f.p WHEN 'n_versions' THEN f.v WHEN 'tables.done' THEN f.d ELSE f.o END::DOUBLE AS full_n, CASE path WHEN 'n_packages' THEN l.p WHEN 'n_versions' THEN l.v WHEN 'tables.done' THEN l.d ELSE l.o END::DOUBLE AS less_n FROM k, f, l),
c AS (SELECT 'less' AS case_name, path, full_n AS before, less_n AS now, ratio, allowance FROM b UNION ALL SELECT 'nothing now', path, less_n, 0, ratio, allowance FROM b
  UNION ALL SELECT 'derived', path, CASE WHEN path = 'tables.open' THEN 0 ELSE full_n END, less_n, ratio, allowance FROM b),
a AS (SELECT n AS case_name, path, full_n AS before, less_n AS now FROM b, (VALUES ('audit fewer'), ('preflight')) AS t(n) WHERE path LIKE 'n%' UNION ALL SELECT 'audit more', path, less_n, full_n FROM b WHERE path LIKE 'n%')
SELECT case_name, 'orders' AS series, 'fell' AS kind, path, before, now, least(before * ratio, before - allowance) AS floor FROM c WHERE now < least(before * ratio, before - allowance)
UNION ALL SELECT 'lost', 'orders', 'no baseline', 't1', NULL, NULL, NULL
UNION ALL SELECT case_name, 'orders', CASE WHEN now < before THEN 'fewer' ELSE 'more' END, path, before, now, before FROM a WHERE now <> before
UNION ALL SELECT 'preflight', 'texts', 'other series', 'orders', NULL, NULL, NULL UNION ALL SELECT 'preflight', 'more', 'other series', 'texts', NULL, NULL, NULL
"""

QUERIES = {
    "stored_contents": (
        stored_contents,
        _RECORDS + "SELECT content_fp, schema_fp, algo AS fp_algo_version, length, seq FROM c WHERE (content_fp, schema_fp, algo) IN (SELECT (content_fp, schema_fp, generation) FROM l)",
    ),
    "stored_links": (stored_links, _RECORDS + "SELECT package, name, notes, content_fp, generation AS fp_algo_version, CASE WHEN doc_id % 2 = 0 THEN source END AS origin_dir FROM l"),
    "ordered_writes": (
        ordered_writes,
        "WITH o AS (SELECT o_custkey AS package, o_orderkey AS seq, o_totalprice AS size FROM orders), late AS (SELECT DISTINCT package FROM o WHERE seq % 4 = 3), "
        "v AS (SELECT * FROM o WHERE (package IN (SELECT package FROM late) AND seq % 4 = 3) OR package NOT IN (SELECT package FROM late)), m AS (SELECT package, count(*) AS n FROM o WHERE size > 200000 GROUP BY 1) "
        "SELECT v.package, count(*) AS n_versions, sum(size) AS size, any_value(n) AS n_marked, CASE WHEN any_value(n) IS NOT NULL THEN '3' END AS batch FROM v LEFT JOIN m USING (package) GROUP BY 1",
    ),
    "grown_table": (
        grown_table,
        "SELECT CAST(o_custkey AS VARCHAR) AS package, o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN CAST(o_orderkey % 100 AS VARCHAR) WHEN 1 THEN o_orderpriority WHEN 3 THEN CASE WHEN o_orderkey % 3 = 0 THEN '1' ELSE '0' END END AS a, "
        "CASE o_orderkey % 4 WHEN 0 THEN CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END WHEN 1 THEN o_orderkey % 7 END AS b, CASE o_orderkey % 4 WHEN 1 THEN 17::BIGINT END AS c, "
        "CASE o_orderkey % 4 WHEN 2 THEN o_totalprice WHEN 3 THEN CAST(o_orderkey AS DOUBLE) END AS d, CASE o_orderkey % 4 WHEN 3 THEN '[\"' || o_orderstatus || '\"]' END AS e, CAST(NULL AS DOUBLE) AS f FROM orders",
    ),
    "retention_of_manifests": (retention_of_manifests, _RETAINED),
    "distinct_estimates": (
        distinct_estimates,
        "SELECT 'lineitem' AS table_name, count(*) AS n_rows, count(DISTINCT l_partkey) AS exact, true AS within FROM lineitem UNION ALL SELECT 'orders', count(*), count(DISTINCT o_custkey), true FROM orders "
        "UNION ALL SELECT 'events', count(*), count(DISTINCT event_id), true FROM events UNION ALL SELECT 'documents', count(*), count(DISTINCT text), true FROM documents",
    ),
}

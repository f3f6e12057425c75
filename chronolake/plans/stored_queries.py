"""Queries over stored state: content addressing and incremental work, with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronolake.operators import contents, incremental, series
from chronolake.plans.tables import order_versions, table


def _records(spark, sf_dir):
    """Documents as records of contents: every source has names, a text may stand in several."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.col("source").alias("package"),
        (F.col("doc_id") % 50).cast("string").alias("name"),
        F.col("doc_id").alias("version"),
        F.col("doc_id").alias("seq"),
        F.sha2("text", 256).alias("content_fp"),
        F.when(F.col("lang") != "en", F.col("lang")).alias("schema_fp"),
        F.lit(1).alias("fp_algo_version"),
        (F.col("doc_id") % 3 == 0).alias("internal"),
        (F.col("doc_id") % 2 == 0).alias("is_current"),
        "n_chars",
        F.when(F.col("doc_id") % 4 == 1, F.col("n_chars").cast("string")).alias("row_sketch"),
    )


_RECORDS = """
WITH r AS (SELECT source AS package, CAST(doc_id % 50 AS VARCHAR) AS name, doc_id AS version, sha256(text) AS content_fp, CASE WHEN lang <> 'en' THEN lang ELSE '' END AS schema_fp,
                  1 AS fp_algo_version, doc_id % 3 = 0 AS internal, doc_id % 2 = 0 AS is_current, n_chars, CASE WHEN doc_id % 4 = 1 THEN CAST(n_chars AS VARCHAR) END AS row_sketch FROM documents),
k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY package, name ORDER BY internal, version) AS n FROM r) WHERE n = 1)
"""


def content_dedup(spark, sf_dir):
    none = contents.with_content_id(contents.eligible(_records(spark, sf_dir))).limit(0).select(*contents.KEY)
    new = contents.new_contents(contents.eligible(_records(spark, sf_dir)), none, ["n_chars", "version"])
    return new.select("content_fp", "schema_fp", "n_chars", "version")


def content_names(spark, sf_dir):
    return contents.collapsed(contents.eligible(_records(spark, sf_dir)), ["package", "name"]).select("package", "name", "version", "content_fp")


def content_insert(spark, sf_dir):
    """Contents of the later half of the documents that the earlier half hasn't stored."""
    r = contents.eligible(_records(spark, sf_dir))
    half = r.agg((F.max("version") / 2).alias("h"))
    old = r.join(F.broadcast(half), F.col("version") <= F.col("h")).select(*contents.KEY).distinct()
    new = r.join(F.broadcast(half), F.col("version") > F.col("h")).drop("h")
    return contents.new_contents(new, old, ["version"]).select("content_fp", "schema_fp", "version")


def content_sketches(spark, sf_dir):
    r = contents.eligible(_records(spark, sf_dir))
    ids = contents.with_content_id(r).select("content_id", "content_fp", "schema_fp").distinct()
    return contents.sketches(r, "row_sketch").join(ids, "content_id").select("content_fp", "schema_fp", "row_sketch")


def content_gc(spark, sf_dir):
    """Contents that the collapsed names still link to."""
    r = contents.eligible(_records(spark, sf_dir))
    every = contents.with_content_id(r).select("content_id", "content_fp", "schema_fp").distinct()
    links = contents.links(contents.collapsed(r, ["package", "name"]), ["package", "name"])
    return contents.referenced(every, links).select("content_fp", "schema_fp")


def content_identities(spark, sf_dir):
    r = contents.collapsed(contents.eligible(_records(spark, sf_dir)), ["package", "name"])
    return contents.identities(r, ["package", "name"], ["version"])


def _state(spark, sf_dir):
    """The newest version of each customer, as it stood before the last year of orders."""
    v = order_versions(spark, sf_dir)
    newest = series.keep_one(v, ["package"], [F.desc("released"), F.desc("seq")])
    old = series.keep_one(v.filter("released < date '1997-06-01'"), ["package"], [F.desc("released"), F.desc("seq")])
    live = newest.select("package", F.col("version").alias("latest_version"))
    fails = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("package"), (F.col("c_custkey") % 7).cast("int").alias("consecutive_failures"), F.lit("2024-01-01").alias("last_attempt"))
    every = incremental.universe(live, table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("package")))
    return every, old.select("package", "version"), fails


_STATE = """
WITH v AS (SELECT o_custkey AS package, o_orderkey AS seq, CAST(o_orderdate AS DATE) AS released, concat_ws('.', year(o_orderdate), month(o_orderdate), o_orderkey % 100) AS version, o_totalprice AS size FROM orders),
live AS (SELECT package, version AS latest_version FROM (SELECT *, row_number() OVER (PARTITION BY package ORDER BY released DESC, seq DESC) AS n FROM v) WHERE n = 1),
old AS (SELECT package, version FROM (SELECT *, row_number() OVER (PARTITION BY package ORDER BY released DESC, seq DESC) AS n FROM v WHERE released < DATE '1997-06-01') WHERE n = 1),
fails AS (SELECT c_custkey AS package, CAST(c_custkey % 7 AS INTEGER) AS consecutive_failures FROM customer),
every AS (SELECT * FROM live UNION ALL SELECT c_custkey, NULL FROM customer WHERE c_custkey NOT IN (SELECT package FROM live)),
todo AS (SELECT package FROM every LEFT JOIN old USING (package) WHERE (old.version IS NULL OR (latest_version IS NOT NULL AND latest_version <> old.version)) AND package NOT IN (SELECT package FROM fails WHERE consecutive_failures >= 5))
"""


def universe_rows(spark, sf_dir):
    return _state(spark, sf_dir)[0]


def change_detection(spark, sf_dir):
    return incremental.changed(*_state(spark, sf_dir))


def sentinel_backfill(spark, sf_dir):
    """Sources with a document that has no label."""
    d, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rows = d.join(labels.groupBy("doc_id").agg(F.max("quality").alias("quality")), "doc_id", "left").select(F.col("source").alias("package"), "doc_id", "quality")
    every = d.select(F.col("source").alias("package")).distinct()
    none = every.limit(0).select("package", F.lit(0).alias("consecutive_failures"))
    return incremental.backfill(rows, every, none, "quality")


def stale_scan(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("n_chars").alias("scanned"), F.col("lang").alias("build"))
    return incremental.invalidated(d, "scanned", "build", "en")


def todo_shard(spark, sf_dir):
    """The first 400 customers to do: a shard's size is the feature."""
    every, old, fails = _state(spark, sf_dir)
    rich = table(spark, sf_dir, "customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("package"))
    return incremental.shard([incremental.changed(every, old, fails), rich], 400)


def upsert_result(spark, sf_dir):
    v = order_versions(spark, sf_dir).select("package", "version", "seq", "released", "size")
    stored = v.filter("released < date '1997-06-01'").drop("seq")
    fresh = v.filter("released >= date '1997-06-01'")
    return incremental.upsert(stored, fresh, ["package", "version"], "seq")


def failure_counters(spark, sf_dir):
    _, _, fails = _state(spark, sf_dir)
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("package")).agg((F.max("o_totalprice") > 300000).alias("ok")).withColumn("attempted", F.lit("2024-02-02"))
    return incremental.counted(fails.filter("consecutive_failures > 0"), o)


def narrow_projection(spark, sf_dir):
    """Customers' narrow rows after a batch of values from suppliers with the same number."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("package"), F.when(F.col("c_custkey") % 3 > 0, F.col("c_name")).alias("title"), F.col("c_mktsegment").alias("license"), F.md5("c_name").alias("description_hash"))
    s = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") * 2).alias("package"), F.when(F.col("s_suppkey") % 2 == 0, F.col("s_name")).alias("title"), F.lit(None).cast("string").alias("license"), F.lit(None).cast("string").alias("description_hash"))
    return incremental.projected(c, s, "package", ["title", "license", "description_hash"])


def harvest_selection(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("package"), F.when(F.col("c_custkey") % 3 > 0, F.col("c_name")).alias("title"), F.md5("c_mktsegment").alias("description_hash"))
    fetched = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("package"), F.when(F.col("c_custkey") % 2 == 0, F.md5("c_mktsegment")).otherwise(F.md5("c_name")).alias("description_hash"))
    return incremental.to_harvest(c, fetched).select("package", "description_hash")


QUERIES = {
    "content_dedup": (content_dedup, _RECORDS + "SELECT content_fp, schema_fp, arg_min(n_chars, version) AS n_chars, min(version) AS version FROM r GROUP BY 1, 2"),
    "content_names": (content_names, _RECORDS + "SELECT package, name, version, content_fp FROM k"),
    "content_insert": (
        content_insert,
        _RECORDS + ", h AS (SELECT max(version) / 2 AS h FROM r) SELECT content_fp, schema_fp, min(version) AS version FROM r, h WHERE version > h AND (content_fp, schema_fp) NOT IN (SELECT (content_fp, schema_fp) FROM r, h WHERE version <= h) GROUP BY 1, 2",
    ),
    "content_sketches": (content_sketches, _RECORDS + "SELECT content_fp, schema_fp, arg_min(row_sketch, version) AS row_sketch FROM r WHERE row_sketch IS NOT NULL GROUP BY 1, 2"),
    "content_gc": (content_gc, _RECORDS + "SELECT DISTINCT content_fp, schema_fp FROM k"),
    "content_identities": (content_identities, _RECORDS + "SELECT package, name, version FROM k WHERE is_current"),
    "universe_rows": (universe_rows, _STATE + "SELECT * FROM every"),
    "change_detection": (change_detection, _STATE + "SELECT package FROM todo"),
    "sentinel_backfill": (
        sentinel_backfill,
        "WITH q AS (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY 1) SELECT DISTINCT source AS package FROM documents LEFT JOIN q USING (doc_id) WHERE quality IS NULL",
    ),
    "stale_scan": (stale_scan, "SELECT doc_id, CASE WHEN lang = 'en' THEN n_chars END AS scanned, lang AS build FROM documents"),
    "todo_shard": (todo_shard, _STATE + "SELECT package FROM (SELECT package FROM todo UNION SELECT c_custkey FROM customer WHERE c_acctbal < 0) ORDER BY package LIMIT 400"),
    "upsert_result": (
        upsert_result,
        _STATE + ", f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY package, version ORDER BY seq DESC) AS n FROM v WHERE released >= DATE '1997-06-01') WHERE n = 1) "
        "SELECT package, version, released, size FROM v WHERE released < DATE '1997-06-01' AND package NOT IN (SELECT package FROM f) UNION ALL SELECT package, version, released, size FROM f",
    ),
    "failure_counters": (
        failure_counters,
        _STATE + ", o AS (SELECT o_custkey AS package, max(o_totalprice) > 300000 AS ok FROM orders GROUP BY 1) "
        "SELECT package, CAST(CASE WHEN ok IS NULL THEN c ELSE coalesce(c, 0) + 1 END AS INTEGER) AS consecutive_failures, CASE WHEN ok IS NULL THEN '2024-01-01' ELSE '2024-02-02' END AS last_attempt "
        "FROM (SELECT package, consecutive_failures AS c FROM fails WHERE consecutive_failures > 0) f FULL JOIN o USING (package) WHERE ok IS NULL OR NOT ok",
    ),
    "narrow_projection": (
        narrow_projection,
        "WITH c AS (SELECT c_custkey AS package, CASE WHEN c_custkey % 3 > 0 THEN c_name END AS title, c_mktsegment AS license, md5(c_name) AS description_hash FROM customer), "
        "s AS (SELECT s_suppkey * 2 AS package, CASE WHEN s_suppkey % 2 = 0 THEN s_name END AS new FROM supplier) "
        "SELECT package, coalesce(new, title) AS title, license, CASE WHEN new IS NULL THEN description_hash END AS description_hash FROM c FULL JOIN s USING (package)",
    ),
    "harvest_selection": (
        harvest_selection,
        "SELECT c_custkey AS package, md5(c_name) AS description_hash FROM customer WHERE c_custkey % 3 = 0 AND c_custkey % 2 = 1",
    ),
}

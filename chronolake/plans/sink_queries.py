"""Queries that go through the sources and sinks and back, and of what a run says of itself, with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from chronolake.operators import incremental, quality
from chronolake.plans.tables import order_versions, table
from chronolake.sources import archive, shared


def table_upsert_on_disk(spark, sf_dir):
    """A table written, appended to with a new column, upserted by package, its flags as numbers, of the wanted columns those that
    there are."""
    path = shared.new_path(spark, "sink")
    v = order_versions(spark, sf_dir).select("package", "version", "seq", "size")
    archive.write_table(v.filter("seq % 4 = 0").withColumn("large", F.col("size") > 200000), path, buckets=8)
    archive.append_table(v.filter("seq % 4 = 1").withColumn("large", F.col("size") > 200000).withColumn("added", F.col("seq") * 2), path, buckets=8)
    archive.replace_packages(spark, path, v.filter("seq % 4 = 2 and package % 3 = 0").withColumn("large", F.lit(None).cast("boolean")), ["package", "seq"], buckets=8)
    rows = archive.with_int_flags(archive.read_table(spark, path))
    return archive.present(rows, ["package", "seq", "version", "large", "added", "nowhere"])


def manifest_on_disk(spark, sf_dir):
    """A manifest with the progress of a first pass, written, read again by its schema; one that isn't there is none."""
    v, c = order_versions(spark, sf_dir), table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("package"))
    first = quality.progress(c, v, c.filter("package % 50 = 1"))
    path = shared.new_path(spark, "manifest")
    archive.write_manifest(quality.manifest({"orders": v}, v, "package", "seq", ["size"], first), path)
    schema = "tables map<string, struct<n_rows: bigint, n_packages: bigint>>, bootstrap struct<n_universe: bigint, n_analyzed: bigint, n_permanent: bigint, n_remaining: bigint, bootstrap_complete: boolean>"
    read, none = archive.read_manifest(spark, path, schema), archive.read_manifest(spark, f"{path}-none", schema)
    return read.select(F.col("tables")["orders"]["n_rows"].alias("n_rows"), "bootstrap.*", F.lit(none is None).alias("other_missing"))


def accumulated_keys(spark, sf_dir):
    """A set of keys that grows, and the rows fetched by it."""
    d = table(spark, sf_dir, "documents").select(F.coalesce("lang", F.lit("")).alias("package"), "source", "doc_id")
    keys = archive.accumulated(d.filter("doc_id % 3 = 0").select("package"), d.filter("doc_id % 7 = 1").select("package"), "package")
    return archive.fetched(d, keys).select("package", "doc_id")


def flattened_records(spark, sf_dir):
    """Records with nested values, these as JSON text."""
    o = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list("l_linenumber")).alias("lines"), F.max(F.struct(F.col("l_linenumber").alias("n"), F.col("l_returnflag").alias("flag"))).alias("last"), F.count("*").alias("n"))
    return archive.flattened(o)


def open_record_types(spark, sf_dir):
    """Records whose keys have whole numbers, numbers, flags, mixed and nested values."""
    o = table(spark, sf_dir, "orders")
    even = F.col("o_orderkey") % 2 == 0
    line = F.to_json(
        F.struct(
            F.col("o_orderkey").alias("key"),
            F.when(even, F.lit(1.5)).otherwise(F.lit(2.0)).alias("real"),
            even.alias("flag"),
            F.when(even, F.col("o_orderstatus")).otherwise(F.col("o_orderkey").cast("string")).alias("mixed"),
            F.when(even, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.col("o_orderstatus"))).alias("columns"),
            F.struct(F.col("o_orderstatus").alias("s")).alias("inner"),
        )
    )
    base = StructType.fromDDL("key bigint, file string")
    return archive.open_records(o.select(line.alias("line")), base).select("key", "real", "flag", "mixed", "file", "n_cols", F.col("inner").alias("inner_text"))


def authoritative_rows(spark, sf_dir):
    """Narrow rows after fetched descriptions, which overwrite title and hash and fill in the license."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("package"), F.when(F.col("c_custkey") % 3 > 0, F.col("c_name")).alias("title"), F.when(F.col("c_custkey") % 5 > 0, F.col("c_mktsegment")).alias("license"), F.md5("c_name").alias("description_hash"))
    s = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") * 2).alias("package"), F.when(F.col("s_suppkey") % 2 == 0, F.col("s_name")).alias("title"), F.lit("open").alias("license"), F.when(F.col("s_suppkey") % 4 == 0, F.md5("s_name")).alias("description_hash"))
    return incremental.projected(c, s, "package", ["title", "license", "description_hash"], ("title", "description_hash"))


def run_status(spark, sf_dir):
    """What a run says at its end: complete, changed, consistent."""
    v, c = order_versions(spark, sf_dir), table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("package"))
    p = quality.progress(c, v, c.filter("package % 50 = 1"), 3).first()
    before, now = (quality.fingerprint_by_parts(df, "package", "seq").first().fingerprint for df in (v.filter("released < date '1998-01-01'"), v))
    done = incremental.is_complete(0, p.n_analyzed, p.n_universe, p.n_universe - p.n_analyzed)
    n = v.count()
    rows = [("complete", p.bootstrap_complete), ("complete without failures", done), ("moved", incremental.has_changed(False, 0, before, now)), ("still", incremental.has_changed(False, 0, now, now)), ("forced", incremental.has_changed(True, 0, now, now)), ("consistent", not quality.consistency(n, n, n)), ("api short", not quality.consistency(n - 1, n, n))]
    return spark.createDataFrame(rows, "what string, holds boolean")


def stale_baseline(spark, sf_dir):
    """Recorded counts, those measured where none are recorded, and what a check of several series says of them."""
    o, e = table(spark, sf_dir, "orders"), table(spark, sf_dir, "events")
    derived = quality.baseline({"orders": o, "none": o.limit(0)}, None).select(F.col("field").alias("table_name"), F.col("value").alias("recorded"))
    own = {"derived": ({"orders": o.filter("o_orderkey % 2 = 0")}, derived), "events": ({"events": e}, e.agg(F.lit("events").alias("table_name"), (F.count("*") - 2).alias("recorded"))), "same": ({"events": e}, e.agg(F.lit("events").alias("table_name"), F.count("*").alias("recorded")))}
    return quality.preflight(own)


_P = "WITH c AS (SELECT c_custkey AS p, c_custkey IN (SELECT o_custkey FROM orders) AS a, c_custkey % 50 = 1 AS f FROM customer)"

QUERIES = {
    "table_upsert_on_disk": (
        table_upsert_on_disk,
        "WITH v AS (SELECT o_custkey AS package, o_orderkey AS seq, concat_ws('.', year(o_orderdate), month(o_orderdate), o_orderkey % 100) AS version, o_totalprice AS size FROM orders), "
        "f AS (SELECT * FROM v WHERE seq % 4 = 2 AND package % 3 = 0) SELECT package, seq, version, CAST(size > 200000 AS INTEGER) AS large, CASE WHEN seq % 4 = 1 THEN seq * 2 END AS added FROM v WHERE seq % 4 < 2 AND package NOT IN (SELECT package FROM f) UNION ALL SELECT package, seq, version, NULL, NULL FROM f",
    ),
    "manifest_on_disk": (
        manifest_on_disk,
        _P + " SELECT (SELECT count(*) FROM orders) AS n_rows, count(*) AS n_universe, count(*) FILTER (WHERE a) AS n_analyzed, count(*) FILTER (WHERE f) AS n_permanent, count(*) FILTER (WHERE NOT a AND NOT f) AS n_remaining, n_analyzed >= n_universe - n_permanent AS bootstrap_complete, true AS other_missing FROM c",
    ),
    "accumulated_keys": (
        accumulated_keys,
        "WITH d AS (SELECT coalesce(lang, '') AS package, doc_id FROM documents) SELECT package, doc_id FROM d WHERE package <> '' AND package IN (SELECT package FROM d WHERE doc_id % 3 = 0 OR doc_id % 7 = 1)",
    ),
    "flattened_records": (
        flattened_records,
        """SELECT l_orderkey, '[' || string_agg(CAST(l_linenumber AS VARCHAR), ',' ORDER BY l_linenumber) || ']' AS lines, '{"n":' || max(l_linenumber) || ',"flag":"' || arg_max(l_returnflag, (l_linenumber, l_returnflag)) || '"}' AS last, count(*) AS n FROM lineitem GROUP BY 1""",
    ),
    "open_record_types": (
        open_record_types,
        "SELECT o_orderkey AS key, CASE WHEN o_orderkey % 2 = 0 THEN 1.5::DOUBLE ELSE 2 END AS real, o_orderkey % 2 = 0 AS flag, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus ELSE CAST(o_orderkey AS VARCHAR) END AS mixed, CAST(NULL AS VARCHAR) AS file, "
        "CAST(2 - o_orderkey % 2 AS INTEGER) AS n_cols, '{\"s\":\"' || o_orderstatus || '\"}' AS inner_text FROM orders",
    ),
    "authoritative_rows": (
        authoritative_rows,
        "WITH c AS (SELECT c_custkey AS package, CASE WHEN c_custkey % 3 > 0 THEN c_name END AS t, CASE WHEN c_custkey % 5 > 0 THEN c_mktsegment END AS l, md5(c_name) AS h FROM customer), "
        "s AS (SELECT s_suppkey * 2 AS package, s_suppkey AS k, CASE WHEN s_suppkey % 2 = 0 THEN s_name END AS t, CASE WHEN s_suppkey % 4 = 0 THEN md5(s_name) END AS h FROM supplier) "
        "SELECT package, CASE WHEN k IS NULL THEN c.t ELSE s.t END AS title, CASE WHEN k IS NULL THEN l ELSE 'open' END AS license, CASE WHEN k IS NULL THEN c.h ELSE s.h END AS description_hash FROM c FULL JOIN s USING (package)",
    ),
    "run_status": (run_status, "SELECT * FROM (VALUES ('complete', false), ('complete without failures', true), ('moved', EXISTS (SELECT 1 FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')), ('still', false), ('forced', true), ('consistent', true), ('api short', false)) AS t(what, holds)"),
    "stale_baseline": (
        stale_baseline,
        "SELECT 'derived' AS series, 'orders' AS table_name, count(*) AS recorded, count(*) FILTER (WHERE o_orderkey % 2 = 0) AS measured, 'violation' AS verdict FROM orders UNION ALL SELECT 'events', 'events', count(*) - 2, count(*), 'note' FROM events",
    ),
}

"""Queries about snapshot quality and reports, with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronolake.operators import quality, report, series
from chronolake.plans.tables import order_versions, table

ORDER = ["released", "seq"]
_V = "WITH v AS (SELECT o_custkey AS package, o_orderkey AS seq, CAST(o_orderdate AS DATE) AS released, concat_ws('.', year(o_orderdate), month(o_orderdate), o_orderkey % 100) AS version, o_totalprice AS size FROM orders)"


def catalog_fingerprint(spark, sf_dir):
    return quality.fingerprint(order_versions(spark, sf_dir), "package", "seq")


def catalog_fingerprint_parts(spark, sf_dir):
    return quality.fingerprint_by_parts(order_versions(spark, sf_dir), "package", "seq")


def table_counts(spark, sf_dir):
    named = {"orders": "o_custkey", "customer": "c_custkey", "documents": "source", "labels": None}
    tables = {n: table(spark, sf_dir, n).withColumnRenamed(k, "package") if k else table(spark, sf_dir, n) for n, k in named.items()}
    return quality.counts(tables)


def manifest_stats(spark, sf_dir):
    return quality.stats(table(spark, sf_dir, "documents").withColumn("long_text", F.col("n_chars") / 2), ["n_chars", "long_text", "lang", "absent"])


def manifest_document(spark, sf_dir):
    v = order_versions(spark, sf_dir)
    m = quality.manifest({"orders": v}, v, "package", "seq", ["size"])
    of = lambda path, kind: F.get_json_object("manifest", f"$.{path}").cast(kind)
    return m.select(of("tables.orders.n_rows", "bigint").alias("n_rows"), of("tables.orders.n_packages", "bigint").alias("n_packages"), of("stats.size.mean", "double").alias("mean"), of("stats.size.median", "double").alias("median"), of("fingerprint", "string").alias("fingerprint"))


def _labelled(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    return table(spark, sf_dir, "documents").join(labels, "doc_id", "left").select("doc_id", "lang", "n_chars", "quality", "toxic", (F.col("n_chars") > 5000).alias("long_text"))


def metric_coverage(spark, sf_dir):
    return quality.coverage(_labelled(spark, sf_dir))


def coverage_alerts(spark, sf_dir):
    d = _labelled(spark, sf_dir).withColumn("nothing", F.lit(None).cast("int")).withColumn("never", F.lit(False))
    thin = d.withColumn("quality", F.when(F.col("doc_id") % 5 == 0, F.col("quality"))).withColumn("toxic", F.when(F.col("toxic") == 0, 0))
    return quality.coverage_alerts(quality.coverage(thin), quality.coverage(d))


def retention_check(spark, sf_dir):
    by_status = lambda d: d.groupBy(F.col("o_orderpriority").alias("field")).agg(F.count("*").alias("value"))
    o = table(spark, sf_dir, "orders")
    now = by_status(o.filter("o_orderdate >= timestamp '1995-01-01' and (o_orderpriority <> '1-URGENT' or o_orderkey % 3 = 0)"))
    limits = o.select(F.col("o_orderpriority").alias("field")).distinct().withColumns({"ratio": F.lit(0.5), "allowance": F.lit(100)})
    return quality.retention(now, by_status(o), limits)


def table_audit(spark, sf_dir):
    tables = {"orders": order_versions(spark, sf_dir), "events": table(spark, sf_dir, "events"), "labels": table(spark, sf_dir, "labels").filter("quality = 1")}
    full = [table(spark, sf_dir, n).agg(F.lit(n).alias("table_name"), F.count("*").alias("recorded")) for n in ("orders", "labels", "customer")]
    recorded = full[0].unionByName(full[1]).unionByName(full[2]).unionByName(tables["events"].agg(F.lit("events").alias("table_name"), (F.count("*") - 1).alias("recorded")))
    return quality.audit(tables, recorded)


def share_measured(spark, sf_dir):
    return quality.share_measured(_labelled(spark, sf_dir), "lang", ["quality", "toxic"])


def _changed(spark, sf_dir):
    v = order_versions(spark, sf_dir)
    last = series.keep_one(v, ["package"], [F.desc("released"), F.desc("seq")])
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("seq")).agg(F.bool_or(F.col("l_returnflag") == "R").alias("is_breaking"), F.count("*").alias("moved"))
    return last.join(lines, "seq", "left").select("package", "is_breaking", "moved", "size")


def ranked_changes(spark, sf_dir):
    """The 40 customers on top of the report, and how many follow."""
    return report.top_with_rest(_changed(spark, sf_dir), report.ranked("is_breaking", "moved", "size", "package"), 40)


def byte_budget(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return report.within_budget(d, [F.asc("doc_id")], "text", 60000).select("doc_id", "bytes_used")


def change_summary(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    part = lambda c: o.filter(c).select(F.col("o_custkey").alias("package"))
    n, done = table(spark, sf_dir, "customer").count(), o.select("o_custkey").distinct().count()
    return report.change_summary(part("o_orderdate >= timestamp '1998-01-01'"), part("o_orderdate < timestamp '1994-01-01'"), n, done)


def catalog_deltas(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    count = lambda d: d.groupBy(F.col("o_orderstatus").alias("field")).agg(F.count("*").alias("value"))
    return report.deltas(count(o), count(o.filter("o_orderdate < timestamp '1997-01-01' and o_orderstatus <> 'P'")))


def dense_counts(spark, sf_dir):
    keys = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("package"))
    return report.dense_counts(keys, order_versions(spark, sf_dir), "package", "n_orders")


def dated_prune(spark, sf_dir):
    tags = table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("tag"))
    return report.to_prune(tags, "tag", 30)


def row_metrics(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(F.col("p_size") % 2 == 0, F.col("p_size")).alias("n_exports"),
        F.when(F.col("p_size") % 3 == 0, F.col("p_size")).alias("n_internal"),
        (F.col("p_size") * 10).alias("n_functions_fallback"),
        F.when(F.col("p_size") % 5 == 0, F.lit(7)).alias("n_deps_direct"),
        F.concat(F.lit("R (>= 4.0), "), F.regexp_replace("p_name", " ", ", ")).alias("raw_deps"),
    )
    return report.row_metrics(p).select("p_partkey", "n_functions", F.col("n_deps").cast("bigint").alias("n_deps"))


def bounded_report(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    fixed = d.groupBy("lang").agg(F.count("*").alias("n")).select(F.lit(1).alias("section"), F.row_number().over(series.Window.orderBy("lang")).cast("long").alias("line_no"), F.concat_ws(" ", "lang", F.col("n").cast("string")).alias("text"))
    rows = d.select(F.lit(2).alias("section"), F.col("doc_id").alias("line_no"), F.concat_ws(" ", F.col("doc_id").cast("string"), "source", "text").alias("text"))
    return report.bounded_report(fixed, rows, 20000).select("section", "line_no", "text")


_LABELLED = """
WITH q AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY 1),
d AS (SELECT doc_id, lang, n_chars, quality, toxic, n_chars > 5000 AS long_text FROM documents LEFT JOIN q USING (doc_id))
"""


def _covered(columns: dict[str, str], source: str) -> str:
    """SQL of coverage rows: column -> boolean, number or other."""
    out = []
    for c, kind in columns.items():
        flag = "true" if kind == "boolean" else f"coalesce(bool_and({c} IN (0, 1)), true)" if kind == "number" else "false"
        positive = f"count(*) FILTER (WHERE {c})" if kind == "boolean" else f"count(*) FILTER (WHERE {c} = 1)" if kind == "number" else "CAST(NULL AS BIGINT)"
        out.append(f"SELECT '{c}' AS metric, count(*) AS n_rows, count({c}) AS measured, CASE WHEN {flag} THEN {positive} END AS positive, CASE WHEN {flag} THEN 'flag' ELSE 'value' END AS kind FROM {source}")
    return " UNION ALL ".join(out)


_PARTS = _V + (
    ", own AS (SELECT CAST(package AS VARCHAR) AS p, sha256(string_agg(CAST(seq AS VARCHAR), ',' ORDER BY CAST(seq AS VARCHAR))) AS d FROM v GROUP BY 1), "
    "part AS (SELECT substring(md5(p), 1, 3) AS k, sha256(string_agg(p || ':' || d, ',' ORDER BY p || ':' || d)) AS d FROM own GROUP BY 1), t AS (SELECT sha256(string_agg(k || ':' || d, ',' ORDER BY k || ':' || d)) AS fingerprint FROM part) "
)
_KINDS = {"doc_id": "number", "lang": "other", "n_chars": "number", "quality": "number", "toxic": "number", "long_text": "boolean"}
_CHANGED = _V + (
    ", last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY package ORDER BY released DESC, seq DESC) AS n FROM v) WHERE n = 1), "
    "l AS (SELECT l_orderkey AS seq, bool_or(l_returnflag = 'R') AS is_breaking, count(*) AS moved FROM lineitem GROUP BY 1), c AS (SELECT package, is_breaking, moved, size FROM last LEFT JOIN l USING (seq)) "
)

QUERIES = {
    "catalog_fingerprint": (catalog_fingerprint, _V + "SELECT sha256(string_agg(package || ':' || seq, ',' ORDER BY package, seq)) AS fingerprint FROM v"),
    "catalog_fingerprint_parts": (catalog_fingerprint_parts, _PARTS + "SELECT fingerprint FROM t"),
    "table_counts": (
        table_counts,
        "SELECT 'orders' AS table_name, count(*) AS n_rows, count(DISTINCT o_custkey) AS n_packages FROM orders UNION ALL SELECT 'customer', count(*), count(DISTINCT c_custkey) FROM customer "
        "UNION ALL SELECT 'documents', count(*), count(DISTINCT source) FROM documents UNION ALL SELECT 'labels', count(*), NULL FROM labels",
    ),
    "manifest_stats": (
        manifest_stats,
        "SELECT 'n_chars' AS metric, avg(n_chars) AS mean, median(n_chars) AS median FROM documents UNION ALL SELECT 'long_text', avg(n_chars / 2), median(n_chars / 2) FROM documents "
        "UNION ALL SELECT 'lang', NULL, NULL UNION ALL SELECT 'absent', NULL, NULL",
    ),
    "manifest_document": (manifest_document, _PARTS + "SELECT count(*) AS n_rows, count(DISTINCT package) AS n_packages, avg(size) AS mean, median(size) AS median, (SELECT fingerprint FROM t) AS fingerprint FROM v"),
    "metric_coverage": (metric_coverage, _LABELLED + _covered(_KINDS, "d")),
    "coverage_alerts": (
        coverage_alerts,
        _LABELLED
        + ", b AS (SELECT *, CAST(NULL AS INTEGER) AS nothing, false AS never FROM d), t AS (SELECT * REPLACE (CASE WHEN doc_id % 5 = 0 THEN quality END AS quality, CASE WHEN toxic = 0 THEN 0 END AS toxic) FROM b), "
        + "cb AS ("
        + _covered(_KINDS | {"nothing": "number", "never": "boolean"}, "b")
        + "), ct AS ("
        + _covered(_KINDS | {"nothing": "number", "never": "boolean"}, "t")
        + "), j AS (SELECT ct.*, cb.measured AS mb, cb.positive AS pb FROM ct LEFT JOIN cb USING (metric)) "
        "SELECT metric, 'never measured' AS alert FROM j WHERE measured = 0 UNION ALL SELECT metric, 'true for none' FROM j WHERE kind = 'flag' AND measured > 0 AND positive = 0 "
        "UNION ALL SELECT metric, 'measured fell' FROM j WHERE mb > 100 AND measured < mb * 0.5 UNION ALL SELECT metric, 'positive fell' FROM j WHERE pb > 100 AND positive < pb * 0.5",
    ),
    "retention_check": (
        retention_check,
        "WITH b AS (SELECT o_orderpriority AS field, count(*) AS prior FROM orders GROUP BY 1), n AS (SELECT o_orderpriority AS field, count(*) AS value FROM orders WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND (o_orderpriority <> '1-URGENT' OR o_orderkey % 3 = 0) GROUP BY 1), "
        "j AS (SELECT field, prior, coalesce(value, 0) AS value, least(prior * 0.5::DOUBLE, prior - 100) AS floor FROM b LEFT JOIN n USING (field)) SELECT * FROM j WHERE value < floor",
    ),
    "table_audit": (
        table_audit,
        "WITH r AS (SELECT 'orders' AS table_name, (SELECT count(*) FROM orders) AS recorded, (SELECT count(*) FROM orders) AS measured UNION ALL SELECT 'labels', (SELECT count(*) FROM labels), (SELECT count(*) FROM labels WHERE quality = 1) "
        "UNION ALL SELECT 'customer', (SELECT count(*) FROM customer), 0 UNION ALL SELECT 'events', (SELECT count(*) FROM events) - 1, (SELECT count(*) FROM events)) "
        "SELECT *, CASE WHEN measured < recorded THEN 'violation' WHEN measured > recorded THEN 'note' ELSE 'ok' END AS verdict FROM r",
    ),
    "share_measured": (share_measured, _LABELLED + "SELECT lang, count(quality)::DOUBLE / count(*) AS share_quality, count(toxic)::DOUBLE / count(*) AS share_toxic FROM d GROUP BY 1"),
    "ranked_changes": (
        ranked_changes,
        _CHANGED + ", o AS (SELECT *, row_number() OVER (ORDER BY coalesce(is_breaking::INT, 0) DESC, coalesce(moved, 0) DESC, size DESC, package) AS rank, count(*) OVER () AS total FROM c) "
        "SELECT package, is_breaking, moved, size, CAST(rank AS INTEGER) AS rank, greatest(total - 40, 0) AS n_more FROM o WHERE rank <= 40",
    ),
    "byte_budget": (byte_budget, "SELECT doc_id, CAST(b AS BIGINT) AS bytes_used FROM (SELECT doc_id, sum(strlen(text) + 1) OVER (ORDER BY doc_id) AS b FROM documents) WHERE b <= 60000"),
    "change_summary": (
        change_summary,
        "WITH c AS (SELECT DISTINCT o_custkey AS p FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'), s AS (SELECT DISTINCT o_custkey AS p FROM orders WHERE o_orderdate < TIMESTAMP '1994-01-01'), "
        "u AS (SELECT (SELECT count(*) FROM customer) AS n, (SELECT count(DISTINCT o_custkey) FROM orders) AS a) "
        "SELECT (SELECT count(*) FROM c WHERE p NOT IN (SELECT p FROM s)) AS n_new, (SELECT count(*) FROM c WHERE p IN (SELECT p FROM s)) AS n_updated, CAST(floor(100.0 * a / n) AS BIGINT) AS percent, greatest(n - a, 0) AS remaining FROM u",
    ),
    "catalog_deltas": (
        catalog_deltas,
        "WITH a AS (SELECT o_orderstatus AS field, count(*) AS value FROM orders GROUP BY 1), b AS (SELECT o_orderstatus AS field, count(*) AS b FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01' AND o_orderstatus <> 'P' GROUP BY 1) SELECT field, value, value - b AS change FROM a LEFT JOIN b USING (field)",
    ),
    "dense_counts": (dense_counts, "SELECT c_custkey AS package, count(o_orderkey) AS n_orders FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1"),
    "dated_prune": (
        dated_prune,
        "WITH t AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS tag FROM orders) SELECT tag FROM t WHERE tag NOT IN (SELECT tag FROM t ORDER BY tag DESC LIMIT 30) AND NOT tag LIKE '%-01'",
    ),
    "row_metrics": (
        row_metrics,
        "SELECT p_partkey, CASE WHEN p_size % 2 = 0 OR p_size % 3 = 0 THEN CASE WHEN p_size % 2 = 0 THEN p_size ELSE 0 END + CASE WHEN p_size % 3 = 0 THEN p_size ELSE 0 END END AS n_functions, "
        "CASE WHEN p_size % 5 = 0 THEN 7 ELSE len(list_filter(string_split(p_name, ' '), lambda x: trim(x) <> '')) END AS n_deps FROM part",
    ),
    "bounded_report": (
        bounded_report,
        "WITH f AS (SELECT 1 AS section, row_number() OVER (ORDER BY lang) AS line_no, concat_ws(' ', lang, n) AS text FROM (SELECT lang, count(*) AS n FROM documents GROUP BY 1)), "
        "t AS (SELECT 2 AS section, doc_id AS line_no, concat_ws(' ', doc_id, source, text) AS text FROM documents), "
        "k AS (SELECT section, line_no, text FROM (SELECT *, sum(strlen(text) + 1) OVER (ORDER BY section, line_no) AS b FROM t) WHERE b <= 20000 - (SELECT sum(strlen(text) + 1) FROM f)) SELECT * FROM f UNION ALL SELECT * FROM k",
    ),
}

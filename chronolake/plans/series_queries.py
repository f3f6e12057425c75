"""Queries over ordered series, with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronolake.operators import authors, series
from chronolake.plans.tables import order_versions, table, with_sets

ORDER = ["released", "seq"]

_SETS = """
WITH l AS (SELECT l_orderkey AS seq, list(DISTINCT l_partkey) AS exports, list(DISTINCT l_suppkey) AS deps,
                  list(DISTINCT l_partkey) FILTER (WHERE l_returnflag = 'R') AS signals FROM lineitem GROUP BY 1),
v AS (SELECT o_custkey AS package, o_orderkey AS seq, CAST(o_orderdate AS DATE) AS released,
             year(o_orderdate) AS y, month(o_orderdate) AS m, o_orderkey % 100 AS p,
             concat_ws('.', year(o_orderdate), month(o_orderdate), o_orderkey % 100) AS version, o_totalprice AS size,
             CASE WHEN o_orderstatus = 'F' THEN o_orderstatus END AS marker FROM orders),
s AS (SELECT v.*, coalesce(exports, []) AS exports, coalesce(deps, []) AS deps, coalesce(signals, []) AS signals FROM v LEFT JOIN l USING (seq)),
d AS (SELECT s.*, row_number() OVER w AS rn, coalesce(lag(exports) OVER w, []) AS exports_b, coalesce(lag(deps) OVER w, []) AS deps_b,
             coalesce(lag(signals) OVER w, []) AS signals_b, lag(y) OVER w AS yb, lag(m) OVER w AS mb, lag(p) OVER w AS pb,
             date_diff('day', lag(released) OVER w, released) AS gap
      FROM s WINDOW w AS (PARTITION BY package ORDER BY released, seq)),
x AS (SELECT d.*, list_filter(exports, lambda e: NOT list_contains(exports_b, e)) AS added,
             list_filter(exports_b, lambda e: NOT list_contains(exports, e)) AS removed,
             CASE WHEN rn = 1 THEN 'initial' WHEN y > yb THEN 'major' WHEN m > mb THEN 'minor' WHEN p > pb THEN 'patch' ELSE 'other' END AS bump FROM d)
"""


def release_cadence_drift(spark, sf_dir):
    dates, v = order_versions(spark, sf_dir), with_sets(spark, sf_dir)  # dates need no sets
    return series.cadence(dates, "package", "released").join(series.drift(v, "package", ORDER, "deps", "bigint"), "package")


def bump_and_fidelity(spark, sf_dir):
    v = series.with_set_diff(with_sets(spark, sf_dir), "package", ORDER, "exports", "bigint")
    v = series.with_fidelity(series.with_bump(v, "package", ORDER, "version"))
    return v.select("package", "version", "seq", "bump", F.col("n_added").cast("bigint").alias("n_added"), F.col("n_removed").cast("bigint").alias("n_removed"), "is_breaking", "bump_fidelity")


def interface_diff(spark, sf_dir):
    v = series.with_set_diff(with_sets(spark, sf_dir), "package", ORDER, "exports", "bigint")
    text = lambda c: F.array_join(F.sort_array(c), ",")
    return v.select("seq", text("added").alias("added"), text("removed").alias("removed"))


def cold_removals(spark, sf_dir):
    return series.cold_removals(with_sets(spark, sf_dir), "package", ORDER, "exports", "signals", "bigint")


def deprecation_maturity(spark, sf_dir):
    v = with_sets(spark, sf_dir).withColumn("lifecycle", F.col("size") > 400000)
    return series.deprecation_maturity(v.withColumn("signals", F.col("signals").cast("array<string>")), "package", "signals", "lifecycle")


def package_values_on_latest(spark, sf_dir):
    v = order_versions(spark, sf_dir)
    return series.on_latest(v, "package", ORDER, series.cadence(v, "package", "released")).select("package", "seq", "is_current", "n_versions", "cadence_days")


def latest_rows(spark, sf_dir):
    return series.latest_marked(order_versions(spark, sf_dir), "package", "marker", "released", "seq").select("package", "seq", "released")


def latest_rows_ranked(spark, sf_dir):
    return series.latest_ranked(order_versions(spark, sf_dir), "package", "marker", "version", "seq").select("package", "seq", "version")


def max_version_rows(spark, sf_dir):
    return series.max_version(order_versions(spark, sf_dir).select("package", "version", "released"), "package", "version").select("package", "version")


def latest_event_of_user(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return series.keep_one(e, ["user_id"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_id", "event_type")


def current_detail(spark, sf_dir):
    v = order_versions(spark, sf_dir)
    current = series.keep_one(v, ["package"], [F.desc("released"), F.desc("seq")]).select("package", F.col("seq").alias("l_orderkey"))
    return table(spark, sf_dir, "lineitem").join(current, "l_orderkey").select("package", "l_orderkey", "l_linenumber", "l_partkey")


def churn_by_version(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    digest = F.sha2(F.col("seq").cast("string"), 256)
    v = order_versions(spark, sf_dir).withColumn("commit", F.substring(digest, 1, 40))
    keyed = li.select(F.col("l_orderkey").alias("seq"), F.col("l_returnflag").alias("file"), "l_quantity").join(v.select("seq", "package"), "seq")
    churn = keyed.select("package", F.substring(digest, 1, 12).alias("commit"), F.lit(None).alias("version"), "file", "l_quantity")
    own = series.churn_of_version(churn, v)
    return own.groupBy("package", "version", "file").agg(F.count("*").alias("n_changes"), F.sum("l_quantity").alias("added"))


def contributor_spans(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("package"), F.col("turn").cast("string").alias("version"), F.col("turn").alias("released"), F.col("role").alias("author_key"), "text")
    return authors.spans(c, "author_key", "package", "released", "version", ["text"]).withColumn("text", F.sha2("text", 256))


def contributor_spans_json(spark, sf_dir):
    """Authors as JSON text, written with stray blanks and capitals, parsed and keyed."""
    c = table(spark, sf_dir, "conversations")
    text = F.concat(F.lit('[{"given":" '), F.upper("role"), F.lit(' ","family":null},{"given":"Team","family":"'), F.col("conv_id") % 7, F.lit('"}]'))
    rows = c.select(F.col("conv_id").alias("package"), F.col("turn").cast("string").alias("version"), F.col("turn").alias("released"), text.alias("authors"))
    return authors.spans(authors.exploded(rows, "authors"), "author_key", "package", "released", "version", ["given"])


def authors_added_later(spark, sf_dir):
    return authors.added_later(table(spark, sf_dir, "conversations"), "role", "conv_id", "turn")


QUERIES = {
    "release_cadence_drift": (
        release_cadence_drift,
        _SETS + "SELECT package, count(*) AS n_versions, min(released) AS first_release, max(released) AS latest_release, median(gap) AS cadence_days, "
        "CAST(sum(CASE WHEN rn = 1 THEN 0 ELSE len(list_filter(deps, lambda e: NOT list_contains(deps_b, e))) + len(list_filter(deps_b, lambda e: NOT list_contains(deps, e))) END) AS BIGINT) AS dependency_drift FROM x GROUP BY 1",
    ),
    "bump_and_fidelity": (
        bump_and_fidelity,
        _SETS + "SELECT package, version, seq, bump, len(added) AS n_added, len(removed) AS n_removed, len(removed) > 0 AS is_breaking, "
        "CASE WHEN rn = 1 THEN NULL WHEN len(removed) > 0 THEN bump = 'major' WHEN len(added) > 0 THEN bump IN ('major', 'minor') ELSE true END AS bump_fidelity FROM x",
    ),
    "interface_diff": (interface_diff, _SETS + "SELECT seq, array_to_string(list_sort(added), ',') AS added, array_to_string(list_sort(removed), ',') AS removed FROM x"),
    "cold_removals": (
        cold_removals,
        _SETS + "SELECT package, CAST(sum(len(removed)) AS BIGINT) AS n_removed, CAST(sum(len(list_filter(removed, lambda e: NOT list_contains(signals_b, e)))) AS BIGINT) AS n_cold, "
        "sum(len(list_filter(removed, lambda e: NOT list_contains(signals_b, e))))::DOUBLE / nullif(sum(len(removed)), 0)::DOUBLE AS cold_removal_rate FROM x WHERE rn > 1 GROUP BY 1",
    ),
    "deprecation_maturity": (deprecation_maturity, _SETS + "SELECT package, max(CASE WHEN size > 400000 THEN 2 WHEN len(signals) > 0 THEN 1 ELSE 0 END) AS deprecation_maturity FROM x GROUP BY 1"),
    "package_values_on_latest": (
        package_values_on_latest,
        _SETS + ", c AS (SELECT package, count(*) AS n, median(gap) AS cad, max(rn) AS last FROM d GROUP BY 1) "
        "SELECT d.package, seq, rn = last AS is_current, CASE WHEN rn = last THEN n END AS n_versions, CASE WHEN rn = last THEN cad END AS cadence_days FROM d JOIN c USING (package)",
    ),
    "latest_rows": (latest_rows, _SETS + "SELECT package, seq, released FROM (SELECT *, row_number() OVER (PARTITION BY package ORDER BY marker IS NOT NULL DESC, released DESC, seq DESC) AS n FROM v) WHERE n = 1"),
    "latest_rows_ranked": (
        latest_rows_ranked,
        _SETS + "SELECT package, seq, version FROM (SELECT *, row_number() OVER (PARTITION BY package ORDER BY marker IS NOT NULL DESC, CASE WHEN marker IS NOT NULL THEN version END DESC NULLS LAST, seq DESC) AS n FROM v) WHERE n = 1",
    ),
    "max_version_rows": (max_version_rows, _SETS + "SELECT package, version FROM (SELECT *, row_number() OVER (PARTITION BY package ORDER BY y DESC, m DESC, p DESC) AS n FROM v) WHERE n = 1"),
    "latest_event_of_user": (latest_event_of_user, "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1"),
    "current_detail": (
        current_detail,
        _SETS + "SELECT package, l_orderkey, l_linenumber, l_partkey FROM lineitem JOIN (SELECT package, seq FROM (SELECT *, row_number() OVER (PARTITION BY package ORDER BY released DESC, seq DESC) AS n FROM v) WHERE n = 1) c ON l_orderkey = c.seq",
    ),
    "churn_by_version": (
        churn_by_version,
        _SETS + "SELECT package, version, l_returnflag AS file, count(*) AS n_changes, sum(l_quantity) AS added FROM lineitem JOIN v ON l_orderkey = v.seq GROUP BY 1, 2, 3",
    ),
    "contributor_spans": (
        contributor_spans,
        "SELECT role AS author_key, conv_id AS package, CAST(min(turn) AS VARCHAR) AS first_version, min(turn) AS first_seen, CAST(max(turn) AS VARCHAR) AS last_version, max(turn) AS last_seen, "
        "count(DISTINCT turn) AS n_versions, sha256(arg_max(text, turn)) AS text FROM conversations GROUP BY 1, 2",
    ),
    "contributor_spans_json": (
        contributor_spans_json,
        "WITH a AS (SELECT conv_id AS package, turn, lower(trim(role)) || ' ' AS author_key, ' ' || upper(role) || ' ' AS given FROM conversations "
        "UNION ALL SELECT conv_id, turn, 'team ' || (conv_id % 7), 'Team' FROM conversations) "
        "SELECT author_key, package, CAST(min(turn) AS VARCHAR) AS first_version, min(turn) AS first_seen, CAST(max(turn) AS VARCHAR) AS last_version, max(turn) AS last_seen, count(DISTINCT turn) AS n_versions, arg_max(given, turn) AS given FROM a GROUP BY 1, 2",
    ),
    "authors_added_later": (
        authors_added_later,
        "WITH f AS (SELECT conv_id, role, min(turn) AS t FROM conversations GROUP BY 1, 2) SELECT conv_id, count(*) FILTER (WHERE t > (SELECT min(turn) FROM conversations c WHERE c.conv_id = f.conv_id)) AS authors_added_later FROM f GROUP BY 1",
    ),
}

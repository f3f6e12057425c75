"""Queries of the bounded change report, with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronolake.operators import change_report, report
from chronolake.plans.tables import order_versions, table

CAP, BUDGETS = 40, (0, 10, 1000, 20_000)


def _inputs(spark, sf_dir):
    """Orders as versions; changed are the customers of 1998 and those without any order; the seed is who
    had ordered before 1994; urgent orders stand for datasets."""
    o = table(spark, sf_dir, "orders")
    keys = o.select(F.col("o_custkey").alias("package"), F.col("o_orderdate").cast("date").alias("day"), "o_orderpriority")
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("seq")).agg(F.count("*").alias("n"), F.count_if(F.col("l_returnflag") == "R").alias("removed"), F.count_if(F.col("l_returnflag") == "A").alias("added"))
    v = order_versions(spark, sf_dir).join(lines, "seq", "left").withColumn("marker", F.when(F.col("marker").isNotNull(), F.col("released")))
    summary = v.select(
        "package",
        "version",
        "seq",
        "marker",
        (F.col("size") / 7).alias("loc"),
        F.col("n").alias("n_exports"),
        F.when(F.col("seq") % 3 == 0, F.col("seq") % 9).alias("n_internal"),
        F.when(F.col("seq") % 4 > 0, F.col("added")).alias("api_added"),
        F.when(F.col("seq") % 4 > 0, F.col("removed")).alias("api_removed"),
        F.when(F.col("seq") % 2 == 0, F.lit(3)).alias("n_deps_direct"),
        F.when(F.col("seq") % 5 == 0, F.lit("R, base, other (>= 1.0)")).alias("raw_deps"),
        F.element_at(F.array(*(F.lit(b) for b in ("initial", "major", "minor", "patch"))), (F.col("seq") % 4 + 1).cast("int")).alias("bump"),
    )
    never = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("package")).join(keys, "package", "left_anti")
    changed = keys.filter("day >= date '1998-01-01'").select("package").unionByName(never).distinct()
    seed = keys.filter("day < date '1994-01-01'").select("package")
    return changed, summary, seed, keys.filter("o_orderpriority = '1-URGENT'").select("package")


def changed_rows(spark, sf_dir):
    return change_report.changed_rows(*_inputs(spark, sf_dir))


def bounded_changes(spark, sf_dir):
    """The table under 40 rows and each of four budgets, and under a count alone."""
    changed, summary, seed, data = _inputs(spark, sf_dir)
    lines, n = change_report.prepared(change_report.changed_rows(changed, summary, seed, data)), changed.count()
    out = None
    for cap, budget in [*((CAP, b) for b in BUDGETS), (1_000_000, 20_000), (CAP, None)]:
        one = change_report.bounded_table(lines, n, cap, budget).select(F.lit(cap).alias("cap"), F.lit(budget).cast("int").alias("budget"), F.row_number().over(change_report.Window.orderBy("line_no")).cast("long").alias("line"), "text")  # as many rows as fit
        out = one if out is None else out.unionByName(one)
    return out


def change_headline(spark, sf_dir):
    """New, updated and failed packages of the last batch."""
    changed, _, seed, _ = _inputs(spark, sf_dir)
    o = table(spark, sf_dir, "orders")
    n, done = table(spark, sf_dir, "customer").count(), o.select("o_custkey").distinct().count()
    batch = o.filter("o_orderdate >= timestamp '1998-01-01'").groupBy(F.col("o_custkey").alias("package")).agg((F.max("o_totalprice") > 300000).alias("ok"))
    return report.change_summary(changed, seed, n, done, batch)


def change_report_lines(spark, sf_dir):
    """Headline, table and counts by status, whole, in each of four budgets."""
    changed, summary, seed, data = _inputs(spark, sf_dir)
    lines, n = change_report.prepared(change_report.changed_rows(changed, summary, seed, data)), changed.count()
    top = change_report.headline(change_headline(spark, sf_dir))
    by = table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    foot = by.select(F.ascii("o_orderstatus").cast("long").alias("line_no"), F.concat(F.lit("- "), "o_orderstatus", F.lit(" "), change_report.number(F.col("n"))).alias("text"))
    out = None
    for budget in BUDGETS:
        one = change_report.whole_report(top, lines, n, foot, CAP, budget).select(F.lit(budget).alias("budget"), F.row_number().over(change_report.Window.orderBy("section", "line_no")).cast("long").alias("line"), "text")  # as many rows as fit
        out = one if out is None else out.unionByName(one)
    return out


def _n(c: str) -> str:
    return f"coalesce(format('{{:,}}', CAST(round_even({c}, 0) AS BIGINT)), 'n/a')"


_ROWS = f"""
WITH o AS (SELECT o_custkey AS package, o_orderkey AS seq, CAST(o_orderdate AS DATE) AS day, concat_ws('.', year(o_orderdate), month(o_orderdate), o_orderkey % 100) AS version, o_totalprice, o_orderstatus, o_orderpriority FROM orders),
l AS (SELECT l_orderkey AS seq, count(*) AS n, count(*) FILTER (WHERE l_returnflag = 'R') AS removed, count(*) FILTER (WHERE l_returnflag = 'A') AS added FROM lineitem GROUP BY 1),
ch AS (SELECT package FROM o WHERE day >= DATE '1998-01-01' UNION SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT package FROM o)),
se AS (SELECT DISTINCT package FROM o WHERE day < DATE '1994-01-01'),
la AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY package ORDER BY o_orderstatus = 'F' DESC, CASE WHEN o_orderstatus = 'F' THEN version END DESC NULLS LAST, seq DESC) AS k FROM o WHERE package IN (SELECT package FROM ch)) WHERE k = 1),
rw AS (SELECT package, version || coalesce(' (' || CASE WHEN package NOT IN (SELECT package FROM se) THEN 'new' ELSE nullif(['initial', 'major', 'minor', 'patch'][CAST(seq % 4 + 1 AS INTEGER)], 'initial') END || ')', '') AS version, o_totalprice / 7 AS loc,
  CASE WHEN n IS NULL AND seq % 3 > 0 THEN NULL ELSE coalesce(n, 0) + CASE WHEN seq % 3 = 0 THEN seq % 9 ELSE 0 END END AS functions, n AS exports, CASE WHEN seq % 4 > 0 THEN added END AS api_added, CASE WHEN seq % 4 > 0 THEN removed END AS api_removed,
  CASE WHEN seq % 2 = 0 THEN 3 WHEN seq % 5 = 0 THEN 2 END AS deps, (SELECT count(*) FROM o u WHERE u.package = la.package AND u.o_orderpriority = '1-URGENT') AS datasets FROM la LEFT JOIN l USING (seq))"""
_MOVED = f"CASE WHEN api_added IS NULL AND api_removed IS NULL THEN 'n/a' WHEN coalesce(api_added, 0) = 0 AND coalesce(api_removed, 0) = 0 THEN '-' ELSE concat_ws('/', CASE WHEN api_added > 0 THEN '+' || {_n('api_added')} END, CASE WHEN api_removed > 0 THEN '-' || {_n('api_removed')} END) END"
_TEXT = _ROWS + (
    f", tx AS (SELECT *, '| ' || concat_ws(' | ', package, version, {_n('loc')}, {_n('functions')}, {_n('exports')}, {_MOVED}, {_n('deps')}, {_n('datasets')}) || ' |' AS text, "
    "row_number() OVER (ORDER BY coalesce(api_removed, 0) > 0 DESC, coalesce(api_removed, 0) + coalesce(api_added, 0) DESC, loc DESC, package) AS nth FROM rw), "
    "ru AS (SELECT *, sum(strlen(text) + 1) OVER (ORDER BY nth) AS used FROM tx), "
    "ct AS (SELECT (SELECT count(*) FROM rw) AS n, (SELECT count(*) FROM ch) AS c, (SELECT bool_or(api_added IS NOT NULL OR api_removed IS NOT NULL) FROM rw) AS known), "
    f"fx AS (SELECT n, c, list_concat(['{change_report.TITLE}', ''], CASE WHEN n > 1 THEN [CASE WHEN known THEN '{change_report.BY_API}' ELSE '{change_report.BY_SIZE}' END, ''] ELSE [] END, ['{change_report.HEADER[0]}', '{change_report.HEADER[1]}']) AS head, "
    "CASE WHEN c > n THEN ['', format('{:,}', c - n) || ' of ' || format('{:,}', c) || ' changed packages have no row here.'] ELSE [] END AS miss, '| and ' || format('{:,}', n) || ' more | | | | | | | |' AS widest FROM ct)"
)


def _table_sql(cap: str, room: str, of: str) -> str:
    """Lines as a list, of a relation that has cap and budget."""
    body = f"(SELECT list(text ORDER BY nth) FROM ru WHERE nth <= {cap} AND (({room}) IS NULL OR used <= {room}))"
    return (
        f"SELECT *, list_concat(head, body, CASE WHEN n > len(body) THEN ['| and ' || format('{{:,}}', n - len(body)) || ' more | | | | | | | |'] ELSE [] END, miss) AS lines "
        f"FROM (SELECT *, coalesce({body}, []) AS body FROM {of})"
    )


_BYTES = "coalesce(list_sum(list_transform({}, lambda x: strlen(x) + 1)), 0)"
_ROOM = f"budget - {_BYTES.format('head')} - {_BYTES.format('list_concat([widest], miss)')}"
_HEAD = (
    "u AS (SELECT (SELECT count(*) FROM customer) AS n, (SELECT count(DISTINCT o_custkey) FROM orders) AS a), ba AS (SELECT package, max(o_totalprice) > 300000 AS ok FROM o WHERE day >= DATE '1998-01-01' GROUP BY 1), "
    "hd AS (SELECT (SELECT count(*) FROM ch WHERE package NOT IN (SELECT package FROM se)) AS n_new, (SELECT count(*) FROM ch WHERE package IN (SELECT package FROM se)) AS n_updated, CAST(floor(100.0 * a / n) AS BIGINT) AS percent, greatest(n - a, 0) AS remaining, "
    "(SELECT count(*) FROM ba WHERE NOT ok) AS n_failed, (SELECT count(*) FROM ba) AS n_batch FROM u)"
)
_WHOLE = _TEXT + (
    ", " + _HEAD + f", tp AS (SELECT list_concat([{_n('n_new')} || ' new, ' || {_n('n_updated')} || ' updated, ' || {_n('percent')} || ' % done, ' || {_n('remaining')} || ' to do.'], CASE WHEN n_failed > 0 THEN [{_n('n_failed')} || ' of the ' || {_n('n_batch')} || ' packages of the last batch failed.'] ELSE [] END) AS top FROM hd), "
    f"ft AS (SELECT list('- ' || o_orderstatus || ' ' || {_n('n')} ORDER BY o_orderstatus) AS foot FROM (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1)), "
    f"bg AS (SELECT b AS full_budget, b - {_BYTES.format('top')} - {_BYTES.format('foot')} - 2 AS budget, top, foot, fx.* FROM fx, tp, ft, (VALUES {', '.join(f'({b})' for b in BUDGETS)}) AS v(b)), "
    f"tb AS ({_table_sql(str(CAP), _ROOM, 'bg')}), al AS (SELECT full_budget AS budget, list_concat(top, [''], lines, [''], foot) AS every FROM tb), "
    "ec AS (SELECT budget, unnest(every) AS text, generate_subscripts(every, 1) AS line FROM al), es AS (SELECT *, sum(strlen(text) + 1) OVER (PARTITION BY budget ORDER BY line) AS used, sum(strlen(text) + 1) OVER (PARTITION BY budget) AS total FROM ec), "
    f"kp AS (SELECT budget, line, text FROM es WHERE total <= budget OR used <= budget - {len(change_report.CUT) + 1}), "
    f"mk AS (SELECT budget, coalesce((SELECT max(line) FROM kp WHERE kp.budget = es.budget), 0) + 1 AS line, CASE WHEN budget >= {len(change_report.CUT) + 1} THEN '{change_report.CUT}' ELSE substr('{change_report.CUT}', 1, greatest(budget - 1, 0)) END AS text FROM (SELECT DISTINCT budget FROM es WHERE total > budget) es)"
    " SELECT * FROM kp UNION ALL SELECT * FROM mk"
)

QUERIES = {
    "changed_rows": (changed_rows, _ROWS + " SELECT * FROM rw"),
    "bounded_changes": (
        bounded_changes,
        _TEXT
        + f", bg AS (SELECT cap, budget, fx.* FROM fx, (VALUES {', '.join(f'({CAP}, {b})' for b in BUDGETS)}, (1000000, 20000), ({CAP}, NULL)) AS v(cap, budget)), tb AS ({_table_sql('cap', _ROOM, 'bg')}) "
        + "SELECT cap, budget, generate_subscripts(lines, 1) AS line, unnest(lines) AS text FROM tb",
    ),
    "change_headline": (change_headline, _ROWS + ", " + _HEAD + " SELECT * FROM hd"),
    "change_report_lines": (change_report_lines, _WHOLE),
}

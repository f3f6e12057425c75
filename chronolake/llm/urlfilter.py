"""URL filters: rules by host and path, and for what no rule fits, trust and distrust over host links.

A rule (host, path, action) fits its host and all subdomains where the url's path starts with the rule's;
the longest wins (of equally long ones the first in order, block before allow). Rules are a table of any
size: they meet the distinct hosts, by those host suffixes that have as many labels as some rule's host.

The share of a host's pages that a rule allows is its seed of trust, the share that a rule blocks its seed
of distrust. Trust runs along links between hosts, distrust against them, both as personalised PageRank:
rank = seed + DAMPING x (what comes in over links), each host's rank divided among its links by how many of
its pages have them. (Hosts without links pass nothing on; that only scales a personalised rank as a
whole, so ranks are left unscaled: 1 is what a wholly trusted, or blocked, host has of itself.) A host is
blocked where its distrust exceeds its trust by ``LEAST`` or more. Ranks are whole numbers of 1 / ``UNIT``,
whose sums come out the same in any order of tasks.

A host's pages, and a host's links, may be a large part of all. Hosts with more than 1 / 2^14 of the rows
are fewer than 2^14, so they are sent to every task, and only rows of the others are shuffled by host. Pages
are shuffled as ids, hosts and paths, never with their html. Every round is written, so that an executor
may be lost.

Nulls and ties: a null url, or one without ``://``, has an empty host and path, no rule, and as nothing is
known of it the verdict allow. A null html has no links. Links to the own host count for nothing. Repeated
rows and repeated or null page_ids are judged each, texts of any length are read whole, extra columns
are ignored. Rules with a null host or action don't fit; a null path is empty. Empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronolake.llm import common

UNIT, DAMPING, ROUNDS, LEAST, SHARE = 1 << 30, 0.85, 20, 0.5, 1 << 14
RULES = "host string, path string, action string"
#: The rules of the query.
GIVEN = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
LINK = r"""(?i)\bhref\s*+=\s*+["']?+\s*+(?:[a-z][a-z0-9+.-]*+:)?+//([^/?#"'\s<>]++)"""


def lower(c: Column) -> Column:
    """A-Z only."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def with_host(pages: DataFrame) -> DataFrame:
    """Adds host and path."""
    url = F.coalesce("url", F.lit(""))
    part = lambda i: F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*+)([^?#]*+)", i)
    return pages.withColumn("host", lower(part(1))).withColumn("path", part(2))


def frequent(rows: DataFrame, by: list[str], least: int = 4096) -> DataFrame:
    """Keys (a written table with n, their number of rows) that have more than 1 / ``SHARE`` of all rows,
    and more than ``least``: fewer than ``SHARE``."""
    total = rows.agg(F.sum("n")).first()[0] or 0
    return rows.filter(F.col("n") > max(least, total // SHARE)).select(*by)


def with_facts(rows: DataFrame, facts: DataFrame, by: list[str], hot: DataFrame) -> DataFrame:
    """Left join of ``facts`` (a row for each key); those of the keys in ``hot`` (bounded) are sent to the rows."""
    few = F.broadcast(hot)
    sent = F.broadcast(facts.join(few, by, "left_semi"))
    near = rows.join(few, by, "left_semi").join(sent, by, "left")
    return near.unionByName(rows.join(few, by, "left_anti").join(facts.join(few, by, "left_anti"), by, "left"))


def rules_of_hosts(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """host, rules: those that fit the host, longest first, as (path, name, action)."""
    r = rules.filter("host is not null and action is not null").select(lower(F.col("host")).alias("suffix"), F.coalesce("path", F.lit("")).alias("path"), "action").distinct()
    labels = [x.k for x in r.select(F.size(F.split("suffix", r"\.")).alias("k")).distinct().orderBy("k").limit(256).collect()]  # a host name has 127 labels at most
    cut = F.array(*(F.when(F.size(F.split("host", r"\.")) >= k, F.substring_index("host", ".", -k)) for k in labels)) if labels else F.array().cast("array<string>")
    each = hosts.select("host", F.explode(F.array_compact(cut)).alias("suffix")).join(r, "suffix")
    name = F.concat("suffix", "path")
    fit = F.struct((-F.length(name)).alias("short"), F.when(F.col("action") == "block", 0).otherwise(1).alias("kind"), name.alias("name"), "path", "action")
    return each.groupBy("host").agg(F.sort_array(F.collect_list(fit)).alias("rules"))


def ruled(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """page_id, host, path, rule and verdict (both null where none fits)."""
    at = with_host(pages.select("page_id", "url")).select("page_id", "host", "path")
    hosts = common.staged(at.groupBy("host").agg(F.count("*").alias("n")), "urls-hosts")
    found = common.staged(rules_of_hosts(hosts, rules), "urls-rules")
    df = with_facts(at, found, ["host"], frequent(hosts, ["host"]))
    # a path is looked for among the host's rules only where there are any
    best = F.expr("get(filter(rules, r -> startswith(path, r.path)), 0)")
    return df.withColumn("best", best).select("page_id", "host", "path", F.col("best.name").alias("rule"), F.col("best.action").alias("verdict"))


def host_links(pages: DataFrame) -> DataFrame:
    """host, to, n: on how many pages of the host there is a link to another one."""
    links = with_host(pages.select("url", "html")).select("host", F.array_distinct(F.transform(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)), lower)).alias("links"))
    each = links.filter("host <> '' and size(links) > 0").select("host", F.explode("links").alias("to"))
    return each.filter("to <> host").groupBy("host", "to").agg(F.count("*").alias("n"))


def propagated(seeds: DataFrame, links: DataFrame, rounds: int = ROUNDS, damping: float = DAMPING) -> DataFrame:
    """kind, host, rank (in 1 / UNIT) from seeds (kind, host, rank) over links (host, to, n): trust along
    them, distrust against them."""
    both = links.select(F.lit("trust").alias("kind"), "host", "to", "n").unionByName(links.select(F.lit("distrust").alias("kind"), F.col("to").alias("host"), F.col("host").alias("to"), "n"))
    both = common.staged(both, "urls-links")
    out = common.staged(both.groupBy("kind", "host").agg(F.sum("n").alias("total"), F.count("*").alias("n")), "urls-totals")
    by = ["kind", "host"]
    hot = frequent(out, by)
    edges = with_facts(both, out.select(*by, "total"), by, hot).select(*by, "to", (damping * F.col("n") / F.col("total")).alias("share"))
    edges, rank = common.staged(edges, "urls-edges"), common.staged(seeds, "urls-rank")
    seeds = rank
    if edges.isEmpty():
        return rank
    for _ in range(rounds):
        few = F.broadcast(hot)
        near = edges.join(F.broadcast(rank.join(few, by, "left_semi")), by)
        far = edges.join(few, by, "left_anti").join(rank.join(few, by, "left_anti"), by)
        sent = near.unionByName(far).select("kind", F.col("to").alias("host"), F.floor(F.col("rank") * F.col("share")).alias("rank"))
        rank = common.staged(seeds.unionByName(sent).groupBy(*by).agg(F.sum("rank").alias("rank")), "urls-rank")
    return rank


def host_verdicts(judged: DataFrame, links: DataFrame, rounds: int = ROUNDS, damping: float = DAMPING, least: float = LEAST) -> DataFrame:
    """host, n (its pages), trust, distrust, blocked: for every host with pages."""
    n = judged.filter("host <> ''").groupBy("host").agg(F.count("*").alias("n"), F.count_if(F.col("verdict") == "allow").alias("trust"), F.count_if(F.col("verdict") == "block").alias("distrust"))
    n = common.staged(n, "urls-seeds")
    seed = lambda kind: n.filter(F.col(kind) > 0).select(F.lit(kind).alias("kind"), "host", F.floor(F.col(kind) * float(UNIT) / F.col("n")).alias("rank"))
    rank = propagated(seed("trust").unionByName(seed("distrust")), links, rounds, damping)
    of = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("rank"))), F.lit(0)).alias(kind)
    sums = n.select("host", "n", F.lit(None).cast("string").alias("kind"), F.lit(0).cast("long").alias("rank")).unionByName(rank.withColumn("n", F.lit(None).cast("long")))
    found = sums.groupBy("host").agg(F.max("n").alias("n"), of("trust"), of("distrust")).filter("n is not null")
    return found.withColumn("blocked", F.col("distrust") - F.col("trust") >= int(least * UNIT))


def judge(pages: DataFrame, rules: DataFrame, rounds: int = ROUNDS, damping: float = DAMPING, least: float = LEAST) -> DataFrame:
    """page_id, host, path, rule, verdict of every page (page_id, url, html)."""
    judged = common.staged(ruled(pages, rules), "urls-judged")
    hosts = common.staged(host_verdicts(judged, host_links(pages), rounds, damping, least), "urls-verdicts")
    open_ = judged.filter("verdict is null").drop("verdict")
    told = with_facts(open_, hosts.select("host", "blocked"), ["host"], frequent(hosts, ["host"]))
    told = told.withColumn("verdict", F.when(F.coalesce("blocked", F.lit(False)), "block").otherwise("allow"))
    return judged.filter("verdict is not null").unionByName(told.drop("blocked")).select("page_id", "host", "path", "rule", "verdict")


def op11_url_filter(spark, sf_dir: str) -> DataFrame:
    return judge(common.table(spark, sf_dir, "pages"), spark.createDataFrame(GIVEN, RULES))


def _oracle() -> str:
    """DuckDB SQL of the same rounds over the same whole numbers."""
    longest = sorted(GIVEN, key=lambda r: -len(r[0] + r[1]))
    fits = " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h}{p} {a}'" for h, p, a in longest)
    ranks = "".join(
        f", r{i + 1} AS MATERIALIZED (SELECT kind, host, CAST(sum(rank) AS BIGINT) AS rank FROM (SELECT * FROM s UNION ALL SELECT r.kind, e.to_host, CAST(floor(r.rank * e.share) AS BIGINT) FROM r{i} r JOIN e ON e.kind = r.kind AND e.host = r.host) GROUP BY 1, 2)"
        for i in range(ROUNDS)
    )
    return rf"""
WITH u AS (SELECT page_id, html, regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', ['host', 'path']) AS p FROM pages),
h AS (SELECT page_id, html, translate(p.host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, p.path AS path FROM u),
j AS (SELECT page_id, host, path, CASE {fits} END AS fit FROM h),
k AS (SELECT page_id, host, path, string_split(fit, ' ')[1] AS rule, string_split(fit, ' ')[2] AS action FROM j),
l AS (SELECT DISTINCT page_id, host, unnest(regexp_extract_all(html, '(?i)\bhref\s*=\s*["'']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"''\s<>]+)', 1)) AS to_host FROM h),
g AS (SELECT host, to_host, count(*) AS n FROM l WHERE host <> '' AND host <> to_host GROUP BY 1, 2),
b AS (SELECT 'trust' AS kind, host, to_host, n FROM g UNION ALL SELECT 'distrust', to_host, host, n FROM g),
e AS (SELECT kind, host, to_host, {DAMPING}::DOUBLE * n / sum(n) OVER (PARTITION BY kind, host) AS share FROM b),
c AS (SELECT host, count(*) AS n, count(*) FILTER (WHERE action = 'allow') AS trust, count(*) FILTER (WHERE action = 'block') AS distrust FROM k WHERE host <> '' GROUP BY 1),
s AS (SELECT 'trust' AS kind, host, CAST(floor(trust * {UNIT}::DOUBLE / n) AS BIGINT) AS rank FROM c WHERE trust > 0 UNION ALL SELECT 'distrust', host, CAST(floor(distrust * {UNIT}::DOUBLE / n) AS BIGINT) FROM c WHERE distrust > 0),
r0 AS (SELECT * FROM s){ranks},
v AS (SELECT host, coalesce(sum(rank) FILTER (WHERE kind = 'distrust'), 0) - coalesce(sum(rank) FILTER (WHERE kind = 'trust'), 0) >= {int(LEAST * UNIT)} AS blocked FROM r{ROUNDS} GROUP BY 1)
SELECT page_id, k.host, path, rule, coalesce(action, CASE WHEN blocked THEN 'block' ELSE 'allow' END) AS verdict FROM k LEFT JOIN v ON v.host = k.host
"""


OP11_SQL = _oracle()

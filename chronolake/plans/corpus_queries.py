"""Queries over a corpus of texts, with their oracles. The tables hold no R sources, so the rules here
are those whose patterns occur; the rest of the rules run on the fixtures of the tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronolake.functions import parse, rules
from chronolake.functions.text import blank_to_null, json_set, line_count, lines
from chronolake.operators import snapshot
from chronolake.plans.tables import table
from chronolake.sources import archive


def _documents(spark, sf_dir):
    """Documents as files: a source is a package, a language its version."""
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("source").alias("package"), F.col("lang").alias("version"), F.concat(F.lit("docs/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"), F.col("text").alias("content"))


def _pages(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    return p.select(F.regexp_extract("url", "^https?://([^/]+)", 1).alias("package"), (F.col("page_id") % 5).cast("string").alias("version"), F.concat(F.lit("R/"), F.col("page_id").cast("string"), F.lit(".R")).alias("path"), F.col("html").alias("content"))


def size_by_class(spark, sf_dir):
    return snapshot.size_by_class(table(spark, sf_dir, "documents"), ["lang"], "text")


def structure_of_pages(spark, sf_dir):
    return snapshot.structure(_pages(spark, sf_dir)).select("package", "version", "n_files", "loc_r", "loc_total", "compiled_share")


LICENSE_RULES = [
    rules.Rule("license_score", "", r"(?i)licen[cs]e", weight=2),
    rules.Rule("license_score", "", r"(?i)released under", weight=3),
    rules.Rule("mail_lines", "", "[a-z0-9.]+@[a-z0-9.]+", unit="lines"),
    rules.Rule("shouting_files", "", "[A-Z]{4,}!!", unit="files"),
    rules.Rule("assigned_secrets", "", "(password=|token = |AKIA)"),
    rules.Rule("digit_lines_without_mail", "", "[0-9]", unit="lines", unless="@"),
]


def pattern_score(spark, sf_dir):
    return rules.apply(_documents(spark, sf_dir), LICENSE_RULES)


def line_density(spark, sf_dir):
    """Lines with a script or style mark, per 1000 lines."""
    p = _pages(spark, sf_dir)
    marked = rules.apply(p, [rules.Rule("n", "", "<(script|style)", unit="lines")])
    loc = p.groupBy(*rules.KEYS).agg(F.sum(line_count("content")).alias("loc"))
    return marked.join(loc, rules.KEYS).select(*rules.KEYS, (F.col("n") * 1000 / F.col("loc")).alias("density"))


def secret_count(spark, sf_dir):
    return rules.apply(_documents(spark, sf_dir), snapshot.SECRETS)


def unsafe_pages(spark, sf_dir):
    return snapshot.rule_metrics(_pages(spark, sf_dir))


def prose_length(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", snapshot.prose_words(F.col("text")).cast("bigint").alias("n_words"))


def license_tokens(spark, sf_dir):
    """License lines of documents as fields: tokens and whether all of them are known."""
    d = table(spark, sf_dir, "documents").withColumn("l", F.explode(lines("text")))
    found = F.regexp_extract("l", r"(?:under the |under )([A-Z][A-Za-z0-9 ,.-]*?)\.?$", 1)
    d = d.select("doc_id", F.regexp_replace(found, " License$", "").alias("f")).filter("f <> ''").distinct()
    tokens = snapshot.license_tokens(F.col("f"))
    return d.select("doc_id", F.array_join(tokens, ";").alias("tokens"), snapshot.all_in(tokens, snapshot.LICENSES_KNOWN).alias("known"))


def file_extensions(spark, sf_dir):
    urls = table(spark, sf_dir, "pages").select(F.regexp_extract("url", r"\.([a-z0-9]+)$", 1).alias("ext"))
    return urls.groupBy("ext").agg(F.count("*").alias("n"))


def change_log_of_lines(spark, sf_dir):
    """Documents as logs: the line that begins a document is the header of those after it."""
    d = table(spark, sf_dir, "documents").filter(F.instr("text", "\n") > 0).select(F.col("doc_id").alias("package"), F.posexplode(lines("text")).alias("line_no", "l"))
    sha = F.concat(F.lit("__C__"), F.col("package").cast("string"), F.lit("\t2020-01-01\tversion "), (F.col("package") % 9).cast("string"), F.lit("."), (F.col("package") % 7).cast("string"))
    body = F.concat_ws("\t", F.length("l").cast("string"), F.when(F.col("line_no") % 2 == 0, "-").otherwise("1"), F.concat(F.lit("{a => b}//"), F.col("line_no").cast("string")))
    log = d.select("package", "line_no", F.when(F.col("line_no") == 0, sha).otherwise(body).alias("line"))
    return archive.change_log(log)


def analyzer_records(spark, sf_dir):
    """Events as tagged records: the first purchase of a user is its summary."""
    e = table(spark, sf_dir, "events")
    line = F.to_json(F.struct(F.when(F.col("event_type") == "purchase", "summary").otherwise("function").alias("rec"), F.col("event_id").alias("name"), F.col("value").alias("v")))
    lines_ = e.select("user_id", F.col("event_id").alias("line_no"), line.alias("line"))
    got = archive.analyzer_records(lines_, {"summary": "name bigint, v double", "function": "name bigint, v double"}, ["user_id"])
    return got["summary"].withColumn("rec", F.lit("summary")).unionByName(got["function"].withColumn("rec", F.lit("function"))).select("user_id", "rec", "name", "v")


def open_records(spark, sf_dir):
    """The JSON of events with its keys and kinds as found."""
    from pyspark.sql.types import StructType

    e = table(spark, sf_dir, "events").select(F.col("props").alias("line"))
    return archive.open_records(e, StructType.fromDDL("absent string"))


def version_tags(spark, sf_dir):
    """Orders as tags: a date is a commit, the month a version."""
    o = table(spark, sf_dir, "orders")
    t = o.select(F.col("o_custkey").alias("package"), F.concat(F.when(F.col("o_orderkey") % 2 == 0, "R-").otherwise(""), F.date_format("o_orderdate", "yyyy.MM")).alias("tag"), F.when(F.col("o_orderkey") % 11 > 0, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date"), F.col("o_orderdate").cast("date").cast("string").alias("commit"), F.col("o_orderkey").alias("seq"))
    return archive.version_tags(t).select("package", "version", "date", "commit")


def json_sets(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    text = F.when(F.col("event_id") % 5 == 0, "{bad").when(F.col("event_id") % 7 == 0, None).otherwise(F.concat(F.lit('["'), "event_type", F.lit('","x","'), "event_type", F.lit('"]')))
    return e.select("event_id", F.array_join(json_set(text), ",").alias("items"), blank_to_null(F.when(F.col("event_id") % 3 == 0, " ").otherwise(F.col("event_type"))).alias("kind"))


def fields_of_documents(spark, sf_dir):
    """Documents with a field line in front, parsed back."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("Lang: "), "lang", F.lit("\nSource: "), "source", F.lit("\n  more\nLang: "), "lang", F.lit("2\n")).alias("content"))
    return parse.fields(d, ["doc_id"])


_D = "WITH f AS (SELECT source AS package, lang AS version, text AS content FROM documents), l AS (SELECT package, version, unnest(string_split(content, chr(10))) AS l FROM f) "
_P = "WITH p AS (SELECT regexp_extract(url, '^https?://([^/]+)', 1) AS package, CAST(page_id % 5 AS VARCHAR) AS version, html FROM pages), loc AS (SELECT *, CASE WHEN html = '' THEN 0 ELSE len(string_split(html, chr(10))) - CASE WHEN html LIKE '%' || chr(10) THEN 1 ELSE 0 END END AS n FROM p) "

_UNSAFE = _P + r""", b AS (SELECT package, version, l, regexp_replace(l, '#.*$', '') AS b FROM (SELECT package, version, unnest(string_split(html, chr(10))) AS l FROM p)),
k AS (SELECT package, version,
  count(*) FILTER (WHERE b LIKE '%<<-%') + count(*) FILTER (WHERE regexp_matches(b, '\bassign\s*\([^)]*(?:\.GlobalEnv|globalenv\s*\(|baseenv\s*\()'))
  + count(*) FILTER (WHERE regexp_matches(b, '\boptions\s*\([^)]*=')) + count(*) FILTER (WHERE regexp_matches(b, '\bSys\.setenv\s*\(')) AS s,
  count(*) FILTER (WHERE regexp_matches(b, '(^|[^A-Za-z0-9_.])[TF]($|[^A-Za-z0-9_.=])')) + count(*) FILTER (WHERE regexp_matches(b, '\b1:(?:length|nrow|ncol)\s*\('))
  + count(*) FILTER (WHERE regexp_matches(b, '^[ \t]{2,}.*\b(?:require|library)\s*\(')) + count(*) FILTER (WHERE regexp_matches(b, '\.Internal\s*\(')) AS i,
  count(*) FILTER (WHERE regexp_matches(b, '^\s*browser\s*\(\s*\)')) + count(*) FILTER (WHERE regexp_matches(b, '^\s*(?:print|cat)\s*\(') AND NOT regexp_matches(b, '\b(?:message|warning|stop)\s*\(')) AS g,
  2 * count(*) FILTER (WHERE regexp_matches(l, 'Sys\.setenv\s*\(') AND regexp_matches(regexp_replace(regexp_replace(l, '''[^'']*''', '''''', 'g'), '"[^"]*"', '""', 'g'), '=\s*[A-Za-z_.]')) AS e
  FROM b GROUP BY 1, 2),
f AS (SELECT package, version, sum(n) AS loc,
  sum(3 * len(regexp_extract_all(html, 'eval\s*\(\s*parse\s*\(\s*text\s*=')) + 2 * len(regexp_extract_all(html, 'system\s*\(\s*paste\s*\(')) + 2 * len(regexp_extract_all(html, 'system2\s*\([^\n]*paste\s*\('))
    + CASE WHEN regexp_matches(html, '\.on(?:Load|Attach)\s*<-\s*function') THEN 2 * len(regexp_extract_all(html, 'download\.file\s*\(|\burl\s*\(|\bcurl\s*\(')) ELSE 0 END) AS u,
  sum(CASE WHEN strlen(html) <= 1000000 THEN len(regexp_extract_all(html, 'AKIA[0-9A-Z]{16}')) + len(regexp_extract_all(html, 'gh[pous]_[A-Za-z0-9_]{36,}|github_pat_[A-Za-z0-9_]{36,}'))
    + len(regexp_extract_all(html, '(?i)(?:api[_-]?key|api[_-]?secret|secret[_-]?key|access[_-]?token)\s*[=:]\s*["''][A-Za-z0-9+/=_\-]{16,}["'']'))
    + len(regexp_extract_all(html, '(?i)(?:password|passwd|api_?key|auth_?token|secret)\s*=\s*["''][A-Za-z0-9+/]{40,}={0,2}["'']')) ELSE 0 END) AS secrets
  FROM loc GROUP BY 1, 2)
SELECT package, version, CAST(u + e AS BIGINT) AS unsafe_pattern_score, CAST(secrets AS BIGINT) AS secret_pattern_count, s * 1000.0::DOUBLE / loc AS global_state_write_density,
  i * 1000.0::DOUBLE / loc AS deprecated_idiom_density, g * 1000.0::DOUBLE / loc AS debug_artifact_density FROM f JOIN k USING (package, version)
"""

QUERIES = {
    "size_by_class": (
        size_by_class,
        "SELECT lang, count(*) AS n_files, CAST(sum(CASE WHEN text = '' THEN 0 ELSE len(string_split(text, chr(10))) - CASE WHEN text LIKE '%' || chr(10) THEN 1 ELSE 0 END END) AS BIGINT) AS n_lines, CAST(sum(strlen(text)) AS BIGINT) AS n_bytes FROM documents GROUP BY 1",
    ),
    "structure_of_pages": (structure_of_pages, _P + "SELECT package, version, count(*) AS n_files, CAST(sum(n) AS BIGINT) AS loc_r, CAST(sum(n) AS BIGINT) AS loc_total, 0.0::DOUBLE AS compiled_share FROM loc GROUP BY 1, 2"),
    "pattern_score": (
        pattern_score,
        _D + ", a AS (SELECT package, version, sum(2 * len(regexp_extract_all(content, '(?i)licen[cs]e')) + 3 * len(regexp_extract_all(content, '(?i)released under'))) AS license_score, "
        "count(*) FILTER (WHERE regexp_matches(content, '[A-Z]{4,}!!')) AS shouting_files, sum(len(regexp_extract_all(content, '(password=|token = |AKIA)'))) AS assigned_secrets FROM f GROUP BY 1, 2), "
        "b AS (SELECT package, version, count(*) FILTER (WHERE regexp_matches(l, '[a-z0-9.]+@[a-z0-9.]+')) AS mail_lines, count(*) FILTER (WHERE regexp_matches(l, '[0-9]') AND NOT l LIKE '%@%') AS digit_lines_without_mail FROM l GROUP BY 1, 2) "
        "SELECT package, version, CAST(license_score AS BIGINT) AS license_score, mail_lines, shouting_files, CAST(assigned_secrets AS BIGINT) AS assigned_secrets, digit_lines_without_mail FROM a JOIN b USING (package, version)",
    ),
    "line_density": (
        line_density,
        _P + ", m AS (SELECT package, version, count(*) FILTER (WHERE regexp_matches(l, '<(script|style)')) AS k FROM (SELECT package, version, unnest(string_split(html, chr(10))) AS l FROM p) GROUP BY 1, 2), t AS (SELECT package, version, sum(n) AS n FROM loc GROUP BY 1, 2) SELECT package, version, k * 1000.0::DOUBLE / n AS density FROM m JOIN t USING (package, version)",
    ),
    "secret_count": (
        secret_count,
        _D + "SELECT package, version, CAST(sum(CASE WHEN strlen(content) <= 1000000 THEN len(regexp_extract_all(content, 'AKIA[0-9A-Z]{16}')) + len(regexp_extract_all(content, 'gh[pous]_[A-Za-z0-9_]{36,}|github_pat_[A-Za-z0-9_]{36,}')) "
        "+ len(regexp_extract_all(content, '(?i)(api[_-]?key|api[_-]?secret|secret[_-]?key|access[_-]?token)\\s*[=:]\\s*[\"''][A-Za-z0-9+/=_\\-]{16,}[\"'']')) + len(regexp_extract_all(content, '(?i)(password|passwd|api_?key|auth_?token|secret)\\s*=\\s*[\"''][A-Za-z0-9+/]{40,}={0,2}[\"'']')) ELSE 0 END) AS BIGINT) AS secret_pattern_count FROM f GROUP BY 1, 2",
    ),
    "unsafe_pages": (unsafe_pages, _UNSAFE),
    "prose_length": (prose_length, "SELECT doc_id, len(list_filter(string_split_regex(trim(text), '\\s+'), lambda x: x <> '')) AS n_words FROM documents"),
    "license_tokens": (
        license_tokens,
        "WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM documents), f AS (SELECT DISTINCT doc_id, regexp_replace(regexp_extract(l, '(?:under the |under )([A-Z][A-Za-z0-9 ,.-]*?)\\.?$', 1), ' License$', '') AS f FROM l) "
        "SELECT doc_id, f AS tokens, f IN ('MIT', 'GPL-2', 'GPL-3', 'Apache License 2.0', 'CC BY 4.0') AS known FROM f WHERE f <> ''",
    ),
    "file_extensions": (file_extensions, "SELECT regexp_extract(url, '\\.([a-z0-9]+)$', 1) AS ext, count(*) AS n FROM pages GROUP BY 1"),
    "change_log_of_lines": (
        change_log_of_lines,
        "WITH l AS (SELECT doc_id, unnest(string_split(regexp_replace(text, '\\n\\z', ''), chr(10))) AS l, generate_subscripts(string_split(regexp_replace(text, '\\n\\z', ''), chr(10)), 1) - 1 AS n FROM documents WHERE text LIKE '%' || chr(10) || '%') "
        "SELECT doc_id AS package, CAST(doc_id AS VARCHAR) AS commit, (doc_id % 9) || '.' || (doc_id % 7) AS version, 'b/' || n AS file, CAST(length(l) AS INTEGER) AS added, CASE WHEN n % 2 = 1 THEN 1 END AS deleted FROM l WHERE n > 0",
    ),
    "analyzer_records": (
        analyzer_records,
        "SELECT user_id, 'summary' AS rec, min(event_id) AS name, arg_min(value, event_id) AS v FROM events WHERE event_type = 'purchase' GROUP BY 1 UNION ALL SELECT user_id, 'function', event_id, value FROM events WHERE event_type IS DISTINCT FROM 'purchase'",
    ),
    "open_records": (open_records, "SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS absent FROM events"),
    "version_tags": (
        version_tags,
        "WITH t AS (SELECT o_custkey AS package, strftime(o_orderdate, '%Y.%m') AS version, CASE WHEN o_orderkey % 11 > 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS date, strftime(o_orderdate, '%Y-%m-%d') AS commit, o_orderkey AS seq FROM orders), "
        "n AS (SELECT *, row_number() OVER (PARTITION BY package ORDER BY date NULLS LAST, seq) AS nth FROM t), a AS (SELECT *, row_number() OVER (PARTITION BY package, commit ORDER BY nth) AS a FROM n), "
        "b AS (SELECT *, row_number() OVER (PARTITION BY package, version ORDER BY nth DESC) AS b FROM a WHERE a = 1) SELECT package, version, date, commit FROM b WHERE b = 1",
    ),
    "json_sets": (
        json_sets,
        "SELECT event_id, CASE WHEN event_id % 5 = 0 OR event_id % 7 = 0 THEN '' ELSE event_type || ',x' END AS items, CASE WHEN event_id % 3 > 0 THEN event_type END AS kind FROM events",
    ),
    "fields_of_documents": (
        fields_of_documents,
        "SELECT doc_id, 'Lang' AS field, lang || '2' AS value FROM documents UNION ALL SELECT doc_id, 'Source', source || chr(10) || 'more' FROM documents",
    ),
}

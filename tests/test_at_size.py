"""What keeps the queries over packages and the byte budget right and bounded on larger tables."""

import time

import duckdb
import pyarrow as pa
from pyspark.sql import functions as F

from chronolake.functions import parse
from chronolake.operators import report, snapshot
from chronolake.plans import snapshot_queries as q

FILES = "package string, version string, path string, content string"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def documents(spark, tmp_path, rows):
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_structure_of_documents_without_words(spark, tmp_path):
    """the row without words ends the vignette with a newline, which begins no line."""
    sf = documents(spark, tmp_path, [(0, "123"), (1, ""), (2, "one two"), (3, None), (4, "... x"), (19, "--")])
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet/*.parquet'")
    query, sql = q.QUERIES["package_structure"]
    found = con.execute(sql)
    columns = [c[0] for c in found.description]
    assert sorted(tuple(r[c] for c in columns) for r in query(spark, sf).collect()) == sorted(found.fetchall())


def test_budget_orders_sizes_not_texts(spark):
    """a task that puts rows in order gets their sizes; texts only if they are asked for."""
    rows = spark.range(50).select("id", F.repeat(F.lit("é"), F.col("id").cast("int")).alias("text"))
    kept = report.within_budget(rows.repartition(7), [F.asc("id")], "text", 30)
    assert [(r.id, r.bytes_used) for r in kept.orderBy("id").collect()] == [(0, 1), (1, 4), (2, 9), (3, 16), (4, 25)]
    assert kept.columns == ["id", "text", "bytes_used"]
    (below,) = [x for x in plan(report.within_budget(rows.repartition(7).filter("text <> 'x'"), [F.asc("id")], "text", 30).select("id", "bytes_used")).splitlines() if "AS _bytes" in x]
    assert ", text#" not in below


def test_contents_are_written_for_asked_paths_only(spark, tmp_path):
    """F4 to F8: who asks for packages alone reads no text; a filter on paths stands below the contents."""
    sf = documents(spark, tmp_path, [(6, "one two three"), (None, "one"), (8, "")])
    files = q._files(spark, sf)
    assert "text:string" not in snapshot.snapshots(files)._jdf.queryExecution().executedPlan().toString()
    assert {r.path for r in files.filter("package is null").collect()} == {"secrets.txt", "tests/testthat/test-a.R", "man/fa.Rd", "man/other.Rd"}
    names = {r.package: r.content for r in files.filter("path = 'DESCRIPTION'").collect()}
    assert "Imports: onepkg (>= 1.6), twolib" in names["p6"] and "Imports: xpkg (>= 1.1), xlib" in names["p8"]


def test_names_meet_tests_in_rows(spark):
    """no row for each word of the tests."""
    rows = [("p", "1", "NAMESPACE", "export(f_1, g, h.i, `%o%`, k)"), ("p", "1", "tests/a.R", "f_1(2) f_12 a.h.i"), ("p", "1", "tests/b.R", "g;xg k2"), ("q", "1", "NAMESPACE", "export(f)"), ("r", "1", "tests/a.R", "f")]
    out = snapshot.export_test_linkage(spark.createDataFrame(rows, FILES))
    assert {r.package: r.exported_fn_test_linkage for r in out.collect()} == {"p": 3 / 5, "q": 0.0, "r": None}
    assert "explode(array_distinct" not in plan(out) and "[^A-Za-z0-9_]+" not in plan(out)


def test_slow_patterns_come_after_a_quick_one(spark):
    """the patterns that try many names at every place are tried where a quoted key stands."""
    assert all(r.where for r in snapshot.SECRETS if r.pattern.startswith("(?i)"))
    key = "abcdefghijklmnop"
    texts = {f'API_key : "{key}"': 1, f"secret_key='{key}'": 1, f'api_key = "{key[:15]}"': 0, f'other = "{key}"': 0, f'passwd = "{key * 3}=="': 1, f'token = "{key * 3}"': 0, "ghp_" + "a" * 36: 1, "github_pat_" + "a" * 36: 1, "ghx_" + "a" * 40: 0, "github_pat_" + "a" * 35: 0}
    rows = [(str(i), "1", "a.txt", t) for i, t in enumerate(texts)]
    out = snapshot.rule_metrics(spark.createDataFrame(rows, FILES))
    assert [r.secret_pattern_count for r in sorted(out.collect(), key=lambda r: int(r.package))] == list(texts.values())


def test_sections_are_made_once(spark):
    """one pass of Python for the sections, one for what they say."""
    rows = [("p", "1", "NAMESPACE", "export(f)"), ("p", "1", "man/f.Rd", "\\name{f}\n\\usage{f(x, y)}\n\\arguments{\\item{x}{a}}\n\\examples{\\dontrun{f()}}\n"), ("p", "1", "man/g.Rd", "")]
    out = snapshot.documentation(spark.createDataFrame(rows, FILES))
    assert plan(out).count("MapIn") == 2
    (r,) = out.collect()
    assert r[2:] == (1.0, 0.5, 0.0, 0.0, 1.0)


def test_long_words_without_colons(spark):
    """the pattern is tried on lines with three colons only."""
    rows = [("p", "1", "R/a.R", "x" * 200_000 + "\nab:::bc:::d; p:::e\nz9:::.f::: ")]
    start = time.time()
    (r,) = snapshot.functions(spark.createDataFrame(rows, FILES)).collect()
    assert (r.triple_colon_count, r.triple_colon_pkgs) == (4, 3) and time.time() - start < 30


def test_slices():
    """F8: a task holds what it makes of a slice, not of a batch."""
    batch = pa.RecordBatch.from_pydict({"n": range(5000), "content": ["x" * (10_000 if i % 1000 == 7 else 10) if i % 3 else None for i in range(5000)]})
    parts = list(parse.slices([batch, batch.slice(0, 0)], ["content"], rows=600, most=9000))
    assert [n for p in parts for n in p["n"].to_pylist()] == list(range(5000))
    assert all(p.num_rows <= 600 and (p.num_rows == 1 or sum(len(t or "") for t in p["content"].to_pylist()) <= 9000) for p in parts)


def test_whole_bodies(spark):
    """a body is read to its end, however long it is and whether or not braces hold it; what follows is not its own."""
    long = lambda name, *last: "\n".join([f"{name} <- function(x) {{", *["  x <- x + 1"] * 300, *last, "}"])
    code = {
        "long": long("long", "  eval(x)"),
        "plain": long("plain", "  x"),
        "argument": "argument <- function(x = {1},\n  y) {\n" + "  y\n" * 5 + "  quote(y)\n}",
        "bare": "bare = function(x) # no braces {\n\n  list(\n" + "    1,\n" * 250 + "    substitute(x))",
        "sum": "sum <- function(x) x +\n" + "  1 + # and\n" * 6 + "  sys.call()",
        "handler": "handler <- function(x) tryCatch({\n  x\n},\nerror = function(e)\n  eval\n(e))",
        "branch": "branch <- function(x) {\n  '}'; `}`; \"\\\"}\"; r\"--(})\")--\"; x %}% x # }\n  bquote(x)\n}",
        "short": "short <- function(x) x\n# next",
        "lambda": "lambda <- function(x)\n  \\(y)\n  y",
    }
    used = {"long", "argument", "bare", "sum", "handler", "branch"}
    for tail in ("", "\neval(1)\n", long("\nhidden", "eval(x)"), "\nopen <- function() {\n eval(x)"):
        rows = [(name, "1", p, t) for name, text in code.items() for p, t in (("NAMESPACE", f"export({name})"), ("R/a.R", text + tail))]
        out = snapshot.functions(spark.createDataFrame(rows, FILES)).collect()
        assert {r.package for r in out if r.nse_surface_n} == used
    (r,) = snapshot.functions(spark.createDataFrame([("p", "1", "NAMESPACE", "export(open)"), ("p", "1", "R/a.R", "open <- function() {\n" + "  1\n" * 300 + "  eval(x)")], FILES)).collect()
    assert r.nse_surface_n == 1  # never closed: to the end of the text

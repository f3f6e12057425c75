"""Operators on the small inputs whose results are known by hand."""

import datetime

import pytest
from pyspark.sql import functions as F

from chronolake.functions import text, version
from chronolake.operators import authors, contents, incremental, quality, report, series


@pytest.fixture(scope="module")
def tide(spark):
    """One package, five versions."""
    d = datetime.date
    rows = [
        ("tide", "0.3.0", d(2019, 3, 10), ["glass", "fern"], ["load", "save", "peek"], ["peek"], 1),
        ("tide", "0.3.2", d(2019, 3, 30), ["glass"], ["load", "save"], [], 2),
        ("tide", "0.4.0", d(2019, 6, 8), ["glass", "moss"], ["load", "save", "scan"], [], 3),
        ("tide", "1.0.0", d(2019, 6, 18), ["moss"], ["load", "scan", "tidy"], ["load"], 4),
        ("tide", "1.0.1", d(2020, 6, 18), ["moss"], ["scan", "tidy"], [], 5),
    ]
    return spark.createDataFrame(rows, "package string, version string, released date, deps array<string>, exports array<string>, signals array<string>, seq long")


ORDER = ["released", "seq"]


def test_series(tide):
    v = series.with_fidelity(series.with_bump(series.with_set_diff(tide, "package", ORDER, "exports"), "package", ORDER, "version")).orderBy("seq").collect()
    assert [r.bump for r in v] == ["initial", "patch", "minor", "major", "patch"] and [r.bump_fidelity for r in v] == [None, False, True, True, False]
    assert [(r.n_added, r.n_removed) for r in v] == [(3, 0), (0, 1), (1, 0), (1, 1), (0, 1)]
    assert series.drift(tide, "package", ORDER, "deps").first().dependency_drift == 3  # fern goes, moss comes, glass goes
    c = series.cadence(tide, "package", "released").first()
    assert (c.n_versions, c.cadence_days, str(c.latest_release)) == (5, 45, "2020-06-18")  # of 20, 70, 10 and 366 days
    cold = series.cold_removals(tide, "package", ORDER, "exports", "signals").first()
    assert (cold.n_removed, cold.n_cold, round(cold.cold_removal_rate, 9)) == (3, 1, 0.333333333)  # save went unannounced
    one = series.cold_removals(tide.filter("seq = 1"), "package", ORDER, "exports", "signals")
    assert one.count() == 0
    level = series.deprecation_maturity(tide.withColumn("lc", F.lit(None).cast("boolean")), "package", "signals", "lc").first()
    assert level.deprecation_maturity == 1
    assert [r.seq for r in series.current_only(tide, "package", ORDER).collect()] == [5]


def test_versions(spark):
    df = spark.createDataFrame([("1.10-2",), ("2",), ("x.1",), (" ",), (None,)], "v string")
    assert [r.t for r in df.select(version.triple("v").alias("t")).collect()] == [[1, 10, 2], [2, 0, 0], [0, 1, 0], [None] * 3, [None] * 3]
    many = spark.createDataFrame([("p", v) for v in ("1.9", "1.2-3", "1.10", "abc", "zz")] + [("q", "b"), ("q", "a")], "package string, version string")
    assert {r.package: r.version for r in series.max_version(many, "package", "version").collect()} == {"p": "1.10", "q": "b"}


def test_spans(spark):
    rows = [
        ("p", "1.0", "2020-01-01", '[{"given":"Ines","family":"Okafor","roles":["aut"]}]'),
        ("p", "1.10", "2020-03-01", '[{"given":"  INES ","family":"okafor"},{"given":"Tomi","family":null}]'),
        ("p", "1.9", None, '[{"given":"Tomi"}]'),
        ("q", "1", "2020-01-01", "not json"),
        ("q", "2", "2021-01-01", '[{"given":null,"family":null},{"given":"Ines","family":"Okafor"},{"given":"Ines","family":"Okafor"}]'),
    ]
    df = spark.createDataFrame(rows, "package string, version string, released string, authors string")
    got = {(r.author_key, r.package): r for r in authors.spans(authors.exploded(df, "authors"), "author_key", "package", "released", "version", ["given"]).collect()}
    assert set(got) == {("ines okafor", "p"), ("tomi ", "p"), ("ines okafor", "q")}
    a = got[("ines okafor", "p")]
    assert (a.first_version, a.last_version, a.n_versions, a.given) == ("1.0", "1.10", 2, "  INES ")
    b = got[("tomi ", "p")]
    assert (b.first_version, b.last_version, b.last_seen) == ("1.10", "1.9", None)
    assert got[("ines okafor", "q")].n_versions == 1


def test_churn(spark):
    v = spark.createDataFrame([("p", "1", "abcdef0123456789"), ("p", "2", "abcdefff"), ("q", "1", None)], "package string, version string, commit string")
    c = spark.createDataFrame([("p", None, "abcdef0", "x"), ("p", None, "abcdefff99", "y"), ("p", None, "abc", "z"), ("q", None, "abcdef0", "w")], "package string, version string, commit string, file string")
    assert sorted((r.version, r.file) for r in series.churn_of_version(c, v).collect()) == [("1", "x"), ("2", "y")]


def test_lines_and_words(spark):
    df = spark.createDataFrame([("",), ("a",), ("a\n",), ("a\n\n",), (None,), ("\n",)], "t string")
    assert [r.n for r in df.select(text.line_count("t").alias("n")).collect()] == [0, 1, 1, 2, 0, 1]
    assert [len(r.n) for r in df.select(text.lines("t").alias("n")).collect()] == [0, 1, 1, 2, 0, 1]
    assert spark.range(1).select(text.words(F.lit(" a,\n b ,,c")).alias("w")).first().w == ["a", "b", "c"]


def test_contents(spark):
    rows = [("p", "d", "1", "fa", None, 1, False, False, "s1", 1), ("p", "d", "2", "fa", "", 1, False, True, None, 2), ("p", "d", "2", "fb", "", 1, True, True, None, 3), ("p", "e", "2", None, "", 1, False, True, None, 4), ("p", "f", "2", "fc", "x", 2, False, True, "s2", 5)]
    r = spark.createDataFrame(rows, "package string, name string, version string, content_fp string, schema_fp string, fp_algo_version int, internal boolean, is_current boolean, sketch string, seq long")
    stored = contents.with_content_id(spark.createDataFrame([("fa", "", 1), ("old", "", 1)], "content_fp string, schema_fp string, fp_algo_version int"))
    out = contents.normalized(r, stored, ["package", "name", "version"], ["seq"], "sketch")
    assert {c.content_fp for c in out["contents"].collect()} == {"fa", "fc"}  # fb lost to the exported copy, old is garbage
    assert out["links"].count() == 3 and {(i.name, i.version) for i in out["identities"].collect()} == {("d", "2"), ("f", "2")}
    assert {s.sketch for s in out["sketches"].collect()} == {"s1", "s2"}


def test_incremental(spark):
    live = spark.createDataFrame([("a", "2"), ("b", "1"), ("c", "1"), ("d", "1")], "package string, latest_version string")
    u = incremental.universe(live, spark.createDataFrame([("a",), ("z",), ("y",)], "package string"))
    state = spark.createDataFrame([("a", "1"), ("b", "1"), ("z", "9")], "package string, version string")
    fails = spark.createDataFrame([("d", 5, "t"), ("c", 4, "t")], "package string, consecutive_failures int, last_attempt string")
    assert sorted(r.package for r in incremental.changed(u, state, fails).collect()) == ["a", "c", "y"]
    rows = spark.createDataFrame([("a", 1, "x"), ("a", None, "x"), ("b", 2, None), ("q", None, "y")], "package string, s int, build string")
    assert [r.package for r in incremental.backfill(rows, u, fails, "s").collect()] == ["a"]
    assert sorted(r.package for r in incremental.backfill(rows, u, fails, "absent").collect()) == ["a", "b"]
    assert sorted(str(r.s) for r in incremental.invalidated(rows, "s", "build", "x").collect()) == ["1", "None", "None", "None"]
    assert incremental.invalidated(rows, "s", "build", None) is rows
    assert [r.s for r in incremental.invalidated(rows, "s", "nobuild", "x").collect()] == [None] * 4
    done = spark.createDataFrame([("c", False, "n"), ("d", True, "n"), ("e", False, "n")], "package string, ok boolean, attempted string")
    assert sorted((r.package, r.consecutive_failures, r.last_attempt) for r in incremental.counted(fails, done).collect()) == [("c", 5, "n"), ("e", 1, "n")]
    stored = spark.createDataFrame([("a", "t", "h"), ("b", None, "h")], "package string, title string, description_hash string")
    fresh = spark.createDataFrame([("a", "new", None), ("b", None, None), ("c", "n", "k")], "package string, title string, description_hash string")
    own = lambda auth: sorted(tuple(r) for r in incremental.projected(stored, fresh, "package", ["title", "description_hash"], auth).collect())
    assert own(()) == [("a", "new", None), ("b", None, "h"), ("c", "n", None)]
    assert own(("title", "description_hash")) == [("a", "new", None), ("b", None, None), ("c", "n", "k")]
    once = incremental.upsert(stored, fresh, ["package"])
    assert sorted(map(tuple, incremental.upsert(once, fresh, ["package"]).collect()), key=str) == sorted(map(tuple, once.collect()), key=str)
    assert incremental.is_complete(0, 9, 10, 1) and not incremental.is_complete(1, 10, 10, 0)
    assert incremental.has_changed(False, 0, "a", "b") and not incremental.has_changed(False, 0, "a", "a")


def test_quality(spark):
    pairs = spark.createDataFrame([("elm7", "1"), ("elm", "2"), ("elm", "10")], "p string, v string")
    import hashlib

    assert quality.fingerprint(pairs, "p", "v").first().fingerprint == hashlib.sha256(b"elm:10,elm:2,elm7:1").hexdigest()
    assert quality.fingerprint(pairs.limit(0), "p", "v").first().fingerprint == hashlib.sha256(b"").hexdigest()
    assert quality.fingerprint_by_parts(pairs, "p", "v").first() == quality.fingerprint_by_parts(pairs.repartition(3), "p", "v").first()
    figures = lambda rows: spark.createDataFrame(rows, "field string, value double")
    limits = spark.createDataFrame([("a", 0.9, 10.0), ("b", 0.9, 10.0), ("c", 0.9, 10.0)], "field string, ratio double, allowance double")
    before, now = figures([("a", 1000.0), ("b", 50.0)]), figures([("a", 890.0), ("c", 0.0)])
    assert [r.field for r in quality.retention(now, before, limits).orderBy("field").collect()] == ["a", "b"]
    assert quality.retention(now, before, limits, rebuild=True).count() == 0
    assert quality.consistency(3, 3, 3) == [] and len(quality.consistency(3, 2, 3)) == 1
    empty = spark.createDataFrame([], "package string")
    assert quality.baseline({"x": empty}, None) is None and quality.baseline({"x": empty}, before) is before
    recorded = spark.createDataFrame([("x", 0), ("y", 3)], "table_name string, recorded long")
    assert [(r.series, r.table_name, r.verdict) for r in quality.preflight({"code": ({"x": empty}, recorded)}).collect()] == [("code", "y", "violation")]


def test_fingerprint_in_blocks(spark, monkeypatch):
    """Many ranges, each in many blocks, give the digest of the whole; nulls are left out."""
    import hashlib

    monkeypatch.setattr(quality, "BLOCK", 40)
    rows = [(i % 97, f"v{i * 7919 % 1000}") for i in range(1000)] + [(None, "x"), (3, None)]
    df = spark.createDataFrame(rows, "p long, v string").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = quality.fingerprint(df, "p", "v").first().fingerprint
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == hashlib.sha256(",".join(f"{p}:{v}" for p, v in sorted(r for r in rows if None not in r)).encode()).hexdigest()


def test_report(spark):
    rows = spark.createDataFrame([(i, "é" * 4) for i in range(10)], "n int, t string")
    assert report.within_budget(rows, [F.asc("n")], "t", 27).count() == 3  # nine bytes each with the line end
    tags = spark.createDataFrame([(f"2024-0{m}-0{d}",) for m in (1, 2) for d in (1, 2, 3)], "tag string")
    assert sorted(r.tag for r in report.to_prune(tags, "tag", 2).collect()) == ["2024-01-02", "2024-01-03"]
    s = report.change_summary(spark.createDataFrame([("a",), ("b",)], "package string"), spark.createDataFrame([("a",)], "package string"), 3, 1).first()
    assert (s.n_new, s.n_updated, s.percent, s.remaining) == (1, 1, 33, 2)

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from chronolake.functions import isolation, parse, version
from chronolake.sources import lookup

KEYS = ["package", "version"]


def opened(df):
    """Files that the executed scans read."""
    df.collect()

    def walk(p):
        if p.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            yield from walk(p.executedPlan())
        elif p.getClass().getSimpleName().endswith("QueryStageExec"):
            yield from walk(p.plan())
        else:
            yield p
            for i in range(p.children().size()):
                yield from walk(p.children().apply(i))

    return sum(p.metrics().apply("numFiles").value() for p in walk(df._jdf.queryExecution().executedPlan()) if p.getClass().getSimpleName() == "FileSourceScanExec")


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(4)
    names = [f"{a}{i:03}" for a in ("an", "ann", "bo", "é") for i in range(200)]
    data = [(rng.choice(names), f"p{rng.randint(0, 50)}", i) for i in range(4000)] + [("hot", f"p{i % 7}", 10**6 + i) for i in range(3000)] + [(None, "p", -1)]
    return spark.createDataFrame(data, "author_key string, package string, x long").repartition(5).cache()


def test_lookup(spark, rows, tmp_path):
    """Rows by key, prefix and set of keys; few files are opened; a hot key lies in several parts."""
    path = f"{tmp_path}/by-author"
    lookup.write(rows, path, ["author_key", "package", "x"], 32)
    spans = lookup.ranges(spark, path).collect()
    assert sum(r.n for r in spans) == 7001 and sum(r.low == "hot" or r.high == "hot" for r in spans) > 5
    found = lambda df: sorted(map(tuple, df.collect()))
    some = rows.select("author_key").distinct().filter("author_key is not null").limit(3).collect()
    for key in [*(r[0] for r in some), "hot", "nobody", ""]:
        got = lookup.by_key(spark, path, key)
        assert found(got) == found(rows.filter(F.col("author_key") == key))
        assert opened(got) <= (16 if key == "hot" else 2)
    for prefix in ("ann", "an0", "é1", "z", "hot", ""):
        assert found(lookup.by_prefix(spark, path, prefix)) == found(rows.filter(F.startswith("author_key", F.lit(prefix))))
    assert opened(lookup.by_prefix(spark, path, "ann00")) <= 3 < len(spans) // 4
    keys = spark.createDataFrame([("an001",), ("an001",), ("hot",), (None,), ("q",)], "k string")
    assert found(lookup.by_keys(spark, path, keys)) == found(rows.filter("author_key in ('an001', 'hot')"))
    assert found(lookup.by_keys(spark, path, ["é007"])) == found(rows.filter("author_key = 'é007'")) and lookup.by_keys(spark, path, ["q"]).collect() == []
    lookup.write(rows.filter("x < 100"), path, ["author_key", "package"], 4)  # anew
    assert lookup.by_prefix(spark, path, "").count() == rows.filter("x < 100 and author_key is not null").count()
    lookup.write(rows, f"{tmp_path}/by-package", ["package", "author_key"], 16)
    assert lookup.by_key(spark, f"{tmp_path}/by-package", "p3").count() == rows.filter("package = 'p3'").count()


def test_parser_isolated(spark):
    """One bad file among the files of a thousand snapshots: 999 results and one sentinel."""

    def numbers(text):
        for line in text.split("\n"):
            if line:
                yield (int(line),)

    files = spark.range(3000).select(F.lit("p").alias("package"), (F.col("id") % 1000).cast("string").alias("version"), F.concat(F.lit("f"), F.col("id")).alias("path"), F.when(F.col("id") == 1234, "12\nx").otherwise(F.concat(F.col("id"), F.lit("\n1"))).alias("content"))
    group = isolation.Parser("numbers", numbers, "n long", lambda r: r.groupBy(*KEYS).agg(F.sum("n").alias("total")))
    other = isolation.Parser("others", numbers, "n long", lambda r: r.groupBy(*KEYS).agg(F.count("*").alias("lines")), "^f1$")
    got = {r.version: r for r in isolation.measured(files, [group, other]).collect()}
    bad = got.pop("234")
    assert len(got) == 999 and bad.total is None and bad[".error.numbers"] == "f1234: ValueError: invalid literal for int() with base 10: 'x'" and bad[".error.others"] is None
    assert all(r[".error.numbers"] is None and r.total == 3 * int(v) + 3003 for v, r in got.items())
    assert got["1"].lines == 2 and got["2"].lines is None


def test_plan_isolated(spark):
    """A plan whose tasks fail for two of fifty snapshots, by a cast and in Python code; too many are raised."""
    files = spark.range(200).select(F.lit("p").alias("package"), (F.col("id") % 50).cast("string").alias("version"), F.col("id").cast("string").alias("path"), F.when(F.col("id").isin(7, 131), "x").otherwise(F.col("id").cast("string")).alias("content"))
    cast = isolation.Plan("cast", lambda f: f.groupBy(*KEYS).agg(F.sum(F.col("content").cast("int")).alias("total")))

    def strict(frames):
        for f in frames:
            yield f.assign(content=f["content"].map(int))[[*KEYS, "content"]].rename(columns={"content": "n"})

    python = isolation.Plan("python", lambda f: f.select(*KEYS, "content").mapInPandas(strict, "package string, version string, n long").groupBy(*KEYS).agg(F.max("n").alias("most")))
    got = {r.version: r for r in isolation.measured(files, [cast, python]).collect()}
    bad = {v for v, r in got.items() if r[".error.cast"]}
    assert len(got) == 50 and bad == {"7", "31"} == {v for v, r in got.items() if r[".error.python"]}
    assert all((r.total, r.most) == ((None, None) if v in bad else (4 * int(v) + 300, int(v) + 150)) for v, r in got.items())
    assert "CAST_INVALID_INPUT" in got["7"][".error.cast"] and "ValueError" in got["31"][".error.python"]
    with pytest.raises(PySparkException):
        isolation.measured(files, [cast], most=1)


def test_version_keys(spark):
    names = ["1.0rc2", "1.0", "1.0_2", "1.0_10", "1-2", "1.10", "v2", "1.9", None]
    got = [r.v for r in spark.createDataFrame([(v,) for v in names], "v string").orderBy(version.padded_key("v")).collect()]
    assert got == [None, "1.0", "1.0_2", "1.0_10", "1.0rc2", "1-2", "1.9", "1.10", "v2"]


def test_escapes():
    """Only braces are escaped; a backslash before a backslash is one of its own."""
    assert parse.balanced(r"a \\} b} c", 0) == 7 and parse.balanced(r"a \} b} c", 0) == 6 and parse.balanced(r"a \x{} b}", 0) == 8

import random

import pytest
from pyspark.sql import functions as F

from chronolake.operators import change_report as cr

ROWS = "package string, version string, loc double, functions double, exports double, api_added double, api_removed double, deps double, datasets long"


def some(n, seed=0, known=True):
    rng = random.Random(seed)
    maybe = lambda m: None if rng.random() < 0.2 else float(rng.randint(0, m))
    return [(f"{rng.choice(['é', 'p', '包'])}{i}" * rng.randint(1, 5), "1.0", maybe(10**7), maybe(99), maybe(99), maybe(3) if known else None, maybe(2) if known else None, maybe(9), i) for i in range(n)]


def size(lines):
    return sum(len(t.encode()) + 1 for t in lines)


def texts(df):
    return [r.text for r in df.orderBy("line_no").collect()]


@pytest.mark.parametrize(("n", "missing", "known"), [(60, 0, True), (60, 7, True), (30, 1234, False), (1, 0, True), (0, 5, True)])
def test_table(spark, n, missing, known):
    """Never over budget where the fixed lines fit; no row more would have fitted; nothing goes uncounted."""
    rows = spark.createDataFrame(some(n, n, known), ROWS).repartition(7)
    lines = cr.prepared(rows).cache()
    every = texts(cr.bounded_table(lines, n + missing, 10**6))
    body = [t for t in every if t.startswith("| ") and t not in cr.HEADER]
    assert len(body) == n and (cr.BY_API in every) == (known and n > 1) and (cr.BY_SIZE in every) == (not known and n > 1)
    for cap, budget in [(10**6, b) for b in (0, 300, 700, 1500, size(every), size(every) + 200)] + [(5, 1500), (0, 1500)]:
        got = texts(cr.bounded_table(lines, n + missing, cap, budget))
        shown = [t for t in got if t in body]
        assert shown == body[: len(shown)] and len(shown) <= cap
        fixed = size(got) - size(shown)
        assert size(got) <= max(budget, fixed)
        if len(shown) < n:
            assert cr.rest_line(n - len(shown)) in got
            spare = size([cr.rest_line(n)]) - size([cr.rest_line(n - len(shown))])  # set aside for the widest
            assert len(shown) == cap or size(got) + size([body[len(shown)]]) + spare > budget
        assert (cr.missing_line(missing, n + missing) in got) == (missing > 0)


def test_nothing(spark):
    none = cr.prepared(spark.createDataFrame([], ROWS))
    assert texts(cr.bounded_table(none, 0, 40, 100)) == [cr.TITLE, "", cr.NOTHING]
    assert texts(cr.bounded_table(none, 3, 40, 100)) == [cr.TITLE, "", *cr.HEADER, "", cr.missing_line(3, 3)]


def test_running(spark):
    """Ranks and sums over many ranges, against one window, with most rows equal in the first key."""
    rng = random.Random(2)
    rows = spark.createDataFrame([(rng.choice([0, 0, 0, 1]), i, rng.randint(0, 50)) for i in range(5000)], "a int, b int, s int").repartition(9)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = cr.running(rows, [F.col("a").desc(), F.col("b").asc()], F.col("s")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    used = 0
    for k, r in enumerate(sorted(got, key=lambda r: (-r.a, r.b))):
        used += r.s
        assert (r.nth, r.used) == (k + 1, used)
    assert len(got) == 5000


def test_order_and_cells(spark):
    rows = [("b", "1", 5.0, None, 1.0, 0.0, 1.0, None, 0), ("a", "1", 9e6, 2.0, None, 50.0, 0.0, 1.0, None), ("c", "2 (new)", 7.5, 2.0, 3.0, None, None, 1.0, 4), ("d", "1", 8.5, 2.0, 3.0, 0.0, None, 1.0, 4)]
    got = texts(cr.prepared(spark.createDataFrame(rows, ROWS)).withColumn("line_no", F.col("nth")))
    assert got == ["| b | 1 | 5 | n/a | 1 | -1 | n/a | 0 |", "| a | 1 | 9,000,000 | 2 | n/a | +50 | 1 | n/a |", "| d | 1 | 8 | 2 | 3 | - | 1 | 4 |", "| c | 2 (new) | 8 | 2 | 3 | n/a | 1 | 4 |"]


@pytest.mark.parametrize("budget", [0, 1, 5, len(cr.CUT), len(cr.CUT) + 1, 30, 41, 10**6])
def test_fitted(spark, budget):
    lines = ["one", "zwei über", "", "drei", "x" * 20]
    df = spark.createDataFrame([(i * 3, t) for i, t in enumerate(lines)], "line_no long, text string").repartition(3)
    got = texts(cr.fitted(df, budget))
    assert size(got) <= max(budget, 1)  # an empty line is a byte
    if budget >= size(lines):
        assert got == lines
    elif budget > len(cr.CUT):
        kept = len(got) - 1
        assert got == [*lines[:kept], cr.CUT] and size([*lines[: kept + 1], cr.CUT]) > budget
    else:
        assert got == [cr.CUT[: max(0, budget - 1)]]

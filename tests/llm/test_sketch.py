import hashlib
import random

import pytest
from pyspark.sql import functions as F

from chronolake.llm import sketch


def edited(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0]))
    out = {}
    for i, (d, t) in enumerate(rows):
        t, after = t or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(t) // 2
        out[d] = (len(t), hashlib.sha256((t[: len(t) - half] + after[:half]).encode()).hexdigest())
    return out


def corpus(n=300):
    rng = random.Random(5)
    return [(i * 7 - 50, " ".join(rng.choice(["alpha", "béta", "c", "😀", "delta\n"]) + str(rng.randint(0, 60)) for _ in range(rng.randint(0, 300)))) for i in range(n)]


@pytest.mark.parametrize("rows", [corpus(), [(5, "one two")], [(None, None), (1, ""), (2, "a b c d e f"), (3, "a b c d e f")]])
def test_edited(spark, tmp_path, rows):
    spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS tie", "2 AS sketch").repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    got = sketch.op3_fingerprints(spark, str(tmp_path)).collect()
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in got} == edited(rows) and len(got) == len(rows)
    assert all(0 <= x <= 1 for r in got for x in (r.near_edited, r.near_next))
    texts = dict(rows)
    by = {}
    assert all(by.setdefault(texts[r.doc_id] or "", r.fingerprint) == r.fingerprint for r in got)


def grams(t):
    """The shingles' hashes as Spark's xxhash64 has them are not needed: sets of words compare alike."""
    w = (t or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_query_against_plain(spark, tmp_path):
    """Written fingerprints against hashes one by one; likeness from them, or exact for short texts."""
    rng = random.Random(8)
    long = " ".join(f"w{i}" for i in range(400))
    rows = [(i, " ".join(rng.choice(["a", "b", f"w{rng.randint(0, 399)}"]) for _ in range(rng.choice([0, 1, 4, 5, 9, 14, 40, 400])))) for i in range(120)]
    rows += [(200, " ".join(long.split()[7:16])), (201, long), (202, "w1 w2 w3 w4 w5 w6"), (203, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10"), (204, None), (205, ""), (206, "one")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in sketch.op3_fingerprints(spark, str(tmp_path)).collect()}
    every = sorted({g for _, t in rows for g in grams(t)})
    edits, texts = {}, [t or "" for _, t in rows]
    for i, (d, _) in enumerate(rows):
        t, after = texts[i], texts[(i + 1) % len(rows)]
        edits[d] = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
    every = sorted({*every, *(g for t in edits.values() for g in grams(t))})
    table = spark.createDataFrame([(i, list(g)) for i, g in enumerate(every)], "i int, g array<string>").withColumn("h", F.expr("transform(g, x -> xxhash64(x))"))
    full, short = F.xxhash64(*(F.get("h", F.lit(j)) for j in range(5))), F.expr("aggregate(h, 0L, (a, x) -> xxhash64(a, x))")
    h = {every[r.i]: r.x for r in table.select("i", F.when(F.size("g") == 5, full).otherwise(short).alias("x")).collect()}
    kept = lambda t: {h[g] for g in grams(t) if 0 <= h[g] < 1 << 61}
    said = lambda t: ("" if kept(t) or not grams(t) else "all:") + ",".join(f"{x % (1 << 64):016x}" for x in sorted(kept(t) or {h[g] for g in grams(t)}))

    def like(a, b):
        if kept(a):
            return len(kept(a) & kept(b)) / len(kept(a))
        return len(grams(a) & grams(b)) / len(grams(a)) if grams(a) else float(not grams(b))

    for i, (d, _) in enumerate(rows):
        t, after = texts[i], texts[(i + 1) % len(rows)]
        assert (got[d].fingerprint, got[d].edited_fingerprint) == (said(t), said(edits[d]))
        assert abs(got[d].near_edited - like(t, edits[d])) < 1e-12 and abs(got[d].near_next - like(t, after)) < 1e-12
    assert got[200].near_next == got[202].near_next == 1.0


def test_successor_of_a_hot_id(spark):
    """Nulls and one doc_id that most rows share are cut further; every row has its successor."""
    rows = [(None, f"n{i}") for i in range(900)] + [(7, f"s{i}") for i in range(1500)] + [(7, "same")] * 40 + [(i, f"t{i}") for i in range(300)] + [((1 << 62) + i, f"u{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "d long, t string").select(F.coalesce("d", F.lit(sketch.FIRST)).alias("at"), F.xxhash64("t").alias("tie"), "t")
    got = sketch.with_next(df.repartition(6), "at", "tie", ["t"], rows_a_range=50).collect()
    order = sorted((r.at, r.tie, r.t) for r in got)
    assert len(got) == len(rows)
    after = [order[(i + 1) % len(order)][2] for i in range(len(order))]
    assert sorted((r.at, r.tie, r.next_t) for r in got) == sorted((a, b, x) for (a, b, _), x in zip(order, after, strict=True))


def test_repeated_rows_and_empty(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "c")], "doc_id long, text string")
    assert sketch.fingerprints(docs).count() == 4
    assert sketch.fingerprints(docs.limit(0)).count() == 0


def test_estimates(spark):
    """At scale 1 the sketch holds every shingle, so containment is exact; at 8 it is near."""
    rows = [(i, a, b) for i, (a, b) in enumerate(zip([t for _, t in corpus(60)], [t[: len(t) // 2] + " x y" for _, t in corpus(60)], strict=True))]
    df = spark.createDataFrame(rows, "id long, a string, b string")
    grams = lambda t: {tuple(w[i : i + 5]) for w in [t.lower().split()] for i in range(max(1, len(w) - 4))} if t.split() else set()
    for scale, least in ((1, 1e-9), (8, 0.35)):
        got = sketch.with_sketch(sketch.with_sketch(df, "a", "s", scale=scale), "b", "t", scale=scale).select("a", "b", sketch.containment("s", "t").alias("c"), F.size("s").alias("n")).collect()
        off = []
        for r in got:
            a, b = grams(r.a), grams(r.b)
            off.append(abs(r.c - (len(a & b) / len(a) if a else float(not b))) if r.n >= 20 or scale == 1 else 0)
        assert max(off) <= least and sum(off) / len(off) < 0.06


def test_merge(spark):
    """The union of sketches is the sketch of the union, short texts included."""
    df = sketch.with_sketch(spark.createDataFrame([(1, "a b c d e f g h"), (1, "h i j k l m"), (2, "")], "g int, t string"), "t", "s", scale=1)
    got = {r.g: len(r.s) for r in sketch.merged(df, "g", "s").collect()}
    assert got == {1: 6}
    rows = [(1, t) for _, t in corpus(40)] + [(1, f"only {i} word{i}") for i in range(30)]
    df = spark.createDataFrame(rows, "g int, t string")
    got = sketch.merged(sketch.with_sketch(df, "t", "s"), "g", "s").first().s
    every = sketch.merged(sketch.with_sketch(df, "t", "s", scale=1), "g", "s").first().s
    assert sorted(got) == sorted(x for x in every if 0 <= x < 1 << 61)

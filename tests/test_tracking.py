import random

from pyspark.sql import functions as F

from chronolake.operators import incremental
from chronolake.streaming import tracking


def arrivals(n, seed):
    rng, out = random.Random(seed), []
    for seq in range(n):
        p, kind = f"p{rng.randint(0, 25)}", rng.choice(["seen", "seen", "result", "result", "result", "gone", "other"])
        v = rng.choice(["1.0", "1.1", "2.0", None]) if kind == "seen" else rng.choice(["1.0", "1.1", "2.0"])
        out.append((p, seq, kind, v, rng.random() < 0.35, rng.random() < 0.7, rng.choice(["b1", "b2", None]), f"t{seq}"))
    return out


def batch(spark, rows):
    """The batch operators over all arrivals so far."""
    a = spark.createDataFrame(rows, tracking.ARRIVAL)
    last = lambda df, by: df.groupBy(*by).agg(F.max_by(F.struct(*[c for c in df.columns if c not in by]), "seq").alias("r")).select(*by, "r.*")
    inside = last(a.filter("kind in ('seen', 'gone')"), ["package"]).filter("kind = 'seen'").select("package", F.col("version").alias("latest_version"))
    good = a.filter("kind = 'result' and ok")
    state = last(good, ["package"]).select("package", "version")
    versions = last(good, ["package", "version"]).select("package", "version", F.when(F.col("measured"), 1).alias("sentinel"), "build", F.lit(1).alias("marker"))
    failed = a.filter("kind = 'result'").join(last(good, ["package"]).select("package", F.col("seq").alias("since")), "package", "left").filter("not ok and seq > coalesce(since, -1)")
    fails = failed.groupBy("package").agg(F.count("*").cast("int").alias("consecutive_failures"), F.max_by("at", "seq").alias("last_attempt"))
    cleared = incremental.invalidated(versions, "marker", "build", "b1")
    todo = incremental.changed(inside, state, fails)
    more = incremental.backfill(versions, inside, fails, "sentinel")
    old = incremental.backfill(cleared, inside, fails, "marker")
    names = lambda df: sorted(r.package for r in df.collect())
    return names(todo), names(more), names(old), sorted(map(tuple, fails.collect())), [r.package for r in incremental.shard([todo, more, old], 7).collect()]


def test_stream_equals_batch(spark, tmp_path):
    """After every batch, each in a run of its own (a restart), the pools are those of the batch operators."""
    rows, table = arrivals(400, 3), f"{tmp_path}/states"
    for i, at in enumerate(range(0, 400, 100)):
        spark.createDataFrame(rows[at : at + 100], tracking.ARRIVAL).repartition(3).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(spark.createDataFrame([], tracking.ARRIVAL).schema).parquet(f"{tmp_path}/in")
        tracking.run(stream, table, f"{tmp_path}/check", 4)
        s = tracking.states(spark, table)
        names = lambda df: sorted(r.package for r in df.collect())
        got = names(tracking.to_analyse(s)), names(tracking.to_backfill(s)), names(tracking.stale(s, "b1")), sorted(map(tuple, tracking.failures(s).collect())), [r.package for r in tracking.next_shard(s, 7, "b1").collect()]
        assert got == batch(spark, rows[: at + 100]), i
    assert any(n >= incremental.PERMANENT for _, n, _ in got[3]) and tracking.stale(s, None).collect() == []

import json

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from chronolake.operators import series
from chronolake.sources import archive
from chronolake.sources.store import Store
from chronolake.streaming import upserts


def test_tags(spark):
    rows = [("p", "1.0", "2020-01-01", "a", 1), ("p", "R-1.1", "2020-02-01", "b", 2), ("p", "1.1", None, "c", 3), ("p", "x1", "2020-01-01", "d", 4), ("p", "1.2", "2020-03-01", "b", 5)]
    got = archive.version_tags(spark.createDataFrame(rows, "package string, tag string, date string, commit string, seq long")).orderBy("nth").collect()
    assert [(r.version, r.commit) for r in got] == [("1.0", "a"), ("1.1", "c")]


def test_change_log(spark):
    lines = ["junk\tbefore\tit", "__C__abc\t2020\tversion 1.2-3 of it", "", "1\t2\tR/{a => b}/x.R", "-\t-\tdata.rda", "short\tline", "__C__def\t2021\tno number", "3\t0\tx => y"]
    df = spark.createDataFrame([("p", i, x) for i, x in enumerate(lines)], "package string, line_no long, line string")
    got = [tuple(r)[1:] for r in archive.change_log(df).collect()]
    assert got == [("abc", "1.2-3", "R/b/x.R", 1, 2), ("abc", "1.2-3", "data.rda", None, None), ("def", None, "y", 3, 0)]


def test_records(spark):
    lines = [{"rec": "summary", "n": 1}, {"rec": "summary", "n": 2}, {"rec": "function", "name": "f", "loc": 3}, {"rec": "function", "name": "g"}, {"rec": "other"}]
    df = spark.createDataFrame([("p", i, json.dumps(x)) for i, x in enumerate(lines)] + [("p", 9, "{bad")], "package string, line_no long, line string")
    got = archive.analyzer_records(df, {"summary": "n int", "function": "name string, loc int"}, ["package"])
    assert [r.n for r in got["summary"].collect()] == [1] and [(r.name, r.loc) for r in got["function"].orderBy("line_no").collect()] == [("f", 3), ("g", None)]
    data = [{"name": "d", "columns": [{"a": 1}, {"a": 2}], "extra": 1.5}, {"name": "e", "columns": []}]
    base = StructType.fromDDL("name string, file string")
    rows = archive.open_records(spark.createDataFrame([(json.dumps(x),) for x in data], "line string"), base).orderBy("name").collect()
    assert [(r.name, r.file, r.n_cols, r.extra) for r in rows] == [("d", None, 2, 1.5), ("e", None, 0, None)] and rows[0]["columns"] == '[{"a":1},{"a":2}]'


def test_tables(spark, tmp_path):
    path = f"{tmp_path}/t"
    old = spark.createDataFrame([("a", "1", 1), ("b", "1", 2), ("c", "1", 3)], "package string, version string, x int")
    archive.write_table(old, path, buckets=4)
    fresh = spark.createDataFrame([("b", "1", 5, True, 1), ("b", "1", 6, False, 2), ("d", "2", 7, True, 3)], "package string, version string, x int, flag boolean, seq long")
    archive.replace_packages(spark, path, fresh, ["package", "version"], "seq", buckets=4)
    got = {(r.package, r.x, r.flag) for r in archive.read_table(spark, path).collect()}
    assert got == {("a", 1, None), ("b", 6, False), ("c", 3, None), ("d", 7, True)}
    assert dict(archive.with_int_flags(fresh).dtypes)["flag"] == "int" and archive.present(old, ["x", "nope"]).columns == ["x"]
    assert archive.read_manifest(spark, f"{tmp_path}/none", "n int") is None
    archive.write_manifest(spark.createDataFrame([('{"n": 3}',)], "value string"), f"{tmp_path}/m")
    assert archive.read_manifest(spark, f"{tmp_path}/m", "n int").first().n == 3
    archive.write_manifest(spark.createDataFrame([("nothing",)], "value string"), f"{tmp_path}/m")
    assert archive.read_manifest(spark, f"{tmp_path}/m", "n int") is None or archive.read_manifest(spark, f"{tmp_path}/m", "n int").first().n is None
    assert [r.package for r in archive.accumulated(old, spark.createDataFrame([("b",), ("",)], "package string"), "package").collect()] == ["a", "b", "c"]


def test_corpus(spark, tmp_path):
    for p, t in (("p/1.0/R/a.R", "x\n\n"), ("p/1.0/DESCRIPTION", "D: 1")):
        f = tmp_path / p
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_text(t)
    got = {(r.package, r.version, r.path, r.content) for r in archive.corpus(spark, str(tmp_path)).collect()}
    assert got == {("p", "1.0", "R/a.R", "x\n"), ("p", "1.0", "DESCRIPTION", "D: 1")}


def test_stream_equals_batch(spark, tmp_path):
    """Arrivals in several batches, with late and repeated versions, give what one batch gives."""
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    rows = events.select((F.col("user_id") % 20).cast("string").alias("package"), F.col("event_id").cast("string").alias("version"), F.col("ts").cast("date").alias("released"), F.col("event_id").alias("seq"))
    rows = rows.unionByName(rows.filter("seq % 9 = 0").withColumn("released", F.date_add("released", 3)).withColumn("seq", F.col("seq") + 100000))
    work = lambda df: series.cadence(df, "package", "released")
    for i in range(3):  # dealt out so that old versions come late
        rows.filter(F.pmod(F.xxhash64("seq"), F.lit(3)) == i).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        upserts.run(stream, f"{tmp_path}/snap", f"{tmp_path}/out", f"{tmp_path}/check", work, ["package", "version"], "seq")
    once = work(series.keep_one(rows, ["package", "version"], [F.desc("seq")]))
    assert sorted(map(tuple, archive.read_table(spark, f"{tmp_path}/out").select(*once.columns).collect())) == sorted(map(tuple, once.collect()))
    assert archive.read_table(spark, f"{tmp_path}/snap").count() == rows.select("package", "version").distinct().count()


def test_ordered_stream(spark, tmp_path):
    """The same through a store: both tables at once, a batch with its marker isn't taken again, new columns are added."""
    rows = spark.range(120).select((F.col("id") % 7).cast("string").alias("package"), (F.col("id") % 30).cast("string").alias("version"), F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 50).cast("int")).alias("released"), F.col("id").alias("seq"))
    work = lambda df: series.cadence(df, "package", "released")
    store = Store(spark, f"{tmp_path}/store", {"snapshots": "package", "results": "package"}, 4)
    for i in range(2):
        rows.filter(F.col("seq") % 2 == i).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        upserts.run_ordered(stream, store, f"{tmp_path}/check", work, ["package", "version"], "seq")
    once = work(series.keep_one(rows, ["package", "version"], [F.desc("seq")]))
    found = lambda: sorted(map(tuple, store.read("results").select(*once.columns).collect()))
    assert found() == sorted(map(tuple, once.collect())) and store.has("stream-0") and store.has("stream-1")
    more = rows.limit(3).withColumn("extra", F.lit(1)).withColumn("package", F.lit("0"))
    before = store.current()
    upserts.ordered_batch(more, "stream-1", store, work, ["package", "version"], "seq")
    assert store.current() == before
    upserts.ordered_batch(more, "late", store, work, ["package", "version"], "seq")
    assert "extra" in store.read("snapshots").columns and store.read("results").count() == 7

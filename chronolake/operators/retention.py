"""What a release must not lose: manifests held against those before, by checks that are data.

A manifest is a JSON text; a check is a row (series, path, ratio, allowance): the figure at ``path`` (dots between levels) must not
fall below least(before x ratio, before - allowance). A figure that the manifest before doesn't have is skipped, one that
is missing now counts as 0. A manifest is a table of one row with the column ``manifest``; no row, or a text
that isn't JSON, is no manifest.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECK = "series string, path string, ratio double, allowance double"
FOUND = "series string, kind string, path string, before double, now double, floor double"


def figures(checks: DataFrame, manifest: DataFrame, name: str) -> DataFrame:
    """The checks with the manifest's figure at each path (null if it isn't one number)."""
    one = manifest.agg(F.max("manifest").alias("m"))  # one row, also where there is none
    return checks.join(F.broadcast(one)).withColumn(name, F.expr("get_json_object(m, concat('$.', path))").try_cast("double")).drop("m")


def _read(manifest: DataFrame) -> bool:
    return bool(manifest.filter("get_json_object(manifest, '$') is not null").limit(1).count())


def violations(series: str, now: DataFrame, before: DataFrame, checks: DataFrame, tag: str = "", rebuild: bool = False) -> DataFrame:
    """Rows of FOUND: figures that ``fell``; ``no baseline`` where a release (its ``tag``) stands before, but its manifest
    couldn't be read. With neither, it is the first release and in order; a rebuild that was asked for is exempt."""
    spark, none = checks.sparkSession, checks.sparkSession.createDataFrame([], FOUND)
    own = checks.filter(F.col("series") == series)
    if rebuild or own.isEmpty():
        return none
    if not _read(before):
        return spark.createDataFrame([(series, "no baseline", tag, None, None, None)], FOUND) if tag else none
    both = figures(figures(own, before, "before"), now, "now").filter("before is not null").withColumn("now", F.coalesce("now", F.lit(0.0)))
    both = both.withColumn("floor", F.least(F.col("before") * F.col("ratio"), F.col("before") - F.col("allowance")))
    return both.filter("now < floor").select("series", F.lit("fell").alias("kind"), "path", "before", "now", "floor")


def audit(series: str, counts: DataFrame, before: DataFrame) -> DataFrame:
    """What a release's tables hold (one row: n_packages, n_versions) against the manifest that came with it: fewer is a violation
    (``fewer``), more a note (``more``: it was published in part). A manifest of another series is a violation
    (``other series``) and compares with nothing; no manifest, nothing to compare."""
    spark = before.sparkSession
    if not _read(before):
        return spark.createDataFrame([], FOUND)
    declared = before.select(F.get_json_object("manifest", "$.series").alias("s")).first().s or ""
    if declared != series:
        return spark.createDataFrame([(series, "other series", declared, None, None, None)], FOUND)
    paths = spark.createDataFrame([(series, p, 1.0, 0.0) for p in ("n_versions", "n_packages")], CHECK)
    one = counts.agg(*(F.coalesce(F.max(c), F.lit(0)).cast("double").alias(c) for c in ("n_versions", "n_packages")))
    now = F.when(F.col("path") == "n_versions", F.col("n_versions")).otherwise(F.col("n_packages"))
    both = figures(paths, before, "before").filter("before is not null").join(F.broadcast(one)).withColumn("now", now)
    kind = F.when(F.col("now") < F.col("before"), "fewer").when(F.col("now") > F.col("before"), "more")
    return both.withColumn("kind", kind).filter("kind is not null").select("series", "kind", "path", "before", "now", F.col("before").alias("floor"))


def measured(versions: DataFrame, packages: DataFrame | None = None) -> DataFrame:
    """n_versions, n_packages of a release's tables."""
    n = versions.agg(F.count("*").alias("n_versions"))
    return n.join((versions if packages is None else packages).agg(F.countDistinct("package").alias("n_packages")))  # one row each


def baseline(series: str, before: DataFrame, counts: DataFrame, tables: dict[str, DataFrame], checks: DataFrame) -> DataFrame:
    """The manifest, or one measured from the release's tables where there is none: the tables that the series' checks ask for.
    Nothing where these are empty, which is what a lost download leaves. A manifest that is there is never replaced."""
    if _read(before):
        return before
    asked = [r.path.removeprefix("tables.") for r in checks.filter((F.col("series") == series) & F.startswith("path", F.lit("tables."))).select("path").orderBy("path").collect()]  # checks are few
    own = [tables[t].agg(F.lit(t).alias("k"), F.count("*").alias("v")) if t in tables else before.sparkSession.createDataFrame([(t, 0)], "k string, v long") for t in asked]
    sums = reduce(DataFrame.unionByName, own).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("k", "v")))).alias("tables")) if own else before.sparkSession.createDataFrame([({},)], "tables map<string, long>")
    one = counts.filter("n_versions > 0 and n_packages > 0").join(F.broadcast(sums))
    return one.select(F.to_json(F.struct(F.lit(series).alias("series"), "n_packages", "n_versions", "tables")).alias("manifest"))


def preflight(spark: SparkSession, series: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """The audits of several series (counts, manifest before)."""
    return reduce(DataFrame.unionByName, [audit(s, c, m) for s, (c, m) in series.items()], spark.createDataFrame([], FOUND))

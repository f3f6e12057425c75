"""Analytics over ordered series: the versions of each package, oldest first.

All functions take the package column and the order columns, which must tell the versions of a
package apart. One window by package serves all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronolake.functions.text import or_empty, ratio
from chronolake.functions.version import bump, numeric_key, triple


def _series(package: str, order: list[str]):
    return Window.partitionBy(package).orderBy(*(F.asc_nulls_last(c) for c in order))


def with_bump(df: DataFrame, package: str, order: list[str], version: str) -> DataFrame:
    """Adds bump: what kind of step each version is from the one before."""
    w = _series(package, order)
    df = df.withColumn("_now", triple(version))
    df = df.withColumn("bump", bump(F.col("_now"), F.lag("_now").over(w), F.row_number().over(w) == 1))
    return df.drop("_now")


def with_set_diff(df: DataFrame, package: str, order: list[str], items: str, of: str = "string") -> DataFrame:
    """Adds added and removed: the set ``items`` against the previous version's. A null set is empty;
    the first version adds all it has."""
    now, before = or_empty(items, of), or_empty(F.lag(items).over(_series(package, order)), of)
    return df.withColumn("added", F.array_except(now, before)).withColumn("removed", F.array_except(before, now))


def with_fidelity(df: DataFrame) -> DataFrame:
    """Adds n_added, n_removed, is_breaking and bump_fidelity (does the bump promise what changed);
    needs bump, added and removed. The first version's fidelity is null."""
    df = df.withColumn("n_added", F.size("added")).withColumn("n_removed", F.size("removed"))
    kept = F.when(F.col("n_removed") > 0, F.col("bump") == "major").when(F.col("n_added") > 0, F.col("bump").isin("major", "minor")).otherwise(True)
    return df.withColumn("is_breaking", F.coalesce(F.col("n_removed") > 0, F.lit(False))).withColumn("bump_fidelity", F.when(F.col("bump") != "initial", kept))


def cadence(df: DataFrame, package: str, released: str) -> DataFrame:
    """Per package: n_versions, first_release, latest_release and cadence_days, the median gap of its
    ordered dates. Rows without a date count as versions only; cadence needs two dates."""
    day = F.col(released).cast("date")
    gap = F.datediff(day, F.lag(day).over(Window.partitionBy(package).orderBy(F.asc_nulls_last(day))))
    gaps = df.select(package, day.alias("_day"), F.when(day.isNotNull(), gap).alias("_gap"))
    return gaps.groupBy(package).agg(F.count("*").alias("n_versions"), F.min("_day").alias("first_release"), F.max("_day").alias("latest_release"), F.median("_gap").alias("cadence_days"))


def drift(df: DataFrame, package: str, order: list[str], items: str, of: str = "string") -> DataFrame:
    """Per package: additions and removals over all transitions (the first version is none)."""
    d = with_set_diff(df.withColumn("_first", F.row_number().over(_series(package, order)) == 1), package, order, items, of)
    moved = F.when(F.col("_first"), 0).otherwise(F.size("added") + F.size("removed"))
    return d.groupBy(package).agg(F.sum(moved).alias("dependency_drift"))


def cold_removals(df: DataFrame, package: str, order: list[str], items: str, signals: str, of: str = "string") -> DataFrame:
    """Per package: removals, removals without a signal in the version just before, and their share
    (null without removals)."""
    w = _series(package, order)
    d = df.withColumn("_before", or_empty(F.lag(signals).over(w), of)).withColumn("_first", F.row_number().over(w) == 1)
    d = with_set_diff(d, package, order, items, of).filter("not _first")
    d = d.groupBy(package).agg(F.sum(F.size("removed")).alias("n_removed"), F.sum(F.size(F.array_except("removed", "_before"))).alias("n_cold"))
    return d.withColumn("cold_removal_rate", ratio(F.col("n_cold"), F.col("n_removed")))


def deprecation_maturity(df: DataFrame, package: str, symbols: str, lifecycle: str) -> DataFrame:
    """Per package: 2 if any version signals by life cycle, 1 if by symbols, else 0."""
    level = F.when(F.coalesce(F.col(lifecycle), F.lit(False)), 2).when(F.size(or_empty(symbols)) > 0, 1).otherwise(0)
    return df.groupBy(package).agg(F.max(level).alias("deprecation_maturity"))


def on_latest(df: DataFrame, package: str, order: list[str], values: DataFrame) -> DataFrame:
    """Joins package-level values to the last row of each package; other rows have null."""
    back = Window.partitionBy(package).orderBy(*(F.desc_nulls_first(c) for c in order))
    df = df.withColumn("is_current", F.row_number().over(back) == 1)
    columns = [c for c in values.columns if c != package]
    joined = df.join(values, package, "left")
    return joined.select(*df.columns, *(F.when(F.col("is_current"), F.col(c)).alias(c) for c in columns))


def current_only(df: DataFrame, package: str, order: list[str]) -> DataFrame:
    """Rows of each package's last version (all rows that share its order)."""
    back = Window.partitionBy(package).orderBy(*(F.desc_nulls_first(c) for c in order))
    return df.withColumn("_rank", F.rank().over(back)).filter("_rank = 1").drop("_rank")


def latest_marked(df: DataFrame, package: str, marker: str, released: str, seq: str) -> DataFrame:
    """One row per package: the marked rows, and for packages without one the newest by date, then by
    order of arrival."""
    newest = Window.partitionBy(package).orderBy(F.col(marker).isNotNull().desc(), F.desc_nulls_last(released), F.desc(seq))
    return df.withColumn("_n", F.row_number().over(newest)).filter("_n = 1").drop("_n")


def latest_ranked(df: DataFrame, package: str, marker: str, version: str, seq: str) -> DataFrame:
    """One row per package: marked first, among these by version text descending, then latest arrival."""
    marked = F.col(marker).isNotNull()
    order = Window.partitionBy(package).orderBy(marked.desc(), F.when(marked, F.col(version)).desc_nulls_last(), F.desc(seq))
    return df.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")


def max_version(df: DataFrame, package: str, version: str) -> DataFrame:
    """One row per package: its highest version by number; unparsable ones lose, text breaks ties."""
    key = numeric_key(version)
    rest = F.struct(*(c for c in df.columns if c != package))
    best = df.groupBy(package).agg(F.max_by(rest, F.struct(key.isNotNull(), key, F.col(version))).alias("_r"))
    return best.select(package, "_r.*")


def keep_one(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_n = 1").drop("_n")


def churn_of_version(churn: DataFrame, versions: DataFrame, digits: int = 7) -> DataFrame:
    """Change-log rows with the version whose commit is theirs: either id may be a prefix of the
    other. Equal leading digits are joined first, then the prefix is checked."""
    c = churn.withColumn("_k", F.substring("commit", 1, digits)).filter(F.length("commit") >= digits)
    v = versions.select("package", "version", F.col("commit").alias("_commit"), F.substring("commit", 1, digits).alias("_k")).filter(F.length("_commit") >= digits)
    fits = F.startswith("commit", "_commit") | F.startswith("_commit", "commit")
    return c.drop("version").join(v, ["package", "_k"]).filter(fits).drop("_k", "_commit")

"""Incremental processing: what to do next, and how results replace what is stored."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PERMANENT = 5


def universe(live: DataFrame, archived: DataFrame) -> DataFrame:
    """package, latest_version of the live, and of what is archived only, with a null version."""
    gone = archived.select("package").distinct().join(live, "package", "left_anti")
    return live.select("package", "latest_version").unionByName(gone.withColumn("latest_version", F.lit(None).cast("string")))


def permanent(failures: DataFrame, least: int = PERMANENT) -> DataFrame:
    return failures.filter(F.col("consecutive_failures") >= least).select("package")


def changed(universe: DataFrame, state: DataFrame, failures: DataFrame) -> DataFrame:
    """Packages never analysed, or live with another version than the stored one."""
    s = state.select("package", F.col("version").alias("_had"), F.lit(True).alias("_known"))
    todo = universe.join(s, "package", "left").filter(F.col("_known").isNull() | (F.col("latest_version").isNotNull() & ~F.col("latest_version").eqNullSafe(F.col("_had"))))
    return todo.join(permanent(failures), "package", "left_anti").select("package")


def backfill(rows: DataFrame, universe: DataFrame, failures: DataFrame, sentinel: str, latest: str | None = None) -> DataFrame:
    """Packages with a null sentinel in any row (or in their latest row, marked by ``latest``); all, if
    the column isn't there."""
    if sentinel not in rows.columns:
        found = rows.select("package").distinct()
    else:
        own = rows.filter(latest) if latest else rows
        found = own.groupBy("package").agg(F.bool_or(F.col(sentinel).isNull()).alias("_n")).filter("_n").select("package")
    return found.join(universe.select("package"), "package", "left_semi").join(permanent(failures), "package", "left_anti")


def invalidated(rows: DataFrame, marker: str, build: str, current: str | None) -> DataFrame:
    """Clears the marker where another build than the current one made the row; of all rows, if the
    build isn't recorded; of none, if the current one isn't known."""
    if current is None or marker not in rows.columns:
        return rows
    stale = ~F.col(build).eqNullSafe(F.lit(current)) if build in rows.columns else F.lit(True)
    return rows.withColumn(marker, F.when(~stale, F.col(marker)))


def shard(pools: list[DataFrame], size: int) -> DataFrame:
    """The first ``size`` packages, in order, of all pools together."""
    every = pools[0].select("package")
    for p in pools[1:]:
        every = every.unionByName(p.select("package"))
    return every.distinct().orderBy("package").limit(size)


def upsert(stored: DataFrame, fresh: DataFrame, keys: list[str], seq: str | None = None) -> DataFrame:
    """Stored rows of untouched packages, and the fresh rows (of equal keys the last) of the others.
    New columns are added, missing ones are null."""
    if seq:
        from chronolake.operators.series import keep_one

        fresh = keep_one(fresh, keys, [F.desc(seq)]).drop(seq)
    kept = stored.join(fresh.select("package").distinct(), "package", "left_anti")
    return kept.unionByName(fresh, allowMissingColumns=True)


def counted(failures: DataFrame, outcome: DataFrame) -> DataFrame:
    """Failure counters after a batch: one more on failure, gone on success."""
    o = outcome.select("package", "ok", "attempted")
    both = failures.join(o, "package", "full_outer")
    now = F.when(F.col("ok").isNull(), F.col("consecutive_failures")).when(~F.col("ok"), F.coalesce("consecutive_failures", F.lit(0)) + 1)
    at = F.when(F.col("ok").isNull(), F.col("last_attempt")).otherwise(F.col("attempted"))
    return both.select("package", now.cast("int").alias("consecutive_failures"), at.alias("last_attempt")).filter("consecutive_failures is not null")


def projected(stored: DataFrame, fresh: DataFrame, key: str, columns: list[str], authoritative: tuple[str, ...] = ()) -> DataFrame:
    """Narrow upsert: a fresh value wins unless it is null; an authoritative column is overwritten by
    the fresh row, null or not. A description hash that isn't authoritative is cleared whenever a title
    arrives, as it was another description's."""
    f = fresh.select(key, F.lit(True).alias("_in"), *(F.col(c).alias(f"_{c}") for c in columns))
    both = stored.join(f, key, "full_outer")
    out = []
    for c in columns:
        new = F.when(F.col("_in") & F.lit(c in authoritative), F.col(f"_{c}")).otherwise(F.coalesce(f"_{c}", c))
        if c == "description_hash" and c not in authoritative and "title" in columns:
            new = F.when(F.col("_title").isNull(), new)
        out.append(new.alias(c))
    return both.select(key, *out)


def to_harvest(rows: DataFrame, fetched: DataFrame) -> DataFrame:
    """Fetched rows worth writing: their package lacks a title, and their hash is new."""
    lacking = rows.filter("title is null").select("package")
    return fetched.join(lacking, "package", "left_semi").join(rows.select("package", "description_hash"), ["package", "description_hash"], "left_anti")


def is_complete(deferred: int, analysed: int, universe: int, permanent: int) -> bool:
    return deferred == 0 and analysed >= universe - permanent


def has_changed(forced: bool, fresh_rows: int, before: str | None, now: str) -> bool:
    return forced or fresh_rows > 0 or before != now

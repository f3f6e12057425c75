"""Bounded, ranked reports about what changed."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronolake.functions.text import strip


def within_budget(rows: DataFrame, order: list, text: str, room: int) -> DataFrame:
    """Rows, in order, while their bytes and a line end each stay within ``room``. Only the first
    ``room`` rows can fit (a row takes a byte at least), so no more are put in one order. Bytes are counted
    before that, so that texts go along only where they are asked for."""
    sized = rows.withColumn("_bytes", F.octet_length(F.coalesce(F.col(text), F.lit(""))) + 1)
    used = F.sum("_bytes").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return sized.orderBy(*order).limit(room).withColumn("bytes_used", used).drop("_bytes").filter(F.col("bytes_used") <= room)


def ranked(breaking: str, moved: str, size: str, name: str) -> list:
    """The order of changed packages: breaking first, then what moved most, then the largest."""
    return [F.coalesce(F.col(breaking).cast("int"), F.lit(0)).desc(), F.coalesce(F.col(moved), F.lit(0)).desc(), F.coalesce(F.col(size), F.lit(0)).desc(), F.col(name).asc()]


def top_with_rest(rows: DataFrame, order: list, k: int) -> DataFrame:
    """The first k rows with their rank, and how many more there are on each."""
    total = rows.agg(F.count("*").alias("_total"))
    top = rows.orderBy(*order).limit(k)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order))).crossJoin(total).withColumn("n_more", F.greatest(F.col("_total") - k, F.lit(0))).drop("_total")


def row_metrics(df: DataFrame) -> DataFrame:
    """n_functions from exports and internals (null only if both are); the fallback only where the table
    has neither column. n_deps, else counted from the raw text."""
    split = [F.col(c) for c in ("n_exports", "n_internal") if c in df.columns]
    total = sum((F.coalesce(c, F.lit(0)) for c in split), F.lit(0))
    functions = F.when(F.coalesce(*split).isNotNull(), total) if split else F.col("n_functions_fallback")
    counted = F.size(F.filter(F.transform(F.split("raw_deps", ","), strip), lambda x: (x != "") & ~x.rlike(r"^R\b(?!\.)")))
    return df.withColumn("n_functions", functions).withColumn("n_deps", F.coalesce("n_deps_direct", F.when(F.col("raw_deps").isNotNull(), counted)))


def dense_counts(keys: DataFrame, rows: DataFrame, key: str, name: str) -> DataFrame:
    """A count for every key, 0 where there are no rows."""
    return keys.join(rows.groupBy(key).agg(F.count("*").alias(name)), key, "left").withColumn(name, F.coalesce(name, F.lit(0)))


def change_summary(changed: DataFrame, seed: DataFrame, universe: int, analysed: int, batch: DataFrame | None = None) -> DataFrame:
    """One row: new and updated packages against the seed, percent processed, remaining; with the outcomes
    (package, ok) of the last batch, how many it had and how many failed."""
    c, s = changed.select("package").distinct(), seed.select("package").distinct().withColumn("_old", F.lit(True))
    both = c.join(s, "package", "left").agg(F.count_if(F.col("_old").isNull()).alias("n_new"), F.count_if(F.col("_old")).alias("n_updated"))
    percent = F.lit(100.0 * analysed / universe if universe else None).cast("double")
    both = both.withColumn("percent", F.floor(percent)).withColumn("remaining", F.lit(min(max(universe - analysed, 0), universe)).cast("bigint"))
    return both if batch is None else both.crossJoin(batch.agg(F.count_if(~F.coalesce("ok", F.lit(False))).alias("n_failed"), F.count("*").alias("n_batch")))  # one row each


def deltas(now: DataFrame, before: DataFrame) -> DataFrame:
    """field, value, change against the prior snapshot (null if either side is absent)."""
    return now.join(before.select("field", F.col("value").alias("_b")), "field", "left").select("field", "value", (F.col("value") - F.col("_b")).alias("change"))


def bounded_report(fixed: DataFrame, table: DataFrame, room: int) -> DataFrame:
    """section, line_no, text: the fixed sections take their bytes first, the ranked table gets what is
    left, then whole lines go from the end. Both have section, line_no, text."""
    taken = fixed.agg(F.coalesce(F.sum(F.octet_length("text") + 1), F.lit(0)).alias("b")).first().b
    order = [F.asc("section"), F.asc("line_no")]
    kept = within_budget(table, order, "text", max(0, room - taken)).drop("bytes_used")
    return within_budget(fixed.unionByName(kept), order, "text", room).drop("bytes_used")


def to_prune(tags: DataFrame, tag: str, keep: int) -> DataFrame:
    """Dated tags to delete: neither among the newest ``keep`` nor of the first of a month."""
    newest = tags.select(tag).distinct().orderBy(F.desc(tag)).limit(keep)
    return tags.select(tag).distinct().join(newest, tag, "left_anti").filter(~F.col(tag).rlike("-01$"))

"""The report about a batch of changed packages: a ranked table under a count and a byte budget.

Order and sizes come from prefix sums over ranges: rows are put in ranges by the report's order, each range is
added up, the sums of all ranges (a row for each) are put before each range's own running sums. No task
has more than a range, however many packages changed and however large the budget.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronolake.operators import report, series
from chronolake.sources.shared import written

#: The report's own words.
TITLE, NOTHING = "## Changed packages", "No package has changed."
HEADER = ("| Package | Version | Lines | Functions | Exports | API | Deps | Datasets |", "|---|---|--:|--:|--:|--:|--:|--:|")
BY_API, BY_SIZE = "Ordered by lost exports, then by how many exports moved.", "Ordered by size, as no change of exports is recorded."
CUT = "(shortened to fit)"


def running(rows: DataFrame, order: list[Column], size: Column, label: str = "report") -> DataFrame:
    """Adds nth (from 1) and used, the running sum of ``size``, in the given order over all rows, which
    must tell rows apart."""
    ranged = rows.withColumn("r_size", size.cast("long")).repartitionByRange(*order)
    ranged = written(ranged.withColumn("r_part", F.spark_partition_id()), label)
    sums = ranged.groupBy("r_part").agg(F.count("*").alias("r_n"), F.sum("r_size").alias("r_sum"))
    before = Window.orderBy("r_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    start = sums.select("r_part", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}0") for c in ("r_n", "r_sum")))
    own = Window.partitionBy("r_part").orderBy(*order)
    at = ranged.join(F.broadcast(start), "r_part")
    nth, used = F.row_number().over(own) + F.col("r_n0"), F.sum("r_size").over(own.rowsBetween(Window.unboundedPreceding, 0)) + F.col("r_sum0")
    return at.withColumn("nth", nth).withColumn("used", used).drop("r_part", "r_size", "r_n0", "r_sum0")


def line_bytes(text: str | Column) -> Column:
    """A line's bytes and those of its end."""
    return F.octet_length(F.col(text) if isinstance(text, str) else text) + 1


def number(c: Column) -> Column:
    """With thousands set apart, rounded; n/a for null."""
    return F.coalesce(F.format_number(F.bround(c), 0), F.lit("n/a"))


def moved(added: Column, removed: Column) -> Column:
    """+12/-3, - if nothing moved, n/a if it isn't known."""
    a, r = F.coalesce(added, F.lit(0)), F.coalesce(removed, F.lit(0))
    both = F.concat_ws("/", F.when(a > 0, F.concat(F.lit("+"), number(a))), F.when(r > 0, F.concat(F.lit("-"), number(r))))
    return F.when(added.isNull() & removed.isNull(), "n/a").when((a == 0) & (r == 0), "-").otherwise(both)


def changed_rows(changed: DataFrame, summary: DataFrame, seed: DataFrame, datasets: DataFrame | None = None) -> DataFrame:
    """A row for each changed package that ``summary`` has: its latest version, with ``new`` or the kind of
    step in brackets; size, functions, exports, what the release did to them, dependencies, and its
    number of rows in ``datasets`` (null without that table)."""
    keys = changed.select("package").distinct()
    latest = series.latest_ranked(summary.join(keys, "package", "left_semi"), "package", "marker", "version", "seq")
    for c, kind in (("loc", "double"), ("n_exports", "double"), ("api_added", "double"), ("api_removed", "double"), ("n_deps_direct", "double"), ("raw_deps", "string"), ("bump", "string"), ("n_functions_fallback", "double")):
        if c not in latest.columns:
            latest = latest.withColumn(c, F.lit(None).cast(kind))
    m = report.row_metrics(latest).join(seed.select("package").distinct().withColumn("known", F.lit(True)), "package", "left")
    tag = F.when(F.col("known").isNull(), "new").when(~F.coalesce("bump", F.lit("")).isin("", "initial"), F.col("bump"))
    m = m.withColumn("version", F.when(tag.isNull(), F.col("version")).otherwise(F.concat("version", F.lit(" ("), tag, F.lit(")"))))
    m = report.dense_counts(m, datasets, "package", "datasets") if datasets is not None else m.withColumn("datasets", F.lit(None).cast("bigint"))
    return m.select("package", "version", "loc", F.col("n_functions").alias("functions"), F.col("n_exports").alias("exports"), "api_added", "api_removed", F.col("n_deps").alias("deps"), "datasets")


def consequence() -> list[Column]:
    """The order of those rows: lost exports first, then by what moved, by size, by name."""
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    return [(z("api_removed") > 0).desc(), (z("api_removed") + z("api_added")).desc(), z("loc").desc(), F.col("package").asc()]


def row_text() -> Column:
    cells = [F.col("package").cast("string"), F.col("version").cast("string"), number(F.col("loc")), number(F.col("functions")), number(F.col("exports")), moved(F.col("api_added"), F.col("api_removed")), number(F.col("deps")), number(F.col("datasets"))]
    return F.concat(F.lit("| "), F.concat_ws(" | ", *(F.coalesce(c, F.lit("n/a")) for c in cells)), F.lit(" |"))


def rest_line(n: int) -> str:
    return f"| and {n:,} more | | | | | | | |"


def missing_line(n: int, of: int) -> str:
    return f"{n:,} of {of:,} changed packages have no row here."


def _lines(spark, texts: list[str], start: int = 0) -> DataFrame:
    return spark.createDataFrame([(start + i, t) for i, t in enumerate(texts)], "line_no long, text string")


def _bytes(texts: list[str]) -> int:
    return sum(len(t.encode()) + 1 for t in texts)


def prepared(rows: DataFrame) -> DataFrame:
    """The rows of ``changed_rows`` as lines with their ranks and running bytes, for any number of budgets."""
    return running(rows.withColumn("text", row_text()), consequence(), line_bytes("text"), "changes")


def bounded_table(lines: DataFrame, n_changed: int, cap: int, budget: int | None = None) -> DataFrame:
    """line_no, text: the table of ``prepared`` rows, in at most ``cap`` rows and ``budget`` bytes, its own
    lines included. What the closing row takes at its widest, and the line about changed packages without a
    row, is set aside before any row is admitted; rows that don't fit are counted in the closing row.
    The title, the header and these two lines stand even where the budget is less than they take."""
    spark = lines.sparkSession
    if not n_changed:
        return _lines(spark, [TITLE, "", NOTHING])
    n, known = lines.agg(F.count("*"), F.coalesce(F.bool_or(F.col("api_added").isNotNull() | F.col("api_removed").isNotNull()), F.lit(False))).first()
    missing = ["", missing_line(n_changed - n, n_changed)] if n_changed > n else []
    fixed = [TITLE, "", *([BY_API if known else BY_SIZE, ""] if n > 1 else []), *HEADER]
    if not n:
        return _lines(spark, [TITLE, "", *HEADER, *missing])
    fits = F.col("nth") <= cap
    if budget is not None:
        fits &= F.col("used") <= budget - _bytes(fixed) - _bytes([rest_line(n), *missing])
    shown = lines.filter(fits)
    left = n - shown.count()
    after = [*([rest_line(left)] if left else []), *missing]
    body = shown.select((F.col("nth") + (len(fixed) - 1)).alias("line_no"), "text")
    return _lines(spark, fixed).unionByName(body).unionByName(_lines(spark, after, len(fixed) + n))


def fitted(lines: DataFrame, budget: int, marker: str = CUT) -> DataFrame:
    """Lines (line_no, text) within ``budget`` bytes: whole lines go from the end and a marker tells of
    it, whose bytes are counted too. Where not even the marker fits, as much of it as does."""
    spark = lines.sparkSession
    own = running(lines, [F.col("line_no").asc()], line_bytes("text"), "lines")
    n, total, last = own.agg(F.count("*"), F.coalesce(F.max("used"), F.lit(0)), F.max("line_no")).first()
    if total <= budget:
        return own.select("line_no", "text")
    room = budget - _bytes([marker])
    if room < 0:
        cut = marker.encode()[: max(0, budget - 1)].decode("utf-8", "ignore")
        return _lines(spark, [cut], last + 1)
    return own.filter(F.col("used") <= room).select("line_no", "text").unionByName(_lines(spark, [marker], last + 1))


def headline(summary: DataFrame) -> DataFrame:
    """The first lines, from a row of ``report.change_summary``."""
    first = F.concat(number(F.col("n_new")), F.lit(" new, "), number(F.col("n_updated")), F.lit(" updated, "), number(F.col("percent")), F.lit(" % done, "), number(F.col("remaining")), F.lit(" to do."))
    failed = F.when(F.col("n_failed") > 0, F.concat(number(F.col("n_failed")), F.lit(" of the "), number(F.col("n_batch")), F.lit(" packages of the last batch failed.")))
    each = F.array_compact(F.array(first, failed))
    return summary.select(F.posexplode(each)).select(F.col("pos").cast("long").alias("line_no"), F.col("col").alias("text"))


def whole_report(top: DataFrame, lines: DataFrame, n_changed: int, foot: DataFrame, cap: int, budget: int) -> DataFrame:
    """section, line_no, text: ``top``, the table of ``prepared`` lines and ``foot`` (line_no, text), an empty line
    between them, in ``budget`` bytes: the table gets what the others leave, then lines go from the end."""
    taken = top.unionByName(foot).agg(F.coalesce(F.sum(line_bytes("text")), F.lit(0))).first()[0] + 2
    table = bounded_table(lines, n_changed, cap, budget - taken)
    blank = _lines(top.sparkSession, [""])
    parts = [df.withColumn("section", F.lit(i)) for i, df in enumerate((top, blank, table, blank, foot))]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    wide = 1 << 40  # more than any section has lines
    kept = fitted(every.select((F.col("section") * F.lit(wide) + F.col("line_no")).alias("line_no"), "text"), budget)
    return kept.select(F.expr(f"line_no div {wide}").alias("section"), (F.col("line_no") % wide).alias("line_no"), "text")

"""Rules over the files of a snapshot, as data: a rule is a column, a set of rules one aggregation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronolake.functions.text import lines

KEYS = ["package", "version"]


@dataclass(frozen=True)
class Rule:
    """Counts matches of ``pattern`` in files whose path matches ``path``: ``unit`` is occurrences,
    lines (that match, and don't match ``unless``) or files. Files must match ``where``, if given, and
    have at most ``most_bytes``."""

    name: str
    path: str
    pattern: str
    unit: str = "occurrences"
    weight: int = 1
    where: str | None = None
    unless: str | None = None
    most_bytes: int | None = None
    source: str = "content"

    def column(self) -> Column:
        text = F.col(self.source)
        if self.unit == "occurrences":
            n = F.regexp_count(text, F.lit(self.pattern))
        elif self.unit == "lines":
            n = F.size(F.filter(F.col(f"_lines_{self.source}"), lambda x: x.rlike(self.pattern) & (~x.rlike(self.unless) if self.unless else F.lit(True))))
        elif self.unit == "files":
            n = text.rlike(self.pattern).cast("int")
        else:
            raise ValueError(f"unit {self.unit}")
        counted = F.col("path").rlike(self.path)
        if self.most_bytes is not None:  # before the pattern is tried
            counted = counted & (F.octet_length(text) <= self.most_bytes)
        if self.where:
            counted = counted & text.rlike(self.where)
        return F.when(counted, n * self.weight).otherwise(0)


def apply(files: DataFrame, rules: list[Rule], keys: list[str] | None = None) -> DataFrame:
    """One row per snapshot with the sum of each rule's counts; rules of one name are added up. All
    patterns run in one pass over the files."""
    keys = keys or KEYS
    names = list(dict.fromkeys(r.name for r in rules))
    for source in sorted({r.source for r in rules if r.unit == "lines"}):  # cut to lines once for all rules
        files = files.withColumn(f"_lines_{source}", lines(source))
    each = files.select(*keys, *(sum((r.column() for r in rules if r.name == n), F.lit(0)).cast("bigint").alias(n) for n in names))
    return each.groupBy(*keys).agg(*(F.sum(n).alias(n) for n in names))


_metrics: dict = {}


def register_metric(name: str, function) -> None:
    """Adds a group of metrics: a function from files (package, version, path, content) to a DataFrame
    with one row per snapshot."""
    _metrics[name] = function


def all_metrics(files: DataFrame, failed: dict[str, Exception] | None = None) -> DataFrame:
    """The metrics of every registered group, side by side; null where a group has no row. Where
    ``failed`` is given, a group whose plan can't be made goes there with its error, and the others are
    kept; otherwise the error is raised."""
    out = files.select(*KEYS).distinct()
    for name in sorted(_metrics):
        try:
            own = _metrics[name](files)
        except Exception as e:
            if failed is None:
                raise
            failed[name] = e
            continue
        out = out.join(own, KEYS, "left")
    return out

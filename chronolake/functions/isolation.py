"""Groups of metrics whose failure on one snapshot is that snapshot's alone.

A group that fails for a snapshot gives null for all its metrics there, and its error in the column
``.error.<group>`` (null where all went well); every other snapshot and group has its results. There are two kinds:

* a parser, a small function of one file's text, with a fold of what the files gave. Its errors are caught where they
  happen, in the task, and travel beside the results as rows.
* a plan, any function from files to a row per snapshot. An error in a task of it ends the job, so the snapshots are
  then halved by a hash, each half run by itself, down to the snapshots that fail; those that don't fail alone (an executor
  was lost, say) have results. More than ``most`` failing snapshots are an error of the group, and raised.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

import pandas as pd
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronolake.functions.rules import KEYS
from chronolake.sources.shared import written

ERROR = ".error."


@dataclass(frozen=True)
class Parser:
    """``parse``: text of a file -> tuples of ``schema`` (DDL); ``fold``: those rows, with the snapshot's keys and
    path, -> a row per snapshot; ``path``: which files are read."""

    name: str
    parse: Callable[[str], Iterable[tuple]]
    schema: str
    fold: Callable[[DataFrame], DataFrame]
    path: str = ""


@dataclass(frozen=True)
class Plan:
    """``run``: files -> a row per snapshot."""

    name: str
    run: Callable[[DataFrame], DataFrame]


def _said(e: BaseException) -> str:
    return f"{type(e).__name__}: {e}".split("\n", 1)[0][:500]


def guarded(files: DataFrame, parser: Parser, keys: list[str]) -> DataFrame:
    """keys, path, the parser's columns, and ``error``: what each file gave, or a row with its error alone."""
    names = [x.split()[0] for x in parser.schema.split(", ")]
    kinds = ", ".join(f"{n} {t}" for n, t in files.select(*keys, "path").dtypes)
    parse = parser.parse

    def run(frames):
        for f in frames:
            out = []
            for *own, content in f.itertuples(index=False, name=None):
                try:
                    out += [(*own, *row, None) for row in list(parse(content or ""))]
                except Exception as e:  # whatever the parser raises is this file's own
                    out.append((*own, *([None] * len(names)), _said(e)))
            yield pd.DataFrame(out, columns=[*keys, "path", *names, "error"]).astype(object)

    some = files.filter(F.col("path").rlike(parser.path)) if parser.path else files
    return some.select(*keys, "path", "content").mapInPandas(run, f"{kinds}, {parser.schema}, error string")


def _parsed(files: DataFrame, parser: Parser, keys: list[str]) -> DataFrame:
    rows = written(guarded(files, parser, keys), f"parsed-{parser.name}")
    failed = rows.filter("error is not null").groupBy(*keys).agg(F.min(F.struct("path", "error")).alias("e"))
    failed = failed.select(*keys, F.concat_ws(": ", "e.path", "e.error").alias(ERROR + parser.name))
    good = rows.filter("error is null").drop("error").join(failed, keys, "left_anti")
    return parser.fold(good).join(failed, keys, "full_outer")


def _run(files: DataFrame, plan: Plan, keys: list[str], most: int) -> DataFrame:
    """A plan's rows, over all snapshots at once or, where it fails, over ever smaller parts."""
    spark, column = files.sparkSession, ERROR + plan.name
    kinds = {n: t for n, t in plan.run(files).dtypes}
    place = F.pmod(F.xxhash64(*keys), F.lit(1 << 32))
    good, bad = [], []

    def part(low: int, high: int) -> None:
        own = files if (low, high) == (0, 1 << 32) else files.filter((place >= low) & (place < high))
        try:
            good.append(written(plan.run(own), f"metrics-{plan.name}"))
            return
        except PySparkException as e:
            error = e
        first = own.agg(F.min(F.struct(*keys)).alias("a"), F.max(F.struct(*keys)).alias("b")).first()
        if first.a == first.b or high - low == 1:
            bad.append((tuple(first.a), error))
            if len(bad) > most:
                raise error
            return
        middle = (low + high) // 2
        part(low, middle)
        part(middle, high)

    part(0, 1 << 32)
    out = None
    for df in good:
        out = df if out is None else out.unionByName(df)
    types = ", ".join(f"{k} {kinds[k]}" for k in keys)
    errors = spark.createDataFrame([(*k, _cause(e)) for k, e in bad], f"{types}, `{column}` string")
    return errors if out is None else out.join(errors, keys, "full_outer")


def _cause(e: PySparkException) -> str:
    """The line of a task's error that says what went wrong."""
    lines = [x.strip() for x in str(e).split("\n") if x.strip()]
    return next((x for x in lines if x.startswith("[") or "Error" in x or "Exception" in x), lines[0] if lines else type(e).__name__)[:500]


def measured(files: DataFrame, groups: list[Parser | Plan], keys: list[str] | None = None, most: int = 100) -> DataFrame:
    """A row for each snapshot of ``files`` (keys, path, content): the metrics of all groups and their errors."""
    keys = keys or KEYS
    out = files.select(*keys).distinct()
    for g in groups:
        out = out.join(_parsed(files, g, keys) if isinstance(g, Parser) else _run(files, g, keys, most), keys, "left")
    return out

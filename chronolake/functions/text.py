"""Text helpers as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def line_count(content: Column | str) -> Column:
    """Lines of a text; one final newline begins no further line, an empty text has none."""
    c = F.col(content) if isinstance(content, str) else content
    return F.when(F.coalesce(c, F.lit("")) == "", 0).otherwise(F.size(F.split(c, "\n", -1)) - F.when(c.endswith("\n"), 1).otherwise(0)).cast("bigint")


def lines(content: Column | str) -> Column:
    """The same lines as an array."""
    c = F.col(content) if isinstance(content, str) else content
    return F.when(F.coalesce(c, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split(F.regexp_replace(c, r"\n\z", ""), "\n", -1))


def basename(path: Column | str) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def extension(path: Column | str) -> Column:
    """Lower-case extension of the file name; null if there is none."""
    found = F.regexp_extract(basename(path), r"^.+\.([^.]+)$", 1)
    return F.when(found != "", F.lower(found))


def blank_to_null(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.trim(c) != "", c)


def ratio(part: Column, whole: Column) -> Column:
    """Null where there is nothing to divide by."""
    return part.cast("double") / F.when(whole != 0, whole.cast("double"))


def or_empty(array: Column | str, of: str = "string") -> Column:
    a = F.col(array) if isinstance(array, str) else array
    return F.coalesce(a, F.array().cast(f"array<{of}>"))


def json_set(text: Column | str) -> Column:
    """Distinct strings of a JSON array; nothing for null, blank or bad text."""
    return F.array_distinct(or_empty(F.from_json(text, "array<string>")))


def words(c: Column | str) -> Column:
    """Entries of a list in text, split at commas, trimmed, without blanks."""
    return F.filter(F.transform(F.split(c, ","), strip), lambda x: x != "")

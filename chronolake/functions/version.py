"""Version strings as columns: components, sortable keys, kinds of bumps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def triple(version: Column | str) -> Column:
    """array<bigint> of major, minor, patch. A part that is missing or no integer is 0; a null or
    blank version has null parts."""
    v = F.col(version) if isinstance(version, str) else version
    parts = F.split(F.trim(v), r"[._-]")
    part = lambda i: F.coalesce(F.get(parts, F.lit(i)).try_cast("bigint"), F.lit(0).cast("bigint"))
    return F.when(F.trim(v) != "", F.array(part(0), part(1), part(2))).otherwise(F.array(*[F.lit(None).cast("bigint")] * 3))


def padded_key(version: Column | str) -> Column:
    """Text that orders versions: dashes are dots, every run of digits is padded with zeros to ten (of a longer one the
    last ten count). Null for a null version."""
    v = F.col(version) if isinstance(version, str) else version
    padded = F.regexp_replace(F.replace(v, F.lit("-"), F.lit(".")), "([0-9]++)", "000000000$1")
    return F.regexp_replace(padded, "0*([0-9]{10})", "$1")


def sort_key(version: Column | str) -> Column:
    """array<bigint> that orders versions by number: digits between dots and dashes; what isn't a
    number sorts first. Null for a null version."""
    v = F.col(version) if isinstance(version, str) else version
    return F.transform(F.split(v, r"[.-]"), lambda p: F.coalesce(p.try_cast("bigint"), F.lit(-1).cast("bigint")))


def numeric_key(version: Column | str) -> Column:
    """As sort_key, but null for a version that isn't all numbers."""
    v = F.col(version) if isinstance(version, str) else version
    return F.when(v.rlike(r"^[0-9]+(?:[.-][0-9]+)*$"), sort_key(v))


def bump(now: Column, before: Column, is_first: Column) -> Column:
    """initial, major, minor, patch or other, by the first component that grew. Components are
    compared one by one: 2.0 to 1.9 is a minor bump."""
    grew = lambda i: F.get(now, F.lit(i)) > F.get(before, F.lit(i))
    return F.when(is_first, "initial").when(grew(0), "major").when(grew(1), "minor").when(grew(2), "patch").otherwise("other")

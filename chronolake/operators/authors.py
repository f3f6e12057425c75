"""Author lists as JSON text, exploded, and the spans over which authors stay with a package."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronolake.functions.version import padded_key

AUTHORS = "array<struct<given:string,family:string,roles:array<string>>>"


def exploded(df: DataFrame, authors: str) -> DataFrame:
    """A row per author of each row: given, family, author_key (lower case, trimmed). Each distinct
    text is parsed once. Bad JSON gives no rows; an author without a name is left out."""
    text = df.select(F.col(authors).alias("_text")).filter("_text is not null").distinct()
    parsed = text.select("_text", F.explode(F.from_json("_text", AUTHORS)).alias("_a"))
    part = lambda c: F.lower(F.trim(F.coalesce(F.col(f"_a.{c}"), F.lit(""))))
    parsed = parsed.select("_text", F.col("_a.given").alias("given"), F.col("_a.family").alias("family"), F.concat_ws(" ", part("given"), part("family")).alias("author_key"))
    parsed = parsed.filter(F.trim("author_key") != "")
    return df.join(parsed, F.col(authors) == F.col("_text")).drop("_text")


def spans(rows: DataFrame, author: str, package: str, released: str, version: str, display: list[str]) -> DataFrame:
    """Per author and package: first and last version, their dates, the number of versions, and the
    latest display columns. Versions are ordered by date (missing last), number, text."""
    once = rows.dropDuplicates([author, package, version]) if not display else rows
    order = F.struct(F.col(released).isNull(), F.col(released), padded_key(version), F.col(version))
    return once.groupBy(author, package).agg(
        F.min_by(version, order).alias("first_version"),
        F.min_by(released, order).alias("first_seen"),
        F.max_by(version, order).alias("last_version"),
        F.max_by(released, order).alias("last_seen"),
        F.countDistinct(version).alias("n_versions"),
        *(F.max_by(c, order).alias(c) for c in display),
    )


def added_later(rows: DataFrame, author: str, package: str, seq: str) -> DataFrame:
    """Per package: distinct authors of later versions that the first version doesn't have."""
    first = rows.groupBy(package, author).agg(F.min(seq).alias("_from"))
    start = rows.groupBy(package).agg(F.min(seq).alias("_start"))
    return first.join(start, package).groupBy(package).agg(F.count_if(F.col("_from") > F.col("_start")).alias("authors_added_later"))

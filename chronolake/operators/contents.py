"""Content-addressed normalisation: many versions of an entity, few distinct contents.

Content ids are hashes of the key, so they need no sequence and come out the same on every run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronolake.operators.series import keep_one

KEY = ["content_fp", "schema_fp", "fp_algo_version"]


def eligible(records: DataFrame) -> DataFrame:
    """Records with a content fingerprint; a missing schema fingerprint is ''."""
    return records.filter("content_fp is not null and content_fp <> ''").withColumn("schema_fp", F.coalesce("schema_fp", F.lit("")))


def collapsed(records: DataFrame, keys: list[str]) -> DataFrame:
    """One record for each of ``keys`` (package, name, version): exported ones first, then by arrival."""
    return keep_one(records, keys, [F.coalesce("internal", F.lit(False)).asc(), F.col("seq").asc()])


def with_content_id(records: DataFrame) -> DataFrame:
    return records.withColumn("content_id", F.sha2(F.concat_ws("|", *(F.col(c).cast("string") for c in KEY)), 256))


def new_contents(records: DataFrame, stored: DataFrame, columns: list[str]) -> DataFrame:
    """Contents to insert: one per key, none that is stored. ``columns`` are taken from the first."""
    first = records.groupBy(*KEY).agg(*(F.min_by(c, "seq").alias(c) for c in columns))
    return with_content_id(first).join(stored.select(*KEY), KEY, "left_anti")


def sketches(records: DataFrame, sketch: str) -> DataFrame:
    """One sketch per content: the first that isn't null."""
    some = with_content_id(records).filter(F.col(sketch).isNotNull())
    return some.groupBy("content_id").agg(F.min_by(sketch, "seq").alias(sketch))


def links(records: DataFrame, keys: list[str]) -> DataFrame:
    """Which content each version of an entity has."""
    return with_content_id(records).select(*keys, "content_id")


def identities(records: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Entities of current versions."""
    return records.filter("is_current").select(*keys, *columns)


def referenced(contents: DataFrame, links: DataFrame) -> DataFrame:
    """Contents (or sketches) that some link still names; the others are garbage."""
    return contents.join(links.select("content_id").distinct(), "content_id", "left_semi")


def normalized(records: DataFrame, stored: DataFrame, keys: list[str], columns: list[str], sketch: str) -> dict[str, DataFrame]:
    """The four tables from a batch of records and the stored contents."""
    own = collapsed(eligible(records), keys)
    link = links(own, keys)
    every = stored.unionByName(new_contents(own, stored, columns), allowMissingColumns=True)
    return {"contents": referenced(every, link), "links": link, "identities": identities(own, keys, columns), "sketches": sketches(own, sketch)}

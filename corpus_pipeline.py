"""A corpus pipeline: each stage reads all that the one before it kept.

Stages take (spark, docs, sf_dir) and return a DataFrame; all but the last return the columns of
``documents``, the fourth also each document's place in the mix. Between stages the rows are written as
Parquet into the shared folder and reread. Empty tables give empty results, repeated rows and null doc_ids
are rows like any other unless a stage says otherwise, texts of any length are read whole, and extra
columns pass through to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chronolake.llm import common, langid, mixing, packing, pii, simhash


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no language is recognised (no text, no letters, or undecided) go. A null lang is
    no reason to go; of equally probable languages the first in order wins."""
    return langid.keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies (five-word shingles, similarity 0.8) stays: that
    with the smallest doc_id; of rows that repeat it, that with the smallest hash of its text, once. A null
    doc_id only stays where all of a component are null. Texts without words are copies of each other."""
    return simhash.keep_one(docs, simhash.near_copies(docs))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts becomes its kind in angle brackets; of overlapping spans the first names
    the whole. A null text stays null, and n_chars is counted anew where it is given."""
    return pii.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their places in the order in which the schedule interleaves their sources, a
    column that the next stage goes by; rows stay where they are. Null sources are one source. Equal rows
    take their places in any order."""
    return mixing.placed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces, each with its sequence and place; sequences in the order of the mix. A
    null text is its end token alone."""
    return packing.pack(docs, order=mixing.AT)


STAGES = [("language ID", language), ("near-dedup", near_dedup), ("PII", personal_data), ("mixing", mix), ("packing", pack)]

#: No SQL has the model of the first stage, the hashes of the second or the token ids of the last; the
#: stages are tested together against a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.staged(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)

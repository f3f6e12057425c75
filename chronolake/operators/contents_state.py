"""Content-addressed tables kept over batches: contents inserted once, links replaced, garbage collected.

The state is a ``Store`` of four tables. A batch of records replaces the links and identities of its packages; contents (keyed by
fingerprint, schema and the generation of the fingerprint) are inserted where the store hasn't them, in batches and over batches, and
the row that is there wins. Only buckets that a batch's keys fall in are read; inserts add files and rewrite none. A new
generation makes new contents; those of the old one go when no link names them any more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolake.operators import contents
from chronolake.sources.shared import written
from chronolake.sources.store import Store

#: What each kind of column says of a record, with declared types (fixed values): of the data itself, of how a version
#: stored it, of where it was found.
CONTENT = {
    "class": "string", "kind": "string", "nrow": "bigint", "ncol": "bigint", "length": "bigint", "n_cols": "bigint", "n_unique": "bigint", "n_missing_total": "bigint", "columns": "string",
    "has_rownames": "bigint", "shape_fp": "string", "dim": "string", "n_dim": "bigint", "has_dimnames": "bigint", "n_stored": "bigint", "n_cells": "bigint", "density": "double",
    "matrix_value_type": "string", "matrix_shape": "string", "matrix_storage": "string", "matrix_uplo": "string", "matrix_diag": "string", "ts_start": "double", "ts_end": "double",
    "ts_frequency": "double", "frequency": "double", "index_start": "string", "index_end": "string", "index_n": "bigint", "index_class": "string", "geom_type": "string", "is_geometry": "bigint",
    "n_geometries": "bigint", "is_spatial": "bigint", "crs_input": "string", "crs_epsg": "bigint", "crs_wkt": "string", "bbox": "string", "n_layers": "bigint", "object_system": "string",
    "s4_package": "string", "label": "string", "comment": "string", "units": "string", "attrs_other": "string",
}
LINK = {"format_version": "bigint", "compressed_bytes": "bigint", "notes": "string"}
ORIGIN = {"origin_dir": "string"}
KEYS = {"contents": "content_id", "sketches": "content_id", "links": "package", "identities": "package"}


def open_state(spark: SparkSession, path: str, buckets: int = 16) -> Store:
    return Store(spark, path, KEYS, buckets)


def _new(store: Store, table: str, rows: DataFrame) -> DataFrame:
    """Rows whose content_id the store hasn't, looked for in their own buckets."""
    old = store.read(table, store.touched(rows, table))
    return rows if old is None else rows.join(old.select("content_id"), "content_id", "left_anti")


def ingest(store: Store, batch: str, records: DataFrame, keys: list[str], columns: list[str], sketch: str) -> bool:
    """Takes a batch of records (package, version, seq, internal, is_current, the content's key, ``columns`` of contents and
    links, ``sketch``). ``keys`` tell the records of a batch apart, package first. False where it has been taken before."""
    if store.has(batch):
        return False
    own = written(contents.collapsed(contents.eligible(records), keys), "records")
    by_role = {c: columns_of(c) for c in columns}
    of = lambda role: [c for c, r in by_role.items() if r == role]
    first = own.groupBy(*contents.KEY).agg(*(F.min_by(c, "seq").alias(c) for c in of("content")), F.min("seq").alias("seq"))
    made = _new(store, "contents", written(contents.with_content_id(first), "contents"))
    sketched = _new(store, "sketches", written(contents.sketches(own, sketch), "sketches"))
    links = contents.with_content_id(own).select(*keys, "content_id", *of("link"))
    names = contents.identities(own, keys, of("origin"))
    writes = [("contents", made, []), ("sketches", sketched, [])]
    for table, fresh in (("links", links), ("identities", names)):  # every row of the batch's packages goes
        over = store.touched(own, table)
        old = store.read(table, over)
        if old is not None:
            fresh = old.join(own.select("package").distinct(), "package", "left_anti").unionByName(fresh, allowMissingColumns=True)
        writes.append((table, fresh, over))
    return store.commit(batch, writes)


def columns_of(name: str) -> str:
    """The role of a column; one that isn't declared describes the content."""
    return "link" if name in LINK else "origin" if name in ORIGIN else "content"


def collect(store: Store, batch: str) -> int:
    """Removes contents and sketches that no link names; how many contents. Only buckets with garbage are rewritten."""
    links = store.read("links")
    writes, gone = [], 0
    for table in ("contents", "sketches"):
        rows = store.read(table)
        if rows is None:
            continue
        live = rows.limit(0).select("content_id") if links is None else links.select("content_id").distinct()
        dead = written(rows.join(live, "content_id", "left_anti").select("content_id"), "garbage")
        over = store.touched(dead, table)
        if over:
            gone += dead.count() if table == "contents" else 0
            writes.append((table, store.read(table, over).join(live, "content_id", "left_semi"), over))
    if writes:
        store.commit(batch, writes)
    return gone

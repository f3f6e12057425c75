"""Snapshot quality: fingerprints, manifests, coverage, alerts, retention, audits."""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType

from chronolake.functions.text import ratio


BLOCK = 1 << 18


def fingerprint(df: DataFrame, package: str, version: str) -> DataFrame:
    """One digest of all (package, version) pairs in order of the pair; pairs with a null are left out. Pairs are sorted in
    ranges, each range writes its text in blocks, and one task, which SHA-256 can't do without, reads the blocks one after
    the other: it sees text only, and holds a block at a time."""
    pair = F.concat(F.col(package).cast("string"), F.lit(":"), F.col(version).cast("string"))
    order = [F.col(package), F.col(version)]
    ranged = df.select(package, version, pair.alias("pair")).filter("pair is not null").repartitionByRange(*order).withColumn("part", F.spark_partition_id())

    def blocks(batches):
        held, size, nth, part = [], 0, 0, None
        for batch in batches:
            for p, x in zip(batch["part"].to_pylist(), batch["pair"].to_pylist(), strict=True):
                part = p
                held.append(x)
                size += len(x)
                if size >= BLOCK:
                    yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([nth], pa.int64()), pa.array([",".join(held)])], names=["part", "nth", "block"])
                    held, size, nth = [], 0, nth + 1
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([nth], pa.int64()), pa.array([",".join(held)])], names=["part", "nth", "block"])

    def digest(batches):
        sha, first = hashlib.sha256(), True
        for batch in batches:
            for x in batch["block"]:
                sha.update(b"" if first else b",")
                sha.update(x.as_py().encode())
                first = False
        yield pa.RecordBatch.from_arrays([pa.array([sha.hexdigest()])], names=["fingerprint"])

    texts = ranged.sortWithinPartitions(*order).select("part", "pair").mapInArrow(blocks, "part int, nth long, block string")
    one = texts.repartition(1).sortWithinPartitions("part", "nth").select("block").mapInArrow(digest, "fingerprint string")
    return one.agg(F.coalesce(F.max("fingerprint"), F.sha2(F.lit(""), 256)).alias("fingerprint"))


def fingerprint_by_parts(df: DataFrame, package: str, version: str, digits: int = 3) -> DataFrame:
    """A digest that no task sees the whole of, another value than ``fingerprint``: each package's versions are
    digested, then the packages of each part, which is named by the first ``digits`` hexadecimal digits of
    the package's own digest, then the parts."""
    p = F.col(package).cast("string")
    digest = lambda c: F.sha2(F.array_join(F.sort_array(F.collect_list(c)), ","), 256)
    own = df.groupBy(p.alias("_p")).agg(digest(F.col(version).cast("string")).alias("d"))
    part = own.groupBy(F.substring(F.md5("_p"), 1, digits).alias("_part")).agg(digest(F.concat("_p", F.lit(":"), "d")).alias("d"))
    return part.agg(digest(F.concat("_part", F.lit(":"), "d")).alias("fingerprint"))


def counts(tables: dict[str, DataFrame], package: str = "package") -> DataFrame:
    """table_name, n_rows, n_packages (null where a table has no such column)."""
    each = [t.agg(F.lit(n).alias("table_name"), F.count("*").alias("n_rows"), (F.countDistinct(package) if package in t.columns else F.lit(None).cast("bigint")).alias("n_packages")) for n, t in tables.items()]
    return reduce(DataFrame.unionByName, each)


def distinct_sketches(df: DataFrame, key: str, buckets: int = 64, log_k: int = 16) -> DataFrame:
    """bucket, n_rows, sketch: of each bucket of keys a sketch of how many different ones it has. The sketches are kept with the
    manifest; buckets are parted by key, so they merge, and one that changed is replaced alone."""
    k = F.col(key).cast("string")
    return df.groupBy(F.pmod(F.xxhash64(k), F.lit(buckets)).cast("int").alias("bucket")).agg(F.count("*").alias("n_rows"), F.hll_sketch_agg(k, F.lit(log_k)).alias("sketch"))


def refreshed_sketches(stored: DataFrame, changed: DataFrame, key: str, touched: list[int], buckets: int = 64, log_k: int = 16) -> DataFrame:
    """The stored sketches, those of the ``touched`` buckets made anew from ``changed`` (all rows of these buckets); no row
    of the others is read."""
    return stored.filter(~F.col("bucket").isin(touched)).unionByName(distinct_sketches(changed, key, buckets, log_k))


def distinct_estimate(sketches: DataFrame) -> DataFrame:
    """One row: n_rows, n_distinct (estimated, within 2 % at the default size) of all buckets together."""
    merged = sketches.agg(F.sum("n_rows").alias("n_rows"), F.hll_union_agg("sketch").alias("s"))
    return merged.select(F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.coalesce(F.hll_sketch_estimate("s"), F.lit(0)).alias("n_distinct"))


def stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """metric, mean, median of numeric columns without their nulls; null for the others and for columns
    that aren't there."""
    kind = {f.name: f.dataType for f in df.schema}
    numeric = [c for c in columns if isinstance(kind.get(c), NumericType)]
    none = F.lit(None).cast("double")
    wide = df.agg(F.count("*").alias("_n"), *(x for c in numeric for x in (F.avg(c).alias(f"a_{c}"), F.median(c).alias(f"m_{c}"))))
    rows = F.array(*(F.struct(F.lit(c).alias("metric"), (F.col(f"a_{c}") if c in numeric else none).alias("mean"), (F.col(f"m_{c}") if c in numeric else none).cast("double").alias("median")) for c in columns))
    return wide.select(F.explode(rows).alias("s")).select("s.*")


def manifest(tables: dict[str, DataFrame], keyed: DataFrame, package: str, version: str, columns: list[str], bootstrap: DataFrame | None = None) -> DataFrame:
    """One row of JSON: counts per table, statistics, fingerprint (by parts), and the first pass's progress, where it is given
    (``progress``)."""
    c = counts(tables, package).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("table_name", F.struct("n_rows", "n_packages"))))).alias("tables"))
    s = stats(keyed, columns).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("metric", F.struct("mean", "median"))))).alias("stats"))
    one = c.crossJoin(s).crossJoin(fingerprint_by_parts(keyed, package, version))  # one row each
    parts = ["tables", "stats", "fingerprint"]
    if bootstrap is not None:
        one, parts = one.crossJoin(bootstrap.select(F.struct(*bootstrap.columns).alias("bootstrap"))), [*parts, "bootstrap"]  # one row each
    return one.select(F.to_json(F.struct(*parts)).alias("manifest"))


def progress(universe: DataFrame, analysed: DataFrame, permanent: DataFrame, deferred: int = 0) -> DataFrame:
    """One row on a first pass over the universe: n_universe, n_analyzed (of it), n_permanent, n_remaining (not below 0), and
    whether it is complete: nothing put off, and all but permanent failures analysed."""
    u = universe.select("package").distinct()
    flag = lambda df, name: df.select("package").distinct().withColumn(name, F.lit(True))
    both = u.join(flag(analysed, "a"), "package", "left").join(flag(permanent, "p"), "package", "left")
    n = both.agg(F.count("*").alias("n_universe"), F.count("a").alias("n_analyzed"), F.count("p").alias("n_permanent"), F.count_if(F.col("a").isNull() & F.col("p").isNull()).alias("n_remaining"))
    done = F.lit(deferred == 0) & (F.col("n_analyzed") >= F.col("n_universe") - F.col("n_permanent"))
    return n.withColumn("n_deferred", F.lit(deferred)).withColumn("bootstrap_complete", done)


def coverage(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """metric, n_rows, measured (not null), positive (flags only), kind: one pass over the table. A
    flag is boolean, or numeric with nothing but 0, 1 and null."""
    kind = {f.name: f.dataType for f in df.schema}
    columns = columns or df.columns
    agg, rows = [F.count("*").alias("n_rows")], []
    for i, c in enumerate(columns):
        v = F.col(c)
        agg.append(F.count(v).alias(f"m{i}"))
        if isinstance(kind[c], BooleanType):
            flag = F.lit(True)
            agg.append(F.count_if(v).alias(f"p{i}"))
        elif isinstance(kind[c], NumericType):
            agg += [F.count_if(v == 1).alias(f"p{i}"), F.coalesce(F.bool_and(v.isin(0, 1)), F.lit(True)).alias(f"f{i}")]
            flag = F.col(f"f{i}")
        else:
            flag = F.lit(False)
        positive = F.when(flag, F.col(f"p{i}")) if not isinstance(kind[c], BooleanType) and isinstance(kind[c], NumericType) else (F.col(f"p{i}") if isinstance(kind[c], BooleanType) else F.lit(None).cast("bigint"))
        rows.append(F.struct(F.lit(c).alias("metric"), F.col("n_rows"), F.col(f"m{i}").alias("measured"), positive.alias("positive"), F.when(flag, "flag").otherwise("value").alias("kind")))
    return df.agg(*agg).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def coverage_alerts(now: DataFrame, before: DataFrame, floor: int = 100, share: float = 0.5) -> DataFrame:
    """metric, alert: never measured; a flag true for none; or measured, or positive, fallen below a
    share of what it was, where that was more than ``floor``."""
    b = before.select("metric", F.col("measured").alias("measured_before"), F.col("positive").alias("positive_before"))
    df = now.join(b, "metric", "left")
    alerts = F.array(
        F.when(F.col("measured") == 0, "never measured"),
        F.when((F.col("kind") == "flag") & (F.col("measured") > 0) & (F.col("positive") == 0), "true for none"),
        F.when((F.col("measured_before") > floor) & (F.col("measured") < F.col("measured_before") * share), "measured fell"),
        F.when((F.col("positive_before") > floor) & (F.col("positive") < F.col("positive_before") * share), "positive fell"),
    )
    return df.select("metric", F.explode(F.array_compact(alerts)).alias("alert"))


def retention(now: DataFrame, before: DataFrame, thresholds: DataFrame, rebuild: bool = False) -> DataFrame:
    """Violations: figures (field, value) below the floor least(before * ratio, before - allowance). A
    figure not recorded before is skipped, one missing now counts as 0; a rebuild is exempt."""
    df = before.select("field", F.col("value").alias("prior")).filter("prior is not null").join(thresholds, "field").join(now, "field", "left")
    df = df.withColumn("value", F.coalesce("value", F.lit(0))).withColumn("floor", F.least(F.col("prior") * F.col("ratio"), F.col("prior") - F.col("allowance")))
    return df.filter((F.col("value") < F.col("floor")) & F.lit(not rebuild)).select("field", "prior", "value", "floor")


def consistency(n_api: int, n_summary: int, n_versions: int) -> list[str]:
    """Warnings where the three row counts of a snapshot differ."""
    said = {"api": n_api, "summary": n_summary, "versions": n_versions}
    return [] if len(set(said.values())) == 1 else [", ".join(f"{k} {v}" for k, v in said.items())]


def audit(tables: dict[str, DataFrame], recorded: DataFrame) -> DataFrame:
    """table_name, recorded, measured, verdict of what a manifest said of a snapshot's tables: fewer
    rows than recorded are a violation, more a note; a table that isn't there counts as empty."""
    measured = counts(tables).select("table_name", F.col("n_rows").alias("measured"))
    df = recorded.join(measured, "table_name", "left").withColumn("measured", F.coalesce("measured", F.lit(0)))
    verdict = F.when(F.col("measured") < F.col("recorded"), "violation").when(F.col("measured") > F.col("recorded"), "note").otherwise("ok")
    return df.select("table_name", "recorded", "measured", verdict.alias("verdict"))


def baseline(tables: dict[str, DataFrame], manifest: DataFrame | None) -> DataFrame | None:
    """Recorded counts, or those measured from the tables where there is no manifest; none if all of
    them are empty. Never replaces a manifest."""
    if manifest is not None:
        return manifest
    derived = counts(tables).select(F.col("table_name").alias("field"), F.col("n_rows").alias("value"))
    return derived if derived.filter("value > 0").limit(1).count() else None


def preflight(series: dict[str, tuple[dict[str, DataFrame], DataFrame]]) -> DataFrame:
    """The audits of several series (tables, recorded counts), less what is in order."""
    each = [audit(t, r).withColumn("series", F.lit(n)) for n, (t, r) in series.items()]
    return reduce(DataFrame.unionByName, each).filter("verdict <> 'ok'")


def share_measured(df: DataFrame, by: str, columns: list[str]) -> DataFrame:
    """Per group: share of rows in which each column is measured."""
    return df.groupBy(by).agg(*(ratio(F.count(c), F.count("*")).alias(f"share_{c}") for c in columns))

"""Sources and sinks: snapshots of files, tags, change logs, analyzer records, result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructType

from chronolake.functions.parse import renamed
from chronolake.sources.files import files as archive_files

FILES = "package string, version string, released date, path string, content string"
TAG = r"^(?:R-)?[0-9]"


def corpus(spark: SparkSession, path: str, pattern: str = "") -> DataFrame:
    """Files below ``path``/package/version/ as the table ``files``, with their bytes (content_bytes): all of them, empty and
    hidden ones too, or those whose path ``pattern`` is found in, before any is opened. The text is without a final newline."""
    raw = archive_files(spark, path, pattern)
    text = F.regexp_replace(F.col("content_bytes").cast("string"), r"\n\z", "")
    return raw.select("package", "version", "path", text.alias("content"), "content_bytes")


def find(files: DataFrame, pattern: str) -> DataFrame:
    return files.filter(F.col("path").rlike(pattern))


def version_tags(tags: DataFrame, seq: str = "seq") -> DataFrame:
    """package, tag, date, commit, seq -> version list: tags that begin with a digit (after ``R-``);
    ordered by date, missing last; one version per commit (the first), one commit per version (the
    last)."""
    t = tags.filter(F.col("tag").rlike(TAG)).withColumn("version", F.regexp_replace("tag", "^R-", ""))
    order = [F.col("date").asc_nulls_last(), F.col(seq).asc()]
    t = t.withColumn("nth", F.row_number().over(Window.partitionBy("package").orderBy(*order)))
    t = t.withColumn("a", F.row_number().over(Window.partitionBy("package", "commit").orderBy("nth"))).filter("a = 1")
    t = t.withColumn("b", F.row_number().over(Window.partitionBy("package", "version").orderBy(F.desc("nth")))).filter("b = 1")
    return t.select("package", "version", "date", "commit", "nth")


def change_log(log: DataFrame) -> DataFrame:
    """package, line_no, line of a log -> commit, version, file, added, deleted. A header
    ``__C__sha<tab>date<tab>subject`` holds for the lines after it; the version is the first in the
    subject; ``-`` counts are null; lines of fewer than three fields are skipped."""
    w = Window.partitionBy("package").orderBy("line_no")
    head = F.when(F.col("line").startswith("__C__"), F.split(F.expr("substring(line, 6)"), "\t"))
    df = log.withColumn("head", F.last(head, ignorenulls=True).over(w)).filter(~F.col("line").startswith("__C__") & F.col("head").isNotNull())
    p = F.split("line", "\t")
    version = F.nullif(F.regexp_extract(F.get("head", F.lit(2)), r"[0-9]+[._-][0-9]+(?:[._-][0-9]+)*", 0), F.lit(""))
    number = lambda i: F.get(p, F.lit(i)).try_cast("int")
    return df.filter(F.size(p) >= 3).select("package", F.get("head", F.lit(0)).alias("commit"), version.alias("version"), renamed(F.get(p, F.lit(2))).alias("file"), number(0).alias("added"), number(1).alias("deleted"))


def analyzer_records(lines: DataFrame, schemas: dict[str, str], keys: list[str]) -> dict[str, DataFrame]:
    """(keys, line_no, line) of NDJSON -> a table per record tag. Of ``summary`` the first of each key
    counts; other tags and lines that aren't JSON are dropped."""
    tagged = lines.withColumn("rec", F.get_json_object("line", "$.rec"))
    out = {}
    for tag, schema in schemas.items():
        rows = tagged.filter(F.col("rec") == tag)
        if tag == "summary":
            rows = rows.groupBy(*keys).agg(F.min_by("line", "line_no").alias("line"), F.min("line_no").alias("line_no"))
        out[tag] = rows.select(*keys, "line_no", F.from_json("line", schema).alias("r")).select(*keys, "line_no", "r.*")
    return out


def flattened(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text; scalars stay."""
    nested = ("array", "struct", "map")
    return df.select(*(F.to_json(c).alias(c) if t.startswith(nested) else F.col(c) for c, t in df.dtypes))


def open_records(lines: DataFrame, base: StructType, nested: str = "columns", most_keys: int = 10_000) -> DataFrame:
    """NDJSON records with whatever keys they have. A column is boolean, bigint or double if all its
    values are, else text (nested values as JSON); base columns are always there; n_cols is the length
    of ``nested``. Only the names and kinds of the keys go through the driver;
    more than ``most_keys`` are an error."""
    rows = lines.select(F.from_json("line", "map<string,string>").alias("m")).filter("m is not null")
    each = rows.select(F.explode("m").alias("k", "v")).filter("v is not null")
    is_a = lambda p: F.bool_and(F.col("v").rlike(p))
    kinds = each.groupBy("k").agg(is_a("^(true|false)$").alias("boolean"), is_a(r"^-?[0-9]{1,18}$").alias("bigint"), is_a(r"^-?[0-9]+(\.[0-9]+)?([eE][-+]?[0-9]+)?$").alias("double"))
    kinds = kinds.orderBy("k").limit(most_keys + 1).collect()
    if len(kinds) > most_keys:
        raise ValueError(f"records with more than {most_keys} keys")
    found = {r.k: next((t for t in ("boolean", "bigint", "double") if r[t]), "string") for r in kinds}
    columns = [F.element_at("m", k).cast(t).alias(k) for k, t in found.items()]
    columns += [F.lit(None).cast(f.dataType).alias(f.name) for f in base if f.name not in found]
    if nested in found:
        columns.append(F.size(F.from_json(F.element_at("m", nested), "array<string>")).alias("n_cols"))
    return rows.select(*columns)


def present(df: DataFrame, wanted: list[str]) -> DataFrame:
    """The wanted columns that there are."""
    return df.select(*(c for c in wanted if c in df.columns))


def with_int_flags(df: DataFrame) -> DataFrame:
    """Booleans as 0 and 1."""
    return df.select(*(F.col(f.name).cast("int").alias(f.name) if isinstance(f.dataType, BooleanType) else F.col(f.name) for f in df.schema))


def write_table(df: DataFrame, path: str, package: str = "package", buckets: int = 64) -> None:
    """A fresh table, partitioned by a bucket of the package so that upserts replace whole parts."""
    df.withColumn("bucket", F.pmod(F.xxhash64(package), F.lit(buckets)).cast("int")).write.mode("overwrite").partitionBy("bucket").parquet(path)


def append_table(df: DataFrame, path: str, package: str = "package", buckets: int = 64) -> None:
    """Appends rows; columns that are new become null in what is there."""
    df.withColumn("bucket", F.pmod(F.xxhash64(package), F.lit(buckets)).cast("int")).write.mode("append").partitionBy("bucket").parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path).drop("bucket")


def replace_packages(spark: SparkSession, path: str, fresh: DataFrame, keys: list[str], seq: str | None = None, package: str = "package", buckets: int = 64) -> None:
    """Upsert on disk: rewrites only the buckets that the fresh packages fall in, by way of a staged
    copy next to the table (a table can't be overwritten while it is read), which goes in the end. A run that fails between is
    to be done again; where readers must never see half of it, or several tables change together, see ``sources.store``."""
    from chronolake.operators.incremental import upsert

    bucket = F.pmod(F.xxhash64(package), F.lit(buckets)).cast("int")
    touched = fresh.select(bucket.alias("bucket")).distinct()
    stored = spark.read.option("mergeSchema", "true").parquet(path).join(F.broadcast(touched), "bucket", "left_semi").drop("bucket")  # at most `buckets` rows
    staged = f"{path.rstrip('/')}__staged"
    upsert(stored, fresh, keys, seq).withColumn("bucket", bucket).write.mode("overwrite").partitionBy("bucket").parquet(staged)
    done = spark.read.parquet(staged)
    done.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)
    gone = spark._jvm.org.apache.hadoop.fs.Path(staged)
    gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)


def write_manifest(manifest: DataFrame, path: str) -> None:
    manifest.coalesce(1).write.mode("overwrite").text(path)  # one row


def read_manifest(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """The manifest as one row, or None where there is none or it can't be parsed."""
    from pyspark.errors import AnalysisException

    try:
        raw = spark.read.text(path, wholetext=True)
    except AnalysisException:
        return None
    row = raw.select(F.from_json("value", schema).alias("m")).filter("m is not null").select("m.*")
    return row if row.limit(1).count() else None


def accumulated(keys: DataFrame, more: DataFrame, key: str) -> DataFrame:
    """Keys of both, each once, in order, without the empty one."""
    return keys.select(key).union(more.select(key)).filter(F.col(key) != "").distinct().orderBy(key)


def fetched(rows: DataFrame, keys: DataFrame, key: str = "package") -> DataFrame:
    """All rows whose key is in the set."""
    return rows.join(keys.select(key).distinct(), key, "left_semi")

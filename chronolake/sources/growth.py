"""Tables that grow by columns and by types: appended rows may bring new columns, and columns of another type.

Types widen along boolean -> bigint -> double -> string; anything else is text (nested values as JSON). An append goes to the
folder of its own shape (its columns and their types), of which there are few; a reader takes the shapes' schemas, the widest
type of each column, casts each shape's columns to it and puts the rows together. Declared types win: a column declared
as a number stays one whatever its first rows were, values that can't be it are null.
"""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DecimalType, FractionalType, IntegralType, StringType

LATTICE = ("boolean", "bigint", "double", "string")


def kind(t: DataType) -> str:
    """The type's place in the lattice."""
    if isinstance(t, BooleanType):
        return "boolean"
    if isinstance(t, IntegralType):
        return "bigint"
    return "double" if isinstance(t, (FractionalType, DecimalType)) else "string"


def widest(kinds: list[str]) -> str:
    return LATTICE[max(LATTICE.index(k) for k in kinds)]


def _as(df: DataFrame, name: str, to: str) -> Column:
    t, c = df.schema[name].dataType, F.col(f"`{name}`")
    own = kind(t)
    if own == "string" and not isinstance(t, StringType):
        c = F.to_json(c) if t.typeName() in ("array", "struct", "map", "variant") else c.cast("string")
    if own == "boolean" and to == "string":
        c = c.cast("int")  # as a number, so that 0 and 1 read the same however the column grew
    return c.try_cast(to).alias(name)


def append(df: DataFrame, path: str, by: str = "package", buckets: int = 64) -> None:
    """Adds rows. Flags are kept as such; a column that is null throughout has a type like any other."""
    own = df.select(*(_as(df, c, kind(df.schema[c].dataType)) for c in df.columns))
    shape = hashlib.sha256(",".join(f"{n}:{t}" for n, t in sorted(own.dtypes)).encode()).hexdigest()[:16]
    own.withColumn("bucket", F.pmod(F.xxhash64(by), F.lit(buckets)).cast("int")).write.mode("append").partitionBy("bucket").parquet(f"{path}/shape={shape}")


def shapes(spark: SparkSession, path: str) -> list[DataFrame]:
    """The rows of each shape, in order of their folders."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    found = sorted(s.getPath().toString() for s in fs.listStatus(root) if s.getPath().getName().startswith("shape="))
    return [spark.read.parquet(p).drop("bucket") for p in found]


def read(spark: SparkSession, path: str, declared: dict[str, str] | None = None) -> DataFrame:
    """All rows; each column in the widest of its types, or the declared one; declared columns are always there."""
    own = shapes(spark, path)
    if not own:
        raise FileNotFoundError(path)
    types: dict[str, str] = {}
    for df in own:
        for f in df.schema:
            types[f.name] = widest([types.get(f.name, LATTICE[0]), kind(f.dataType)])
    types |= declared or {}
    none = lambda c: F.lit(None).cast(types[c]).alias(c)
    return reduce(DataFrame.unionByName, [df.select(*(_as(df, c, types[c]) if c in df.columns else none(c) for c in types)) for df in own])


def with_declared(df: DataFrame, declared: dict[str, str]) -> DataFrame:
    """The declared columns in their types (missing ones null, values that don't fit null), then the others as they are."""
    own = [_as(df, c, t) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in declared.items()]
    return df.select(*own, *(F.col(f"`{c}`") for c in df.columns if c not in declared))

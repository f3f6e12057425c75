"""Document fingerprints by a threshold-scaled sketch.

A text's shingles (five words, lower case, split at white space; a shorter text is one shingle) are
hashed to 64 bits; the sketch keeps every distinct hash in the lowest 1/``SCALE`` of the range. The
threshold is fixed, so sketches of parts merge by union and sketches of very unequal texts compare:
|A and B| / |A| estimates how much of A is contained in B. The sketch of texts taken together is the
union of theirs, always. A text whose hashes all lie above the threshold, a short one as a rule, has an
empty sketch and there is nothing to estimate from; how much of it another text contains is then counted
from all hashes of the two, which are worked out for such texts alone. Its written fingerprint is ``all:``
and all its hashes.

Everything is built from SQL functions. A document's successor is found with one shuffle: doc_ids are
cut into ranges at percentiles of all of them, each range is ordered on its own, and the rows at the
head of a range are also sent to the range before it. A doc_id that very many rows have is cut further by
the hashes of their texts; rows that are equal in both stay together.

Nulls and ties: a null text counts as empty; a text without words is contained wholly in another such
one and not at all in any other. A null doc_id stands before all others; rows that repeat a doc_id
are ordered by the hash of their text. A single row is its own successor. Very long texts are hashed whole,
within their row. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronolake.llm import common

SCALE, WORDS = 8, 5
FIRST = -(1 << 63)


def with_sketch(df: DataFrame, text: str, sketch: str, words: int = WORDS, scale: int = SCALE, all_if_none: str | None = None) -> DataFrame:
    """Adds ``sketch``: the sorted kept hashes (array of long) of the column ``text`` (not null); and
    ``all_if_none``: all its hashes where none is kept, else none.

    Arrays that a lambda reads are columns of their own, and read twice, so that the optimizer
    doesn't compute them again for each element."""
    w, h, k = f"{sketch}_w", f"{sketch}_h", f"{sketch}_k"
    df = df.withColumn(w, F.expr(f"transform(filter(split(lower({text}), '\\\\s+'), x -> x <> ''), x -> xxhash64(x))"))
    gram = ", ".join(f"get({w}, i + {j})" for j in range(words))
    whole = f"array(aggregate({w}, 0L, (a, x) -> xxhash64(a, x)))"
    df = df.withColumn(h, F.expr(f"case when size({w}) >= {words} then transform(sequence(0, size({w}) - {words}), i -> xxhash64({gram})) when size({w}) > 0 then {whole} else cast(array() as array<bigint>) end"))
    below = f"shiftrightunsigned(x, {64 - int(math.log2(scale))}) = 0" if scale > 1 else "true"
    df = df.withColumn(k, F.expr(f"filter({h}, x -> {below})"))
    df = df.withColumn(sketch, F.expr(f"if(size({k}) > 0, array_sort(array_distinct({k})), {k})"))
    if all_if_none:
        df = df.withColumn(all_if_none, F.expr(f"if(size({k}) > 0, cast(array() as array<bigint>), array_sort(array_distinct({h})))"))
    return df.drop(w, h, k)


def containment(a: str, b: str, all_a: str | None = None, all_b: str | None = None) -> Column:
    """Estimated share of a's shingles that b has; null without an estimate, unless ``all_a`` and ``all_b``
    have all hashes of both for that case."""
    share = lambda x, y: f"size(array_intersect({x}, {y})) / double(size({x}))"
    none = f"case when size({all_a}) > 0 then {share(all_a, all_b)} when size({all_b}) > 0 then 0D else 1D end" if all_a else "cast(null as double)"
    return F.expr(f"if(size({a}) > 0, {share(a, b)}, {none})")


def jaccard(a: str, b: str, all_a: str | None = None, all_b: str | None = None) -> Column:
    """Estimated Jaccard similarity; where both sketches are empty as for ``containment``."""
    share = lambda x, y: f"size(array_intersect({x}, {y})) / double(size(array_union({x}, {y})))"
    none = f"if(size({all_a}) + size({all_b}) = 0, 1D, {share(all_a, all_b)})" if all_a else "cast(null as double)"
    return F.expr(f"if(size({a}) + size({b}) > 0, {share(a, b)}, {none})")


def merged(df: DataFrame, by: str, sketch: str) -> DataFrame:
    """The sketch of each group's texts taken together: the union of their sketches."""
    return df.select(by, F.explode(sketch).alias("x")).distinct().groupBy(by).agg(F.array_sort(F.collect_list("x")).alias(sketch))


def _in_ranges(df: DataFrame, order: str, tie: str, cuts: list[tuple[int, int]]) -> DataFrame:
    """Adds r_range, the number of the last of the sorted cuts that isn't above the row's (order, tie),
    and r_head: does the row equal that cut? Cuts are looked up in two steps."""
    side = math.isqrt(len(cuts) - 1) + 1
    pair = lambda own: F.array(*(F.struct(F.lit(c).alias("c"), F.lit(t).alias("t")) for c, t in own))
    outer, inner = pair(cuts[::side]), F.array(*(pair(cuts[i : i + side]) for i in range(0, len(cuts), side)))
    below = "x -> x.c < r_at or x.c = r_at and x.t <= r_tie"
    at = df.withColumn("r_at", F.col(order)).withColumn("r_tie", F.col(tie)).withColumn("r_outer", outer)
    at = at.withColumn("r_block", F.expr(f"greatest(size(filter(r_outer, {below})) - 1, 0)")).withColumn("r_inner", F.get(inner, F.col("r_block")))
    at = at.withColumn("r_range", F.col("r_block") * side + F.expr(f"greatest(size(filter(r_inner, {below})) - 1, 0)"))
    return at.withColumn("r_head", F.expr("exists(r_inner, x -> x.c = r_at and x.t = r_tie)")).drop("r_at", "r_tie", "r_outer", "r_block", "r_inner")


def with_next(df: DataFrame, order: str, tie: str, carried: list[str], rows_a_range: int = 2000, most: int = 65536) -> DataFrame:
    """Adds next_<c> for each of ``carried``: its value in the next row by (order, tie), both longs
    without nulls; the last row gets the first row's. ``most`` bounds the number of ranges."""
    spark = df.sparkSession
    keys = df.select(order, tie)
    n = keys.count()
    if not n:
        return df.select("*", *(F.col(c).alias(f"next_{c}") for c in carried))
    want = min(most, max(n // rows_a_range, min(n // 8, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))) + 1)
    cuts = keys.agg(F.percentile_approx(order, [i / want for i in range(1, want)] or [0.0], max(10000, 4 * want)).alias("cuts")).first()["cuts"]
    times = Counter(cuts)
    near = [(c, FIRST) for c in times]
    hot = sorted(c for c, k in times.items() if k > 1)  # values that fill more than a range are cut by their ties, which are hashes
    near += [(c, FIRST + (i << 64) // times[c]) for c in hot for i in range(1, times[c])]
    # percentiles are near: what ranges there are, and with which row each begins
    heads = _in_ranges(keys, order, tie, sorted(near)).groupBy("r_range").agg(F.min(F.struct(order, tie)).alias("low")).collect()
    cuts = sorted(tuple(r.low) for r in heads)
    at = _in_ranges(df, order, tie, cuts)
    own = F.struct(F.col("r_range").alias("to"), F.lit(False).alias("ghost"))
    both = F.when(F.col("r_head"), F.array(own, F.struct(F.expr(f"if(r_range = 0, {len(cuts) - 1}, r_range - 1)").alias("to"), F.lit(True).alias("ghost")))).otherwise(F.array(own))
    dealt = at.select(*df.columns, F.explode(both).alias("r")).select(*df.columns, "r.to", "r.ghost")
    w = Window.partitionBy("to").orderBy("ghost", order, tie)
    return dealt.select("*", *(F.lead(c).over(w).alias(f"next_{c}") for c in carried)).filter("not ghost").drop("to", "ghost")


def fingerprints(docs: DataFrame) -> DataFrame:
    """For each row: doc_id, n_chars, edited (text), and of the text (no prefix), the edited text and the
    next text (not written where no hash is needed) the sketch, and all hashes where the text's own
    sketch is empty."""
    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_or_empty().alias("text"))
    df = df.withColumn("at", F.coalesce("doc_id", F.lit(FIRST))).withColumn("tie", F.xxhash64("text")).withColumn("n_chars", F.length("text").cast("long"))
    df = with_next(with_sketch(df, "text", "sketch", all_if_none="hashes"), "at", "tie", ["text", "sketch"])
    half = "int(n_chars div 2)"
    df = df.withColumn("edited", F.expr(f"concat(substr(text, 1, int(n_chars) - {half}), substr(next_text, 1, {half}))"))
    df = with_sketch(df, "edited", "edited_sketch", all_if_none="edited_none")
    # for a text without a sketch, the whole sets of what it is compared with
    for name, text in (("edited_hashes", "edited"), ("next_hashes", "next_text")):
        df = with_sketch(df.withColumn("asked", F.when(F.size("sketch") == 0, F.col(text)).otherwise("")), "asked", name, scale=1)
    return df.drop("text", "next_text", "asked")


def written(sketch: str, hashes: str) -> Column:
    """The sketch in hexadecimal digits, or all hashes where it is empty."""
    hexed = lambda x: f"array_join(transform({x}, x -> lower(lpad(hex(x), 16, '0'))), ',')"
    return F.expr(f"if(size({sketch}) > 0 or size({hashes}) = 0, {hexed(sketch)}, concat('all:', {hexed(hashes)}))")


def op3_fingerprints(spark, sf_dir: str) -> DataFrame:
    df = fingerprints(common.table(spark, sf_dir, "documents"))
    return df.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        written("sketch", "hashes").alias("fingerprint"),
        written("edited_sketch", "edited_none").alias("edited_fingerprint"),
        containment("sketch", "edited_sketch", "hashes", "edited_hashes").alias("near_edited"),
        containment("sketch", "next_sketch", "hashes", "next_hashes").alias("near_next"),
        jaccard("sketch", "edited_sketch", "hashes", "edited_hashes").alias("jaccard_edited"),
    )

"""Repeated passages by sparse suffix arrays.

Every passage of ``WORDS`` words or more (split at white space) that stands in more than one place of
the corpus is found, with its full extent in every place. Texts that are equal as a whole are folded into
one first. Of all suffixes only those are kept that begin at a minimiser: the first smallest of the
hashes of ``GRAM``-word runs in a window of ``WORDS`` words. Equal windows have their minimiser at the
same place, so what repeats has a kept suffix in common. The kept suffixes are sorted by their leading
words, in ranges over all tasks, and compared with their neighbours; those without a like neighbour are
out. From the others the match is extended to the left and to the right, window by window: a kept suffix
stands for the windows whose minimiser it is, up to ``WORDS`` - ``GRAM`` words to its left, and a window
belongs to the match as long as another place has its equal. What the repeated windows cover, joined where
they overlap, is a repeated passage.

Texts are read twice and shuffled once at most. The first time, every row gives its kept suffixes; equal
texts are folded by what they gave. The second time, a row that stands for its text and has a like
neighbour goes to its places. Which rows these are is told to the tasks by a bit map of at most ``BITS``
bits, whatever the size of the table: a row that it lets through without need only meets no places.

A window is known by 128 bits made from 128-bit hashes of its words. Equal windows have equal leads, so a
kept suffix travels once with all its windows to those with its lead. A lead that very many places have
(``many_places``) is kept from that: there all windows are sorted with their places in ranges, which cut a
group of equal windows up, so that a passage which very many texts share costs no more than its places.

Of equal windows, the one with the smallest (doc_id, place) is the first (in each row that has them);
``later`` passages are those covered by windows that aren't.

Nulls: a null or short text has no passages. A null doc_id comes before all others. Rows that repeat
both doc_id and text are places of their own and have equal results. A text may have any length; it is
read as a whole. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronolake.llm import common

WORDS, GRAM = 50, 8
BITS, MANY = 1 << 28, 1 << 16
_BASES = [np.uint64(0x9E3779B97F4A7C15 | 1), np.uint64(0xD6E8FEB86659FD93)]
_BACKS = [np.uint64(pow(int(b), -1, 1 << 64)) for b in _BASES]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    if n:
        p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


def _runs(words: np.ndarray, k: int, forth: np.ndarray, back: np.ndarray) -> np.ndarray:
    """Hash of each run of k words."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * back[: len(words)], dtype=np.uint64)))
    return _mixed((total[k:] - total[:n]) * forth[:n])


def _least(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each run of w values."""
    n = len(x) - w + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    pad = np.concatenate((x, np.full(-len(x) % w, np.iinfo(np.uint64).max, np.uint64))).reshape(-1, w)
    left = np.minimum.accumulate(pad, axis=1).ravel()
    right = np.minimum.accumulate(pad[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[w - 1 : w - 1 + n])


class Batch:
    """Texts as one array of word hashes, with their windows and minimisers."""

    def __init__(self, texts: list[str | None], words: int, gram: int, with_windows: bool):
        each = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts]
        self.sizes = np.array([len(w) for w in each], np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)))[: len(each)]
        h, n = xxhash.xxh3_128_digest, int(self.sizes.sum())
        hashes = np.frombuffer(b"".join([h(w) for own in each for w in own]), np.uint64).reshape(n, 2)
        forth, back = zip(*((_powers(f, n), _powers(b, n)) for f, b in zip(_BASES, _BACKS, strict=True)), strict=True)
        self.grams = _runs(hashes[:, 0], gram, forth[0], back[0])
        n_windows = max(0, n - words + 1)
        # where each window's minimiser is: the least place in the order of (hash, place)
        order = np.argsort(self.grams, kind="stable")
        rank = np.empty(len(order), np.uint64)
        rank[order] = np.arange(len(order), dtype=np.uint64)
        self.anchor = order[_least(rank, words - gram + 1).astype(np.int64)]
        self.windows = [_runs(hashes[:, k], words, forth[k], back[k]) for k in (0, 1)] if with_windows else None
        self.doc = np.repeat(np.arange(len(each)), self.sizes)[:n_windows]
        self.whole = np.arange(n_windows) + words <= (self.starts + self.sizes)[self.doc]

    def lists(self, at: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """For sorted places in the array: offsets of each text's, and the places in their texts."""
        of = np.searchsorted(self.starts, at, side="right") - 1
        # empty texts begin where the next text does: the last of equal starts has the words
        return pa.array(np.searchsorted(of, np.arange(len(self.sizes) + 1)).astype(np.int32)), (at - self.starts[of]).astype(np.int32)


def _batches(batch: pa.RecordBatch, words: int, gram: int, with_windows: bool, most: int = 1 << 22):
    """(first row, its part) of parts of a batch that have about ``most`` bytes at most (a longer text is
    a part alone)."""
    texts = batch["text"].to_pylist()
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end] or "") <= most):
            size += len(texts[end] or "")
            end += 1
        yield at, Batch(texts[at:end], words, gram, with_windows)
        at = end


def kept_suffixes(rows: DataFrame, words: int, gram: int) -> DataFrame:
    """A row for each text of ``rows`` (tid, doc_id, text): tid, rows (how many have it), low (their smallest
    doc_id), n_words, and the places and leading words (a hash) of its kept suffixes."""

    def work(batches):
        for batch in batches:
            for at, b in _batches(batch, words, gram, False):
                kept = np.unique(b.anchor[b.whole])
                offsets, place = b.lists(kept)
                columns = [batch[c].slice(at, len(b.sizes)) for c in ("tid", "doc_id")]
                columns += [pa.array(b.sizes), pa.ListArray.from_arrays(offsets, pa.array(place)), pa.ListArray.from_arrays(offsets, pa.array(b.grams[kept].view(np.int64)))]
                yield pa.RecordBatch.from_arrays(columns, names=["tid", "doc_id", "n_words", "places", "leads"])

    found = rows.mapInArrow(work, "tid binary, doc_id long, n_words long, places array<int>, leads array<bigint>")
    low = F.min(F.struct(F.col("doc_id").isNotNull().alias("some"), "doc_id"))
    found = found.groupBy("tid").agg(F.count("*").alias("rows"), low.alias("low"), *(F.first(c).alias(c) for c in ("n_words", "places", "leads")))
    return found.withColumn("low", F.col("low.doc_id"))


ALIKE, OPEN, EDGE = 0, 1, 2


def with_neighbours(suffixes: DataFrame) -> DataFrame:
    """lead, short (of tid) and place of the kept suffixes that a neighbour in the sorted array is like.

    The array is cut into ranges, so that what very many suffixes begin with is cut up too. A range also
    tells the leads at its two ends; a suffix there that is like none in its range is like one of another
    range if that tells the same lead."""
    spark = suffixes.sparkSession
    rows = suffixes.select(F.xxhash64("tid").alias("short"), F.explode(F.arrays_zip("places", "leads")).alias("s")).select(F.col("s.leads").alias("lead"), "short", F.col("s.places").alias("place"))
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    array = rows.repartitionByRange(ranges, "lead", "short", "place").sortWithinPartitions("lead")

    def work(batches):
        part, held, first = TaskContext.get().partitionId(), None, True
        names = ["kind", "part", "lead", "short", "place"]

        def out(batch, kind):
            n = batch.num_rows
            return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, np.int32)), pa.array(np.full(n, part, np.int32)), batch["lead"], batch["short"], batch["place"]], names=names)

        def compared(batch, before, after):
            """Of the rows with a lead before and one after, those like a neighbour; the rest at the ends."""
            lead = batch["lead"].to_numpy(zero_copy_only=False)
            same = lead[1:] == lead[:-1]
            alike = np.concatenate(([before is not None and before == lead[0]], same)) | np.concatenate((same, [after is not None and after == lead[-1]]))
            yield out(batch.filter(pa.array(alike)), ALIKE)
            ends = np.zeros(len(lead), bool)
            ends[0], ends[-1] = before is None, after is None
            yield out(batch.filter(pa.array(ends & ~alike)), OPEN)
            yield out(batch.filter(pa.array(ends)), EDGE)

        before = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                yield from compared(held, before, batch["lead"][0].as_py())
                before = held["lead"][held.num_rows - 1].as_py()
            held, first = batch, False
        if held is not None:
            yield from compared(held, before, None)

    found = common.staged(array.mapInArrow(work, "kind int, part int, lead long, short long, place int"), "suffix-array")
    edges = found.filter(F.col("kind") == EDGE).select("lead", "part").distinct().groupBy("lead").count().filter("count > 1").select("lead")  # two for each range at most
    alike = found.filter(F.col("kind") == ALIKE).unionByName(found.filter(F.col("kind") == OPEN).join(F.broadcast(edges), "lead", "left_semi"))
    return alike.select("lead", "short", "place")


def many_places(alike: DataFrame) -> DataFrame:
    """The leads that more than 1 / 2^14 of all places have, and more than ``MANY``: fewer than 2^14."""
    counts = alike.groupBy("lead").agg(F.count("*").alias("n"))
    total = alike.count()
    return common.staged(counts.filter(F.col("n") > max(MANY, total >> 14)).select("lead"), "suffix-many")


def _reached(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """The ``rows`` (tid, some, id) whose bit ``keys`` has set in a bit map with 16 bits for each of the keys,
    and ``BITS`` at most: all rows whose key is among them, and few others."""
    bits = min(BITS, 1 << max(15, (16 * keys.count()).bit_length()))
    bit = F.pmod(F.xxhash64("tid", "some", "id"), F.lit(bits))
    at = lambda df: df.withColumn("bit", bit).withColumn("bucket", F.bitmap_bucket_number("bit"))
    buckets = at(keys).groupBy("bucket").agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("map"))
    place = F.bitmap_bit_position("bit")
    byte = F.conv(F.hex(F.substring("map", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = at(rows).join(F.broadcast(buckets), "bucket").filter(byte.bitwiseAND(F.expr("shiftleft(1, cast(bitmap_bit_position(bit) % 8 as int))")) != 0)
    return found.select(*rows.columns)


def extended(texts: DataFrame, places: DataFrame, words: int, gram: int) -> DataFrame:
    """lead, short (of tid), low, start, first and second for each of a text's ``places`` (tid, some, id, places):
    its lead, and the start and the hashes (two lists) of the windows in a row whose minimiser it is.
    ``texts`` has tid, some, id and text; of those that repeat all these, one counts."""

    def work(batches):
        for batch in batches:
            for at, b in _batches(batch, words, gram, True):
                own = np.zeros(int(b.sizes.sum()) + 1, bool)
                for i, at_words in enumerate(batch["places"].slice(at, len(b.sizes)).to_pylist()):
                    at_words = np.array(at_words, np.int64)
                    own[b.starts[i] + at_words[at_words < b.sizes[i]]] = True
                chosen = np.flatnonzero(b.whole & own[b.anchor])
                if not len(chosen):
                    continue
                # windows in a row with one minimiser
                new = np.flatnonzero(np.concatenate(([True], (np.diff(chosen) > 1) | (np.diff(b.anchor[chosen]) != 0))))
                head = chosen[new]
                of = pa.array(b.doc[head] + at)
                offsets = pa.array(np.append(new, len(chosen)).astype(np.int32))
                columns = [pa.array(b.grams[b.anchor[head]].view(np.int64)), batch["short"].take(of), batch["low"].take(of), pa.array((head - b.starts[b.doc[head]]).astype(np.int32))]
                columns += [pa.ListArray.from_arrays(offsets, pa.array(x[chosen].view(np.int64))) for x in b.windows]
                yield pa.RecordBatch.from_arrays(columns, names=["lead", "short", "low", "start", "first", "second"])

    key = ["tid", "some", "id"]
    rows = _reached(texts, places.select(*key)).dropDuplicates(key).join(places, key)
    rows = rows.select(F.xxhash64("tid").alias("short"), F.when(F.col("some"), F.col("id")).alias("low"), "text", "places")
    return rows.mapInArrow(work, "lead long, short long, low long, start int, first array<bigint>, second array<bigint>")


def _windows(runs: DataFrame) -> DataFrame:
    """A row for each window."""
    each = runs.select("lead", "short", "low", "start", F.posexplode(F.arrays_zip("first", "second")).alias("k", "w"))
    return each.select("lead", "short", "low", (F.col("start") + F.col("k")).cast("int").alias("start"), F.col("w.first").alias("w1"), F.col("w.second").alias("w2"))


def _place():
    return F.struct(F.col("low").isNotNull().alias("some"), "low", "start")


def repeated(runs: DataFrame) -> DataFrame:
    """short, low, start and first (of the equal ones, the smallest place) of windows that have an equal. What
    has one lead meets in one task."""
    equal = Window.partitionBy("lead", "w1", "w2")
    each = _windows(runs.repartition("lead")).withColumn("n", F.count("*").over(equal)).withColumn("first", F.min(_place()).over(equal))
    return each.filter("n > 1").select("short", "low", "start", "first")


def repeated_by_many(runs: DataFrame) -> DataFrame:
    """The same for leads that very many places have: their windows are sorted with their places in ranges, so
    that a window of very many places is cut up too. What the row before has been in another range is told
    by the first and the last window of each range, two rows a range."""
    spark = runs.sparkSession
    at = _windows(common.staged(runs, "suffix-windows"))
    at = at.select("w1", "w2", F.col("low").isNotNull().alias("some"), F.coalesce("low", F.lit(0).cast("long")).alias("id"), "start", "short")
    names, place = ["w1", "w2", "some", "id", "start", "short"], ["f_some", "f_id", "f_start"]
    array = at.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *names).sortWithinPartitions(*names)

    def work(frames):
        part, rows, top = TaskContext.get().partitionId(), None, None

        def out(f, kind):
            return f.assign(part=np.int32(part), kind=np.int32(kind))[[*names, *place, "alike", "part", "kind"]]

        def told(f):
            """All rows of a frame, whose first is known and whose ``alike`` is said."""
            opened = (f["w1"].to_numpy() == top[0]) & (f["w2"].to_numpy() == top[1])
            yield out(f[opened], OPEN)
            yield out(f[~opened & f["alike"].to_numpy(bool)], ALIKE)

        for f in frames:
            if not len(f):
                continue
            f = f.assign(alike=False, **{p: f[c] for p, c in zip(place, ("some", "id", "start"), strict=True)})
            if rows is None:
                top = f["w1"].iloc[0], f["w2"].iloc[0]
                yield out(f.iloc[:1], EDGE)
            else:
                f = pd.concat((rows, f), ignore_index=True)
            w1, w2 = f["w1"].to_numpy(), f["w2"].to_numpy()
            same = np.concatenate(([False], (w1[1:] == w1[:-1]) & (w2[1:] == w2[:-1])))
            of = np.maximum.accumulate(np.where(same, 0, np.arange(len(f))))  # the first row of its window
            alike = f["alike"].to_numpy(bool) | same
            alike[:-1] |= same[1:]
            f = f.assign(alike=alike, **{p: f[p].to_numpy()[of] for p in place})
            yield from told(f.iloc[:-1])
            rows = f.iloc[-1:]
        if rows is not None:
            yield out(rows, EDGE)
            lone = not rows["alike"].iloc[0] and (rows["w1"].iloc[0], rows["w2"].iloc[0]) != top
            yield from [out(rows, OPEN)] if lone else told(rows)

    found = common.staged(array.mapInPandas(work, "w1 long, w2 long, some boolean, id long, start int, short long, f_some boolean, f_id long, f_start int, alike boolean, part int, kind int"), "suffix-sorted")
    edges = found.filter(F.col("kind") == EDGE).groupBy("w1", "w2").agg(F.min(F.struct(*place)).alias("f"), (F.count_distinct("part") > 1).alias("more")).select("w1", "w2", "f.*", "more").toPandas()

    def close(frames):
        for f in frames:
            f = f.drop(columns=place).merge(edges, on=["w1", "w2"])
            yield f[f["alike"] | f["more"]][["some", "id", "start", "short", *place]]

    opened = found.filter(F.col("kind") == OPEN).mapInPandas(close, "some boolean, id long, start int, short long, f_some boolean, f_id long, f_start int")
    rows = found.filter(F.col("kind") == ALIKE).select(*opened.columns).unionByName(opened)
    low = lambda some, d: F.when(F.col(some), F.col(d)).alias("low")
    return rows.select("short", low("some", "id"), "start", F.struct(F.col("f_some").alias("some"), low("f_some", "f_id"), F.col("f_start").alias("start")).alias("first"))


def _covered(starts: str, words: int) -> str:
    """SQL: the spans that windows at the sorted places cover, joined where they overlap or touch."""
    none = "cast(array() as array<struct<start:int,end:int>>)"
    step = (
        f"if(s <= a.cur.end, struct(a.done as done, struct(a.cur.start as start, s + {words} as end) as cur), "
        f"struct(if(a.cur.end < 0, a.done, concat(a.done, array(a.cur))) as done, struct(s as start, s + {words} as end) as cur))"
    )
    return f"aggregate({starts}, struct({none} as done, struct(-1 as start, -1 as end) as cur), (a, s) -> {step}, a -> if(a.cur.end < 0, a.done, concat(a.done, array(a.cur))))"


def passages(docs: DataFrame, words: int = WORDS, gram: int = GRAM) -> DataFrame:
    """For each row: doc_id, n_words, spans and later (arrays of start and end in words)."""
    tid = F.unhex(F.substring(F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256), 1, 32))
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), tid.alias("tid"))
    texts = common.staged(kept_suffixes(given, words, gram), "suffix-kept")
    alike = common.staged(with_neighbours(texts), "suffix-alike")
    many = many_places(alike)
    key = lambda d: (F.col(d).isNotNull().alias("some"), F.coalesce(F.col(d), F.lit(0).cast("long")).alias("id"))
    ids, rows = texts.select("tid", F.xxhash64("tid").alias("short"), *key("low")), given.select("tid", *key("doc_id"), "text")

    def runs(of: DataFrame) -> DataFrame:
        places = of.groupBy("short").agg(F.collect_list("place").alias("places"))
        return extended(rows, common.staged(ids.join(places, "short").drop("short"), "suffix-places"), words, gram)

    if many.isEmpty():
        again = repeated(runs(alike))
    else:
        again = repeated(runs(alike.join(F.broadcast(many), "lead", "left_anti"))).unionByName(repeated_by_many(runs(alike.join(F.broadcast(many), "lead", "left_semi"))))
    later = F.when(~_place().eqNullSafe(F.col("first")), F.col("start"))
    spans = again.groupBy("short", "low").agg(F.sort_array(F.collect_list("start")).alias("s_all"), F.sort_array(F.collect_list(later)).alias("s_later"))
    spans = spans.select("short", F.col("low").alias("s_low"), F.expr(_covered("s_all", words)).alias("s_spans"), F.expr(_covered("s_later", words)).alias("s_later"))
    none = F.array().cast("array<struct<start:int,end:int>>")
    known = texts.select("tid", "rows", "low", "n_words", F.xxhash64("tid").alias("short")).join(spans.withColumnRenamed("short", "s_short"), (F.col("short") == F.col("s_short")) & F.col("low").eqNullSafe(F.col("s_low")), "left")
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").cast("int").alias("end")))
    copied = (F.col("rows") > 1) & (F.col("n_words") >= words)
    known = known.select("tid", "low", "n_words", F.when(copied, whole).otherwise(F.coalesce("s_spans", none)).alias("spans"), F.coalesce("s_later", none).alias("first_later"), F.when(copied, whole).otherwise(none).alias("copy_later"))
    own = F.col("doc_id").eqNullSafe(F.col("low"))
    return given.select("doc_id", "tid").join(known, "tid").select("doc_id", "n_words", "spans", F.when(own, F.col("first_later")).otherwise(F.col("copy_later")).alias("later"))


def op7_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    df = passages(common.table(spark, sf_dir, "documents"))
    total = lambda c: F.expr(f"aggregate({c}, 0L, (a, s) -> a + s.end - s.start)")
    written = lambda c: F.expr(f"array_join(transform({c}, s -> concat(s.start, ':', s.end)), ',')")
    return df.select("doc_id", "n_words", F.size("spans").cast("long").alias("n_spans"), total("spans").alias("repeated_words"), total("later").alias("later_words"), written("spans").alias("spans"), written("later").alias("later_spans"))

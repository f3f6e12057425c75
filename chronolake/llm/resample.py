"""Importance resampling towards a target distribution, by hashed n-grams.

A text's features are its runs of 1 to ``GRAM`` words (A-Z in lower case; digits, letters and all beyond
ASCII make words), each hashed to one of ``BUCKETS`` buckets. A bucket's gain is the logarithm of how much
more often the target has it than the documents, and a document's weight the sum over its features.
Adding Gumbel noise that depends on doc_id alone and taking the highest scores draws documents without
replacement in proportion to their importance.

Texts are read twice and never shuffled: once to count buckets over all documents (a task sends one row
for each of its buckets), once to sum gains. Both times a batch's n-grams are interned in an open-addressed
table of NumPy arrays: keys are the XXH64 of their bytes, compared byte by byte where keys are equal,
next slots tried on collision; a slot holds its n-gram's bucket and count, and each occurrence the
number of its slot, by which it gathers its gain. Nothing in the table's work is per word in Python but
n-grams of more than ``LONG`` bytes.

A batch holds some ``PIECE`` bytes; a longer text is cut between words, the last words going before the next
piece, so that no n-gram is lost or counted twice. Buckets are bounded by the parameter, so
counts and gains go through the driver. Ranks are counted by score (sums of counts in two levels), and within a
score by doc_id; rows equal in all that is returned are counted as one and written out again.

Nulls and ties: a null text has no words, a document without words weight 0. A null doc_id is written as
nothing in the noise and comes before all others in ties. Repeated rows have features like any other
and are drawn each, in any order. Extra columns are ignored. An empty target, or no documents, is a
distribution that is the same for all buckets. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronolake.llm import common

GRAM, BUCKETS, LEAST_WORDS, PERCENT, SEED, LONG, PIECE = 1, 10_000, 20, 10, 2024, 32, 1 << 22
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
# XXH64's primes and CRC-32's polynomial (fixed values)
_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))
_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, _CRC >> 1 ^ np.uint32(0xEDB88320), _CRC >> 1)


def _turn(x: np.ndarray, r: int) -> np.ndarray:
    return x << np.uint64(r) | x >> np.uint64(64 - r)


def short_hashes(rows: np.ndarray) -> np.ndarray:
    """XXH64 (seed 0) of each row of bytes; fewer than 32 columns."""
    n, size = rows.shape
    h, at = np.full(n, _P5 + np.uint64(size)), 0
    whole = lambda a, b, kind: np.ascontiguousarray(rows[:, a:b]).view(kind)[:, 0].astype(np.uint64)
    while at + 8 <= size:
        h = _turn(h ^ _turn(whole(at, at + 8, "<u8") * _P2, 31) * _P1, 27) * _P1 + _P4
        at += 8
    if at + 4 <= size:
        h = _turn(h ^ whole(at, at + 4, "<u4") * _P1, 23) * _P2 + _P3
        at += 4
    for i in range(at, size):
        h = _turn(h ^ rows[:, i].astype(np.uint64) * _P5, 11) * _P1
    h = (h ^ h >> np.uint64(33)) * _P2
    h = (h ^ h >> np.uint64(29)) * _P3
    return h ^ h >> np.uint64(32)


def short_crcs(rows: np.ndarray) -> np.ndarray:
    """CRC-32 of each row of bytes."""
    c = np.full(len(rows), 0xFFFFFFFF, np.uint32)
    for i in range(rows.shape[1]):
        c = _CRC[(c ^ rows[:, i]) & np.uint32(255)] ^ c >> np.uint32(8)
    return ~c


class Table:
    """An open-addressed table of the n-grams of one buffer of bytes.

    Arrays by slot: ``key`` (XXH64), ``start`` and ``size`` (where the first occurrence stands, size -1 in a
    free slot), ``bucket``, ``count``."""

    def __init__(self, data: np.ndarray, most: int, buckets: int):
        slots = 1 << max(4, (2 * most).bit_length())
        self.data, self.mask, self.buckets = data, np.int64(slots - 1), buckets
        self.key, self.start = np.zeros(slots, np.uint64), np.zeros(slots, np.int64)
        self.size, self.bucket, self.count = np.full(slots, -1, np.int64), np.zeros(slots, np.int64), np.zeros(slots, np.int64)

    def intern(self, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The slot of each occurrence; counts them."""
        slot = np.empty(len(start), np.int64)
        for n in np.unique(size):
            at = np.nonzero(size == n)[0]
            slot[at] = self._of_size(start[at], int(n))
        self.count += np.bincount(slot, minlength=len(self.count))
        return slot

    def _rows(self, start: np.ndarray, n: int) -> np.ndarray:
        return self.data[start[:, None] + np.arange(n)]

    def _bytes(self, start: int, n: int) -> bytes:
        return self.data[start : start + n].tobytes()

    def _of_size(self, start: np.ndarray, n: int) -> np.ndarray:
        short = n < LONG
        key = short_hashes(self._rows(start, n)) if short else np.array([xxhash.xxh64_intdigest(self._bytes(s, n)) for s in start], np.uint64)
        slot = (key & np.uint64(self.mask)).astype(np.int64)
        left = np.arange(len(start))
        while len(left):
            at = slot[left]
            free = left[self.size[at] < 0]
            if len(free):  # of those that want a free slot, one takes it
                own = slot[free]
                self.start[own] = start[free]
                new = free[self.start[own] == start[free]]
                own = slot[new]
                self.size[own], self.key[own] = n, key[new]
                self.bucket[own] = (short_crcs(self._rows(start[new], n)).astype(np.int64) if short else np.array([zlib.crc32(self._bytes(s, n)) for s in start[new]], np.int64)) % self.buckets
            same = (self.size[at] == n) & (self.key[at] == key[left])
            maybe = np.nonzero(same)[0]
            if len(maybe):
                own, held = start[left[maybe]], self.start[at[maybe]]
                if short:
                    same[maybe] = (self._rows(own, n) == self._rows(held, n)).all(axis=1)
                else:
                    same[maybe] = [a == b or self._bytes(a, n) == self._bytes(b, n) for a, b in zip(own, held, strict=True)]
            left = left[~same]
            slot[left] = slot[left] + 1 & self.mask
        return slot


def cut(texts, grams: int = GRAM, size: int = PIECE):
    """Groups of (number of the text, bytes, words before that only give context), of some ``size``
    bytes each; A-Z in lower case. A longer text is cut after a word."""
    group, held = [], 0
    for i, text in enumerate(texts):
        data = ("" if text is None else text).encode("utf-8", "replace").translate(_LOWER)
        at, before, context = 0, b"", 0
        while True:
            end = at + size
            if end < len(data):
                while end < len(data) and _WORD[data[end]]:
                    end += 1
            piece = before + data[at:end]
            group.append((i, piece, context))
            held += len(piece)
            if held >= size:
                yield group
                group, held = [], 0
            if end >= len(data):
                break
            at = end
            if grams > 1:
                s, z = spans(np.frombuffer(piece, np.uint8))
                last = [piece[a : a + n] for a, n in zip(s[1 - grams :].tolist(), z[1 - grams :].tolist(), strict=True)]
                before, context = b" ".join(last) + b" ", len(last)
    if group:
        yield group


def spans(data: np.ndarray, breaks: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of words; none goes across ``breaks``."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = _WORD[data]
    first = inside[:-1].copy()
    first[1:] &= ~inside[:-2]
    last = inside[:-1] & ~inside[1:]
    if breaks is not None:
        at = breaks[breaks < len(data)]
        first[at] = inside[at]
        at = at[at > 0]
        last[at - 1] = inside[at - 1]
    start = np.nonzero(first)[0]
    return start, np.nonzero(last)[0] - start + 1


def features(group: list[tuple[int, bytes, int]], grams: int = GRAM, buckets: int = BUCKETS):
    """Table of a group's n-grams; for every occurrence its slot and the place in the group of its piece;
    the number of (new) words of each piece."""
    lengths = np.array([len(p) for _, p, _ in group], np.int64)
    breaks = np.cumsum(lengths) - lengths
    data = np.frombuffer(b"".join(p for _, p, _ in group), np.uint8)
    start, size = spans(data, breaks)
    if grams > 1:  # words side by side, one space between them
        keep = np.repeat(start - np.concatenate([[0], np.cumsum(size + 1)[:-1]]), size + 1) + np.arange(int((size + 1).sum()))
        new = np.full(len(keep), 32, np.uint8)
        ends = np.cumsum(size + 1) - 1
        inner = np.ones(len(keep), bool)
        inner[ends] = False
        new[inner] = data[keep[inner]]
        piece = np.searchsorted(breaks, start, "right") - 1
        data, start = new, ends - size
    else:
        piece = np.searchsorted(breaks, start, "right") - 1
    lead = np.array([c for _, _, c in group], np.int64)
    head = np.searchsorted(piece, np.arange(len(group)))
    nth = np.arange(len(start)) - head[piece]
    words = np.bincount(piece[nth >= lead[piece]], minlength=len(group))
    all_start, all_size, all_piece = [], [], []
    for n in range(1, grams + 1):
        a, b = start[: len(start) - n + 1], np.arange(n - 1, len(start))
        good = (piece[: len(a)] == piece[b]) & (nth[b] >= lead[piece[b]])
        all_start.append(a[good])
        all_size.append(start[b][good] + size[b][good] - a[good])
        all_piece.append(piece[b][good])
    s, z, p = (np.concatenate(x) if len(x) > 1 else x[0] for x in (all_start, all_size, all_piece))
    table = Table(data, len(s), buckets)
    return table, table.intern(s, z), p, words


def bucket_counts(texts: DataFrame, grams: int = GRAM, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall in each bucket."""

    def work(batches):
        total = np.zeros(buckets, np.int64)
        for batch in common.parts(batches, 2000):
            for group in cut(batch["text"].to_pylist(), grams):
                table = features(group, grams, buckets)[0]
                used = np.nonzero(table.count)[0]
                np.add.at(total, table.bucket[used], table.count[used])
        some = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in texts.select(F.col("text").cast("string").alias("text")).mapInArrow(work, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # `buckets` rows at most
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Of each bucket, in thousandths, rounded down."""
    n, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    of = lambda s, t: math.floor(1000 * math.log(float(t + 1) * float(s_all + n) / (float(s + 1) * float(t_all + n))))
    return np.array([of(int(s), int(t)) for s, t in zip(source, target, strict=True)], np.int64)


def noise(doc_id: str = "doc_id", seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, from a hash of the doc_id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def weighted(docs: DataFrame, gain: np.ndarray, grams: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_features, weight of every row."""
    buckets = len(gain)

    def work(batches):
        for batch in common.parts(batches, 2000):
            n = batch.num_rows
            words, found, weight = (np.zeros(n, np.int64) for _ in range(3))
            for group in cut(batch["text"].to_pylist(), grams):
                table, slot, piece, own = features(group, grams, buckets)
                doc = np.array([i for i, _, _ in group])
                np.add.at(words, doc, own)
                np.add.at(found, doc, np.bincount(piece, minlength=len(group)))
                each = np.zeros(len(group), np.int64)
                np.add.at(each, piece, gain[table.bucket[slot]])
                np.add.at(weight, doc, each)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *(pa.array(x, pa.int64()) for x in (words, found, weight))], names=["doc_id", "n_words", "n_features", "weight"])

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return given.mapInArrow(work, "doc_id long, n_words long, n_features long, weight long")


def drawn(scored: DataFrame, percent: int = PERCENT, least: int = LEAST_WORDS) -> DataFrame:
    """Adds rank to (doc_id, n_words, n_features, weight, score), where it is among the drawn."""
    own = ["doc_id", "n_words", "n_features", "weight", "score"]
    rows = common.staged(scored.groupBy(*own).agg(F.count("*").alias("n")), "resample-rows")
    able = F.col("n_words") >= least
    by_score = common.staged(rows.filter(able).groupBy("score").agg(F.sum("n").alias("n")), "resample-scores")
    total, top = by_score.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("score"), F.lit(0))).first()
    most = percent * total // 100
    above = common.before(by_score.withColumn("key", top - F.col("score")), "key", "n").filter(F.col("before") < most).select("score", F.col("before").alias("above"))
    ahead = F.coalesce(F.sum("n").over(Window.partitionBy("score").orderBy(*(c for c in own if c != "score")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    high = rows.filter(able).join(above, "score").withColumn("start", F.col("above") + ahead).drop("above")
    low = rows.filter(~able).withColumn("start", F.lit(None).cast("long"))
    rest = rows.filter(able).join(above, "score", "left_anti").withColumn("start", F.lit(None).cast("long"))
    every = high.unionByName(rest).unionByName(low).withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
    rank = F.col("start") + F.col("nth")
    return every.select(*own, F.when(rank <= most, rank).alias("rank"))


def resampled(docs: DataFrame, target: DataFrame, grams: int = GRAM, buckets: int = BUCKETS, percent: int = PERCENT, least: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank (null where not drawn) of every row of ``docs``
    (doc_id, text), drawn towards the texts of ``target``."""
    gain = gains(bucket_counts(docs, grams, buckets), bucket_counts(target, grams, buckets))
    return drawn(weighted(docs, gain, grams).withColumn("score", F.col("weight") + noise("doc_id", seed)), percent, least)


def op13_resample(spark, sf_dir: str) -> DataFrame:
    docs, target = common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark")
    return resampled(docs, target).select("doc_id", "n_features", "weight", "score", "rank")


#: CRC-32 of a text's bytes (a macro's body in ``t``): its table by the rule, then byte by byte.
CRC_TABLE = "(SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS t)"


def crc_sql(text: str) -> str:
    """DuckDB SQL, where CRC_TABLE's t is in scope."""
    each = f"list_transform(range(strlen({text})), lambda k: CAST('0x' || substr(hex(encode({text})), CAST(2 * k + 1 AS INTEGER), 2) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {each}), lambda a, b: xor(a >> 8, t[CAST(xor(a, b) & 255 AS INTEGER) + 1])), 4294967295)"


OP13_SQL = rf"""
WITH w AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
d AS (SELECT r, unnest(words) AS word FROM w),
g AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark),
v AS MATERIALIZED (SELECT word, {crc_sql("word")} % {BUCKETS} AS bucket FROM (SELECT word FROM d UNION SELECT word FROM g), {CRC_TABLE}),
s AS (SELECT bucket, count(*) AS n FROM d JOIN v USING (word) GROUP BY 1), t AS (SELECT bucket, count(*) AS n FROM g JOIN v USING (word) GROUP BY 1),
b AS MATERIALIZED (SELECT bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT sum(n) FROM s) + {BUCKETS})::DOUBLE / ((s.n + 1)::DOUBLE * (coalesce((SELECT sum(n) FROM t), 0) + {BUCKETS})::DOUBLE))) AS gain FROM s LEFT JOIN t USING (bucket)),
f AS (SELECT r, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS weight FROM d JOIN v USING (word) JOIN b USING (bucket) GROUP BY 1),
x AS (SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, CAST('0x' || substr(sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h FROM w LEFT JOIN f USING (r)),
y AS (SELECT doc_id, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM x),
z AS (SELECT doc_id, n_features, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST) AS n, count(*) OVER () AS total FROM y WHERE n_features >= {LEAST_WORDS})
SELECT y.doc_id, y.n_features, weight, score, CASE WHEN z.n <= {PERCENT} * z.total // 100 THEN z.n END AS rank FROM y LEFT JOIN z ON z.doc_id IS NOT DISTINCT FROM y.doc_id
"""

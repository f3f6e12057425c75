"""Best-fit packing into sequences of fixed length by bin completion.

Texts become ids in Python tasks; a document longer than a sequence is cut into whole sequences, its
first piece being the shorter one. What has to be packed is then only a histogram: how many pieces
there are of each length, at most as many entries as a sequence has tokens, however large the corpus.
The histogram is solved on the driver by bin completion: around the largest remaining length, take
an undominated filling of the rest, as often as the counts allow; branch over all other fillings and
over fewer copies, prune a branch once its waste exceeds what the incumbent allows or its state was
met before with as few sequences, and keep the best-fit-decreasing solution as first incumbent. The
search ends at the lower bound, or when nothing is left to try, or after ``nodes`` steps (None: no
bound, an exact search); ``Solution`` says how many sequences no packing can do without and whether
the result is proven to be the fewest. The solution is a list of patterns, each with a number of
copies; a piece finds its place by its rank among the pieces of its length.

Ranks are counted in two levels (length, then as many salts as the length's count asks for), so that
a length that very many pieces share isn't ordered in one task.

Nulls: a null text counts as empty and still has its end token. Null or repeated doc_ids and repeated
rows are packed like any other; pieces that are equal in all columns may change places. Very long texts
are encoded whole, one at a time. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import zlib
from collections import Counter
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronolake.llm import common

LENGTH, END, NODES, ROWS, WORDS_KEPT = 2048, 0, 20_000, 4000, 200_000
SPAN, TOKENS, LEVELS = 4096, 1 << 21, 16
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class Encoder:
    """Ids of a text as little-endian unsigned 32-bit integers, as the tokenizer file has them. A text is
    first cut at the tokenizer's added tokens, then before single spaces, where its ids can't depend on
    each other; the ids of ``WORDS_KEPT`` words are remembered. A part in which a space meets other white
    space is encoded as a whole."""

    _odd = re.compile(r" \s|\s ")

    def __init__(self, ranks_path: str, pattern: str, added: dict[str, int]):
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.plain = tiktoken.Encoding("public", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.known: dict[str, bytes] = {}
        self.added = {t: np.array([i], "<u4").tobytes() for t, i in added.items()}
        self.cuts = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None

    def _bytes(self, text: str) -> bytes:
        return np.array(self.plain(text), "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        found = self._bytes(" " + word)
        if len(self.known) < WORDS_KEPT and len(word) < 40:
            self.known[word] = found
        return found

    def __call__(self, text: str) -> bytes:
        if self.cuts and self.cuts.search(text):
            parts = self.cuts.split(text)
            return b"".join(self.added[p] if k % 2 else self._part(p) for k, p in enumerate(parts))
        return self._part(text)

    def _part(self, text: str) -> bytes:
        if self._odd.search(text):
            return self._bytes(text)
        first, *rest = text.split(" ")
        known, word = self.known.get, self._word
        return self._bytes(first) + b"".join([known(w) or word(w) for w in rest])


def encoder() -> Encoder:
    """One for each worker process."""
    import public_tokenizers

    def make() -> Encoder:
        with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
            added = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
        return Encoder(path, public_tokenizers.PATTERN, added)

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return common.held(path, make)


def cut(n: int, length: int = LENGTH) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n ids."""
    first = n if n <= length else n % length or length
    return [(0, first)] + [(s, length) for s in range(first, n, length)]


def pieces(docs: DataFrame, length: int = LENGTH, with_ids: bool = False, order: str | None = None) -> DataFrame:
    """The pieces of all documents; with their ids or their document's ``order`` (a long), if asked for."""
    end = np.array([END], "<u4").tobytes()

    def work(batches):
        encode = encoder()
        for batch in common.parts(batches):
            out: list[list] = [[] for _ in range(6)]
            places = []
            for i, (doc_id, text) in enumerate(zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True)):
                ids = encode(text or "") + end
                for k, (s, m) in enumerate(cut(len(ids) // 4, length)):
                    own = ids[4 * s : 4 * (s + m)]
                    for column, value in zip(out, (doc_id, k, s, m, zlib.crc32(own), np.frombuffer(own, "<u4").astype(np.int32) if with_ids else None), strict=True):
                        column.append(value)
                    places.append(i)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()))
            names = ("doc_id", "piece", "start", "length", "ids_crc32", "ids")
            arrays, named = [pa.array(c, k) for c, k in zip(out, kinds, strict=True)][: 5 + with_ids], list(names[: 5 + with_ids])
            if order:
                arrays, named = [*arrays, batch[order].take(pa.array(places, pa.int64()))], [*named, order]
            yield pa.RecordBatch.from_arrays(arrays, names=named)

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *([F.col(order).cast("long").alias(order)] if order else []))
    return given.mapInArrow(work, PIECES + ", ids array<int>" * with_ids + (f", {order} long" if order else ""))


def best_fit(counts: dict[int, int], length: int) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
    """Best fit decreasing over a histogram: (copies, ((length, number), ...)) of each pattern."""
    rooms: list[list] = [[] for _ in range(length + 1)]  # by room: (copies, pattern)
    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            room = next((r for r in range(size, length + 1) if rooms[r]), None)
            copies, pattern = rooms[room].pop() if room is not None else (left, {})
            room = length if room is None else room
            each = min(room // size, left)
            use = min(copies, left // each)
            if use < copies and pattern:
                rooms[room].append((copies - use, pattern))
            rooms[room - each * size].append((use, pattern | {size: each}))
            left -= use * each
    return [(c, tuple(sorted(p.items(), reverse=True))) for bins in rooms for c, p in bins]


def _dominated(filling, left: dict[int, int], sizes: list[int], slack: int) -> bool:
    """Could a piece that is still there take the place of some of the filling's (or of nothing), that
    are together no larger, and at least two or smaller? Then the other filling is as good."""
    some, two = 1, 0  # bit t: pieces of sum t can be taken out; two of them or more
    for s, k in filling:
        for _ in range(k):
            two |= two << s | (some & ~1) << s
            some |= some << s
    used = dict(filling)
    for s in sizes:
        if left[s] > used.get(s, 0) and ((some >> max(0, s - slack) & ((1 << (s - max(0, s - slack))) - 1)) or two >> s & 1):
            return True
    return False


def _fillings(sizes: list[int], counts: dict[int, int], room: int):
    """The fillings of ``room``, best sum first and, of equal sums, those with larger pieces first; None in
    the place of a dominated one, so that looking at it counts as a step."""
    every, sizes = sizes, [s for s in sizes if s <= room and counts[s]]
    reach = [1] * (len(sizes) + 1)
    mask = (1 << (room + 1)) - 1
    for i in range(len(sizes) - 1, -1, -1):
        bits, s, c, k = reach[i + 1], sizes[i], min(counts[sizes[i]], room // sizes[i]), 1
        while c:
            k = min(k, c)
            bits |= bits << (s * k)
            c -= k
            k *= 2
        reach[i] = bits & mask

    def of(i: int, total: int):
        if not total:
            yield ()
            return
        while i < len(sizes) and (sizes[i] > total or not reach[i] >> total & 1):
            i += 1
        if i == len(sizes):
            return
        for k in range(min(counts[sizes[i]], total // sizes[i]), -1, -1):
            if reach[i + 1] >> (total - k * sizes[i]) & 1:
                for rest in of(i + 1, total - k * sizes[i]):
                    yield ((sizes[i], k), *rest) if k else rest

    for total in range(reach[0].bit_length() - 1, -1, -1):
        if reach[0] >> total & 1:
            for filling in of(0, total):
                yield None if _dominated(filling, counts, every, room - total) else filling


class Solution(NamedTuple):
    patterns: list[tuple[int, tuple[tuple[int, int], ...]]]
    sequences: int
    bound: int  # no packing needs fewer
    proven: bool  # nor is there one with fewer than ``sequences``


def least_sequences(counts: dict[int, int], length: int) -> int:
    """A lower bound: pieces above half a sequence are alone among themselves, and what lies in the room
    beside them can't be used for pieces of ``k`` or more unless it is that large."""
    n, total = np.zeros(length + 2, np.int64), np.zeros(length + 2, np.int64)
    for s, c in counts.items():
        n[s], total[s] = c, s * c
    n, total = np.cumsum(n), np.cumsum(total)
    best, half = -(-int(total[length]) // length), length // 2
    for k in range(half + 1):
        large, top = int(n[length] - n[length - k]), length - k
        middle, held = int(n[max(half, top)] - n[half]), int(total[max(half, top)] - total[half])
        small = int(total[half] - total[max(k - 1, 0)])
        best = max(best, large + middle + max(0, -(-(small - (middle * length - held)) // length)))
    return best


def complete(counts: dict[int, int], length: int = LENGTH, nodes: int | None = NODES) -> Solution:
    """The histogram's packing by bin completion, never worse than best fit decreasing."""
    left = {s: counts[s] for s in sorted(counts, reverse=True) if counts[s]}
    best, total, sizes = best_fit(left, length), sum(s * c for s, c in left.items()), list(left)
    fewest, bound = sum(c for c, _ in best), least_sequences(left, length)
    chosen: list = []
    met: dict[bytes, int] = {}  # of each state, the fewest sequences it was met with
    bins = waste = steps = 0

    def branches(begin: int = 0, at_most: int | None = None):
        """(copies, pattern, waste of each, filling's number) to try from this state, from a filling and a
        number of copies of it on."""
        top = next(s for s in sizes if left[s])
        own = {s: n - (s == top) for s, n in left.items() if n}
        for i, filling in enumerate(_fillings(list(own), own, length - top)):
            if filling is None or i < begin:
                yield None
                continue
            need = Counter({top: 1})
            need.update(dict(filling))
            lost = length - sum(s * k for s, k in need.items())
            room = (fewest - 1) * length - total - waste
            if lost > room:
                return
            copies = min(left[s] // k for s, k in need.items())
            copies = min(copies, room // lost) if lost else copies
            copies = min(copies, at_most) if i == begin and at_most is not None else copies
            while copies:
                yield copies, tuple(sorted(need.items(), reverse=True)), lost, i
                copies //= 2

    # of each level its branches, and the one taken; branches far up are dropped and made anew when needed
    levels: list[list] = [[branches(), 0, None]] if fewest > bound else []
    while levels and fewest > bound and (nodes is None or steps < nodes):
        steps += 1
        level = levels[-1]
        if level[0] is None:
            level[0] = branches(level[1], level[2])
        found = next(level[0], ())
        if found is None:
            continue
        if not found:
            levels.pop()
            if chosen:
                copies, pattern, lost = chosen.pop()
                bins, waste = bins - copies, waste - copies * lost
                for s, k in pattern:
                    left[s] += copies * k
            continue
        copies, pattern, lost, i = found
        level[1:] = [i, copies // 2]
        if waste + copies * lost > (fewest - 1) * length - total:
            continue
        for s, k in pattern:
            left[s] -= copies * k
        bins, waste = bins + copies, waste + copies * lost
        state = hashlib.blake2b(np.fromiter(left.values(), np.int64, len(left)).tobytes(), digest_size=16).digest()
        done, again = not any(left.values()), met.get(state, bins + 1) <= bins
        if done and bins < fewest:
            best, fewest = [(c, p) for c, p, _ in chosen] + [(copies, pattern)], bins
        if done or again:
            bins, waste = bins - copies, waste - copies * lost
            for s, k in pattern:
                left[s] += copies * k
            continue
        met[state] = bins
        chosen.append((copies, pattern, lost))
        levels.append([branches(), 0, None])
        if len(levels) > LEVELS:
            levels[-LEVELS - 1][0] = None
    return Solution(best, fewest, bound, fewest == bound or not levels)


class Plan:
    """Where the pieces of each length go, by their rank among the pieces of that length."""

    def __init__(self, patterns):
        rows, sequence, used = [], 0, Counter()
        for copies, pattern in patterns:
            offset = 0
            for size, k in pattern:
                rows.append((size, used[size], sequence, k, offset))
                used[size] += copies * k
                offset += size * k
            sequence += copies
        self.sequences = sequence
        self.size, self.rank, self.base, self.each, self.offset = np.array(sorted(rows), np.int64).reshape(-1, 5).T

    def place(self, size: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key, at = self.size * (1 << 40) + self.rank, size * (1 << 40) + rank
        i = np.searchsorted(key, at, side="right") - 1
        copy, nth = np.divmod(rank - self.rank[i], self.each[i])
        return self.base[i] + copy, self.offset[i] + nth * size


def assign(cut_up: DataFrame, length: int = LENGTH, nodes: int | None = NODES) -> DataFrame:
    """The pieces (a written table) with sequence_id, offset, fewest_possible (a lower bound of the number
    of sequences) and proven (is there no packing with fewer?)."""
    counts = {r.length: r.n for r in cut_up.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `length` rows
    found = complete(counts, length, nodes)
    plan = Plan(found.patterns)
    salts = F.create_map(*(F.lit(x) for n, c in sorted(counts.items()) for x in (int(n), -(-c // ROWS)))) if counts else F.create_map().cast("map<bigint,bigint>")
    salted = cut_up.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), F.coalesce(F.element_at(salts, F.col("length").cast("int")).cast("long"), F.lit(1))))
    cells = common.staged(salted.groupBy("length", "salt").count(), "pack-cells")
    cells = common.before(cells, "salt", "count", "length").select("length", "salt", "before")
    nth = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32"))
    ranked = salted.withColumn("nth", nth).join(cells, ["length", "salt"]).withColumn("rank", F.col("before") + F.col("nth") - 1)

    def work(frames):
        for f in frames:
            sequence, offset = plan.place(f["length"].to_numpy(np.int64), f["rank"].to_numpy(np.int64))
            yield f.drop(columns="rank").assign(sequence_id=sequence, offset=offset, fewest_possible=found.bound, proven=found.proven)

    columns = cut_up.columns
    schema = ", ".join(f"{n} {t}" for n, t in cut_up.dtypes)
    return ranked.select(*columns, "rank").mapInPandas(work, f"{schema}, sequence_id long, offset long, fewest_possible long, proven boolean")


def assign_in_order(cut_up: DataFrame, order: str, length: int = LENGTH, span: int = SPAN, tokens: int = TOKENS, nodes: int | None = NODES // 10) -> DataFrame:
    """The pieces (a written table) with sequence_id and offset, so that sequences keep the order of the
    documents (column ``order``, a long of at least 0): runs of ``span`` places, short ones together, are
    packed each on their own, one after the other. In a run, pieces of one length are used in order and
    sequences stand by their first piece. A run costs its last sequence at most, and what ``nodes`` steps of
    search don't find."""
    spans = cut_up.groupBy(F.expr(f"{order} div {span}").alias("at")).agg(F.sum("length").alias("n"))
    spans = common.before(common.staged(spans, "pack-spans"), "at", "n").select("at", F.expr(f"before div {tokens}").alias("run"))
    dealt = cut_up.withColumn("at", F.expr(f"{order} div {span}")).join(spans, "at").drop("at")

    def work(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values([order, "piece", "doc_id", "start", "ids_crc32"], kind="stable", ignore_index=True)
        plan = Plan(complete(dict(Counter(f["length"].tolist())), length, nodes).patterns)
        sequence, offset = plan.place(f["length"].to_numpy(np.int64), f.groupby("length").cumcount().to_numpy(np.int64))
        head = np.unique(sequence, return_index=True)[1]  # of each sequence, its first piece's place
        number = np.empty(len(head), np.int64)
        number[np.argsort(head, kind="stable")] = np.arange(len(head))
        return f.drop(columns=order).assign(sequence_id=number[sequence], offset=offset)

    own = ", ".join(f"{n} {t}" for n, t in cut_up.dtypes if n != order)
    placed = common.staged(dealt.groupBy("run").applyInPandas(work, f"{own}, run long, sequence_id long, offset long"), "pack-runs")
    base = common.before(placed.groupBy("run").agg((F.max("sequence_id") + 1).alias("n")), "run", "n").select("run", "before")
    kept = [c for c in cut_up.columns if c != order]
    return placed.join(base, "run").select(*kept, (F.col("sequence_id") + F.col("before")).alias("sequence_id"), "offset")


def pack(docs: DataFrame, length: int = LENGTH, order: str | None = None, nodes: int | None = NODES) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece (and what ``assign``
    adds); in the documents' ``order``, if there is such a column."""
    cut_up = common.staged(pieces(docs, length, order=order), "pack-pieces")
    return assign_in_order(cut_up, order, length, nodes=nodes and nodes // 10) if order else assign(cut_up, length, nodes)


def op8_packing(spark, sf_dir: str) -> DataFrame:
    return pack(common.table(spark, sf_dir, "documents"))

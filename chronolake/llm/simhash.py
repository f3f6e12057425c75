"""SimHash near-duplicates through sharded vantage-point trees.

A document's fingerprint has bit b set if more than half of its word shingles' XXH64 values have
it. Two fingerprints are linked at ``max_bits`` or fewer differing bits; a component is whatever
links reach.

How the links are found: equal fingerprints are folded into one first, so copies cost nothing
further. A vantage-point tree over a bounded sample gives the shards: at a node with vantage point
v and radius m, fingerprints with d(x, v) <= m go left. Each fingerprint has one home leaf and
visits the later leaves whose balls its own ball of radius ``max_bits`` may touch, by the triangle
inequality; so each close pair meets in the home leaf of one of the two, and no close pair is lost
whatever the sample was. Shards that are still large get trees of their own, from samples of their own,
level by level. A leaf's homes and its visitors are dealt out in blocks, and a task compares two blocks,
so that what it holds is bounded; only the edges of a spanning forest leave it, not all pairs.

Nulls and ties: a null or empty text has fingerprint 0 and is linked like any other. A null doc_id
takes part; it is never the smallest unless all of a component are null, whose component_id is then
null. Repeated rows stay repeated. Very long texts are hashed whole, in parts. Extra columns are ignored.
An empty table gives an empty result.
"""

from __future__ import annotations

import math
import pickle

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronolake.llm import common

SEED, WIDE = 42, 8
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _shingles(text: str | None, shingle_words: int) -> np.ndarray:
    """XXH64 of every shingle, repeats included; of the whole, if there are fewer words."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    n, h = len(words), xxhash.xxh64_intdigest
    whole = b" ".join(words)
    if n <= shingle_words:
        return np.array([h(whole, SEED)] if n else [], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate(([0], ends[: n - shingle_words] + 1))
    spans = zip(starts.tolist(), ends[shingle_words - 1 :].tolist(), strict=True)
    return np.fromiter((h(whole[s:e], SEED) for s, e in spans), np.uint64, n - shingle_words + 1)


def _majority(hashes: np.ndarray) -> np.ndarray:
    """For each of the 64 bits, is it set in more than half of the hashes?"""
    ones, step = np.zeros(64, np.int64), 1 << 15
    for a in range(0, len(hashes), step):
        part = np.ascontiguousarray(hashes[a : a + step])
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return 2 * ones > len(hashes)


def fingerprint(text: str | None, shingle_words: int = 4) -> int:
    """The unsigned 64-bit fingerprint of one text."""
    return int(np.packbits(_majority(_shingles(text, shingle_words)), bitorder="little").view(np.uint64)[0])


def wide_fingerprint(text: str | None, shingle_words: int, parts: int = WIDE) -> tuple[int, bytes]:
    """Number of distinct shingles and a fingerprint of ``parts`` * 64 bits over them."""
    hashes = np.unique(_shingles(text, shingle_words))
    return len(hashes), wide_code(hashes, parts)


def wide_code(hashes: np.ndarray, parts: int = WIDE) -> bytes:
    out = []
    for k in range(parts):
        x = hashes + np.uint64(k * 0x9E3779B97F4A7C15 % (1 << 64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        out.append(np.packbits(_majority(x ^ (x >> np.uint64(31))), bitorder="little"))
    return np.concatenate(out).tobytes()


def _given(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("text_hash"), F.col("text").cast("string").alias("text"))


def fingerprints(docs: DataFrame, shingle_words: int = 4) -> DataFrame:
    """doc_id, text_hash (of the text, to tell rows of one doc_id apart), fp (signed 64 bits)."""

    def work(batches):
        for batch in common.parts(batches):
            fps = np.fromiter((fingerprint(t, shingle_words) for t in batch["text"].to_pylist()), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["text_hash"], pa.array(fps.view(np.int64))], names=["doc_id", "text_hash", "fp"])

    return _given(docs).mapInArrow(work, "doc_id long, text_hash long, fp long")


class Bits:
    """The space of 64-bit fingerprints ``fp``: links are ``most`` differing bits or fewer."""

    key, columns, schema, spare = "fp", ["fp"], "fp long", 0

    def __init__(self, most: int):
        self.most = most

    def points(self, f: pd.DataFrame) -> np.ndarray:
        return f["fp"].to_numpy(np.int64).view(np.uint64)

    def away(self, points: np.ndarray, vantage: np.ndarray) -> np.ndarray:
        return np.bitwise_count(points ^ vantage).astype(np.int64)

    def reach(self, points: np.ndarray) -> np.ndarray:
        return np.full(len(points), self.most)

    def split(self, points: np.ndarray) -> tuple[np.ndarray, int] | None:
        """A vantage point and a radius that halve the points, if one does."""
        vantage = points[len(points) // 2]
        d = self.away(points, vantage)
        radius = int(np.median(d))
        return (vantage, radius) if (d <= radius).any() and (d > radius).any() else None

    def forest(self, f: pd.DataFrame, within: bool) -> tuple[np.ndarray, np.ndarray]:
        fps, home = self.points(f), f["home"].to_numpy(bool)
        a, b = _forest(fps[home], fps[~home], self.most, within)
        return a.view(np.int64), b.view(np.int64)


class VantageTree:
    """Nodes (vantage, radius, left, right); a negative child -1-k is leaf k. What has no more than
    ``least`` points of the sample is a leaf, and so is what the space has no split for."""

    def __init__(self, space, sample: np.ndarray, depth: int, least: int = 2):
        self.space, self.least = space, least
        self.nodes: list[list] = []
        self.leaves = 0
        self.root = self._grow(sample, depth)

    def _grow(self, points: np.ndarray, depth: int) -> int:
        split = self.space.split(points) if depth > 0 and len(points) > self.least else None
        if split:
            inside, k = self.space.away(points, split[0]) <= split[1], len(self.nodes)
            self.nodes.append([*split, 0, 0])
            self.nodes[k][2] = self._grow(points[inside], depth - 1)
            self.nodes[k][3] = self._grow(points[~inside], depth - 1)
            return k
        self.leaves += 1
        return -self.leaves

    def visits(self, points: np.ndarray, live: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, leaf, is_home): each row's home leaf, and the later leaves it has to visit. Rows that
        aren't ``live`` have no home; they visit every leaf that they may touch."""
        rows, leaves, homes, reach = [], [], [], self.space.reach(points)
        todo = [(self.root, np.arange(len(points)), np.ones(len(points), bool) if live is None else live)]
        while todo:
            k, idx, home = todo.pop()
            if not len(idx):
                continue
            if k < 0:
                rows.append(idx)
                leaves.append(np.full(len(idx), -k - 1, np.int64))
                homes.append(home)
                continue
            vantage, radius, left, right = self.nodes[k]
            d = self.space.away(points[idx], vantage)
            inside = d <= radius
            go = d <= radius + reach[idx]
            todo.append((left, idx[go], (home & inside)[go]))
            go = d > radius - reach[idx]
            todo.append((right, idx[go], (home & ~inside)[go]))
        if not rows:
            none = np.zeros(0, np.int64)
            return none, none, none.astype(bool)
        row, leaf, home = np.concatenate(rows), np.concatenate(leaves), np.concatenate(homes)
        at = np.full(len(points), -1, np.int64)
        at[row[home]] = leaf[home]
        keep = leaf >= at[row]
        return row[keep], leaf[keep], home[keep]


def _forest(homes: np.ndarray, queries: np.ndarray, reach: int, within: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the links between queries and homes (``within``: and among homes).
    Both are ordered by their distance from one more vantage point, so that a run of queries is
    compared only with the homes whose distance differs by ``reach`` at most."""
    if not len(homes):
        return homes, homes
    away = np.bitwise_count(homes ^ homes[0])
    order = np.argsort(away, kind="stable")
    homes, away = homes[order], away[order].astype(np.int64)
    far = np.bitwise_count(queries ^ homes[0])
    order = np.argsort(far, kind="stable")
    points, at_d = np.concatenate((homes, queries[order])), np.concatenate((away, far[order].astype(np.int64)))
    parent = np.arange(len(points))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    k = len(homes)
    a, b, at, step = [], [], 0 if within else k, 1
    label = np.arange(k)
    while at < len(points):
        end = min(len(points), at + step, k if at < k else len(points))
        lo, hi = np.searchsorted(away, at_d[at] - reach), np.searchsorted(away, at_d[end - 1] + reach, side="right")
        d = np.bitwise_count(points[at:end, None] ^ homes[None, lo:hi])
        q, h = np.nonzero(d <= reach)
        h += lo
        _, first = np.unique(q * np.int64(k) + label[h], return_index=True)
        for x, y in zip((q[first] + at).tolist(), h[first].tolist(), strict=True):
            r, s = find(x), find(y)
            if r != s:
                parent[max(r, s)] = min(r, s)
                a.append(x)
                b.append(y)
        up = parent[:k]
        while not np.array_equal(up, parent[up]):
            up = parent[up]
        label, at, step = up.copy(), end, min(step * 4, max(1, (1 << 22) // max(1, k)))
    return points[a], points[b]


LEAVES = 4096


def _depth(space, n: float, leaf: int, sample: int) -> int:
    return min(max(0, math.ceil(math.log2(max(n, 1) / leaf))) + space.spare, int(math.log2(sample)) - 3)


def _split(dealt: DataFrame, big: DataFrame, space, leaf: int, sample: int, chunk: int) -> DataFrame:
    """The rows (shard, a point's columns, home) of the shards in ``big`` (shard, homes, n), dealt to the
    leaves of a tree for each shard."""

    def grow(f: pd.DataFrame) -> pd.DataFrame:
        homes = int(f["homes"].iloc[0])
        tree = VantageTree(space, space.points(f), max(1, _depth(space, homes, leaf, sample)), max(2, len(f) * leaf // homes if space.spare else 0))
        return pd.DataFrame({"shard": f["shard"].iloc[:1], "tree": [pickle.dumps(tree)]})

    of = dealt.join(big, "shard")
    seen = of.filter(F.col("home") & (F.pmod(F.xxhash64(space.key), F.ceil(F.col("homes") / sample)) == 0))
    trees = common.staged(seen.groupBy("shard").applyInPandas(grow, "shard long, tree binary"), "simhash-trees")

    def deal(_: tuple, tree: pd.DataFrame, f: pd.DataFrame) -> pd.DataFrame:
        f = f[["shard", *space.columns, "home"]]
        if not len(f) or not len(tree):  # a sample without rows: the shard stays as it is
            return f.assign(shard=f["shard"] * LEAVES)
        row, at, home = pickle.loads(tree["tree"].iloc[0]).visits(space.points(f), f["home"].to_numpy(bool))
        return f.iloc[row].assign(shard=int(f["shard"].iloc[0]) * LEAVES + at, home=home)

    parts = F.ceil(F.col("n") / chunk)
    rows = of.withColumn("part", F.pmod(F.xxhash64(space.key, F.lit(1)), parts)).select("shard", "part", *space.columns, "home")
    trees = trees.join(big, "shard").select("shard", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part"), "tree")
    return trees.groupBy("shard", "part").cogroup(rows.groupBy("shard", "part")).applyInPandas(deal, f"shard long, {space.schema}, home boolean")


def links(reps: DataFrame, max_bits: int = 4, leaf: int = 32768, sample: int = 16384, chunk: int = 1 << 18, space=None) -> DataFrame:
    """Edges (a, b) between distinct points, named by their key, that span every component of the links.
    Points are fingerprints ``fp``, linked at ``max_bits``, or those of another ``space``.

    ``leaf`` is the number of homes aimed at in a shard, ``sample`` about as many points as a tree
    is grown from (trees only decide where pairs meet, never whether), ``chunk`` about as many rows of a
    shard as a task deals out."""
    space = space or Bits(max_bits)
    reps = reps.select(*space.columns)
    n = reps.count()
    depth = _depth(space, n, leaf, sample) if n > leaf else 0
    seen = reps.orderBy(F.xxhash64(space.key), space.key).limit(sample).collect() if depth else []
    seen = space.points(pd.DataFrame(seen, columns=space.columns))
    tree = VantageTree(space, seen, depth, max(2, len(seen) * leaf // max(1, n) if space.spare else 0))

    def deal(frames):
        for f in frames:
            row, shard, home = tree.visits(space.points(f))
            yield f.iloc[row].assign(shard=shard, home=home)[["shard", *space.columns, "home"]]

    dealt = common.staged(reps.mapInPandas(deal, f"shard long, {space.schema}, home boolean"), "simhash-shards")
    size = lambda: dealt.groupBy("shard").agg(F.sum(F.col("home").cast("long")).alias("homes"), F.count("*").alias("n"))
    done, big = [], common.staged(size().filter(F.col("homes") > 2 * leaf), "simhash-large")
    while not big.isEmpty():
        done.append(dealt.join(big, "shard", "left_anti").withColumn("level", F.lit(len(done))))
        dealt = common.staged(_split(dealt, big, space, leaf, sample, chunk), "simhash-shards")
        # shards that a tree of their own doesn't at least halve are left to blocks
        was = big.select(F.col("shard").alias("of"), F.col("homes").alias("was"))
        big = size().filter(F.col("homes") > 2 * leaf).join(was, F.expr(f"shard div {LEAVES} = of")).filter("2 * homes <= was")
        big = common.staged(big.select("shard", "homes", "n"), "simhash-large")
    every = dealt.withColumn("level", F.lit(len(done)))
    for part in done:
        every = every.unionByName(part)
    # a cell is a block of homes against itself, a later block of homes or a block of visitors
    counts = every.groupBy("level", "shard").agg(F.ceil(F.sum(F.col("home").cast("long")) / (2 * leaf)).alias("blocks"), F.ceil(F.sum((~F.col("home")).cast("long")) / (8 * leaf)).alias("others"))
    own = F.pmod(F.xxhash64(space.key, F.lit(2)), F.when(F.col("home"), F.col("blocks")).otherwise(F.col("others")))
    at = every.join(common.staged(counts.filter("blocks > 0"), "simhash-blocks"), ["level", "shard"]).withColumn("own", own)
    cell = lambda i, j, home: F.struct(i.alias("i"), j.alias("j"), home.alias("home"))
    upto = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    first, second = (lambda k: cell(F.least("own", k), F.greatest("own", k), F.col("own") <= k)), (lambda v: cell(F.col("own"), -1 - v, F.lit(True)))
    homes = F.concat(F.transform(upto(F.col("blocks")), first), F.when(F.col("others") > 0, F.transform(upto(F.greatest("others", F.lit(1))), second)).otherwise(F.array().cast("array<struct<i:bigint,j:bigint,home:boolean>>")))
    visitors = F.transform(upto(F.col("blocks")), lambda k: cell(k, -1 - F.col("own"), F.lit(False)))
    cells = at.select("level", "shard", *space.columns, F.explode(F.when(F.col("home"), homes).otherwise(visitors)).alias("c")).select("level", "shard", "c.i", "c.j", *space.columns, "c.home")

    def close(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        a, b = space.forest(f, key[2] == key[3])
        return pd.DataFrame({"a": a, "b": b})

    return cells.groupBy("level", "shard", "i", "j").applyInPandas(close, "a long, b long")


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); root is the component's smallest node.

    Alternates large-star and small-star steps until nothing changes; each round is a written
    table, so a lost executor costs one round at most."""
    now = common.staged(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        now = common.staged(small.filter("u <> v").distinct(), "links")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def near_duplicates(docs: DataFrame, shingle_words: int = 4, max_bits: int = 4) -> DataFrame:
    """A row for each row of ``docs``: doc_id, text_hash, fp, root (of its component, a fingerprint),
    component_id (its smallest doc_id)."""
    fps = common.staged(fingerprints(docs, shingle_words), "simhash")
    reps = common.staged(fps.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-distinct")
    of = connected(links(reps, max_bits))
    reps = reps.join(of, reps.fp == of.node, "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    low = reps.groupBy("root").agg(F.min("low").alias("component_id"))
    return fps.join(reps.select("fp", "root").join(low, "root"), "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def most_bits(similarity: float, bits: int) -> int:
    """Differing bits expected of two sets of equal size with that Jaccard similarity."""
    return round(bits * math.acos(2 * similarity / (1 + similarity)) / math.pi)


def apart(common: int, a: int, b: int) -> float:
    """Probability that a majority bit differs between two sets with ``common`` hashes in both and a
    and b hashes of their own."""
    at = lambda n: np.array([math.comb(n, k) for k in range(n + 1)], float) / 2.0**n
    ones, out = at(common), 0.0
    for k in range(common + 1):
        p = at(a)[np.arange(a + 1) * 2 + 2 * k > common + a].sum()
        q = at(b)[np.arange(b + 1) * 2 + 2 * k > common + b].sum()
        out += ones[k] * (p * (1 - q) + q * (1 - p))
    return out


FEW, DEVIATIONS = 48, 5


def radius(similarity: float, bits: int) -> tuple[int, int]:
    """Differing bits that pairs of at least that similarity stay within, but for one in some 10^6: for
    pairs in which a set has fewer than ``FEW`` hashes (majorities of few hashes depend on how many
    there are), and for all others."""
    few = max((apart(c, a, b) for c in range(1, FEW) for a in range(c) for b in range(a + 1) if c >= similarity * (c + a + b) - 1e-9), default=0.0)
    many = max(most_bits(similarity, 1 << 16) / (1 << 16), *(apart(FEW, a, b) for a in range(FEW) for b in range(a + 1) if FEW >= similarity * (FEW + a + b) - 1e-9))
    far = lambda p: math.ceil(bits * p + DEVIATIONS * math.sqrt(bits * p * (1 - p)))
    return far(max(few, many)), far(many)


def _proposed(codes: np.ndarray, sizes: np.ndarray, k: int, within: bool, first: tuple[int, int], most: tuple[int, int], ratio: float) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the pairs of places, one of them among the first k (homes), that may be
    similar: all words of their codes differ in ``most`` bits at most (for few hashes, for many), the
    first two, which are looked at before, in ``first``, and sizes are within ``ratio``. Homes are
    compared with each other only if ``within``. Homes and queries are ordered by size, so that only a
    run of homes is compared."""
    parent = np.arange(len(codes))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    a, b, step = [], [], 1
    at, homes = 0 if within else k, sizes[:k]
    label = np.arange(len(codes))
    while at < len(codes):
        end = min(len(codes), at + step, k if at < k else len(codes))
        lo, hi = np.searchsorted(homes, sizes[at] * ratio - 1e-9), np.searchsorted(homes, sizes[end - 1] / ratio + 1e-9, side="right")
        d = np.bitwise_count(codes[at:end, 0][:, None] ^ codes[None, lo:hi, 0]) + np.bitwise_count(codes[at:end, 1][:, None] ^ codes[None, lo:hi, 1])
        q, h = np.nonzero(d <= max(first))
        q, h = q + at, h + lo
        other = (label[h] != label[q]) & ((q >= k) | (h < q))
        q, h = q[other], h[other]
        near = np.zeros(len(q), bool)
        for s in range(0, len(q), 1 << 18):
            d = np.bitwise_count(codes[q[s : s + (1 << 18)]] ^ codes[h[s : s + (1 << 18)]])
            few = np.minimum(sizes[q[s : s + (1 << 18)]], sizes[h[s : s + (1 << 18)]]) < FEW
            near[s : s + (1 << 18)] = (d[:, :2].sum(axis=1, dtype=np.int64) <= np.where(few, *first)) & (d.sum(axis=1, dtype=np.int64) <= np.where(few, *most))
        near &= np.minimum(sizes[q], sizes[h]) >= ratio * np.maximum(sizes[q], sizes[h]) - 1e-9
        q, h = q[near], h[near]
        _, one = np.unique(q * np.int64(len(parent)) + label[h], return_index=True)
        for x, y in zip(q[one].tolist(), h[one].tolist(), strict=True):
            r, s = find(x), find(y)
            if r != s:
                parent[max(r, s)] = min(r, s)
                a.append(x)
                b.append(y)
        label = parent
        while not np.array_equal(label, label[label]):
            label = label[label]
        label = label.copy()
        at, step = end, min(step * 4, max(1, (1 << 21) // max(1, k)))
    return np.array(a, np.int64), np.array(b, np.int64)


def _linked(codes: np.ndarray, sets: list[np.ndarray], k: int, within: bool, most: tuple[int, int], similarity: float) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the pairs of places, one of them among the first k (homes), whose
    sets have the Jaccard similarity. Only pairs within ``most`` bits are looked at, closest first, and
    only between places that aren't linked by then. Homes are compared with each other only if ``within``."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    flat = np.unique(np.concatenate(sets), return_inverse=True)[1] if sizes.sum() else np.zeros(0, np.int64)
    ends = np.cumsum(sizes)
    starts, seen = ends - sizes, np.zeros(int(flat.max()) + 1 if len(flat) else 0, bool)
    label, edges = np.arange(len(sets)), []
    for q in range(0 if within else k, len(sets)):
        h = np.arange(min(q, k))
        h = h[(np.minimum(sizes[h], sizes[q]) >= similarity * np.maximum(sizes[h], sizes[q]) - 1e-9) & (label[h] != label[q])]
        if not len(h):
            continue
        d = np.bitwise_count(codes[h] ^ codes[q]).sum(axis=1, dtype=np.int64)
        near = d <= np.where(np.minimum(sizes[h], sizes[q]) < FEW, *most)
        h = h[near][np.argsort(d[near], kind="stable")]
        seen[flat[starts[q] : ends[q]]] = True
        while len(h):
            _, first = np.unique(label[h], return_index=True)  # the closest of each component
            test = h[first]
            shared = np.fromiter((seen[flat[s:e]].sum() for s, e in zip(starts[test].tolist(), ends[test].tolist(), strict=True)), np.int64, len(test))
            for x in test[shared >= similarity * (sizes[test] + sizes[q] - shared) - 1e-9].tolist():
                if label[x] != label[q]:
                    label[label == label[x]] = label[q]
                    edges.append((q, x))
            h = np.delete(h, first)
            h = h[label[h] != label[q]]
        seen[flat[starts[q] : ends[q]]] = False
    return edges


class Wide:
    """The space of texts (``node``, ``size``: its number of shingles, ``code``: its wide fingerprint) in
    which texts of that Jaccard ``similarity`` are near. Two points are as far apart as their codes, in
    bits, or as their sizes, whichever is more; the ratio of sizes that similar texts keep within counts
    as ``radius`` bits. The larger of two metrics is one, so the triangle inequality holds."""

    key, columns, schema, spare = "node", ["node", "size", "code"], "node long, size long, code binary", 3

    def __init__(self, similarity: float):
        self.similarity = similarity
        self.first, self.most = radius(similarity, 128), radius(similarity, 64 * WIDE)
        self.scale = self.most[1] / math.log(1 / similarity)

    def points(self, f: pd.DataFrame) -> np.ndarray:
        """A row of words for each: the size, and the code."""
        codes = np.frombuffer(b"".join(f["code"]), np.uint64).reshape(len(f), WIDE)
        return np.concatenate((f["size"].to_numpy(np.int64).astype(np.uint64)[:, None], codes), axis=1)

    def away(self, points: np.ndarray, vantage: np.ndarray) -> np.ndarray:
        bits = np.bitwise_count(points[:, 1:] ^ vantage[1:]).sum(axis=1, dtype=np.int64)
        sizes = np.log(np.maximum(points[:, 0], 1).astype(float)) - math.log(max(int(vantage[0]), 1))
        return np.maximum(bits, self.scale * np.abs(sizes))

    def reach(self, points: np.ndarray) -> np.ndarray:
        """A text has ``most`` for few hashes if the other text of a pair may have few."""
        return np.where(points[:, 0] * self.similarity < FEW, *self.most) + 1e-6

    def split(self, points: np.ndarray) -> tuple[np.ndarray, float] | None:
        """The vantage point and radius that leave the fewest comparisons, of some points and the empty
        text; none, if they leave nearly all, as a text then only visits more leaves."""
        best, reach = (0.9, None), self.reach(points)
        for vantage in (*points[np.arange(8) * len(points) // 8], np.zeros(1 + WIDE, np.uint64)):
            d = self.away(points, vantage)
            for r in np.unique(np.quantile(d, np.arange(1, 16) / 16, method="lower")).tolist():
                inside = (d <= r).mean()
                left = inside * (d <= r + reach).mean() + (1 - inside) * (d > r - reach).mean()
                if 0 < inside < 1 and left < best[0]:
                    best = left, (vantage, r)
        return best[1]

    def forest(self, f: pd.DataFrame, within: bool) -> tuple[np.ndarray, np.ndarray]:
        f = f.sort_values(["home", "size"], ascending=[False, True], kind="stable")
        node, k = f["node"].to_numpy(np.int64), int(f["home"].sum())
        if not k:
            return node[:0], node[:0]
        points = self.points(f)
        a, b = _proposed(points[:, 1:], points[:, 0].astype(np.int64), k, within, self.first, self.most, self.similarity)
        return node[a], node[b]


SENT = 1_000_000


def near_copies(docs: DataFrame, shingle_words: int = 5, similarity: float = 0.8, block: int = 32768, nodes: int = 512, hashes: int = 1 << 19) -> DataFrame:
    """A row for each row of ``docs``: doc_id, text_hash, root, component_id. Two texts are linked if
    their shingle sets have the Jaccard similarity. ``WIDE`` * 64-bit fingerprints only propose pairs
    (``radius``); what they propose is then decided by the sets themselves.

    Pairs are found by ``links``, as those of ``near_duplicates`` are: sharded vantage-point trees, over
    the space ``Wide``. A radius this wide prunes by fingerprints only where many are alike; by sizes it
    prunes always, and a shard that no vantage point divides is compared in blocks of ``block``
    homes on average, two in a task. A spanning forest of the proposals leaves it.

    The forests give components of texts that may be similar. Those of a component meet with their sets,
    in blocks of some ``nodes`` texts and ``hashes`` hashes, two in a task; no pair leaves it but the
    edges of a spanning forest of the similar ones."""

    def sets_of(batch):
        sets = [np.unique(_shingles(t, shingle_words)) for t in batch["text"].to_pylist()]
        return sets, pa.array(np.fromiter((xxhash.xxh64_intdigest(x.tobytes()) for x in sets), np.uint64, len(sets)).view(np.int64))

    def work(batches):
        common.held("near copies", object)  # what an earlier stage's workers keep goes
        common.give_back()
        for batch in common.parts(batches):
            sets, node = sets_of(batch)
            columns = [batch["doc_id"], batch["text_hash"], node, pa.array([len(x) for x in sets], pa.int64()), pa.array([wide_code(x) for x in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_hash", "node", "size", "code"])

    def hashes_of(batches):
        for batch in common.parts(batches):
            sets, node = sets_of(batch)
            offsets = np.concatenate(([0], np.cumsum(np.fromiter(map(len, sets), np.int64, len(sets))))).astype(np.int32)
            flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([node, pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["node", "hashes"])

    fps = common.staged(_given(docs).mapInArrow(work, "doc_id long, text_hash long, node long, size long, code binary"), "simhash-wide")
    # texts of one set are one point, known by a hash of it; one row stands for it
    row = F.xxhash64("doc_id", "text_hash")
    reps = common.staged(fps.groupBy("node").agg(F.min("doc_id").alias("low"), F.first("size").alias("size"), F.first("code").alias("code"), F.min(row).alias("row")), "simhash-points")
    space = Wide(similarity)
    maybe = connected(links(reps, leaf=max(1, block // 2), space=space))
    maybe = common.staged(maybe.select("node", F.col("root").alias("part")).distinct().join(reps.select("node", "size", "code", "row"), "node"), "simhash-parts")

    # those that may be similar, with their sets
    asked = maybe.select("row")
    sets = _given(docs).withColumn("row", row).join(F.broadcast(asked) if asked.count() <= SENT else asked, "row", "left_semi").select("text").mapInArrow(hashes_of, "node long, hashes array<bigint>")
    sets = sets.groupBy("node").agg(F.first("hashes").alias("hashes"))
    cut = maybe.groupBy("part").agg(F.greatest(F.ceil(F.count("*") / nodes), F.ceil(F.sum("size") / hashes), F.lit(1)).alias("cut"))
    own = F.pmod(F.xxhash64("node", F.lit(1)), F.col("cut"))
    met = maybe.drop("row").join(cut, "part").withColumn("own", own).join(sets, "node")
    pair = F.transform(F.sequence(F.lit(0).cast("long"), F.col("cut") - 1), lambda k: F.struct(F.least("own", k).alias("i"), F.greatest("own", k).alias("j"), (F.col("own") <= k).alias("home")))
    met = met.select("part", "node", "code", "hashes", F.explode(pair).alias("c")).select("part", "c.i", "c.j", "c.home", "node", "code", "hashes")

    def decide(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("home", ascending=False, kind="stable")
        codes = np.frombuffer(b"".join(f["code"]), np.uint64).reshape(len(f), -1)
        node, home = f["node"].to_numpy(np.int64), f["home"].to_numpy(bool)
        edges = _linked(codes, [np.asarray(x, np.int64) for x in f["hashes"]], int(home.sum()), key[1] == key[2], space.most, similarity)
        a, b = np.array(edges, np.int64).reshape(-1, 2).T
        return pd.DataFrame({"a": node[a], "b": node[b]})

    of = connected(met.groupBy("part", "i", "j").applyInPandas(decide, "a long, b long"))
    reps = reps.select("node", "low").join(of, "node", "left").select("node", "low", F.coalesce("root", "node").alias("root"))
    low = reps.groupBy("root").agg(F.min("low").alias("component_id"))
    return fps.select("doc_id", "text_hash", "node").join(reps.select("node", "root").join(low, "root"), "node").select("doc_id", "text_hash", "root", "component_id")


def keep_one(docs: DataFrame, near: DataFrame) -> DataFrame:
    """The documents less all but one of each component of ``near``: the row with the smallest doc_id
    (of rows that repeat it, one). Texts are shuffled only where rows repeat."""
    kept = near.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("doc_id", "root", "text_hash").agg(F.count("*").alias("n"))
    kept = kept.groupBy("doc_id", "root").agg(F.min_by(F.struct("text_hash", "n"), "text_hash").alias("t"))
    kept = common.staged(kept.select(F.xxhash64("doc_id", "t.text_hash").alias("k_row"), F.col("t.n").alias("n")), "simhash-kept")
    hashed = docs.withColumn("k_row", F.xxhash64(F.col("doc_id").cast("long"), F.xxhash64(F.col("text").cast("string"))))
    return common.one_of_each(hashed, "k_row", kept).select(*docs.columns)


def op10_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    near = near_duplicates(common.table(spark, sf_dir, "documents"))
    return near.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")

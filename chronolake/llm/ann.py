"""Nearest neighbours by inner product through a forest of hash prefixes.

Each of ``TREES`` trees gives a vector a hash string of ``LEVELS`` bits: the signs of its projections, less
the mean vector, on random directions. A tree is the sorted array of its strings; a prefix of any length is
a range of it. A query descends in every tree to its longest matching prefix and then ascends in all trees
at once, level by level, until the ranges together hold the wanted number of candidates; those are scored.

The arrays are sorted without their vectors, in ranges over all tasks, and cut into blocks of ``PART`` rows.
A query is a row of every array, so the task that holds its block counts there how many share each prefix
with it. Beyond that block a directory of the blocks' ends tells which others a prefix reaches (each counts
whole). The directory has ``BLOCKS`` blocks at most, and those that end with a tree or a sorted range: where
there are more rows, blocks are larger. Behind a string stand ``TAIL`` bits of a hash of the vector's id, so
that strings which very many vectors share are cut into blocks too.

How many candidates are wanted is calibrated: for ``PROBES`` queries the true neighbours are found among all
rows, and the smallest number is taken that reaches ``RECALL`` for them. On vectors spread evenly in all
directions that is a large part of the rows, whatever the hash; on vectors in clusters it is a small one.

A vector found in several trees counts as several candidates, so a query may see fewer than K others.
Such queries, and only they, ascend again with eight times the candidates until they have K or have seen
all rows.

Equal vectors are folded into one before, with their K + 1 smallest ids: more can't be in a result.
Vectors travel once for each tree, to their blocks (small ones at the ends of ranges are joined), where queries meet them; a join of candidates with
vectors would send a vector once for each candidate. Each task keeps the best of what it sees.

Vectors that are null, zero, of another size than most, or that hold a null or a value that isn't
finite take no part, nor do null vec_ids; of rows that repeat a vec_id, one counts. Extra columns are
ignored. An empty table gives an empty result, a single vector a query without neighbours.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronolake.llm import common

K, TREES, LEVELS, TAIL, PROBES, RECALL = 20, 6, 40, 22, 96, 0.95
PART, BLOCKS = 32768, 1 << 18


def usable(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """vec_id, vec (array of double), h1, h2 (hashes of it); each vec_id once."""
    v = F.col(vector).cast("array<double>")
    df = rows.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("vec")).filter("vec_id is not null and vec is not null and size(vec) > 0")
    df = df.filter("not exists(vec, x -> x is null or isnan(x) or abs(x) = double('infinity')) and exists(vec, x -> x <> 0)")
    df = df.withColumn("h1", F.xxhash64("vec")).withColumn("h2", F.hash("vec"))
    sizes = df.groupBy(F.size("vec").alias("size")).count().orderBy(F.desc("count"), "size").first()
    df = df.filter(F.size("vec") == (sizes["size"] if sizes else 0))
    return df.groupBy("vec_id").agg(F.min_by(F.struct("vec", "h1", "h2"), F.struct("h1", "h2")).alias("v")).select("vec_id", "v.*")


def folded(vectors: DataFrame, k: int) -> DataFrame:
    """h1, h2, rep (smallest vec_id), members (the k + 1 smallest) of each distinct vector."""
    first = F.row_number().over(Window.partitionBy("h1", "h2").orderBy("vec_id"))
    few = vectors.select("vec_id", "h1", "h2").withColumn("nth", first).filter(F.col("nth") <= k + 1)
    return few.groupBy("h1", "h2").agg(F.min("vec_id").alias("rep"), F.sort_array(F.collect_list("vec_id")).alias("members"))


def _matrix(blobs, kind: str) -> np.ndarray:
    """Vectors kept as ``kind`` of number (their own, so nothing is lost), in double precision."""
    return np.frombuffer(b"".join(blobs), kind).reshape(len(blobs), -1).astype(np.float64)


def _keys(x: np.ndarray, ids: np.ndarray, mean: np.ndarray, trees: int, levels: int, seed: int) -> np.ndarray:
    """Every tree's hash string of ``levels`` bits, with the tail behind it."""
    planes = np.random.default_rng(seed).standard_normal((x.shape[1], trees * levels))
    bits = ((x - mean) @ planes > 0).reshape(len(x), trees, levels)
    codes = (bits * (1 << np.arange(levels - 1, -1, -1, dtype=np.int64))).sum(axis=2)
    tail = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - TAIL)
    return (codes << TAIL) | tail.astype(np.int64)[:, None]


def _common(a: np.ndarray, b: np.ndarray, levels: int) -> np.ndarray:
    """Length of the common prefix of the strings of two keys."""
    return levels - np.frexp(((a ^ b) >> TAIL).astype(np.float64))[1]


def _range(keys: np.ndarray, level, levels: int) -> tuple[np.ndarray, np.ndarray]:
    """The keys [low, high) with the same first ``level`` bits."""
    shift = levels + TAIL - np.asarray(level, np.int64)
    low = (keys >> shift) << shift
    return low, low + (np.int64(1) << shift)


def _part(rows: int) -> int:
    return max(PART, -(-rows // BLOCKS))


def _cuts(tree: np.ndarray, key: np.ndarray, part: int) -> list[tuple[int, int]]:
    """Where a sorted run is cut into blocks: after ``part`` rows and at each tree, never between equal keys."""
    n = len(key)
    trees = np.append(np.flatnonzero(tree[1:] != tree[:-1]) + 1, n)
    changes = np.append(np.flatnonzero((tree[1:] != tree[:-1]) | (key[1:] != key[:-1])) + 1, n)
    out, start = [], 0
    while start < n:
        end = int(min(changes[np.searchsorted(changes, min(start + part, n))], trees[np.searchsorted(trees, start, side="right")]))
        out.append((start, end))
        start = end
    return out


def _blocks(frames, part: int):
    """The blocks of a task's sorted rows, one after the other."""
    held, n = [], 0
    for f in frames:
        held.append(f)
        n += len(f)
        if n >= 2 * part:
            run = pd.concat(held, ignore_index=True)
            *whole, (start, _) = _cuts(run["tree"].to_numpy(), run["key"].to_numpy(), part)
            for a, b in whole:
                yield run.iloc[a:b]
            held = [run.iloc[start:]]
            n = len(held[0])
    if n:
        run = pd.concat(held, ignore_index=True)
        for a, b in _cuts(run["tree"].to_numpy(), run["key"].to_numpy(), part):
            yield run.iloc[a:b]


def _shared(block: np.ndarray, keys: np.ndarray, levels: int) -> np.ndarray:
    """For each key and level, how many of the sorted block have the same prefix."""
    ends = [_range(keys, level, levels) for level in range(levels + 1)]
    return np.stack([np.searchsorted(block, high) - np.searchsorted(block, low) for low, high in ends], axis=1)


class Forest:
    """The directory: for each tree, the first and last key and the size of every block, in order."""

    def __init__(self, blocks: list[tuple[np.ndarray, np.ndarray, np.ndarray]], levels: int):
        self.first, self.last, self.n = zip(*blocks, strict=True)
        self.below = [np.concatenate(([0], np.cumsum(n))) for n in self.n]
        self.levels, self.size = levels, int(sum(b[-1] for b in self.below))

    def merged(self, part: int) -> "Forest":
        """The same arrays with neighbouring blocks joined, up to ``part`` rows."""
        out = []
        for first, last, n in zip(self.first, self.last, self.n, strict=True):
            starts, size = [], part
            for i, rows in enumerate(n.tolist()):
                size += rows
                if size > part:
                    starts.append(i)
                    size = rows
            at = np.array(starts, np.int64)
            out.append((first[at], last[np.append(at[1:], len(n)) - 1], np.add.reduceat(n, at)) if starts else (first, last, n))
        return Forest(out, self.levels)

    def block(self, t: int, keys: np.ndarray) -> np.ndarray:
        """The block that holds each key of an array."""
        return np.searchsorted(self.first[t], keys, side="right") - 1

    def reached(self, t: int, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The blocks [a, b) that keys in [low, high) can stand in."""
        a, b = np.searchsorted(self.last[t], low), np.searchsorted(self.first[t], high)
        return a, np.maximum(a, b)

    def counts(self, keys: np.ndarray, own: np.ndarray) -> np.ndarray:
        """For each query (row of keys) and level, the candidates in all trees together: those counted in
        its own blocks, and the other blocks that the prefix reaches."""
        out = own.copy()
        for t in range(keys.shape[1]):
            home = self.n[t][self.block(t, keys[:, t])]
            for level in range(self.levels + 1):
                a, b = self.reached(t, *_range(keys[:, t], level, self.levels))
                out[:, level] += self.below[t][b] - self.below[t][a] - home
        return out

    def level(self, keys: np.ndarray, own: np.ndarray, wanted: int) -> np.ndarray:
        """The deepest level at which all trees together have the wanted candidates."""
        if wanted >= self.size:
            return np.zeros(len(keys), np.int64)
        enough = self.counts(keys, own) >= wanted
        return np.where(enough.any(axis=1), self.levels - np.argmax(enough[:, ::-1], axis=1), 0)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest, ties to smaller ids."""
    if len(scores) > 4 * k:
        near = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near]))[:k]]


def _search(x: np.ndarray, ids: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, id, score) of the k best; scores are summed one pair at a time, so that they don't
    depend on a vector's place."""
    rows, found, scores = [], [], []
    near = q @ x.T
    for i in range(len(q)):
        s = near[i]
        if len(s) > 4 * k:
            edge = np.partition(s, len(s) - k)[len(s) - k]
            keep = np.flatnonzero(s >= edge - 1e-9 * max(1.0, abs(edge)))
        else:
            keep = np.arange(len(s))
        exact = (x[keep] * q[i]).sum(axis=1)
        best = _best(exact, ids[keep], k)
        rows.append(np.full(len(best), i))
        found.append(ids[keep][best])
        scores.append(exact[best])
    return np.concatenate(rows), np.concatenate(found), np.concatenate(scores)


def _top(rows: DataFrame, by: str, k: int) -> DataFrame:
    nth = F.row_number().over(Window.partitionBy(by).orderBy(F.desc("score"), "rep"))
    return rows.withColumn("nth", nth).filter(F.col("nth") <= k).drop("nth")


def search(rows: DataFrame, is_query: str, k: int = K, vector: str = "embedding", trees: int = TREES, levels: int = LEVELS, recall: float = RECALL, seed: int = 7) -> DataFrame:
    """query_id, rank, vec_id, score: for each row that meets the condition ``is_query`` (SQL on
    vec_id), its k nearest among all other rows, as the forest finds them."""
    spark = rows.sparkSession
    vectors = common.staged(usable(rows, vector), "ann-vectors")
    fold = common.staged(folded(vectors, k), "ann-distinct")
    queries = vectors.filter(is_query).select(F.col("vec_id").alias("query_id"), "h1", "h2").join(fold, ["h1", "h2"]).select("query_id", F.col("rep").alias("q"))
    asked = queries.select(F.col("q").alias("rep")).distinct().withColumn("asked", F.lit(True))
    kind = "<f4" if dict(rows.dtypes)[vector] == "array<float>" else "<f8"
    one = vectors.first()
    if one is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    size = len(one.vec)
    mean = np.array(vectors.agg(*(F.avg(F.get("vec", F.lit(i))).alias(f"m{i}") for i in range(size))).first(), float)

    def hashed(frames):
        for f in frames:
            if len(f):
                x = np.stack(f["vec"].to_numpy())
                yield pd.DataFrame({"rep": f["rep"], "asked": f["asked"], "keys": list(_keys(x, f["rep"].to_numpy(np.int64), mean, trees, levels, seed)), "vec": [r.astype(kind).tobytes() for r in x]})

    distinct = vectors.join(fold.select(F.col("rep").alias("vec_id")), "vec_id").withColumnRenamed("vec_id", "rep")
    index = distinct.join(asked, "rep", "left").select("rep", F.coalesce("asked", F.lit(False)).alias("asked"), "vec")
    index = common.staged(index.mapInPandas(hashed, "rep long, asked boolean, keys array<long>, vec binary"), "ann-index")
    forest, asked = _sorted(index, trees, levels)
    blocks = forest.merged(_part(forest.size))
    wanted = _calibrated(index, asked, forest, k, recall, kind)

    def nearest(asked: DataFrame, wanted: int) -> DataFrame:
        def items(frames):
            for f in frames:
                if len(f):
                    keys = np.stack(f["keys"].to_numpy())
                    for t in range(trees):
                        yield pd.DataFrame({"tree": t, "block": blocks.block(t, keys[:, t]), "key": keys[:, t], "high": -1, "rep": f["rep"], "vec": f["vec"]})

        def asks(frames):
            for f in frames:
                if not len(f):
                    continue
                keys, reps, vecs = np.stack(f["keys"].to_numpy()), f["rep"].to_numpy(np.int64), f["vec"].to_numpy()
                level = forest.level(keys, np.stack(f["own"].to_numpy()), wanted)
                for t in range(trees):
                    low, high = _range(keys[:, t], level, levels)
                    a, b = blocks.reached(t, low, high)
                    q = np.repeat(np.arange(len(f)), b - a)
                    block = np.arange(len(q)) + np.repeat(b - np.cumsum(b - a), b - a)
                    for s in range(0, len(q), 8192):
                        i = q[s : s + 8192]
                        yield pd.DataFrame({"tree": t, "block": block[s : s + 8192], "key": low[i], "high": high[i], "rep": reps[i], "vec": vecs[i]})

        def scan(f: pd.DataFrame) -> pd.DataFrame:
            f = f.sort_values(["key", "rep"], kind="stable")
            item = f["high"].to_numpy() < 0
            keys, ids = f["key"].to_numpy(np.int64)[item], f["rep"].to_numpy(np.int64)[item]
            ask = f[~item]
            if not len(ids) or not len(ask):
                return pd.DataFrame({"q": [], "rep": [], "score": []})
            x, q = _matrix(f["vec"].to_numpy()[item], kind), _matrix(ask["vec"].to_numpy(), kind)
            qid = ask["rep"].to_numpy(np.int64)
            spans, of = np.unique(np.stack((np.searchsorted(keys, ask["key"]), np.searchsorted(keys, ask["high"]))), axis=1, return_inverse=True)
            out = []
            for j, (a, b) in enumerate(spans.T.tolist()):
                own = np.flatnonzero(of == j) if a < b else []
                for s in range(0, len(own), 256):
                    i, rep, score = _search(x[a:b], ids[a:b], q[own[s : s + 256]], k + 1)
                    out.append(pd.DataFrame({"q": qid[own[s : s + 256]][i], "rep": rep, "score": score}))
            return pd.concat(out) if out else pd.DataFrame({"q": [], "rep": [], "score": []})

        kinds = "tree int, block long, key long, high long, rep long, vec binary"
        dealt = index.select("rep", "keys", "vec").mapInPandas(items, kinds).unionByName(asked.mapInPandas(asks, kinds))
        found = dealt.groupBy("tree", "block").applyInPandas(scan, "q long, rep long, score double").distinct()
        best = _top(found, "q", k + 1).join(fold.select("rep", "members"), "rep")
        return common.staged(_top(best.select("q", "score", F.explode("members").alias("rep")), "q", k + 1), "ann-best")

    best, least = nearest(asked, wanted), min(k + 1, vectors.count())
    while wanted < forest.size:  # at which all rows are candidates
        short = common.staged(best.groupBy("q").count().filter(F.col("count") < least).select("q"), "ann-short")
        if short.isEmpty():
            break
        wanted = min(8 * wanted, forest.size)
        again = asked.join(short.select(F.col("q").alias("rep")), "rep", "left_semi")
        best = best.join(short, "q", "left_anti").unionByName(nearest(again, wanted))
    lists = best.groupBy("q").agg(F.collect_list(F.struct("rep", "score")).alias("near"))
    full = queries.join(lists, "q").select("query_id", F.explode("near").alias("x")).select("query_id", "x.rep", "x.score").filter("rep <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "rep"))
    return full.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", F.col("rep").alias("vec_id"), "score")


def _sorted(index: DataFrame, trees: int, levels: int) -> tuple[Forest, DataFrame]:
    """The directory of the sorted arrays, and rep, keys, vec and own of the queries: how many rows of
    their blocks in all trees together share each prefix."""
    part = _part(index.count() * trees)
    ranges = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = index.select("rep", "asked", F.posexplode("keys").alias("tree", "key"))
    array = rows.repartitionByRange(ranges, "tree", "key").sortWithinPartitions("tree", "key")

    def work(frames):
        for f in _blocks(frames, part):
            tree, key = int(f["tree"].iloc[0]), f["key"].to_numpy(np.int64)
            yield pd.DataFrame({"tree": [tree], "first": [key[0]], "last": [key[-1]], "n": [len(key)], "rep": [0], "own": [[]]})
            q = np.flatnonzero(f["asked"].to_numpy(bool))
            for s in range(0, len(q), 4096):
                i = q[s : s + 4096]
                yield pd.DataFrame({"tree": tree, "first": 0, "last": 0, "n": 0, "rep": f["rep"].to_numpy(np.int64)[i], "own": list(_shared(key, key[i], levels))})

    found = common.staged(array.mapInPandas(work, "tree int, first long, last long, n long, rep long, own array<long>"), "ann-array")
    ends = found.filter("n > 0").select("tree", "first", "last", "n").toPandas().sort_values(["tree", "first"])  # ``BLOCKS`` at most, and the ends of trees and ranges
    forest = Forest([tuple(ends.loc[ends["tree"] == t, c].to_numpy(np.int64) for c in ("first", "last", "n")) for t in range(trees)], levels)
    total = F.aggregate("all", F.array_repeat(F.lit(0).cast("long"), levels + 1), lambda a, x: F.zip_with(a, x, lambda p, q: p + q))
    own = found.filter("n = 0").groupBy("rep").agg(F.collect_list("own").alias("all")).select("rep", total.alias("own"))  # a list of each tree
    return forest, common.staged(index.filter("asked").select("rep", "keys", "vec").join(own, "rep"), "ann-asked")


def _calibrated(index: DataFrame, asked: DataFrame, forest: Forest, k: int, recall: float, kind: str) -> int:
    """The fewest candidates that give ``PROBES`` queries the wanted recall of their true neighbours
    among all rows."""
    probes = asked.orderBy(F.xxhash64("rep"), "rep").limit(PROBES).collect()
    if not probes:
        return 1
    q, keys, own = _matrix([r.vec for r in probes], kind), np.array([r.keys for r in probes], np.int64), np.array([r.own for r in probes], np.int64)
    ids = np.array([r.rep for r in probes])

    def exact(frames):
        for f in frames:
            if len(f):
                reps, of = f["rep"].to_numpy(np.int64), np.stack(f["keys"].to_numpy())
                i, rep, score = _search(_matrix(f["vec"].to_numpy(), kind), reps, q, k + 1)
                at = pd.Series(range(len(reps)), index=reps).loc[rep].to_numpy()
                yield pd.DataFrame({"q": ids[i], "rep": rep, "score": score, "common": _common(of[at], keys[i], forest.levels).max(axis=1)})

    true = _top(index.select("rep", "keys", "vec").mapInPandas(exact, "q long, rep long, score double, common int").filter("q <> rep"), "q", k).collect()
    wanted = max(64, k)
    while wanted < forest.size:
        level = dict(zip(ids.tolist(), forest.level(keys, own, wanted).tolist(), strict=True))
        if sum(r.common >= level[r.q] for r in true) >= recall * len(true):
            break
        wanted = int(wanted * 1.15) + 1
    return wanted


def op4_ann(spark, sf_dir: str) -> DataFrame:
    return search(common.table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0")

import numpy as np
import pytest
import xxhash

from chronolake.llm import common, simhash


def plain(text, k=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", low) if w]
    grams = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    h = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def brute(rows):
    """component_id by comparing every pair."""
    fps, root = [plain(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        low[r] = min((x for x in (low.get(r), d) if x is not None), default=None)
    return sorted(((str(d), f"{fps[i]:016x}", low[find(i)]) for i, (d, _) in enumerate(rows)), key=str)


WORDS = [f"w{i}é" for i in range(300)]


def corpus(n=120, seed=0):
    rng, rows = np.random.default_rng(seed), []
    for i in range(n):
        if i % 3 and rows:
            words = rows[rng.integers(len(rows))].split(" ")
            if len(words) > 3:
                words[rng.integers(len(words))] = "Edit"
            rows.append(" ".join(words))
        else:
            rows.append(" ".join(rng.choice(WORDS, rng.integers(1, 400))))
    return list(enumerate(rows)) + [(900, ""), (901, None), (902, "   \n"), (903, "one"), (903, "one"), (None, "one"), (None, rows[0])]


def got(spark, rows, **extra):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS root", "2 AS fp")
    near = simhash.near_duplicates(docs, **extra)
    return sorted(((str(r.doc_id), f"{r.fp & (2**64 - 1):016x}", r.component_id) for r in near.collect()), key=str)


def test_against_every_pair(spark):
    assert got(spark, corpus()) == brute(corpus())


@pytest.mark.parametrize("leaf, sample, chunk", [(40, 512, 1 << 18), (5, 64, 150)])
def test_tree_loses_no_link(spark, leaf, sample, chunk):
    """Also with trees below trees, and with blocks of homes and of visitors."""
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 400, dtype=np.int64)
    near = base[rng.integers(0, 400, 1500)] ^ np.array([sum({1 << int(b) for b in rng.integers(0, 63, 3)}) for _ in range(1500)])
    fps = np.unique(np.concatenate((base, near)))
    reps = spark.createDataFrame([(int(x),) for x in fps], "fp long")
    edges = simhash.links(reps, 4, leaf=leaf, sample=sample, chunk=chunk)
    found = {r.node: r.root for r in simhash.connected(edges).collect()}
    root = {int(x): int(x) for x in fps}
    d = np.bitwise_count(fps[:, None] ^ fps[None, :])
    changed = True
    while changed:
        changed = False
        for i, j in zip(*np.nonzero(d <= 4), strict=True):
            a, b = int(fps[i]), int(fps[j])
            if root[a] != root[b]:
                root[a] = root[b] = min(root[a], root[b])
                changed = True
    assert {x: found.get(x, x) for x in root} == root


@pytest.mark.parametrize("near", [simhash.near_duplicates, simhash.near_copies])
def test_keep_one_and_empty(spark, near):
    rows = [(1, "a b c d e"), (2, "a b c d e"), (2, "a b c d e"), (3, "x"), (3, "x"), (None, "q"), (4, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS size", "2 AS code")
    kept = simhash.keep_one(docs, near(docs))
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(1, "a b c d e"), (3, "x"), (None, "q"), (4, None)], key=str)
    assert near(docs.limit(0)).count() == 0 and kept.columns == docs.columns


def jaccard(a, b, k=5):
    grams = lambda t: {tuple(w[i : i + k]) for w in [t.lower().split()] for i in range(max(1, len(w) - k + 1))}
    return len(grams(a) & grams(b)) / len(grams(a) | grams(b))


def test_near_copies(spark, monkeypatch):
    """Pairs well above the similarity meet, pairs well below don't, whatever the size of the blocks."""
    rng, rows = np.random.default_rng(3), []
    for i in range(40):
        words = list(rng.choice(WORDS, rng.integers(30, 900)))
        for j in range(5):
            other = list(words)
            for p in rng.integers(len(words), size=[0, 1, len(words) // 100, len(words) // 50, len(words) // 12][j]):
                other[p] = "Edit"
            rows.append((i * 10 + j, " ".join(other)))
    texts = dict(rows)
    for block, sent in ((16384, simhash.SENT), (20, 0)):  # the last with keys too many to be sent
        monkeypatch.setattr(simhash, "SENT", sent)
        monkeypatch.setattr(common, "SENT", sent)
        root = {r.doc_id: r.component_id for r in simhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string"), block=block).collect()}
        for a in texts:
            for b in texts:
                if a < b and a // 10 == b // 10 and jaccard(texts[a], texts[b]) >= 0.88:
                    assert root[a] == root[b]
                elif a // 10 != b // 10:
                    assert root[a] != root[b]
        alone = [a for a in texts if a % 10 == 4 and max(jaccard(texts[a], texts[b]) for b in texts if b != a and a // 10 == b // 10) < 0.7]
        assert alone and all(root[a] == a for a in alone)


@pytest.mark.parametrize("text", ["", "A b", "A b c d", "A b c d\x0be", "x " * 5000])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain(text)


def test_near_copies_by_exact_similarity(spark):
    """Short and long texts at, below and above the similarity: linked just as all their pairs say."""
    rng, texts = np.random.default_rng(11), []
    for n in (6, 7, 8, 9, 10, 12, 14, 20, 24, 32, 49, 60, 94):
        for _ in range(8):
            words = [f"w{rng.integers(10**6)}" for _ in range(n)]
            texts.append(words)
            texts += [words[:-k] + ["x"] * k for k in range(1, n // 4 + 2)]
            texts += [words[:-k] for k in range(1, n // 4 + 2)]
            texts += [words[: n // 2] + ["y"] + words[n // 2 + 1 :]]
    texts = [" ".join(w) for w in texts]
    sets = [set(simhash._shingles(t, 5).tolist()) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            shared = len(a & sets[j])
            if 5 * shared >= 4 * (len(a) + len(sets[j]) - shared):
                r, s = find(i), find(j)
                root[max(r, s)] = min(r, s)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for bounds in ({}, {"block": 400, "nodes": 5, "hashes": 200}):
        got = {r.doc_id: r.component_id for r in simhash.near_copies(docs, **bounds).collect()}
        assert got == {i: find(i) for i in range(len(texts))}


def wide_points(sizes, templates, flips, seed=5):
    """Points of the space of near copies: a random code for each template, with some bits of it flipped."""
    rng = np.random.default_rng(seed)
    codes = rng.integers(0, 2, (max(templates) + 1, 512), np.uint8)[templates]
    for row in codes:
        row[rng.choice(512, flips, replace=False)] ^= 1
    return np.concatenate((np.array(sizes, np.uint64)[:, None], np.packbits(codes, axis=1).view(np.uint64)), axis=1)


@pytest.mark.parametrize("leaf, sample, chunk", [(64, 512, 1 << 18), (10, 64, 150)])
def test_near_copies_meet_in_trees(spark, leaf, sample, chunk):
    """Wide fingerprints go through the trees of op10 too, which lose no pair: also with trees below trees,
    and with blocks of homes and of visitors."""
    rng, space = np.random.default_rng(7), simhash.Wide(0.8)
    templates = rng.integers(0, 150, 600)
    points = wide_points((np.exp(rng.uniform(0, 8, 150))[templates] * rng.uniform(0.85, 1.15, 600)).astype(int) + 1, templates, 45)
    rows = [(i, int(p[0]), p[1:].tobytes()) for i, p in enumerate(points)]
    found = {r.node: r.root for r in simhash.connected(simhash.links(spark.createDataFrame(rows, space.schema), leaf=leaf, sample=sample, chunk=chunk, space=space)).collect()}
    root = list(range(600))
    for i in range(600):
        for j in range(i):
            (s, t), d = sorted((int(points[i, 0]), int(points[j, 0]))), np.bitwise_count(points[i, 1:] ^ points[j, 1:])
            k = int(s >= simhash.FEW)
            if 5 * s >= 4 * t and d[:2].sum() <= space.first[k] and d.sum() <= space.most[k]:
                root = [min(root[i], root[j]) if r in (root[i], root[j]) else r for r in root]
    assert {i: found.get(i, i) for i in range(600)} == dict(enumerate(root)) and 100 < len(set(root)) < 400


def test_trees_prune_near_copies():
    """By sizes; and by fingerprints alone, where many are alike. What nothing divides is one leaf."""
    rng, space = np.random.default_rng(8), simhash.Wide(0.8)
    spread = wide_points(np.exp(rng.uniform(0, 8, 2000)).astype(int), np.arange(2000), 0)
    tree = simhash.VantageTree(space, spread, 6, 50)
    row, leaf, home = tree.visits(spread)
    assert tree.leaves > 8 and home.sum() == 2000 and len(row) < 2000 * 2.5
    alike = wide_points([300] * 1000, [0] * 600 + list(range(1, 401)), 20)
    tree = simhash.VantageTree(space, alike, 1)
    row, leaf, home = tree.visits(alike)
    assert tree.leaves == 2 and sorted(np.bincount(leaf[home]).tolist()) == [400, 600]
    assert {int(x) for x in row[leaf == leaf[home & (row == 0)][0]]} == set(range(600))  # the others don't meet those alike there
    assert simhash.VantageTree(space, alike[600:], 6).leaves == 1


def test_pipeline_stage_goes_by_trees(spark, monkeypatch):
    """The pipeline's near-dedup proposes its pairs by ``links``."""
    import corpus_pipeline

    spaces, links = [], simhash.links
    monkeypatch.setattr(simhash, "links", lambda *a, **k: (spaces.append(k.get("space")), links(*a, **k))[1])
    docs = spark.createDataFrame([(1, "a b c d e f g"), (2, "A b c d e f g"), (3, "other words")], "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()) == [1, 3]
    assert [type(s) for s in spaces] == [simhash.Wide]

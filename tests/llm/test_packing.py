import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from chronolake.llm import packing


@pytest.mark.parametrize("seed", range(12))
def test_solver(seed):
    rng = random.Random(seed)
    length = rng.choice([10, 50, 300, 2048])
    counts = Counter(rng.randint(1, length) for _ in range(rng.randint(1, 400)))
    counts[length] += rng.randint(0, 3)
    if seed % 3 == 0:
        counts[max(1, length // 3)] += 5000
    for solve in (packing.best_fit, lambda c, n: packing.complete(c, n).patterns):
        plan = solve(dict(counts), length)
        used = Counter()
        for copies, pattern in plan:
            assert copies > 0 and sum(s * k for s, k in pattern) <= length
            for s, k in pattern:
                used[s] += copies * k
        assert used == +counts
    found = packing.complete(dict(counts), length)
    bins = sum(c for c, _ in found.patterns)
    assert bins == found.sequences and found.bound <= bins
    assert -(-sum(s * c for s, c in counts.items()) // length) <= bins <= sum(c for c, _ in packing.best_fit(dict(counts), length))


def fewest(items, length):
    """Optimal by trying everything."""
    best = [len(items)]

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(items):
            best[0] = len(rooms)
            return
        for r in sorted(set(rooms)):
            if r >= items[i]:
                rooms.remove(r)
                go(i + 1, [*rooms, r - items[i]])
                rooms.append(r)
        go(i + 1, [*rooms, length - items[i]])

    go(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(8))
def test_near_optimal(seed):
    rng = random.Random(seed)
    items = sorted((rng.randint(10, 70) for _ in range(9)), reverse=True)
    got = packing.complete(Counter(items), 100)
    assert got.sequences == fewest(items, 100) and got.proven


@pytest.mark.parametrize("seed", range(60))
def test_exact(seed, monkeypatch):
    """The search without a bound of steps against everything, also with repeated lengths and where nearly
    all levels have to be made anew."""
    monkeypatch.setattr(packing, "LEVELS", 1 if seed % 2 else 16)
    rng = random.Random(seed)
    length = rng.choice([20, 100, 101, 60])
    pool = [rng.randint(length // 8, 3 * length // 4) for _ in range(rng.randint(2, 10))]
    items = sorted((rng.choice(pool) for _ in range(11)), reverse=True)
    got = packing.complete(Counter(items), length, None)
    best = fewest(items, length)
    assert got.sequences == best == sum(c for c, _ in got.patterns) and got.proven and got.bound <= best
    assert packing.least_sequences(Counter(items), length) <= best


def test_steps_are_bounded():
    """Where the bound of steps ends the search, the result says that it isn't proven."""
    rng = random.Random(3)
    hard = Counter(rng.choice([341, 342, 343, 512, 683, 684, 700]) * 2 + 1 for _ in range(400))
    few, many = packing.complete(dict(hard), 2048, 10), packing.complete(dict(hard), 2048, 3000)
    assert few.bound <= many.sequences <= few.sequences and (few.proven is False or few.sequences == few.bound)


TEXTS = ["", None, "Hello world", " lead", "trail ", "two  spaces", "a \nb\n c\t d", "x\n\n  y", "é😀 naïve 中文 text", "don't we'll", "12 345,6 ", "a b " * 3000, "<|endoftext|> x", "a <|endoftext|>  b", "x<|endoftext|><|endoftext|>", "  nb  sp", "word " * 2047, "q" * 5000]


def test_ids():
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(2)
    more = ["".join(rng.choice([" ", "  ", "\n", "a", "B", "ing", ".", "'s", "é", "9", "\t", " "]) for _ in range(rng.randint(1, 40))) for _ in range(2000)]
    for t in TEXTS + more:
        assert np.frombuffer(packing.encoder()(t or ""), "<u4").tolist() == plain.encode(t or "", add_special_tokens=False).ids, repr(t)


def test_pack(spark):
    rng = random.Random(4)
    rows = list(enumerate(TEXTS + [" ".join(rng.choice(["alpha", "beta", "x"]) for _ in range(rng.randint(1, 1500))) for _ in range(200)])) + [(None, "same"), (7, "same"), (7, "same")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS length", "2 AS rank")
    got = packing.pack(docs).collect()
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    want = Counter()
    for d, t in rows:
        ids = np.frombuffer(packing.encoder()(t or ""), "<u4").tolist() + [0]
        first = len(ids) if len(ids) <= 2048 else len(ids) % 2048 or 2048
        starts = [0, *range(first, len(ids), 2048)]
        for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
            want[(d, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    assert len(by) <= -(-sum(k[3] * n for k, n in want.items()) // 2048) + 1
    assert packing.pack(docs.limit(0)).count() == 0
    one = packing.pieces(docs.filter("doc_id = 2"), with_ids=True).first()
    assert len(one.ids) == one.length and one.ids[-1] == 0

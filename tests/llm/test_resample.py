import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from chronolake.llm import resample

DOCS, TARGET = "doc_id long, text string", "item_id long, text string"


def grams_of(text, n):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return words, [" ".join(words[i : i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1)]


def brute(docs, target, n=1, buckets=10_000, percent=10, least=20):
    bucket = lambda g: zlib.crc32(g.encode()) % buckets
    source, aim = (Counter(bucket(g) for t in texts for g in grams_of(t, n)[1]) for texts in ([t for _, t in docs], target))
    s, t = sum(source.values()), sum(aim.values())
    gain = [math.floor(1000 * math.log((aim[b] + 1) * (s + buckets) / ((source[b] + 1) * (t + buckets)))) for b in range(buckets)]
    rows = []
    for doc, text in docs:
        words, own = grams_of(text, n)
        h = int(hashlib.sha256(f"2024:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(g)] for g in own)
        rows.append([doc, len(words), len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    drawn = able[: percent * len(able) // 100]
    ranks = {}
    for i, r in enumerate(drawn):
        ranks.setdefault(tuple(r), []).append(i + 1)
    return sorted([(*r, (ranks.get(tuple(r)) or [None]).pop(0) if ranks.get(tuple(r)) else None) for r in rows], key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def some(rng, n):
    pool = [*"alpha Beta ÉTÉ straße 日本語 x1 2024".split(), "long" * 20, *(f"w{i}" for i in range(60))]
    text = lambda k: "".join(rng.choice(pool) + rng.choice([" ", ", ", "\n", "--", " \t ", "_"]) for _ in range(k))
    return [(i, text(rng.randint(0, 90))) for i in range(n)], [text(30) for _ in range(8)]


@pytest.mark.parametrize("grams", [1, 2, 3])
@pytest.mark.parametrize("size", [1 << 22, 37])
def test_random(spark, monkeypatch, grams, size):
    """Against plain counting, in whole batches and with texts cut into pieces."""
    docs, target = some(random.Random(grams), 300)
    if size < 1000:  # the cutting alone, in this process
        whole, _, _, words = resample.features([(i, t.encode().translate(resample._LOWER), 0) for i, (_, t) in enumerate(docs)], grams, 500)
        counts, got = Counter(), Counter()
        for b, c in zip(whole.bucket, whole.count, strict=True):
            counts[b] += c
        total = 0
        for group in resample.cut([t for _, t in docs], grams, size):
            table, _, _, own = resample.features(group, grams, 500)
            total += own.sum()
            for b, c in zip(table.bucket, table.count, strict=True):
                got[b] += c
        assert +counts == +got and total == words.sum()
        return
    df = spark.createDataFrame(docs, DOCS).repartition(3)
    got = found(resample.resampled(df, spark.createDataFrame(list(enumerate(target)), TARGET), grams))
    assert got == brute(docs, target, grams)


def test_edges(spark):
    """Nulls, repeated rows, ties, empty and very long texts, clashing names, empty tables."""
    long = " ".join(f"word{i % 977}" for i in range(400_000))
    docs = [(1, None), (2, ""), (3, "?!"), (4, long), (None, "a " * 30), (None, "a " * 30), (5, "b " * 25), (5, "b " * 25), (5, "b " * 25), (6, "one" * 500_000)]
    target = [None, "a a b", ""]
    df, aim = spark.createDataFrame(docs, DOCS), spark.createDataFrame(list(enumerate(target)), TARGET)
    want = brute(docs, target, percent=50)
    assert found(resample.resampled(df.selectExpr("*", "1 score", "'x' n", "2 bucket"), aim, percent=50)) == want
    assert sorted(r[5] for r in want if r[5]) == [1, 2, 3]
    assert found(resample.resampled(df, aim.limit(0), percent=50)) == brute(docs, [], percent=50)
    assert resample.resampled(df.limit(0), aim).collect() == []


def test_hashes():
    rng = random.Random(1)
    for n in range(1, 32):
        rows = [rng.randbytes(n) for _ in range(50)]
        matrix = np.frombuffer(b"".join(rows), np.uint8).reshape(50, n)
        assert resample.short_hashes(matrix).tolist() == [xxhash.xxh64_intdigest(r) for r in rows]
        assert resample.short_crcs(matrix).tolist() == [zlib.crc32(r) for r in rows]


def test_collisions(monkeypatch):
    """Equal keys of different n-grams stay apart, by their bytes."""
    monkeypatch.setattr(resample, "short_hashes", lambda rows: np.full(len(rows), 7, np.uint64))
    table, slot, _, _ = resample.features([(0, b"aa bb aa cc bb aa d", 0)], 1, 1000)
    assert len(set(slot.tolist())) == 4 and sorted(table.count[table.count > 0].tolist()) == [1, 1, 2, 3]

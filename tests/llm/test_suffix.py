import random
from collections import defaultdict

import pytest

from chronolake.llm import common, suffix


def joined(starts, size):
    spans = []
    for s in sorted(starts):
        if spans and s <= spans[-1][1]:
            spans[-1][1] = s + size
        else:
            spans.append([s, s + size])
    return [tuple(x) for x in spans]


def plain(rows, size):
    """Every window against every other: (spans, later spans) of each row."""
    places = defaultdict(list)
    for i, (d, t) in enumerate(rows):
        w = (t or "").split()
        for s in range(len(w) - size + 1):
            places[tuple(w[s : s + size])].append((d is not None, d, s, i))
    cover, later = [set() for _ in rows], [set() for _ in rows]
    for own in places.values():
        if len(own) > 1:
            first = min(own, key=lambda p: (p[0], p[1] or 0, p[2]))[:3]
            for *place, i in own:
                cover[i].add(place[2])
                if tuple(place) != first:
                    later[i].add(place[2])
    return [(joined(a, size), joined(b, size)) for a, b in zip(cover, later, strict=True)]


def corpus(size, seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "b", "the", "é"]) if rng.random() < 0.3 else f"w{rng.randint(0, 5000)}"
    passages = [[word() for _ in range(n)] for n in (size - 1, size, size + 1, 3 * size, size + 7)]
    rows = []
    for i in range(60):
        w = [word() for _ in range(rng.randint(0, 4 * size))]
        for _ in range(rng.randint(0, 3)):
            k = rng.randint(0, len(w))
            w[k:k] = rng.choice(passages)
        rows.append((i, " ".join(w)))
    return rows + [(100, rows[3][1]), (101, "x " * (2 * size)), (102, None), (103, ""), (None, rows[4][1]), (5, rows[5][1] + " z")]


@pytest.mark.parametrize("size, gram, sent", [(50, 8, None), (20, 4, None), (12, 3, None), (20, 4, 0)])
def test_against_every_window(spark, size, gram, sent, monkeypatch):
    """Also where keys are too many to be sent and texts are shuffled (``sent`` 0)."""
    if sent is not None:
        monkeypatch.setattr(common, "SENT", sent)
    rows = corpus(size, size)
    rows += [(200 + i, f"own{i} " * 3 + " ".join(f"shared{k}" for k in range(size + 4)) + f" end{i}") for i in range(150)]  # one passage in very many
    rows += [(400, " ".join(["one", "two"] * (3 * size))), (401, rows[3][1]), (3, rows[3][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS start", "2 AS window")
    got = defaultdict(list)
    for r in suffix.passages(docs.repartition(3), size, gram).collect():
        got[(r.doc_id, r.n_words)].append(([(s.start, s.end) for s in r.spans], [(s.start, s.end) for s in r.later]))
    want = defaultdict(list)
    for (d, t), spans in zip(rows, plain(rows, size), strict=True):
        want[(d, len((t or "").split()))].append(spans)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_query_first_and_empty(spark, tmp_path):
    p = " ".join(f"p{i}" for i in range(60))
    rows = [(1, "x " + p + " y"), (2, p), (3, "q"), (3, "q")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in suffix.op7_suffix_dedup(spark, str(tmp_path)).collect())
    assert got == [(1, 62, 1, 60, 0, "1:61", ""), (2, 60, 1, 60, 60, "0:60", "0:60"), (3, 1, 0, 0, 0, "", ""), (3, 1, 0, 0, 0, "", "")]
    assert suffix.passages(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_long_text(spark):
    """A text that is far longer than a part of a batch, with a passage at both ends."""
    rng = random.Random(2)
    p = [f"p{i}" for i in range(70)]
    w = p + [f"w{rng.randrange(10**9)}" for _ in range(900_000)] + p
    docs = spark.createDataFrame([(1, " ".join(w)), (2, "a b " + " ".join(p[:60]))], "doc_id long, text string")
    got = {r.doc_id: ([tuple(s) for s in r.spans], [tuple(s) for s in r.later]) for r in suffix.passages(docs).collect()}
    assert got == {1: ([(0, 70), (900070, 900140)], [(900070, 900140)]), 2: ([(2, 62)], [(2, 62)])}


@pytest.mark.parametrize("many, bits", [(3, 1 << 15), (40, 1 << 28)])
def test_leads_of_very_many(spark, many, bits, monkeypatch):
    """Where all, or some, leads have so many places that their windows are counted apart, and a bit map that
    is full: the same rows."""
    monkeypatch.setattr(suffix, "MANY", many)
    monkeypatch.setattr(suffix, "BITS", bits)
    rows = corpus(20, 7) + [(200 + i, f"own{i} " * 3 + " ".join(f"shared{k}" for k in range(24)) + f" end{i}") for i in range(50)]
    rows += [(3, rows[3][1]), (3, rows[3][1]), (3, rows[8][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_words, [tuple(s) for s in r.spans], [tuple(s) for s in r.later]) for r in suffix.passages(docs.repartition(3), 20, 4).collect()), key=str)
    want = [(d, len((t or "").split()), *spans) for (d, t), spans in zip(rows, plain(rows, 20), strict=True)]
    assert got == sorted(want, key=str)


def test_texts_stay_where_they_are(spark, monkeypatch):
    """Texts without repeats are not shuffled, however many there are."""
    monkeypatch.setattr(common, "SENT", 0)
    rng = random.Random(5)
    rows = [(i, " ".join(f"{rng.randrange(16**12):x}" for _ in range(1000))) for i in range(400)]
    rows += [(1000 + i, " ".join(t.split()[200:260])) for i, t in rows[:3]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    written = lambda: spark.sparkContext._jsc.sc().statusStore().executorSummary("driver").totalShuffleWrite()
    before = written()
    assert suffix.passages(docs).where("size(spans) > 0").count() == 6
    assert written() - before < sum(len(t) for _, t in rows) / 3

import random
from collections import Counter, defaultdict
from fractions import Fraction

import pandas as pd
import pytest

from chronolake.llm import mixing


def slots(blocks, share, **bounds):
    """The whole schedule, piece by piece: [(source, block, slot, release, deadline)]."""
    out = []
    for piece in mixing.phases(blocks, share, **bounds):
        own, n, times = piece[2], piece[5], piece[6]
        for r in mixing.slots_of(piece).itertuples(index=False):
            for k in range(times):
                more = own[r.m_source] * n // sum(own.values())
                out.append((r.m_source, r.m_block + k * more, r.m_slot + k * n, r.m_release + k * n, r.m_deadline + k * n))
    return sorted(out, key=lambda r: r[2])


@pytest.mark.parametrize("seed", range(14))
def test_schedule(seed):
    """Every block once, in its window; in each phase less than one block off the given weights."""
    rng = random.Random(seed)
    names = [f"s{i}" for i in range(rng.randint(1, 12))]
    weights = {s: rng.choice([rng.random() ** 3, Fraction(rng.randint(1, 9), rng.randint(1, 9)), 0.25, 1]) for s in names}
    blocks = {s: rng.randint(0, 900) for s in names}
    got = slots(blocks, mixing.shares(weights), segment=rng.choice([7, 100, 5000]), period=rng.choice([1, 100, 1 << 17]))
    assert [r[2] for r in got] == list(range(sum(blocks.values())))
    assert Counter(r[0] for r in got) == +Counter(blocks)
    had, left, start = Counter(), dict(blocks), 0
    own = {s: Fraction(weights[s]) for s in names if blocks[s]}
    for s, j, t, release, deadline in got:
        assert j == blocks[s] - left[s] and release <= t < deadline
        left[s] -= 1
        had[s] += 1
        total = sum(own.values())
        assert all(abs(had[x] - (t + 1 - start) * own[x] / total) < 1 for x in own)
        if not left[s]:
            had, start = Counter(), t + 1
            own = {x: w for x, w in own.items() if left[x]}


@pytest.mark.parametrize("weights", [{"a": Fraction(1, 3), "b": 0.0001, "c": 0, "d": Fraction(2, 3) - Fraction(1, 10**4)}, {"a": 1 / 3, "b": 0.0001, "c": 0.0, "d": 2 / 3 - 0.0001}])
def test_exact_weights(weights):
    """Over a million slots the bound holds against the weights as given; weight 0 has no slot."""
    blocks = {"a": 10**6, "b": 10**6, "c": 50, "d": 10**6}
    exact, got, slot = {s: Fraction(w) for s, w in weights.items()}, Counter(), 0
    total, share = sum(exact.values()), mixing.shares(weights)
    assert share["c"] == 0 and all(Fraction(share[s], sum(share.values())) == exact[s] / total for s in share)
    edf = mixing.Edf.new({s: n for s, n in share.items() if n})
    for slot in range(1, 10**6 + 1):
        s, j = edf.step()
        got[s] += 1
        # the source that ran is the only one that can be ahead, and at deadlines none is behind
        assert got[s] - slot * float(exact[s] / total) < 1 + 1e-6
        if slot % 9973 == 0:
            assert all(abs(got[x] - slot * exact[x] / total) < 1 for x in exact)
    assert got["b"] in (99, 100, 101) and "c" not in got
    first = next(iter(mixing.phases(blocks, share)))
    assert "c" not in first[2]


def test_mix(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(["a"] * 6 + ["b", "b", "c", None]), f"t{i}") for i in range(3000)] + [(None, "a", "n"), (5, "b", "r"), (5, "b", "r"), (9001, "z", "none"), (9002, "y", "zero")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").selectExpr("*", "1 AS n", "2 AS rank")
    weights = {"a": 0.5, "b": 0.3, "c": Fraction(1, 10), "": 0.1, "y": 0}
    got = mixing.mix(docs, weights, block=16).collect()
    assert Counter((r.doc_id, r.source, r.text) for r in got) == Counter(rows)
    assert {r.source for r in got if r.m_slot is None} == {"y", "z"}
    got = [r for r in got if r.m_slot is not None]
    blocks = defaultdict(list)
    for r in got:
        blocks[(r.m_source, r.m_block)].append(r)
        assert r.m_release <= r.m_slot < r.m_deadline
    sizes = Counter(r.m_source for r in got)
    for (s, k), own in blocks.items():
        assert sorted(r.m_nth for r in own) == list(range(min(16, sizes[s] - 16 * k))) and len({r.m_slot for r in own}) == 1
    at = {own[0].m_slot: s for (s, _), own in blocks.items()}
    assert sorted(at) == list(range(len(blocks)))
    had, ends = Counter(), min(max(own[0].m_slot for (x, _), own in blocks.items() if x == s) for s in sizes)
    total = sum(Fraction(w) for w in weights.values())
    for t in range(ends):
        had[at[t]] += 1
        assert all(abs(had[s] - (t + 1) * Fraction(w) / total) < 1 for s, w in weights.items())
    for again in (mixing.mix(docs.repartition(7), weights, block=16), mixing.mix(docs, weights, block=16, segment=5, period=1)):
        assert Counter((r.doc_id, r.m_slot) for r in again.collect() if r.m_slot is not None) == Counter((r.doc_id, r.m_slot) for r in got)
    order = [r.text for r in mixing.mixed(docs).collect()]
    assert sorted(order) == sorted(t for *_, t in rows) and mixing.mixed(docs).columns == docs.columns
    with pytest.raises(ValueError):
        mixing.shares({"a": -1})


def test_repeats_match_plain_run(spark):
    """Whole periods repeated by SQL give what the run through all blocks gives."""
    blocks, share = {"a": 9000, "b": 9000, "c": 2}, {"a": 2, "b": 1, "c": 1}
    got = sorted(map(tuple, mixing.schedule(spark, blocks, share).collect()), key=lambda r: r[2])
    assert got == slots(blocks, share) == slots(blocks, share, period=1) and len(got) == 18002
    assert isinstance(mixing.slots_of(next(mixing.phases(blocks, share))), pd.DataFrame)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, source string")
    assert mixing.mix(docs).count() == 0

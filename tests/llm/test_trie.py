import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from chronolake.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """The contract, conversation by conversation."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [(r, t) for _, _, r, t in sorted(own)] for c, own in convs.items()}
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(("" if c is None else str(c)).encode()) % 4
        built[c] = (own[:h] if c is None else turns.get(c - c % 20, [])[:h]) + own[h:]
    order = lambda c: (c is not None, c or 0)
    members, ended = defaultdict(list), defaultdict(list)
    for c in sorted(built, key=order):
        for d in range(len(built[c]) + 1):
            members[tuple(built[c][:d])].append(c)
        ended[tuple(built[c])].append(c)
    out = []
    for node, own in members.items():
        below = [x for x in members if x[: len(node)] == node]
        saved = sum((len(members[x]) - 1) * len(words(x[-1][1])) for x in below if x)
        children = [x for x in below if len(x) == len(node) + 1]
        leaves = [x for x in below if not any(len(y) == len(x) + 1 and y[: len(x)] == x for y in below)]
        ids = ",".join("" if c is None else str(c) for c in ended[node])
        out.append((own[0], len(node), members[node[:-1]][0] if node else None, len(own), len(children), len(leaves), saved, hashlib.sha256(ids.encode()).hexdigest()))
    return sorted(out, key=str)


def words(text):
    for c in "\t\n\x0b\x0c\r":
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize(("seed", "share", "least", "queue"), [(0, 1 << 14, 4096, 200_000), (1, 4, 2, 3), (2, 50, 1, 1), (3, 2, 10, 2)])
def test_random(spark, seed, share, least, queue):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(200), 120):
        first = rng.choice(["system prompt", f"own {c}", "other\tprompt  x", ""])
        said = [first, *(rng.choice(["yes", "no", "why so", f"t{c}"]) for _ in range(rng.randint(0, 7)))]
        rows += [(c, i * 2, rng.choice(["user", None]) if i % 3 else "user", t or None) for i, t in enumerate(said)]
    rows += [(4000 + c, i, "user", t) for c in range(60) for i, t in enumerate(["hot", "copy of all", "end"])]
    rng.shuffle(rows)
    got = trie.trie(spark.createDataFrame(rows, SCHEMA).repartition(5), share, least, queue)
    assert found(got) == brute(rows)


def test_edges(spark):
    """Null ids, turns, roles, texts; repeated rows; negative ids; a turnless conversation; a very long text."""
    rows = [(None, None, None, None), (None, 1, "a", "x y"), (-41, 1, "u", "q"), (-40, 1, "u", "q"), (-40, None, "u", "before"), (7, 3, "u", "same"), (7, 3, "u", "same"), (25, 1, None, ""), (25, 2, "b", "w " * 300_000), (9223372036854775807, 1, "u", "z")]
    rows += [(c, 1, "u", "lost") for c in range(101, 120)]  # without 100, short ones lose all turns
    got = found(trie.trie(spark.createDataFrame(rows, SCHEMA)))
    want = brute(rows)
    assert got == want and any(r[1] == 0 and r[7] != hashlib.sha256().hexdigest() for r in got)
    assert found(trie.trie(spark.createDataFrame(rows, SCHEMA).selectExpr("*", "conv_id k1", "text words", "1 depth"), 4, 2, 1)) == want
    empty = trie.trie(spark.createDataFrame([], SCHEMA))
    assert empty.collect() == [] and empty.columns[0] == "conv_id"


def test_deep(spark):
    """A conversation of many turns, and others that leave it at every depth."""
    rows = [(0, i, "u", f"t{i}") for i in range(400)] + [(20 * k + 1, i, "u", f"t{i}" if i < 10 * k else "leaves") for k in range(1, 40) for i in range(10 * k + 1)]
    assert found(trie.trie(spark.createDataFrame(rows, SCHEMA), 8, 5, 20)) == brute(rows)


def test_queue():
    rng, queue, plain = random.Random(5), trie.Queue(4), []
    for _ in range(5000):
        if plain and rng.random() < 0.45:
            want = min(plain)
            plain.remove(want)
            assert queue.first() == want and queue.pop() == want
        else:
            item = (rng.randint(0, 300), rng.randint(0, 10**6))
            plain.append(item)
            queue.push(item)
    assert [queue.pop() for _ in range(len(plain))] == sorted(plain) and queue.first() is None

"""A trie of conversation prefixes, with totals passed up by time-forward processing.

A node is a distinct sequence of first turns (role, text); it is named by 128 bits, the exclusive or
of hashes of its turns with their positions, so prefixes come from one running sum over a conversation.
Texts are hashed where they are read and go no further.

Totals of subtrees go from nodes to parents in reverse level order. A node that more than 1 / ``SHARE`` of
all (conversation, depth) rows belong to is heavy; there are fewer than ``SHARE`` of them, and what is above
a heavy node is heavy. The others hang below in subtrees of a bounded part of all conversations each. Such
subtrees are dealt out by a hash of their roots; a task's nodes are sorted by Spark, deepest first
(on disk where they are many), and go through once: a node takes the messages of its children from a
priority queue, which spills sorted runs to the task's own scratch file, and leaves one for its parent. When a node
meets its children it also tells them its name. What the roots say to heavy parents is summed by parent
before it is shuffled, so a first turn that a third of all conversations share is no large group; then
the heavy nodes go through the same procedure, in one task of fewer than ``SHARE`` rows.

Ids of conversations that end in a node are made to text in blocks of ids, sorted, and digested one block
after the other; SHA-256 runs through a text from its start, so those of one node are digested by one task,
which holds one block at a time.

Nulls and ties: a null turn is first, a null role or text empty; turns of equal number are ordered by role,
then by a hash of the text; repeated rows are turns like any other. Null conv_ids are one conversation,
smaller than all others, whose decimal form is empty; its id comes out null. A conversation's turns are
ordered together by Spark's external sort. Texts of any length are hashed whole, extra columns are
ignored. An empty table gives an empty result: there is no root without a conversation.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronolake.llm import common, resample

EVERY, HEADS, SHARE, LEAST, QUEUE, BLOCK = 20, 4, 1 << 14, 4096, 200_000, 4096
NONE = -(1 << 63)
WORD = r"[^\x20\x09-\x0D]++"


class Queue:
    """A priority queue of tuples. Beyond ``most`` of them the larger half goes to a scratch file, as a sorted run that
    is read back piece by piece."""

    def __init__(self, most: int = QUEUE):
        self.most, self.near, self.runs, self.file = most, [], [], None

    def push(self, item: tuple) -> None:
        heapq.heappush(self.near, item)
        if len(self.near) > self.most:
            self.near.sort()
            keep = self.most // 2
            self._spill(self.near[keep:])
            del self.near[keep:]

    def _spill(self, items: list) -> None:
        self.file = self.file or tempfile.TemporaryFile()  # without a name: gone with the task
        places = []
        self.file.seek(0, 2)
        for at in range(0, len(items), 1000):
            places.append(self.file.tell())
            pickle.dump(items[at : at + 1000], self.file, pickle.HIGHEST_PROTOCOL)
        run = self._read(places)
        heapq.heappush(self.runs, (next(run), len(self.runs), id(run), run))

    def _read(self, places: list[int]):
        for at in places:
            self.file.seek(at)
            yield from pickle.load(self.file)

    def first(self):
        """The smallest, or None."""
        near, far = self.near[:1], self.runs[:1]
        if near and far:
            return min(near[0], far[0][0])
        return near[0] if near else far[0][0] if far else None

    def pop(self) -> tuple:
        if self.runs and (not self.near or self.runs[0][0] < self.near[0]):
            item, n, key, run = self.runs[0]
            if (more := next(run, None)) is None:
                heapq.heappop(self.runs)
            else:
                heapq.heapreplace(self.runs, (more, n, key, run))
            return item
        return heapq.heappop(self.near)


NODE = ["depth", "k1", "k2", "p1", "p2", "conv", "n_convs", "words", "top", "children", "leaves", "saved"]
TOTALS = "k1 long, k2 long, p1 long, p2 long, conv long, depth long, parent long, n_convs long, n_children long, n_leaves long, saved_tokens long, top boolean"


def time_forward(batches, most: int = QUEUE):
    """Nodes in reverse level order (depth falling, then key) -> their totals, in record batches. ``children``, ``leaves``
    and ``saved`` are what a node has been told from elsewhere; a node marked ``top`` has its parent elsewhere."""
    queue, out = Queue(most), []
    schema = pa.schema([(c, pa.bool_() if t == "boolean" else pa.int64()) for c, t in (x.split() for x in TOTALS.split(", "))])

    def written():
        made = pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(schema)], schema=schema)
        out.clear()
        return made

    for batch in common.parts(batches, 10_000):
        for depth, k1, k2, p1, p2, conv, n, words, top, children, leaves, saved in zip(*(batch[c].to_pylist() for c in NODE), strict=True):
            at = (-depth, k1, k2)
            while (first := queue.first()) is not None and first[:3] == at:
                child = queue.pop()[3:]
                out.append((*child[:6], conv, *child[6:], False))
                children, leaves, saved = children + 1, leaves + child[8], saved + child[9]
            leaves, saved = leaves or 1, saved + (n - 1) * words
            own = (k1, k2, p1, p2, conv, depth, n, children, leaves, saved)
            if top:
                out.append((*own[:6], None, *own[6:], True))
            else:
                queue.push((1 - depth, p1, p2, *own))
            if len(out) >= 10_000:
                yield written()
    if queue.first() is not None:
        raise ValueError("a node's parent isn't where the node is")
    if out:
        yield written()


def rebuilt(turns: DataFrame) -> DataFrame:
    """c, depth, k1, k2 (the node), p1, p2 (its parent), words, last: a row for each conversation and each
    of its depths, from 0. One shuffle, of hashes, by the conversation that others take their first turns from."""
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    c = F.coalesce(F.col("conv_id").cast("long"), F.lit(NONE))
    own = turns.select(c.alias("c"), "turn", role.alias("role"), F.xxhash64(role, text).alias("h1"), F.xxhash64(F.lit("second"), text, role).alias("h2"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    own = own.withColumn("b", F.when(F.col("c") == NONE, F.col("c")).otherwise(F.col("c") - F.col("c") % EVERY))
    decimal = F.when(F.col("c") == NONE, "").otherwise(F.col("c").cast("string"))
    own = own.withColumn("h", F.crc32(decimal.cast("binary")) % HEADS).repartition("b")
    of = Window.partitionBy("b", "c").orderBy(F.asc_nulls_first("turn"), "role", "h1", "h2")
    own = own.withColumn("pos", F.row_number().over(of).cast("long")).withColumn("n", F.count("*").over(Window.partitionBy("b", "c")))
    turn = F.struct("pos", "h1", "h2", "words")
    given = F.sort_array(F.collect_list(F.when((F.col("c") == F.col("b")) & (F.col("pos") < HEADS), turn)).over(Window.partitionBy("b")))  # 3 turns at most
    own = own.withColumn("given", given).withColumn("given", F.expr("filter(given, x -> x.pos <= h)"))
    began = F.size("given").cast("long")
    length = began + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    item = lambda pos, h1, h2, words: F.struct(pos.alias("pos"), h1.alias("h1"), h2.alias("h2"), words.alias("words"))
    zero = F.lit(0).cast("long")
    lead = F.when(F.col("pos") == 1, F.concat(F.array(item(zero, zero, zero, zero)), "given")).otherwise(F.array().cast("array<struct<pos:bigint,h1:bigint,h2:bigint,words:bigint>>"))
    tail = F.when(F.col("pos") > F.col("h"), F.array(item(F.col("pos") - F.col("h") + began, F.col("h1"), F.col("h2"), F.col("words"))))
    rows = own.select("b", "c", length.alias("length"), F.explode(F.concat(lead, F.coalesce(tail, F.array().cast("array<struct<pos:bigint,h1:bigint,h2:bigint,words:bigint>>")))).alias("t"))
    rows = rows.select("b", "c", F.col("t.pos").alias("depth"), "length", F.col("t.words").alias("words"), F.col("t.h1").alias("h1"), F.col("t.h2").alias("h2"))
    own_bits = lambda *x: F.when(F.col("depth") == 0, F.lit(0)).otherwise(F.xxhash64(*x))
    rows = rows.withColumn("f1", own_bits("depth", "h1", "h2")).withColumn("f2", own_bits("h2", "depth", "h1"))
    run = Window.partitionBy("b", "c").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("k1", F.bit_xor("f1").over(run)).withColumn("k2", F.bit_xor("f2").over(run))
    return rows.select("c", "depth", "k1", "k2", F.col("k1").bitwiseXOR(F.col("f1")).alias("p1"), F.col("k2").bitwiseXOR(F.col("f2")).alias("p2"), "words", (F.col("depth") == F.col("length")).alias("last"))


def ends(rows: DataFrame) -> DataFrame:
    """k1, k2, sha: the digest of the ids of the conversations that end in a node."""
    decimal = "if(x = -9223372036854775808, '', string(x))"
    block = rows.filter("last").groupBy("k1", "k2", F.expr(f"c div {BLOCK}").alias("block")).agg(F.array_sort(F.collect_list("c")).alias("ids"))  # BLOCK ids at most, twice that around 0
    block = block.select("k1", "k2", "block", F.expr(f"array_join(transform(ids, x -> {decimal}), ',')").alias("ids"))

    def digest(batches):
        key, sha, done = None, None, []
        for batch in common.parts(batches, 1000):
            for k1, k2, ids in zip(*(batch[c].to_pylist() for c in ("k1", "k2", "ids")), strict=True):
                if (k1, k2) == key:
                    sha.update(b",")
                else:
                    if sha:
                        done.append((*key, sha.hexdigest()))
                    key, sha = (k1, k2), hashlib.sha256()
                sha.update(ids.encode())
            if done:
                yield _batch(done)
                done = []
        if sha:
            yield _batch([(*key, sha.hexdigest())])

    def _batch(done):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in done], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string()))], names=["k1", "k2", "sha"])

    return block.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "block").select("k1", "k2", "ids").mapInArrow(digest, "k1 long, k2 long, sha string")


def trie(turns: DataFrame, share: int = SHARE, least: int = LEAST, queue: int = QUEUE) -> DataFrame:
    """The nodes of the trie of the rebuilt conversations (conv_id, turn, role, text)."""
    rows = common.staged(rebuilt(turns), "trie-rows")
    first = lambda c: F.any_value(c).alias(c)  # noqa: E731  equal in all of a node's rows
    nodes = rows.groupBy("k1", "k2").agg(F.min("c").alias("conv"), F.count("*").alias("n_convs"), first("depth"), first("words"), first("p1"), first("p2"))
    nodes = common.staged(nodes, "trie-nodes")
    limit = max(least, (nodes.agg(F.sum("n_convs")).first()[0] or 0) // share)
    heavy = nodes.filter(F.col("n_convs") > limit)  # fewer than `share`
    few = F.broadcast(heavy.select("k1", "k2"))
    parents = F.broadcast(heavy.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.lit(True).alias("above")))
    light = nodes.join(few, ["k1", "k2"], "left_anti").join(parents, ["p1", "p2"], "left").withColumn("top", F.coalesce("above", F.col("depth") == 0)).drop("above")
    # the root of the light subtree that a conversation runs into: one at most
    under = rows.join(few, ["k1", "k2"], "left_anti").join(parents, ["p1", "p2"], "left").filter(F.col("above") | (F.col("depth") == 0))
    under = under.select(F.col("c").alias("conv"), F.col("k1").alias("s1"), F.col("k2").alias("s2"))
    told = [F.lit(0).cast("long").alias(x) for x in ("children", "leaves", "saved")]
    dealt = light.join(under, "conv").select(*NODE[:-3], *told, "s1", "s2").repartition("s1", "s2").sortWithinPartitions(F.desc("depth"), "k1", "k2")
    work = lambda batches: time_forward(batches, queue)
    low = common.staged(dealt.select(*NODE).mapInArrow(work, TOTALS), "trie-totals")
    said = low.filter("top and depth > 0").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
    high = heavy.join(F.broadcast(said), ["k1", "k2"], "left").withColumn("top", F.col("depth") == 0).fillna(0, ["children", "leaves", "saved"])
    high = high.select(*NODE).coalesce(1).sortWithinPartitions(F.desc("depth"), "k1", "k2").mapInArrow(work, TOTALS)
    names = F.broadcast(heavy.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv").alias("over")))
    tops = low.filter("top").join(names, ["p1", "p2"], "left").withColumn("parent", F.when(F.col("depth") > 0, F.col("over"))).drop("over")
    every = low.filter("not top").unionByName(tops).unionByName(high).join(ends(rows), ["k1", "k2"], "left")
    back = lambda c: F.nullif(F.col(c), F.lit(NONE))
    return every.select(
        back("conv").alias("conv_id"),
        "depth",
        back("parent").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("sha", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


def op12_prefix_trie(spark, sf_dir: str) -> DataFrame:
    return trie(common.table(spark, sf_dir, "conversations"))


OP12_SQL = rf"""
WITH o AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
c AS (SELECT c, n, {resample.crc_sql("CAST(c AS VARCHAR)")} % 4 AS h FROM (SELECT c, count(*) AS n FROM o GROUP BY 1), {resample.CRC_TABLE}),
g AS (SELECT c.c, o.pos AS depth, role, text FROM c JOIN o ON o.c = c.c - c.c % 20 AND o.pos <= c.h),
k AS (SELECT c, count(*) AS n FROM g GROUP BY 1),
a AS (SELECT * FROM g UNION ALL SELECT c.c, coalesce(k.n, 0) + o.pos - c.h, role, text FROM c JOIN o ON o.c = c.c AND o.pos > c.h LEFT JOIN k ON k.c = c.c),
t AS (SELECT c, depth, text, string_agg(md5(concat(md5(role), md5(text))), '' ORDER BY depth) OVER (PARTITION BY c ORDER BY depth) AS key FROM a),
l AS (SELECT c.c, coalesce(max(depth), 0) AS length FROM c LEFT JOIN a ON a.c = c.c GROUP BY 1),
m AS MATERIALIZED (SELECT c, depth, md5(key) AS key, CASE WHEN depth > 1 THEN md5(left(key, length(key) - 32)) ELSE 'root' END AS up, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM t UNION ALL SELECT c, 0, 'root', NULL, 0 FROM c),
n AS MATERIALIZED (SELECT key, any_value(up) AS up, any_value(depth) AS depth, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(words) AS own FROM m GROUP BY 1),
p AS (SELECT up, count(*) AS n FROM n WHERE up IS NOT NULL GROUP BY 1),
r AS (SELECT m.key AS above, n.* FROM n JOIN m x ON x.c = n.conv_id AND x.key = n.key JOIN m ON m.c = n.conv_id AND m.depth <= n.depth),
s AS (SELECT above, count(*) FILTER (WHERE key NOT IN (SELECT up FROM p)) AS n_leaves, sum(own) AS saved FROM r GROUP BY 1),
e AS (SELECT key, sha256(string_agg(CAST(m.c AS VARCHAR), ',' ORDER BY m.c)) AS sha FROM m JOIN l ON l.c = m.c AND l.length = m.depth GROUP BY 1)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(p.n, 0) AS n_children, n_leaves, CAST(saved AS BIGINT) AS saved_tokens, coalesce(sha, sha256('')) AS ends_sha256
FROM n LEFT JOIN n u ON u.key = n.up LEFT JOIN p ON p.up = n.key JOIN s ON s.above = n.key LEFT JOIN e ON e.key = n.key
"""

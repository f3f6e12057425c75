"""Mixing sources to target weights by a Pfair schedule.

A source's documents, in an order given by a hash, form blocks of ``BLOCK`` documents. Weights are exact
fractions (``shares``: whole numbers that stand to each other as the weights do, whose sum is the
period). Block j of a source of weight w is released at slot floor(j / w) and due by slot
ceil((j + 1) / w); in every slot the released block with the earliest deadline runs. After any number of
slots each source has had its weight's share to within less than one block.

Sources don't end at the same slot. When one has no block left, a new phase begins, in which the others
share the slots as their weights stand to each other; the bound holds in every phase, counted from its
first slot. So no slot is empty, and there are as many slots as blocks.

Only a phase's first period has to be worked out, as the schedule repeats. Where weights have no
period of ``PERIOD`` slots or less (1/3 given as a float has one of 2^54), the driver runs through the blocks once,
keeping the state of the schedule at every ``SEGMENT``-th slot, and tasks work out the segments from
there. A hash bucket gets the slots of all blocks that it has rows of, so that whole rows are shuffled
once, by bucket, whatever the size.

Ranks within a source are counted in two levels (source, then a hash bucket), so that a source that
holds most documents isn't ordered in one task. The number of sources must be small against a corpus:
their sizes go through the driver.

Without given weights, a source's weight (column m_weight) is its number of documents to the power
``POWER``, rounded to whole parts in ``PARTS`` of the sum, one part at least: nobody's target, but a
usual flattening.

Nulls: a null source is scheduled as the source ''. A source with weight 0, or that given weights don't
name, has no slot: its m_slot, m_release and m_deadline are null. Negative weights are an error. Null or
repeated doc_ids and repeated rows are placed like any other, equal rows in any order; texts of any
length are only hashed; extra columns are kept. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from fractions import Fraction
from math import gcd, lcm

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronolake.llm import common

BLOCK, POWER, PARTS, ROWS, SEGMENT, PERIOD, FEW = 64, 0.7, 10_000, 4000, 1 << 17, 1 << 17, 4096
AT = "mix_at"


def shares(weights: dict[str, float | Fraction]) -> dict[str, int]:
    """Whole numbers without a common divisor, exactly in proportion to the weights."""
    exact = {s: Fraction(w) for s, w in weights.items()}
    if any(w < 0 for w in exact.values()):
        raise ValueError("a weight is negative")
    scale = lcm(*(w.denominator for w in exact.values())) if exact else 1
    whole = {s: int(w * scale) for s, w in exact.items()}
    common_part = gcd(*whole.values()) or 1
    return {s: n // common_part for s, n in whole.items()}


def by_size(sizes: dict[str, int]) -> dict[str, int]:
    """The weights of sources that nobody gave weights for, in parts of ``PARTS`` (of a little more, as
    each has one at least)."""
    total = sum(n**POWER for n in sizes.values())
    return {s: max(1, round(PARTS * n**POWER / total)) for s, n in sizes.items()}


class Edf:
    """Earliest deadline first among the released blocks of sources with whole shares; ``state`` is what
    it takes to go on from the present slot."""

    def __init__(self, share: dict[str, int], state: tuple[int, dict[str, int]] | None = None):
        self.share, self.period = share, sum(share.values())
        self.slot, self.next = state[0], dict(state[1])
        self.wait, self.ready = [], []
        for s in sorted(share):
            self._release(s)

    @classmethod
    def new(cls, share: dict[str, int]) -> Edf:
        return cls(share, (0, dict.fromkeys(share, 0)))

    def _release(self, s: str) -> None:
        j, w = self.next[s], self.share[s]
        heapq.heappush(self.wait, (j * self.period // w, s))

    def step(self) -> tuple[str, int]:
        """(source, block) of the present slot."""
        while self.wait and self.wait[0][0] <= self.slot:
            _, s = heapq.heappop(self.wait)
            heapq.heappush(self.ready, (-(-(self.next[s] + 1) * self.period // self.share[s]), s))
        _, s = heapq.heappop(self.ready)
        j = self.next[s]
        self.next[s], self.slot = j + 1, self.slot + 1
        self._release(s)
        return s, j

    def state(self) -> tuple[int, dict[str, int]]:
        return self.slot, dict(self.next)


def window(j: int, share: int, period: int) -> tuple[int, int]:
    """Release and deadline of block j."""
    return j * period // share, -(-(j + 1) * period // share)


def phases(blocks: dict[str, int], share: dict[str, int], segment: int = SEGMENT, period: int = PERIOD):
    """The schedule of ``blocks`` (how many each source has) in pieces to be worked out apart: (first
    slot, its phase's first slot, shares of the sources left, state within the phase, first block of
    each in the phase, slots, how often they repeat)."""
    left = {s: n for s, n in sorted(blocks.items()) if n and share.get(s)}
    at, had = 0, dict.fromkeys(left, 0)
    while left:
        own = shares({s: share[s] for s in left})
        edf, start, first = Edf.new(own), at, dict(had)
        unit = max(1, FEW // edf.period)  # periods that are worked out together, so that few have to be repeated
        times = min(left[s] // (own[s] * unit) for s in own)
        if times and edf.period <= period:
            yield at, start, own, edf.state(), first, edf.period * unit, times
            edf = Edf(own, (times * unit * edf.period, {s: times * unit * own[s] for s in own}))
            at += edf.slot
        ended = any(edf.next[s] == left[s] for s in own)
        while not ended:
            begun, state = at, edf.state()
            while at < begun + segment and not ended:
                s, j = edf.step()
                at, ended = at + 1, j + 1 == left[s]
            yield begun, start, own, state, first, at - begun, 1
        had |= {s: had[s] + edf.next[s] for s in own}
        left = {s: left[s] - edf.next[s] for s in own if left[s] > edf.next[s]}


def slots_of(piece) -> pd.DataFrame:
    """m_source, m_block (of the whole source), slot, release and deadline of one piece's first run."""
    begun, start, own, state, first, n, _ = piece
    edf, rows = Edf(own, state), []
    for k in range(n):
        s, j = edf.step()
        release, deadline = window(j, own[s], edf.period)
        rows.append((s, first[s] + j, begun + k, start + release, start + deadline))
    return pd.DataFrame(rows, columns=["m_source", "m_block", "m_slot", "m_release", "m_deadline"])


def schedule(spark, blocks: dict[str, int], share: dict[str, int], segment: int = SEGMENT, period: int = PERIOD) -> DataFrame:
    """m_source, m_block, m_slot, m_release, m_deadline of every block with a share; a written table."""
    pieces = list(phases(blocks, share, segment, period))

    def work(frames):
        for f in frames:
            for k in f["k"].tolist():
                yield slots_of(pieces[k]).assign(k=k)

    kinds = "m_source string, m_block long, m_slot long, m_release long, m_deadline long"
    if not pieces:
        return spark.createDataFrame([], kinds)
    once = spark.range(len(pieces), numPartitions=min(len(pieces), 1024)).select(F.col("id").alias("k")).mapInPandas(work, kinds + ", k long")
    each = [(k, s, own[s] * n // sum(own.values()), n, times) for k, (_, _, own, _, _, n, times) in enumerate(pieces) for s in own if times > 1]
    again = spark.createDataFrame(each, "k long, m_source string, own long, slots long, times long")
    rows = once.join(F.broadcast(again), ["k", "m_source"], "left")  # one piece at most of a phase repeats; a phase ends a source
    rows = rows.withColumn("nth", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("times", F.lit(1)) - 1)))
    on = lambda c, by: (F.col(c) + F.col("nth") * F.coalesce(by, F.lit(0))).alias(c)
    return common.staged(rows.select("m_source", on("m_block", "own"), *(on(c, "slots") for c in ("m_slot", "m_release", "m_deadline"))), "mix-slots")


def mix(docs: DataFrame, weights: dict[str, float | Fraction] | None = None, block: int = BLOCK, segment: int = SEGMENT, period: int = PERIOD) -> DataFrame:
    """The rows of ``docs`` (doc_id, source, ...) with m_source, m_weight, m_block (in its source),
    m_nth (in its block), m_slot, m_release and m_deadline."""
    spark = docs.sparkSession
    text = [F.xxhash64(F.col("text").cast("string"))] if "text" in docs.columns else []
    df = docs.withColumn("m_source", F.coalesce(F.col("source").cast("string"), F.lit(""))).withColumn("m_hash", F.xxhash64("doc_id", *text))
    sizes = {r.m_source: r.n for r in df.groupBy("m_source").agg(F.count("*").alias("n")).collect()}
    share = shares(by_size(sizes) if weights is None else {s: weights.get(s, 0) for s in sizes})
    blocks = {s: -(-n // block) for s, n in sizes.items()}
    plan = schedule(spark, blocks, share, segment, period)
    buckets = {s: -(-n // ROWS) for s, n in sizes.items()}
    known = spark.createDataFrame([(s, buckets[s], float(Fraction(share[s], sum(share.values()) or 1))) for s in sorted(sizes)], "m_source string, m_buckets long, m_weight double")
    df = df.join(F.broadcast(known), "m_source").withColumn("m_bucket", F.pmod("m_hash", F.col("m_buckets")))  # a row for each source
    cells = common.staged(df.groupBy("m_source", "m_bucket").agg(F.count("*").alias("n")), "mix-cells")
    cells = common.before(cells, "m_bucket", "n", "m_source").select("m_source", "m_bucket", F.col("before").alias("m_before"), "n")
    runs = cells.withColumn("m_block", F.expr(f"explode(sequence(m_before div {block}, (m_before + n - 1) div {block}))"))
    places = F.sort_array(F.collect_list(F.struct("m_block", "m_slot", "m_release", "m_deadline"))).alias("m_places")
    cells = runs.join(plan, ["m_source", "m_block"], "left").groupBy("m_source", "m_bucket", "m_before").agg(places)
    nth = F.row_number().over(Window.partitionBy("m_source", "m_bucket").orderBy("m_hash", "doc_id"))
    df = df.withColumn("m_row", nth).join(cells, ["m_source", "m_bucket"])  # as the window dealt them out: whole rows move once
    df = df.withColumn("m_nth", ((F.col("m_before") + F.col("m_row") - 1) % block).cast("long"))
    df = df.withColumn("m_at", F.get("m_places", F.expr(f"cast((m_before + m_row - 1) div {block} - m_before div {block} as int)")))
    return df.select(*docs.columns, "m_source", "m_weight", "m_at.m_block", "m_nth", "m_at.m_slot", "m_at.m_release", "m_at.m_deadline")


def mixed(docs: DataFrame, weights: dict[str, float | Fraction] | None = None) -> DataFrame:
    """The rows of ``docs`` that have a slot, in the order of the mix: partition by partition, row by row."""
    return placed(docs, weights).orderBy(AT).select(*docs.columns)


def placed(docs: DataFrame, weights: dict[str, float | Fraction] | None = None) -> DataFrame:
    """The rows of ``docs`` that have a slot, with their place in the mix (``AT``), as order doesn't
    outlive a shuffle."""
    return mix(docs, weights).filter("m_slot is not null").select(*docs.columns, (F.col("m_slot") * BLOCK + F.col("m_nth")).alias(AT))


def op6_mixing(spark, sf_dir: str) -> DataFrame:
    df = mix(common.table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return df.select("doc_id", "source", F.col("m_weight").alias("weight"), F.col("m_block").alias("block"), F.col("m_nth").alias("nth"), F.col("m_slot").alias("slot"), F.col("m_release").alias("release"), F.col("m_deadline").alias("deadline"))

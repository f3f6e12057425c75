"""License scans: an exact set-similarity join of text blocks with license templates.

Words are runs of digits, a-z and non-ASCII characters after lower-casing A-Z. A template of n words is
held against blocks of the least power of two words that is 2 n or more (``BLOCK`` at least), and a new block
begins every half block, so that any passage of up to half a block lies whole in one, however long or short a
template is. A template and a block match if the block holds at least ``LEAST`` of the template's
distinct words; of a template of fewer than ``FULL`` distinct words, whose words are mostly everybody's, all of
them. All such pairs are found: words are ordered by how often they occur in the whole
corpus, rarest first; a match must share a word of the template's prefix and of the block's prefix in
that order (prefix filter), have enough words at all (length filter), and still be able to reach the
overlap from the places where the shared word stands (positional filter); what is left is counted.
The templates are a parameter and small, so each task holds their index and blocks are not shuffled.

All matches are returned (column matches). Variants of one notice (cc-by and cc-by-nc) differ by less than
the threshold, so that all of them match where one stands. A match gives a label only if it has evidence
of its own: if the block still matches without the words of the passages of better matches (by
containment, then by distinct words) of templates that share enough of its own. A match's passage is
the window of ``SLACK`` times the template's words in the block that holds most of its distinct words,
the first of equals. A document's labels are those of its matches with evidence of their own and those of
its base phrases; its score is 1 if it has a base phrase, else the best containment among the former,
else 0.

Nulls: a null or empty text has no words, no labels and score 0. Rows stay as they are, repeated or
not; null doc_ids too; extra columns are ignored. Very long texts are scanned whole, block by block. An
empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from math import ceil
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronolake.llm import common
from chronolake.llm.license_texts import PHRASES, TEMPLATES

BLOCK, LEAST, SLACK, FULL = 8, 0.8, 1.25, 12

_WORD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD).split()


class Match(NamedTuple):
    template: int
    start: int  # first word of the block
    size: int  # words of the block
    containment: float
    own: bool  # is there evidence apart from better matches of variants?


def block_size(n: int, least: int = BLOCK) -> int:
    """Words of the blocks that a template of n words is held against."""
    return max(least, 1 << (2 * n - 1).bit_length())


def block_starts(n: int, size: int) -> range:
    """The blocks of n words: one every half block, until one reaches the end."""
    return range(0, max(1, n - size // 2) if n > size else 1, size // 2)


def passage(block: list[bytes], wanted: frozenset[bytes], n: int) -> tuple[int, int]:
    """The first window of up to ``n`` words with the most distinct ones of ``wanted``."""
    inside: Counter = Counter()
    best, at = 0, 0
    for i, w in enumerate(block):
        if w in wanted:
            inside[w] += 1
        if i >= n and block[i - n] in wanted:
            inside[block[i - n]] -= 1
            if not inside[block[i - n]]:
                del inside[block[i - n]]
        if len(inside) > best:
            best, at = len(inside), max(0, i - n + 1)
    return at, min(len(block), at + n)


class Index:
    """The templates under a global order of words."""

    def __init__(self, templates, counts: dict[str, int], least: float = LEAST, block: int = BLOCK):
        given = [(label, words(text)) for label, text in templates]
        self.labels, self.lengths, self.sets = [x for x, _ in given], [len(w) for _, w in given], [frozenset(w) for _, w in given]
        every = sorted(set().union(*self.sets), key=lambda w: (counts.get(w.decode(), 0), w))
        self.rank = {w: i for i, w in enumerate(every)}
        self.need = [len(w) if len(w) < FULL else ceil(least * len(w) - 1e-9) for w in self.sets]
        self.prefix: dict[int, dict[bytes, list[tuple[int, int]]]] = {}  # of each size of block
        for t, w in enumerate(self.sets):
            own = self.prefix.setdefault(block_size(self.lengths[t], block), {})
            for i, x in enumerate(sorted(w, key=self.rank.get)[: len(w) - self.need[t] + 1]):
                own.setdefault(x, []).append((t, i))
        self.any = frozenset(w for own in self.prefix.values() for w in own)
        # the templates that share enough of each
        self.variants = [[b for b, y in enumerate(self.sets) if b != a and len(x & y) >= self.need[a]] for a, x in enumerate(self.sets)]

    def block(self, block: list[bytes], size: int) -> list[tuple[int, float]]:
        """(template, containment) of all templates for blocks of that size that the block holds enough of."""
        own = sorted({w for w in block if w in self.rank}, key=self.rank.get)
        tried, out = set(), []
        for j, w in enumerate(own):
            for t, i in self.prefix[size].get(w, ()):
                need, n = self.need[t], len(self.sets[t])
                if t in tried or len(own) < need or j > len(own) - need or 1 + min(n - i - 1, len(own) - j - 1) < need:
                    continue
                tried.add(t)
                overlap = len(self.sets[t].intersection(own))
                if overlap >= need:
                    out.append((t, overlap / n))
        return out

    def document(self, words: list[bytes]) -> list[Match]:
        """All matches of a document."""
        if self.any.isdisjoint(words):
            return []
        found = []
        for size, prefix in self.prefix.items():
            step, ends = size // 2, block_starts(len(words), size)
            at = {b * step for i, w in enumerate(words) if w in prefix for b in (i // step, i // step - 1) if b >= 0}
            for s in sorted(s for s in at if s in ends):
                found += [(t, s, size, share) for t, share in self.block(words[s : s + size], size)]
        held: dict[int, list[tuple[tuple[float, int], range]]] = {}
        if len({t for t, *_ in found}) > 1:
            for t, s, size, share in found:
                a, b = passage(words[s : s + size], self.sets[t], int(SLACK * self.lengths[t]))
                held.setdefault(t, []).append(((share, len(self.sets[t])), range(s + a, s + b)))
        out = []
        for t, s, size, share in found:
            taken = {i for b in self.variants[t] for rank, own in held.get(b, ()) if rank > (share, len(self.sets[t])) for i in own}
            rest = {w for i, w in enumerate(words[s : s + size], s) if i not in taken} if taken else None
            out.append(Match(t, s, size, share, rest is None or len(self.sets[t] & rest) >= self.need[t]))
        return out


def base(words: list[bytes]) -> list[tuple[int, str]]:
    """(first word, label) of every place where a base phrase stands."""
    out = []
    for phrase, label in PHRASES.items():
        parts = phrase.encode().split()
        n, at = len(parts), -1
        while True:
            try:
                at = words.index(parts[-1], at + 1)
            except ValueError:
                break
            if at >= n - 1 and words[at - n + 1 : at + 1] == parts:
                out.append((at - n + 1, label))
    return out


def frequencies(docs: DataFrame, templates=TEMPLATES) -> dict[str, int]:
    """How often each word of the templates occurs in all texts (as many rows as they have words)."""
    known = {w for _, text in templates for w in words(text)}

    def work(batches):
        seen: Counter = Counter()
        for batch in common.parts(batches):
            for text in batch["text"].to_pylist():
                seen.update(filter(known.__contains__, words(text)))
        names = sorted(seen)
        yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in names], pa.string()), pa.array([seen[w] for w in names], pa.int64())], names=["word", "n"])

    rows = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(work, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {r.word: r.n for r in rows.collect()}


MATCHES = "array<struct<label:string,template:int,first_word:bigint,words:bigint,containment:double,own:boolean>>"


def scan(docs: DataFrame, templates=TEMPLATES, least: float = LEAST, block: int = BLOCK) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and matches: of each
    match the label, the template's place in ``templates``, the block's first word and size, the
    containment and whether it has evidence of its own."""
    index = Index(templates, frequencies(docs, templates), least, block)
    match = pa.list_(pa.struct([("label", pa.string()), ("template", pa.int32()), ("first_word", pa.int64()), ("words", pa.int64()), ("containment", pa.float64()), ("own", pa.bool_())]))
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "matches"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), match]

    def work(batches):
        for batch in common.parts(batches):
            rows = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                w = words(text)
                places, found = base(w), index.document(w)
                at, own = [p for p, _ in places], {x for _, x in places}
                score = 1.0 if places else max((m.containment for m in found if m.own), default=0.0)
                labels = own | {index.labels[m.template] for m in found if m.own}
                hits = [{"label": index.labels[m.template], "template": m.template, "first_word": m.start, "words": m.size, "containment": m.containment, "own": m.own} for m in found]
                rows.append((doc_id, len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(own)), ",".join(sorted(labels)), score, hits))
            columns = zip(*rows, strict=True) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = f"doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, matches {MATCHES}"
    return given.mapInArrow(work, schema)


def op1_license_scan(spark, sf_dir: str) -> DataFrame:
    df = scan(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return df.withColumn("n_matches", F.size("matches").cast("long")).withColumn("matches", F.transform("matches", lambda m: F.struct(m["label"].alias("label"), m["first_word"].alias("first_word"), m["containment"].alias("containment"))))

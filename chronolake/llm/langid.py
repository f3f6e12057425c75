"""Language identification by unigrams over all segmentations.

Each language has a probability for every piece of a fixed public vocabulary; the probability of a
word is the sum over all its segmentations into pieces (forward algorithm), that of a text the
product over its words (runs of what is not an ASCII non-letter, lower case, with a mark in front).
Probabilities are trained by expectation maximisation over the same segmentations. A text takes the
language under which it is most probable; the score is that language's posterior at the evidence of
``EVIDENCE`` words at most, so that long texts don't all score 1.

Training reads a sample of about ``SAMPLE`` labelled rows of each language (all, where there are
fewer), chosen by a hash of doc_id, and all words of these; the bound is a parameter. A round of training
is one job: tasks share out the distinct words and send back what each piece is expected to occur, so
that no language is one task. Everything else covers all rows. Held-out rows, whose crc32(doc_id) mod 3
is 1, are never trained on; lang, source and doc_id are no inputs of a prediction.

Nulls: a null text, or one without a letter, is ``und`` with score 0. A row with null lang or doc_id
is not trained on, and one with null doc_id is not held out. Without any training row all is ``und``.
Of equally probable languages the first in order wins. Very long texts and words are read whole. Rows
stay as they are, repeated or not, extra columns too. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from math import exp, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from chronolake.llm import common

SAMPLE, ROUNDS, EVIDENCE, WORDS_KEPT = 2000, 3, 20, 100_000
UNKNOWN, SMOOTH = 1e-7, 0.5
MARK, LONG = "▁", 40
_KEY, _NONE = np.uint64(0x9E3779B97F4A7C15), np.zeros(0, np.uint64)
_SPLIT = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "replace").translate(_SPLIT).split()


def has_letter(text: str | None) -> bool:
    return any(c.isalpha() for c in text or "")


def vocabulary(path: str | None = None) -> list[str]:
    """The pieces of a public tokenizer that are letters, with or without the mark in front."""
    import public_tokenizers
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))
    found = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    return sorted({p for p in found if (p[1:] if p[0] == MARK else p).isalpha() and p == p.lower()} | {MARK})


def _matches(word: str, table: dict) -> list[list[tuple[int, str]]]:
    """For each position, (end, piece) of the pieces that begin there; ``table`` has prefixes too."""
    out = []
    for i in range(len(word)):
        here = []
        for j in range(i + 1, len(word) + 1):
            piece = word[i:j]
            if piece not in table:
                break
            if table[piece] is not None:
                here.append((j, piece))
        if not here or here[0][0] > i + 1:
            here.insert(0, (i + 1, ""))  # an unknown character
        out.append(here)
    return out


def _with_prefixes(table: dict) -> dict:
    return dict.fromkeys(p[:k] for p in table for k in range(1, len(p))) | table


PART, SMALL = 60, 1e-100


def _marked(word: str) -> list[str]:
    """A word with its mark, in parts of ``PART`` letters."""
    return [(MARK if k == 0 else "") + word[k : k + PART] for k in range(0, len(word), PART)]


def seen_pieces(counts: dict[str, int], table: dict) -> Counter:
    """How often each piece stands anywhere in the words."""
    seen: Counter = Counter()
    for w, n in counts.items():
        for part in _marked(w):
            for here in _matches(part, table):
                for _, piece in here:
                    if piece:
                        seen[piece] += n
    return seen


def expected_pieces(counts: dict[str, int], table: dict, prob: dict[str, float]) -> Counter:
    """How often each piece is expected in the words' segmentations. Sums that get small are scaled up,
    and how often that happened is kept, so that no word is too long or too rare."""
    out: Counter = Counter()
    for w, n in counts.items():
        for part in _marked(w):
            matches, size = _matches(part, table), len(part)
            ahead, times, scale = [1.0] + [0.0] * size, [0] * (size + 1), 0
            for i in range(size):
                if 0 < ahead[i] < SMALL:
                    scale += 1
                    for j in range(i, size + 1):
                        ahead[j] /= SMALL
                times[i] = scale
                for j, p in matches[i]:
                    ahead[j] += ahead[i] * prob[p]
            behind, back, scale = [0.0] * size + [1.0], [0] * (size + 1), 0
            for i in range(size - 1, -1, -1):
                behind[i] = sum(prob[p] * behind[j] * SMALL ** max(-3, back[j] - scale) for j, p in matches[i])
                if 0 < behind[i] < SMALL:
                    behind[i] /= SMALL
                    scale += 1
                back[i] = scale
            for i in range(size):
                share = n * ahead[i] / behind[0]
                for j, p in matches[i]:
                    if p:
                        out[p] += share * prob[p] * behind[j] * SMALL ** max(-3, times[i] + back[j] - back[0])
    return out


def _normal(expected: dict[str, float], seen: dict[str, float]) -> dict[str, float]:
    total = sum(expected.values()) + SMOOTH * len(seen)
    return {p: (expected.get(p, 0.0) + SMOOTH) / total for p in seen}


def train(counts: dict[str, int], pieces: list[str], rounds: int = ROUNDS) -> dict[str, float]:
    """Piece probabilities of one language from its word counts, in one place; ``fit`` does the same in
    tasks."""
    table = _with_prefixes(dict.fromkeys(pieces, 1.0))
    seen = seen_pieces(counts, table)
    total = max(1, sum(seen.values()))
    prob = {p: c / total for p, c in seen.items()}
    for _ in range(rounds):
        prob = _normal(expected_pieces(counts, table, prob | {"": UNKNOWN}), seen)
    return prob


class Model:
    """All languages' probabilities; ``least`` is what a language gives a piece it hasn't seen."""

    def __init__(self, learned: dict[str, dict[str, float]]):
        self.langs = sorted(learned)
        self.least = [min(learned[x].values(), default=UNKNOWN) / 2 for x in self.langs]
        pieces = {p: tuple(learned[x].get(p, m) for x, m in zip(self.langs, self.least, strict=True)) for p in sorted({p for t in learned.values() for p in t})}
        self.table = _with_prefixes(pieces)
        self.unknown = (UNKNOWN,) * len(self.langs)
        # for each piece length: the pieces' keys in order and their probabilities
        self.sized: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size in sorted({len(p) for p in pieces}):
            own = [p for p in pieces if len(p) == size]
            keys = np.zeros(len(own), np.uint64)
            for c in np.array(own, f"<U{size}").view(np.uint32).reshape(len(own), size).T:
                keys = keys * _KEY + c.astype(np.uint64)
            order = np.argsort(keys)
            self.sized[size] = (keys[order], np.array([pieces[p] for p in own])[order])
        self.name = hashlib.blake2b(repr((self.langs, self.least, pieces)).encode(), digest_size=16).hexdigest()
        self.index: dict[bytes, int] = {}
        self.logs = np.zeros((0, len(self.langs)))

    def __getstate__(self):
        return self.__dict__ | {"index": {}, "logs": np.zeros((0, len(self.langs)))}

    def many(self, raws: list[bytes]) -> np.ndarray:
        """Log probabilities of words (rows) in each language (columns), words of one length at a time."""
        given = [MARK + r.decode("utf-8", "replace") for r in raws]
        out, lengths = np.zeros((len(given), len(self.langs))), np.fromiter(map(len, given), np.int64, len(given))
        for size in np.unique(lengths).tolist():
            rows = np.flatnonzero(lengths == size)
            if size > LONG:
                for i in rows.tolist():
                    out[i] = self.word(raws[i])
                continue
            letters = np.array([given[i] for i in rows.tolist()], f"<U{size}").view(np.uint32).reshape(len(rows), size).astype(np.uint64).T
            ahead = np.zeros((size + 1, len(rows), len(self.langs)))
            ahead[0] = 1.0
            for i in range(size):
                key = np.zeros(len(rows), np.uint64)
                for n in range(1, min(size - i, max(self.sized, default=1)) + 1):
                    key = key * _KEY + letters[i + n - 1]
                    keys, probs = self.sized.get(n, (_NONE, None))
                    if len(keys):
                        at = np.searchsorted(keys, key)
                        at[at == len(keys)] = 0
                        hit = np.flatnonzero(keys[at] == key)
                        ahead[i + n, hit] += ahead[i, hit] * probs[at[hit]]
                    else:
                        hit = _NONE
                    if n == 1 and len(hit) < len(rows):
                        miss = np.ones(len(rows), bool)
                        miss[hit.astype(np.int64)] = False
                        ahead[i + 1, miss] += ahead[i, miss] * UNKNOWN
            out[rows] = np.log(np.maximum(ahead[size], 1e-320))
        return out

    def word(self, raw: bytes) -> tuple[float, ...]:
        """Log probability of a word in each language."""
        word, table, none = MARK + raw.decode("utf-8", "replace"), self.table, self.unknown
        size, n = len(word), len(self.langs)
        ahead: list = [None] * (size + 1)
        ahead[0], scale = [1.0] * n, 0.0
        for i in range(size):
            at = ahead[i]
            if at is None:
                continue
            if max(at) < 1e-150:  # the same factor for all positions still open
                for j in range(i, min(size, i + 70) + 1):
                    if ahead[j] is not None:
                        ahead[j] = [x * 1e150 for x in ahead[j]]
                at, scale = ahead[i], scale - log(1e150)
            single = False
            for j in range(i + 1, size + 1):
                piece = word[i:j]
                probs = table.get(piece, 0)
                if probs == 0:
                    break
                if probs is not None:
                    single |= j == i + 1
                    to = ahead[j]
                    ahead[j] = [a * p for a, p in zip(at, probs)] if to is None else [t + a * p for t, a, p in zip(to, at, probs)]  # noqa: B905
            if not single:
                to = ahead[i + 1]
                ahead[i + 1] = [a * p for a, p in zip(at, none)] if to is None else [t + a * p for t, a, p in zip(to, at, none)]  # noqa: B905
        return tuple(log(max(x, 1e-320)) + scale for x in ahead[size])

    def classify(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language and score of each text. The first ``WORDS_KEPT`` words are remembered."""
        given = [words(t) if self.langs and has_letter(t) else [] for t in texts]
        known, new, n = self.index.get, {}, len(self.index)
        places = [n + new.setdefault(w, len(new)) if (k := known(w)) is None else k for own in given for w in own]
        fresh = list(new)
        logs = self.many(fresh)
        sizes = np.fromiter(map(len, given), np.int64, len(given))
        total, step = np.zeros((len(given), len(self.langs))), np.repeat(np.arange(len(given)), sizes)
        at = np.array(places, np.int64)
        kept = at < n
        for k in range(len(self.langs)):
            each = np.empty(len(at))
            each[kept], each[~kept] = self.logs[at[kept], k], logs[at[~kept] - n, k]
            total[:, k] = np.bincount(step, each, len(given))
        if fresh and (room := WORDS_KEPT - n) > 0:
            self.index |= {w: n + i for i, w in enumerate(fresh[:room])}
            self.logs = np.concatenate((self.logs, logs[:room]))
        out = []
        for t, size in zip(total.tolist(), sizes.tolist(), strict=True):
            if not size:
                out.append(("und", 0.0))
                continue
            best = max(range(len(t)), key=lambda i: (t[i], -i))
            weight = min(size, EVIDENCE) / size
            out.append((self.langs[best], 1 / sum(exp(max(-700.0, (x - t[best]) * weight)) for x in t)))
        return out


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, sample: int = SAMPLE, rounds: int = ROUNDS) -> Model:
    """Learns from the rows of ``docs`` (doc_id, text, lang) that aren't held out."""
    rows = docs.filter("doc_id is not null and lang is not null and text is not null").filter(~held_out()).select(F.col("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return Model({})
    share = F.create_map(*(F.lit(x) for lang, n in sorted(counts.items()) for x in (lang, min(1.0, sample / n))))
    chosen = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.coalesce(F.element_at(share, F.col("lang")), F.lit(0.0)) * (1 << 20))

    def count(batches):
        for batch in common.parts(batches):
            by: dict[str, Counter] = {}
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
                by.setdefault(lang, Counter()).update(words(text))
            rows = [(lang, w.decode("utf-8", "replace"), n) for lang, c in by.items() for w, n in c.items()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.string(), pa.int64()))], names=["lang", "word", "n"])

    known = chosen.select("lang", "text").mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    known = common.staged(known.repartition("lang", "word"), "langid-words")
    pieces = vocabulary()

    def summed(learned: dict[str, dict[str, float]] | None) -> dict[str, dict[str, float]]:
        """What every piece occurs in all words, or is expected to: the vocabulary, for each language."""

        def work(batches):
            table = _with_prefixes(dict.fromkeys(pieces, 1.0))
            for batch in common.parts(batches, 20_000):
                by: dict[str, dict[str, int]] = {}
                for lang, word, n in zip(*(batch[c].to_pylist() for c in ("lang", "word", "n")), strict=True):
                    by.setdefault(lang, {})[word] = n
                out = {lang: expected_pieces(own, table, learned[lang] | {"": UNKNOWN}) if learned else seen_pieces(own, table) for lang, own in by.items()}
                rows = [(lang, p, float(x)) for lang, own in out.items() for p, x in own.items()]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.string(), pa.float64()))], names=["lang", "piece", "x"])

        found: dict[str, dict[str, float]] = {}
        # sums in a fixed order, so that a model doesn't depend on which task was first
        for r in known.mapInArrow(work, "lang string, piece string, x double").groupBy("lang", "piece").agg(F.expr("aggregate(array_sort(collect_list(x)), 0D, (a, x) -> a + x)").alias("x")).collect():
            found.setdefault(r.lang, {})[r.piece] = r.x
        return found

    seen = summed(None)
    learned = {lang: {p: c / sum(own.values()) for p, c in own.items()} for lang, own in seen.items()}
    for _ in range(rounds):
        expected = summed(learned)
        learned = {lang: _normal(expected.get(lang, {}), own) for lang, own in seen.items()}
    return Model(learned)


def classify(docs: DataFrame, model: Model, keep: list[str] | None = None, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """The rows of ``docs`` (its columns ``keep``, else all) with the prediction and its score,
    called ``names``."""
    keep = docs.columns if keep is None else keep
    given = docs.select(*keep, F.col("text").cast("string").alias("x_text"))

    def work(batches):
        own = common.held(model.name, lambda: model)  # its word cache stays for the worker's next task
        for batch in common.parts(batches):
            found = own.classify(batch["x_text"].to_pylist())
            columns = [batch[c] for c in keep] + [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, *names])
        common.give_back()

    kept = [StructField(f.name, f.dataType, True) for f in docs.select(*keep).schema]
    return given.mapInArrow(work, StructType([*kept, StructField(names[0], StringType()), StructField(names[1], DoubleType())]))


def keep_identified(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The documents that some language is found for, with a score of ``least`` or more. Where there is
    nothing to learn from, those with a letter."""
    model = fit(docs)
    if not model.langs:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    found = classify(docs, model, names=("k_lang_pred", "k_score"))
    return found.filter((F.col("k_lang_pred") != "und") & (F.col("k_score") >= least)).select(*docs.columns)


def op5_language_id(spark, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return classify(docs, fit(docs), ["doc_id"]).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")

import itertools
import math
import random
import zlib

from chronolake.llm import langid

PIECES = ["▁", "a", "b", "ab", "▁a", "ba", "aba"]


def every_way(word, prob):
    """Sum over all segmentations, written out."""
    total = 0.0
    for cuts in itertools.product((0, 1), repeat=len(word) - 1):
        parts, at = [], 0
        for i, c in enumerate([*cuts, 1], 1):
            if c:
                parts.append(word[at:i])
                at = i
        singles = {p for p in prob if len(p) == 1}
        total += math.prod(prob.get(p, langid.UNKNOWN if len(p) == 1 and p not in singles else 0.0) for p in parts)
    return total


def test_forward_sums_all_segmentations():
    rng = random.Random(1)
    learned = {x: {p: rng.random() / 5 for p in PIECES} for x in ("x", "y")}
    model = langid.Model(learned)
    for w in ("a", "ab", "abab", "babaab", "aqb", "é", "bbbbbb"):
        for lang, got in zip(model.langs, model.word(w.encode()), strict=True):
            assert math.isclose(got, math.log(every_way("▁" + w, learned[lang])), rel_tol=1e-9), w
    mixed = [w.encode() for w in ("a", "ab", "aqb", "é", "bbbbbb", "abababab", "a" * 39, "b" * 60, "ba")]
    for row, w in zip(model.many(mixed), mixed, strict=True):
        assert all(math.isclose(x, y, rel_tol=1e-9) for x, y in zip(row, model.word(w), strict=True)), w
    long = model.word(b"ab" * 4000)
    assert all(math.isfinite(x) and x < -1000 for x in long)


def test_training_raises_likelihood():
    counts = {"abab": 5, "ba": 3, "aab": 2}
    score = lambda prob: sum(n * math.log(every_way("▁" + w, prob)) for w, n in counts.items())
    by_rounds = [score(langid.train(counts, PIECES, rounds)) for rounds in (1, 2, 4)]
    assert by_rounds[0] <= by_rounds[1] + 0.05 and by_rounds[1] <= by_rounds[2] + 0.05


def expected_every_way(counts, prob):
    """Expected pieces from all segmentations, each weighted by its probability."""
    out = {}
    for word, n in counts.items():
        w = "▁" + word
        ways = []
        for cuts in itertools.product((0, 1), repeat=len(w) - 1):
            parts, at = [], 0
            for i, c in enumerate([*cuts, 1], 1):
                if c:
                    parts.append(w[at:i])
                    at = i
            ways.append((math.prod(prob.get(p, langid.UNKNOWN if len(p) == 1 else 0.0) for p in parts), parts))
        total = sum(x for x, _ in ways)
        for x, parts in ways:
            for p in parts:
                if p in prob:
                    out[p] = out.get(p, 0.0) + n * x / total
    return out


def test_expected_pieces():
    rng = random.Random(5)
    prob = {p: rng.random() / 5 for p in PIECES}
    table = langid._with_prefixes(dict.fromkeys(PIECES, 1.0))
    counts = {"abab": 2, "baqab": 1, "aaaa": 3, "qqq": 1}
    got, want = langid.expected_pieces(counts, table, prob | {"": langid.UNKNOWN}), expected_every_way(counts, prob)
    assert all(math.isclose(got[p], want.get(p, 0.0), rel_tol=1e-9, abs_tol=1e-12) for p in PIECES)
    # nothing is too long or too rare: known pieces around many unknown letters are counted in full
    long = langid.expected_pieces({"ab" + "ж" * 55 + "ba": 4}, table, prob | {"": langid.UNKNOWN})
    want = expected_every_way({"abжжba": 4}, prob)
    assert all(math.isclose(long[p], want.get(p, 0.0), rel_tol=1e-9, abs_tol=1e-12) for p in PIECES)


def test_fit_is_train_in_tasks(spark):
    docs = spark.createDataFrame(rows(60), "doc_id long, text string, lang string")
    model, counts = langid.fit(docs), {}
    for d, t, lang in rows(60):
        if d is not None and lang and t is not None and zlib.crc32(str(d).encode()) % 3 != 1:
            own = counts.setdefault(lang, {})
            for w in langid.words(t):
                own[w.decode()] = own.get(w.decode(), 0) + 1
    for i, lang in enumerate(model.langs):
        for p, x in langid.train(counts[lang], langid.vocabulary()).items():
            assert math.isclose(model.table[p][i], x, rel_tol=1e-9)
    assert langid.fit(docs).name == model.name != langid.Model({"x": {"a": 0.5}}).name


def rows(n=400):
    rng, out = random.Random(0), []
    parts = {"en": ["the", "ing", "and", "ation", "wh"], "fr": ["eau", "eux", "ment", "qué", "le"], "de": ["sch", "ung", "ein", "keit", "der"]}
    for i in range(n):
        lang = rng.choice(list(parts))
        out.append((i, " ".join("".join(rng.choice(parts[lang]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(2, 60))), lang))
    return out + [(1000, None, "en"), (1001, "", "fr"), (1002, "12 + 3 — !", "de"), (1003, "THE INGAND!! THEATION", None), (None, "sch ung der", "xx"), (1004, "a" * 20000, None)]


def test_query(spark, tmp_path):
    given = rows()
    spark.createDataFrame(given, "doc_id long, text string, lang string").selectExpr("*", "1 AS score", "2 AS lang_pred").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in langid.op5_language_id(spark, str(tmp_path)).collect()}
    assert len(got) == len(given)
    right = 0
    for d, t, lang in given:
        r = got[d]
        assert r.held_out == (d is not None and zlib.crc32(str(d).encode()) % 3 == 1) and 0 <= r.score <= 1
        if not any(c.isalpha() for c in t or ""):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in ("en", "fr", "de")
            right += r.lang_pred == lang
    assert right >= 395 and got[1003].lang_pred == "en" and got[None].lang_pred == "de"


def test_edges(spark):
    docs = spark.createDataFrame(rows(30), "doc_id long, text string, lang string").selectExpr("*", "1 AS score")
    kept = langid.keep_identified(docs)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert not ids & {1000, 1001, 1002} and {d for d, *_ in rows(30)} - ids <= {1000, 1001, 1002, 1004}
    unlabelled = docs.withColumn("lang", langid.F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.classify(unlabelled, langid.fit(unlabelled), ["doc_id"]).collect()} == {"und"}
    assert langid.keep_identified(docs.limit(0)).count() == 0

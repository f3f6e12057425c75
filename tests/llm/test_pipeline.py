import re
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from chronolake.llm import langid, packing, pii, simhash


def redacted(text):
    spans = sorted((int(s.split(":")[1]), -int(s.split(":")[2]), s.split(":")[0]) for s in found(text))
    out, at, kind = [], 0, None
    merged = []
    for start, end, kind in spans:
        if merged and merged[-1][1] > start:
            merged[-1][1] = max(merged[-1][1], -end)
        else:
            merged.append([start, -end, kind])
    for start, end, kind in merged:
        out.append(text[at:start] + f"<{kind.upper()}>")
        at = end
    return "".join(out) + text[at:]


def found(text):
    for kind, pattern in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+){3}"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"), ("card", r"[0-9]([\x20-]?[0-9])+")):
        for m in re.finditer(pattern, text):
            n = len(re.sub("[^0-9]", "", m[0]))
            digits = [int(c) for c in reversed(m[0]) if c.isdigit()]
            luhn = sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(digits)) % 10 == 0
            if kind == "email" or kind == "ip" and all(int(x) < 256 for x in m[0].split(".")) or kind == "phone" and 8 <= n <= 15 or kind == "card" and 16 <= n <= 19 and luhn:
                yield f"{kind}:{m.start()}:{m.end()}"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def test_stages_against_plain(spark):
    """The stages on the smallest tables, step by step against a plain version of each."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    model = langid.fit(docs)
    kept = {d: r.text for d, r in rows.items() if (lambda p: p[0] != "und" and p[1] >= 0.5)(model.classify([r.text])[0])}
    sets, root = {d: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if (w := lowered(t).split()) else set() for d, t in kept.items()}, {d: d for d in kept}
    ids = sorted(kept)
    changed = True
    while changed:
        changed = False
        for i in ids:
            for j in ids:
                if root[i] != root[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9:
                    root[i] = root[j] = min(root[i], root[j])
                    changed = True
    kept = {d: redacted(t) for d, t in kept.items() if root[d] == d}
    stage = docs
    for _, f in corpus_pipeline.STAGES[:3]:
        stage = f(spark, stage, sf)
        assert stage.columns == docs.columns
    assert {r.doc_id: (r.text, r.n_chars, r.source) for r in stage.collect()} == {d: (t, len(t), rows[d].source) for d, t in kept.items()}
    sequences, pieces = defaultdict(list), defaultdict(int)
    for r in corpus_pipeline.run(spark, sf).collect():
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id] += r.length
    assert dict(pieces) == {d: len(np.frombuffer(packing.encoder()(t), "<u4")) + 1 for d, t in kept.items()}
    for own in sequences.values():
        assert [o for o, _ in sorted(own)] == [sum(n for p, n in own if p < o) for o, _ in sorted(own)] and sum(n for _, n in own) <= 2048
    assert len(sequences) <= -(-sum(pieces.values()) // 2048) + 1


def test_odd_rows(spark, tmp_path):
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, "same words here for all", "en", None, 1), (3, "same words here for all", "en", None, 1), (None, "other words of a text with a@b.cd", None, "b", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("extra", F.lit(1))
    docs.write.parquet(f"{tmp_path}/a/documents.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/b/documents.parquet")
    got = corpus_pipeline.run(spark, f"{tmp_path}/a").collect()
    assert sorted((r.doc_id for r in got), key=str) == [3, None]
    assert corpus_pipeline.run(spark, f"{tmp_path}/b").count() == 0
    assert pii.redact(docs).columns == docs.columns


def test_mix_reaches_sequences(spark):
    """The rarer of two sources has its weight's share of the early sequences and none of the last ones;
    fails without the mixing stage."""
    docs = spark.range(22000).selectExpr("id AS doc_id", "rtrim(repeat('word ', 200 + int(pmod(hash(id), 150)))) AS text", "'en' AS lang", "if(id % 11 = 0, 'b', 'a') AS source", "1L AS n_chars")
    for _, f in corpus_pipeline.STAGES[[n for n, _ in corpus_pipeline.STAGES].index("PII") + 1 :]:
        docs = f(spark, docs, "")
    got = docs.selectExpr("sequence_id", "if(doc_id % 11 = 0, length, 0) AS b", "length").groupBy("sequence_id").sum("b", "length").orderBy("sequence_id").collect()
    share = lambda rows: sum(r[1] for r in rows) / sum(r[2] for r in rows)
    n, weight = len(got), 1 / (1 + 10**0.7)
    assert [r.sequence_id for r in got] == list(range(n)) and all(r[2] <= 2048 for r in got)
    assert abs(share(got[: n // 3]) - weight) < 0.01 and share(got[-n // 10 :]) == 0
    assert n <= -(-sum(r[2] for r in got) // 2048) * 1.02


def test_near_dedup_is_exact(spark):
    """On the smallest table, what stays is one document of each component of all pairs at 0.8."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    sets, root = {d: set(simhash._shingles(t, 5).tolist()) for d, t in texts.items()}, {d: d for d in texts}
    changed = True
    while changed:
        changed = False
        for i in texts:
            for j in texts:
                if root[i] != root[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9:
                    root[i] = root[j] = min(root[i], root[j])
                    changed = True
    kept = {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, sf).collect()}
    assert kept == {d for d in texts if root[d] == d} and {185, 192} <= kept

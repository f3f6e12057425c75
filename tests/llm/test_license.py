import random
import re

from chronolake.llm import license as lic


def plain_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


SETS = [(label, plain_words(text)) for label, text in lic.TEMPLATES]


def enough(held, n):
    return held == n if n < 12 else held >= 0.8 * n - 1e-12


def every_match(w):
    """Every block against every template: (template, first word, size, containment, has it evidence of
    its own)."""
    found, taken = [], []
    for t, (_, notice) in enumerate(SETS):
        size, own = 8, set(notice)
        while size < 2 * len(notice):
            size *= 2
        starts = [0]
        while starts[-1] + size < len(w):
            starts.append(starts[-1] + size // 2)
        for s in starts:
            block = w[s : s + size]
            share = len(own & set(block)) / len(own)
            if enough(len(own & set(block)), len(own)):
                n = int(1.25 * len(notice))
                windows = [(len(own & set(block[a : a + n])), -a) for a in range(max(1, len(block) - n + 1))]
                at = s - max(windows)[1]
                found.append((t, s, size, share))
                taken.append((t, (share, len(own)), set(range(at, min(at + n, s + len(block))))))
    out = []
    for t, s, size, share in found:
        own = set(SETS[t][1])
        variants = [b for b, (_, x) in enumerate(SETS) if b != t and enough(len(own & set(x)), len(own))]
        gone = set().union(*(at for b, rank, at in taken if b in variants and rank > (share, len(own))))
        rest = {x for i, x in enumerate(w[s : s + size], s) if i not in gone}
        out.append((t, s, size, share, enough(len(own & rest), len(own))))
    return out


def plain(text):
    w = plain_words(text)
    places = []
    for phrase, label in lic.PHRASES.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(w)) if w[i : i + len(p)] == p]
    found = every_match(w)
    kept = [(SETS[t][0], share) for t, _, _, share, alone in found if alone]
    own = {x for _, x in places}
    at = [i for i, _ in places]
    return (len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(own)), ",".join(sorted(own | {x for x, _ in kept})), 1.0 if at else max((c for _, c in kept), default=0.0)), found


def corpus():
    rng, filler = random.Random(9), ["the", "and", "wörd", "under", "of", "license", "public", "4", "x", "general", "mit", "apache", "version"]
    out = [None, "", "MIT License", "mit-license, MIT\nLICENSE; general public\tlicense", "Licensed under CC BY-NC 4.0.", "Licensed under CC BY 4.0", "the apache  License 2", "¿mité license"]
    for _ in range(250):
        w = [rng.choice(filler) for _ in range(rng.randint(0, 200))]
        for _ in range(rng.randint(0, 2)):
            notice = rng.choice(lic.TEMPLATES)[1].split()
            for _ in range(rng.randint(0, 4)):
                notice[rng.randrange(len(notice))] = rng.choice(["oops", "the"])
            k = rng.randint(0, len(w))
            w[k:k] = notice
        out.append(rng.choice([" ", "\n", ", "]).join(w))
    gpl, lgpl, agpl = (next(t for x, t in lic.TEMPLATES if x == y and "gnu" in t) for y in ("gpl", "lgpl", "agpl"))
    out += [f"{gpl}. {agpl}", f"{lgpl} {gpl}", "Licensed under CC BY 4.0 (text); licensed under CC BY-SA 4.0 (images)"]
    out += [f"{'x ' * k}{t}{' y' * k}" for _, t in lic.TEMPLATES[-7:] for k in (0, 50, 301)]
    return out + [" ".join(lic.TEMPLATES[3][1].split() * 300)]


def test_against_every_pair(spark, tmp_path):
    texts = corpus()
    rows = [*enumerate(texts), (None, "MIT license"), (2, "MIT License")]
    spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS score", "2 AS labels").write.parquet(f"{tmp_path}/documents.parquet")
    got = lic.op1_license_scan(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    for r in got:
        want, found = plain("MIT License" if r.doc_id is None else texts[r.doc_id])
        assert tuple(r)[1:7] == want[:6], (r, want)
        assert abs(r.score - want[6]) < 1e-12 and r.n_matches == len(found)
        assert sorted((m.label, m.first_word) for m in r.matches) == sorted((SETS[t][0], s) for t, s, *_ in found)
    assert {r.doc_id: r.labels for r in got}[4] == "cc-by-nc"


def test_all_matches(spark):
    """Every pair that meets the threshold is there, families and long templates included."""
    texts = corpus()
    for r in lic.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect():
        want = {(t, s, size, round(c, 9), own) for t, s, size, c, own in every_match(plain_words(texts[r.doc_id]))}
        assert {(m.template, m.first_word, m.words, round(m.containment, 9), m.own) for m in r.matches} == want


def test_labels():
    index = lic.Index(lic.TEMPLATES, {})
    of = lambda text: {index.labels[m.template] for m in index.document(lic.words(text)) if m.own}
    assert of("Licensed under CC BY-NC 4.0.") == {"cc-by-nc"}
    assert of("Licensed under CC BY 4.0 (text); licensed under CC BY-SA 4.0 (images)") == {"cc-by", "cc-by-sa"}
    notice = {x: t for x, t in reversed(lic.TEMPLATES[:20])}
    assert of(notice["agpl"] + " and so on. " + "this work is licensed under the gnu general public license version 3") >= {"agpl", "gpl"}
    for clean in ("licensed under clause 4 0 by the board of the county", "version 4.0 is licensed to you under terms set by the vendor", "proprietary; distributed under the terms of the house software license version 1 0 only"):
        assert of(clean) == set() == of("some words before it " * 9 + clean + " and some after it" * 9)
    long = next(t for x, t in lic.TEMPLATES[20:] if x == "mit")
    assert of("word " * 77 + long + " word" * 500) == {"mit"}
    with_copy = lic.Index((*lic.TEMPLATES, ("own", " ".join(f"t{i}" for i in range(1200)))), {})
    assert [m.containment for m in with_copy.document([f"t{i}".encode() for i in range(1200)])] == [1.0]


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert lic.scan(docs).count() == 0

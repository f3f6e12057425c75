import hashlib
import random
import re

from chronolake.llm import pii


def luhn(d):
    return sum(int(c) if i % 2 == 0 else (2 * int(c) - 9 * (int(c) > 4)) for i, c in enumerate(reversed(d))) % 10 == 0


def plain(text):
    """Base spans by the stated patterns, and ibans."""
    text, out = text or "", []
    digits = lambda m: re.sub("[^0-9]", "", m)
    rules = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15),
    ]
    for kind, pattern, good in rules:
        out += [f"{kind}:{m.start()}:{m.end()}" for m in re.finditer(pattern, text) if good(m[0])]
    return out


def mod97(word):
    plain = word.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def scored(text):
    """All spans with their scores, by the stated rules, one kind after another."""
    text, out = text or "", []
    for span in plain(text):
        kind, a, b = span.split(":")
        out.append((kind, int(a), int(b)))
    lengths = {c[:2]: int(c[2:]) for c in pii.IBAN.split()}
    at = 0
    while at < len(text):
        m = re.compile(r"(?<![A-Za-z0-9])([A-Z]{2})[0-9]{2}").search(text, at)
        if not m:
            break
        at = m.start() + 1
        if m[1] in lengths:
            w = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){%d}(?![A-Za-z0-9])" % (lengths[m[1]] - 4)).match(text, m.start())
            if w:
                at = w.end()
                if mod97(w[0]):
                    out.append(("iban", w.start(), w.end()))
    for m in re.finditer(r"(?<![0-9+])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,14}(?![ -]?[0-9])", text):
        if luhn(re.sub("[^0-9]", "", m[0])):
            out.append(("amex", m.start(), m.end()))
    for m in re.finditer(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])", text):
        if not (m[1] in ("000", "666") or m[1][0] == "9" or m[2] == "00" or m[3] == "0000"):
            out.append(("ssn", m.start(), m.end()))
    base, kept = {"email": 0.7, "ip": 0.5, "card": 0.8, "phone": 0.5, "iban": 0.8, "amex": 0.6, "ssn": 0.6}, []
    for kind in pii.KINDS:
        own = [(a, b) for k, a, b in out if k == kind]
        # context reaches to the next match of the kind's pattern, checked or not
        every = [m.span() for m in re.finditer(pii.PATTERN[kind].replace(r"|\G", ""), text)] if kind != "email" else own
        for a, b in own:
            before = max((e for _, e in every if e <= a), default=0)
            after = min((s for s, _ in every if s >= b), default=len(text))
            near = (text[max(before, a - 48) : a] + " " + text[b : min(after, b + 48)]).lower()
            score = base[kind] + 0.2 * bool(re.search(rf"\b(?:{pii.WORDS[kind]})", near, re.ASCII)) - 0.2 * bool(re.search(rf"\b(?:{pii.AGAINST})", near, re.ASCII))
            if kind in pii.BASE or score >= 0.75 - 1e-12:
                kept.append((kind, a, b, min(1.0, score)))
    return kept


CONTEXTS = ["", "iban ", "order ", "my bank account: ", "isbn ", "amex card ", "social security ", "ssn ", "tel. ", "e-mail ", "server ", "zzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzz "]
NUMBERS = ["DE89370400440532013000", "DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32", "NO9386011117947", "DE89370400440532013001", "378282246310005", "3782 822463 10005", "378282246310006", "30569309025904", "123-45-6789", "000-12-3456", "4111 1111 1111 1111", "+49 89 1234567", "a@b.de", "10.0.0.1"]


def contexts(n=300):
    rng = random.Random(6)
    return ["".join(rng.choice(CONTEXTS) + rng.choice(NUMBERS) + rng.choice([" ", " BIC COBADEFF ", ", ", " EUR 12 ", " x" * 40 + " ", "é "]) for _ in range(rng.randint(1, 4))) for _ in range(n)]


CASES = [
    None, "", "é", "write to a.b@c.de, now", "é😀 x@y.zz 1.2.3.4 256.1.1.1 1.2.3.4.5 00012.0.0.255",
    "a@b.co_x@y.zz a@b.c@d.e @a.b foo@bar", "4111 1111 1111 1111 and 4111-1111-1111-1112", "12 3456", "card 4111111111111111111",
    "+1 (274) 555-9629 +12 +1 2 +999999999999999999", "1" * 300, "x" * 5000 + "@y.z", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7",
    "DE89 3704 0044 0532 0130 00 iban DE89370400440532013000 DE89370400440532013001", "٣.٣.٣.٣ ", "a@b.c " * 1300, "+4111111111111111 1.1.1.1@x.y",
]


def fuzz(n=400):
    rng = random.Random(3)
    return ["".join(rng.choice(["a", "1", "23", "4111111111111111", "+", "@", ".", "-", " ", "(", "x.y", "é", "255", "_", "%"]) for _ in range(rng.randint(1, 60))) for _ in range(n)]


def test_against_plain_search(spark):
    texts = CASES + fuzz()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "'q' AS p_z", "null AS score")
    docs.createOrReplaceTempView("t_docs")
    rows = pii.find(docs).select("doc_id", pii._joined(pii.BASE).alias("base"), pii._joined(("iban",)).alias("iban")).collect()
    found = {r.doc_id: r for r in rows}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        assert found[i].base == ",".join(plain(t)), t
    assert found[13].iban == "iban:0:27,iban:33:55"


def test_scores(spark):
    """Every span and its score; context decides about the added kinds."""
    texts = contexts() + ["DE89 3704 0044 0532 0130 00 BIC COBADEFF", "GB82 WEST 1234 5698 7654 32 EUR 12", "378282246310005", "amex 378282246310005", "ssn 123-45-6789", "123-45-6789", "isbn order DE89370400440532013000"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kinds = set()
    for r in pii.find(docs).collect():
        got = [(s.kind, s.start, s.end, round(s.score, 9)) for k in pii.KINDS for s in r[f"p_{k}"]]
        assert got == [(k, a, b, round(x, 9)) for k, a, b, x in scored(texts[r.doc_id])], texts[r.doc_id]
        kinds |= {k for k, *_ in got}
    assert kinds == set(pii.KINDS)
    last = {r.doc_id - len(texts): [s.kind for k in pii.KINDS for s in r[f"p_{k}"]] for r in pii.find(docs).collect()}
    assert [last[i] for i in range(-7, 0)] == [["iban"], ["iban"], [], ["amex"], ["ssn"], [], []]


def test_query(spark, tmp_path):
    spark.createDataFrame([(i, t) for i, t in enumerate(CASES)] + [(None, "a@b.cd"), (1, "")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = pii.op2_pii(spark, str(tmp_path)).collect()
    for r in rows:
        if r.doc_id not in (None, 1):
            base = plain(CASES[r.doc_id])
            assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
            assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(b.startswith(k + ":") for b in base) for k in pii.BASE]
            assert len(r.scores) == len(r.spans.split(",")) * bool(r.spans)


def test_redact(spark):
    rows = [(1, "é a@b.cd and 1.1.1.1.", 9), (2, None, None), (3, "", 0), (4, "none", 4), (5, "1.1.1.1@x.y", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    out = {r.doc_id: (r.text, r.n_chars) for r in pii.redact(docs).collect()}
    assert out == {1: ("é <EMAIL> and <IP>.", 19), 2: (None, None), 3: ("", 0), 4: ("none", 4), 5: ("<EMAIL>", 7)}
    assert pii.redact(docs.limit(0)).count() == 0


def test_redact_against_plain(spark):
    """Many spans, overlapping ones too, across chunks, in texts of many sizes."""
    rng = random.Random(12)
    texts = ["".join(rng.choice(["a@b.cd ", "1.2.3.4@x.yz ", "é 10.0.0.1, ", "+4111111111111111 ", "text é😀 "]) for _ in range(n)) for n in (1, 5, 511, 512, 513, 1024, 1025, 3000)]
    texts.append("mail a@b.cd, " * 16_000)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.redact(docs).collect():
        t, merged = texts[r.doc_id], []
        for start, end, kind in sorted(((a, b, k) for k, a, b, _ in scored(t)), key=lambda s: (s[0], -s[1], s[2])) if len(t) < 100_000 else [(13 * i + 5, 13 * i + 11, "email") for i in range(16_000)]:
            if merged and merged[-1][1] > start:
                merged[-1][1] = max(merged[-1][1], end)
            else:
                merged.append([start, end, kind])
        out, at = [], 0
        for start, end, kind in merged:
            out.append(t[at:start] + f"<{kind.upper()}>")
            at = end
        assert r.text == "".join(out) + t[at:]

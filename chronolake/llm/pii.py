"""Personal data: regular expressions propose spans, checksums confirm them, context scores them.

Kinds, in order: email, ip, card, phone (the base kinds), then those that the method adds: iban (with the
length that its country declares, and mod-97), amex (13 to 15 digits that pass Luhn) and ssn (three, two
and four digits). Base matches count if they pass their check: parts of at most 255 (ip), 16 to 19 digits
and Luhn (card), 8 to 15 digits (phone). Matches are leftmost and don't overlap within a kind; one that
fails its check is dropped and not retried. Positions are code points, from 0, end exclusive.

The score of a span starts from what its kind's check proves, rises where a word that goes with the kind
stands within ``CONTEXT`` characters before or after it, and falls where a word stands there that goes
with other numbers. An added kind needs ``LEAST_SCORE``: an iban has it unless its context speaks against
it, an amex or ssn only has it where its context speaks for it. Base spans stay whatever their score.

Everything is built from SQL functions. The patterns are linear in the text: they use possessive
repeats and look-behinds, which change nothing about what is found. Texts without "@" skip the
search for email, texts without a digit the others. Spans are folded and texts cut ``CHUNK`` spans at a
time, so that very long texts with very many spans don't cost their square.

Nulls: a null or empty text has no spans (and stays null or empty when redacted). Other columns may
be null, repeated or of any name; rows stay as they are, one result row for each. An empty table gives an
empty result.
"""

from __future__ import annotations

from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronolake.llm import common

CONTEXT, LEAST_SCORE, CHUNK = 48, 0.75, 512
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "amex", "ssn")

# The length of an iban in each country.
IBAN = (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29 ES24 FI18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 "
    "IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MR27 MT31 MU30 NL18 NO15 PK24 PL28 PS29 PT25 QA29 RO24 RS22 SA24 "
    "SC31 SE24 SI19 SK24 SM27 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20"
)


def _ibans() -> str:
    by_length = groupby(sorted(IBAN.split(), key=lambda c: (c[2:], c)), key=lambda c: int(c[2:]))
    each = "|".join(f"(?:{'|'.join(c[:2] for c in own)})[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}" for n, own in by_length)
    return f"(?<![A-Za-z0-9])(?:{each})(?![A-Za-z0-9])"


# A pattern, the score of a checked match and the words that go with each kind.
PATTERN = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "iban": _ibans(),
    "amex": r"(?<![0-9+])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,14}(?![ -]?[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
CHECKED_SCORE = {"email": 0.7, "ip": 0.5, "card": 0.8, "phone": 0.5, "iban": 0.8, "amex": 0.6, "ssn": 0.6}
WORDS = {
    "email": "e-?mail|contact|write|courriel|correo|kontakt",
    "ip": "ip|address|host|server|adresse|servidor",
    "card": "card|visa|credit|carte|tarjeta|karte",
    "phone": "tel|phone|call|fax|mobile|telefon|llamar",
    "iban": "iban|bank|account|konto|compte|cuenta",
    "amex": "amex|american express|diners|card|credit|carte|tarjeta|karte",
    "ssn": "ssn|social security",
}
AGAINST = "isbn|order|invoice|serial|tracking|version|example"

_SPAN = "struct<start:bigint,end:bigint,word:string,near:string>"


def _luhn(digits: str) -> str:
    digit = f"int(substr({digits}, i, 1))"
    twice = f"(length({digits}) - i) % 2 = 1"
    return f"(aggregate(sequence(1, length({digits})), 0, (a, i) -> a + if({twice}, 2 * {digit} - if({digit} > 4, 9, 0), {digit})) % 10 = 0)"


def _mod97(plain: str) -> str:
    turned = f"concat(substr({plain}, 5), substr({plain}, 1, 4))"
    code = "ascii(c)"
    return f"(aggregate(split({turned}, ''), 0, (a, c) -> if({code} > 57, (a * 100 + {code} - 55) % 97, (a * 10 + {code} - 48) % 97)) = 1)"


_DIGITS = "regexp_replace(s.word, '[^0-9]', '')"
CHECK = {
    "email": "true",
    "ip": "s.word rlike '^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:[.]|$)){4}$'",
    "card": _luhn(_DIGITS),
    "phone": f"length({_DIGITS}) between 8 and 15",
    "iban": _mod97("replace(s.word, ' ', '')"),
    "amex": _luhn(_DIGITS),
    "ssn": "not s.word rlike '^(?:000|666|9)|-00-|-0000$'",
}


def _all_spans(df: DataFrame, kind: str, text: str) -> DataFrame:
    """Adds p_<kind>: the checked and scored spans of one kind in the column ``text``."""
    pattern, m, s, z, b, p = PATTERN[kind], f"p_m_{kind}", f"p_s_{kind}", f"p_z_{kind}", f"p_b_{kind}", f"p_{kind}"
    df = df.withColumn(m, F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0)))
    df = df.withColumn(s, F.when(F.size(m) > 0, F.split(F.col(text), pattern, -1)).otherwise(F.array().cast("array<string>")))
    df = df.withColumn(
        z,
        F.arrays_zip(
            F.expr(f"transform(slice({s}, 1, size({m})), x -> bigint(length(x)))").alias("gap"),
            F.col(m).alias("word"),
            F.expr(f"zip_with(slice({s}, 1, size({m})), slice({s}, 2, size({m})), (x, y) -> concat(right(x, {CONTEXT}), ' ', left(y, {CONTEXT})))").alias("near"),
        ),
    )
    chunks = f"sequence(0, (size({z}) - 1) div {CHUNK})"
    part = f"slice({z}, c * {CHUNK} + 1, {CHUNK})"
    total = f"aggregate({part}, 0L, (a, x) -> a + x.gap + length(x.word))"
    # where each chunk of matches begins, so that no step carries more than one chunk
    df = df.withColumn(b, F.expr(f"if(size({z}) = 0, array(0L), aggregate({chunks}, array(0L), (a, c) -> concat(a, array(element_at(a, -1) + {total}))))"))
    one = "struct(a.pos + x.gap as start, a.pos + x.gap + length(x.word) as end, x.word as word, x.near as near)"
    inner = (
        f"aggregate({part}, struct({b}[c] as pos, cast(array() as array<{_SPAN}>) as out), "
        f"(a, x) -> struct(a.pos + x.gap + length(x.word) as pos, concat(a.out, array({one})) as out), a -> a.out)"
    )
    score = f"least(1.0D, {CHECKED_SCORE[kind]}D + if(lower(s.near) rlike '\\\\b(?:{WORDS[kind]})', 0.2D, 0.0D) - if(lower(s.near) rlike '\\\\b(?:{AGAINST})', 0.2D, 0.0D))"
    least = "0.0D" if kind in BASE else f"{LEAST_SCORE}D"
    found = f"if(size({z}) = 0 or size({b}) = 0, cast(array() as array<{_SPAN}>), flatten(transform({chunks}, c -> {inner})))"
    scored = f"transform(filter({found}, s -> {CHECK[kind]}), s -> struct('{kind}' as kind, s.start as start, s.end as end, {score} as score))"
    return df.withColumn(p, F.expr(f"filter({scored}, s -> s.score >= {least})"))


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with p_<kind>: array of (kind, start, end, score), for each kind."""
    plain = F.coalesce(F.col(text), F.lit(""))
    df = docs.withColumn("p_mail", F.when(F.contains(plain, F.lit("@")), plain).otherwise(""))
    df = df.withColumn("p_digit", F.when(plain.rlike("[0-9]"), plain).otherwise(""))
    for kind in KINDS:
        df = _all_spans(df, kind, "p_mail" if kind == "email" else "p_digit")
    return df.select(*docs.columns, *(f"p_{k}" for k in KINDS))


def _joined(kinds: tuple[str, ...]) -> Column:
    said = F.flatten(F.array(*(F.expr(f"transform(p_{k}, s -> concat(s.kind, ':', s.start, ':', s.end))") for k in kinds)))
    return F.array_join(said, ",")


_CUT = "struct<start:bigint,end:bigint,kind:string>"


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with every span replaced by its kind in angle brackets. Spans of several
    kinds that overlap become one, named after the first. A column n_chars is counted anew."""
    df = find(docs, text).withColumn("p_all", F.array_sort(F.flatten(F.array(*(F.expr(f"transform(p_{k}, s -> struct(s.start as start, -s.end as neg, s.kind as kind))") for k in KINDS)))))
    none = f"cast(array() as array<{_CUT}>)"
    span = "named_struct('start', s.start, 'end', -s.neg, 'kind', s.kind)"
    longer = "named_struct('start', a.cur.start, 'end', greatest(a.cur.end, -s.neg), 'kind', a.cur.kind)"
    # chunk by chunk: the spans that are done, and the one that the next may still overlap
    step = f"if(a.cur is not null and a.cur.end > s.start, struct(a.out as out, {longer} as cur), struct(if(a.cur is null, a.out, concat(a.out, array(a.cur))) as out, {span} as cur))"
    inner = f"aggregate(slice(p_all, c * {CHUNK} + 1, {CHUNK}), struct({none} as out, b.cur as cur), (a, s) -> {step})"
    outer = (
        f"aggregate(sequence(0, (size(p_all) - 1) div {CHUNK}), struct(cast(array() as array<array<{_CUT}>>) as done, cast(null as {_CUT}) as cur), "
        f"(b, c) -> element_at(transform(array({inner}), r -> struct(concat(b.done, array(r.out)) as done, r.cur as cur)), 1), b -> concat(flatten(b.done), array(b.cur)))"
    )
    df = df.withColumn("p_cut", F.expr(f"if(coalesce(size(p_all), 0) <= 0, {none}, {outer})"))
    # each chunk of spans with the text from the chunk before it to its last span
    t = f"`{text}`"
    ends = f"int(if(c = 0, 0L, p_cut[c * {CHUNK} - 1].end))"
    last = f"int(p_cut[least((c + 1) * {CHUNK}, size(p_cut)) - 1].end)"
    df = df.withColumn("p_parts", F.expr(f"if(size(p_cut) = 0, cast(array() as array<struct<at:int,own:string,cut:array<{_CUT}>>>), transform(sequence(0, (size(p_cut) - 1) div {CHUNK}), c -> struct({ends} as at, substr({t}, {ends} + 1, {last} - {ends}) as own, slice(p_cut, c * {CHUNK} + 1, {CHUNK}) as cut)))"))
    begin = "int(if(i = 0, bigint(p.at), p.cut[i - 1].end))"
    pieces = f"transform(p.cut, (s, i) -> concat(substr(p.own, {begin} - p.at + 1, int(s.start) - {begin}), '<', upper(s.kind), '>'))"
    new = F.expr(f"if(size(p_cut) = 0, {t}, concat(array_join(transform(p_parts, p -> array_join({pieces}, '')), ''), substr({t}, int(element_at(p_cut, -1).end) + 1)))")
    out = df.withColumn(text, new).select(*docs.columns)
    return out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length(text)).cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def op2_pii(spark, sf_dir: str) -> DataFrame:
    df = find(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return df.select(
        "doc_id",
        *(F.size(f"p_{k}").cast("long").alias(f"n_{k}") for k in BASE),
        F.sha2(_joined(BASE), 256).alias("base_sha256"),
        _joined(KINDS).alias("spans"),
        F.flatten(F.array(*(F.expr(f"transform(p_{k}, s -> s.score)") for k in KINDS))).alias("scores"),
    )

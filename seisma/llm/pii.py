"""Personal data: patterns propose, checksums confirm, context adjusts the score.

Everything is a Spark column expression.  A text that holds no trace of a kind
(no ``@``, no digit, no ``+``) skips that kind's pattern.  Positions come from
splitting the text at the matches: piece and match lengths add up to code point
offsets.  The patterns are the plain ones with possessive repetition and a guard
against starting inside a run that has just failed; both leave the leftmost
matches as they are and keep the work linear in very long runs.

Kinds: ``email``, ``ip`` (parts at most 255), ``card`` (13 to 19 digits, Luhn),
``phone`` (9 to 15 digits after a plus sign), and ``iban`` (mod-97), which is
reported beside the others.  A match that fails its check is dropped without
another try.  An account number is tried at each head (two capitals, two digits),
in its country's length or, for other codes, in 34 to 15 characters, the longest
that passes; of spans that overlap the first stays.  A span's score starts at its kind's prior and moves with words
found within ``CONTEXT`` code points around it; scores rank spans, they drop none.

Defined results: a null text is the empty text, without spans; repeated rows
give repeated results; only the id and the text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

KINDS = ("email", "ip", "card", "phone")
ALL_KINDS = (*KINDS, "iban")
CONTEXT = 40
#: Matches are worked on in blocks, so that no step copies or walks over all of a text's matches for each of them.
BLOCK = 128
_AHEAD = 65  # an account number's 34 characters, 30 blanks and what follows

_LOCAL = "[A-Za-z0-9._%+-]"
_PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=(?:\x20?[A-Z0-9]){11})",  # the head only, see _accounts
}
#: Countries by the length of their account numbers.
_COUNTRIES = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_TRACE = {
    "email": r"@[A-Za-z0-9-]", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){12}",
    "phone": r"\+[0-9]", "iban": r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]",
}
_PRIOR = {"email": 0.8, "ip": 0.5, "card": 0.7, "phone": 0.6, "iban": 0.8}
_FOR = {
    "email": r"(?i)\b(mail|e-mail|email|contact|kontakt|courriel|correo)\b",
    "ip": r"(?i)\b(ip|host|server|address|login|adresse)\b",
    "card": r"(?i)\b(card|visa|credit|karte|carte|tarjeta|payment)\b",
    "phone": r"(?i)\b(phone|tel|call|mobile|telefon|fax)\b",
    "iban": r"(?i)\b(iban|bank|account|konto|compte|cuenta)\b",
}
_AGAINST = {
    "email": r"(?i)\b(example|noreply)\b", "ip": r"(?i)\b(version|v|release|section)\b",
    "card": r"(?i)\b(order|serial|isbn|tracking)\b", "phone": r"(?i)\b(sum|total|score)\b", "iban": r"(?i)\b(serial|part)\b",
}


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, r"[^0-9]", "")


def _mod97(match: Column) -> Column:
    """The remainder of an account number with its head moved to the end and letters as 10 to 35."""
    flat = F.regexp_replace(match, r"\x20", "")
    turned = F.concat(F.substring(flat, 5, 100), F.substring(flat, 1, 4))

    def step(acc: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code >= 65, (acc * 100 + code - 55) % 97).otherwise((acc * 10 + code - 48) % 97).cast("int")

    return F.aggregate(F.split(turned, ""), F.lit(0), lambda acc, c: F.when(c == "", acc).otherwise(step(acc, c)))


_SPAN = "struct<start:int,end:int,match:string>"


def _blocks(pieces: Column) -> Column:
    """The pieces in blocks; ``pieces`` is a column, as it is read for every block."""
    last = F.floor((F.size(pieces) - 1) / BLOCK).cast("int")
    return F.when(F.size(pieces) > 0, F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(pieces, b * BLOCK + 1, BLOCK)))


def _carried(blocks: Column, step) -> Column:
    """array<array<span>>: ``step`` gives a piece's spans from where the text before it ends, and the new end; a block starts where the last one ended."""
    none = F.array().cast(f"array<{_SPAN}>")

    def inner(at: Column, block: Column) -> Column:
        def add(acc: Column, x: Column) -> Column:
            spans, end = step(acc["at"], x)
            return F.struct(end.alias("at"), F.concat(acc["out"], spans).alias("out"))

        return F.aggregate(block, F.struct(F.coalesce(at, F.lit(0)).alias("at"), none.alias("out")), add)

    whole = F.aggregate(blocks, F.array().cast(f"array<struct<at:int,out:array<{_SPAN}>>>"),
                        lambda done, block: F.concat(done, F.array(inner(F.try_element_at(done, F.lit(-1))["at"], block))))
    return F.coalesce(F.transform(whole, lambda b: b["out"]), F.array().cast(f"array<array<{_SPAN}>>"))


def _placed(at: Column, x: Column) -> tuple[Column, Column]:
    start, end = at + x["gap"], at + x["gap"] + F.length(x["match"])
    return F.array(F.struct(start.alias("start"), end.alias("end"), x["match"].alias("match"))), end


def _not_overlapping(at: Column, x: Column) -> tuple[Column, Column]:
    free = at <= x["start"]
    return F.when(free, F.array(x)).otherwise(F.array().cast(f"array<{_SPAN}>")), F.when(free, x["end"]).otherwise(at)


def _near(text: Column, blocks: Column) -> Column:
    """For each block the text from before its first span to behind its last, and where that begins."""

    def cut(block: Column) -> Column:
        start = F.greatest(F.try_element_at(block, F.lit(1))["start"] - CONTEXT, F.lit(0))
        return F.struct(start.alias("start"), F.substring(text, start + 1, F.try_element_at(block, F.lit(-1))["end"] + _AHEAD - start).alias("text"))

    return F.transform(blocks, cut)


def _accounts(heads: Column, near: Column) -> Column:
    """array<array<span>> of the account numbers that begin at the heads and pass mod-97."""

    def whole(codes: str, n: int) -> str:
        return rf"(?:{codes})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}(?![A-Za-z0-9])"

    codes = {n: x.replace(" ", "|") for n, x in _COUNTRIES.items()}
    known = "^(?:" + "|".join(whole(x, n) for n, x in codes.items()) + ")"

    def place(head: Column, around: Column) -> Column:
        here = F.substring(around["text"], head["start"] - around["start"] + 1, F.lit(_AHEAD))
        tries = F.when(here.rlike(f"^(?:{'|'.join(codes.values())})"), F.array(F.regexp_extract(here, known, 0))).otherwise(
            F.array(*(F.regexp_extract(here, "^" + whole("[A-Z]{2}", n), 0) for n in range(34, 14, -1))))
        match = F.try_element_at(F.filter(tries, lambda m: (m != "") & (_mod97(m) == 1)), F.lit(1))
        return F.struct(head["start"].alias("start"), match.alias("match"))

    found = F.zip_with(heads, near, lambda block, around: F.filter(F.transform(block, lambda h: place(h, around)), lambda p: p["match"].isNotNull()))
    ended = F.transform(found, lambda block: F.transform(block, lambda p: F.struct(
        p["start"].alias("start"), (p["start"] + F.length(p["match"])).alias("end"), p["match"].alias("match"))))
    return _carried(ended, _not_overlapping)


def _valid(kind: str, match: Column) -> Column:
    n = F.length(_digits(match))
    if kind == "ip":
        part = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
        return match.rlike(rf"^{part}\.{part}\.{part}\.{part}$")
    if kind == "card":
        return n.between(13, 19) & F.call_function("luhn_check", _digits(match))
    if kind == "phone":
        return n.between(9, 15)
    if kind == "iban":
        return _mod97(match) == 1
    return F.lit(True)


def _pieces(text: Column, kind: str, matches: Column) -> Column:
    """array<struct<gap, match>>: each match with the length of what lies between it and the one before."""
    gaps = F.slice(F.transform(F.split(text, _PATTERNS[kind], -1), F.length), F.lit(1), F.size(matches))
    return F.when(F.size(matches) > 0, F.zip_with(gaps, matches, lambda g, m: F.struct(g.alias("gap"), m.alias("match")))).otherwise(
        F.array().cast("array<struct<gap:int,match:string>>"))


def _spans(kind: str, places: Column, near: Column) -> Column:
    """array<struct<kind, start, end, score>> of the kind's confirmed matches, in order."""

    def span(place: Column, around: Column) -> Column:
        first = F.greatest(place["start"] - CONTEXT, F.lit(0))
        beside = F.substring(around["text"], first - around["start"] + 1, place["end"] - place["start"] + 2 * CONTEXT)
        score = F.lit(_PRIOR[kind]) + F.when(beside.rlike(_FOR[kind]), 0.2).otherwise(0.0) - F.when(beside.rlike(_AGAINST[kind]), 0.2).otherwise(0.0)
        return F.struct(F.lit(kind).alias("kind"), place["start"].alias("start"), place["end"].alias("end"), F.round(score, 2).alias("score"))

    return F.flatten(F.zip_with(places, near, lambda block, around: F.transform(
        F.filter(block, lambda p: _valid(kind, p["match"])), lambda p: span(p, around))))


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and one array of spans for each kind."""
    body = F.col("_text")
    none = F.array().cast("array<string>")
    out = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    # one step a column: what a later step uses several times is computed once
    out = out.withColumns({f"_m_{k}": F.when(body.rlike(_TRACE[k]), F.regexp_extract_all(body, F.lit(_PATTERNS[k]), F.lit(0))).otherwise(none) for k in ALL_KINDS})
    out = out.withColumns({f"_l_{k}": _pieces(body, k, F.col(f"_m_{k}")) for k in ALL_KINDS})
    out = out.withColumns({f"_p_{k}": _carried(_blocks(F.col(f"_l_{k}")), _placed) for k in ALL_KINDS})
    out = out.withColumn("_p_iban", _accounts(F.col("_p_iban"), _near(body, F.col("_p_iban"))))
    return out.select("doc_id", *(_spans(k, F.col(f"_p_{k}"), _near(body, F.col(f"_p_{k}"))).alias(k) for k in ALL_KINDS))


def _listed(kinds: tuple[str, ...]) -> Column:
    every = F.concat(*(F.col(k) for k in kinds))
    return F.array_join(F.transform(every, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, counts by base kind and of ibans, digest of the base spans, all spans, and the highest score."""
    found = find(docs, doc_id, text)
    return found.select(
        "doc_id", *(F.size(k).cast("bigint").alias(f"n_{k}") for k in ALL_KINDS),
        F.sha2(_listed(KINDS).cast("binary"), 256).alias("base_sha256"), _listed(ALL_KINDS).alias("spans"),
        F.array_max(F.transform(F.concat(*(F.col(k) for k in ALL_KINDS)), lambda s: s["score"])).alias("top_score"))

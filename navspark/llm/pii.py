"""Personal data: patterns propose, checksums confirm, context scores. Built-in functions only.

Regular expressions propose e-mail addresses, IPv4 addresses, payment cards,
phone numbers and IBANs; Luhn (cards) and mod-97 (IBANs) confirm; words within
40 characters on either side raise or lower each span's score. Base kinds are
reported whatever their score; an added kind needs ``MIN_SCORE``.

An IBAN's country fixes its length, so upper-case words and numbers that follow
one don't hide it; every possible start is tried, also inside another proposal.

A scan and a projection: no shuffle, no Python, memory bounded by one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navspark.llm.spans import count_kind, let, regex_spans, span_list

_OCTET = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"

#: Possessive repeats and look-behinds only prune: they give the matches of the
#: plain patterns, without their quadratic scans over long runs.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    # Takes the first four characters only, so that proposals may overlap; group 1 is the longest one.
    "iban": r"(?<![A-Za-z0-9])(?=([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30})(?![A-Za-z0-9]))[A-Z]{2}[0-9]{2}",
}
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = tuple(PATTERNS)

#: kind -> (score before context, words that raise it, words that lower it)
CONTEXT = {
    "email": (0.9, "mail|contact|write|send|reply", "example|noreply"),
    "ip": (0.6, "ip|address|host|server|login|from", "version|release|section|build"),
    "card": (0.8, "card|visa|master|amex|credit|debit|pay|cvv|expir", "order|invoice|isbn|ean|tracking|serial"),
    "phone": (0.7, "phone|tel|call|mobile|cell|fax|whatsapp|dial", "order|invoice|version|part"),
    "iban": (0.8, "iban|bank|account|konto|transfer|bic|swift", "order|serial|part"),
}
CONTEXT_STEP = 0.2

#: IBAN length -> countries, from the ISO 13616 registry and its known partial users.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD TG",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}
#: An IBAN without spaces whose length is its country's; other country codes may have any length.
IBAN_LEGAL = (
    "^(?:"
    + "|".join(f"(?:{c.replace(' ', '|')}).{{{n - 2}}}" for n, c in IBAN_LENGTHS.items())
    + f"|(?!{'|'.join(IBAN_LENGTHS.values()).replace(' ', '|')}).{{15,34}})$"
)
MIN_SCORE = 0.5


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn_ok(value: Column) -> Column:
    """Luhn checksum over the digits of a string."""
    ds = F.transform(F.split(F.reverse(digits(value)), ""), lambda c: c.cast("int"))
    total = F.aggregate(
        F.transform(
            ds,
            lambda x, i: F.when(i % 2 == 0, x).otherwise(F.when(x > 4, x * 2 - 9).otherwise(x * 2)),
        ),
        F.lit(0),
        lambda a, x: a + F.coalesce(x, F.lit(0)),
    )
    return total % 10 == 0


def mod97_ok(value: Column) -> Column:
    """ISO 7064 mod-97-10 check of an IBAN (spaces ignored)."""
    compact = F.regexp_replace(value, r"\x20", "")
    moved = F.concat(F.substr(compact, F.lit(5)), F.left(compact, F.lit(4)))
    rest = F.aggregate(
        F.transform(F.split(moved, ""), lambda c: F.ascii(c)),
        F.lit(0),
        lambda a, c: F.when(c.between(48, 57), (a * 10 + c - 48) % 97)
        .when(c.between(65, 90), (a * 100 + c - 55) % 97)
        .otherwise(a),
    )
    return rest == 1


def _ibans(text: Column) -> Column:
    """The different confirmed IBANs of a text, as written; a longer one before its own prefixes."""

    def confirmed(value: Column) -> Column:
        words = F.split(value, r"\x20")
        prefixes = F.transform(
            F.sequence(F.lit(1), F.size(words)), lambda k: F.array_join(F.slice(words, 1, k), " ")
        )
        legal = F.filter(prefixes, lambda p: F.regexp_replace(p, r"\x20", "").rlike(IBAN_LEGAL))
        return F.slice(F.reverse(F.filter(legal, mod97_ok)), 1, 1)

    found = F.regexp_extract_all(text, F.lit(PATTERNS["iban"]), F.lit(1))
    return F.reverse(F.array_sort(F.array_distinct(F.flatten(F.transform(found, confirmed)))))


def _any_of(ibans: Column) -> Column:
    """A pattern of these IBANs; they hold capitals, digits and spaces only."""
    return F.concat(
        F.lit("(?<![A-Za-z0-9])(?=[A-Z]{2}[0-9]{2})(?:"), F.array_join(ibans, "|"), F.lit(")(?![A-Za-z0-9])")
    )


def _valid(kind: str, s: Column) -> Column:
    v = s["value"]
    n = F.length(digits(v))
    if kind == "ip":
        return v.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return n.between(13, 19) & luhn_ok(v)
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


def _score(kind: str, s: Column) -> Column:
    base, up, down = CONTEXT[kind]
    near = F.concat_ws(" ", s["before"], s["after"])
    score = (
        F.lit(base)
        + F.when(near.rlike(rf"(?i)\b(?:{up})"), CONTEXT_STEP).otherwise(0.0)
        - F.when(near.rlike(rf"(?i)\b(?:{down})"), CONTEXT_STEP).otherwise(0.0)
    )
    return F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), score)), 6)


def pii_spans(text: Column, kind: str) -> Column:
    """Confirmed spans of one kind: ``array<struct<rank, start, end, kind, score>>``."""
    if kind == "iban":
        # Without an IBAN there is no pattern to look for: null text has no spans.
        good = let(_ibans(text), lambda v: regex_spans(F.when(F.size(v) > 0, text), _any_of(v)))
    else:
        good = F.filter(regex_spans(text, PATTERNS[kind]), lambda s: _valid(kind, s))
    out = F.transform(
        good,
        lambda s: F.struct(
            F.lit(KINDS.index(kind)).alias("rank"),
            s["start"].alias("start"),
            s["end"].alias("end"),
            F.lit(kind).alias("kind"),
            _score(kind, s).alias("score"),
        ),
    )
    return out if kind in BASE_KINDS else F.filter(out, lambda s: s["score"] >= MIN_SCORE)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: its id and ``base`` and ``found`` spans.

    Spans are ordered by kind as listed, then start. Null text counts as empty
    (no spans); a null id is kept; repeated rows give repeated results; other
    columns are ignored, so their names cannot clash; an empty table gives an
    empty result; texts of any length are read whole.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.select(F.col(id_col).alias(id_col), *[pii_spans(text, k).alias(f"_{k}") for k in KINDS])
    return d.select(
        id_col,
        F.array_sort(F.concat(*[f"_{k}" for k in BASE_KINDS])).alias("base"),
        F.array_sort(F.concat(*[f"_{k}" for k in KINDS])).alias("found"),
    )


def _replaced(text: Column, kind: str) -> Column:
    if kind == "iban":
        return let(
            _ibans(text),
            lambda v: F.when(F.size(v) > 0, F.regexp_replace(text, _any_of(v), F.lit("[IBAN]"))).otherwise(text),
        )
    pattern = PATTERNS[kind]

    def keep(v: Column) -> Column:
        s = F.struct(v.alias("value"), F.lit("").alias("before"), F.lit("").alias("after"))
        return F.when(_valid(kind, s), F.lit(f"[{kind.upper()}]")).otherwise(v)

    def rebuilt(m: Column) -> Column:
        gaps = F.split(text, pattern, -1)
        return F.array_join(
            F.flatten(F.zip_with(gaps, m, lambda g, v: F.array(g, F.coalesce(keep(v), F.lit(""))))), ""
        )

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return let(found, lambda m: F.when(F.size(m) > 0, rebuilt(m)).otherwise(text))


def redact_documents(docs: DataFrame, text_col: str = "text", n_chars_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with its text redacted and its character count (if any) kept right.

    One projection per kind, so each kind's text is computed once. All other
    columns and all rows stay; null text stays null with its count as it was.
    """
    out = docs
    for kind in ("email", "iban", "card", "phone", "ip"):
        out = out.withColumn(text_col, _replaced(F.col(text_col), kind))
    if n_chars_col and n_chars_col in docs.columns:
        out = out.withColumn(
            n_chars_col,
            F.coalesce(F.length(text_col).cast(docs.schema[n_chars_col].dataType), F.col(n_chars_col)),
        )
    return out


def pii_digest(docs: DataFrame) -> DataFrame:
    """The registered result: counts per base kind, digest of the base spans, all spans, scores."""
    s = find_pii(docs)
    return s.select(
        "doc_id",
        *[count_kind("base", k).alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(span_list(F.col("base")), 256).alias("base_sha256"),
        span_list(F.col("found")).alias("spans"),
        F.array_join(F.transform("found", lambda s: s["score"].cast("string")), ",").alias("scores"),
    )

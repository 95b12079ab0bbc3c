"""Secret scan: token patterns plus sliding-window entropy, built-in functions only.

Three base patterns (assignments, access keys, hex runs) are always reported.
Beside them every candidate string of one character class is scanned with a
sliding window: the window's Shannon entropy per class is kept by incremental
counts (one symbol enters, one leaves), and the stretch from the first to the
last window above the class's threshold becomes a span. Base spans and what the
allow-list names are cut out of the string first; each piece left is scanned by
itself, so neither hides a key elsewhere in a URL or a long run.

The job is a scan and a projection: no shuffle, no Python, memory bounded by
one row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navspark.llm.spans import count_kind, let, regex_spans, span_list

ASSIGN = (
    r"((?i:password|passwd|secret|token|api_?key))"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_MIN = 12
ACCESS = r"AKIA[A-Z0-9]+"
ACCESS_MIN = 18
HEX = r"[0-9a-f]+"
HEX_MIN = 16

WINDOW = 20
#: class name -> (regular expression of its characters, entropy threshold in bits)
CLASSES = {
    "entropy_hex": ("0-9A-F", 3.0),
    "entropy_base64": ("A-Za-z0-9+/_=-", 3.8),
}
#: Characters of a path part: those of the widest class but the slash.
_PART = "[A-Za-z0-9+_=-]"
#: Stretches that look random but are no secrets: UUIDs, file digests announced
#: as such (with their slashes) and AWS's published example keys.
ALLOW = (
    rf"(?<!{_PART})[0-9a-fA-F]{{8}}(?:-[0-9a-fA-F]{{4}}){{3}}-[0-9a-fA-F]{{12}}(?!{_PART})"
    rf"|(?<!{_PART})(?i:sha)(?:"
    + "|".join(
        rf"{bits}-(?:[A-Za-z0-9+/_-]{{{n}}}={{0,2}}(?!{_PART}))?" for bits, n in ((1, 27), (256, 43), (512, 86))
    )
    + rf"){_PART}*+"
    r"|(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{30}EXAMPLEKEY(?![A-Za-z0-9+/])"
)
#: Alphabets and digit runs written out, and placeholder words. They speak for
#: the path part they stand in, as far as ``ALLOW_REACH`` characters.
ALLOW_WORDS = (
    r"(?i:abcdefghij|0123456789|1234567890|example|placeholder|changeme|your[_-]?(?:key|token|secret))"
)
ALLOW_REACH = 2 * WINDOW
_NEAR_WORD = (
    rf"(?:(?={_PART}{{0,{ALLOW_REACH}}}{ALLOW_WORDS})|(?<=(?={ALLOW_WORDS}){_PART}{{1,{ALLOW_REACH + 10}}})){_PART}"
)
KINDS = ("assign", "access", "hex", *CLASSES)
#: The class whose characters hold the other's and those of hex and access spans.
_WIDEST = "entropy_base64"

# A maximal run shorter than the minimum holds no longer one, so the minimum can
# stand in the pattern.
_ACCESS_SPAN = f"{ACCESS[:-1]}{{{ACCESS_MIN - 4},}}+"
_HEX_RUN = f"(?<![0-9a-f]){HEX[:-1]}{{{HEX_MIN},}}+"
#: An access span and what a hex span that begins in its last digits has beyond it.
_ACCESS_RUN = _ACCESS_SPAN + rf"(?:(?<=(?=[0-9a-f]{{{HEX_MIN}}})[0-9]{{1,{HEX_MIN}}})[a-f][0-9a-f]*+)?"


def _plogp() -> Column:
    return F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(WINDOW + 2)])


def _code_range(chars: str) -> tuple[int, int]:
    """First and last code of a class's characters, given as in a regular expression."""
    codes = [ord(c) for c in chars if c != "-"]
    return min(codes), max(codes)


def hot_window(value: Column, threshold: float, window: int = WINDOW, codes_of: tuple[int, int] = (0, 127)) -> Column:
    """``struct<first, last, best>`` over an ASCII string: start of the first and end
    of the last window whose entropy reaches ``threshold`` (-1 if none), and
    the highest entropy seen. Counts change by one symbol in, one symbol out; there
    is one for each code from the first to the last of ``codes_of``."""
    low, high = codes_of
    codes = F.transform(F.split(value, ""), lambda c: F.ascii(c) - low)
    table = _plogp()
    moves = F.arrays_zip(
        codes.alias("i"), F.concat(F.array_repeat(F.lit(-1), window), codes).alias("o")
    )

    def step(st: Column, x: Column) -> Column:
        ci, co = F.get(st["counts"], x["i"]), F.get(st["counts"], x["o"])
        same = x["i"] == x["o"]
        gone = F.when(x["o"] >= 0, F.get(table, co - 1) - F.get(table, co)).otherwise(0.0)
        total = F.when(same, st["total"]).otherwise(
            st["total"] + F.get(table, ci + 1) - F.get(table, ci) + gone
        )
        counts = F.when(same, st["counts"]).otherwise(
            F.transform(
                st["counts"],
                lambda c, k: c + (k == x["i"]).cast("int") - (k == x["o"]).cast("int"),
            )
        )
        pos = st["pos"] + 1
        entropy = F.when(pos >= window, F.lit(math.log2(window)) - total / window).otherwise(0.0)
        hot = entropy >= threshold
        return F.struct(
            counts.alias("counts"),
            total.alias("total"),
            pos.alias("pos"),
            F.when(hot & (st["first"] < 0), pos - window).otherwise(st["first"]).alias("first"),
            F.when(hot, pos).otherwise(st["last"]).alias("last"),
            F.greatest(st["best"], entropy).alias("best"),
        )

    start = F.struct(
        F.array_repeat(F.lit(0), high - low + 1).alias("counts"),
        F.lit(0.0).alias("total"),
        F.lit(0).alias("pos"),
        F.lit(-1).alias("first"),
        F.lit(-1).alias("last"),
        F.lit(0.0).alias("best"),
    )
    # The outgoing list is longer by one window; its tail has no incoming symbol.
    moves = F.filter(moves, lambda x: x["i"].isNotNull())
    return F.aggregate(moves, start, step, lambda st: F.struct(st["first"], st["last"], st["best"]))


def _blank_matches(value: Column, pattern: str) -> Column:
    """``value`` with spaces for the matches of ``pattern``."""

    def without(m: Column) -> Column:
        gaps = F.split(value, pattern, -1)
        blank = F.zip_with(gaps, m, lambda g, v: F.concat(g, F.repeat(F.lit(" "), F.coalesce(F.length(v), F.lit(0)))))
        return F.when(F.size(m) > 0, F.array_join(blank, "")).otherwise(value)

    return let(F.regexp_extract_all(value, F.lit(pattern), F.lit(0)), without)


def _blanked(value: Column) -> Column:
    """``value`` with spaces for what the allow-list names."""
    return let(
        _blank_matches(value, ALLOW),
        lambda v: F.when(v.rlike(ALLOW_WORDS), F.regexp_replace(v, _NEAR_WORD, " ")).otherwise(v),
    )


def _less_base(runs: Column, assign: Column) -> Column:
    """``runs`` of the widest class with spaces in their values where base spans lie.

    A hex or access span lies inside one run, so the run's own matches are
    blanked. An assignment may cover several runs: the two sorted lists are
    merged by position, which gives each run the number of assignments that
    start before it. Of those only the last can reach into the run, and those that
    start inside it stand between its number and the next run's. Every step is
    linear in the text but for the sort.
    """

    def cut(v: Column, s: Column, b: Column) -> Column:
        start = F.greatest(b["start"], s["start"])
        n = (F.least(b["end"], s["end"]) - start).cast("int")
        return F.when(n > 0, F.overlay(v, F.repeat(F.lit(" "), n), (start - s["start"] + 1).cast("int"), n)).otherwise(v)

    def numbered(p: Column) -> Column:
        marks = F.array_sort(
            F.concat(
                F.transform(p["r"], lambda s: F.struct(s["start"].alias("at"), F.lit(0).alias("of"))),
                F.transform(p["a"], lambda b: F.struct(b["start"].alias("at"), F.lit(1).alias("of"))),
            )
        )
        places = F.filter(F.transform(marks, lambda m, i: F.when(m["of"] == 0, i)), lambda i: i.isNotNull())
        return F.struct(p["r"].alias("r"), p["a"].alias("a"), F.transform(places, lambda i, j: i - j).alias("before"))

    def blank(q: Column) -> Column:
        def one(s: Column, j: Column) -> Column:
            c = F.get(q["before"], j)
            upto = F.coalesce(F.get(q["before"], j + 1), F.size(q["a"]))
            first = F.greatest(c - 1, F.lit(0))
            inside = let(_blank_matches(s["value"], _ACCESS_RUN), lambda v: _blank_matches(v, _HEX_RUN))
            left = F.aggregate(F.slice(q["a"], first + 1, upto - first), inside, lambda v, b: cut(v, s, b))
            return F.struct(s["start"].alias("start"), left.alias("value"))

        return F.transform(q["r"], one)

    return let(F.struct(runs.alias("r"), assign.alias("a")), lambda p: let(numbered(p), blank))


def _mixed(spans: Column) -> Column:
    # Secrets mix letters and digits; words, rulers and numbers don't.
    return F.filter(spans, lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[A-Za-z]"))


def _run(kind: str) -> str:
    chars = CLASSES[kind][0]
    return f"(?<![{chars}])[{chars}]{{{WINDOW},}}+"


def _own_runs(left: Column, kind: str) -> Column:
    """A narrower class is judged by its own runs, also where the allow-list looks around."""

    def within(s: Column) -> Column:
        return F.transform(
            _mixed(regex_spans(s["value"], _run(kind))),
            lambda p: F.struct((s["start"] + p["start"]).alias("start"), p["value"].alias("value")),
        )

    return left if kind == _WIDEST else F.flatten(F.transform(left, within))


def _pieces(runs: Column, kind: str) -> Column:
    """What the allow-list leaves of a class's runs."""

    def within(s: Column) -> Column:
        return F.transform(
            _mixed(let(_blanked(s["value"]), lambda w: regex_spans(w, _run(kind)))),
            lambda p: F.struct((s["start"] + p["start"]).alias("start"), p["value"].alias("value")),
        )

    return F.flatten(F.transform(runs, within))


def _entropy_spans(pieces: Column, kind: str) -> Column:
    chars, threshold = CLASSES[kind]
    scored = F.transform(
        pieces,
        lambda p: F.struct(
            p["start"], hot_window(p["value"], threshold, codes_of=_code_range(chars)).alias("w")
        ),
    )
    return F.transform(
        F.filter(scored, lambda s: s["w"]["first"] >= 0),
        lambda s: F.struct(
            (s["start"] + s["w"]["first"]).alias("start"),
            F.lit(KINDS.index(kind)).alias("rank"),
            (s["start"] + s["w"]["last"]).alias("end"),
            F.lit(kind).alias("kind"),
            F.round(s["w"]["best"], 6).alias("entropy"),
        ),
    )


def _base_spans(spans: Column, kind: str) -> Column:
    return F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"),
            F.lit(KINDS.index(kind)).alias("rank"),
            s["end"].alias("end"),
            F.lit(kind).alias("kind"),
            F.lit(0.0).alias("entropy"),
        ),
    )


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: its id, ``base`` and ``found`` spans.

    Both are ``array<struct<start, rank, end, kind, entropy>>`` ordered by
    start, then kind; ``found`` holds the base spans and the entropy spans of
    the text outside them. Null text counts as empty (no spans); a null id is
    kept; repeated rows give repeated results; other columns are ignored, so
    their names cannot clash; an empty table gives an empty result. Texts of
    any length are read whole.
    """
    d = docs.select(F.col(id_col).alias(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    text = F.col("_text")
    assign = F.filter(
        regex_spans(text, ASSIGN), lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 2)) >= ASSIGN_MIN
    )
    access, hexes = regex_spans(text, _ACCESS_SPAN), regex_spans(text, _HEX_RUN)
    kinds = (_base_spans(assign, "assign"), _base_spans(access, "access"), _base_spans(hexes, "hex"))
    d = d.select(id_col, "_text", F.array_sort(F.concat(*kinds)).alias("base"))
    # A step a projection: nested in one expression they exceed the analyzer's iterations.
    assigned = F.filter("base", lambda s: s["kind"] == "assign")
    d = d.select(id_col, "base", _mixed(regex_spans(text, _run(_WIDEST))).alias("_runs"), assigned.alias("_assigned"))
    d = d.select(id_col, "base", _less_base(F.col("_runs"), F.col("_assigned")).alias("_left"))
    d = d.select(id_col, "base", *[_own_runs(F.col("_left"), k).alias(f"_{k}") for k in CLASSES])
    d = d.select(id_col, "base", *[_pieces(F.col(f"_{k}"), k).alias(f"_{k}") for k in CLASSES])
    extra = F.concat(*[_entropy_spans(F.col(f"_{k}"), k) for k in CLASSES])
    return d.select(id_col, "base", F.array_sort(F.concat("base", extra)).alias("found"))


def secret_digest(docs: DataFrame) -> DataFrame:
    """The registered result: counts per base kind, digest of the base spans, all spans."""
    s = scan_secrets(docs)
    return s.select(
        "doc_id",
        *[count_kind("base", k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(span_list(F.col("base")), 256).alias("base_sha256"),
        span_list(F.col("found")).alias("spans"),
        F.coalesce(F.array_max(F.transform("found", lambda s: s["entropy"])), F.lit(0.0)).alias("max_entropy"),
    )

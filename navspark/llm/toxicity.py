"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

Features of a text: densities of a fixed lexicon (plain and de-obfuscated) and
of a lexicon learned from labels, distance from a lexicon hit to the nearest
second-person word, second-person, capital and punctuation rates, and how much
of the text is obfuscated. The learned lexicon holds words and word beginnings
that labels tie to toxic texts; out-of-fold lexicons keep the trees from
trusting it too much. Lexicon, trees and calibration are fitted on a bounded,
hash-chosen sample of labelled rows; features are computed from whole texts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from navspark.llm.boosting import BoostedTrees, apply_isotonic, fit_boosting, fit_isotonic
from navspark.llm.blocks import frugal
from navspark.llm.features import labelled_sample
from navspark.llm.packing import quoted
from navspark.llm.shipping import ship

#: Labelled rows the model is fitted on (expected number).
LABELLED_SAMPLE = 20_000
#: Most units of a learned lexicon, and the least toxic texts a unit needs.
LEARNED_UNITS = 4_000
LEAST_SUPPORT = 4
#: Words whose facts a task keeps at hand, and units it counts before it hands them on.
CACHED_WORDS, HELD_UNITS = 100_000, 250_000
STEMS = (4, 5, 6)
THRESHOLD = 0.3

# Insults the lexicon starts from.
LEXICON = frozenset(
    "arsehole ass asshole bastard bitch clown cretin crap creep cunt damn dick disgusting dumb dumbass fool freak "
    "fuck fucking garbage hate idiot idiotic imbecile jerk kill loser lunatic moron moronic pathetic pig prick rat "
    "retard rubbish scum shit shitty shut slut sucker suck sucks stupid trash ugly useless vermin whore worthless "
    "idiota estúpido imbécil basura asqueroso mierda puta tonto maldito "
    "idiote stupide connard merde salope ordure pourriture abruti débile "
    "dummkopf blöd scheiße scheisse arschloch abschaum schlampe drecksack trottel widerlich".split()
)
# Second-person words.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos "
    "tú ti tus usted ustedes vosotros".split()
)
_LEET = str.maketrans("0134578@$!|*", "oieastbasiia")
_WORD = re.compile(r"[^\W\d_]+")
_MASKED = re.compile(r"[A-Za-z]+(?:[0-9@$!|*.\-_]+[A-Za-z]+)+")
_SPACED = re.compile(r"(?<![A-Za-z])[A-Za-z](?:[ .\-_*][A-Za-z]){3,}(?![A-Za-z])")
_STRETCHED = re.compile(r"([a-z])\1{2,}")
FEATURES = 16

# Byte kinds for the quick test of hidden_hits: letters (1), masks (2), separators of spaced letters.
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[65:91] = _KIND[97:123] = 1
_KIND[list(b"0123456789@$!|*.-_")] = 2
_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[list(b" .-_*")] = True


@dataclass
class ToxicityModel:
    lexicon: dict[str, float]
    trees: BoostedTrees
    knots: tuple[np.ndarray, np.ndarray]


def units(word: str) -> list[str]:
    """A word and its beginnings, as learned-lexicon units."""
    return [word, *[f"{word[:n]}-" for n in STEMS if len(word) >= n]]


def plain_forms(token: str) -> list[str]:
    """What an obfuscated token may stand for: letters put back, or separators left out."""
    low = token.lower()
    return [re.sub(r"[^a-z]", "", low.translate(_LEET)), re.sub(r"[^a-z]", "", low)]


def hidden_hits(text: str, data: np.ndarray | None = None) -> tuple[int, int]:
    """``(obfuscated tokens, lexicon words among them)``; ``data`` are the text's UTF-8 bytes."""
    seen = hits = 0
    if data is None:
        data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    # Without a run of masks between letters, or letters standing apart, no pattern can match.
    kind = _KIND[data]
    if (kind == 2).any():
        runs = kind[(kind != 2) | np.concatenate(([True], kind[:-1] != 2))]
        masked = ((runs[:-2] == 1) & (runs[1:-1] == 2) & (runs[2:] == 1)).any()
    else:
        masked = False
    apart = (kind[:-1] == 1) & _SEPARATOR[data[1:]]
    spaced = len(data) > 6 and (apart[:-4] & apart[2:-2] & apart[4:]).any()
    for m in _MASKED.finditer(text) if masked else ():
        seen += 1
        hits += any(f in LEXICON for f in plain_forms(m[0])) and not any(
            p.lower() in LEXICON for p in _WORD.findall(m[0])
        )
    for m in _SPACED.finditer(text) if spaced else ():
        seen += 1
        hits += re.sub(r"[^a-z]", "", m[0].lower()) in LEXICON
    return seen, hits


def _word_facts(w: str, lexicons: list[dict[str, float]]) -> tuple | bool:
    """``(in lexicon, second person, stretched lexicon word, learned weights)``, False if none holds."""
    stretched = False
    if _STRETCHED.search(w):
        stretched = _STRETCHED.sub(r"\1", w) in LEXICON or _STRETCHED.sub(r"\1\1", w) in LEXICON
    us = units(w)
    weights = [max([lex.get(u, 0.0) for u in us]) for lex in lexicons]
    seed, second = w in LEXICON, w in SECOND_PERSON
    return (seed, second, stretched, weights) if seed or second or stretched or any(weights) else False


def text_features(text: str | None, lexicons: list[dict[str, float]], cache: dict[str, tuple | bool]) -> list[np.ndarray]:
    """One feature row per learned lexicon. An empty or null text is all zeros but for its length."""
    rows = [np.zeros(FEATURES) for _ in lexicons]
    if not text:
        return rows
    low = text.lower()
    words = _WORD.findall(low)
    n = max(len(words), 1)
    counts = Counter(words)
    seed = second = stretched = 0
    learned = [[0.0, 0.0, 0] for _ in lexicons]
    for w, c in counts.items():
        known = cache.get(w)
        if known is False:
            continue
        if known is None:
            if len(cache) > CACHED_WORDS:
                cache.clear()
            known = cache[w] = _word_facts(w, lexicons)
            if known is False:
                continue
        seed += c * known[0]
        second += c * known[1]
        stretched += c * known[2]
        for mine, weight in zip(learned, known[3], strict=True):
            if weight:
                mine[0] += c * weight
                mine[1] = max(mine[1], weight)
                mine[2] += c
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    obfuscated, hidden = hidden_hits(text, data)
    near = 0.0
    if seed and second:
        hits = np.array([i for i, w in enumerate(words) if w in LEXICON])
        you = np.array([i for i, w in enumerate(words) if w in SECOND_PERSON])
        j = np.searchsorted(you, hits)
        gap = np.minimum(
            np.abs(you[np.minimum(j, len(you) - 1)] - hits), np.abs(you[np.maximum(j - 1, 0)] - hits)
        ).min()
        near = 1.0 / gap
    letters = sum(map(len, words))
    upper = int(np.count_nonzero((data >= 65) & (data <= 90)))
    chars = len(text)
    shared = [
        seed / n,
        np.log1p(seed),
        (hidden + stretched) / n,
        np.log1p(hidden + stretched),
        near,
        second / n,
        upper / max(letters, 1),
        text.count("!") / chars,
        text.count("?") / chars,
        (chars - letters - text.count(" ")) / chars,
        obfuscated / n,
        np.log1p(n),
        len(counts) / n,
    ]
    for row, (total, top, hits) in zip(rows, learned, strict=True):
        row[: len(shared)] = shared
        row[len(shared) :] = (total / n, top, np.log1p(hits))
    return rows


def learn_lexicon(pos: np.ndarray, neg: np.ndarray, names: list[str], n_pos: float, n_neg: float, least: int) -> dict[str, float]:
    """Units whose texts are toxic far more often than others: lower bound of the log odds ratio."""
    odds = np.log((pos + 0.5) / (n_pos - pos + 0.5)) - np.log((neg + 0.5) / (n_neg - neg + 0.5))
    spread = np.sqrt(1 / (pos + 0.5) + 1 / (n_pos - pos + 0.5) + 1 / (neg + 0.5) + 1 / (n_neg - neg + 0.5))
    bound = odds - 1.64 * spread
    order = sorted((i for i in np.flatnonzero((bound > 1.0) & (pos >= least))), key=lambda i: (-bound[i], names[i]))
    return {names[i]: float(bound[i]) for i in order[:LEARNED_UNITS]}


def _count_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts per unit, fold and label, added up within the task."""
    total: Counter = Counter()
    for batch in batches:
        for text, slot in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            total.update((u, slot) for u in {u for w in set(_WORD.findall((text or "").lower())) for u in units(w)})
            total[("", slot)] += 1
        if len(total) > HELD_UNITS:
            yield _unit_batch(total)
            total.clear()
    yield _unit_batch(total)


def _unit_batch(total: Counter) -> pa.RecordBatch:
    names = [u for u, _ in total]
    cols = [pa.array(names, pa.string())]
    slots = np.array([s for _, s in total], dtype=np.int64)
    counts = np.array(list(total.values()), dtype=np.int64)
    cols += [pa.array(np.where(slots == s, counts, 0)) for s in range(4)]
    return pa.RecordBatch.from_arrays(cols, names=["unit", "s0", "s1", "s2", "s3"])


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, learn: Column, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text"
) -> ToxicityModel:
    """Learn from labelled rows whose id satisfies ``learn`` (a column over the id).

    An id with several labels is toxic if most say so; null labels and ids are
    ignored; without any label every score is 0.5.
    """
    spark = docs.sparkSession
    ship(spark)
    label = (F.avg(label_col) >= 0.5).cast("int")
    sample = labelled_sample(docs, labels, learn, label, label_col, LABELLED_SAMPLE, id_col, text_col).withColumn(
        "slot", F.col("label") + 2 * F.pmod(F.xxhash64(F.lit(3), "h"), F.lit(2)).cast("int")
    )
    sums = sample.select("text", "slot").mapInArrow(frugal(_count_units), "unit string, s0 bigint, s1 bigint, s2 bigint, s3 bigint")
    sums = sums.groupBy("unit").agg(*[F.sum(f"s{s}").alias(f"s{s}") for s in range(4)])
    rows = sums.where(f"unit = '' OR s1 + s3 >= {LEAST_SUPPORT}").collect()
    sizes = next((np.array([r["s0"], r["s1"], r["s2"], r["s3"]], float) for r in rows if r["unit"] == ""), np.zeros(4))
    rows = sorted((r for r in rows if r["unit"]), key=lambda r: r["unit"])
    names = [r["unit"] for r in rows]
    c = np.array([[r["s0"], r["s1"], r["s2"], r["s3"]] for r in rows], float).reshape(-1, 4)
    least = max(2, LEAST_SUPPORT // 2)
    of_fold = [learn_lexicon(c[:, 2 * f + 1], c[:, 2 * f], names, sizes[2 * f + 1], sizes[2 * f], least) for f in (0, 1)]
    full = learn_lexicon(c[:, 1] + c[:, 3], c[:, 0] + c[:, 2], names, sizes[1] + sizes[3], sizes[0] + sizes[2], LEAST_SUPPORT)

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, tuple | bool] = {}
        for batch in batches:
            out = []
            for text, slot in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                out.append(text_features(text, of_fold, cache)[1 - slot // 2])  # the other fold's lexicon
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array(out, pa.list_(pa.float64()))], names=["slot", "h", "x"]
            )

    got = sample.select("text", "slot", "h").mapInArrow(frugal(featurise), "slot int, h bigint, x array<double>").collect()
    got.sort(key=lambda r: r["h"])
    x = np.array([r["x"] for r in got]).reshape(-1, FEATURES)
    y = np.array([r["slot"] % 2 for r in got], float)
    # Calibrate on margins of trees that have not seen the row: five folds by order of hash.
    fold = np.arange(len(y)) % 5
    margin = np.zeros(len(y))
    for k in range(5):
        if (fold == k).any():
            margin[fold == k] = fit_boosting(x[fold != k], y[fold != k]).margin(x[fold == k])
    return ToxicityModel(full, fit_boosting(x, y), fit_isotonic(margin, y))


def score_toxicity(
    docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """``(id, score)``, or ``row``, a struct of the columns ``keep``, and ``score``, for every row.

    Null and empty texts get the score of a text without features; null ids
    are kept; repeated rows give repeated results; texts of any length are
    scored whole; an empty table gives an empty result; columns other than
    those named are ignored, and those kept may have any names and types.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    passed = F.col(id_col).alias(id_col) if keep is None else F.struct(*[F.col(quoted(c)) for c in keep]).alias("row")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        cache: dict[str, tuple | bool] = {}
        for batch in batches:
            x = np.zeros((batch.num_rows, FEATURES))
            for i, text in enumerate(batch.column(0)):
                x[i] = text_features(text.as_py(), [m.lexicon], cache)[0]
            score = np.clip(apply_isotonic(m.knots, m.trees.margin(x)), 0.0, 1.0)
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(score)], names=schema.names)

    rows = docs.select(F.col(quoted(text_col)).alias("text"), passed)
    schema = T.StructType([rows.schema.fields[1], T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(frugal(make), schema)


def learn_ids(id_col: str = "doc_id") -> Column:
    """Ids whose labels may be learned from: ``crc32 mod 4`` is not 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 != 2, F.lit(False))


def toxicity_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The registered result: learn outside ``crc32(doc_id) mod 4 = 2``, score every document."""
    model = fit_toxicity(docs, labels, learn_ids())
    return score_toxicity(docs, model).select(
        "doc_id", (~learn_ids()).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )

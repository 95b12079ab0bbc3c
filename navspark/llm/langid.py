"""Language identification by nearest centroid.

Texts become L2-normalised TF-IDF vectors of hashed letter 1- to 3-grams.
Document frequencies come from every learning text; each language's centroids
from spherical k-means over a bounded, hash-chosen sample of its texts, one
task per language. A prediction is the language of the centroid with the
highest cosine; a text farther from it than that centroid's own members were
is marked as rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navspark.llm.features import (
    below,
    document_frequencies,
    inverse_frequencies,
    is_letter,
    letters_only,
    ngram_counts,
    row_hash,
)
from navspark.llm.shipping import ship
from navspark.plans.materialize import broadcast_if_small, materialize

FEATURES = 8192
CENTROIDS = 4
#: Expected texts per language that k-means is fitted on.
SAMPLE_PER_LANGUAGE = 400
#: Centroids held as a dense block at once; more of them are unpacked block by block.
DENSE_CENTROIDS = 8_192
ITERATIONS = 12
#: A text is rejected below this share of the centroid's lowest member cosine (0.5 % quantile).
REJECT_SHARE = 0.8
UNDETERMINED = "und"
_CHUNK = 64


@dataclass
class LanguageModel:
    languages: list[str]  # of each centroid
    centroids: list[tuple[np.ndarray, np.ndarray]]  # places and values of unit rows of FEATURES
    floors: np.ndarray  # lowest cosine each centroid accepts
    idf: np.ndarray

    def block(self, first: int) -> np.ndarray:
        """Dense rows of the centroids from ``first`` on, ``DENSE_CENTROIDS`` at most."""
        part = self.centroids[first : first + DENSE_CENTROIDS]
        out = np.zeros((len(part), FEATURES), np.float32)
        for row, (at, x) in zip(out, part, strict=True):
            row[at] = x
        return out


def nearest(v: np.ndarray, model: LanguageModel, dense: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Each row's centroid of highest cosine (ties: the first) and that cosine."""
    best, top = np.zeros(len(v), np.int64), np.full(len(v), -np.inf, np.float32)
    for first in range(0, len(model.centroids), DENSE_CENTROIDS):
        cos = v @ (dense if dense is not None else model.block(first)).T
        at = np.argmax(cos, axis=1)
        high = cos[np.arange(len(v)), at]
        better = high > top
        best[better], top[better] = first + at[better], high[better]
    return best, top


def _counts(text: str) -> np.ndarray:
    return ngram_counts(letters_only(text), FEATURES)


def vectors(texts: list[str], idf: np.ndarray) -> np.ndarray:
    """Unit TF-IDF rows; a text without letters is a zero row."""
    v = np.stack([_counts(t) for t in texts])
    np.log1p(v, out=v)
    v *= idf
    norm = np.linalg.norm(v, axis=1, keepdims=True)
    return v / np.where(norm > 0, norm, 1)


def spherical_kmeans(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit centroids and each row's centroid; farthest-first start, so no chance is involved."""
    picks = [int(np.argmax(v @ v.mean(axis=0)))]
    near = v @ v[picks[0]]
    while len(picks) < min(k, len(v)):
        nxt = int(np.argmin(near))
        if near[nxt] > 1 - 1e-6:
            break
        picks.append(nxt)
        near = np.maximum(near, v @ v[nxt])
    c = v[picks].copy()
    for _ in range(ITERATIONS):
        at = np.argmax(v @ c.T, axis=1)
        for j in range(len(c)):
            mine = v[at == j]
            if len(mine):
                m = mine.sum(axis=0)
                c[j] = m / max(np.linalg.norm(m), 1e-12)
    return c, np.argmax(v @ c.T, axis=1)


def fit_languages(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Learn from the rows of ``docs`` where ``learn`` holds and text and language are not null."""
    ship(docs.sparkSession)
    rows = docs.where(learn).select(
        F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), row_hash(id_col, text_col).alias("h")
    ).where("text IS NOT NULL AND lang IS NOT NULL")
    df, n = document_frequencies(rows.select("text"), _counts, FEATURES)
    idf = inverse_frequencies(df, n)
    counts = materialize(rows.groupBy(F.col("lang").alias("of_lang")).agg((F.lit(float(SAMPLE_PER_LANGUAGE)) / F.count("*")).alias("rate")))
    rated = rows.join(broadcast_if_small(counts), F.col("lang") == F.col("of_lang"))
    sample = rated.where(below(F.least(F.col("rate"), F.lit(1.0)), F.col("h"))).select("text", "lang", "h").dropDuplicates(["lang", "h"])

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["h", "text"])
        v = vectors(list(pdf["text"]), idf)
        v = v[np.linalg.norm(v, axis=1) > 0]
        if not len(v):
            return pd.DataFrame({"lang": [], "at": [], "x": [], "floor": []})
        c, at = spherical_kmeans(v, CENTROIDS)
        used = [j for j in range(len(c)) if (at == j).any()]
        floors = [float(np.quantile((v[at == j] @ c[j]), 0.005)) for j in used]
        rows = [c[j].astype(np.float32) for j in used]
        places = [np.flatnonzero(r).astype(np.int32) for r in rows]
        return pd.DataFrame({
            "lang": pdf["lang"].iloc[0],
            "at": [p.tobytes() for p in places],
            "x": [r[p].tobytes() for r, p in zip(rows, places, strict=True)],
            "floor": floors,
        })

    # Languages are fitted one a task; a rare one has few texts and so short lists.
    fitted = sample.groupBy("lang").applyInPandas(fit, "lang string, at binary, x binary, floor double").collect()
    fitted.sort(key=lambda r: (r["lang"], bytes(r["at"]), bytes(r["x"])))
    return LanguageModel(
        [r["lang"] for r in fitted],
        [(np.frombuffer(bytes(r["at"]), np.int32), np.frombuffer(bytes(r["x"]), np.float32)) for r in fitted],
        np.array([r["floor"] for r in fitted]),
        idf,
    )


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text", reject: bool = True) -> DataFrame:
    """``(id, lang_pred, score, rejected)`` for every row of ``docs``.

    ``score`` is the cosine with the nearest centroid. With ``reject`` a text
    beyond its centroid's reach is ``und``; else only null texts and texts
    without a letter are. Equal cosines go to the first language by name. Null
    ids are kept, repeated rows give repeated results, texts of any length are
    read whole, other columns are ignored, an empty table gives an empty result, and a model without
    languages answers ``und``.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, lang_pred string, score double, rejected boolean"

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        dense = m.block(0) if len(m.centroids) <= DENSE_CENTROIDS else None
        for batch in batches:
            langs, scores, out_of_reach = [UNDETERMINED] * batch.num_rows, np.zeros(batch.num_rows), np.zeros(batch.num_rows, bool)
            held: list[tuple[int, str]] = []

            def flush() -> None:
                v = vectors([t for _, t in held], m.idf)
                for (i, _), j, cos in zip(held, *nearest(v, m, dense), strict=True):
                    scores[i] = min(1.0, max(0.0, float(cos)))
                    out_of_reach[i] = scores[i] < m.floors[j] * REJECT_SHARE
                    langs[i] = UNDETERMINED if reject and out_of_reach[i] else m.languages[j]
                held.clear()

            for i, text in enumerate(batch.column(1).to_pylist()):
                if text and m.languages and has_letter(text):
                    held.append((i, text))
                    if len(held) == _CHUNK:
                        flush()
            if held:
                flush()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(scores), pa.array(out_of_reach)],
                names=[id_col, "lang_pred", "score", "rejected"],
            )

    return docs.select(id_col, text_col).mapInArrow(predict, schema)


def has_letter(text: str) -> bool:
    if any(c.isalpha() for c in text[:64]):
        return True
    from navspark.llm.textops import code_points

    return bool(is_letter(code_points(text)).any())


def language_digest(docs: DataFrame) -> DataFrame:
    """The registered result: learn outside ``crc32(doc_id) mod 3 = 1``, predict every document."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(True))
    model = fit_languages(docs, ~held_out)
    return identify(docs, model, reject=False).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected"
    )

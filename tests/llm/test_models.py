"""op1, op3, op6: held-out accuracy on real tables, and edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from navspark.llm.boosting import apply_isotonic, fit_boosting, fit_isotonic
from navspark.llm.features import PIECE, letters_only, ngram_counts
from navspark.llm.langid import UNDETERMINED, fit_languages, identify, language_digest, spherical_kmeans
from navspark.llm.quality import fit_quality, quality_digest, score_quality, vote, QualityModel
from navspark.llm.toxicity import LEXICON, fit_toxicity, hidden_hits, learn_ids, score_toxicity, text_features, toxicity_digest
from tests.conftest import SF_SMALL
from tests.llm.brute import toxicity_score

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source")
    odd = [
        (900_000, None, "en", "s"),
        (900_001, "", "en", "s"),
        (900_002, "1234 ... 5678 !!", "en", "s"),
        (None, "the and of to in is that for it with", "en", "s"),
        (900_003, "the and of to " * 100_000, None, None),
        (900_004, "12 34 " * 200 + "the and of the thing", "en", "s"),
    ]
    return d.union(spark.createDataFrame(odd * 2, d.schema)).selectExpr("*", "1 AS h", "2 AS score", "3 AS label")


@pytest.fixture(scope="module")
def labels(spark):
    t = spark.read.parquet(f"{SF}/labels.parquet")
    more = [(None, 1, 1), (900_000, None, None), (900_001, 1, 0), (900_001, 1, 0), (1, 1, 0)]
    return t.union(spark.createDataFrame(more, t.schema))


def test_language(docs):
    got = {r.doc_id: r for r in language_digest(docs).collect()}
    for i in (900_000, 900_001, 900_002):
        assert got[i].lang_pred == UNDETERMINED and got[i].score == 0
    assert got[900_003].lang_pred == got[900_004].lang_pred == got[None].lang_pred == "en"
    rows = docs.where("doc_id < 900000").select("doc_id", "lang").collect()
    held = [(r.lang, got[r.doc_id].lang_pred) for r in rows if got[r.doc_id].held_out]
    assert len(held) > 250 and np.mean([a == b for a, b in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())
    assert language_digest(docs).count() == docs.count()


def test_language_rejection(spark, docs):
    model = fit_languages(docs, F.lit(True))
    known = docs.where("lang = 'en' AND length(text) > 2000 AND doc_id < 1000").orderBy("doc_id").first().text
    far = spark.createDataFrame([(1, "αβγδε ζηθικ λμνξο πρστυ"), (2, known)], "doc_id int, text string")
    got = {r.doc_id: (r.lang_pred, r.rejected) for r in identify(far, model).collect()}
    assert got[1] == (UNDETERMINED, True) and got[2][0] == "en"
    none = fit_languages(docs.limit(0), F.lit(True))
    assert {r.lang_pred for r in identify(far, none).collect()} == {UNDETERMINED}
    assert identify(far.limit(0), model).count() == 0


def test_kmeans_separates():
    rng = np.random.default_rng(0)
    v = np.concatenate([np.eye(4)[i] * 5 + rng.standard_normal((30, 4)) * 0.1 for i in range(3)])
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    _, at = spherical_kmeans(v, 3)
    assert all(len(set(at[i * 30 : i * 30 + 30])) == 1 for i in range(3)) and len(set(at)) == 3
    assert len(spherical_kmeans(np.repeat(v[:1], 5, axis=0), 4)[0]) == 1


def test_long_text_counts_in_pieces():
    p = letters_only("abc def " * 5)
    long = np.tile(p, 2 * PIECE // len(p))
    a = ngram_counts(long, 512)
    assert a.sum() == sum(len(long) - n + 1 for n in (1, 2, 3))


def accuracy(got, labels, column):
    known = {r.doc_id: r[column] for r in labels.where("doc_id < 900000").collect()}
    return [(known[r.doc_id], r.predicted) for r in got if r.doc_id in known and r.held_out]


def test_quality(docs, labels):
    got = quality_digest(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    held = accuracy(got, labels, "quality")
    assert len(held) > 80 and np.mean([a == b for a, b in held]) > 0.9
    empty = {r.score for r in got if r.doc_id in (900_000, 900_001)}
    assert len(empty) == 1


def test_quality_without_labels(spark, docs, labels):
    model = fit_quality(docs, labels.limit(0), F.lit(True))
    assert {r.score for r in score_quality(docs.limit(20), model).collect()} == {0.5}
    model = fit_quality(docs.limit(0), labels, F.lit(True))
    assert score_quality(docs.limit(0), model).count() == 0
    assert {r.score for r in score_quality(docs.limit(5), model).collect()} == {0.5}


def test_vote_ties():
    m = QualityModel(np.ones(1), np.ones((1, 2)), np.repeat(np.eye(2, dtype=np.float32), 40, axis=0), np.r_[np.ones(40), np.zeros(40)], 0.5)
    got = vote(np.array([[1, 0], [0, 1], [0, 0], [0.7071, 0.7071]], np.float32), m)
    assert got.tolist() == [1.0, 0.0, 0.5, 0.5]


def test_toxicity(docs, labels):
    got = toxicity_digest(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    held = accuracy(got, labels, "toxic")
    assert len(held) > 60 and np.mean([a == b for a, b in held]) > 0.9
    assert all(r.predicted == int(r.score >= 0.3) for r in got)
    assert {r.predicted for r in got if r.doc_id in (900_000, 900_001, 900_002)} == {0}


def test_toxicity_without_labels(docs, labels):
    assert {r.score for r in toxicity_digest(docs.limit(20), labels.limit(0)).collect()} == {0.5}
    assert toxicity_digest(docs.limit(0), labels).count() == 0


def test_obfuscation():
    assert {"idiot", "stupid"} <= LEXICON
    assert hidden_hits("you 1d10t! an id1ot, s t u p i d and st.up.id") [1] >= 3
    assert hidden_hits("plain words, well-known e-mail v1.2")[1] == 0
    a, = text_features("You are an idiot and you know it.", [{}], {})
    b, = text_features("You know it and so on for many words until an idiot.", [{}], {})
    assert a[4] > b[4] > 0
    assert text_features(None, [{}], {})[0].sum() == 0


def test_boosting_and_calibration():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((1500, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(float)
    m = fit_boosting(x[:1000], y[:1000])
    assert (((m.margin(x[1000:]) > 0) == y[1000:]).mean()) > 0.93
    s = rng.random(400)
    label = (rng.random(400) < s**2).astype(float)
    xs, ys = fit_isotonic(s, label)
    assert (np.diff(ys) >= 0).all() and (np.diff(xs) >= 0).all()
    brute = min(
        (float(((apply_isotonic((xs, ys), s) - label) ** 2).sum()), 0.0),
        (float(((label.mean() - label) ** 2).sum()), 1.0),
    )
    assert brute[1] == 0.0
    assert apply_isotonic(fit_isotonic(np.zeros(0), np.zeros(0)), np.array([3.0]))[0] == 0.5
    assert len(fit_boosting(x, np.zeros(1500)).trees) == 0


def plain_grams(text):
    """Hashed 1- to 3-grams of a text's letters, one by one in Python integers."""
    low = "".join(c if c.isalpha() else " " for c in text.lower())
    points = [ord(c) for i, c in enumerate(low) if c != " " or (i and low[i - 1] != " ")]
    out = {}
    for n in (1, 2, 3):
        for i in range(len(points) - n + 1):
            h = n * 0x27D4EB2F & 0xFFFFFFFF
            for p, prime in zip(points[i : i + n], (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)):
                h = (h ^ p) * prime & 0xFFFFFFFF
                h ^= h >> 15
            f = (h * 0x2C1B3C6D & 0xFFFFFFFF) >> 19
            out[f] = out.get(f, 0) + 1
    return out


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet"), spark.read.parquet(f"{SF_SMALL}/labels.parquet")


def test_language_against_brute_force(small, monkeypatch):
    """Every cosine of every text of the table with every centroid, in plain Python."""
    import math

    import navspark.llm.langid as langid

    model = fit_languages(small[0], F.lit(True))
    centroids = [dict(zip(at.tolist(), x.tolist())) for at, x in model.centroids]
    got = {r.doc_id: r for r in identify(small[0], model, reject=False).collect()}
    for r in small[0].collect():
        v = {f: math.log1p(c) * float(model.idf[f]) for f, c in plain_grams(r.text or "").items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        if not any(c.isalpha() for c in r.text or ""):
            assert got[r.doc_id].lang_pred == UNDETERMINED
            continue
        cos = [sum(x * c.get(f, 0.0) for f, x in v.items()) / norm for c in centroids]
        assert abs(got[r.doc_id].score - min(1.0, max(cos))) < 1e-4
        mine = max(c for c, lang in zip(cos, model.languages) if lang == got[r.doc_id].lang_pred)
        assert mine >= max(cos) - 1e-5
    # Blocks of centroids give the same answers as all of them at once.
    monkeypatch.setattr(langid, "DENSE_CENTROIDS", 3)
    v = langid.vectors([r.text for r in small[0].limit(40).collect() if r.text], model.idf)
    dense = np.concatenate([model.block(i) for i in range(0, len(model.centroids), 3)])
    at, top = langid.nearest(v, model, None)
    assert (at == np.argmax(v @ dense.T, axis=1)).all() and np.allclose(top, (v @ dense.T).max(axis=1))


def test_many_languages_and_letterless_texts(spark):
    rows = [(i, f"text number {chr(97 + i % 26)} {i}", f"l{i % 2500}", "s") for i in range(5_000)]
    model = fit_languages(spark.createDataFrame(rows, "doc_id int, text string, lang string, source string"), F.lit(True))
    assert len(set(model.languages)) == 2500
    odd = [(1, "\U000F0000\U000E0100 12"), (2, "\U00031350"), (3, "\U0010FFFF")]
    got = {r.doc_id: r.lang_pred for r in identify(spark.createDataFrame(odd, "doc_id int, text string"), model, reject=False).collect()}
    assert got[1] == got[3] == UNDETERMINED and got[2] != UNDETERMINED


def test_quality_against_brute_force(small):
    """Each text's similarities with all labelled vectors, sorted and voted one by one."""
    from navspark.llm.quality import NEIGHBOURS, SHARPNESS, weighted

    model = fit_quality(*small, F.lit(True))
    got = {r.doc_id: r.score for r in score_quality(small[0], model).collect()}
    vectors = [[float(x) for x in v] for v in model.vectors]
    for r in small[0].collect():
        v = [float(x) for x in (weighted([r.text], model.idf) @ model.basis)[0]]
        norm = sum(x * x for x in v) ** 0.5
        if norm:
            sims = sorted(((sum(a * b for a, b in zip(v, u)) / norm, y) for u, y in zip(vectors, model.labels)), reverse=True)
            last = sims[min(NEIGHBOURS, len(sims)) - 1][0]
            voters = [(s**SHARPNESS, y) for s, y in sims if s >= last - 1e-6 and s > 0]
        total = sum(w for w, _ in voters) if norm else 0
        expected = sum(w * y for w, y in voters) / total if total else model.prior
        assert abs(got[r.doc_id] - expected) < 2e-3, r.doc_id


def test_toxicity_against_brute_force(small):
    """Each text's way through every tree, node by node, and the calibration between its knots."""
    model = fit_toxicity(*small, learn_ids())
    got = {r.doc_id: r.score for r in score_toxicity(small[0], model).collect()}
    for r in small[0].collect():
        assert abs(got[r.doc_id] - toxicity_score(model, r.text)) < 1e-9


def test_the_sample_is_of_rows_not_of_ids(spark, monkeypatch):
    from navspark.llm.features import labelled_sample

    rows = [(1, f"text {i}") for i in range(3_000)] + [(i, "other") for i in range(2, 12)]
    docs = spark.createDataFrame(rows, "doc_id int, text string").selectExpr("*", "1 AS h", "2 AS label", "3 AS known_id")
    labels = spark.createDataFrame([(i, 1) for i in range(1, 12)], "doc_id int, quality int")
    n = labelled_sample(docs, labels, F.lit(True), F.avg("quality"), "quality", 200, "doc_id", "text").count()
    assert 120 < n < 280
    assert labelled_sample(docs, labels, F.lit(True), F.avg("quality"), "quality", 10**6, "doc_id", "text").count() == 3_010

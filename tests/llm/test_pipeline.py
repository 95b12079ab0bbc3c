"""The corpus pipeline stage by stage against plain Python."""

import corpus_pipeline as cp
import pytest
from pyspark.sql import functions as F

from navspark.llm.toxicity import THRESHOLD, fit_toxicity, learn_ids
from tests.conftest import SF_SMALL
from tests.llm.brute import components, contaminated, shingles, toxicity_score
from tests.llm.test_spans import base_pii


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = [docs]
    for name, stage in cp.STAGES:
        stage(spark, out[-1], SF_SMALL).write.parquet(f"{folder}/{name}")
        out.append(spark.read.parquet(f"{folder}/{name}"))
    return [([tuple(r) for r in d.collect()], d.columns) for d in out]


def ids(step):
    return [r[0] for r in step[0]]


def test_names_and_columns(steps):
    assert [n for n, _ in cp.STAGES] == ["toxicity", "near_dedup", "decontamination", "pii", "mixing"]
    assert all(c == steps[0][1] for _, c in steps[:-1])


def test_toxicity_rejects(spark, steps):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = fit_toxicity(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"), learn_ids())
    bad = {r.doc_id for r in docs.collect() if toxicity_score(model, r.text) >= THRESHOLD}
    assert bad and set(ids(steps[1])) == set(ids(steps[0])) - bad


def test_one_of_each_group(steps):
    comp = components({r[0]: shingles(r[1]) for r in steps[1][0]})
    assert sorted(ids(steps[2])) == sorted(d for d, c in comp.items() if d == c)


def test_decontamination(spark, steps):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()}
    want = [r[0] for r in steps[2][0] if not contaminated(r[1], items)]
    assert sorted(ids(steps[3])) == sorted(want)


def test_pii_gone_and_counted(steps):
    before = {r[0]: r[1] for r in steps[3][0]}
    assert sorted(ids(steps[4])) == sorted(before)
    for r in steps[4][0]:
        assert not [s for s in base_pii(r[1])] and r[4] == len(r[1])
        if not base_pii(before[r[0]]):
            assert r[1] == before[r[0]]


def test_mixing_counts(steps):
    out = steps[5]
    columns = out[1]
    copy, copies = columns.index("copy"), columns.index("copies")
    assert set(ids(out)) <= set(ids(steps[4]))
    by_doc = {}
    for r in out[0]:
        by_doc.setdefault(r[0], []).append((r[copy], r[copies]))
    assert all(sorted(c for c, _ in v) == list(range(1, v[0][1] + 1)) for v in by_doc.values())


def test_repeated_rows_and_nulls(spark):
    rows = [(1, "a b c d e f", "en", "s", 11), (1, "a b c d e f", "en", "s", 11), (2, None, None, None, None), (None, "x", "en", "s", 1), (3, "A b c d e f", "en", "s", 11)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    out = sorted((str(r.doc_id), r.text) for r in cp.near_dedup(spark, docs, SF_SMALL).collect())
    assert out == [("1", "a b c d e f"), ("2", None), ("None", "x")]
    assert cp.pii(spark, docs, SF_SMALL).count() == 5
    assert cp.decontamination(spark, docs, SF_SMALL).count() == 5
    assert cp.near_dedup(spark, docs.limit(0), SF_SMALL).count() == 0
    assert cp.mixing(spark, docs.limit(0), SF_SMALL).count() == 0


def test_rows_with_null_and_repeated_ids_are_judged_by_text(spark):
    item = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").orderBy("item_id").first().text
    near, clean = "one two three four five six seven eight nine ten", "quite other words stand in this short clean text"
    kind = "doc_id bigint, text string, lang string, source string, n_chars bigint"

    def left(stage, rows):
        docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], kind)
        return sorted((str(r.doc_id), str(r.text)) for r in stage(spark, docs, SF_SMALL).collect())

    rows = [(None, item), (None, clean), (4, item), (4, clean), (5, clean), (None, None)]
    assert left(cp.decontamination, rows) == [("4", clean), ("5", clean), ("None", "None"), ("None", clean)]
    rows = [(7, near), (7, clean), (8, near), (None, near), (None, "x y"), (None, "x y"), (None, None), (None, None), (9, None), (9, None)]
    want = [("7", near), ("7", clean), ("9", "None"), ("None", "None"), ("None", "None"), ("None", "x y")]
    assert left(cp.near_dedup, rows) == want


#: Names that operators and stages use inside, and one column each of a type that has no order.
INNER = (
    "toxicity _text score row uid id text_ _source _draw cdf parts draw of_source source_ rate salt gone number n n_shingles "
    "component_id keeper kept copy copies shuffle_key label h slot known_id term item_no words postings place lo hi _uid _again a.b `x`"
).split()


@pytest.fixture(scope="module")
def clashing(spark):
    """Documents with nulls, repeats and copies beside columns of every inner name."""
    text = "one two three four five six seven eight nine ten"
    rows = [(1, text), (1, text), (2, text + " eleven"), (3, None), (3, None), (None, "x y"), (None, None), (4, ""), (5, "other words here")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    extra = [F.map_from_arrays(F.array(F.lit("k")), F.array(F.col("doc_id"))).alias(c) for c in INNER]
    return docs.select("*", *extra)


@pytest.mark.parametrize("name", [n for n, _ in cp.STAGES])
def test_extra_columns_of_any_name_pass(spark, clashing, name, tmp_path):
    stage = dict(cp.STAGES)[name]
    out = stage(spark, clashing, SF_SMALL)
    plain = stage(spark, clashing.select("doc_id", "text", "lang", "source", "n_chars"), SF_SMALL)
    added = ["copy", "copies", "shuffle_key"] if name == "mixing" else []
    assert out.columns == [c for c in clashing.columns if c not in added] + added
    rows, bare = (sorted((str(r["doc_id"]), str(r["text"])) for r in d.collect()) for d in (out, plain))
    assert rows == bare
    out.drop("a.b").write.parquet(str(tmp_path / "out"))
    assert stage(spark, clashing.limit(0), SF_SMALL).collect() == []


def test_near_dedup_keeps_one_of_equal_rows(spark, clashing):
    kept = [(r.doc_id, r.text) for r in cp.near_dedup(spark, clashing, SF_SMALL).collect()]
    text = "one two three four five six seven eight nine ten"
    assert sorted(map(str, kept)) == sorted(map(str, [(1, text), (3, None), (4, ""), (5, "other words here"), (None, "x y"), (None, None)]))

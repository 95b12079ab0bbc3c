"""Source divergence against the sum over every kept term."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from navspark.llm import divergence
from navspark.llm.divergence import source_divergence, terms, tree_corrections
from tests.conftest import SF_SMALL
from tests.llm.brute import lower_ascii
from tests.oracle_compare import compare

SCHEMA = "doc_id long, text string, lang string, source string"


def plain(rows, least=30):
    docs = [(lower_ascii(t), lang or "", source or "") for _, t, lang, source in rows]
    found = [(Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t)), lang, s) for t, lang, s in docs]
    df = Counter((lang, w) for c, lang, _ in found for w in c)
    kept = defaultdict(list)
    for (lang, w), n in df.items():
        if n >= least:
            kept[lang].append(w)
    count, groups = defaultdict(Counter), {(lang, s) for _, lang, s in found}
    for c, lang, s in found:
        for w, n in c.items():
            if df[lang, w] >= least:
                count[lang, s][w] += n
                count[lang, None][w] += n

    def shares(lang, s):
        c, v = count[lang, s], kept[lang]
        size = sum(c.values()) + 5 * len(v)
        return {w: 1 + 1_000_000_000 * (c[w] + 5) // size for w in v}

    out = []
    for lang, s in groups:
        p, q = shares(lang, s), shares(lang, None)
        pairs = []
        for other in {b for a, b in groups if a == lang and b != s}:
            r = shares(lang, other)
            pairs.append((-sum(abs(p[w] - r[w]) for w in p), other))
        over = [(-(p[w] - q[w]), w) for w in p if count[lang, s][w] > 0 and p[w] > q[w]]
        for part, found_rows in (("pair", pairs), ("term", over)):
            for k, (value, item) in enumerate(sorted(found_rows, key=lambda x: (x[0], x[1].encode())), 1):
                if part == "pair" or k <= 50:
                    out.append((lang, s, part, item, -value, k))
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def sample(n, seed=1):
    rng = random.Random(seed)
    words = ["The", "the", "É", "é", "straße", "a1b", "日本", "x_y", "z", *[f"w{chr(97 + i)}" for i in range(20)]]
    return [
        (i, " ".join(rng.choices(words, weights=range(len(words), 0, -1), k=rng.randint(0, 30))), rng.choice(["en", "de"]), f"s{min(rng.randint(0, 9), 6)}")
        for i in range(n)
    ]


def test_against_every_term(spark):
    rows = sample(400)
    odd = [
        (900, None, "en", "s0"),
        (901, "", "en", "empty"),
        (902, "the " * 50_000, "en", "s1"),
        (903, "the é z", None, None),
        (904, "the", "en", None),
        (905, "1 2 3 []", "fr", "only"),
        (906, "un", "fr", "other"),
        rows[0],
    ]
    for some in (rows, rows + odd, rows[:20], odd):
        expected = plain(some)
        assert got(source_divergence(spark.createDataFrame(some, SCHEMA).repartition(5))) == expected
    assert any(r[2] == "term" for r in plain(rows))


def test_empty_table_and_extra_columns(spark):
    assert got(source_divergence(spark.createDataFrame([], SCHEMA))) == []
    rows = sample(200, 2)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS n", "'t' AS term", "2 AS value", "map(1, 2) AS item", "3 AS p", "4 AS v")
    assert got(source_divergence(df)) == plain(rows)


def test_small_blocks_and_early_flushes_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK_CELLS", 8)
    monkeypatch.setattr(divergence, "HELD_COUNTS", 5)
    rows = sample(300, 3)
    counts = divergence.term_counts(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sum(r["n"] for r in counts) == sum(len(terms(r[1].encode())) for r in rows)
    assert got(source_divergence(spark.createDataFrame(rows, SCHEMA))) == plain(rows)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.dictionaries(st.integers(0, 4), st.integers(0, 3), min_size=1), min_size=1, max_size=12))
def test_tree_equals_pairs_of_each_path(rows):
    base = [7, 3, 5, 5, 1]
    paths = sorted([(s, base[s] + 4 * n, base[s]) for s, n in sorted(r.items())] for r in rows)
    expected = Counter()
    for path in paths:
        for j, (h, ph, qh) in enumerate(path):
            for g, pg, qg in path[:j]:
                expected[g, h] += abs(pg - ph) - abs(pg - qh) - abs(qg - ph) + abs(qg - qh)
    distinct = [p for i, p in enumerate(paths) if not i or p != paths[i - 1]]
    flat = np.array([x for p in distinct for x in p], dtype=np.int64).reshape(-1, 3)
    offsets = np.cumsum([0, *map(len, distinct)])
    pairs, total = tree_corrections(flat[:, 0], flat[:, 1], flat[:, 2], offsets, np.array([paths.count(p) for p in distinct]))
    found = {(int(g), int(h)): int(v) for (g, h), v in zip(pairs, total)}
    assert {k: v for k, v in found.items() if v} == {k: v for k, v in expected.items() if v}


def test_registered_query_equals_sql(spark):
    assert compare(spark, SF_SMALL, ["op13_divergence"], verbose=False)["op13_divergence"]["ok"]

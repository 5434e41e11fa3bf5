"""Ranked search against a full scan in plain Python."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from monthtide.llm import queries, ranked_search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, places=50):
    counted = [(d, Counter(words(t)), len(words(t))) for d, t in docs]
    n_docs, n_terms = sum(n > 0 for *_, n in counted), sum(n for *_, n in counted)
    found = []
    for item, text in {i for i in items if i[1] is not None}:
        asked, scores = set(words(text)), []
        weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * sum(t in c for _, c, _ in counted) + 1))) for t in asked}
        for d, c, n in counted:
            score = sum(weight[t] * ((10**9 * c[t]) // (1000 * c[t] + 20 * (50 + 50 * n * n_docs // n_terms))) for t in asked if t in c)
            if score > 0:
                scores.append((-score, d is None, d or 0, d))
        found += [(item, k + 1, d, -s) for k, (s, _, _, d) in enumerate(sorted(scores)[:places])]
    return sorted(found, key=str)


def got(spark, docs, items, **options):
    rows = ranked_search.search(
        spark.createDataFrame([(*d, 0.5, "x") for d in docs], "doc_id long, text string, norm double, terms string"),
        spark.createDataFrame([(*i, 7) for i in items], "item_id long, text string, rank int"),
        **options,
    )
    return sorted(map(tuple, rows.collect()), key=str)


def sample(rng, docs, items):
    vocabulary = [f"w{int(rng.paretovariate(0.7))}" for _ in range(4000)]
    made = [(k, " ".join(rng.choices(vocabulary, k=rng.choice([1, 5, 40, 300])))) for k in range(docs)]
    asked = [(k, " ".join(rng.choice(made)[1].split()[:20])) for k in range(items)]
    return made, asked


@pytest.mark.parametrize("bucket, share", [(4, 0.05), (64, 0.3), (2048, 1 / 16)])
def test_search_equals_a_full_scan(spark, monkeypatch, bucket, share):
    monkeypatch.setattr(ranked_search, "BUCKET", bucket)
    monkeypatch.setattr(ranked_search, "FIRST_SHARE", share)
    docs, items = sample(random.Random(bucket), 500, 12)
    assert got(spark, docs, items, places=10) == plain(docs, items, 10)


def test_odd_rows_ties_and_hot_copies(spark):
    docs = [(1, "Naïve CAFÉ x1"), (2, None), (3, ""), (4, " .,!\n"), (None, "alpha beta"), (None, "alpha beta"), (5, "中文 alpha ΑΒΓ"), (6, "x " * 50_000 + "alpha")]
    docs += [(100 + k, "alpha beta gamma") for k in range(300)] + [(7, "alpha beta gamma")] * 3 + [(2**40, "delta")]
    items = [(1, "alpha"), (2, None), (3, ""), (4, "nothing here"), (5, "naïve café"), (5, "naïve café"), (5, "delta"), (None, "中文 αβγ ΑΒΓ"), (6, "X1 beta gamma alpha alpha")]
    assert got(spark, docs, items) == plain(docs, items)
    assert got(spark, docs, items, places=400) == plain(docs, items, 400)


def test_empty_tables(spark):
    assert got(spark, [], [(1, "a")]) == [] and got(spark, [(1, "a")], []) == []
    assert got(spark, [(1, None)], [(1, "a")]) == []


def test_items_in_blocks(spark, monkeypatch):
    docs, items = sample(random.Random(9), 120, 9)
    monkeypatch.setattr(ranked_search, "QUERY_BYTES", 200)
    assert got(spark, docs, items, places=5) == plain(docs, items, 5)


def test_bounds_leave_work_out(monkeypatch):
    """Buckets and rows that can't have the score are not looked at, and none that can is left out."""
    rng = np.random.default_rng(3)
    weights = rng.integers(1, 9000, 40)
    bounds = np.cumsum([0, *rng.integers(1, 12, 300)])
    terms = np.concatenate([np.sort(rng.choice(40, b - a, replace=False)) for a, b in zip(bounds, bounds[1:])])
    impacts = rng.integers(1, 100_000, len(terms))
    norms = np.sqrt([((weights[terms[a:b]] * impacts[a:b]).astype(float) ** 2).sum() for a, b in zip(bounds, bounds[1:])])
    bucket = ranked_search.Bucket(np.arange(300), norms, bounds, terms, impacts, weights)
    asked = ranked_search.Queries({}, np.array([1, 5, 9, 30, 2, 3]), np.array([0, 4, 6]))
    weight, wanted = np.zeros(40, np.int64), asked.of_number(0)
    weight[wanted] = weights[wanted]
    scores = bucket.scores(np.arange(300), weight)
    for needed in np.sort(scores)[[150, 250, 290, 299]]:
        found = bucket.candidates(wanted, float(needed))
        assert set(np.flatnonzero((scores >= needed) & (scores > 0))) <= set(found)
        assert len(found) < 300 or needed <= 1
    assert bucket.open_queries(asked, np.array([1.0, 1.0])).tolist() == [0, 1]
    assert bucket.open_queries(asked, np.array([1e15, 1.0])).tolist() == [1]


def test_query_equals_a_full_scan(spark):
    folder = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    assert sorted(map(tuple, queries.op13_ranked_search(spark, folder).collect()), key=str) == plain(docs, items)

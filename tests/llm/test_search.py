"""MaxScore against brute force."""

from __future__ import annotations

from collections import Counter

import numpy as np

from quillsift.llm import topk


def brute(rows, every, k):
    ok = [
        (i, [int(np.floor(256 * x)) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = Counter()
    for own, (q, a) in enumerate(ok):
        if q % every == 0:
            scores = [
                (-sum(x * y for x, y in zip(a, b, strict=True)), i)
                for other, (i, b) in enumerate(ok)
                if other != own and len(a) == len(b)
            ]
            out.update((q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scores)[:k]))
    return out


def check(spark, rows, every=5, k=5):
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id LONG, embedding ARRAY<DOUBLE>, v STRING")
    got = Counter(tuple(r) for r in topk.search_embeddings(df, every, k).collect())
    assert got == brute(rows, every, k)


def test_ties_and_bad_vectors(spark, monkeypatch):
    random = np.random.default_rng(3)
    rows = [(i, random.normal(size=8).round(1).tolist()) for i in range(300)]
    rows += [(300 + i, rows[7][1]) for i in range(40)]
    rows += [(500, None), (501, [None] * 8), (505, [float("nan")] * 8), (510, [float("inf")] * 8)]
    rows += [(None, rows[0][1]), (515, []), (520, [1.0] * 3), (525, [2.0] * 3)]
    monkeypatch.setattr(topk, "SHARD_ROWS", 100)
    check(spark, rows)


def test_large_numbers_and_few_rows(spark):
    check(spark, [(0, [3e6, -3e6]), (5, [3e6, 3.0]), (6, [-3e6, 3e6])])
    check(spark, [(0, [1.0, 2.0])])
    check(spark, [(1, [1.0, 2.0])])


def test_repeated_ids_are_rows_of_their_own(spark, monkeypatch):
    """One id holds a third of all rows, and rows repeat as a whole."""
    random = np.random.default_rng(9)
    rows = [(5, random.normal(size=4).round(1).tolist()) for _ in range(40)]
    rows += [(i, random.normal(size=4).round(1).tolist()) for i in range(80)]
    rows += [rows[0], rows[0], rows[50]]
    monkeypatch.setattr(topk, "SHARD_ROWS", 30)
    check(spark, rows)


def test_empty_tables(spark):
    check(spark, [])
    check(spark, [(None, [1.0]), (5, None)])


def test_pruned_search_is_exact():
    random = np.random.default_rng(5)
    vectors = np.floor(random.normal(size=(3_000, 32)) * 100).astype(np.int64)
    shard = topk.Shard(np.arange(3_000), vectors)
    for q in range(0, 3_000, 300):
        ids, scores = shard.search(vectors[q], q, 5)
        best = np.lexsort((ids, -scores))[:5]
        exact = (vectors @ vectors[q]).astype(float)
        exact[q] = -np.inf
        want = np.lexsort((np.arange(3_000), -exact))[:5]
        assert ids[best].tolist() == want.tolist()
        assert len(ids) < 3_000

import math

import numpy as np
import pytest

from phrasemill.llm.fusion import fuse_scores, stationary


def brute(scores, damping=0.85):
    """The walk as a dense matrix."""
    n = len(scores[0])
    t = np.zeros((n, n))
    for s in scores:
        s = np.where(np.isnan(s), -np.inf, s)
        for i in range(n):
            to = np.ones(n) if s[i] == s.max() else (s >= s[i]).astype(float)
            t[i] += to / to.sum() / len(scores)
    x = np.ones(n) / n
    for _ in range(500):
        x = damping * x @ t + (1 - damping) / n
    return x


def cases():
    rng = np.random.default_rng(3)
    for n in (1, 2, 3, 8, 40):
        yield [rng.integers(0, max(2, n // 2), n).astype(float), rng.normal(size=n)]
    yield [np.array([1.0, np.nan, 3.0]), np.array([np.nan, np.nan, np.nan])]
    yield [np.zeros(5), np.zeros(5)]


def test_walk_equals_the_dense_matrix():
    all_cases = list(cases())
    group = np.concatenate([np.full(len(c[0]), i) for i, c in enumerate(all_cases)])
    got = stationary(group, [np.concatenate([c[k] for c in all_cases]) for k in (0, 1)])
    assert np.allclose(got, np.concatenate([brute(c) for c in all_cases]), atol=1e-10)


def test_balanced_item_wins_over_leaders_of_one_score(spark):
    rows = [(1, 0, 1.1, 0.78), (1, 1, 7.0, 0.74), (1, 2, 7.2, 0.31), (1, 3, 6.5, 0.36), (1, 4, 5.3, 0.41), (1, 5, 9.0, -0.5)]
    top = fuse_scores(spark.createDataFrame(rows, "g BIGINT, i BIGINT, a DOUBLE, b DOUBLE"), "g", "i", ["a", "b"]).filter("fused_rank = 1").collect()
    assert [r.i for r in top] == [1]


def test_range_of_a_score_does_not_matter(spark):
    rows = [(1, i, float(i * 7 % 5), float(i * 3 % 4)) for i in range(12)]
    big = [(g, i, a * 1e6 - 5, math.atan(b)) for g, i, a, b in rows]
    order = [[tuple(r) for r in fuse_scores(spark.createDataFrame(x, "g BIGINT, i BIGINT, a DOUBLE, b DOUBLE"), "g", "i", ["a", "b"]).select("i", "fused_rank").orderBy("i").collect()] for x in (rows, big)]
    assert order[0] == order[1]


def test_nulls_repeats_ties_and_extra_columns(spark):
    rows = [(1, 5, 2.0, None, "x"), (1, 5, 2.0, None, "x"), (1, 4, 2.0, float("nan"), "y"), (None, 4, 1.0, 1.0, "z"), (2, None, 1.0, 1.0, "z"), (3, 9, None, None, None)]
    df = spark.createDataFrame(rows, "g BIGINT, i BIGINT, a DOUBLE, b DOUBLE, fused_rank STRING")
    got = sorted((r.g, r.i, r.fused_rank) for r in fuse_scores(df, "g", "i", ["a", "b"]).collect())
    assert got == [(1, 4, 1), (1, 5, 2), (3, 9, 1)]
    assert fuse_scores(df.limit(0), "g", "i", ["a", "b"]).collect() == []


def test_large_groups_walk_as_tables_with_the_same_result(spark, monkeypatch):
    import phrasemill.llm.fusion as f

    monkeypatch.setattr(f, "_rounds", lambda damping, size: 6)  # the same number of steps either way
    rng = np.random.default_rng(5)
    rows = [(1, i, float(a), float(b)) for i, (a, b) in enumerate(zip(rng.integers(0, 9, 30), rng.normal(size=30)))] + [(2, i, float(i), None) for i in range(3)]
    df = spark.createDataFrame(rows, "g BIGINT, i BIGINT, a DOUBLE, b DOUBLE")
    stationary_6 = lambda *a: stationary(*a[:2], *a[2:], rounds=6)
    monkeypatch.setattr(f, "stationary", stationary_6)
    near = {(r.g, r.i): (r.stationarity, r.fused_rank) for r in fuse_scores(df, "g", "i", ["a", "b"]).collect()}
    far = {(r.g, r.i): (r.stationarity, r.fused_rank) for r in fuse_scores(df, "g", "i", ["a", "b"], most_items=10).collect()}
    assert near.keys() == far.keys()
    assert all(near[k][0] == pytest.approx(far[k][0], abs=1e-10) and near[k][1] == far[k][1] for k in near)

import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from phrasemill.llm import terms

LISTED = [(1, "cell"), (1, "cell"), (2, "cell"), (3, "rare one"), (4, " "), (5, None), (6, "null"), (7, "never"), (None, "ghost")]
MAPPING = [(1, 10), (1, 10), (2, 10), (2, 11), (3, 12), (3, 12), (3, 12), (4, 13), (5, 14), (6, 11), (8, 15), (1, None), (None, 10)]


def tables(spark):
    listed = spark.createDataFrame([(*r, 0, "x") for r in LISTED], "candidate_id BIGINT, candidate STRING, row_id BIGINT, term STRING")
    return spark.createDataFrame([(*r, 1, "y") for r in MAPPING], "candidate_id BIGINT, row_id BIGINT, tf BIGINT, candidate STRING"), listed


def test_scores_count_over_all_ids_of_a_string(spark):
    mapping, listed = tables(spark)
    got = {(r.row_id, r.candidate_id): r for r in terms.score_terms(mapping, listed).collect()}
    assert {k: (r.tf, r.df, r.n_docs) for k, r in got.items()} == {(10, 1): (2, 2, 3), (10, 2): (1, 2, 3), (11, 2): (1, 2, 3), (12, 3): (3, 1, 3), (11, 6): (1, 1, 3)}
    assert got[12, 3].tfidf == pytest.approx(3 * (math.log(4 / 2) + 1))
    assert all(0 <= r.elite_prob <= 1 for r in got.values())


def test_wrong_scores(spark):
    mapping, listed = tables(spark)
    right = 2 * (math.log(4 / 3) + 1)
    rows = [(10, 1, right), (10, 1, right), (10, 2, 9.0), (11, 2, None), (12, 3, float("nan")), (11, 6, math.log(2) + 1.0005), (77, 7, 0.0), (77, 3, 0.5), (None, 1, 1.0)]
    ranked = spark.createDataFrame([(*r, 5) for r in rows], "row_id BIGINT, candidate_id BIGINT, tfidf_score DOUBLE, tfidf BIGINT")
    assert {tuple(r) for r in terms.wrong_scores(ranked, mapping, listed).collect()} == {(10, 2), (11, 2), (12, 3), (77, 3), (None, 1)}
    assert {tuple(r) for r in terms.wrong_scores(ranked, mapping.limit(0), listed).collect()} >= {(10, 1), (10, 2)}
    assert terms.wrong_scores(ranked.limit(0), mapping, listed).collect() == []


N = 2000
HISTOGRAMS = [
    ([1, 2], [50, 3]),  # rare, hardly bursty
    ([1, 2, 9], [30, 10, 4]),
    ([1, 3, 4, 12], [2, 2, 2, 1]),
    ([1, 2, 3, 4, 5, 6, 7, 8], [200, 60, 30, 25, 30, 20, 12, 5]),
    ([1, 2, 3], [400, 130, 43]),
    ([1], [5]),  # no two kinds of records
    ([1, 2, 3], [900, 60, 5]),
    ([1, 2], [1990, 10]),  # in every record
    ([40], [1]),
]


def fit(histograms, total=N, **kw):
    lens = [len(a) for a, _ in histograms]
    k, n = (np.concatenate([h[i] for h in histograms]) for i in (0, 1))
    return terms.fit_two_poisson(np.repeat(np.arange(len(lens)), lens), k, n, total, **kw)


def likelihood(k, n, share, high, low):
    f = share * np.exp(-high) * high**k + (1 - share) * np.exp(-low) * low**k
    return (n * np.log(f)).sum()


def second_fit(k, n, total):
    """One term at a time, by plain EM from many starts: the likeliest end."""
    k, n = np.array([*k, 0.0]), np.array([*n, total - sum(n)], dtype=float)
    df, occ, ends = n[:-1].sum(), (n * k).sum(), []
    for m in (0.8, 1.2, 2.0, 4.0):
        for s in (0.02, 0.3, 0.9):
            high, low, share = occ / df * m, 0.2 * occ / total, s * df / total
            for _ in range(30_000):
                a, b = share * high**k * np.exp(-high), (1 - share) * low**k * np.exp(-low)
                r = a / (a + b)
                new = (n * r).sum() / total, (n * r * k).sum() / (n * r).sum(), (n * (1 - r) * k).sum() / (n * (1 - r)).sum()
                still = max(abs(x - y) for x, y in zip(new, (share, high, low)))
                share, high, low = new
                if still < 1e-14:
                    break
            ends.append((likelihood(k, n, share, high, low), share, high, low) if high >= low else (likelihood(k, n, share, high, low), 1 - share, low, high))
    return max(ends)


def test_mixture_equals_a_second_fitter():
    share, high, low, converged = fit(HISTOGRAMS)
    assert converged.all()
    k = np.arange(1, 13.0)
    for i, (a, b) in enumerate(HISTOGRAMS[:5]):
        best, s, h, lo = second_fit(a, b, N)
        cells = np.array([*a, 0.0]), np.array([*b, N - sum(b)], dtype=float)
        assert likelihood(*cells, share[i], high[i], low[i]) >= best - 1e-7
        assert terms.elite_posterior(k, share[i], high[i], low[i]) == pytest.approx(terms.elite_posterior(k, s, h, lo), abs=1e-4)


def test_more_steps_change_nothing():
    k = np.arange(1, 10.0)
    one, more = fit(HISTOGRAMS), fit(HISTOGRAMS, steps=50_000)
    for i in range(len(HISTOGRAMS)):
        assert terms.elite_posterior(k, *(x[i] for x in one[:3])) == pytest.approx(terms.elite_posterior(k, *(x[i] for x in more[:3])), abs=1e-6)
    assert not fit(HISTOGRAMS, steps=1)[3][:5].any()  # reported, not passed over


def test_terms_without_two_kinds_of_records_have_a_defined_model():
    share, high, low, _ = fit(HISTOGRAMS[5:8])
    assert low.tolist() == [0, 0, 0] and (terms.elite_posterior(np.array([1.0, 2.0]), share[0], high[0], low[0]) == 1).all()


def test_common_terms_count_less_than_rare_ones(spark):
    """At equal occurrences the score falls as the share of documents rises, whether or not counts vary much."""
    rows, listed = [], []
    for i, docs in enumerate((4, 40, 400, 1400)):
        listed.append((i, f"term {i}"))
        rows += [(i, d) for d in range(docs)] + [(i, d) for d in range(docs // 4)]
    frame = spark.createDataFrame(rows + [(9, d) for d in range(1500)], "candidate_id BIGINT, row_id BIGINT")
    got = terms.score_terms(frame, spark.createDataFrame([*listed, (9, "all")], "candidate_id BIGINT, candidate STRING")).collect()
    for tf in (1, 2):
        scores = [{r.distinctiveness for r in got if r.candidate_id == i and r.tf == tf} for i in range(4)]
        assert all(len(s) == 1 for s in scores)
        flat = [s.pop() for s in scores]
        assert flat == sorted(flat, reverse=True), flat
    assert all(r.converged for r in got)


def test_bursty_term_is_elite_where_it_is_frequent():
    rng = np.random.default_rng(1)
    counts = np.concatenate([rng.poisson(0.2, 900), rng.poisson(6, 100)])
    k, n = np.unique(counts[counts > 0], return_counts=True)
    share, high, low = (x[0] for x in fit([(k, n)], 1000)[:3])
    assert share == pytest.approx(0.1, abs=0.02) and high == pytest.approx(6, abs=0.6) and low == pytest.approx(0.2, abs=0.05)


def test_fit_of_many_terms_converges():
    rng = np.random.default_rng(8)
    histograms = []
    while len(histograms) < 400:
        counts = rng.poisson(rng.choice([0.01, 0.3, 2, 9], size=N, p=rng.dirichlet([2, 1, 0.3, 0.1])))
        if counts.any():
            histograms.append(np.unique(counts[counts > 0], return_counts=True))
    share, high, low, converged = fit(histograms)
    assert converged.mean() > 0.99 and np.isfinite([share, high, low]).all() and (high > low).all()


def test_run_lengths_over_batches():
    rows = sorted([("a", 1)] * 5 + [("a", 2)] * 3 + [("b", 2)] + [("c", i) for i in range(6)])
    rows = [(None, 1), (None, 1), (None, 2), *rows, ("d", None)]
    for size in (1, 2, 3, 7, 50):
        batches = [pa.RecordBatch.from_arrays([pa.array([t for t, _ in rows[i : i + size]], pa.string()), pa.array([r for _, r in rows[i : i + size]], pa.int64())], ["t", "r"]) for i in range(0, len(rows), size)]
        got = Counter()
        for b in terms._runs("t", "r")(iter(batches)):
            for t, tf, df in zip(*(c.to_pylist() for c in b.columns)):
                got[t, "tf"] += tf
                got[t, "df"] += df
        assert {k: got[k, "df"] for k in (None, "a", "b", "c", "d")} == {None: 2, "a": 2, "b": 1, "c": 6, "d": 0}
        assert {k: got[k, "tf"] for k in (None, "a", "b", "c", "d")} == {None: 3, "a": 8, "b": 1, "c": 6, "d": 1}


def test_frequencies_of_a_hot_term(spark):
    rows = [("hot" if i % 3 == 0 else f"t{i % 50}", i % 211) for i in range(4000)] + [(None, 1), ("x", None)]
    want = defaultdict(set)
    for t, r in rows:
        want[t] |= {r} - {None}
    got = {r.term: (r.tf, r.df) for r in terms.term_frequencies(spark.createDataFrame(rows, "t STRING, r BIGINT").repartition(5), "t", "r").collect()}
    assert got == {t: (n, len(want[t])) for t, n in Counter(t for t, _ in rows).items()}
    assert terms.term_frequencies(spark.createDataFrame([], "t STRING, r BIGINT"), "t", "r").collect() == []


def test_marks(spark):
    listed = spark.createDataFrame([(1, "common"), (2, "middle"), (3, "rare"), (4, "never"), (5, "Never"), (6, "")], "candidate_id BIGINT, candidate STRING")
    mapping = spark.createDataFrame([(1, i) for i in range(100)] + [(2, i) for i in range(5)] + [(3, 1), (3, 1), (3, 2)], "candidate_id BIGINT, row_id BIGINT")
    got = {r.candidate: (r.tf, r.df, r.mark) for r in terms.candidate_frequencies(mapping, listed).collect()}
    assert got == {"common": (100, 100, "common"), "middle": (5, 5, None), "rare": (3, 2, "rare"), "never": (0, 0, "rare"), "Never": (0, 0, "rare")}
    empty = {r.candidate: r.mark for r in terms.candidate_frequencies(mapping.limit(0), listed).collect()}
    assert set(empty.values()) == {"rare"} and len(empty) == 5

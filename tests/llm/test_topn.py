import math
import os
import random

import pytest

from phrasemill.llm import topn

SCHEMA = "row_id BIGINT, candidate_id BIGINT, tfidf_score DOUBLE, semantic_score FLOAT, g STRING, position INT"


def brute(rows, n=3):
    best = {}
    for r, c, s, t, *_ in {x[:4] for x in rows}:
        if None not in (r, c, s) and not math.isnan(s):
            t = -math.inf if t is None or math.isnan(t) else t
            best.setdefault(r, set()).add((-s, -t, c))
    return sorted((r, k[2]) for r, v in best.items() for k in sorted(v)[:n])


def rows():
    rng = random.Random(8)
    out = [(7 if i % 3 == 0 else rng.randrange(60), i % 900, float(rng.randrange(25)), rng.choice([0.5, 0.25, None, 0.75]), "x", 1) for i in range(3000)]
    out += [(1, 1, None, 0.5, "x", 1), (1, 2, float("nan"), 0.5, "x", 1), (None, 1, 9.0, 0.5, "x", 1), (1, None, 9.0, 0.5, "x", 1), (500, 3, 0.0, None, "x", 1)]
    return out + out[:100]


def found(df):
    return sorted((r.row_id, r.candidate_id) for r in df.collect())


def test_best_of_every_group_with_ties_repeats_and_a_hot_group(spark):
    df = spark.createDataFrame(rows(), SCHEMA).repartition(4)
    assert found(topn.best_candidates(df)) == brute(rows())
    one = topn.best_candidates(df, n=1)
    assert found(one) == brute(rows(), 1)
    assert topn.best_candidates(df.limit(0)).collect() == []


def test_nan_second_score_is_lowest(spark):
    data = [(1, 1, 5.0, float("nan"), "", 0), (1, 2, 5.0, None, "", 0), (1, 3, 5.0, -1.0, "", 0), (1, 0, 4.0, 9.0, "", 0)]
    got = topn.best_candidates(spark.createDataFrame(data, SCHEMA)).orderBy("position").collect()
    assert [r.candidate_id for r in got] == [3, 1, 2]


def read(spark, data, n, **kw):
    files = topn.write_clustered(spark.createDataFrame(data, SCHEMA).repartition(4), "row_id", "tfidf_score", "semantic_score", "candidate_id", n, **kw)
    best = topn.read_best(files, n)
    return sorted((r.g, r.i) for r in topn.top_n(best, n).collect()), topn.row_groups_read(best).first()


def test_groups_larger_than_a_section_are_cut_and_skipped(spark):
    data = [(7, i, float(i), 0.0, "", 0) for i in range(20_000)] + [(8, 1, 1.0, 0.0, "", 0)]
    got, (n_read, every) = read(spark, data + data[-500:], 3, section_rows=1000, row_group_rows=250)
    assert got == [(7, 19_997), (7, 19_998), (7, 19_999), (8, 1)]
    assert every > 60 and n_read <= 4


def test_ties_at_the_cut_are_read(spark):
    data = [(7, i, 1.0, float(i), "", 0) for i in range(5_000)]
    got, (n_read, every) = read(spark, data, 2, section_rows=1000, row_group_rows=250)
    assert got == [(7, 4_998), (7, 4_999)] and n_read == every == 20


def test_repeats_do_not_fill_up_a_group(spark):
    data = [(7, 1, 9.0, 0.0, "", 0)] * 4000 + [(7, i, 1.0, 0.0, "", 0) for i in range(2, 4000)]
    assert read(spark, data, 3, section_rows=1000, row_group_rows=250)[0] == [(7, 1), (7, 2), (7, 3)]


def test_most_row_groups_of_small_groups_are_not_read(spark):
    """Groups of about ten rows, hundreds to a row group: three of ten rows are the result."""
    rng = random.Random(2)
    data = [(g, i, rng.gauss(g % 17, 3), 0.0, "", 0) for g in range(4000) for i in range(rng.randrange(7, 15))]
    got, (n_read, every) = read(spark, data, 3, section_rows=2000, row_group_rows=200)
    assert got == brute(data) and n_read < 0.5 * every
    few, (n_read, every) = read(spark, data, 1, section_rows=2000, row_group_rows=200)
    assert few == brute(data, 1) and n_read < 0.35 * every


@pytest.mark.parametrize("sf", ["sf0.1", "check_l"])
def test_most_row_groups_of_the_test_tables_are_not_read(spark, sf):
    path = f"/root/testdata/{sf}/ranked_candidates.parquet"
    if not os.path.exists(path):
        pytest.skip("no test tables")
    files = topn.write_clustered(spark.read.parquet(path), "row_id", "tfidf_score", "semantic_score", "candidate_id")
    n_read, every = topn.row_groups_read(topn.read_best(files, 3)).first()
    assert every >= 20 and n_read < 0.5 * every

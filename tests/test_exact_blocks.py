"""Blocks beyond the cap of the blocked operator."""

import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as entry
from phrasemill.operators import cluster, components
from phrasemill.operators.tiles import forest


def found(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def blocks(spark):
    rng = np.random.default_rng(4)
    m = rng.normal(size=(47, 4))
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    rows = [(i, "hot" if i < 40 else "b" if i < 46 else None, m[i].tolist()) for i in range(47)]
    want = sorted((i, j) for i in range(47) for j in range(i + 1, 47) if rows[i][1] == rows[j][1] is not None and round(float(m[i] @ m[j]), 9) >= 0.6)
    return spark.createDataFrame(rows, "ord BIGINT, block STRING, vec ARRAY<DOUBLE>"), want


def test_oversize_blocks_keep_their_edges(spark):
    v, want = blocks(spark)
    assert found(cluster.similarity_edges(v, 0.6, max_block_size=7), "u", "v") != want
    for tile in (7, 40, 1000):
        assert found(cluster.exact_similarity_edges(v, 0.6, tile), "u", "v") == want


def test_spanning_edges_are_edges_and_give_the_same_components(spark):
    v, want = blocks(spark)
    got = cluster.exact_similarity_edges(v, 0.6, 7, spanning=True)
    pairs = found(got, "u", "v")
    assert set(pairs) < set(want)
    sim = {(r.u, r.v): r.similarity for r in cluster.exact_similarity_edges(v, 0.6, 7).collect()}
    assert all(sim[r.u, r.v] == r.similarity for r in got.collect())
    both = [found(components.star_components(spark.createDataFrame(e, "u BIGINT, v BIGINT")), "node", "root") for e in (pairs, want)]
    assert both[0] == both[1]
    assert [x.tolist() for x in forest(np.zeros((0, 0), dtype=bool))] == [[], []]


def test_clusters_do_not_depend_on_the_size_of_a_block(spark):
    words = [f"solid cell {c * 6}" for c in "abcdefgh"] + ["solid porous electrode", "solid porous electroder"]
    listed = spark.createDataFrame(list(enumerate(words)), "candidate_id BIGINT, candidate STRING")
    small = {r.candidate: r.cluster_id for r in cluster.cluster_candidates(listed, 0.9, 9).collect()}
    whole = {r.candidate: r.cluster_id for r in cluster.cluster_candidates(listed, 0.9, None).collect()}
    assert small[words[-1]] != small[words[-2]] and whole[words[-1]] == whole[words[-2]]
    sizes = cluster.skipped_blocks(listed.withColumn("block", F.lit("solid")), 9)
    assert found(sizes, "n_blocks", "n_rows") == [(1, 10)]
    assert found(cluster.skipped_blocks(listed.withColumn("block", F.lit("solid")), 10), "n_blocks", "n_rows") == [(0, 0)]


def test_exact_queries_have_uncapped_sql():
    sql = entry.oracle_sql()
    for name in ("q_candidate_edges_exact", "q_similarity_edges_exact", "q_components_exact", "q_cluster_exact"):
        assert name in entry.queries() and "AND 2000)" not in sql[name] and f"AND {1 << 62})" in sql[name]

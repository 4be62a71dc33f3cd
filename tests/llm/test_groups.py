import random

import numpy as np
import pytest

import phrasemill.llm.groups as groups
from phrasemill.operators import unionfind


def brute(edges):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = sorted((find(a), find(b)))
            up[y] = x
    return {x: find(x) for x in list(up)}


def edges():
    rng = random.Random(4)
    e = [(i + 1, i) for i in range(400)]  # a long thin chain
    e += [(1000, 1000 + i) for i in range(1, 300)]  # a hub
    e += [(rng.randrange(2000, 2400), rng.randrange(2000, 2400)) for _ in range(250)]
    e += [(5, 5), (None, 7), (8, None), (3000, 3001), (3001, 3000), (3000, 3001)]
    rng.shuffle(e)
    return e


@pytest.mark.parametrize("limit", [4_000_000, 900, 60])
def test_groups_at_every_bound(spark, limit):
    """One bounded merge, one level of contraction, and several levels."""
    df = spark.createDataFrame(edges(), "a BIGINT, b BIGINT").repartition(6)
    got = {r.node: r.root for r in groups.group_matches(df, merge_edges=limit, fan_in=2).collect()}
    assert got == brute(edges())


def test_large_sparse_graph_beyond_the_bound(spark):
    """Paths, a hub and a random graph of 400,000 edges against a bound of 40,000, by sizes of the components."""
    path = spark.range(150_000).selectExpr("id * 7919 % 1000003 as a", "(id + 1) * 7919 % 1000003 as b")
    hub = spark.range(1, 50_000).selectExpr("2000000L as a", "2000000 + id as b")
    loose = spark.range(200_000).selectExpr("3000000 + xxhash64(id) % 300000 as a", "3000000 + xxhash64(id, 1) % 300000 as b")
    df = path.union(hub).union(loose)
    sizes = lambda t: sorted((r["root"], r["count"]) for r in t.groupBy("root").count().collect())
    rows = df.toPandas()
    node, root = unionfind.stars(rows["a"].to_numpy(), rows["b"].to_numpy())
    every, n = np.unique(np.concatenate([root, np.unique(root)]), return_counts=True)
    assert sizes(groups.group_matches(df.repartition(12), merge_edges=40_000)) == list(zip(every.tolist(), n.tolist()))


def test_one_row_for_each_node_and_empty(spark):
    df = spark.createDataFrame(edges(), "a BIGINT, b BIGINT").repartition(3)
    out = groups.group_matches(df)
    assert out.count() == out.select("node").distinct().count()
    assert groups.group_matches(df.limit(0)).collect() == []


def test_which_matches_link(spark):
    nan = float("nan")
    rows = [(1, 2, "lemma", None), (2, 1, "lemma", nan), (2, 3, "semantic", 0.92), (3, 4, "semantic", 0.9199), (4, 5, "semantic", None), (5, 6, "semantic", nan), (6, 6, "lemma", 1.0),
            (6, 99, "lemma", 1.0), (None, 1, "lemma", 1.0), (7, 8, None, 0.95), (8, 9, None, None)]
    m = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "candidate_id_a BIGINT, candidate_id_b BIGINT, match_kind STRING, score DOUBLE, candidate_id BIGINT")
    listed = spark.createDataFrame([(i, "x") for i in [*range(1, 10), 1, None]], "candidate_id BIGINT, candidate STRING")
    got = {r.node: r.root for r in groups.group_matches(groups.valid_matches(m, listed)).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 7: 7, 8: 7}

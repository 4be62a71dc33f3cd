from collections import Counter, defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from phrasemill.operators import balanced
from phrasemill.operators.balanced import dense_ids, distinct_counts, running_counts, running_sums
from phrasemill.operators.coverage import cluster_documents, wrong_doc_counts


def skewed(n=3000):
    """One key holds a third of the rows, and values repeat."""
    rows = [(1 if i % 3 == 0 else i % 17, i * 7 % 400) for i in range(n)]
    return rows + [(None, 5), (None, 5), (2, None), (3, None)]


def test_distinct_counts_of_a_hot_key(spark):
    rows = skewed()
    want = defaultdict(set)
    for k, v in rows:
        want[k] |= {v} - {None}
    got = {r.k: (r.n_rows, r.n_distinct) for r in distinct_counts(spark.createDataFrame(rows, "k BIGINT, v BIGINT").repartition(5), "k", "v").collect()}
    assert got == {k: (n, len(want[k])) for k, n in Counter(k for k, _ in rows).items()}


def test_hot_key_is_split_over_partitions(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(skewed(), "k BIGINT, v BIGINT").repartition(4)
    parts = df.repartitionByRange(4, F.col("k"), F.col("v")).filter("k = 1").select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts > 1


def test_running_counts_over_boundaries(spark):
    rows = skewed(900)
    got = sorted(((r.k is not None, r.k or 0, r.ordinal), r.v, r.n_rows) for r in running_counts(spark.createDataFrame(rows, "k BIGINT, v BIGINT").repartition(4), "k", "v").collect())
    pairs = Counter(rows)
    want = []
    for k in {k for k, _ in rows}:
        vs = sorted({v for x, v in rows if x == k}, key=lambda v: (v is not None, v or 0))
        want += [((k is not None, k or 0, i + 1), v, pairs[k, v]) for i, v in enumerate(vs)]
    assert got == sorted(want, key=lambda x: x[0])


def test_running_sums_with_nulls(spark):
    rows = [(1, i, None if i % 5 == 0 else float(i)) for i in range(50)] + [(2, 1, 4.0)]
    got = {(r.k, r.o): r.s for r in running_sums(spark.createDataFrame(rows, "k BIGINT, o BIGINT, x DOUBLE").repartition(4), "k", ["o"], "x", "s").collect()}
    total = 0
    for k, o, x in rows[:-1]:
        total += x or 0
        assert got[k, o] == total
    assert got[2, 1] == 4.0


def test_dense_ids_are_gapless_and_ordered(spark):
    df = spark.createDataFrame([(i * 37 % 211, "x") for i in range(211)], "a BIGINT, b STRING").repartition(5)
    got = sorted((r.i, r.a) for r in dense_ids(df, ["a"], "i", start=1).collect())
    assert got == [(i + 1, i) for i in range(211)]
    assert dense_ids(df.limit(0), ["a"], "i").collect() == []


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.one_of(st.none(), st.integers(0, 5))), max_size=40), parts=st.integers(1, 4))
def test_distinct_counts_equal_brute_force(spark, rows, parts):
    got = {r.k: (r.n_rows, r.n_distinct) for r in distinct_counts(spark.createDataFrame(rows, "k BIGINT, v BIGINT").repartition(parts), "k", "v").collect()}
    assert got == {k: (sum(x == k for x, _ in rows), len({v for x, v in rows if x == k and v is not None})) for k in {k for k, _ in rows}}


def test_wrong_doc_counts(spark):
    clusters = spark.createDataFrame([(1, 10), (1, 10), (2, 10), (2, 20), (None, 20), (3, None), (4, 30)], "candidate_id BIGINT, cluster_id BIGINT")
    mapping = spark.createDataFrame([(1, 100, "a"), (1, 100, "b"), (2, 100, "c"), (2, 101, None), (2, None, "x"), (9, 5, "y")], "candidate_id BIGINT, row_id BIGINT, cluster_id STRING")
    assert sorted(tuple(r) for r in cluster_documents(mapping, clusters).collect()) == [(10, 2), (20, 2)]
    stated = spark.createDataFrame([(10, 2), (10, 2), (20, 3), (30, 0), (40, None), (50, 1), (None, 7)], "cluster_id BIGINT, doc_count BIGINT")
    assert sorted(r.cluster_id for r in wrong_doc_counts(stated, mapping, clusters).collect()) == [20, 40, 50]
    assert wrong_doc_counts(stated.limit(0), mapping, clusters).collect() == []
    assert sorted(r.cluster_id for r in wrong_doc_counts(stated, mapping.limit(0), clusters).collect()) == [10, 20, 40, 50]


def test_spread_join_equals_a_join_and_cuts_hot_keys(spark):
    rows = [(1 if i % 3 == 0 else None if i % 50 == 1 else i % 70, i) for i in range(40_000)]
    big = spark.createDataFrame(rows, "k BIGINT, v BIGINT").repartition(3)
    small = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (99, "d"), (None, "e")], "k BIGINT, name STRING")
    out = balanced.spread_join(big, small, "k", "v")
    assert out.columns == ["k", "v", "name"]
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, big.join(small, "k").collect()))
    assert sorted(map(tuple, balanced.spread_join(big, small, "k", "v", how="left_semi").collect())) == sorted(map(tuple, big.join(small, "k", "left_semi").collect()))
    assert "_part" in balanced.spread_join(big, small, "k", "v")._jdf.queryExecution().toString()
    assert balanced.spread_join(big.limit(0), small, "k", "v").collect() == []
    assert balanced.heavy_keys(big, "k").keys() == {1} and balanced.heavy_keys(big.limit(500), "k") == {}  # few rows are no burden

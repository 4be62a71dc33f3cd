"""Links that buckets of many members, and splits of loose components, must not lose."""

import numpy as np
import pyarrow as pa
import pytest

from phrasemill.llm import similarity as S


def at(degrees):
    v = np.zeros(64)
    v[0], v[1] = np.cos(np.deg2rad(degrees)), np.sin(np.deg2rad(degrees))
    return [float(x) for x in v]


@pytest.fixture
def one_bucket(monkeypatch):
    """Every vector falls into one bucket."""

    def entries(dim, plan, parts, kind, hot):
        def run(batches):
            for b in batches:
                ids = b.column("id").to_numpy().astype(kind)
                if len(ids):
                    yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([bytes(4 * len(ids))]), pa.array([ids.tobytes()])], ["pid", "keys", "ids"])

        return run

    monkeypatch.setattr(S, "_entries", entries)


def clusters(spark, angles):
    df = spark.createDataFrame([(i, at(a)) for i, a in enumerate(angles)], "id BIGINT, vec ARRAY<FLOAT>")
    return {r.id: (r.cluster_id, r.cluster_size, r.typical_id) for r in S.similarity_clusters(df).collect()}


def test_components_are_compared_by_all_their_members(spark, one_bucket):
    """5 is near 4 alone: neither the bucket's least id nor the least of a component shows it."""
    vectors = spark.createDataFrame([(i, at(a)) for i, a in enumerate([0, 5, 10, 15, 20, 41, 90])], "id BIGINT, vec ARRAY<FLOAT>")
    sets = S.describe(vectors, 64)
    names, sample = S.draw(sets, vectors, 64)
    links = S.similar_links(vectors, sets.select("id", "s", "e"), names, sample, 7, 0.92).collect()
    near = np.eye(7, dtype=bool)
    for r in links:
        near[r.u, r.v] = near[r.v, r.u] = True
    assert S._components(near).tolist() == [0] * 6 + [6]


def test_leftovers_of_a_split_keep_their_links(spark, one_bucket):
    """6 and 7 were linked only through 0, which stays with the others."""
    angles = [0, -20, -20.2, -20.4, -20.6, -20.8, 20, 21, -42, -42.2, -42.4]
    got = clusters(spark, angles)
    assert {i for i in got if got[i][0] == 6} == {6, 7} and got[6] == got[7] == (6, 2, 6)
    assert {i for i in got if got[i][0] == 0} == {0, 1, 2, 3, 4, 5, 8, 9, 10}


def test_split_around_the_member_with_most_neighbours(spark):
    """Two cores of six and a bridge of two: the bridge has the largest sums of cosines, but fewer neighbours."""
    core = [30, 30.1, 30.2, 44, 44.1, 44.2]
    got = clusters(spark, [-a for a in core] + [-8] + core + [8])
    assert {i for i in got if got[i][0] == 0} == {0, 1, 2, 3, 4, 5, 6}
    assert {i for i in got if got[i][0] == 7} == {7, 8, 9, 10, 11, 12, 13}

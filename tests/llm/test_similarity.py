import numpy as np
import pyarrow as pa
import pytest

from phrasemill.llm import similarity as S


def family(rng, size, cos=0.95, dim=64):
    base = rng.normal(size=dim)
    base /= np.linalg.norm(base)
    out = []
    for _ in range(size):
        e = rng.normal(size=dim)
        e -= e @ base * base
        e /= np.linalg.norm(e)
        a = np.sqrt(cos)
        out.append((a * base + np.sqrt(1 - a * a) * e).astype(np.float32))
    return out


def brute(vectors, threshold=0.92):
    """Clusters of two or more by all pairs, for data in which clusters are mutually similar."""
    ids = sorted(vectors)
    x = np.array([vectors[i] for i in ids], dtype=float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    c = x @ x.T
    out = {}
    for a, i in enumerate(ids):
        near = [b for b in range(len(ids)) if c[a, b] >= threshold]
        if len(near) > 1:
            s = {ids[b]: round(sum(c[b, k] for k in near if k != b), 4) for b in near}
            out[i] = (min(s), len(near), min(s, key=lambda j: (-s[j], j)))
    return out


def clusters(spark, rows, **kw):
    df = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "m", 7) for i, v in rows], "id BIGINT, vec ARRAY<FLOAT>, model STRING, weight BIGINT")
    return {r.id: (r.cluster_id, r.cluster_size, r.typical_id) for r in S.similarity_clusters(df.repartition(3), **kw).collect()}


def test_clusters_copies_and_unusable_vectors(spark):
    rng = np.random.default_rng(2)
    vectors, n = {}, 0
    for size in (2, 3, 5, 1, 1, 30, 2):
        for v in family(rng, size):
            vectors[n] = v
            n += 1
    for i in range(20):  # exact copies of one vector under other ids, and of a lonely one
        vectors[100 + i] = vectors[0]
    vectors[200] = vectors[10]
    bad = [(900, None), (901, [0.0] * 64), (902, [1.0] * 10), (903, [float("nan")] + [1.0] * 63), (904, [None] + [1.0] * 63), (905, [])]
    rows = list(vectors.items()) + list(vectors.items())[:7] + bad
    assert clusters(spark, rows) == brute(vectors)


def test_components_beyond_a_tile_come_out_the_same(spark):
    rng = np.random.default_rng(7)
    vectors = dict(enumerate(v for size in (60, 40, 3, 2) for v in family(rng, size, 0.97)))
    vectors |= {1000 + k: v for k, v in vectors.items() if k % 9 == 0}  # copies
    for tile in (10, 2000):
        assert clusters(spark, list(vectors.items()), tile=tile) == brute(vectors)


def test_hot_bucket_is_linked_where_it_is_made(spark):
    """A third of all vectors lies within one bucket of most bands; with extra columns of clashing names."""
    rng = np.random.default_rng(4)
    dense = family(rng, 150, 0.999)
    vectors = dict(enumerate([*dense, *(v for _ in range(300) for v in family(rng, 1))]))
    assert clusters(spark, list(vectors.items())) == brute(vectors)


def test_ids_beyond_32_bits_below_zero_and_with_several_vectors(spark):
    rng = np.random.default_rng(5)
    vectors = dict(zip((-5, -(1 << 40), 3, 1 << 50), family(rng, 4)))
    assert clusters(spark, list(vectors.items())) == brute(vectors)
    got = clusters(spark, [(1, family(rng, 1)[0]), (1, family(rng, 1)[0]), (2, family(rng, 1)[0])])
    assert got == {}


def test_loose_chain_is_split_around_medoids(spark):
    turn = np.deg2rad(20)  # neighbours at cosine 0.94, second neighbours at 0.77
    rows = []
    for i in range(5):
        v = np.zeros(64)
        v[0], v[1] = np.cos(i * turn), np.sin(i * turn)
        rows.append((i, v))
    got = clusters(spark, rows)
    assert got == {1: (1, 3, 2), 2: (1, 3, 2), 3: (1, 3, 2)}


def test_empty(spark):
    assert clusters(spark, []) == {}


def unit(rng, n, dim=64):
    x = rng.normal(size=(n, dim))
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def pairs_at(rng, n, cosine):
    a = unit(rng, n).astype(float)
    e = rng.normal(size=a.shape)
    e -= (e * a).sum(1, keepdims=True) * a
    e /= np.linalg.norm(e, axis=1, keepdims=True)
    return a.astype(np.float32), (cosine * a + np.sqrt(1 - cosine**2) * e).astype(np.float32)


@pytest.mark.parametrize("n", [1_000, 100_000, 10_000_000])
def test_recall_at_the_threshold(n):
    """Bands chosen for any number of vectors find pairs at the threshold, and no such pair falls to the Jaccard check."""
    rng = np.random.default_rng(9)
    plan = S.choose_bands(unit(rng, 2000), n, 0.92)
    a, b = pairs_at(rng, 4000, 0.92)
    (ea, sa), (eb, sb) = S.elements(a), S.elements(b)
    assert (S.band_keys(a, plan) == S.band_keys(b, plan)).any(1).mean() > 0.99
    assert S._jaccard(ea, eb, sa, sb).min() >= S.least_jaccard(64, 0.92)


def test_pairs_of_each_vector_do_not_grow_with_the_number_of_vectors():
    rng = np.random.default_rng(3)
    per_vector = []
    for n in (8_000, 32_000, 128_000):
        x = unit(rng, n)
        plan = S.choose_bands(x[:2000], n, 0.92)
        keys = np.concatenate([S.band_keys(x[i : i + 4000], plan) for i in range(0, n, 4000)])
        counts = np.unique(keys.ravel(), return_counts=True)[1]  # over all bands: equal keys of two bands would count as well
        pairs = (counts * (counts - 1) // 2).sum()
        per_vector.append(pairs / n)
        assert pairs / n == pytest.approx(plan.pairs, rel=0.1)
    assert max(per_vector) < 1.5 * min(per_vector), per_vector


def test_buckets_cut_over_batches_are_whole():
    """Packed entries of any batching give the same pairs and the same members of large buckets."""
    rng = np.random.default_rng(1)
    plan, x = S.Bands(1, 0, 2, 0, 0.0), unit(rng, 200, 4)
    seen = []
    for size in (200, 33, 5):
        table = pa.table({"id": np.arange(200), "vec": S._lists(x)})
        packed = list(S._entries(4, plan, 1, "<i8", np.zeros(0, np.uint64))(iter(table.to_batches(max_chunksize=size))))
        out = pa.Table.from_batches(list(S._bucket_pairs("<i8")(iter(packed)))).to_pandas()
        seen.append((set(map(tuple, out[out.v.notna()][["u", "v"]].astype(int).values)), set(map(tuple, out[out.v.isna()][["u", "key"]].astype(int).values))))
    assert seen[0] == seen[1] == seen[2] and len(seen[0][1]) > 300

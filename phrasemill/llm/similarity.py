"""Problem 5: similarity clusters. MinHash banding, exact Jaccard, components, exact cosine, split around medoids.

A vector becomes a set: for each random rotation the signed axes nearest to the rotated vector, and the side on which it
lies of each of some planes. Two vectors share more elements the smaller their angle, so the Jaccard similarity of the
sets stands for the cosine. MinHash is used in its one-permutation form: the universe is cut in bins, one for each rotation
in which axes are ordered by their distance, so a set's minima in a bin are the rotation's nearest axes. A band is the
least ``rows`` elements of one bin, with some sides; bands use different rotations and are independent. At cosine 0.92
the nearest axis agrees with probability 0.51 and a side with 0.87, for unrelated vectors with 0.008 and 0.5.

How long a band is and how many bands there are follows from the number of vectors: :func:`choose_bands` keeps the
unrelated pairs that meet in a bucket at a constant number for each vector, at a recall aimed at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.tiles import TILE, forest, sides, tile_pairs
from ..plans.storage import discard, materialize
from .groups import group_matches

ROTATIONS, SEED = 64, 20240229
#: Probability aimed at, as if bands were independent, that a pair exactly at the threshold shares one; nearer pairs share one
#: more surely. Bands have planes in common, so what is measured at 0.92 is a little less: 0.9915 to 0.9958.
RECALL = 0.995
#: Expected pairs below the threshold that meet in a bucket, for each vector.
PAIRS_PER_VECTOR = 1.0
#: Vectors on which the rate of such pairs is measured. The rate sets the number of bands, never which vectors take part.
SAMPLE = 2000
#: Buckets up to this size give all their pairs at once; of larger ones those come later that a first link has not joined.
FEW = 4
#: Band entries that one task holds on average (12 or 16 bytes each).
ENTRIES = 2_000_000


@lru_cache(4096)
def _turn(dim: int, r: int) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng([SEED, dim, r]).normal(size=(dim, dim)))[0].astype(np.float32)


def elements(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per vector the nearest signed axis of the first ``ROTATIONS`` rotations, and a bit for the side of as many planes."""
    out = np.empty((len(x), ROTATIONS), dtype=np.int16)
    side = np.empty((len(x), ROTATIONS), dtype=bool)
    at = np.arange(len(x))
    for r in range(ROTATIONS):
        y = x @ _turn(x.shape[1], r)
        side[:, r] = y[:, 0] > 0
        k = np.abs(y).argmax(1)
        out[:, r] = 2 * k + (y[at, k] > 0)
    return out, np.packbits(side, axis=1).view(np.uint64)[:, 0]


def _nearest(y: np.ndarray, rows: int, codes: np.ndarray) -> Iterator[np.ndarray]:
    """Sums of the codes of the one, two, ... ``rows`` signed axes nearest to rotated vectors, whatever their order."""
    size, at, h = np.abs(y), np.arange(len(y)), np.zeros(len(y), dtype=np.uint64)
    for _ in range(rows):
        k = size.argmax(1)
        h = h + codes[2 * k + (y[at, k] > 0)]
        size[at, k] = -1
        yield h


@lru_cache(8)
def _codes(dim: int) -> np.ndarray:
    return np.random.default_rng(SEED).integers(1, 1 << 63, size=2 * dim, dtype=np.uint64)


@lru_cache(8)
def agreement(dim: int, cosine: float, most: int = 8) -> tuple[list[float], float]:
    """Probability that the one, two, ... nearest axes, and that a plane's side, are the same for two vectors at ``cosine``."""
    rng = np.random.default_rng(SEED)
    x, z = rng.normal(size=(2, 60_000, dim)).astype(np.float32)
    y = np.float32(cosine) * x + np.float32(math.sqrt(1 - cosine**2)) * z
    codes = _codes(dim)
    return [float((a == b).mean()) for a, b in zip(_nearest(x, most, codes), _nearest(y, most, codes))], 1 - math.acos(cosine) / math.pi


def least_jaccard(dim: int, threshold: float) -> float:
    """Jaccard similarity 5.5 standard deviations below the mean of pairs at ``threshold``; below it pairs are dropped."""
    (a, *_), g = agreement(dim, threshold)
    shared = ROTATIONS * (a + g) - 5.5 * math.sqrt(ROTATIONS * (a * (1 - a) + g * (1 - g)))
    return max(0.0, shared / (4 * ROTATIONS - shared))


def _shared(eu: np.ndarray, ev: np.ndarray, su: np.ndarray, sv: np.ndarray) -> np.ndarray:
    return (eu == ev).sum(-1) + ROTATIONS - np.bitwise_count(su ^ sv)


def _jaccard(*sets: np.ndarray) -> np.ndarray:
    m = _shared(*sets)
    return m / (4 * ROTATIONS - m)


def _least(holds, most: int = 1 << 20) -> int:
    """The least k from 0 for which ``holds(k)``, true from some k on; ``most`` if there is none below."""
    low, high = 0, 1
    while high < most and not holds(high):
        low, high = high, 2 * high
    high = min(high, most)
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if holds(mid) else (mid + 1, high)
    return low


@dataclass(frozen=True)
class Bands:
    """``rows`` axes to a band; the first ``plain`` bands take ``bits`` sides with them, ``finer`` further ones one more.

    ``pairs`` is the expected number of pairs below the threshold that meet, for each vector.
    """

    rows: int
    bits: int
    plain: int
    finer: int
    pairs: float

    @property
    def bands(self) -> int:
        return self.plain + self.finer


def choose_bands(x: np.ndarray, n: int, threshold: float, recall: float = RECALL, pairs: float = PAIRS_PER_VECTOR) -> Bands:
    """The fewest bands that find a pair at ``threshold`` with probability ``recall``, were they independent, while at most ``pairs`` others meet.

    ``x`` is a sample of the ``n`` vectors. Its pairs below the threshold show how often a band of up to three rows brings
    such pairs together, also where vectors are not spread evenly; longer bands go on from there at the rate of vectors
    spread evenly, 1 in ``C(dim, rows) * 2**rows``. A larger ``n`` asks for longer bands, so the number of bands grows as a
    small power of ``n`` and the pairs of each vector do not.
    """
    dim, x = x.shape[1], (x / np.sqrt((x.astype(float) ** 2).sum(1, keepdims=True))).astype(np.float32)
    even = [1 / (math.comb(dim, k) * 2.0**k) for k in range(1, 9)]
    rates = [[p * 0.5**t for t in range(9)] for p in even]  # by rows, sides
    cos = x @ x.T
    far = np.triu(cos < threshold, 1)
    if far.any():
        g, met = 1 - np.arccos(np.clip(cos, -1, 1)) / np.pi, np.zeros((3, 9))
        for r in range(ROTATIONS):
            for k, h in enumerate(_nearest(x @ _turn(dim, r), 3, _codes(dim))):
                near = g[(h[:, None] == h[None, :]) & far]
                met[k] += [(near**t).sum() for t in range(9)]
        met /= ROTATIONS * far.sum()
        more = max(1.0, met[2, 0] / even[2] / max(met[1, 0] / even[1], 1e-9)) if met[2, 0] * ROTATIONS * far.sum() > 30 else 1.0
        for k in range(8):
            over = met[min(k, 2)] * even[k] / even[min(k, 2)] * more ** max(0, k - 2)
            rates[k] = [max(a, b) for a, b in zip(over, rates[k])]
    same, side = agreement(dim, threshold)
    miss, best = math.log(1 - recall), None
    for rows in range(1, 9):
        rate = [r * (n - 1) / 2 for r in rates[rows - 1]]
        found = [math.log1p(-same[rows - 1] * side**t) for t in range(9)]  # of missing the pair in one band
        finer = lambda t, plain: max(0, math.ceil((miss - plain * found[t]) / found[t + 1] - 1e-9))
        for t in range(8):
            most = finer(t, 0)
            if most * rate[t + 1] <= pairs:
                cost = lambda p: p * rate[t] + finer(t, p) * rate[t + 1]
                plain = max(0, most - _least(lambda k: k >= most or cost(most - k) <= pairs, most))
                this = Bands(rows, t, plain, finer(t, plain), cost(plain))
                best = this if best is None or this.bands < best.bands else best
                break
    return best or Bands(8, 7, 0, finer(7, 0), finer(7, 0) * rate[8])


def band_keys(x: np.ndarray, plan: Bands) -> np.ndarray:
    """Per vector one 64-bit key for each band: the ``rows`` nearest axes of its rotation and sides of other rotations."""
    dim, b = x.shape[1], plan.bands
    own = np.random.default_rng(SEED + 1).integers(0, 1 << 63, size=b, dtype=np.uint64)
    keys, sides = np.empty((len(x), b), dtype=np.uint64), np.empty((len(x), b), dtype=np.uint64)
    for r in range(b):
        y = x @ _turn(dim, r)
        *_, keys[:, r] = _nearest(y, plan.rows, _codes(dim))
        sides[:, r] = y[:, 0] > 0
    for r in range(b):
        h = keys[:, r]
        for t in range(1, plan.bits + (r >= plan.plain) + 1):
            h = h * np.uint64(2) + sides[:, (r + t) % b]
        h = (h ^ own[r]) * np.uint64(0x9E3779B97F4A7C15)  # equal axes of two bands are different elements
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        keys[:, r] = h ^ (h >> np.uint64(32))
    return keys


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _lists(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))


def _digests(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each vector's numbers; -0 counts as 0."""
    words = (x + np.float32(0)).view(np.uint32).astype(np.uint64)
    rng = np.random.default_rng(SEED)
    out = []
    for _ in range(2):
        h = ((words + rng.integers(0, 1 << 62, size=words.shape[1], dtype=np.uint64)) * (rng.integers(0, 1 << 62, size=words.shape[1], dtype=np.uint64) | np.uint64(1))) ** 2
        h = h.sum(1) * np.uint64(0x9E3779B97F4A7C15)
        out.append((h ^ (h >> np.uint64(31))).view(np.int64))
    return out[0], out[1]


def _usable(x: np.ndarray) -> np.ndarray:
    """Vectors of finite numbers that are not all zero."""
    n = np.einsum("ij,ij->i", x.astype(float), x.astype(float))
    return np.isfinite(n) & (n > 0)


def _described(dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                b = whole.slice(at, 2000)
                x = _matrix(b.column("vec"), dim).astype(np.float32)
                ok = _usable(x)
                x, ids = x[ok], b.column("id").filter(pa.array(ok))
                e, s = elements(x)
                h1, h2 = _digests(x)
                yield pa.RecordBatch.from_arrays([ids, pa.array(h1), pa.array(h2), pa.array(s.view(np.int64)), _lists(e.astype(np.int16))], ["id", "h1", "h2", "s", "e"])

    return run


def _keyed(b: pa.RecordBatch, dim: int, plan: Bands) -> tuple[np.ndarray, np.ndarray]:
    """Band keys of a batch's usable vectors, and the id of each."""
    x = _matrix(b.column("vec"), dim).astype(np.float32)
    ok = _usable(x)
    x = x[ok]
    keys = [band_keys(x[at : at + 2000], plan) for at in range(0, len(x), 2000)]
    return np.concatenate(keys or [np.zeros((0, plan.bands), np.uint64)]).ravel(), np.repeat(b.column("id").to_numpy()[ok], plan.bands)


def _entries(dim: int, plan: Bands, parts: int, kind: str, hot: np.ndarray):
    """Band entries packed by bucket partition: 32 bits of the key and the id, both as bytes. Hot keys are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, ids = _keyed(b, dim, plan)
            ids = ids.astype(kind)
            if not len(keys):
                continue
            if len(hot):
                cold = ~np.isin(keys, hot)
                keys, ids = keys[cold], ids[cold]
            pid = ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
            order = np.argsort(pid, kind="stable")
            pid, keys, ids = pid[order], (keys[order] & np.uint64(0xFFFFFFFF)).astype("<u4"), ids[order]
            at = np.flatnonzero(np.append(True, pid[1:] != pid[:-1])) if len(pid) else np.zeros(0, np.int64)
            ends = np.append(at, len(pid)).astype(np.int32)
            packed = [pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer((ends * a.itemsize).astype(np.int32).tobytes()), pa.py_buffer(a.tobytes())]) for a in (keys, ids)]
            yield pa.RecordBatch.from_arrays([pa.array(pid[at].astype(np.int32)), *packed], ["pid", "keys", "ids"])

    return run


PAIR_SCHEMA = "u BIGINT, v BIGINT, key BIGINT"


def _pair_rows(u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
    lo, hi = np.minimum(u, v), np.maximum(u, v)
    one = np.unique(np.stack([lo, hi], axis=1)[lo != hi], axis=0)
    return pa.RecordBatch.from_arrays([pa.array(one[:, 0]), pa.array(one[:, 1]), pa.nulls(len(one), pa.int64())], ["u", "v", "key"])


def _key_rows(ids: np.ndarray, keys: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(ids), pa.nulls(len(ids), pa.int64()), pa.array(keys)], ["u", "v", "key"])


def _first_leader(ids: np.ndarray, leaders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per id the least of its leaders."""
    order = np.lexsort((leaders, ids))
    ids, leaders = ids[order], leaders[order]
    new = np.append(True, ids[1:] != ids[:-1])[: len(ids)]
    return ids[new], leaders[new]


def _bucket_pairs(kind: str):
    """Whole buckets of one partition: rows ``u, v`` are candidate pairs, rows ``u, key`` members of larger buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(pid, k, i) for b in batches for pid, k, i in zip(*(c.to_pylist() for c in b.columns))]
        if not held:
            return
        keys = np.concatenate([(np.uint64(pid) << np.uint64(32)) | np.frombuffer(k, dtype="<u4").astype(np.uint64) for pid, k, _ in held])
        ids = np.concatenate([np.frombuffer(i, dtype=kind) for _, _, i in held]).astype(np.int64)
        del held
        order = np.argsort(keys)
        keys, ids = keys[order], ids[order]
        start = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        width = np.diff(np.append(start, len(keys)))
        us, vs = [], []
        for m in range(2, FEW + 1):
            rows = start[width == m][:, None] + np.arange(m)
            a, b = np.triu_indices(m, 1)
            us.append(ids[rows[:, a]].ravel())
            vs.append(ids[rows[:, b]].ravel())
        wide = width > FEW
        if wide.any():
            inside = np.repeat(wide, width)
            leader = np.repeat(np.minimum.reduceat(ids, start)[wide], width[wide])
            member, first = _first_leader(ids[inside], leader)
            us.append(member)
            vs.append(first)
            yield _key_rows(ids[inside], keys[inside].view(np.int64))
        yield _pair_rows(np.concatenate(us), np.concatenate(vs))

    return run


def _hot_pairs(dim: int, plan: Bands, hot: np.ndarray, leaders: np.ndarray):
    """The entries of hot keys, where they are made: a link to the key's known leader and a member row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, ids = _keyed(b, dim, plan)
            at = np.isin(keys, hot)
            keys, ids = keys[at], ids[at]
            yield _key_rows(ids, keys.view(np.int64))
            yield _pair_rows(*_first_leader(ids, leaders[np.searchsorted(hot, keys)]))

    return run


def _cross_pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs of different ``root`` within each ``key``, of rows sorted by key in which keys are whole."""

    def pairs(k: np.ndarray, i: np.ndarray, r: np.ndarray) -> pd.DataFrame:
        start = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
        width = np.diff(np.append(start, len(k)))
        us, vs = [], []
        for m in np.unique(width):
            a, b = np.triu_indices(m, 1)
            for part in np.array_split(start[width == m], max(1, int((width == m).sum() * len(a) / 2e6))):
                rows = part[:, None] + np.arange(m)
                x, y = rows[:, a].ravel(), rows[:, b].ravel()
                other = r[x] != r[y]
                us.append(i[x[other]])
                vs.append(i[y[other]])
        u, v = np.concatenate(us), np.concatenate(vs)
        return pd.DataFrame({"u": np.minimum(u, v), "v": np.maximum(u, v)}).drop_duplicates()

    held = None
    for pdf in batches:
        both = pdf if held is None else pd.concat([held, pdf])
        if both.empty:
            continue
        k = both["key"].to_numpy()
        open_ = k == k[-1]
        if not open_.all():
            yield pairs(*(both[c].to_numpy()[~open_] for c in ("key", "u", "root")))
        held = both[open_]
    if held is not None and len(held):
        yield pairs(*(held[c].to_numpy() for c in ("key", "u", "root")))


def _alike(least: float):
    """Pairs whose sets have an exact Jaccard similarity of ``least`` or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                eu, ev = (_matrix(b.column(c), ROTATIONS) for c in ("eu", "ev"))
                keep = pa.array(_jaccard(eu, ev, *(b.column(c).to_numpy().view(np.uint64) for c in ("su", "sv"))) >= least)
                yield pa.RecordBatch.from_arrays([b.column("u").filter(keep), b.column("v").filter(keep)], ["u", "v"])

    return run


def similar_links(vectors: DataFrame, sets: DataFrame, names: np.ndarray, sample: np.ndarray, n: int, threshold: float, recall: float = RECALL, kind: str = "<i8") -> DataFrame:
    """``u, v`` links between ``id, vec`` with sets ``id, s, e`` that connect all pairs which share a band and are alike by Jaccard.

    All pairs of a small bucket are compared. In a larger one every member is first compared with one leader, the least
    id; then all pairs of the bucket whose members are still in different components, in tiles where the bucket is
    larger than one. So no pair that shares a band is left out unless its ends are connected already.

    Entries go to their bucket's partition packed as bytes. Keys that hold over a hundredth of the sample never meet in
    one task: their members are linked to the key's leader in the sample (``names``, vectors ``sample``) where they are made.
    """
    dim = sample.shape[1]
    plan = choose_bands(sample, n, threshold, recall)
    least = least_jaccard(dim, threshold)
    hot, leaders = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if len(sample) >= 200:
        hot, at, count = np.unique(band_keys(sample.astype(np.float32), plan).ravel(), return_index=True, return_counts=True)
        hot, leaders = hot[count > len(sample) / 100], names[at[count > len(sample) / 100] // plan.bands]
    vectors = vectors.select("id", "vec")
    parts = max(sets.sparkSession.sparkContext.defaultParallelism, math.ceil(n * plan.bands / ENTRIES))
    entries = vectors.mapInArrow(_entries(dim, plan, parts, kind, hot), "pid INT, keys BINARY, ids BINARY")
    found = entries.repartitionById(parts, F.col("pid")).mapInArrow(_bucket_pairs(kind), PAIR_SCHEMA)
    if len(hot):
        found = found.union(vectors.mapInArrow(_hot_pairs(dim, plan, hot, leaders), PAIR_SCHEMA))
    found = materialize(found, "pairs")

    def check(candidates: DataFrame) -> DataFrame:
        one = candidates.select("u", "v").distinct()
        left, right = (sets.select(F.col("id").alias(x), F.col("s").alias(f"s{x}"), F.col("e").alias(f"e{x}")) for x in "uv")
        return one.join(left, "u").join(right, "v").select("u", "v", "su", "eu", "sv", "ev").mapInArrow(_alike(least), "u BIGINT, v BIGINT")

    links = materialize(check(found.filter("v is not null")), "links")
    wide = found.filter("v is null").select("u", "key").distinct()
    if wide.isEmpty():
        discard(found)
        return links
    comp = group_matches(links)
    placed = wide.join(comp.withColumnRenamed("node", "u"), "u", "left").select("u", "key", F.coalesce("root", "u").alias("root"))
    several = placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("n")).filter("lo < hi")
    open_ = materialize(placed.join(several.select("key", "n"), "key"), "open")
    inside = open_.filter(F.col("n") <= TILE).select("key", "u", "root").repartition("key").sortWithinPartitions("key").mapInPandas(_cross_pairs, "u BIGINT, v BIGINT")
    more = check(inside)
    large = open_.filter(F.col("n") > TILE)
    if not large.isEmpty():
        rows = large.join(sets.select(F.col("id").alias("u"), "s", "e"), "u").select("key", "u", "root", "s", "e")

        def between(pdf: pd.DataFrame) -> pd.DataFrame:
            ids, root, s, e = pdf["u"].to_numpy(), pdf["root"].to_numpy(), pdf["s"].to_numpy().view(np.uint64), np.array(pdf["e"].tolist(), dtype=np.int16)
            r, c = sides(pdf)
            near = np.zeros((len(ids), len(ids)), dtype=bool)
            for x in r:
                near[x, c] = (_jaccard(e[x], e[c], s[x], s[c]) >= least) & (root[x] != root[c])
            u, v = forest(near | near.T)
            return pd.DataFrame({"u": ids[u], "v": ids[v]})

        more = more.union(tile_pairs(rows, "key", "u").groupBy("key", "_a", "_b").applyInPandas(between, "u BIGINT, v BIGINT"))
    out = materialize(links.union(more), "links")
    for t in (found, links, open_):
        discard(t)
    return out


def draw(sets: DataFrame, vectors: DataFrame, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of the ``SAMPLE`` sets whose id has the least hash."""
    ids = sets.select("id").distinct().orderBy(F.xxhash64("id", F.lit(SEED)), "id").limit(SAMPLE)
    rows = vectors.join(F.broadcast(ids), "id", "left_semi").collect()  # SAMPLE ids
    by_id = {r["id"]: x for r in rows if _usable(x := np.array([r["vec"]], dtype=np.float32))[0]}
    names = np.array(sorted(by_id), dtype=np.int64)
    return names, np.array([by_id[i][0] for i in names.tolist()], dtype=np.float32).reshape(-1, dim)


def _components(near: np.ndarray) -> np.ndarray:
    """Per row of a symmetric boolean matrix its component's first row."""
    out = np.arange(len(near))
    u, v = forest(near)
    for a, b in zip(u, v):  # edges come parent first
        out[b] = out[a]
    return out


def split_component(ids: np.ndarray, weight: np.ndarray, x: np.ndarray, threshold: float) -> list[tuple[np.ndarray, int]]:
    """Clusters of unit vectors ``x``, ids rising: members' positions and the position of the typical one.

    Linked vectors form components. In each, the member with the most neighbours (then the largest sum of cosines over the
    component, then the smallest id) is the centre; it and its neighbours are a cluster, the rest is grouped anew.
    """
    cos = x @ x.T
    near = cos >= threshold - 1e-9
    np.fill_diagonal(near, True)
    todo, out = [np.arange(len(ids))], []
    while todo:
        rows = todo.pop()
        part = _components(near[np.ix_(rows, rows)])
        for c in np.unique(part):
            m = rows[part == c]
            n = near[np.ix_(m, m)]
            degree, total = n @ weight[m], np.round(cos[np.ix_(m, m)] @ weight[m] - 1, 4)
            centre = np.lexsort((ids[m], -total, -degree))[0]
            kept = m[n[centre]]
            sums = np.round(cos[np.ix_(kept, kept)] @ weight[kept] - 1, 4)
            out.append((kept, int(kept[np.lexsort((ids[kept], -sums))[0]])))
            if len(kept) < len(m):
                todo.append(m[~n[centre]])
    return out


def _small_groups(dim: int, threshold: float):
    """Whole components of sorted rows ``root, id, weight, vec``: their clusters, by exact cosines."""

    def clusters(root: np.ndarray, ids: np.ndarray, weight: np.ndarray, vec: np.ndarray) -> pa.RecordBatch:
        h1, h2 = _digests(vec)
        order = np.lexsort((h2, h1, ids, root))
        root, ids, weight, x = root[order], ids[order], weight[order], vec[order].astype(np.float64)
        first = np.append(True, (ids[1:] != ids[:-1]) | (root[1:] != root[:-1]))
        root, ids, weight, x = root[first], ids[first], weight[first], x[first]
        x /= np.sqrt((x * x).sum(1, keepdims=True))
        start = np.flatnonzero(np.append(True, root[1:] != root[:-1]))
        width = np.diff(np.append(start, len(root)))
        low, size, typical = np.empty_like(ids), np.zeros_like(ids), np.empty_like(ids)
        for m in np.unique(width):
            for at in np.array_split(start[width == m], max(1, int((width == m).sum() * m * m / 4e6))):
                rows = at[:, None] + np.arange(m)
                y, w = x[rows], weight[rows]
                cos = y @ y.transpose(0, 2, 1)
                whole = (cos >= threshold - 1e-9).all((1, 2))
                best = np.round((cos @ w[:, :, None])[:, :, 0] - 1, 4).argmax(1)  # the first is the smallest id
                low[rows], size[rows], typical[rows] = ids[at][:, None], w.sum(1)[:, None], ids[at + best][:, None]
                for g in np.flatnonzero(~whole):
                    r = rows[g]
                    for kept, t in split_component(ids[r], weight[r], x[r], threshold):
                        k = r[kept]
                        low[k], size[k], typical[k] = ids[k].min(), weight[k].sum(), ids[r[t]]
        keep = pa.array(size > 1)
        return pa.RecordBatch.from_arrays([pa.array(c).filter(keep) for c in (ids, low, size, typical)], ["id", "cluster_id", "cluster_size", "typical_id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b.column("vec"), dim).astype(np.float32)
            ok = _usable(x)
            if not ok.any():
                continue
            new = tuple(c[ok] for c in (b.column("root").to_numpy(), b.column("id").to_numpy(), b.column("weight").to_numpy(), x))
            both = tuple(map(np.concatenate, zip(*held, new)))
            open_ = both[0] == both[0][-1]
            if not open_.all():
                yield clusters(*(c[~open_] for c in both))
            held = [tuple(c[open_] for c in both)]
        if held:
            yield clusters(*held[0])

    return run


def _unit_rows(dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column("vec"), dim).astype(np.float32)
            ok = _usable(x)
            h1, h2 = _digests(x[ok])
            y = x[ok].astype(np.float64)
            y /= np.sqrt((y * y).sum(1, keepdims=True))
            yield pa.RecordBatch.from_arrays([*(b.column(c).filter(pa.array(ok)) for c in ("id", "weight", "root")), pa.array(h1), pa.array(h2), _lists(y)], ["id", "weight", "root", "h1", "h2", "x"])

    return run


def _neighbours(rows: DataFrame, threshold: float) -> DataFrame:
    """All pairs of ``id, weight, root, x`` (unit) of equal ``root``, tile by tile.

    Rows ``u, v`` are links that connect what is within ``threshold``; rows ``u, n`` without a ``v`` are parts of the
    number of vectors within ``threshold`` of ``u``, copies counted and itself included.
    """

    def counted(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, w, x = pdf["id"].to_numpy(), pdf["weight"].to_numpy(), np.array(pdf["x"].tolist(), dtype=float)
        r, c = sides(pdf)
        near = np.zeros((len(ids), len(ids)), dtype=bool)
        near[np.ix_(r, c)] = x[r] @ x[c].T >= threshold - 1e-9
        near |= near.T
        np.fill_diagonal(near, pdf["_a"].iloc[0] == pdf["_b"].iloc[0])
        u, v = forest(near)
        ends = pd.array([*ids[v].tolist(), *[None] * len(ids)], dtype="Int64")
        return pd.DataFrame({"u": np.concatenate([ids[u], ids]), "v": ends, "n": np.concatenate([np.zeros(len(u), dtype=np.int64), near @ w])})

    dealt = tile_pairs(rows.select("id", "weight", "root", "x"), "root", "id")
    return dealt.groupBy("root", "_a", "_b").applyInPandas(counted, "u BIGINT, v BIGINT, n BIGINT")


def _dot(a, b):
    return F.aggregate(F.zip_with(a, b, lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)


def _medoids(rows: DataFrame, dim: int, first: tuple[str, ...] = ()) -> DataFrame:
    """``root, typical, tx``: per component the member with the largest ``first``, then sum of cosines to the others.

    The sum to the others is the member's product with the component's vector sum, less 1 for itself, so a component of
    any size needs one partial aggregate. Sums are compared at 4 decimals; ties go to the smallest id.
    """
    sums = rows.groupBy("root").agg(F.array(*[F.sum(F.col("x")[i] * F.col("weight")) for i in range(dim)]).alias("total"))
    scored = rows.join(sums, "root").withColumn("s", F.round(_dot(F.col("x"), F.col("total")) - 1, 4))
    best = scored.groupBy("root").agg(F.max_by(F.struct(F.col("id").alias("typical"), F.col("x").alias("tx")), F.struct(*first, "s", -F.col("id"))).alias("b"))
    return best.select("root", "b.typical", "b.tx")


def _large_groups(rows: DataFrame, dim: int, threshold: float) -> DataFrame:
    """:func:`split_component` for components of any size, over tables.

    A component whose medoid is within ``threshold`` of all others is one cluster as it stands, at a cost in proportion
    to its size. Only for others all pairs are computed, tile by tile.
    """

    def split(members: DataFrame, centres: DataFrame) -> DataFrame:
        near = (F.col("id") == F.col("typical")) | (_dot(F.col("x"), F.col("tx")) >= threshold - 1e-9)
        return materialize(members.join(centres, "root").withColumn("near", near).select("id", "weight", "root", "x", "typical", "near"), "placed")

    placed = split(rows, _medoids(rows, dim))
    loose = placed.filter("not near").select("root").distinct()
    done = placed.join(loose, "root", "left_anti").select("id", "weight", "typical")
    rows = placed.join(loose, "root", "left_semi").select("id", "weight", "root", "x")
    while not rows.isEmpty():
        found = materialize(_neighbours(rows, threshold), "neighbours")
        degree = found.filter("v is null").groupBy(F.col("u").alias("id")).agg(F.sum("n").alias("degree"))
        # All neighbours of a member are in its own new component, so its degree there is the one counted.
        again = group_matches(found.filter("v is not null").select("u", "v")).withColumnRenamed("node", "id")
        rows = rows.drop("root").join(again, "id", "left").join(degree, "id", "left")
        rows = materialize(rows.select("id", "weight", F.coalesce("root", "id").alias("root"), "x", F.coalesce("degree", "weight").alias("degree")), "members")
        placed = split(rows, _medoids(rows, dim, ("degree",)))
        kept = placed.filter("near").select("id", "weight", F.col("typical").alias("root"), "x")
        done = done.union(kept.join(_medoids(kept, dim), "root").select("id", "weight", "typical"))
        rows = placed.filter("not near").select("id", "weight", "root", "x")
        discard(found)
    size = done.groupBy("typical").agg(F.sum("weight").alias("cluster_size"), F.min("id").alias("cluster_id")).filter("cluster_size > 1")
    return done.select("id", "typical").join(size, "typical").select("id", "cluster_id", "cluster_size", F.col("typical").alias("typical_id"))


def describe(vectors: DataFrame, dim: int) -> DataFrame:
    """``id, h1, h2, s, e``: digests and set of every usable ``id, vec``, in one pass, written to the shared folder."""
    return materialize(vectors.mapInArrow(_described(dim), "id BIGINT, h1 BIGINT, h2 BIGINT, s BIGINT, e ARRAY<SMALLINT>"), "sets")


def similarity_clusters(vectors: DataFrame, threshold: float = 0.92, dim: int = 64, recall: float = RECALL, tile: int = TILE) -> DataFrame:
    """``id, cluster_id, cluster_size, typical_id`` of every ``id, vec`` that is in a cluster of two or more.

    ``cluster_id`` is the smallest id of the cluster. Vectors that are null, of another length, zero, or hold a null,
    NaN or infinity are similar to nothing; of several usable vectors of one id the one with the least digest counts.
    Exact copies collapse to one weighted vector before any pair is made. Sets that are alike by exact Jaccard similarity
    form candidate components, and inside these exact cosines decide: linked vectors form components, and a component
    without a member within ``threshold`` of all others is split around the member with the most neighbours
    (:func:`split_component`). ``typical_id`` has the largest sum of cosines in its cluster, compared at 4 decimals; ties
    go to the smallest id. A component of up to ``tile`` vectors is handled by one task, a larger one over tables, with
    the same result. Empty tables give no rows.
    """
    vec = F.col("vec").cast("array<float>")
    given = vectors.filter(F.col("id").isNotNull() & (F.size("vec") == dim)).select(F.col("id").cast("bigint").alias("id"), vec.alias("vec")).filter(~F.exists("vec", F.isnull))
    every = describe(given, dim)
    keys = every.select("id", "h1", "h2").distinct()
    one = keys.groupBy("id").agg(F.min(F.struct("h1", "h2")).alias("k"), F.count(F.lit(1)).alias("n"))
    alike = one.groupBy("k").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("weight")).filter("weight > 1")
    copies = materialize(one.join(alike, "k").select("id", "rep", "weight"), "copies")
    other = one.filter("n > 1").select("id", F.col("k.h1").alias("k1"), F.col("k.h2").alias("k2"))
    spare = every.join(other, "id").filter("h1 <> k1 or h2 <> k2").select("id", "h1", "h2").distinct()
    spent = copies.filter("id <> rep").select("id")
    sets = every.join(spent, "id", "left_anti").join(spare, ["id", "h1", "h2"], "left_anti").select("id", "s", "e")

    n, low, high = sets.agg(F.count(F.lit(1)), F.min("id"), F.max("id")).first()
    if not n:
        return vectors.sparkSession.createDataFrame([], "id BIGINT, cluster_id BIGINT, cluster_size BIGINT, typical_id BIGINT")
    names, sample = draw(sets, given, dim)
    kind = "<i4" if -(1 << 31) <= low and high < 1 << 31 else "<i8"
    links = similar_links(given.join(spent, "id", "left_anti"), sets, names, sample, n, threshold, recall, kind)
    comp = materialize(group_matches(links).select(F.col("node").alias("id"), "root"), "components")
    weights = copies.filter("id = rep").select("id", "weight")
    rows = given.join(comp, "id").join(weights, "id", "left").select("root", "id", F.coalesce("weight", F.lit(1).cast("bigint")).alias("weight"), "vec")
    big = comp.groupBy("root").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > tile).select("root")
    schema = "id BIGINT, cluster_id BIGINT, cluster_size BIGINT, typical_id BIGINT"
    crowded = not big.isEmpty()
    small = rows.join(big, "root", "left_anti") if crowded else rows
    out = small.repartition("root").sortWithinPartitions("root").mapInArrow(_small_groups(dim, threshold), schema)
    if crowded:
        units = rows.join(big, "root", "left_semi").select("id", "weight", "root", "vec").mapInArrow(_unit_rows(dim), "id BIGINT, weight BIGINT, root BIGINT, h1 BIGINT, h2 BIGINT, x ARRAY<DOUBLE>")
        first = units.groupBy("id").agg(F.min_by(F.struct("weight", "root", "x"), F.struct("h1", "h2")).alias("b")).select("id", "b.*")
        out = out.union(_large_groups(materialize(first, "members"), dim, threshold))
    alone = weights.join(comp, "id", "left_anti").select("id", F.col("id").alias("cluster_id"), F.col("weight").alias("cluster_size"), F.col("id").alias("typical_id"))
    out = materialize(out.union(alone), "clusters")
    rest = copies.filter("id <> rep").select("id", "rep").join(out.withColumnRenamed("id", "rep"), "rep").select("id", "cluster_id", "cluster_size", "typical_id")
    return out.select("id", "cluster_id", "cluster_size", "typical_id").union(rest)

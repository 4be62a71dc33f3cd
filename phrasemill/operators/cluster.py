"""Candidate clustering: lemma groups, similarity within first-token blocks, components, labels, sizes."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.embedding import Embedder, get_embedder
from ..functions.text import block_key
from ..functions.tokens import lemma_key
from ..functions.vectors import dot, unit
from ..plans.storage import materialize
from .components import connected_components
from .tiles import TILE, forest, sides, tile_pairs


def ordered_candidates(listed: DataFrame) -> DataFrame:
    """``ord, candidate``: distinct non-null candidates with the least id as list position."""
    return listed.filter("candidate is not null and candidate_id is not null").groupBy("candidate").agg(F.min("candidate_id").alias("ord"))


def lemma_groups(cands: DataFrame) -> DataFrame:
    """``candidate, ord, lemma, group_ord``: candidates of equal lemma key share the least position as group."""
    keyed = cands.withColumn("lemma", lemma_key(F.col("candidate")))
    low = keyed.groupBy("lemma").agg(F.min("ord").alias("group_ord"))
    return keyed.join(low, "lemma").select("candidate", "ord", "lemma", "group_ord")


def lemma_edges(cands: DataFrame) -> DataFrame:
    """Star edges ``u, v`` from each candidate to the first of its lemma group: a group of m gives m-1 edges."""
    return lemma_groups(cands).filter("ord <> group_ord").select(F.col("ord").alias("u"), F.col("group_ord").alias("v"))


def block_sizes(cands: DataFrame) -> DataFrame:
    """``block, block_size`` by first token."""
    return cands.groupBy(block_key(F.col("candidate")).alias("block")).agg(F.count(F.lit(1)).alias("block_size"))


def similarity_edges(vectors: DataFrame, threshold: float = 0.85, max_block_size: int = 2000) -> DataFrame:
    """Pairs ``u, v, similarity`` (u < v) at or above ``threshold`` inside a block of ``ord, block, vec`` (unit vectors).

    As the operator is defined, blocks of one and blocks beyond ``max_block_size`` give no pairs, so what one task
    holds is bounded; they are removed by a join on counts before vectors are shuffled. Sums run in double precision.
    """
    size = vectors.groupBy("block").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n").between(2, max_block_size))
    kept = vectors.join(size.select("block"), "block", "left_semi")

    def pairs(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ord")
        ids, m = pdf["ord"].to_numpy(), np.array(pdf["vec"].tolist(), dtype=float)
        sim = np.round(m @ m.T, 9)
        r, c = np.nonzero(np.triu(sim >= threshold, 1))
        return pd.DataFrame({"u": ids[r], "v": ids[c], "similarity": sim[r, c]})

    return kept.groupBy("block").applyInPandas(pairs, "u BIGINT, v BIGINT, similarity DOUBLE")


def exact_similarity_edges(vectors: DataFrame, threshold: float = 0.85, tile: int = TILE, spanning: bool = False) -> DataFrame:
    """:func:`similarity_edges` without a cap: blocks beyond ``tile`` members are multiplied tile by tile, across tasks.

    A task holds two tiles whatever the size of the block. With ``spanning``, a pair of tiles gives only the edges of
    trees that span its components: fewer edges, and the same components.
    """

    def pairs(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ord")
        ids, m = pdf["ord"].to_numpy(), np.array(pdf["vec"].tolist(), dtype=float)
        rows, cols = sides(pdf)
        sim = np.round(m[rows] @ m[cols].T, 9)
        near = sim >= threshold
        if spanning:
            square = np.zeros((len(ids), len(ids)), dtype=bool)
            square[np.ix_(rows, cols)] = near
            a, b = forest(square | square.T)
            at = np.full(len(ids), -1)  # position in rows or cols
            at[rows] = np.arange(len(rows))
            at[cols] = np.arange(len(cols))
            swap = ~np.isin(a, rows)
            r, c = np.where(swap, at[b], at[a]), np.where(swap, at[a], at[b])
        else:
            r, c = np.nonzero(np.triu(near, 1) if pdf["_a"].iloc[0] == pdf["_b"].iloc[0] else near)
        u, v = ids[rows[r]], ids[cols[c]]
        return pd.DataFrame({"u": np.minimum(u, v), "v": np.maximum(u, v), "similarity": sim[r, c]})

    dealt = tile_pairs(vectors.select("block", "ord", "vec"), "block", "ord", tile)
    return dealt.groupBy("block", "_a", "_b").applyInPandas(pairs, "u BIGINT, v BIGINT, similarity DOUBLE")


def oversize_blocks(vectors: DataFrame, max_block_size: int = 2000) -> DataFrame:
    """``block, block_size`` of the blocks that :func:`similarity_edges` leaves out as too large."""
    return vectors.filter("block is not null").groupBy("block").agg(F.count(F.lit(1)).alias("block_size")).filter(F.col("block_size") > max_block_size)


def skipped_blocks(vectors: DataFrame, max_block_size: int = 2000) -> DataFrame:
    """``n_blocks, n_rows``: blocks of ``block`` rows that :func:`similarity_edges` leaves out as too large, and their rows."""
    over = oversize_blocks(vectors, max_block_size)
    return over.agg(F.count(F.lit(1)).alias("n_blocks"), F.coalesce(F.sum("block_size"), F.lit(0)).alias("n_rows"))


def embed_candidates(cands: DataFrame, embedder: Embedder | None = None) -> DataFrame:
    """Adds ``vec`` to distinct candidates."""
    return cands.withColumn("vec", (embedder or get_embedder()).embed(F.col("candidate")))


def merge_groups(cands: DataFrame, edges: DataFrame) -> DataFrame:
    """``ord, candidate, first_ord``: components over ``edges``; a candidate without edges is its own group."""
    comp = connected_components(edges.select("u", "v"))
    return cands.join(comp.withColumnRenamed("node", "ord"), "ord", "left").select("ord", "candidate", F.coalesce("root", "ord").alias("first_ord"))


def cluster_labels(members: DataFrame, cluster: str = "first_ord") -> DataFrame:
    """``cluster, cluster_label, cluster_size`` from ``ord, candidate, vec`` rows with a cluster column.

    The label is the member nearest to the mean of all members (at 9 decimals; ties go to the first in list order). A
    zero mean compares as 0 for all. Sums of the mean are taken per component, so a cluster of any size costs one
    partial aggregate a partition.
    """
    dims = members.select(cluster, F.posexplode("vec").alias("_i", "_x")).groupBy(cluster, "_i").agg(F.avg("_x").alias("_x"))
    mean = dims.groupBy(cluster).agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", "_x"))), lambda s: s["_x"]).alias("_m"))
    sim = F.round(dot(F.col("vec"), unit(F.col("_m"))), 9)
    best = members.join(mean, cluster).groupBy(cluster).agg(F.max_by("candidate", F.struct(sim, -F.col("ord"))).alias("cluster_label"), F.count(F.lit(1)).alias("cluster_size"))
    return best.withColumnRenamed(cluster, "cluster")


def cluster_candidates(listed: DataFrame, threshold: float = 0.85, max_block_size: int | None = 2000, embedder: Embedder | None = None) -> DataFrame:
    """``candidate_id, candidate, cluster_id, cluster_label, cluster_size`` for every listed candidate.

    Lemma edges and similarity edges are merged in one components run. Cluster ids count from 0 in list order. Null
    candidates are left out; a string under several ids is one candidate, and each of its ids is listed. Without a
    ``max_block_size`` no block is skipped.
    """
    from .balanced import dense_ids

    vecs = materialize(embed_candidates(ordered_candidates(listed), embedder), "vectors")  # read for edges and for labels
    cands = vecs.select("candidate", "ord")
    blocks = vecs.withColumn("block", block_key(F.col("candidate")))
    edges = exact_similarity_edges(blocks, threshold, spanning=True) if max_block_size is None else similarity_edges(blocks, threshold, max_block_size)
    groups = merge_groups(cands, lemma_edges(cands).unionByName(edges.select("u", "v")))
    labels = cluster_labels(groups.join(vecs.select("ord", "vec"), "ord"))
    ids = dense_ids(labels, ["cluster"], "cluster_id")
    every = listed.filter("candidate is not null and candidate_id is not null").select("candidate_id", "candidate").distinct()
    return every.join(groups.select("candidate", F.col("first_ord").alias("cluster")), "candidate").join(ids, "cluster").select("candidate_id", "candidate", "cluster_id", "cluster_label", "cluster_size")

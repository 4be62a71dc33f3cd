"""Problem 2: pairwise matches consolidated into groups by hierarchical union-find over spanning forests."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import with_roots
from ..operators.unionfind import spanning_stars
from ..plans.storage import discard, materialize

#: Edges that one merging task may hold (about 100 bytes each while they are merged).
MERGE_EDGES = 2_000_000
FAN_IN = 8
SCHEMA = "node BIGINT, root BIGINT"


def _merged(forest: DataFrame, parts: int, limit: int, fan_in: int) -> DataFrame:
    """Forests of ``parts`` partitions merged ``fan_in`` at a time until one is left."""
    while True:
        parts = max(1, math.ceil(parts / fan_in))
        nxt = materialize(forest.coalesce(parts).mapInPandas(spanning_stars(limit), SCHEMA), "forest")
        discard(forest)
        forest = nxt
        if parts == 1:
            return forest


def _contracted(forest: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A level of the hierarchy: what the forests of all partitions say about their roots, and who hangs below them.

    A node that is a root in no partition takes one of its roots as its own; its other roots are linked to that one. So
    edges between roots are left, which connect what was connected. Roots follow a random order, so in any graph a fixed
    share of the nodes, at least a third of those on a path, is no root.
    """
    roots = materialize(forest.select("root").distinct(), "roots")
    below = forest.join(roots.select(F.col("root").alias("node")), "node", "left_anti")
    up = materialize(below.groupBy("node").agg(F.min("root").alias("root")), "below")
    between = forest.join(roots.select(F.col("root").alias("node")), "node", "left_semi")
    over = below.join(up.withColumnRenamed("root", "first"), "node").filter("root <> first").select(F.col("root").alias("node"), F.col("first").alias("root"))
    edges = materialize(between.select("node", "root").union(over).select(F.greatest("node", "root").alias("node"), F.least("node", "root").alias("root")).distinct(), "edges")
    discard(roots)
    return edges, up


def group_matches(edges: DataFrame, merge_edges: int = MERGE_EDGES, fan_in: int = FAN_IN) -> DataFrame:
    """``node, root`` for every node with a neighbour; ``root`` is the least node linked directly or indirectly.

    Edges are two BIGINT columns. Null ends, self-matches and repeats give nothing. Each edge partition is reduced to
    its spanning forest by union-find. While all forests together exceed what one task may hold, they form a level: nodes
    that are no root hang below one, and only the edges between roots go on to the next level, into partitions of
    bounded size. When they fit, forests are merged ``fan_in`` partitions at a time until the global components remain, and
    the levels are resolved downwards again. Each step is written to the shared folder. An empty table gives an empty one.
    """
    u, v = edges.columns[:2]
    clean = edges.select(F.col(u).cast("bigint").alias("node"), F.col(v).cast("bigint").alias("root")).filter("node <> root")
    forest = materialize(clean.mapInPandas(spanning_stars(merge_edges, True), SCHEMA), "forest")
    n, levels = forest.count(), []
    while n > merge_edges:
        rest, up = _contracted(forest)
        discard(forest)
        levels.append(up)
        # Edges of a node come together, so that a partition's forest joins more than single edges.
        parts = max(2, math.ceil(2 * n / merge_edges))
        forest = materialize(rest.repartition(parts, "root").mapInPandas(spanning_stars(merge_edges, True), SCHEMA), "forest")
        discard(rest)
        n = forest.count()
    out = _merged(forest, forest.rdd.getNumPartitions(), 4 * merge_edges, fan_in)
    if not levels:
        return with_roots(out)
    for up in reversed(levels):
        known = out.select(F.col("node").alias("root"), F.col("root").alias("top"))
        here = up.join(known, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
        out = out.union(here)
    # Roots of upper levels came in random order: the least node of each component names it.
    every = materialize(with_roots(out), "labels")
    low = every.groupBy("root").agg(F.min("node").alias("low"))
    return every.join(low, "root").select("node", F.col("low").alias("root"))


def valid_matches(matches: DataFrame, listed: DataFrame, threshold: float = 0.92) -> DataFrame:
    """``a, b`` of rows that link: both ends listed and different, of kind ``lemma`` or with a score not below ``threshold``.

    Null and NaN scores link only by kind; a null kind links only by score.
    """
    ids = listed.filter("candidate_id is not null").select("candidate_id").distinct()
    score = F.col("score").cast("double")
    good = F.coalesce(F.col("match_kind") == "lemma", F.lit(False)) | F.coalesce((score >= threshold) & ~F.isnan(score), F.lit(False))
    rows = matches.filter(good & (F.col("candidate_id_a") != F.col("candidate_id_b"))).select(F.col("candidate_id_a").alias("a"), F.col("candidate_id_b").alias("b"))
    return rows.join(ids.select(F.col("candidate_id").alias("a")), "a", "left_semi").join(ids.select(F.col("candidate_id").alias("b")), "b", "left_semi").select("a", "b")

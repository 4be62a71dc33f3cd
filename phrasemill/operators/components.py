"""Connected components: union-find within partitions, then in one bounded task, or by alternating star contraction (Kiveris et al. 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.storage import discard, materialize
from .unionfind import spanning_stars

#: Edges of spanning forests that one task may hold.
ONE_TASK = 1_000_000


def _large_star(e: DataFrame) -> DataFrame:
    both = e.union(e.select(F.col("v"), F.col("u")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    return down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))


def _clean(e: DataFrame) -> DataFrame:
    return e.filter("u <> v").distinct()


def star_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``u, v``): root is the least node linked directly or indirectly.

    Self-loops, repeats and null ends are ignored; nodes without another node do not appear. Each round is two
    grouped minima and two joins, whose result is written to the shared folder, so lineage stays short. The number of
    edges never grows; adaptive execution splits a hub's rows. A round without change ends the loop.
    """
    e = materialize(_clean(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u is not null and v is not null")), "star")
    mark = None
    for _ in range(max_rounds):
        nxt = materialize(_clean(_small_star(_clean(_large_star(e)))), "star")
        row = nxt.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        discard(e)
        e = nxt
        if row == mark:
            break
        mark = row
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    return with_roots(e.select(F.col("u").alias("node"), F.col("v").alias("root")))


def connected_components(edges: DataFrame, one_task: int = ONE_TASK) -> DataFrame:
    """``node, root`` as :func:`star_components` gives them, in fewer steps.

    Every partition of ``edges`` is reduced to its spanning forest. Forests of up to ``one_task`` edges together are
    merged by one task; more of them go on to star contraction.
    """
    clean = edges.select(F.col("u").cast("bigint").alias("u"), F.col("v").cast("bigint").alias("v")).filter("u <> v")
    forest = materialize(clean.mapInPandas(spanning_stars(one_task), "node BIGINT, root BIGINT"), "forest")
    if forest.count() > one_task:
        return star_components(forest.select(F.col("node").alias("u"), F.col("root").alias("v")))
    return with_roots(materialize(forest.coalesce(1).mapInPandas(spanning_stars(4 * one_task), "node BIGINT, root BIGINT"), "components"))


def with_roots(stars: DataFrame) -> DataFrame:
    """Star rows ``node, root`` and a row for each root itself."""
    return stars.union(stars.select("root", "root").distinct())

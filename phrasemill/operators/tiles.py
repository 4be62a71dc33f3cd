"""All pairs inside groups of any size: groups are cut in tiles, and every pair of tiles is one small task group."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a tile on average; a task group holds two tiles.
TILE = 2000


def tile_pairs(df: DataFrame, group: str, item: str, tile: int = TILE) -> DataFrame:
    """Rows of groups of two or more, copied once for each pair of tiles ``_a <= _b`` that their own tile ``_k`` is in.

    A group of n rows has t = ceil(n / tile) tiles by hash of ``item``, and each of its rows goes out t times; a group
    of up to ``tile`` rows isn't copied. Grouped by (``group``, ``_a``, ``_b``), any two rows meet: rows of different
    tiles once, rows of the same tile where ``_a = _b``. Null groups are left out.
    """
    size = df.groupBy(group).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").withColumn("_t", F.ceil(F.col("_n") / tile)).drop("_n")
    own = df.join(size, group).withColumn("_k", F.pmod(F.xxhash64(item), F.col("_t")))
    other = own.withColumn("_j", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_t") - 1)))
    return other.withColumn("_a", F.least("_k", "_j")).withColumn("_b", F.greatest("_k", "_j")).drop("_j", "_t")


def sides(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Row positions of the two tiles of a task group; twice the same ones where a tile meets itself."""
    if pdf["_a"].iloc[0] == pdf["_b"].iloc[0]:
        return np.arange(len(pdf)), np.arange(len(pdf))
    left = (pdf["_k"] == pdf["_a"]).to_numpy()
    return np.flatnonzero(left), np.flatnonzero(~left)


def forest(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges of trees that span the components of a symmetric boolean matrix."""
    u, v, unseen = [], [], np.ones(len(near), dtype=bool)
    for start in range(len(near)):
        if not unseen[start]:
            continue
        unseen[start], todo = False, [start]
        while todo:
            at = todo.pop()
            new = np.flatnonzero(near[at] & unseen)
            unseen[new] = False
            u.append(np.full(len(new), at))
            v.append(new)
            todo.extend(new.tolist())
    empty = [np.empty(0, dtype=np.int64)]
    return np.concatenate(u or empty), np.concatenate(v or empty)

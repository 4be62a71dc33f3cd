"""Problem 6: one order from several scores by a random walk on ranks."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.balanced import running_sums
from ..plans.storage import discard, materialize

DAMPING, BATCH_ROWS = 0.85, 200_000
#: Items of a group that one task may hold (about 200 bytes each); larger groups walk as distributed tables.
MOST_ITEMS = 1_000_000
#: Values are compared, and the walk ends, by probability times group size, whose mean is 1 in a group of any size.
DECIMALS, LEAST_CHANGE = 9, 1e-11


def _rounds(damping: float, size: int) -> int:
    """Rounds after which the walk over ``size`` items has converged from any start: each takes off ``1 - damping`` of the rest."""
    return math.ceil(math.log(LEAST_CHANGE / (2 * max(size, 1))) / math.log(damping))


class _Ladder:
    """One score's jumps inside each group: from an item uniformly to those not below it; from the highest, anywhere."""

    def __init__(self, group: np.ndarray, score: np.ndarray, first: np.ndarray, size: np.ndarray):
        self.order = np.lexsort((-score, group))
        g, s = group[self.order], score[self.order]
        new = np.concatenate([[True], (g[1:] != g[:-1]) | (s[1:] != s[:-1])])
        starts = np.flatnonzero(new)
        tie = np.cumsum(new) - 1
        self.tie_start, self.group_start, self.group_end = starts[tie], first[g], (first + size)[g]
        self.top = self.tie_start == self.group_start
        self.targets = (np.append(starts[1:], len(g))[tie] - self.group_start).astype(float)
        self.size = size[g].astype(float)

    def step(self, x: np.ndarray) -> np.ndarray:
        y = x[self.order]
        climbing = np.concatenate([[0.0], np.cumsum(np.where(self.top, 0, y / self.targets))])
        leaving = np.concatenate([[0.0], np.cumsum(np.where(self.top, y, 0))])
        moved = climbing[self.group_end] - climbing[self.tie_start] + (leaving[self.group_end] - leaving[self.group_start]) / self.size
        out = np.empty_like(x)
        out[self.order] = moved
        return out


def stationary(group: np.ndarray, scores: list[np.ndarray], damping: float = DAMPING, rounds: int | None = None) -> np.ndarray:
    """Stationary probability of every item, groups being contiguous runs numbered 0, 1, ...

    A walker picks one of the scores with equal chance and jumps to a uniformly chosen item among those not below its
    own by that score, itself included. From the highest, where nothing is left to climb, and otherwise with probability
    ``1 - damping``, it restarts anywhere in the group: were it to stay there, the items that lead by a single score
    would hold all of its time. Missing scores (NaN) are lower than all others.
    """
    size = np.bincount(group)
    first = np.concatenate([[0], np.cumsum(size)[:-1]])
    ladders = [_Ladder(group, np.where(np.isnan(s), -np.inf, s), first, size) for s in scores]
    start = 1 / size[group]
    x = start
    for _ in range(rounds or _rounds(damping, size.max(initial=1))):
        nxt = damping * sum(ladder.step(x) for ladder in ladders) / len(ladders) + (1 - damping) * start
        if (np.abs(nxt - x) * size[group]).max(initial=0) < LEAST_CHANGE:
            return nxt
        x = nxt
    return x


def fuse_scores(df: DataFrame, group: str, item: str, scores: list[str], damping: float = DAMPING, most_items: int = MOST_ITEMS) -> DataFrame:
    """``group, item, stationarity, fused_rank`` (from 1): items of each group in one order by all scores.

    Only the order of each score counts, never its range. Null and NaN scores are lowest; of repeated items the higher
    value of each score counts; ties of the walk (probability times group size at 9 decimals) go to the lower item. Null groups and items are left
    out. Groups are streamed in batches of whole groups. A group of more than ``most_items`` distinct items is never
    held by a task: its walk runs over tables instead (:func:`_walk_large`), with the same result.
    """
    values = [F.max(F.when(~F.isnan(F.col(s).cast("double")), F.col(s).cast("double"))).alias(f"_s{i}") for i, s in enumerate(scores)]
    every = materialize(df.filter(F.col(group).isNotNull() & F.col(item).isNotNull()).groupBy(group, item).agg(*values), "items")
    crowded = every.groupBy(group).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > most_items).select(group)
    huge = not crowded.isEmpty()
    items = every.join(crowded, group, "left_anti") if huge else every
    kinds = {f.name: f.dataType.simpleString() for f in items.schema}
    names = [f"_s{i}" for i in range(len(scores))]

    def ranked(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([group, item], ignore_index=True)
        g = pd.factorize(pdf[group])[0]
        p = stationary(g, [pdf[s].to_numpy(dtype=float) for s in names], damping)
        order = np.lexsort((np.arange(len(p)), -np.round(p * np.bincount(g)[g], DECIMALS), g))
        rank = np.empty(len(p), dtype=np.int64)
        first = np.concatenate([[0], np.cumsum(np.bincount(g))[:-1]])
        rank[order] = np.arange(len(p)) - first[g[order]] + 1
        return pd.DataFrame({group: pdf[group], item: pdf[item], "stationarity": p, "fused_rank": rank})

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        n = 0
        for pdf in batches:
            held.append(pdf)
            n += len(pdf)
            if n >= BATCH_ROWS:
                both = pd.concat(held, ignore_index=True)
                last = both[group] == both[group].iloc[-1]
                if not last.all():
                    yield ranked(both[~last])
                    both = both[last]
                held, n = [both], len(both) - BATCH_ROWS if last.all() else len(both)
        if held and sum(map(len, held)):
            yield ranked(pd.concat(held, ignore_index=True))

    schema = f"`{group}` {kinds[group]}, `{item}` {kinds[item]}, stationarity DOUBLE, fused_rank BIGINT"
    small = items.repartition(group).sortWithinPartitions(group).mapInPandas(walk, schema)
    return small.union(_walk_large(every.join(crowded, group, "left_semi"), group, item, names, damping)) if huge else small


def _walk_large(items: DataFrame, group: str, item: str, names: list[str], damping: float) -> DataFrame:
    """The same walk for groups of any size: each step is a sum by (group, score) and a range-partitioned running sum.

    State is written to the shared folder after every step; the items of a group never meet in one task.
    """
    low = [F.coalesce(-F.col(s), F.lit(float("inf"))).alias(s) for s in names]  # ascending order is best first
    x = items.select(group, item, *low)
    size = x.groupBy(group).agg(F.count(F.lit(1)).alias("_size"))
    for i, s in enumerate(names):
        n = x.groupBy(group, s).agg(F.count(F.lit(1)).alias("_m"))
        steps = running_sums(n, group, [s], "_m", f"_to{i}").select(group, s, f"_to{i}", (F.col(f"_to{i}") == F.col("_m")).alias(f"_top{i}"))
        x = x.join(steps, [group, s])
    x = materialize(x.join(size, group).withColumn("_x", 1 / F.col("_size")), "walk")
    for _ in range(_rounds(damping, size.agg(F.max("_size")).first()[0])):
        moved = x
        for i, s in enumerate(names):
            y = x.groupBy(group, s).agg(F.sum(F.when(~F.col(f"_top{i}"), F.col("_x") / F.col(f"_to{i}")).otherwise(0.0)).alias("_y"))
            upto = running_sums(y, group, [s], "_y", "_c")
            whole = x.groupBy(group).agg(F.sum(F.when(~F.col(f"_top{i}"), F.col("_x") / F.col(f"_to{i}")).otherwise(0.0)).alias("_all"), F.sum(F.when(F.col(f"_top{i}"), F.col("_x")).otherwise(0.0)).alias("_left"))
            came = upto.join(whole, group).select(group, s, (F.col("_all") - F.col("_c") + F.col("_y")).alias(f"_in{i}"), F.col("_left").alias(f"_left{i}"))
            moved = moved.join(came, [group, s])
        share = sum(F.col(f"_in{i}") + F.col(f"_left{i}") / F.col("_size") for i in range(len(names))) / len(names)
        nxt = materialize(moved.withColumn("_new", damping * share + (1 - damping) / F.col("_size")).select(*[c for c in x.columns if c != "_x"], F.col("_x").alias("_old"), F.col("_new").alias("_x")), "walk")
        change = nxt.agg(F.max(F.abs(F.col("_x") - F.col("_old")) * F.col("_size"))).first()[0]
        discard(x)
        x = nxt.drop("_old")
        x.phrasemill_path = nxt.phrasemill_path  # type: ignore[attr-defined]
        if change < LEAST_CHANGE:
            break
    out = x.select(group, item, F.col("_x").alias("stationarity"), (-F.round(F.col("_x") * F.col("_size"), DECIMALS)).alias("_o")).withColumn("_one", F.lit(1))
    placed = running_sums(out, group, ["_o", item], "_one", "fused_rank")
    return placed.select(group, item, "stationarity", F.col("fused_rank").cast("bigint").alias("fused_rank"))


def requested_ranking(ranked: DataFrame, requests: DataFrame) -> DataFrame:
    """:func:`fuse_scores` of TF-IDF and semantic score for the distinct requested documents that are ranked.

    The request is applied as a semi-join before anything else; Spark broadcasts it below its size threshold and
    otherwise shuffles both sides by document.
    """
    wanted = requests.filter("row_id is not null").select("row_id").distinct()
    rows = ranked.select("row_id", "candidate_id", "tfidf_score", "semantic_score").join(wanted, "row_id", "left_semi")
    return fuse_scores(rows, "row_id", "candidate_id", ["tfidf_score", "semantic_score"])

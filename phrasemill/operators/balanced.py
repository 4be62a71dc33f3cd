"""Per-key results when a few keys hold most rows.

Rows are range partitioned on the composite of key and a secondary column, with bounds from sampled quantiles. A
heavy key then spans several partitions of ordinary size instead of filling one, while equal composites stay
together. Each partition computes a partial state for each of its keys; the states of keys that straddle a boundary
are stitched afterwards. A key gives at most one state per partition, so stitching moves next to nothing.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.storage import materialize


LEAST_SAMPLED = 1000


def distinct_counts(df: DataFrame, key: str, value: str) -> DataFrame:
    """``key, n_rows, n_distinct`` of every key, heavy or not; null keys form one group, null values are not counted.

    The exchange by (key, value) already clusters the pairs, so duplicates fold without another shuffle, each
    partition adds up its keys, and only those sums are exchanged by key.
    """
    ranged = df.select(key, value).repartitionByRange(F.col(key), F.col(value))
    pairs = ranged.groupBy(key, value).agg(F.count(F.lit(1)).alias("_n"))
    return pairs.groupBy(key).agg(F.sum("_n").alias("n_rows"), F.count(value).alias("n_distinct"))


def heavy_keys(df: DataFrame, key: str) -> dict:
    """Keys that hold more than a partition's share of the rows, each with the number of partitions it fills (rounded up).

    Sizes are estimated on a tenth of the rows, by an aggregate that combines map-side: they decide where rows go, never
    which rows take part. Keys with fewer than ``LEAST_SAMPLED`` rows in it, about ten times as many in all, burden no task and
    are not heavy; of so few a sample would tell nothing. No more keys can be heavy than there are partitions, so what comes to the driver is
    bounded. Null is no key.
    """
    parts = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    sizes = df.filter(F.col(key).isNotNull()).select(key).sample(0.1, seed=1).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = sizes.agg(F.sum("_n").alias("_total")).scalar()
    share = F.col("_n") * parts / total
    return {r[0]: r[1] for r in sizes.filter((share > 1) & (F.col("_n") >= LEAST_SAMPLED)).select(key, F.ceil(share).cast("int")).collect()}


def spread_join(big: DataFrame, small: DataFrame, key: str, spread_by: str, counted: DataFrame | None = None, how: str = "inner") -> DataFrame:
    """``big`` joined with ``small`` on ``key``, where a few keys may hold most rows of ``big``.

    Keys that hold more than their share of a partition are cut in as many parts as the largest of them fills partitions,
    by the hash of ``spread_by``; their rows of ``small`` go to every part. Sizes are taken from ``counted`` (``big`` itself if
    not given). Null keys match nothing; ``how`` is ``inner`` or ``left_semi``.
    """
    heavy = heavy_keys(big if counted is None else counted, key)
    if not heavy:
        return big.join(small, key, how)
    cut, hot = max(heavy.values()), F.coalesce(F.col(key).isin(*heavy), F.lit(False))  # at most a key for each partition
    part = F.when(hot, F.pmod(F.xxhash64(spread_by), F.lit(cut)).cast("int")).otherwise(0)
    copies = F.explode(F.when(hot, F.sequence(F.lit(0), F.lit(cut - 1))).otherwise(F.array(F.lit(0))))
    return big.withColumn("_part", part).join(small.withColumn("_part", copies), [key, "_part"], how).drop("_part")


def dense_ids(df: DataFrame, order: Sequence[str], name: str, start: int = 0) -> DataFrame:
    """``df`` with a gapless ``name`` in the order of ``order`` (nulls first), numbered from ``start``.

    A range-partitioned sort, local numbers, and one offset per partition; the sorted rows are written to the shared
    folder first, because two evaluations could sample different bounds. Rows equal in ``order`` get some order.
    """
    local = F.monotonically_increasing_id()
    ranged = df.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order]).sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in order])
    kept = materialize(ranged.withColumn("_mid", local), "numbered")
    pid, at = F.shiftright("_mid", 33), F.col("_mid").bitwiseAND((1 << 33) - 1)
    counts = sorted((r["p"], r["n"]) for r in kept.groupBy(pid.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())  # a row per partition
    offsets, total = [], start
    for p, n in counts:
        offsets.append((p, total))
        total += n
    table = df.sparkSession.createDataFrame(offsets or [(0, start)], "_p BIGINT, _o BIGINT")
    out = kept.withColumn("_p", pid).join(F.broadcast(table), "_p")  # as many rows as partitions
    return out.withColumn(name, F.col("_o") + at).drop("_p", "_o", "_mid")


def running_sums(df: DataFrame, key: str, order: Sequence[str], value: str, name: str) -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` over the rows of the same key up to this one, in the order of ``order``.

    Nulls come first and null keys form one group; a null value counts as 0. Rows equal in key and order get some order.
    Sums run inside each range partition; a key that began in earlier partitions is moved up by its totals there, for
    which the rows are written to the shared folder first.
    """
    at = [F.col(c).asc_nulls_first() for c in (key, *order)]
    ranged = df.repartitionByRange(*at).sortWithinPartitions(*at).withColumn("_pid", F.spark_partition_id())
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranged.schema) + f", `{name}` DOUBLE"

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_key, so_far = object(), 0.0
        for pdf in batches:
            if pdf.empty:
                continue
            k = pdf[key]
            new = ~((k == k.shift()) | (k.isna() & k.shift().isna()))
            first = None if pd.isna(k.iloc[0]) else k.iloc[0]
            new.iloc[0] = first != open_key
            run = new.cumsum()
            sums = pdf[value].astype(float).fillna(0).groupby(run).cumsum()
            if first == open_key:
                sums = sums.where(run > 0, sums + so_far)
            open_key, so_far = (None if pd.isna(k.iloc[-1]) else k.iloc[-1]), float(sums.iloc[-1])
            yield pdf.assign(**{name: sums})

    kept = materialize(ranged.mapInPandas(scan, schema), "running")
    states = kept.groupBy(F.col(key).alias("_k"), F.col("_pid").alias("_p")).agg(F.sum(F.coalesce(F.col(value).cast("double"), F.lit(0.0))).alias("_v"))
    parts = states.groupBy("_k").agg(F.array_sort(F.collect_list(F.struct("_p", "_v"))).alias("_s")).filter(F.size("_s") > 1)
    before = F.aggregate(F.slice("_s", F.lit(1), F.col("_i")), F.lit(0.0), lambda a, x: a + x["_v"])
    moved = parts.select("_k", F.posexplode("_s").alias("_i", "_x"), "_s").select("_k", F.col("_x._p").alias("_p"), before.alias("_off"))
    # Only keys that straddle a boundary are here: at most two rows a partition.
    out = kept.join(F.broadcast(moved), F.col(key).eqNullSafe(F.col("_k")) & (F.col("_pid") == F.col("_p")), "left")
    return out.select(*df.columns, (F.col(name) + F.coalesce("_off", F.lit(0.0))).alias(name))


def running_counts(df: DataFrame, key: str, order: str, name: str = "ordinal") -> DataFrame:
    """Distinct ``key, order`` pairs, ``n_rows`` of each, and the position ``name`` (from 1) of ``order`` within its key.

    Nulls in either column come first and count as a value.
    """
    pairs = df.select(key, order).repartitionByRange(F.col(key), F.col(order)).groupBy(key, order).agg(F.count(F.lit(1)).alias("n_rows"))
    out = running_sums(pairs.withColumn("_one", F.lit(1)), key, [order], "_one", name)
    return out.select(key, order, "n_rows", F.col(name).cast("bigint").alias(name))

import numpy as np
from pyspark.sql import functions as F

from phrasemill.llm.fusion import fuse_scores, stationary


def test_large_groups_are_ordered_by_the_walk_not_by_the_item(spark):
    n = 100_000
    rows = spark.range(n).select(F.lit(1).alias("g"), F.col("id").alias("i"), F.xxhash64("id").cast("double").alias("a"), F.xxhash64("id", F.lit(7)).cast("double").alias("b"))
    given = rows.toPandas()
    walk = stationary(np.zeros(n, dtype=np.int64), [given["a"].to_numpy(), given["b"].to_numpy()]) * n
    got = fuse_scores(rows, "g", "i", ["a", "b"]).select("i", "fused_rank").toPandas().sort_values("fused_rank")
    assert got["fused_rank"].tolist() == list(range(1, n + 1))
    assert np.diff(walk[got["i"].to_numpy()]).max() <= 2e-9

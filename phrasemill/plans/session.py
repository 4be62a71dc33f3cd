"""Session construction and input spreading."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Per-row work is heavy for its bytes: small partitions keep all cores busy instead of being merged into a few.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "phrasemill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's defaults; settings given by the cluster or in ``conf`` win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Parquet table ``name`` of ``sf_dir``, projected to ``columns`` so that only they are scanned."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def spread(df: DataFrame) -> DataFrame:
    """Round-robin a scan that arrives in fewer tasks than the cluster has cores.

    Meant for a plain scan before expensive per-row work. A large table has more splits than cores and is
    returned as it is, so nothing is shuffled at scale.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df

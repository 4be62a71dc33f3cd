"""Documents per cluster, and the reports over clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import starts_with_pattern
from ..plans.storage import materialize
from .balanced import distinct_counts, spread_join


def cluster_documents(mapping: DataFrame, clusters: DataFrame) -> DataFrame:
    """``cluster_id, doc_count``: distinct non-null documents of the candidates that ``clusters`` puts in the cluster.

    Memberships are made distinct, so repeated rows count once and a candidate in two clusters counts in both. The join
    cuts hot candidates in parts; its rows are written once, because range partitioning on (cluster, document) reads
    them twice, to sample and to move. So a hot cluster spreads as well. Clusters without documents do not appear.
    """
    member = clusters.filter("candidate_id is not null and cluster_id is not null").select("candidate_id", "cluster_id").distinct()
    named = mapping.filter("row_id is not null and candidate_id is not null").select("candidate_id", "row_id")
    rows = materialize(spread_join(named, member, "candidate_id", "row_id").select("cluster_id", "row_id"), "members")
    return distinct_counts(rows, "cluster_id", "row_id").select("cluster_id", F.col("n_distinct").alias("doc_count"))


def cluster_doc_counts(mapping: DataFrame, clusters: DataFrame) -> DataFrame:
    """``cluster_id, cluster_label, cluster_size, doc_count``; label and size are the least stated ones."""
    meta = clusters.filter("cluster_id is not null").groupBy("cluster_id").agg(F.min("cluster_label").alias("cluster_label"), F.min("cluster_size").alias("cluster_size"))
    return meta.join(cluster_documents(mapping, clusters), "cluster_id").select("cluster_id", "cluster_label", "cluster_size", "doc_count")


def wrong_doc_counts(stated: DataFrame, mapping: DataFrame, clusters: DataFrame) -> DataFrame:
    """``cluster_id`` of stated counts that are null or differ from the counted documents (0 if none)."""
    counted = cluster_documents(mapping, clusters).withColumnRenamed("doc_count", "_true")
    rows = stated.filter("cluster_id is not null").select("cluster_id", "doc_count").distinct().join(counted, "cluster_id", "left")
    return rows.filter("not doc_count <=> coalesce(_true, 0)").select("cluster_id").distinct()


def top_clusters(counts: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` clusters with most documents; ties by id."""
    return counts.orderBy(F.desc("doc_count"), "cluster_id").limit(k)


def largest_clusters(clusters: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` clusters with most distinct candidates; ties by id."""
    size = clusters.filter("cluster_id is not null").groupBy("cluster_id").agg(F.min("cluster_label").alias("cluster_label"), F.count_distinct("candidate").alias("n_candidates"))
    return size.orderBy(F.desc("n_candidates"), "cluster_id").limit(k)


def _sizes(clusters: DataFrame) -> DataFrame:
    return clusters.filter("cluster_id is not null").groupBy("cluster_id").agg(F.count_distinct("candidate").alias("cluster_size"))


def cluster_size_distribution(clusters: DataFrame) -> DataFrame:
    """``cluster_size, n_clusters, n_candidates`` by counted size."""
    return _sizes(clusters).groupBy("cluster_size").agg(F.count(F.lit(1)).alias("n_clusters"), F.sum("cluster_size").alias("n_candidates"))


def cluster_summary(clusters: DataFrame) -> DataFrame:
    """One row: clusters, singletons, clusters of several, candidates in these."""
    many = F.col("cluster_size") > 1
    return _sizes(clusters).agg(
        F.count(F.lit(1)).alias("n_clusters"), F.count_if(~many).alias("n_singletons"), F.count_if(many).alias("n_multi"),
        F.coalesce(F.sum(F.when(many, F.col("cluster_size"))), F.lit(0)).alias("n_in_multi"),
    )


def matching_candidates(clusters: DataFrame, pattern: str) -> DataFrame:
    """Distinct cluster rows whose candidate matches a regular expression; null never matches."""
    return clusters.filter(starts_with_pattern(F.col("candidate"), pattern)).select("candidate", "cluster_id").distinct()

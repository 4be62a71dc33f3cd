"""Dictionary encoding of occurrences: candidates_list and candidates_mapping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .balanced import dense_ids


def candidates_list(occurrences: DataFrame) -> DataFrame:
    """``candidate_id, candidate, surface_form, extraction_source``: one row per form, ids from 0 by first appearance.

    Appearance order is section (all titles first), document id, span source, span. Surface and tags are those of the
    first occurrence.
    """
    at = ["section_ord", "row_id", "source_ord", "span_ord"]
    first = occurrences.groupBy("candidate").agg(F.min(F.struct(*at, "surface_form", "extraction_source")).alias("_f"))
    ids = dense_ids(first.select("candidate", "_f.*"), [*at, "candidate"], "candidate_id")
    return ids.select("candidate_id", "candidate", "surface_form", "extraction_source")


def candidates_mapping(occurrences: DataFrame, listed: DataFrame, raw_tf: bool = False) -> DataFrame:
    """``candidate_id, row_id``, one row per occurrence; ``raw_tf`` repeats a row for each of its ``n_spans``."""
    occ = occurrences.select("candidate", "row_id", "n_spans")
    if raw_tf:
        occ = occ.select("candidate", "row_id", F.explode(F.sequence(F.lit(1), F.col("n_spans").cast("int"))).alias("_k"))
    return occ.join(listed.select("candidate", "candidate_id"), "candidate").select("candidate_id", "row_id")


def chunk_candidates(occurrences: DataFrame) -> DataFrame:
    """``chunk_id, n_candidates``: distinct forms found in each chunk."""
    return occurrences.groupBy("chunk_id").agg(F.count_distinct("candidate").alias("n_candidates"))

"""Canonical (document, candidate) table, TF-IDF, semantic scores, ranks within documents."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import RankConfig
from ..functions.embedding import Embedder, get_embedder
from ..functions.text import format_documents, is_blank
from ..functions.vectors import dot
from ..plans.storage import materialize
from ..sources.chunks import ChunkStore, assign_chunks
from .balanced import dense_ids, heavy_keys, running_sums, spread_join

RANKED_COLUMNS = ("row_id", "candidate", "surface_form", "extraction_source", "tf", "df", "idf", "tfidf_score", "semantic_score", "rank_tfidf", "rank_semantic")


def unique_candidates(listed: DataFrame) -> DataFrame:
    """One row per ``candidate_id`` (the least of differing repeats), without null and blank candidates."""
    rest = [c for c in ("surface_form", "extraction_source") if c in listed.columns]
    one = listed.filter(F.col("candidate_id").isNotNull()).groupBy("candidate_id").agg(F.min(F.struct("candidate", *rest)).alias("_c"))
    return one.select("candidate_id", "_c.*").filter(~is_blank(F.col("candidate")))


def canonical(mapping: DataFrame, listed: DataFrame) -> DataFrame:
    """``row_id, candidate_id, tf`` and the list's columns: one row per pair whose candidate is listed.

    Rows without a ``row_id`` are dropped before counting; unknown documents stay. Pairs fold map-side before the
    shuffle; the join to the list runs on folded pairs, and cuts hot candidates in parts.
    """
    tf = mapping.filter(F.col("row_id").isNotNull() & F.col("candidate_id").isNotNull()).groupBy("candidate_id", "row_id").agg(F.count(F.lit(1)).alias("tf"))
    return spread_join(tf, unique_candidates(listed), "candidate_id", "row_id", mapping)


def compute_tfidf(canon: DataFrame, smoothed: bool = True, check_empty: bool = False) -> DataFrame:
    """Adds ``df`` (distinct documents of the candidate string), ``idf`` and ``tfidf_score``.

    Smoothed: ``ln((N+1)/(df+1)) + 1``; plain: ``ln(N/df) + 1``; N is the number of distinct documents. An empty table
    stays empty; with ``check_empty`` it raises ``ValueError``.
    """
    if check_empty and canon.isEmpty():
        raise ValueError("no (document, candidate) pair: N would be 0")
    per = canon.groupBy("candidate", "row_id").agg(F.count(F.lit(1)).alias("_k")).groupBy("candidate").agg(F.count(F.lit(1)).alias("df"))
    n = canon.agg(F.count_distinct("row_id").alias("_n"))
    out = canon.join(per, "candidate").withColumn("_n", n.scalar())
    ratio = (F.col("_n") + 1) / (F.col("df") + 1) if smoothed else F.col("_n") / F.col("df")
    idf = F.log(ratio) + 1
    return out.withColumn("idf", idf).withColumn("tfidf_score", F.col("tf") * F.col("idf")).drop("_n")


def rank_within(df: DataFrame, score: str, name: str, key: str = "row_id", digits: int = 9, heavy: Collection = ()) -> DataFrame:
    """Adds ``name``: standard competition rank of ``score`` (descending, at ``digits`` decimals) within ``key``.

    NaN and null scores share the last place. Keys in ``heavy`` are not ranked by a window, which would bring each into one
    task: their distinct scores are counted, summed up over range partitions, and joined back. With heavy keys ``df``
    should be a written table, because it is read several times.
    """
    s = F.col(score).cast("double")
    clean = F.round(F.when(~F.isnan(s), s), digits)
    ranked = lambda x: x.withColumn(name, F.rank().over(Window.partitionBy(key).orderBy(clean.desc_nulls_last())))
    if not heavy:
        return ranked(df)
    hot = F.coalesce(F.col(key).isin(*heavy), F.lit(False))
    many = df.filter(hot).withColumn("_o", F.coalesce(-clean, F.lit(float("inf"))))  # ascending order is best first
    counts = many.groupBy(key, "_o").agg(F.count(F.lit(1)).alias("_m"))
    places = running_sums(counts, key, ["_o"], "_m", "_to").select(key, "_o", (F.col("_to") - F.col("_m") + 1).cast("int").alias(name))
    return ranked(df.filter(~hot)).unionByName(many.join(places, [key, "_o"]).drop("_o"))


def semantic_scores(canon: DataFrame, documents: DataFrame, embedder: Embedder | None = None) -> DataFrame:
    """Adds ``semantic_score`` (float): dot product of the unit vectors of candidate and document text.

    Each distinct candidate and each document in use is embedded once. A document that is unknown or empty has the zero
    vector, so its score is 0. ``documents`` holds ``row_id, doc_text``; of a repeated id the greatest text counts.
    """
    embedder = embedder or get_embedder()
    cands = canon.select("candidate").distinct().withColumn("_cv", embedder.embed(F.col("candidate")))
    used = documents.join(canon.select("row_id").distinct(), "row_id", "left_semi").groupBy("row_id").agg(F.max("doc_text").alias("doc_text"))
    docs = used.withColumn("_dv", embedder.embed(F.col("doc_text"))).drop("doc_text")
    # Documents last: the dot product follows at once, and ranks within documents reuse that partitioning.
    out = canon.join(cands, "candidate").join(docs, "row_id", "left")
    return out.withColumn("semantic_score", F.coalesce(dot(F.col("_cv"), F.col("_dv")), F.lit(0.0)).cast("float")).drop("_cv", "_dv")


def semantic_scores_chunked(canon: DataFrame, documents: DataFrame, store: ChunkStore, chunk_size: int, embedder: Embedder | None = None) -> DataFrame:
    """:func:`semantic_scores` in resumable chunks of ``chunk_size`` documents: finished chunks of ``store`` are kept.

    All unfinished chunks are computed in one job, whatever their number. Scores are stored by (document, candidate id)
    and joined back. ``canon`` is read several times, so it should be a written table.
    """
    ids = assign_chunks(canon.select("row_id").distinct(), "row_id", chunk_size)
    todo = store.pending(sorted(r["chunk_id"] for r in ids.select("chunk_id").distinct().collect()))  # a row for each chunk
    if todo:
        done = canon.sparkSession.createDataFrame([(x,) for x in sorted(store.completed)], "chunk_id STRING")
        mine = (ids.join(done, "chunk_id", "left_anti") if store.completed else ids).select("row_id", "chunk_id")
        part = canon.select("row_id", "candidate_id", "candidate").join(mine, "row_id")
        store.save_all(todo, semantic_scores(part, documents, embedder).select("row_id", "candidate_id", "semantic_score", "chunk_id"))
    kind = canon.schema["row_id"].dataType.simpleString()
    saved = store.load_all(canon.sparkSession, f"row_id {kind}, candidate_id BIGINT, semantic_score FLOAT").select("row_id", "candidate_id", "semantic_score")
    return canon.join(saved, ["row_id", "candidate_id"], "left")


def unknown_documents(canon: DataFrame, documents: DataFrame) -> DataFrame:
    """Document ids of pairs for which no document exists."""
    return canon.select("row_id").distinct().join(documents.select("row_id"), "row_id", "left_anti")


def known_documents(documents: DataFrame, canon: DataFrame) -> DataFrame:
    """Documents that occur in some pair."""
    return documents.join(canon.select("row_id").distinct(), "row_id", "left_semi")


def rank_candidates(mapping: DataFrame, listed: DataFrame, documents: DataFrame, cfg: RankConfig = RankConfig(), store: ChunkStore | None = None) -> DataFrame:
    """The whole ranking: canonical pairs, TF-IDF, semantic score, both ranks, columns in their fixed order.

    With ``store`` the semantic scores are computed in resumable chunks of ``cfg.doc_chunk_size`` documents.
    """
    texts = format_documents(documents, cfg.format_mode, **({"cls_token": cfg.cls_token, "sep_token": cfg.sep_token} if cfg.format_mode == "cls_sep" else {}))
    # Read for df, N, the candidates and the documents in use: written once instead of computed each time.
    canon = materialize(canonical(mapping, listed), "canonical")
    weighted, embedder = compute_tfidf(canon, cfg.smoothed_idf), get_embedder(cfg.embedder, model_name=cfg.model_name)
    if store is not None and cfg.doc_chunk_size:
        scored = semantic_scores_chunked(materialize(weighted, "weighted"), texts, store, cfg.doc_chunk_size, embedder)
    else:
        scored = semantic_scores(weighted, texts, embedder)
    heavy = heavy_keys(canon, "row_id")
    if heavy:
        scored = materialize(scored, "scored")
    ranked = rank_within(scored, "tfidf_score", "rank_tfidf", heavy=heavy)
    ranked = rank_within(materialize(ranked, "ranked") if heavy else ranked, "semantic_score", "rank_semantic", heavy=heavy)
    return ranked.select(*RANKED_COLUMNS, *[c for c in ranked.columns if c not in RANKED_COLUMNS])


def in_rank_order(ranked: DataFrame) -> DataFrame:
    """``ranked`` with ``place`` from 1, in the order of document, TF-IDF rank and candidate id, by a range-partitioned sort."""
    return dense_ids(ranked, ["row_id", "rank_tfidf", "candidate_id"], "place", 1)


def score_ranges(ranked: DataFrame) -> DataFrame:
    """Least and greatest of both scores, pairs and distinct documents and candidates, in one pass."""
    return ranked.agg(
        F.min("tfidf_score").alias("min_tfidf"), F.max("tfidf_score").alias("max_tfidf"), F.min("semantic_score").alias("min_semantic"), F.max("semantic_score").alias("max_semantic"),
        F.count(F.lit(1)).alias("n_pairs"), F.count_distinct("row_id").alias("n_documents"), F.count_distinct("candidate").alias("n_candidates"),
    )

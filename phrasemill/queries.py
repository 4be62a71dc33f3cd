"""Named queries over the test tables, each a ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import ExtractConfig, RankConfig
from .functions.text import block_key, format_documents, get_formatter
from .operators import balanced, cluster, components, coverage, dictionary, extract, ranking
from .plans.session import read_table, spread
from .plans.storage import materialize, new_path
from .sources.chunks import ChunkStore, assign_chunks
from .sources.tables import latest_revision, load_blacklist, load_candidates_list, load_candidates_mapping, load_clusters, load_source_documents, write_clusters, write_table
from .streaming.extract_stream import stream_occurrences

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
#: The shipped configuration leaves n-grams off.
CFG = ExtractConfig(use_ngram_backoff=False)
BLACKLIST = sorted(
    {x.strip().lower() for x in (Path(__file__).parent / "sources/blacklist.txt").read_text().splitlines() if x.strip() and x[0] != "#"}
)
CLUSTER_THRESHOLD, EMBEDDING_THRESHOLD, BLOCK_CAP, CHUNK = 0.85, 0.3, 2000, 500
#: Cap of the queries that show what a cap leaves out.
SMALL_CAP = 50


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def plain(df: DataFrame) -> DataFrame:
    """Integers as BIGINT, floats as DOUBLE at six decimals: the types in which results are compared."""

    def as_plain(name: str, kind: str) -> Column:
        if kind in ("int", "smallint", "tinyint"):
            return F.col(name).cast("bigint").alias(name)
        return F.round(F.col(name).cast("double"), 6).alias(name) if kind in ("float", "double") else F.col(name)

    return df.select(*[as_plain(n, k) for n, k in df.dtypes])


def documents(spark: SparkSession, d: str) -> DataFrame:
    return latest_revision(spread(read_table(spark, d, "source_docs", "row_id", "title", "abstract", "loaded_at")))


def blacklist(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(x,) for x in BLACKLIST], "candidate STRING")


def occurrences(spark: SparkSession, d: str) -> DataFrame:
    return extract.extract(documents(spark, d), CFG, blacklist(spark))


@query
def q_sections(spark, d):
    return plain(extract.sections(documents(spark, d)).select("row_id", "source_section", "text"))


@query
def q_tokens(spark, d):
    t = extract.tokens(documents(spark, d), CFG)
    return plain(t.select("row_id", "source_section", F.array_join("toks", " ").alias("tokens"), "cls", F.size("toks").alias("n_tokens")))


def _spans(spark, d, name):
    cfg = ExtractConfig(use_noun_chunks=name == "noun_chunk", use_dependency_phrases=name == "dep_phrase", use_ngram_backoff=name == "ngram")
    return plain(extract.spans(documents(spark, d), cfg))


@query
def q_noun_chunks(spark, d):
    return _spans(spark, d, "noun_chunk")


@query
def q_dep_phrases(spark, d):
    return _spans(spark, d, "dep_phrase")


@query
def q_ngrams(spark, d):
    return _spans(spark, d, "ngram")


@query
def q_trim_filter(spark, d):
    k = extract.kept_spans(documents(spark, d), CFG)
    return plain(k.select("row_id", "source_section", "source", "span_ord", "surface_form", "candidate"))


@query
def q_normalize_lemma(spark, d):
    cfg = ExtractConfig(use_ngram_backoff=False, normalization_mode="lemma", apply_light_lemmatization=True)
    k = extract.kept_spans(documents(spark, d), cfg)
    return plain(k.select("row_id", "source_section", "source", "span_ord", "surface_form", "candidate"))


@query
def q_blacklist(spark, d):
    k = extract.kept_spans(documents(spark, d), CFG, blacklist(spark))
    return plain(k.groupBy("candidate").agg(F.count(F.lit(1)).alias("n_spans")))


@query
def q_extract(spark, d):
    return plain(occurrences(spark, d).select("row_id", "candidate", "surface_form", "source_section", "extraction_source", "n_spans"))


@query
def q_explain_spans(spark, d):
    x = extract.explain_spans(documents(spark, d), CFG, blacklist(spark))
    return plain(x.groupBy("source", "outcome").agg(F.count(F.lit(1)).alias("n_spans")))


@query
def q_explain_rows(spark, d):
    """Every raw span with its form and what became of it."""
    x = extract.explain_spans(documents(spark, d), CFG, blacklist(spark))
    return plain(x.select("row_id", "source_section", "source", "span_ord", "candidate", "outcome"))


@query
def q_extract_once(spark, d):
    """Extraction without ``keep_duplicates``: a form counts once in a section."""
    cfg = ExtractConfig(use_ngram_backoff=False, keep_duplicates=False)
    occ = extract.extract(documents(spark, d), cfg, blacklist(spark))
    return plain(occ.groupBy("candidate").agg(F.count(F.lit(1)).alias("n_sections"), F.sum("n_spans").alias("n_spans")))


@query
def q_chunk_candidates(spark, d):
    """Distinct candidates of each chunk of documents."""
    chunks = assign_chunks(documents(spark, d).select("row_id"), "row_id", CHUNK).select("row_id", "chunk_id")
    return plain(dictionary.chunk_candidates(occurrences(spark, d).join(chunks, "row_id")))


@query
def q_candidates_list(spark, d):
    return plain(dictionary.candidates_list(occurrences(spark, d)))


@query
def q_candidates_mapping(spark, d):
    occ = materialize(occurrences(spark, d), "occurrences")
    return plain(dictionary.candidates_mapping(occ, dictionary.candidates_list(occ)))


@query
def q_extracted_tfidf(spark, d):
    """The flagship: extraction through TF-IDF to ranks within documents."""
    occ = occurrences(spark, d)
    tf = materialize(occ.groupBy("row_id", "candidate").agg(F.count(F.lit(1)).alias("tf")), "counts")  # read for df, N and the scores
    out = ranking.rank_within(ranking.compute_tfidf(tf), "tfidf_score", "rank_tfidf")
    return plain(out.select("row_id", "candidate", "tf", "df", "idf", "tfidf_score", "rank_tfidf"))


def _tables(spark, d):
    return read_table(spark, d, "candidates_mapping", "candidate_id", "row_id"), read_table(spark, d, "candidates_list")


@query
def q_canonical(spark, d):
    return plain(ranking.canonical(*_tables(spark, d)).select("row_id", "candidate_id", "candidate", "surface_form", "extraction_source", "tf"))


def _tfidf(spark, d, smoothed):
    out = ranking.compute_tfidf(ranking.canonical(*_tables(spark, d)), smoothed)
    return plain(out.select("row_id", "candidate_id", "tf", "df", "idf", "tfidf_score"))


@query
def q_tfidf_smooth(spark, d):
    return _tfidf(spark, d, True)


@query
def q_tfidf_raw(spark, d):
    return _tfidf(spark, d, False)


@query
def q_rank_tfidf(spark, d):
    out = ranking.compute_tfidf(ranking.canonical(*_tables(spark, d)))
    return plain(ranking.rank_within(out, "tfidf_score", "rank_tfidf").select("row_id", "candidate_id", "tfidf_score", "rank_tfidf"))


@query
def q_ranked_candidates(spark, d):
    return plain(ranking.rank_candidates(*_tables(spark, d), documents(spark, d), RankConfig()))


@query
def q_ranking_order(spark, d):
    """The ranking in the order of document, rank and candidate."""
    ranked = ranking.rank_within(ranking.compute_tfidf(ranking.canonical(*_tables(spark, d))), "tfidf_score", "rank_tfidf")
    return plain(ranking.in_rank_order(ranked.select("row_id", "candidate_id", "rank_tfidf")).select("place", "row_id", "candidate_id", "rank_tfidf"))


@query
def q_score_ranges(spark, d):
    return plain(ranking.score_ranges(ranking.rank_candidates(*_tables(spark, d), documents(spark, d), RankConfig())))


@query
def q_format_cls_sep(spark, d):
    return format_documents(documents(spark, d), "cls_sep")


@query
def q_format_plain(spark, d):
    docs = documents(spark, d)
    return docs.select("row_id", get_formatter("plain")(F.col("title"), F.col("abstract")).alias("doc_text"))


@query
def q_semi_known(spark, d):
    return ranking.known_documents(documents(spark, d).select("row_id"), ranking.canonical(*_tables(spark, d)))


@query
def q_anti_unknown(spark, d):
    return ranking.unknown_documents(ranking.canonical(*_tables(spark, d)), documents(spark, d))


@query
def q_mapping_counts(spark, d):
    m = _tables(spark, d)[0]
    return m.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(F.struct("candidate_id", "row_id")).alias("n_pairs"))


def _candidates(spark, d):
    return cluster.ordered_candidates(read_table(spark, d, "candidates_list", "candidate_id", "candidate"))


@query
def q_lemma_groups(spark, d):
    return plain(cluster.lemma_groups(_candidates(spark, d)))


@query
def q_blocks(spark, d):
    return plain(cluster.block_sizes(_candidates(spark, d)))


@query
def q_candidate_edges(spark, d):
    vecs = cluster.embed_candidates(_candidates(spark, d)).withColumn("block", block_key(F.col("candidate")))
    return plain(cluster.similarity_edges(vecs, CLUSTER_THRESHOLD, BLOCK_CAP))


@query
def q_candidate_edges_exact(spark, d):
    vecs = cluster.embed_candidates(_candidates(spark, d)).withColumn("block", block_key(F.col("candidate")))
    return plain(cluster.exact_similarity_edges(vecs, CLUSTER_THRESHOLD))


@query
def q_skipped_blocks(spark, d):
    """What the cap of the other queries leaves out."""
    cands = _candidates(spark, d).withColumn("block", block_key(F.col("candidate")))
    each = [cluster.skipped_blocks(x, BLOCK_CAP).select(F.lit(n).alias("blocks_of"), "*") for n, x in (("candidates", cands), ("embeddings", _embeddings(spark, d)))]
    return plain(each[0].union(each[1]))


def _embeddings(spark, d):
    e = read_table(spark, d, "embeddings", "vec_id", "embedding", "label")
    return e.select(F.col("vec_id").alias("ord"), F.col("label").cast("string").alias("block"), F.col("embedding").alias("vec"))


@query
def q_similarity_edges(spark, d):
    return plain(cluster.similarity_edges(_embeddings(spark, d), EMBEDDING_THRESHOLD, BLOCK_CAP))


@query
def q_block_cap(spark, d):
    return plain(cluster.similarity_edges(_embeddings(spark, d), EMBEDDING_THRESHOLD, SMALL_CAP))


@query
def q_block_cap_skipped(spark, d):
    """The blocks that :func:`q_block_cap` leaves out, with their sizes."""
    return plain(cluster.oversize_blocks(_embeddings(spark, d), SMALL_CAP))


@query
def q_block_cap_candidates(spark, d):
    """The small cap over first-token blocks, whose sizes lie on both sides of it at every scale."""
    vecs = cluster.embed_candidates(_candidates(spark, d)).withColumn("block", block_key(F.col("candidate")))
    return plain(cluster.similarity_edges(vecs, CLUSTER_THRESHOLD, SMALL_CAP))


@query
def q_components(spark, d):
    return components.connected_components(cluster.similarity_edges(_embeddings(spark, d), EMBEDDING_THRESHOLD, BLOCK_CAP))


@query
def q_similarity_edges_exact(spark, d):
    return plain(cluster.exact_similarity_edges(_embeddings(spark, d), EMBEDDING_THRESHOLD))


@query
def q_components_exact(spark, d):
    return components.connected_components(cluster.exact_similarity_edges(_embeddings(spark, d), EMBEDDING_THRESHOLD, spanning=True))


@query
def q_cluster_exact(spark, d):
    listed = read_table(spark, d, "candidates_list", "candidate_id", "candidate")
    return plain(cluster.cluster_candidates(listed, CLUSTER_THRESHOLD, None))


@query
def q_cluster_full(spark, d):
    listed = read_table(spark, d, "candidates_list", "candidate_id", "candidate")
    return plain(cluster.cluster_candidates(listed, CLUSTER_THRESHOLD, BLOCK_CAP))


def _clusters(spark, d):
    return read_table(spark, d, "candidate_clusters")


@query
def q_cluster_doc_counts(spark, d):
    return plain(coverage.cluster_doc_counts(_tables(spark, d)[0], _clusters(spark, d)))


@query
def q_top_clusters(spark, d):
    return plain(coverage.top_clusters(coverage.cluster_doc_counts(_tables(spark, d)[0], _clusters(spark, d)), 20))


@query
def q_largest_clusters(spark, d):
    return plain(coverage.largest_clusters(_clusters(spark, d), 10))


@query
def q_cluster_size_dist(spark, d):
    return plain(coverage.cluster_size_distribution(_clusters(spark, d)))


@query
def q_cluster_summary(spark, d):
    return plain(coverage.cluster_summary(_clusters(spark, d)))


@query
def q_matching_candidates(spark, d):
    return plain(coverage.matching_candidates(_clusters(spark, d), "^batter"))


@query
def q_chunk_assign(spark, d):
    return plain(assign_chunks(documents(spark, d).select("row_id"), "row_id", CHUNK))


@query
def q_resume_pending(spark, d):
    done = spark.createDataFrame([("chunk_0000",), ("chunk_0002",)], "chunk_id STRING")
    return plain(assign_chunks(documents(spark, d).select("row_id"), "row_id", CHUNK).join(done, "chunk_id", "left_anti").select("row_id", "chunk_no", "chunk_id"))


def _written(spark, df, label, writer=write_table, suffix=".csv"):
    """Path of ``df`` as a sink leaves it in the shared folder."""
    return writer(df, new_path(spark, label) + suffix)


@query
def q_source_documents(spark, d):
    docs = load_source_documents(spark, f"{d}/source_docs.parquet", "row_id", "title", "abstract")
    return docs.select("row_id", "title", "abstract", "office")


@query
def q_csv_list(spark, d):
    """The dictionary through its CSV sink and scan: literal words, quotes and commas stay."""
    return load_candidates_list(spark, _written(spark, read_table(spark, d, "candidates_list"), "list"))


@query
def q_csv_mapping(spark, d):
    """The mapping through CSV under other column names; document ids come back as text."""
    other = read_table(spark, d, "candidates_mapping", "candidate_id", "row_id").withColumnsRenamed({"candidate_id": "cid", "row_id": "doc"})
    return load_candidates_mapping(spark, _written(spark, other, "mapping"), {"candidate_id": "cid", "row_id": "doc"})


@query
def q_csv_clusters(spark, d):
    return load_clusters(spark, _written(spark, _clusters(spark, d).withColumn("more", F.lit(1)), "clusters", write_clusters))


@query
def q_sorted_counts(spark, d):
    """Document counts through the sorted sink, read back by part file and row."""
    counts = coverage.cluster_doc_counts(_tables(spark, d)[0], _clusters(spark, d)).orderBy(F.desc("doc_count"), "cluster_id")
    lines = spark.read.parquet(_written(spark, counts.select("cluster_id", "doc_count"), "counts", suffix=".parquet"))
    placed = balanced.dense_ids(lines.select("*", "_metadata.file_name", "_metadata.row_index"), ["file_name", "row_index"], "place", 1)
    return plain(placed.select("place", "cluster_id", "doc_count"))


@query
def q_blacklist_file(spark, d):
    path = new_path(spark, "blacklist")
    spark.createDataFrame([("# a comment",), ("",), *((f" {x.upper()} ",) for x in BLACKLIST)], "line STRING").write.text(path)
    return load_blacklist(spark, path)


@query
def q_chunk_store(spark, d):
    """Chunks saved by an interrupted and a second run, and read back together."""
    chunks = assign_chunks(documents(spark, d).select("row_id"), "row_id", CHUNK).select("row_id", "chunk_id")
    names, path = sorted(r[0] for r in chunks.select("chunk_id").distinct().collect()), new_path(spark, "chunks")
    ChunkStore(path, "q", spark).save_all(names[:1], chunks.filter(F.col("chunk_id") == names[0]) if names else chunks)
    again = ChunkStore(path, "q", spark)
    again.save_all(again.pending(names), chunks.filter(F.col("chunk_id").isin(again.pending(names))))
    return ChunkStore(path, "q", spark).load_all(spark, "row_id BIGINT")


@query
def q_ranked_chunked(spark, d):
    """The ranking with semantic scores from a chunk store."""
    store = ChunkStore(new_path(spark, "semantic"), "q", spark)
    return plain(ranking.rank_candidates(*_tables(spark, d), documents(spark, d), RankConfig(doc_chunk_size=CHUNK), store))


@query
def q_streamed_extract(spark, d):
    """Extraction over a stream of the documents' files."""
    source, out, schema = new_path(spark, "stream"), new_path(spark, "occurrences"), "row_id BIGINT, title STRING, abstract STRING"
    documents(spark, d).select("row_id", "title", "abstract").write.parquet(source)
    listed = new_path(spark, "blacklist")
    blacklist(spark).write.text(listed)
    cfg = ExtractConfig(use_ngram_backoff=False, blacklist_path=listed)
    stream_occurrences(spark, source, schema, out, new_path(spark, "progress"), cfg).awaitTermination()
    return plain(spark.read.parquet(out).select("row_id", "candidate", "surface_form", "source_section", "extraction_source", "n_spans"))


@query
def p1_found(spark, d):
    return coverage.wrong_doc_counts(read_table(spark, d, "cluster_doc_counts", "cluster_id", "doc_count"), _tables(spark, d)[0], read_table(spark, d, "candidate_clusters", "candidate_id", "cluster_id"))


@query
def p1_candidate_counts(spark, d):
    return balanced.distinct_counts(_tables(spark, d)[0], "candidate_id", "row_id")


@query
def p1_doc_ordinals(spark, d):
    return balanced.running_counts(_tables(spark, d)[0], "candidate_id", "row_id")

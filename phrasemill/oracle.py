"""The same queries in SQL, for comparison on the same tables."""

from __future__ import annotations

from .functions.tokens import ADJECTIVE_ENDING, NUMBER_WORDS, STOP_WORDS, TOKEN, VERB_ENDING, VERBS
from .queries import BLACKLIST, BLOCK_CAP, CHUNK, CLUSTER_THRESHOLD, EMBEDDING_THRESHOLD, SMALL_CAP


def _in(words) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


DOCS = r"""docs AS (SELECT row_id, title, abstract FROM (
  SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY loaded_at DESC NULLS LAST, coalesce(abstract, '') DESC, coalesce(title, '') DESC) AS rn
  FROM source_docs WHERE row_id IS NOT NULL) WHERE rn = 1)"""
STRIP = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
SECTIONS = (
    DOCS
    + r""", sections AS (
  SELECT row_id, 0 AS section_ord, 'title' AS source_section, """ + STRIP.format("title") + r""" AS text FROM docs WHERE regexp_matches(title, '\S')
  UNION ALL
  SELECT row_id, 1, 'abstract', """ + STRIP.format("abstract") + r""" FROM docs WHERE regexp_matches(abstract, '\S'))"""
)
LEMMA = r"""CASE WHEN regexp_matches(lower({0}), '[^ea]ies$') THEN regexp_replace(lower({0}), 'ies$', 'y')
  WHEN regexp_matches(lower({0}), '[^aeo]es$') THEN regexp_replace(lower({0}), 'es$', 'e')
  WHEN regexp_matches(lower({0}), '[^us]s$') THEN regexp_replace(lower({0}), 's$', '') ELSE lower({0}) END"""
TOKENS = (
    SECTIONS
    + rf""", tokd AS (SELECT *, regexp_extract_all(text, '{TOKEN}') AS toks FROM sections),
  tok AS (SELECT *, array_to_string(list_transform(toks, lambda w: CASE
    WHEN regexp_matches(w, '^[^\p{{L}}0-9]') THEN 'P'
    WHEN regexp_matches(w, '^[0-9]') OR lower(w) IN {_in(NUMBER_WORDS)} THEN 'D'
    WHEN lower(w) IN {_in(STOP_WORDS)} THEN 'S'
    WHEN lower(w) IN {_in(VERBS)} OR (length(w) > 4 AND regexp_matches(lower(w), '{VERB_ENDING}')) THEN 'V'
    WHEN length(w) > 4 AND regexp_matches(lower(w), '{ADJECTIVE_ENDING}') THEN 'A' ELSE 'N' END), '') AS cls FROM tokd)"""
)
ORD = "row_number() OVER (PARTITION BY row_id, section_ord ORDER BY {0}) - 1"
SPANS = (
    TOKENS
    + f""", pos AS MATERIALIZED (SELECT *, unnest(range(1, length(cls) + 1)) AS i FROM tok),
  nc AS (SELECT *, {ORD.format('st')} AS span_ord FROM (
    SELECT row_id, section_ord, source_section, toks, cls, 0 AS source_ord, 'noun_chunk' AS source, i AS st, length(regexp_extract(substr(cls, i), '^[AN]*N')) AS n
    FROM pos WHERE substr(cls, i, 1) IN ('A', 'N') AND (i = 1 OR substr(cls, i - 1, 1) NOT IN ('A', 'N'))) WHERE n > 0),
  dp AS (SELECT row_id, section_ord, source_section, toks, cls, 1 AS source_ord, 'dep_phrase' AS source, i - m AS st, m + 1 AS n, {ORD.format('i')} AS span_ord FROM (
    SELECT *, length(regexp_extract(substr(cls, greatest(1, i - 4), least(i - 1, 4)), '[AN]+$')) AS m FROM pos WHERE substr(cls, i, 1) = 'N') WHERE m >= 1 AND m < 4),
  ng AS (SELECT row_id, section_ord, source_section, toks, cls, 2 AS source_ord, 'ngram' AS source, i AS st, n, {ORD.format('n, i')} AS span_ord
    FROM pos, (VALUES (2), (3)) AS s(n) WHERE i + n - 1 <= length(cls) AND contains(substr(cls, i, n), 'N')),
  span AS (SELECT * FROM nc UNION ALL BY NAME SELECT * FROM dp),
  cut AS (SELECT *, st + length(c) - length(ltrim(c, 'SP')) AS st2, trim(c, 'SP') AS core FROM (SELECT *, substr(cls, st, n) AS c FROM span)),
  worded AS (SELECT *, array_to_string(toks[st2:st2 + length(core) - 1], ' ') AS surface_form, lower(array_to_string(toks[st2:st2 + length(core) - 1], ' ')) AS candidate,
    array_to_string(list_transform(list_zip(toks[st2:st2 + length(core) - 1], str_split(core, '')), lambda p: CASE WHEN p[2] IN ('A', 'N') THEN {LEMMA.format('p[1]')} ELSE lower(p[1]) END), ' ') AS lemma_candidate FROM cut),
  kept AS (SELECT * FROM worded WHERE contains(core, 'N') AND length(core) BETWEEN 1 AND 4 AND NOT contains(core, 'P') AND candidate <> '')"""
)
OCC = (
    SPANS
    + f""", occ AS MATERIALIZED (SELECT row_id, candidate, arg_min(surface_form, source_ord * 1000000 + span_ord) AS surface_form, source_section, section_ord,
    array_to_string(list_sort(list_distinct(list(source))), '|') AS extraction_source, min(source_ord * 1000000 + span_ord) AS first_at, count(*) AS n_spans
    FROM kept WHERE candidate NOT IN {_in(BLACKLIST)} GROUP BY row_id, candidate, source_section, section_ord)"""
)
LISTED = (
    OCC
    + """, firsts AS (SELECT *, row_number() OVER (PARTITION BY candidate ORDER BY section_ord, row_id, first_at) AS rn FROM occ),
  listed AS (SELECT row_number() OVER (ORDER BY section_ord, row_id, first_at, candidate) - 1 AS candidate_id, candidate, surface_form, extraction_source FROM firsts WHERE rn = 1)"""
)
CANON = r"""uniq AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY candidate_id ORDER BY candidate NULLS FIRST, surface_form NULLS FIRST, extraction_source NULLS FIRST) AS rn
    FROM candidates_list WHERE candidate_id IS NOT NULL) WHERE rn = 1 AND regexp_matches(candidate, '\S')),
  canon AS (SELECT row_id, candidate_id, candidate, surface_form, extraction_source, tf FROM (
    SELECT candidate_id, row_id, count(*) AS tf FROM candidates_mapping WHERE row_id IS NOT NULL GROUP BY ALL) JOIN uniq USING (candidate_id))"""
DF = """dfs AS (SELECT candidate, count(DISTINCT row_id) AS df FROM canon GROUP BY 1), nn AS (SELECT count(DISTINCT row_id) AS n FROM canon)"""
TFIDF = CANON + ", " + DF + """, tfidf AS (SELECT *, tf * idf AS tfidf_score FROM (
    SELECT canon.*, df, ln((n + 1) / (df + 1)) + 1 AS idf FROM canon JOIN dfs USING (candidate), nn))"""
CLS_SEP = (
    r"""CASE WHEN t = '' AND a = '' THEN '' WHEN a = '' THEN '[CLS] ' || t WHEN t = '' THEN '[CLS] [SEP] ' || a ELSE '[CLS] ' || t || ' [SEP] ' || a END"""
)
TEXTS = DOCS + f""", texts AS (SELECT row_id, {CLS_SEP} AS doc_text, CASE WHEN t <> '' AND a <> '' THEN t || '. ' || a ELSE t || a END AS plain_text FROM (
    SELECT row_id, coalesce({STRIP.format('title')}, '') AS t, coalesce({STRIP.format('abstract')}, '') AS a FROM docs))"""


def _vectors(name: str, source: str, key: str, text: str) -> str:
    """CTEs ``name``: (key, bucket, w), the hashed trigram vector in sparse form."""
    return f"""{name}_g AS (SELECT {key}, low, unnest(range(1, length(low) - 1)) AS i FROM (SELECT {key}, lower({text}) AS low FROM {source}) WHERE length(low) >= 3),
  {name}_c AS (SELECT {key}, CAST('0x' || substr(md5(substr(low, i, 3)), 1, 8) AS BIGINT) % 64 AS bucket, count(*) AS n FROM {name}_g GROUP BY ALL),
  {name} AS (SELECT {key}, bucket, n / sqrt(sum(n * n) OVER (PARTITION BY {key})) AS w FROM {name}_c)"""


RANKED = (
    "WITH " + TFIDF + ", " + TEXTS + ", cand AS (SELECT DISTINCT candidate FROM canon), " + _vectors("cv", "cand", "candidate", "candidate") + ", " + _vectors("dv", "texts", "row_id", "doc_text")
    + """, sem AS (SELECT canon.row_id, canon.candidate_id, sum(cv.w * dv.w) AS s FROM canon JOIN cv USING (candidate) JOIN dv ON dv.row_id = canon.row_id AND dv.bucket = cv.bucket GROUP BY ALL),
  ranked AS (SELECT row_id, candidate, surface_form, extraction_source, tf, df, round(idf, 6) AS idf, round(tfidf_score, 6) AS tfidf_score,
    round(CAST(CAST(coalesce(s, 0) AS FLOAT) AS DOUBLE), 6) AS semantic_score,
    rank() OVER (PARTITION BY row_id ORDER BY round(tfidf_score, 9) DESC) AS rank_tfidf,
    rank() OVER (PARTITION BY row_id ORDER BY round(CAST(CAST(coalesce(s, 0) AS FLOAT) AS DOUBLE), 9) DESC) AS rank_semantic, candidate_id
    FROM tfidf LEFT JOIN sem USING (row_id, candidate_id))"""
)
CANDS = "cands AS (SELECT candidate, min(candidate_id) AS ord FROM candidates_list WHERE candidate IS NOT NULL AND candidate_id IS NOT NULL GROUP BY 1)"
BLOCK = r"coalesce(nullif(split_part(trim(regexp_replace(candidate, '\s+', ' ', 'g')), ' ', 1), ''), '__empty__')"
LEMMAS = CANDS + rf""", lem AS (SELECT candidate, ord, array_to_string(list_transform(regexp_extract_all(candidate, '{TOKEN}'), lambda w: {LEMMA.format('w')}), ' ') AS lemma FROM cands),
  lemg AS (SELECT *, min(ord) OVER (PARTITION BY lemma) AS group_ord FROM lem)"""
CEDGES = (
    LEMMAS + f", blk AS (SELECT candidate, ord, {BLOCK} AS block FROM cands), " + _vectors("cv", "cands", "candidate", "candidate")
    + f""", okb AS (SELECT block FROM blk GROUP BY 1 HAVING count(*) BETWEEN 2 AND {BLOCK_CAP}),
  vb AS (SELECT ord, block, bucket, w FROM blk JOIN okb USING (block) JOIN cv USING (candidate)),
  ce AS (SELECT a.ord AS u, b.ord AS v, round(sum(a.w * b.w), 9) AS similarity FROM vb a JOIN vb b ON a.block = b.block AND a.bucket = b.bucket AND a.ord < b.ord GROUP BY ALL HAVING round(sum(a.w * b.w), 9) >= {CLUSTER_THRESHOLD})"""
)
EEDGES = """eb AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings),
  okb AS (SELECT label FROM eb GROUP BY 1 HAVING count(*) BETWEEN 2 AND {cap}),
  ee AS (SELECT a.vec_id AS u, b.vec_id AS v, round(list_dot_product(a.vec, b.vec), 9) AS similarity FROM eb a JOIN eb b ON a.label = b.label AND a.vec_id < b.vec_id JOIN okb ON okb.label = a.label
    WHERE round(list_dot_product(a.vec, b.vec), 9) >= {t})"""
ECOMP = """both_ AS (SELECT u, v FROM {e} UNION SELECT v, u FROM {e}),
  reach AS (SELECT DISTINCT u AS node, u AS root FROM both_ UNION SELECT r.node, b.v FROM reach r JOIN both_ b ON b.u = r.root),
  comp AS (SELECT node, min(root) AS root FROM reach GROUP BY 1)"""
DOC_COUNTS = """member AS (SELECT DISTINCT candidate_id, cluster_id FROM candidate_clusters WHERE candidate_id IS NOT NULL AND cluster_id IS NOT NULL),
  dc AS (SELECT cluster_id, count(DISTINCT row_id) AS doc_count FROM candidates_mapping JOIN member USING (candidate_id) WHERE row_id IS NOT NULL GROUP BY 1),
  meta AS (SELECT cluster_id, min(cluster_label) AS cluster_label, min(cluster_size) AS cluster_size FROM candidate_clusters WHERE cluster_id IS NOT NULL GROUP BY 1)"""
SIZES = "sizes AS (SELECT cluster_id, count(DISTINCT candidate) AS cluster_size FROM candidate_clusters WHERE cluster_id IS NOT NULL GROUP BY 1)"
CHUNKS_ONLY = f"""ch AS (SELECT row_id, (row_number() OVER (ORDER BY row_id) - 1) // {CHUNK} AS chunk_no FROM docs),
  chunks AS (SELECT *, 'chunk_' || lpad(CAST(chunk_no AS VARCHAR), CAST(greatest(4, length(CAST(chunk_no AS VARCHAR))) AS INTEGER), '0') AS chunk_id FROM ch)"""
CHUNKS = f"{DOCS}, {CHUNKS_ONLY}"
EXPLAIN = f"""{SPANS}, why AS (SELECT *, CASE WHEN core = '' THEN 'DROPPED: empty after trim' WHEN length(core) > 4 THEN 'DROPPED: length'
    WHEN NOT contains(core, 'N') THEN 'DROPPED: no noun' WHEN contains(core, 'P') THEN 'DROPPED: punctuation' WHEN candidate = '' THEN 'DROPPED: empty after normalise'
    WHEN candidate IN {_in(BLACKLIST)} THEN 'DROPPED: blacklisted' END AS d FROM worded),
  num AS (SELECT *, row_number() OVER (PARTITION BY row_id, section_ord, candidate, d IS NULL ORDER BY source_ord, span_ord) AS rn FROM why),
  explained AS (SELECT row_id, source_section, source, span_ord, candidate, coalesce(d, CASE WHEN rn > 1 THEN 'DUPLICATE' ELSE 'KEPT' END) AS outcome FROM num)"""
_raw_spans = "SELECT row_id, source_section, source, span_ord, st AS start, CAST(n AS BIGINT) AS len FROM {0}"

ORACLE: dict[str, str] = {
    "q_sections": f"WITH {SECTIONS} SELECT row_id, source_section, text FROM sections",
    "q_tokens": f"WITH {TOKENS} SELECT row_id, source_section, array_to_string(toks, ' ') AS tokens, cls, len(toks) AS n_tokens FROM tok",
    "q_noun_chunks": f"WITH {SPANS} " + _raw_spans.format("nc"),
    "q_dep_phrases": f"WITH {SPANS} " + _raw_spans.format("dp"),
    "q_ngrams": f"WITH {SPANS} " + _raw_spans.format("ng"),
    "q_trim_filter": f"WITH {SPANS} SELECT row_id, source_section, source, span_ord, surface_form, candidate FROM kept",
    "q_normalize_lemma": f"WITH {SPANS} SELECT row_id, source_section, source, span_ord, surface_form, lemma_candidate AS candidate FROM kept",
    "q_blacklist": f"WITH {SPANS} SELECT candidate, count(*) AS n_spans FROM kept WHERE candidate NOT IN {_in(BLACKLIST)} GROUP BY 1",
    "q_extract": f"WITH {OCC} SELECT row_id, candidate, surface_form, source_section, extraction_source, n_spans FROM occ",
    "q_explain_spans": f"WITH {EXPLAIN} SELECT source, outcome, count(*) AS n_spans FROM explained GROUP BY ALL",
    "q_explain_rows": f"WITH {EXPLAIN} SELECT row_id, source_section, source, span_ord, candidate, outcome FROM explained",
    "q_extract_once": f"WITH {OCC} SELECT candidate, count(*) AS n_sections, count(*) AS n_spans FROM occ GROUP BY 1",
    "q_candidates_list": f"WITH {LISTED} SELECT * FROM listed",
    "q_candidates_mapping": f"WITH {LISTED} SELECT candidate_id, row_id FROM occ JOIN listed USING (candidate)",
    "q_extracted_tfidf": f"""WITH {OCC}, canon AS (SELECT row_id, candidate, count(*) AS tf FROM occ GROUP BY ALL), {DF}
      SELECT row_id, candidate, tf, df, round(idf, 6) AS idf, round(tf * idf, 6) AS tfidf_score, rank() OVER (PARTITION BY row_id ORDER BY round(tf * idf, 9) DESC) AS rank_tfidf
      FROM (SELECT canon.*, df, ln((n + 1) / (df + 1)) + 1 AS idf FROM canon JOIN dfs USING (candidate), nn)""",
    "q_canonical": f"WITH {CANON} SELECT row_id, candidate_id, candidate, surface_form, extraction_source, tf FROM canon",
    "q_tfidf_smooth": f"WITH {TFIDF} SELECT row_id, candidate_id, tf, df, round(idf, 6) AS idf, round(tfidf_score, 6) AS tfidf_score FROM tfidf",
    "q_tfidf_raw": f"WITH {CANON}, {DF} SELECT row_id, candidate_id, tf, df, round(ln(n / df) + 1, 6) AS idf, round(tf * (ln(n / df) + 1), 6) AS tfidf_score FROM canon JOIN dfs USING (candidate), nn",
    "q_rank_tfidf": f"WITH {TFIDF} SELECT row_id, candidate_id, round(tfidf_score, 6) AS tfidf_score, rank() OVER (PARTITION BY row_id ORDER BY round(tfidf_score, 9) DESC) AS rank_tfidf FROM tfidf",
    "q_ranked_candidates": RANKED + " SELECT * FROM ranked",
    "q_ranking_order": f"""WITH {TFIDF}, r AS (SELECT row_id, candidate_id, rank() OVER (PARTITION BY row_id ORDER BY round(tfidf_score, 9) DESC) AS rank_tfidf FROM tfidf)
      SELECT row_number() OVER (ORDER BY row_id, rank_tfidf, candidate_id) AS place, row_id, candidate_id, rank_tfidf FROM r""",
    "q_score_ranges": RANKED + """ SELECT min(tfidf_score) AS min_tfidf, max(tfidf_score) AS max_tfidf, min(semantic_score) AS min_semantic, max(semantic_score) AS max_semantic,
      count(*) AS n_pairs, count(DISTINCT row_id) AS n_documents, count(DISTINCT candidate) AS n_candidates FROM ranked""",
    "q_format_cls_sep": f"WITH {TEXTS} SELECT row_id, doc_text FROM texts",
    "q_format_plain": f"WITH {TEXTS} SELECT row_id, plain_text AS doc_text FROM texts",
    "q_semi_known": f"WITH {CANON}, {DOCS} SELECT row_id FROM docs WHERE row_id IN (SELECT row_id FROM canon)",
    "q_anti_unknown": f"WITH {CANON}, {DOCS} SELECT DISTINCT row_id FROM canon WHERE row_id NOT IN (SELECT row_id FROM docs)",
    "q_mapping_counts": "SELECT count(*) AS n_rows, (SELECT count(*) FROM (SELECT DISTINCT candidate_id, row_id FROM candidates_mapping)) AS n_pairs FROM candidates_mapping",
    "q_lemma_groups": f"WITH {LEMMAS} SELECT candidate, ord, lemma, group_ord FROM lemg",
    "q_blocks": f"WITH {CANDS} SELECT {BLOCK} AS block, count(*) AS block_size FROM cands GROUP BY 1",
    "q_candidate_edges": f"WITH {CEDGES} SELECT u, v, round(similarity, 6) AS similarity FROM ce",
    "q_similarity_edges": f"WITH {EEDGES.format(cap=BLOCK_CAP, t=EMBEDDING_THRESHOLD)} SELECT u, v, round(similarity, 6) AS similarity FROM ee",
    "q_block_cap": f"WITH {EEDGES.format(cap=50, t=EMBEDDING_THRESHOLD)} SELECT u, v, round(similarity, 6) AS similarity FROM ee",
    "q_components": f"WITH RECURSIVE {EEDGES.format(cap=BLOCK_CAP, t=EMBEDDING_THRESHOLD)}, {ECOMP.format(e='ee')} SELECT node, root FROM comp",
    "q_cluster_full": f"""WITH RECURSIVE {CEDGES}, alle AS (SELECT u, v FROM ce UNION SELECT ord, group_ord FROM lemg WHERE ord <> group_ord), {ECOMP.format(e='alle')},
      grp AS (SELECT candidate, ord, coalesce(root, ord) AS first_ord FROM cands LEFT JOIN comp ON node = ord),
      sz AS (SELECT first_ord, count(*) AS cluster_size, row_number() OVER (ORDER BY first_ord) - 1 AS cluster_id FROM grp GROUP BY 1),
      cen AS (SELECT first_ord, bucket, sum(w) AS w FROM grp JOIN cv USING (candidate) GROUP BY ALL),
      cn AS (SELECT first_ord, bucket, w / sqrt(sum(w * w) OVER (PARTITION BY first_ord)) AS w FROM cen),
      sims AS (SELECT grp.candidate, grp.ord, grp.first_ord, round(coalesce(sum(cv.w * cn.w), 0), 9) AS s FROM grp LEFT JOIN cv ON cv.candidate = grp.candidate LEFT JOIN cn ON cn.first_ord = grp.first_ord AND cn.bucket = cv.bucket GROUP BY ALL),
      lab AS (SELECT first_ord, candidate AS cluster_label FROM (SELECT *, row_number() OVER (PARTITION BY first_ord ORDER BY s DESC, ord) AS rn FROM sims) WHERE rn = 1)
      SELECT l.candidate_id, l.candidate, cluster_id, cluster_label, cluster_size FROM (SELECT DISTINCT candidate_id, candidate FROM candidates_list WHERE candidate IS NOT NULL AND candidate_id IS NOT NULL) l
      JOIN grp USING (candidate) JOIN sz USING (first_ord) JOIN lab USING (first_ord)""",
    "q_cluster_doc_counts": f"WITH {DOC_COUNTS} SELECT cluster_id, cluster_label, cluster_size, doc_count FROM meta JOIN dc USING (cluster_id)",
    "q_top_clusters": f"WITH {DOC_COUNTS} SELECT cluster_id, cluster_label, cluster_size, doc_count FROM meta JOIN dc USING (cluster_id) ORDER BY doc_count DESC, cluster_id LIMIT 20",
    "q_largest_clusters": "SELECT cluster_id, min(cluster_label) AS cluster_label, count(DISTINCT candidate) AS n_candidates FROM candidate_clusters WHERE cluster_id IS NOT NULL GROUP BY 1 ORDER BY n_candidates DESC, cluster_id LIMIT 10",
    "q_cluster_size_dist": f"WITH {SIZES} SELECT cluster_size, count(*) AS n_clusters, CAST(sum(cluster_size) AS BIGINT) AS n_candidates FROM sizes GROUP BY 1",
    "q_cluster_summary": f"WITH {SIZES} SELECT count(*) AS n_clusters, count(*) FILTER (cluster_size <= 1) AS n_singletons, count(*) FILTER (cluster_size > 1) AS n_multi, CAST(coalesce(sum(cluster_size) FILTER (cluster_size > 1), 0) AS BIGINT) AS n_in_multi FROM sizes",
    "q_matching_candidates": "SELECT DISTINCT candidate, cluster_id FROM candidate_clusters WHERE regexp_matches(candidate, '^batter')",
    "q_chunk_assign": f"WITH {CHUNKS} SELECT row_id, chunk_no, chunk_id FROM chunks",
    "q_chunk_candidates": f"WITH {OCC}, {CHUNKS_ONLY} SELECT chunk_id, count(DISTINCT candidate) AS n_candidates FROM occ JOIN chunks USING (row_id) GROUP BY 1",
    "q_resume_pending": f"WITH {CHUNKS} SELECT row_id, chunk_no, chunk_id FROM chunks WHERE chunk_id NOT IN ('chunk_0000', 'chunk_0002')",
    "q_source_documents": "SELECT row_id, title, abstract, office FROM source_docs",
    "q_csv_list": "SELECT candidate_id, nullif(candidate, '') AS candidate, nullif(surface_form, '') AS surface_form, nullif(extraction_source, '') AS extraction_source FROM candidates_list",
    "q_csv_mapping": "SELECT candidate_id, CAST(row_id AS VARCHAR) AS row_id FROM candidates_mapping",
    "q_csv_clusters": "SELECT candidate_id, nullif(candidate, '') AS candidate, cluster_id, nullif(cluster_label, '') AS cluster_label, cluster_size FROM candidate_clusters",
    "q_sorted_counts": f"WITH {DOC_COUNTS} SELECT row_number() OVER (ORDER BY doc_count DESC, cluster_id) AS place, cluster_id, doc_count FROM meta JOIN dc USING (cluster_id)",
    "q_blacklist_file": "SELECT unnest([" + _in(BLACKLIST)[1:-1] + "]) AS candidate",
    "q_chunk_store": f"WITH {CHUNKS} SELECT row_id, chunk_id FROM chunks",
    "q_ranked_chunked": RANKED + " SELECT * FROM ranked",
    "q_streamed_extract": f"WITH {OCC} SELECT row_id, candidate, surface_form, source_section, extraction_source, n_spans FROM occ",
    "p1_found": f"WITH {DOC_COUNTS} SELECT DISTINCT s.cluster_id FROM cluster_doc_counts s LEFT JOIN dc USING (cluster_id) WHERE s.cluster_id IS NOT NULL AND s.doc_count IS DISTINCT FROM coalesce(dc.doc_count, 0)",
    "p1_candidate_counts": "SELECT candidate_id, count(*) AS n_rows, count(DISTINCT row_id) AS n_distinct FROM candidates_mapping GROUP BY 1",
    "p1_doc_ordinals": "SELECT *, row_number() OVER (PARTITION BY candidate_id ORDER BY row_id NULLS FIRST) AS ordinal FROM (SELECT candidate_id, row_id, count(*) AS n_rows FROM candidates_mapping GROUP BY ALL)",
}

#: Blocks of any size: the same SQL with a cap that no block reaches.
_NO_CAP = 1 << 62
for _name in ("q_candidate_edges", "q_similarity_edges", "q_components", "q_cluster_full"):
    ORACLE[_name.replace("_full", "") + "_exact"] = ORACLE[_name].replace(f"BETWEEN 2 AND {BLOCK_CAP})", f"BETWEEN 2 AND {_NO_CAP})")
ORACLE["q_skipped_blocks"] = f"""WITH {CANDS}, sizes AS (SELECT 'candidates' AS blocks_of, {BLOCK} AS block, count(*) AS n FROM cands GROUP BY ALL
    UNION ALL SELECT 'embeddings', CAST(label AS VARCHAR), count(*) FROM embeddings WHERE label IS NOT NULL GROUP BY ALL)
  SELECT w.blocks_of, count(n) AS n_blocks, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_rows FROM (VALUES ('candidates'), ('embeddings')) w(blocks_of)
  LEFT JOIN sizes ON sizes.blocks_of = w.blocks_of AND n > {BLOCK_CAP} GROUP BY 1"""
ORACLE["q_block_cap_candidates"] = ORACLE["q_candidate_edges"].replace(f"BETWEEN 2 AND {BLOCK_CAP})", f"BETWEEN 2 AND {SMALL_CAP})")
ORACLE["q_block_cap_skipped"] = f"SELECT CAST(label AS VARCHAR) AS block, count(*) AS block_size FROM embeddings WHERE label IS NOT NULL GROUP BY 1 HAVING count(*) > {SMALL_CAP}"

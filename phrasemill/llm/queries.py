"""Queries over the test tables, and their SQL where SQL can express them on whole tables."""

from __future__ import annotations

import unicodedata

from pyspark.sql import functions as F

from ..plans.session import read_table, spread
from ..queries import plain
from .characters import PLAIN, TO_LATIN
from . import encoding, fusion, groups, leakage, lookalikes, similarity, terms, topn

QUERIES, ORACLE = {}, {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@query
def p2_found(spark, d):
    edges = groups.valid_matches(read_table(spark, d, "candidate_matches", "candidate_id_a", "candidate_id_b", "match_kind", "score"), read_table(spark, d, "candidates_list", "candidate_id"))
    return groups.group_matches(edges).select(F.col("node").alias("candidate_id"), F.col("root").alias("group_id"))


def _mapping(spark, d):
    return read_table(spark, d, "candidates_mapping", "candidate_id", "row_id")


def _list(spark, d):
    return read_table(spark, d, "candidates_list", "candidate_id", "candidate")


@query
def p3_found(spark, d):
    return terms.wrong_scores(read_table(spark, d, "ranked_candidates", "row_id", "candidate_id", "tfidf_score"), _mapping(spark, d), _list(spark, d))


@query
def p3_term_scores(spark, d):
    """What the model of :func:`p3_distinctiveness` is fitted on, and the TF-IDF of every pair."""
    return plain(terms.score_terms(_mapping(spark, d), _list(spark, d)).select("row_id", "candidate_id", "tf", "df", "n_docs", "idf", "tfidf"))


@query
def p3_distinctiveness(spark, d):
    """How characteristic each candidate is of each of its documents, by the fitted mixtures."""
    return plain(terms.score_terms(_mapping(spark, d), _list(spark, d)).select("row_id", "candidate_id", "elite_prob", "distinctiveness", "converged"))


@query
def p4_found(spark, d):
    return terms.candidate_frequencies(_mapping(spark, d), _list(spark, d)).filter("mark is not null").select("candidate", "mark")


@query
def p4_frequencies(spark, d):
    return terms.candidate_frequencies(_mapping(spark, d), _list(spark, d))


def _clusters(spark, d):
    v = spread(read_table(spark, d, "candidate_vectors", "candidate_id", "vec"))
    return similarity.similarity_clusters(v.select(F.col("candidate_id").alias("id"), "vec"))


@query
def p5_found(spark, d):
    return _clusters(spark, d).select(F.col("id").alias("candidate_id"), "typical_id")


@query
def p5_clusters(spark, d):
    """Each cluster with its identifier, its size and its most typical member as label."""
    one = _clusters(spark, d).select("cluster_id", "cluster_size", "typical_id").distinct()
    names = _list(spark, d).filter("candidate_id is not null").groupBy("candidate_id").agg(F.min("candidate").alias("cluster_label"))
    return one.join(names, one["typical_id"] == names["candidate_id"], "left").select("cluster_id", "cluster_label", "cluster_size")


def _ranking(spark, d):
    ranked = read_table(spark, d, "ranked_candidates", "row_id", "candidate_id", "tfidf_score", "semantic_score")
    return fusion.requested_ranking(ranked, read_table(spark, d, "ranking_requests", "row_id"))


@query
def p6_found(spark, d):
    return _ranking(spark, d).filter("fused_rank = 1").select("row_id", "candidate_id")


@query
def p6_ranking(spark, d):
    return _ranking(spark, d).select("row_id", "candidate_id", "fused_rank")


@query
def p7_found(spark, d):
    ranked = read_table(spark, d, "ranked_candidates", "row_id", "candidate_id", "tfidf_score", "semantic_score")
    return topn.best_candidates(ranked).select("row_id", "candidate_id")


@query
def p8_ids(spark, d):
    return encoding.encode_texts(spread(read_table(spark, d, "documents", "doc_id", "text")), "doc_id", "text", vocabulary())


@query
def p8_round_trip(spark, d):
    """Every document as its ids decode; a null text counts as empty."""
    return encoding.decode_ids(p8_ids(spark, d), "doc_id", "ids", vocabulary())


def _leak_tables(spark, d):
    return spread(read_table(spark, d, "documents", "doc_id", "text")), read_table(spark, d, "eval_items", "item_id", "item_text")


@query
def p9_found(spark, d):
    return leakage.leaked_items(*_leak_tables(spark, d))


@query
def p9_cleaned(spark, d):
    return leakage.remove_leaks(*_leak_tables(spark, d))


@query
def p10_found(spark, d):
    return lookalikes.same_looking(spread(read_table(spark, d, "documents", "doc_id", "text")))


@query
def p10_canonical(spark, d):
    return lookalikes.canonical_texts(spread(read_table(spark, d, "documents", "doc_id", "text")), "doc_id", "text").select("doc_id", "canonical")


@query
def p10_classes(spark, d):
    return lookalikes.look_classes(spread(read_table(spark, d, "documents", "doc_id", "text")))


_COUNTED = r"""ids AS (SELECT candidate_id, candidate FROM (SELECT *, row_number() OVER (PARTITION BY candidate_id ORDER BY candidate NULLS FIRST) AS rn FROM candidates_list WHERE candidate_id IS NOT NULL)
    WHERE rn = 1 AND regexp_matches(candidate, '\S')),
  counted AS (SELECT row_id, candidate_id, candidate FROM candidates_mapping JOIN ids USING (candidate_id) WHERE row_id IS NOT NULL),
  dfs AS (SELECT candidate, count(*) AS tf, count(DISTINCT row_id) AS df FROM counted GROUP BY 1), nn AS (SELECT count(DISTINCT row_id) AS n FROM counted)"""
_FREQUENCIES = f"""WITH {_COUNTED}, strings AS (SELECT DISTINCT candidate FROM ids),
  f AS (SELECT candidate, coalesce(tf, 0) AS tf, coalesce(df, 0) AS df, n AS n_docs FROM strings LEFT JOIN dfs USING (candidate), nn),
  m AS (SELECT *, CASE WHEN df < 3 THEN 'rare' WHEN df * 100 > n_docs * 5 THEN 'common' END AS mark FROM f)"""
ORACLE["p2_found"] = """WITH RECURSIVE ids AS (SELECT DISTINCT candidate_id FROM candidates_list WHERE candidate_id IS NOT NULL),
  e AS (SELECT DISTINCT candidate_id_a AS u, candidate_id_b AS v FROM candidate_matches WHERE candidate_id_a <> candidate_id_b AND (match_kind = 'lemma' OR (score >= 0.92 AND NOT isnan(score)))
    AND candidate_id_a IN (FROM ids) AND candidate_id_b IN (FROM ids)),
  b AS (SELECT u, v FROM e UNION SELECT v, u FROM e),
  low AS (SELECT DISTINCT u AS node, u AS root FROM b UNION SELECT b.v, low.root FROM low JOIN b ON b.u = low.node WHERE low.root < b.v)
  SELECT node AS candidate_id, min(root) AS group_id FROM low GROUP BY 1"""
ORACLE["p3_found"] = f"""WITH {_COUNTED}, tfs AS (SELECT row_id, candidate_id, candidate, count(*) AS tf FROM counted GROUP BY ALL),
  ok AS (SELECT row_id, candidate_id, tfs.tf * (ln((n + 1) / (df + 1)) + 1) AS want FROM tfs JOIN dfs USING (candidate), nn)
  SELECT DISTINCT r.row_id, r.candidate_id FROM ranked_candidates r LEFT JOIN ok USING (row_id, candidate_id)
  WHERE r.tfidf_score IS NULL OR isnan(r.tfidf_score) OR abs(r.tfidf_score - coalesce(want, 0)) > 0.001"""
ORACLE["p4_found"] = _FREQUENCIES + " SELECT candidate, mark FROM m WHERE mark IS NOT NULL"
ORACLE["p4_frequencies"] = _FREQUENCIES + " SELECT * FROM m"
_CLIQUES = """v AS (SELECT DISTINCT candidate_id AS id, CAST(vec AS DOUBLE[]) AS vec FROM candidate_vectors WHERE vec IS NOT NULL AND len(vec) = 64),
  u AS (SELECT id, list_transform(vec, lambda x: x / sqrt(list_dot_product(vec, vec))) AS x FROM v
    WHERE len(list_filter(vec, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND list_dot_product(vec, vec) > 0),
  p AS (SELECT a.id AS a, b.id AS b, list_dot_product(a.x, b.x) AS c FROM u a JOIN u b ON a.id <> b.id WHERE list_dot_product(a.x, b.x) >= 0.92),
  s AS (SELECT a AS id, least(a, min(b)) AS cluster_id, count(*) + 1 AS cluster_size, round(sum(c), 4) AS s FROM p GROUP BY a),
  t AS (SELECT *, first_value(id) OVER (PARTITION BY cluster_id ORDER BY s DESC, id) AS typical_id FROM s)"""
ORACLE["p5_found"] = f"WITH {_CLIQUES} SELECT id AS candidate_id, typical_id FROM t"
ORACLE["p5_clusters"] = f"""WITH {_CLIQUES}, names AS (SELECT candidate_id, min(candidate) AS cluster_label FROM candidates_list GROUP BY 1)
  SELECT DISTINCT cluster_id, cluster_label, cluster_size FROM t LEFT JOIN names ON candidate_id = typical_id"""
ORACLE["p7_found"] = """WITH one AS (SELECT DISTINCT row_id, candidate_id, tfidf_score, CASE WHEN NOT isnan(semantic_score) THEN semantic_score END AS semantic_score FROM ranked_candidates
    WHERE row_id IS NOT NULL AND candidate_id IS NOT NULL AND tfidf_score IS NOT NULL AND NOT isnan(tfidf_score)),
  n AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY tfidf_score DESC, semantic_score DESC NULLS LAST, candidate_id) AS k FROM one)
  SELECT row_id, candidate_id FROM n WHERE k <= 3"""
ORACLE["p8_round_trip"] = "SELECT doc_id, coalesce(text, '') AS text FROM documents"
ORACLE["p3_term_scores"] = f"""WITH {_COUNTED}, tfs AS (SELECT row_id, candidate_id, candidate, count(*) AS tf FROM counted GROUP BY ALL)
  SELECT row_id, candidate_id, tfs.tf, df, n AS n_docs, round(ln((n + 1) / (df + 1)) + 1, 6) AS idf, round(tfs.tf * (ln((n + 1) / (df + 1)) + 1), 6) AS tfidf FROM tfs JOIN dfs USING (candidate), nn"""
# Where the first place is clear, whatever weighs both scores equally finds it: here the sum of the two mean ranks.
ORACLE["p6_found"] = """WITH one AS (SELECT row_id, candidate_id, max(CASE WHEN NOT isnan(tfidf_score) THEN tfidf_score END) AS t, max(CASE WHEN NOT isnan(semantic_score) THEN semantic_score END) AS s
    FROM ranked_candidates WHERE row_id IN (SELECT row_id FROM ranking_requests) AND candidate_id IS NOT NULL GROUP BY ALL),
  r AS (SELECT *, 2 * rank() OVER (PARTITION BY row_id ORDER BY t DESC NULLS LAST) + count(*) OVER (PARTITION BY row_id, t)
      + 2 * rank() OVER (PARTITION BY row_id ORDER BY s DESC NULLS LAST) + count(*) OVER (PARTITION BY row_id, s) AS place FROM one)
  SELECT row_id, arg_min(candidate_id, place * 1000000000000 + candidate_id) AS candidate_id FROM r GROUP BY 1"""


def _looks(text: str, fold: str = "") -> str:
    """SQL of a text as a reader sees it, with every look-alike letter as its Latin one."""
    table = {chr(k): v for k, v in PLAIN.items() if len(v or "") < 2} | TO_LATIN
    quoted = lambda x: x.replace("'", "''")
    gone = "".join(k for k, v in table.items() if not v)
    to = [(k, v) for k, v in table.items() if v]
    longer = [(chr(k), v) for k, v in PLAIN.items() if len(v or "") > 1]
    out = f"replace({text}, chr(13) || chr(10), ' ')"
    for k, v in longer:
        out = f"replace({out}, '{quoted(k)}', '{quoted(v)}')"
    out = f"nfc_normalize(translate({out}, '{quoted(''.join(k for k, _ in to))}{gone}', '{quoted(''.join(v for _, v in to))}'))"
    # Letters composed with a mark come apart only where they are look-alikes.
    pairs = [(c, unicodedata.normalize("NFC", "".join(TO_LATIN.get(x, x) for x in unicodedata.normalize("NFD", c)))) for c in map(chr, range(0x370, 0x530)) if len(unicodedata.normalize("NFD", c)) > 1]
    pairs = [(c, v) for c, v in pairs if len(v) == 1 and v != c]
    return f"trim(nfc_normalize(translate({out}, '{''.join(c for c, _ in pairs)}', '{''.join(v for _, v in pairs)}')))"


_LOOKS = f"l AS (SELECT doc_id, text, {_looks('text')} AS look FROM documents WHERE text IS NOT NULL)"
ORACLE["p10_found"] = f"""WITH {_LOOKS} SELECT a.doc_id AS doc_id_a, b.doc_id AS doc_id_b FROM l a JOIN l b ON a.look = b.look AND a.text <> b.text AND a.doc_id < b.doc_id
  WHERE regexp_matches(a.look, '\\S')"""
ORACLE["p10_classes"] = f"""WITH {_LOOKS}, s AS (SELECT look, text, min(doc_id) AS spelling_id, count(*) AS n FROM l WHERE regexp_matches(look, '\\S') GROUP BY ALL),
  c AS (SELECT look, min(spelling_id) AS class_id, CAST(sum(n) AS BIGINT) AS class_size, count(*) AS n_spellings FROM s GROUP BY 1 HAVING count(*) > 1)
  SELECT doc_id, class_id, spelling_id, class_size, n_spellings, class_size - n AS links FROM l JOIN s USING (look, text) JOIN c USING (look)"""
# Runs of six words of an item that stand in a document cover their places in the item.
ORACLE["p9_found"] = f"""WITH d AS (SELECT doc_id, regexp_extract_all(lower({_looks('text')}), '[\\p{{L}}\\p{{N}}_]+') AS w FROM documents WHERE text IS NOT NULL),
  i AS (SELECT item_id, regexp_extract_all(lower({_looks('item_text')}), '[\\p{{L}}\\p{{N}}_]+') AS w FROM eval_items WHERE item_text IS NOT NULL),
  dg AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + 5], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 4)) AS p FROM d WHERE len(w) >= 6)),
  ig AS (SELECT item_id, p, len(w) AS n, array_to_string(w[p:p + 5], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 4)) AS p FROM i WHERE len(w) >= 12)),
  c AS (SELECT DISTINCT doc_id, item_id, n, p + k AS place FROM dg JOIN ig USING (g) CROSS JOIN (SELECT unnest(range(6)) AS k))
  SELECT doc_id, item_id FROM c GROUP BY doc_id, item_id, n HAVING count(*) * 2 >= n"""

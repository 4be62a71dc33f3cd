import json
import warnings

import pytest
from pyspark.sql import functions as F

from phrasemill.config import ExtractConfig, RankConfig
from phrasemill.operators import cluster, components, coverage, dictionary, extract, ranking
from phrasemill.sources.chunks import ChunkStore, assign_chunks
from phrasemill.sources.tables import latest_revision, load_blacklist, load_candidates_list, load_candidates_mapping, load_source_documents, write_table

DOCS = "row_id BIGINT, title STRING, abstract STRING"
CFG = ExtractConfig(use_ngram_backoff=False)


def docs(spark, *rows):
    return spark.createDataFrame(list(rows), DOCS)


def found(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_sections_skip_null_and_blank(spark):
    d = docs(spark, (1, " T ", None), (2, "", "\t A \n"), (3, None, None))
    assert found(extract.sections(d), "row_id", "source_section", "text") == [(1, "title", "T"), (2, "abstract", "A")]
    with pytest.raises(ValueError, match="title"):
        extract.sections(d.select("row_id"))


def test_trim_filter_and_merge(spark):
    d = docs(spark, (1, "The porous electrode of the cell.", "A porous electrode, 12 of 34, and Porous Electrode"))
    occ = extract.extract(d, CFG)
    assert found(occ, "candidate", "surface_form", "source_section", "extraction_source", "n_spans") == [
        ("cell", "cell", "title", "noun_chunk", 1),
        ("porous electrode", "porous electrode", "abstract", "dep_phrase|noun_chunk", 4),
        ("porous electrode", "porous electrode", "title", "dep_phrase|noun_chunk", 2),
    ]


def test_length_blacklist_and_lemma(spark):
    d = docs(spark, (1, "alpha beta gamma delta epsilon; method; Batteries", None))
    black = spark.createDataFrame([("method",)], "candidate STRING")
    got = {r.candidate for r in extract.extract(d, CFG, black).collect()}
    assert "method" not in got and "batteries" in got and "alpha beta gamma delta epsilon" not in got
    lemmas = ExtractConfig(use_ngram_backoff=False, normalization_mode="lemma", apply_light_lemmatization=True)
    assert "battery" in {r.candidate for r in extract.extract(d, lemmas).collect()}
    out = {(r.candidate, r.outcome) for r in extract.explain_spans(d, CFG, black).collect()}
    assert ("method", "DROPPED: blacklisted") in out and ("alpha beta gamma delta epsilon", "DROPPED: length") in out


def test_ngrams_and_custom_source(spark):
    d = docs(spark, (1, "solid cell", None))
    assert found(extract.spans(d, ExtractConfig(use_noun_chunks=False, use_dependency_phrases=False)), "start", "len") == [(1, 2)]
    none = ExtractConfig(use_noun_chunks=False, use_dependency_phrases=False, use_ngram_backoff=False)
    assert extract.extract(d, none).collect() == []
    extract.register_span_source("first")(lambda cls, cfg: F.array(F.struct(F.lit(1).alias("st"), F.lit(1).alias("n"))))
    try:
        assert found(extract.extract(d, none), "candidate", "extraction_source") == [("solid", "first")]
    finally:
        del extract.SPAN_SOURCES["first"]


def test_empty_corpus_keeps_its_columns(spark):
    occ = extract.extract(docs(spark).limit(0), CFG)
    assert occ.collect() == [] and occ.columns[:5] == ["row_id", "candidate", "surface_form", "source_section", "extraction_source"]
    listed = dictionary.candidates_list(occ)
    assert listed.collect() == [] and dictionary.candidates_mapping(occ, listed).collect() == []


def test_ids_follow_first_appearance(spark):
    d = docs(spark, (2, "zinc", "anode"), (1, "cathode", "zinc zinc"))
    occ = extract.extract(d, CFG)
    listed = dictionary.candidates_list(occ)
    ids = {r.candidate: r.candidate_id for r in listed.collect()}
    assert ids["cathode"] == 0 and ids["zinc"] == 1 and sorted(ids.values()) == list(range(len(ids)))
    assert len(dictionary.candidates_mapping(occ, listed).collect()) == occ.count()
    assert dictionary.candidates_mapping(occ, listed, raw_tf=True).count() == occ.agg(F.sum("n_spans")).first()[0]


LIST = [(0, "solid electrolyte", "solid electrolyte"), (1, "energy density", "energy density"), (2, "electrode material", "electrode materials"), (3, "lithium battery", "lithium batteries"), (4, "battery cell", "battery cells")]
MAP = [(0, 1), (0, 3), (1, 1), (1, 2), (1, 2), (2, 2), (3, 1), (4, 3)]


def demo(spark, extra_map=(), extra_list=()):
    listed = spark.createDataFrame([(*x, "noun_chunk") for x in [*LIST, *extra_list]], "candidate_id BIGINT, candidate STRING, surface_form STRING, extraction_source STRING")
    return spark.createDataFrame([*MAP, *extra_map], "candidate_id BIGINT, row_id BIGINT"), listed


def test_demo_ranking(spark):
    mapping, listed = demo(spark, [(0, None), (99, 1)], [(5, " ", None), (6, None, None)])
    d = docs(spark, (1, "Lithium-ion battery with solid electrolyte", "x"), (2, "High energy density electrode materials", None))
    got = {(r.row_id, r.candidate): r for r in ranking.rank_candidates(mapping, listed, d).collect()}
    assert len(got) == 7
    r = got[2, "energy density"]
    assert (r.tf, r.df, r.rank_tfidf) == (2, 2, 1) and r.idf == pytest.approx(1.2876820725) and r.tfidf_score == pytest.approx(2.5753641449)
    assert got[1, "lithium battery"].rank_tfidf == 1 and got[1, "energy density"].rank_tfidf == got[1, "solid electrolyte"].rank_tfidf == 2
    assert got[3, "battery cell"].semantic_score == 0.0
    canon = ranking.canonical(mapping, listed)
    assert [r.row_id for r in ranking.unknown_documents(canon, d).collect()] == [3]
    assert found(ranking.known_documents(d, canon), "row_id") == [(1,), (2,)]


def test_tfidf_modes_and_empty(spark):
    canon = ranking.canonical(*demo(spark))
    raw = {r.candidate: r.idf for r in ranking.compute_tfidf(canon, smoothed=False).collect()}
    assert raw["battery cell"] == pytest.approx(2.0986122887)
    assert ranking.compute_tfidf(canon.limit(0)).collect() == []
    with pytest.raises(ValueError):
        ranking.compute_tfidf(canon.limit(0), check_empty=True)


def test_rank_puts_missing_scores_last(spark):
    df = spark.createDataFrame([(1, 1, 0.5), (1, 2, None), (1, 3, float("nan")), (1, 4, 0.5), (1, 5, 0.1)], "row_id INT, i INT, s DOUBLE")
    assert found(ranking.rank_within(df, "s", "r"), "i", "r") == [(1, 1), (2, 4), (3, 4), (4, 1), (5, 3)]


def test_rank_of_heavy_documents_equals_the_window(spark):
    rows = [(i % 3 and 1 or i % 7, i, None if i % 50 == 0 else float("nan") if i % 60 == 1 else float(i * 7 % 40) / 3) for i in range(600)] + [(None, 0, 1.0)]
    df = spark.createDataFrame(rows, "row_id BIGINT, i BIGINT, s DOUBLE").repartition(3)
    window = found(ranking.rank_within(df, "s", "r").fillna(-1, "row_id"), "row_id", "i", "r")
    assert found(ranking.rank_within(df, "s", "r", heavy=[1, 5]).fillna(-1, "row_id"), "row_id", "i", "r") == window


def test_similarity_edges_blocks_and_cap(spark):
    rows = [(0, "a", [1.0, 0.0]), (1, "a", [1.0, 0.0]), (2, "a", [0.6, 0.8]), (3, "b", [1.0, 0.0]), (4, "c", [1.0, 0.0]), (5, "c", [0.0, 1.0])]
    v = spark.createDataFrame(rows, "ord BIGINT, block STRING, vec ARRAY<DOUBLE>")
    assert found(cluster.similarity_edges(v, 0.6), "u", "v") == [(0, 1), (0, 2), (1, 2)]  # equal to the threshold counts
    assert found(cluster.similarity_edges(v, 0.6, max_block_size=2), "u", "v") == []


def test_components_over_chains_loops_and_stars(spark):
    edges = [(i, i + 1) for i in range(30)] + [(50, 50), (60, 61), (61, 60), (70, None)] + [(100, 100 + i) for i in range(1, 20)]
    got = dict(found(components.star_components(spark.createDataFrame(edges, "u BIGINT, v BIGINT")), "node", "root"))
    assert got == {**{i: 0 for i in range(31)}, 60: 60, 61: 60, **{100 + i: 100 for i in range(20)}}
    assert components.star_components(spark.createDataFrame([], "u BIGINT, v BIGINT")).collect() == []


def test_clusters_join_lemmas_and_similar_phrases(spark):
    words = ["lithium battery", "lithium batteries", "lithium batterys", "zinc anode", "Zinc anode", None]
    listed = spark.createDataFrame(list(enumerate(words)), "candidate_id BIGINT, candidate STRING")
    got = {r.candidate: r for r in cluster.cluster_candidates(listed, 0.8).collect()}
    assert len(got) == 5
    assert got["lithium battery"].cluster_id == got["lithium batteries"].cluster_id == got["lithium batterys"].cluster_id == 0
    assert got["zinc anode"].cluster_id == got["Zinc anode"].cluster_id == 1 and got["zinc anode"].cluster_size == 2
    assert got["Zinc anode"].cluster_label == "zinc anode"  # equal vectors: the first in list order


def test_reports(spark):
    c = spark.createDataFrame([(0, "a", 0, "a", 9), (1, "b", 0, "a", 9), (1, "b", 0, "a", 9), (2, "battery", 1, "x", 1), (3, None, 1, "x", 1)], "candidate_id BIGINT, candidate STRING, cluster_id BIGINT, cluster_label STRING, cluster_size BIGINT")
    assert found(coverage.cluster_size_distribution(c), "cluster_size", "n_clusters", "n_candidates") == [(1, 1, 1), (2, 1, 2)]
    assert tuple(coverage.cluster_summary(c).first()) == (2, 1, 1, 2)
    assert found(coverage.largest_clusters(c, 1), "cluster_id", "n_candidates") == [(0, 2)]
    assert found(coverage.matching_candidates(c, "^batter"), "candidate") == [("battery",)]
    m = spark.createDataFrame([(0, 1), (1, 1), (1, 2), (2, None)], "candidate_id BIGINT, row_id BIGINT")
    assert found(coverage.cluster_doc_counts(m, c), "cluster_id", "doc_count") == [(0, 2)]
    assert found(coverage.top_clusters(coverage.cluster_doc_counts(m, c), 5), "cluster_id") == [(0,)]


def test_csv_round_trip_keeps_literals_quotes_and_zeros(spark, tmp_path):
    rows = [(0, "null", None, "ngram"), (1, "n/a", 'say "x", y', None), (2, "nan", "b", "t")]
    path = write_table(spark.createDataFrame(rows, "candidate_id BIGINT, candidate STRING, surface_form STRING, extraction_source STRING"), str(tmp_path / "l.csv"))
    assert found(load_candidates_list(spark, path).fillna(""), "candidate_id", "candidate", "surface_form") == [(0, "null", ""), (1, "n/a", 'say "x", y'), (2, "nan", "b")]
    write_table(spark.createDataFrame([(1, "0012")], "cid BIGINT, doc STRING"), str(tmp_path / "m.csv"))
    m = load_candidates_mapping(spark, str(tmp_path / "m.csv"), {"candidate_id": "cid", "row_id": "doc"})
    assert found(m, "candidate_id", "row_id") == [(1, "0012")]
    with pytest.raises(ValueError, match="missing"):
        load_candidates_mapping(spark, str(tmp_path / "m.csv"))
    with pytest.raises(ValueError, match="unsupported"):
        load_source_documents(spark, "x.json", "a", "b", "c")


def test_blacklist_file(spark, tmp_path):
    (tmp_path / "b.txt").write_text("# note\n\n Present Invention \n # odd\nclaim # why\nclaim # why\n")
    assert found(load_blacklist(spark, str(tmp_path / "b.txt")), "candidate") == [("# odd",), ("claim # why",), ("present invention",)]
    with warnings.catch_warnings(record=True) as w:
        warnings.simplefilter("always")
        assert load_blacklist(spark, str(tmp_path / "none.txt")).count() == 0
    assert w


def test_latest_revision(spark):
    df = spark.createDataFrame([(1, "a", "old", 1), (1, "a", "new", 2), (2, None, "x", None), (None, "t", "t", 3)], DOCS + ", loaded_at INT")
    assert found(latest_revision(df), "row_id", "abstract") == [(1, "new"), (2, "x")]


def test_chunks_resume(spark, tmp_path):
    d = assign_chunks(docs(spark, *[(i * 10, "t", "a") for i in range(7)]), "row_id", 3)
    assert found(d.groupBy("chunk_id").count(), "chunk_id", "count") == [("chunk_0000", 3), ("chunk_0001", 3), ("chunk_0002", 1)]
    store = ChunkStore(tmp_path / "c", "one")
    for c in ("chunk_0000", "chunk_0001"):
        store.save(c, d.filter(F.col("chunk_id") == c).select("row_id"))
    again = ChunkStore(tmp_path / "c", "one")
    assert again.n_completed() == 2 and again.is_done("chunk_0001") and again.pending(["chunk_0000", "chunk_0002"]) == ["chunk_0002"]
    assert again.load_all(spark, "row_id BIGINT").count() == 6
    assert ChunkStore(tmp_path / "c", "two").n_completed() == 0
    import shutil

    shutil.rmtree(tmp_path / "c/chunk_id=chunk_0001")
    with pytest.raises(FileNotFoundError):
        again.load_all(spark, "row_id BIGINT")
    again.clear()
    assert ChunkStore(tmp_path / "c", "one").load_all(spark, "row_id BIGINT").columns == ["row_id", "chunk_id"]


def test_pipeline_runs_once_and_resumes(spark, tmp_path):
    from phrasemill.plans.pipeline import Pipeline

    spark.createDataFrame([(i, f"porous electrode {w}", f"the {w} electrode holds a solid cell") for i, w in enumerate(["zinc", "tin", "iron"])], "APPLN_ID BIGINT, APPLN_TITLE STRING, APPLN_ABSTR STRING").write.parquet(str(tmp_path / "in.parquet"))
    raw = {
        "data_path": str(tmp_path / "in.parquet"), "candidates_list_path": str(tmp_path / "l"), "candidates_mapping_path": str(tmp_path / "m"), "output_path": str(tmp_path / "r"),
        "semantic": {"backend": "hashed", "doc_chunk_size": 2, "checkpoint_dir": str(tmp_path / "cs")},
        "extraction": {"extract_chunk_size": 2, "checkpoint_dir": str(tmp_path / "cx")}, "clustering": {"semantic_threshold": 0.92, "output_path": str(tmp_path / "c"), "doc_counts_path": str(tmp_path / "d")},
    }
    (tmp_path / "cfg.json").write_text(json.dumps(raw))
    pipe = Pipeline(spark, RankConfig.from_dict(raw), CFG)
    assert set(pipe.run().values()) == {True}
    assert set(pipe.run().values()) == {False}
    n = spark.read.parquet(str(tmp_path / "l")).count()
    assert spark.read.parquet(str(tmp_path / "c")).count() == n and spark.read.parquet(str(tmp_path / "r")).columns[-1] == "candidate_id"
    counts = {r.cluster_label: r.doc_count for r in spark.read.parquet(str(tmp_path / "d")).collect()}
    assert counts["solid cell"] == 3


def test_config_warns_of_keys_without_effect():
    with pytest.warns(UserWarning, match="language"):
        assert ExtractConfig.from_dict({"language": "en", "ngram_max": 2, "_comment": ""}).ngram_max == 2


def test_streamed_extraction(spark, tmp_path):
    from phrasemill.streaming.extract_stream import stream_occurrences

    docs(spark, (1, "porous electrode", None)).write.parquet(str(tmp_path / "in"))
    stream_occurrences(spark, str(tmp_path / "in"), DOCS, str(tmp_path / "out"), str(tmp_path / "ck"), CFG).awaitTermination(60)
    assert [r.candidate for r in spark.read.parquet(str(tmp_path / "out")).collect()] == ["porous electrode"]


def test_chunked_semantic_scores_equal_and_resume(spark, tmp_path):
    mapping, listed = demo(spark)
    texts = spark.createDataFrame([(1, "lithium battery cell"), (2, "energy density of cells")], "row_id BIGINT, doc_text STRING")
    canon = ranking.canonical(mapping, listed)
    want = found(ranking.semantic_scores(canon, texts), "row_id", "candidate_id", "semantic_score")
    store = ChunkStore(tmp_path / "s", "x")
    assert found(ranking.semantic_scores_chunked(canon, texts, store, 2), "row_id", "candidate_id", "semantic_score") == want
    again = ChunkStore(tmp_path / "s", "x")
    assert again.n_completed() == 2
    assert found(ranking.semantic_scores_chunked(canon, texts, again, 2), "row_id", "candidate_id", "semantic_score") == want


def test_token_backends(spark):
    d = docs(spark, (1, "x", None))
    with pytest.raises(ValueError, match="rules"):
        extract.tokens(d, ExtractConfig(nlp_backend="other"))
    with pytest.raises(ImportError, match="spacy"):
        extract.tokens(d, ExtractConfig(nlp_backend="spacy"))


def shipped(tmp_path, base, suffix):
    """A ranking configuration of the documented form, with outputs of one suffix below ``base``."""
    return {
        "data_path": f"{base}/in.parquet", "id_column": "APPLN_ID", "title_column": "APPLN_TITLE", "abstract_column": "APPLN_ABSTR",
        "candidates_list_path": f"{base}/candidates_list{suffix}", "candidates_mapping_path": f"{base}/candidates_mapping{suffix}", "output_path": f"{base}/ranked{suffix}",
        "candidates_list_columns": {"candidate_id": "candidate_id", "candidate": "candidate", "surface_form": "surface_form", "extraction_source": "extraction_source"},
        "semantic": {"backend": "hashed", "model_name": "x", "batch_size": 64, "doc_chunk_size": 2, "checkpoint_dir": f"{base}/cs"},
        "extraction": {"extract_chunk_size": 2, "checkpoint_dir": f"{base}/cx"},
        "clustering": {"semantic_threshold": 0.92, "max_block_size": 2000, "output_path": f"{base}/clusters{suffix}", "doc_counts_path": f"{base}/counts{suffix}"},
    }


@pytest.mark.parametrize("suffix,scheme", [(".csv", ""), (".csv", "file://"), (".parquet", "file://")])
def test_every_stage_with_paths_of_every_kind(spark, tmp_path, suffix, scheme):
    from phrasemill.__main__ import main
    from phrasemill.plans.pipeline import Pipeline
    from phrasemill.sources.tables import load_candidates_mapping, load_clusters, read_any

    rows = [(i, f"porous electrode {w}", f'the {w} electrode, "solid" cell holds a solid cell') for i, w in enumerate(["zinc", "tin", "iron", "lead", "gold"])] + [(9, None, " ")]
    spark.createDataFrame(rows, "APPLN_ID BIGINT, APPLN_TITLE STRING, APPLN_ABSTR STRING").write.parquet(str(tmp_path / "in.parquet"))
    raw = shipped(tmp_path, f"{scheme}{tmp_path}", suffix)
    cfg = RankConfig.from_dict(raw)
    pipe = Pipeline(spark, cfg, CFG)
    assert set(pipe.run().values()) == {True} and set(pipe.run().values()) == {False}
    assert dict(found(pipe.chunk_report, "chunk_id", "n_candidates")).keys() == {"chunk_0000", "chunk_0001", "chunk_0002"}
    n = read_any(spark, cfg.candidates_list_path).count()
    assert load_clusters(spark, cfg.clusters_path).count() == n and load_candidates_mapping(spark, cfg.candidates_mapping_path).count() > n
    counts = {r.cluster_label: int(r.doc_count) for r in read_any(spark, cfg.doc_counts_path).collect()}
    assert counts["solid cell"] == counts["porous electrode"] == 5
    assert read_any(spark, cfg.output_path).count() > 0
    # A new list makes the stages behind it run again.
    changed = Pipeline(spark, cfg, ExtractConfig(use_ngram_backoff=False, max_candidate_length=3))
    assert changed.run() == {"extract": True, "rank": True, "cluster": True, "count": True}
    (tmp_path / "cfg.json").write_text(json.dumps(raw))
    (tmp_path / "ex.json").write_text(json.dumps({"use_ngram_backoff": False, "max_candidate_length": 3}))
    assert main(["run", "--config", str(tmp_path / "cfg.json"), "--extract-config", str(tmp_path / "ex.json")]) == 0


def jobs(spark, run):
    """Jobs submitted by ``run``, by the scheduler's own count; the status tracker forgets old ones in a long session."""
    scheduler = spark.sparkContext._jsc.sc().dagScheduler()
    before = scheduler.numTotalJobs()
    run()
    return scheduler.numTotalJobs() - before


def test_jobs_do_not_grow_with_chunks(spark, tmp_path):
    from phrasemill.plans.pipeline import Pipeline

    spark.createDataFrame([(i, f"porous electrode {i}", "a solid cell") for i in range(24)], "APPLN_ID BIGINT, APPLN_TITLE STRING, APPLN_ABSTR STRING").write.parquet(str(tmp_path / "in.parquet"))
    took = []
    for size in (12, 4, 1):
        raw = shipped(tmp_path, str(tmp_path), ".parquet")
        for part in ("extraction", "semantic"):
            raw[part]["checkpoint_dir"] += str(size)
        raw["extraction"]["extract_chunk_size"] = raw["semantic"]["doc_chunk_size"] = size
        raw |= {k: raw[k].replace(".parquet", f"{size}.parquet") for k in ("candidates_list_path", "candidates_mapping_path", "output_path")}
        pipe = Pipeline(spark, RankConfig.from_dict(raw), CFG)
        took.append(jobs(spark, lambda: (pipe.run_extract(), pipe.run_rank())))
    assert took[0] == took[1] == took[2] > 0


def test_interrupted_chunks_are_written_anew_and_empty_ones_count(spark, tmp_path):
    d = assign_chunks(docs(spark, *[(i, "t", "a") for i in range(6)]), "row_id", 2).select("row_id", "chunk_id")
    store = ChunkStore(tmp_path / "c", "one")
    d.filter("chunk_id = 'chunk_0001'").write.partitionBy("chunk_id").parquet(str(tmp_path / "c"))  # left by a run that died
    store.save_all(["chunk_0000", "chunk_0001", "chunk_0002"], d.filter("chunk_id <> 'chunk_0002'"))
    again = ChunkStore(f"file://{tmp_path}/c", "one")
    assert found(again.load_all(spark, "row_id BIGINT"), "row_id") == [(0,), (1,), (2,), (3,)] and again.is_done("chunk_0002")


def test_keep_duplicates(spark):
    d = docs(spark, (1, "zinc cell", "zinc cell and zinc cell"))
    for keep, spans in ((True, 2), (False, 1)):
        got = extract.extract(d, ExtractConfig(use_ngram_backoff=False, use_dependency_phrases=False, keep_duplicates=keep))
        assert found(got.filter("candidate = 'zinc cell'"), "source_section", "n_spans") == [("abstract", spans), ("title", 1)]


def test_ranking_in_order(spark):
    df = spark.createDataFrame([(2, 1, 1), (1, 5, 2), (1, 4, 1), (1, 3, 1)], "row_id BIGINT, candidate_id BIGINT, rank_tfidf INT")
    assert found(ranking.in_rank_order(df), "place", "row_id", "candidate_id") == [(1, 1, 3), (2, 1, 4), (3, 1, 5), (4, 2, 1)]


def test_model_backend_gives_its_own_chunks_phrases_and_lemmas(spark):
    """A stand-in for the model: what matters is which of its answers become spans and forms."""
    from phrasemill.functions import spacy_backend

    class Token:
        def __init__(self, i, text, pos, dep, lemma):
            self.i, self.text, self.pos_, self.dep_, self.lemma_, self.lefts = i, text, pos, dep, lemma, []
            self.is_punct, self.is_stop, self.like_num, self.is_digit = pos == "PUNCT", text == "the", False, False

    class Doc(list):
        noun_chunks = ()

    class Chunk:
        def __init__(self, start, end):
            self.start, self.end = start, end

    def load(name, lemmas):
        class Model:
            def pipe(self, texts):
                for _ in texts:
                    d = Doc([Token(0, "the", "DET", "det", "the"), Token(1, "Solid", "ADJ", "amod", "solid"), Token(2, "State", "NOUN", "compound", "state"), Token(3, "Batteries", "NOUN", "ROOT", "battery"), Token(4, "Volta", "PROPN", "appos", "volt")])
                    d[3].lefts = [d[0], d[1], d[2]]
                    d.noun_chunks = (Chunk(0, 4),)
                    yield d

        return Model()

    out = spacy_backend.spacy_tokens(extract.sections(docs(spark, (1, "x", None))), "m", 4, True, load).first()
    assert out.cls == "SANNN" and [tuple(s) for s in out.model_chunks] == [(1, 4)] and [tuple(s) for s in out.model_phrases] == [(2, 3)]
    assert out.model_lemmas == ["the", "solid", "state", "battery", "Volta"]
    assert spacy_backend.phrase_spans([], 4) == []

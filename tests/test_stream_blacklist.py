from phrasemill.config import ExtractConfig
from phrasemill.streaming.extract_stream import stream_occurrences

DOCS = "row_id BIGINT, title STRING, abstract STRING"


def test_streamed_extraction_leaves_out_blacklisted_phrases(spark, tmp_path):
    (tmp_path / "b.txt").write_text("# note\nPorous Electrode\n")
    spark.createDataFrame([(1, "porous electrode", None), (2, "zinc anode", None)], DOCS).write.parquet(str(tmp_path / "in"))
    cfg = ExtractConfig(use_ngram_backoff=False, blacklist_path=str(tmp_path / "b.txt"))
    stream_occurrences(spark, str(tmp_path / "in"), DOCS, str(tmp_path / "out"), str(tmp_path / "ck"), cfg).awaitTermination(60)
    assert [r.candidate for r in spark.read.parquet(str(tmp_path / "out")).collect()] == ["zinc anode"]

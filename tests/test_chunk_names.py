from phrasemill.sources.chunks import assign_chunks


def test_chunks_beyond_four_digits_stay_apart(spark):
    d = assign_chunks(spark.range(10_012).withColumnRenamed("id", "row_id"), "row_id", 1)
    got = {r.chunk_no: r.chunk_id for r in d.collect()}
    assert len(set(got.values())) == len(got) == 10_012
    assert got[7] == "chunk_0007" and got[9_999] == "chunk_9999" and got[10_000] == "chunk_10000" and got[10_011] == "chunk_10011"

import __spark_entry__ as entry
from phrasemill.operators import cluster

DATA = "/root/testdata"


def test_small_cap_has_work_and_skips_at_every_scale(spark):
    for sf in ("sf0.01", "sf0.1"):
        q = {n: entry.queries()[n](spark, f"{DATA}/{sf}") for n in ("q_block_cap_candidates", "q_candidate_edges", "q_block_cap_skipped", "q_blocks")}
        assert 0 < q["q_block_cap_candidates"].count() < q["q_candidate_edges"].count()
        assert all(r.block_size > 50 for r in q["q_block_cap_skipped"].collect()) and q["q_block_cap_skipped"].count() > 0
        sizes = [r.block_size for r in q["q_blocks"].collect()]
        assert min(sizes) <= 50 < max(sizes)


def test_oversize_blocks(spark):
    v = spark.createDataFrame([("a",)] * 3 + [("b",)] * 2 + [(None,)] * 9, "block STRING")
    assert [tuple(r) for r in cluster.oversize_blocks(v, 2).collect()] == [("a", 3)]

from pyspark.sql import functions as F

from phrasemill.config import RankConfig
from phrasemill.functions import embedding
from phrasemill.plans.pipeline import Pipeline


def test_clusters_use_the_configured_embedder(spark, tmp_path, monkeypatch):
    class ByModel(embedding.Embedder):
        def __init__(self, model_name):
            self.model_name = model_name

        def embed(self, text):
            return F.when(F.lit(self.model_name == "one"), F.array(F.lit(1.0), F.lit(0.0))).when(text.endswith("a"), F.array(F.lit(1.0), F.lit(0.0))).otherwise(F.array(F.lit(0.0), F.lit(1.0)))

    monkeypatch.setitem(embedding._BACKENDS, "by_model", ByModel)
    spark.createDataFrame([(0, "cell alpha"), (1, "cell q")], "candidate_id BIGINT, candidate STRING").write.parquet(str(tmp_path / "l"))
    for model, clusters in (("one", 1), ("two", 2)):
        cfg = RankConfig(candidates_list_path=str(tmp_path / "l"), clusters_path=str(tmp_path / model), embedder="by_model", model_name=model)
        assert Pipeline(spark, cfg).run_cluster()
        assert spark.read.parquet(str(tmp_path / model)).select("cluster_id").distinct().count() == clusters

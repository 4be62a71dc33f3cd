"""Stage 1 over a stream of documents: extraction is stateless per document, ranking stays a batch job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..config import ExtractConfig
from ..operators.extract import extract
from ..sources.tables import load_blacklist


def stream_occurrences(spark: SparkSession, source_dir: str, schema: str, out_dir: str, checkpoint: str, cfg: ExtractConfig = ExtractConfig()) -> StreamingQuery:
    """Start a query that appends the occurrences of each newly arrived parquet file to ``out_dir``.

    Documents (``row_id, title, abstract``) are taken as they arrive; a batch id names its folder, so a repeated batch
    replaces its own output and nothing is written twice. The blacklist of ``cfg`` is read anew for each batch.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        black = load_blacklist(batch.sparkSession, cfg.blacklist_path) if cfg.blacklist_path else None
        extract(batch, cfg, black).write.mode("overwrite").parquet(f"{out_dir}/batch={batch_id}")

    docs = spark.readStream.schema(schema).parquet(source_dir)
    return docs.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

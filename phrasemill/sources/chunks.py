"""Resumable chunk datasets: parquet parts by ``chunk_id`` and a JSON manifest with a configuration fingerprint."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import files


def fingerprint(config: object) -> str:
    """Short digest of a configuration; a changed one makes old chunks unusable."""
    return hashlib.sha256(repr(config).encode()).hexdigest()[:16]


class ChunkStore:
    """Chunks of one stage in ``directory``, on any file system Spark can write to.

    A chunk counts as done only after its files are complete. A manifest of another configuration counts as none.
    """

    def __init__(self, directory: str, config: object = None, spark: SparkSession | None = None):
        self.spark = spark or SparkSession.active()
        self.dir, self.config = str(directory).rstrip("/"), config
        self.manifest = f"{self.dir}/manifest.json"
        self.completed: set[str] = set()
        self.empty: set[str] = set()
        if files.exists(self.spark, self.manifest):
            d = json.loads(files.read_text(self.spark, self.manifest))
            if config is None or d.get("fingerprint") in (None, fingerprint(config)):
                self.completed, self.empty = set(d["completed"]), set(d.get("empty", []))

    def is_done(self, chunk_id: str) -> bool:
        return chunk_id in self.completed

    def n_completed(self) -> int:
        return len(self.completed)

    def pending(self, chunk_ids: list[str]) -> list[str]:
        """Those of ``chunk_ids`` that are not done, in order."""
        return [c for c in chunk_ids if c not in self.completed]

    def _path(self, chunk_id: str) -> str:
        return f"{self.dir}/chunk_id={chunk_id}"

    def _mark(self, chunk_ids: list[str]) -> None:
        there = files.folders(self.spark, self.dir)
        self.completed |= set(chunk_ids)
        self.empty = {c for c in self.empty - set(chunk_ids)} | {c for c in chunk_ids if f"chunk_id={c}" not in there}
        text = json.dumps({"completed": sorted(self.completed), "empty": sorted(self.empty), "fingerprint": fingerprint(self.config)})
        files.write_text(self.spark, self.manifest, text)

    def save(self, chunk_id: str, df: DataFrame) -> None:
        """Write one chunk's files, then add it to the manifest."""
        df.write.mode("overwrite").parquet(self._path(chunk_id))
        self._mark([chunk_id])

    def save_all(self, chunk_ids: list[str], df: DataFrame) -> None:
        """Write all of ``chunk_ids`` from ``df``, which has their names in ``chunk_id``, in one job, then add them to the manifest.

        Whatever an earlier run left of these chunks is replaced; other chunks are not touched.
        """
        if not chunk_ids:
            return
        there = files.folders(self.spark, self.dir)
        for c in chunk_ids:
            if f"chunk_id={c}" in there:
                files.delete(self.spark, self._path(c))
        df.repartition("chunk_id").write.mode("append").partitionBy("chunk_id").parquet(self.dir)
        self._mark(chunk_ids)

    def load_all(self, spark: SparkSession, schema: str) -> DataFrame:
        """All finished chunks with their ``chunk_id``; an empty typed table if there is none.

        ``FileNotFoundError`` if a chunk of the manifest has lost its files.
        """
        there = files.folders(self.spark, self.dir)
        full = sorted(self.completed - self.empty)
        for c in full:
            if f"chunk_id={c}" not in there:
                raise FileNotFoundError(f"chunk {c} is in the manifest but not in {self.dir}")
        if not full:
            return spark.createDataFrame([], schema + ", chunk_id STRING")
        return spark.read.schema(schema + ", chunk_id STRING").option("basePath", self.dir).parquet(*map(self._path, full))

    def clear(self) -> None:
        """Delete the chunks of the manifest, then the manifest; other files stay."""
        for c in self.completed:
            files.delete(self.spark, self._path(c))
        files.delete(self.spark, self.manifest)
        self.completed, self.empty = set(), set()


def assign_chunks(df: DataFrame, key: str, chunk_size: int) -> DataFrame:
    """``df`` with ``chunk_no`` and ``chunk_id``: consecutive runs of ``chunk_size`` ids in key order.

    Positions come from a range-partitioned numbering, so no single task sorts the table.
    """
    from ..operators.balanced import dense_ids
    from ..functions.text import chunk_name

    pos = dense_ids(df, [key], "_pos")
    no = F.floor(F.col("_pos") / chunk_size).cast("bigint")
    return pos.withColumn("chunk_no", no).withColumn("chunk_id", chunk_name(no)).drop("_pos")

"""The staged pipeline: extract, rank, cluster, count; a stage whose output is complete is skipped."""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ExtractConfig, RankConfig
from ..functions.embedding import get_embedder
from ..operators.cluster import cluster_candidates
from ..operators.coverage import cluster_doc_counts
from ..operators.dictionary import candidates_list, candidates_mapping, chunk_candidates
from ..operators.extract import extract
from ..operators.ranking import rank_candidates
from ..sources import files
from ..sources.chunks import ChunkStore, assign_chunks, fingerprint
from ..sources.tables import latest_revision, load_blacklist, load_candidates_list, load_candidates_mapping, load_clusters, load_source_documents, write_clusters, write_table

OCCURRENCES = (
    "row_id BIGINT, candidate STRING, surface_form STRING, source_section STRING, extraction_source STRING, "
    "section_ord INT, source_ord INT, span_ord INT, n_spans BIGINT"
)


def _mark(spark: SparkSession, path: str) -> dict:
    mark = path + ".stage.json"
    return json.loads(files.read_text(spark, mark)) if files.exists(spark, mark) else {}


def is_complete(spark: SparkSession, path: str, config: object, *inputs: str) -> bool:
    """True if ``path`` was written to its end under the same configuration and from the ``inputs`` as they are now."""
    return files.exists(spark, path + "/_SUCCESS") and _mark(spark, path).get("fingerprint") == _state(spark, config, inputs)


def _state(spark: SparkSession, config: object, inputs: tuple[str, ...]) -> str:
    return fingerprint((config, [_mark(spark, i).get("run") for i in inputs]))


def _done(spark: SparkSession, path: str, config: object, *inputs: str) -> None:
    files.write_text(spark, path + ".stage.json", json.dumps({"fingerprint": _state(spark, config, inputs), "run": uuid.uuid4().hex}))


class Pipeline:
    """Runs the stages over the paths of a :class:`RankConfig`, parquet or CSV by suffix, on any file system Spark knows.

    Outputs are folders of part files with a mark beside them. A stage runs again if its configuration changed or an
    earlier stage wrote its input anew.
    """

    def __init__(self, spark: SparkSession, rank: RankConfig, extract_cfg: ExtractConfig = ExtractConfig()):
        self.spark, self.rank_cfg, self.extract_cfg = spark, rank, extract_cfg
        self.chunk_report: DataFrame | None = None  # documents' distinct candidates by chunk, once stage 1 has run

    def documents(self) -> DataFrame:
        c = self.rank_cfg
        return latest_revision(load_source_documents(self.spark, c.data_path, c.id_column, c.title_column, c.abstract_column))

    def run_extract(self) -> bool:
        """Stage 1: all chunks that an earlier run did not finish, in one job; False if the stage was complete."""
        c, cfg = self.rank_cfg, (self.rank_cfg.data_path, self.extract_cfg)
        if is_complete(self.spark, c.candidates_list_path, cfg) and is_complete(self.spark, c.candidates_mapping_path, cfg):
            return False
        store = ChunkStore(c.extract_checkpoint_dir, cfg, self.spark)
        docs = assign_chunks(self.documents(), "row_id", c.extract_chunk_size)
        names = sorted(r["chunk_id"] for r in docs.select("chunk_id").distinct().collect())  # one row per chunk
        black = load_blacklist(self.spark, self.extract_cfg.blacklist_path) if self.extract_cfg.blacklist_path else None
        todo = store.pending(names)
        if todo:
            done = self.spark.createDataFrame([(x,) for x in sorted(store.completed)], "chunk_id STRING")
            mine = docs.join(done, "chunk_id", "left_anti") if store.completed else docs
            found = extract(mine.select("row_id", "title", "abstract"), self.extract_cfg, black)
            store.save_all(todo, found.join(mine.select("row_id", "chunk_id"), "row_id"))
        occ = store.load_all(self.spark, OCCURRENCES)
        self.chunk_report = chunk_candidates(occ)
        write_table(candidates_list(occ), c.candidates_list_path)
        listed = load_candidates_list(self.spark, c.candidates_list_path)
        write_table(candidates_mapping(occ, listed, self.extract_cfg.tf_mode == "raw"), c.candidates_mapping_path)
        _done(self.spark, c.candidates_list_path, cfg)
        _done(self.spark, c.candidates_mapping_path, cfg)
        return True

    def _stage(self, path: str, inputs: tuple[str, ...], build, write=write_table) -> bool:
        if is_complete(self.spark, path, self.rank_cfg, *inputs):
            return False
        write(build(), path)
        _done(self.spark, path, self.rank_cfg, *inputs)
        return True

    def _list(self) -> DataFrame:
        return load_candidates_list(self.spark, self.rank_cfg.candidates_list_path, self.rank_cfg.candidates_list_columns)

    def _mapping(self) -> DataFrame:
        return load_candidates_mapping(self.spark, self.rank_cfg.candidates_mapping_path, self.rank_cfg.candidates_mapping_columns)

    def run_rank(self) -> bool:
        c = self.rank_cfg
        inputs = (c.candidates_list_path, c.candidates_mapping_path)
        store = ChunkStore(c.semantic_checkpoint_dir, (c, _state(self.spark, None, inputs)), self.spark) if c.doc_chunk_size else None
        return self._stage(c.output_path, inputs, lambda: rank_candidates(self._mapping(), self._list(), self.documents(), c, store))

    def run_cluster(self) -> bool:
        c = self.rank_cfg
        clusters = lambda: cluster_candidates(self._list(), c.semantic_threshold, c.max_block_size, get_embedder(c.embedder, model_name=c.model_name))
        return self._stage(c.clusters_path, (c.candidates_list_path,), clusters, write_clusters)

    def run_count(self) -> bool:
        c = self.rank_cfg
        counts = lambda: cluster_doc_counts(self._mapping(), load_clusters(self.spark, c.clusters_path)).orderBy(F.desc("doc_count"), "cluster_id")
        return self._stage(c.doc_counts_path, (c.candidates_mapping_path, c.clusters_path), counts)

    def run(self) -> dict[str, bool]:
        """All stages; True for those that ran, False for those skipped."""
        return {"extract": self.run_extract(), "rank": self.run_rank(), "cluster": self.run_cluster(), "count": self.run_count()}


def describe(cfg: RankConfig) -> str:
    """The configuration as JSON."""
    return json.dumps(asdict(cfg), indent=1)

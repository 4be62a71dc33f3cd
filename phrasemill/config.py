"""Configuration, read from the two JSON files a user of the pipeline already has."""

from __future__ import annotations

import json
import warnings
from dataclasses import dataclass, field, fields
from pathlib import Path
from typing import Any

#: Keys that the configuration files may hold but that change nothing.
IGNORED = ("trim_stopword_edges", "language", "title_weight", "abstract_weight", "n_process", "batch_size")


def load_json(path: str | Path) -> dict[str, Any]:
    """A JSON object from a file on the driver."""
    return json.loads(Path(path).read_text(encoding="utf-8"))


@dataclass(frozen=True)
class ExtractConfig:
    """Options of candidate extraction."""

    use_noun_chunks: bool = True
    use_dependency_phrases: bool = True
    use_ngram_backoff: bool = True
    ngram_min: int = 2
    ngram_max: int = 3
    min_candidate_length: int = 1
    max_candidate_length: int = 4
    lowercase: bool = True
    normalization_mode: str = "conservative"
    apply_light_lemmatization: bool = False
    keep_duplicates: bool = True
    blacklist_path: str | None = None
    hyphen: str = "split"
    tf_mode: str = "section"
    nlp_backend: str = "rules"
    spacy_model: str = "en_core_web_sm"

    @property
    def lemmatize(self) -> bool:
        """Lemmas replace nouns and adjectives only if both switches are set."""
        return self.normalization_mode == "lemma" and self.apply_light_lemmatization

    @classmethod
    def from_dict(cls, d: dict[str, Any]) -> ExtractConfig:
        """Known keys are taken; keys without effect give a warning; comments are skipped."""
        for k in d:
            if k in IGNORED:
                warnings.warn(f"configuration key {k!r} has no effect", stacklevel=2)
        known = {f.name for f in fields(cls)}
        return cls(**{k: v for k, v in d.items() if k in known})


@dataclass(frozen=True)
class RankConfig:
    """Options of ranking, clustering and of the staged pipeline."""

    data_path: str = ""
    id_column: str = "APPLN_ID"
    title_column: str = "APPLN_TITLE"
    abstract_column: str = "APPLN_ABSTR"
    candidates_list_path: str = "outputs/candidates_list"
    candidates_mapping_path: str = "outputs/candidates_mapping"
    candidates_list_columns: dict[str, str] = field(default_factory=dict)
    candidates_mapping_columns: dict[str, str] = field(default_factory=dict)
    format_mode: str = "cls_sep"
    cls_token: str = "[CLS]"
    sep_token: str = "[SEP]"
    extract_chunk_size: int = 5000
    extract_checkpoint_dir: str = "outputs/checkpoints/extraction"
    embedder: str = "hashed"
    model_name: str = "all-MiniLM-L6-v2"
    doc_chunk_size: int | None = 100_000
    semantic_checkpoint_dir: str = "outputs/checkpoints/semantic"
    smoothed_idf: bool = True
    output_path: str = "outputs/ranked_candidates"
    semantic_threshold: float = 0.85
    max_block_size: int | None = 2000
    clusters_path: str = "outputs/candidate_clusters"
    doc_counts_path: str = "outputs/cluster_doc_counts"

    @classmethod
    def from_dict(cls, d: dict[str, Any]) -> RankConfig:
        """From the nested form of the ranking file; an absent key keeps its default."""
        nested = {
            "format_mode": ("text_formatting", "mode"),
            "cls_token": ("text_formatting", "cls_token"),
            "sep_token": ("text_formatting", "sep_token"),
            "extract_chunk_size": ("extraction", "extract_chunk_size"),
            "extract_checkpoint_dir": ("extraction", "checkpoint_dir"),
            "embedder": ("semantic", "backend"),
            "model_name": ("semantic", "model_name"),
            "doc_chunk_size": ("semantic", "doc_chunk_size"),
            "semantic_checkpoint_dir": ("semantic", "checkpoint_dir"),
            "smoothed_idf": ("tfidf", "smoothed_idf"),
            "semantic_threshold": ("clustering", "semantic_threshold"),
            "max_block_size": ("clustering", "max_block_size"),
            "clusters_path": ("clustering", "output_path"),
            "doc_counts_path": ("clustering", "doc_counts_path"),
        }
        known = {f.name for f in fields(cls)}
        flat = {k: v for k, v in d.items() if k in known}
        for name, (group, key) in nested.items():
            if key in d.get(group, {}):
                flat[name] = d[group][key]
        return cls(**flat)

"""Embedding backends: a registry, the built-in hashed-trigram encoder and an optional model adapter."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

DIM = 64
_BACKENDS: dict[str, Callable[..., "Embedder"]] = {}


def register_embedder(name: str):
    """Decorator: make an embedder class available to :func:`get_embedder`."""

    def add(cls):
        _BACKENDS[name] = cls
        return cls

    return add


def get_embedder(backend: str = "hashed", **options) -> "Embedder":
    """The backend ``backend``; ``ValueError`` naming the known ones otherwise."""
    if backend not in _BACKENDS:
        raise ValueError(f"unknown embedding backend {backend!r}; available: {sorted(_BACKENDS)}")
    return _BACKENDS[backend](**options)


class Embedder:
    """Turns a text column into unit vectors (zero for null and empty texts)."""

    def embed(self, text: Column) -> Column:
        raise NotImplementedError


@register_embedder("hashed")
class HashedTrigramEmbedder(Embedder):
    """Character trigrams of the lower-cased text, counted in ``dim`` buckets, at unit length.

    The bucket of a trigram is the number in the first eight hex digits of its MD5 modulo ``dim``. Texts of fewer than
    three characters, empty and null texts give the zero vector.
    """

    def __init__(self, dim: int = DIM, **_):
        self.dim = dim

    def embed(self, text: Column) -> Column:
        dim = self.dim

        @F.pandas_udf("array<double>")
        def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            bucket: dict[str, int] = {}

            def vector(t: str | None) -> np.ndarray:
                low = (t or "").lower()
                grams = [low[i : i + 3] for i in range(len(low) - 2)]
                for g in grams:
                    if g not in bucket:
                        bucket[g] = int(hashlib.md5(g.encode()).hexdigest()[:8], 16) % dim
                v = np.bincount([bucket[g] for g in grams], minlength=dim).astype(float) if grams else np.zeros(dim)
                n = np.sqrt((v * v).sum())
                return v / n if n > 0 else v

            for s in batches:
                if len(bucket) > 500_000:
                    bucket.clear()
                yield pd.Series([vector(t) for t in s], index=s.index)

        return encode(text)


@register_embedder("sentence_transformers")
class SentenceTransformerEmbedder(Embedder):
    """Adapter for a sentence-transformers model; the library is loaded lazily, once per Python worker."""

    def __init__(self, model_name: str = "all-MiniLM-L6-v2", batch_size: int = 64, **_):
        try:
            import sentence_transformers  # noqa: F401
        except ImportError as e:
            raise ImportError("the sentence_transformers backend needs the package sentence-transformers") from e
        self.model_name, self.batch_size = model_name, batch_size

    def embed(self, text: Column) -> Column:
        name, size = self.model_name, self.batch_size

        @F.pandas_udf("array<double>")
        def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            from sentence_transformers import SentenceTransformer

            model = SentenceTransformer(name)
            for s in batches:
                texts = [t or "" for t in s]
                vectors = model.encode(texts, batch_size=size, normalize_embeddings=True, show_progress_bar=False)
                yield pd.Series([np.zeros(len(v)) if not t else v.astype(float) for t, v in zip(texts, vectors)], index=s.index)

        return encode(text)

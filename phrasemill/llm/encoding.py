"""Problem 8: byte-level BPE ids of every text, by backtracking over longest token matches."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Split of a text into pieces that are merged on their own; the public pattern of the rank files.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
KNOWN_PIECES = 200_000
_ENCODERS: dict[str, "Encoder"] = {}


def parse_ranks(data: bytes) -> dict[bytes, int]:
    """Tokens and ids of a rank file: one base64 token and one number a line."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line.strip())}


class Encoder:
    """Exact merges without merging: cut a piece into the longest tokens, step back where neighbours are incompatible.

    A sequence of tokens is the one that merging gives exactly if each two neighbours are what merging makes of their
    joint bytes. So the encoder walks forward with the longest match from an Aho-Corasick scan, asks a table of
    neighbour compatibility (filled as needed), takes the next shorter token where it says no, and steps back where none
    is left. A position from which nothing fits is never tried again, so the time is linear in the bytes of the piece.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str = PIECES):
        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for t, i in ranks.items():
            self.tokens[i] = t
        self.scan = ahocorasick.Automaton()
        for t, i in ranks.items():
            self.scan.add_word(t.decode("latin-1"), i)
        self.scan.make_automaton()
        self.blob = np.frombuffer(b"".join(self.tokens), dtype=np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(t) for t in self.tokens])])
        self.fits: dict[tuple[int, int], bool] = {}
        self.shorter_of: dict[int, int | None] = {}
        self.known: dict[str, list[int]] = {}

    def merge(self, data: bytes) -> list[int]:
        """The definition: merge the adjacent pair of lowest id until none is a token. Used on two tokens at a time."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            pairs = [self.ranks.get(a + b, 1 << 60) for a, b in zip(parts, parts[1:])]
            i = min(range(len(pairs)), key=pairs.__getitem__)
            if pairs[i] == 1 << 60:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def compatible(self, a: int, b: int) -> bool:
        key = (a, b)
        if key not in self.fits:
            if len(self.fits) > 2_000_000:
                self.fits.clear()
            self.fits[key] = self.merge(self.tokens[a] + self.tokens[b]) == [a, b]
        return self.fits[key]

    def shorter(self, i: int) -> int | None:
        """The longest token that is a proper prefix of token ``i``."""
        if i not in self.shorter_of:
            t = self.tokens[i]
            self.shorter_of[i] = next((self.ranks[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in self.ranks), None)
        return self.shorter_of[i]

    def encode_piece(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        n, tokens = len(data), self.tokens
        longest: list[int | None] = [None] * n
        for end, i in self.scan.iter(data.decode("latin-1")):
            start = end - len(tokens[i]) + 1
            if longest[start] is None or len(tokens[i]) > len(tokens[longest[start]]):
                longest[start] = i
        dead, out, at, t = bytearray(n + 1), [], 0, longest[0]
        while at < n:
            while t is not None and (dead[at + len(tokens[t])] or (out and not self.compatible(out[-1], t))):
                t = self.shorter(t)
            if t is not None:
                out.append(t)
                at += len(tokens[t])
                t = longest[at] if at < n else None
            elif out:
                dead[at] = 1
                last = out.pop()
                at -= len(tokens[last])
                t = self.shorter(last)
            else:
                raise ValueError(f"the vocabulary can't write {data[:40]!r}")
        return out

    def encode(self, text: str) -> list[int]:
        """Ids of a text; '' gives none. Strings of special tokens are ordinary text."""
        known, out = self.known, []
        for piece in self.split(text):
            ids = known.get(piece)
            if ids is None:
                ids = self.encode_piece(piece.encode())
                if len(piece) <= 64:
                    if len(known) >= KNOWN_PIECES:
                        known.clear()
                    known[piece] = ids
            out += ids
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, gathered from one byte table by token offsets."""
        ids = np.asarray(ids, dtype=np.int64)
        start, size = self.offsets[ids], self.offsets[ids + 1] - self.offsets[ids]
        jump = np.repeat(start - np.concatenate([[0], np.cumsum(size)[:-1]]), size) if len(ids) else np.zeros(0, np.int64)
        return self.blob[jump + np.arange(len(jump))].tobytes().decode()


def encoder(data: bytes) -> Encoder:
    """The encoder of a rank file's bytes, built once per Python worker."""
    key = hashlib.sha256(data).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(parse_ranks(data))
    return _ENCODERS[key]


def _lists(rows: list[list[int]]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)])
    flat = np.fromiter((i for r in rows for i in r), dtype=np.int32, count=int(ends[-1]))
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))


def encode_texts(df: DataFrame, key: str, text: str, vocabulary: str) -> DataFrame:
    """``key, ids`` of every row, in one narrow pass; empty and null texts get an empty list, whole texts are encoded.

    ``vocabulary`` is the path of a rank file on the driver. Its bytes (under 1 MB, of fixed size) go to the workers as
    a broadcast, so executors need no copy of the file.
    """
    with open(vocabulary, "rb") as f:
        shared = df.sparkSession.sparkContext.broadcast(f.read())
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(shared.value).encode
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                b = whole.slice(at, 1000)
                yield pa.RecordBatch.from_arrays([b.column(0), _lists([encode(t) if t else [] for t in b.column(1).to_pylist()])], [key, "ids"])

    return df.select(key, text).mapInArrow(run, f"`{key}` {kind}, ids ARRAY<INT>")


def decode_ids(df: DataFrame, key: str, ids: str, vocabulary: str) -> DataFrame:
    """``key, text`` of every list of ids; an empty list gives '', a null list null."""
    with open(vocabulary, "rb") as f:
        shared = df.sparkSession.sparkContext.broadcast(f.read())
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = encoder(shared.value).decode
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([None if x is None else decode(x) for x in b.column(1).to_pylist()], pa.string())], [key, "text"])

    return df.select(key, F.col(ids).cast("array<int>")).mapInArrow(run, f"`{key}` {kind}, text STRING")

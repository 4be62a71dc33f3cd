"""Problem 9: passages of held-out items inside documents, by a suffix automaton over the items' words."""

from __future__ import annotations

import hashlib
import pickle
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.storage import materialize
from .characters import skeleton

#: A token of the original text: word characters with the invisible and combining ones that may stand between them.
TOKEN = re.compile("[\\w­̀-ͯ​-‏‪-‮⁠-⁤︀-️﻿]+")
PARTS = re.compile(r"\w+")
LEAST_RUN, LEAST_WORDS, LEAST_SHARE, LONG_RUN = 6, 12, 0.5, 25
#: Item words of one automaton: about 55 bytes a word in a worker (80 at most seen), 500 while it is built.
BLOCK_WORDS = 1_500_000
#: Bytes of automata that a worker holds at once; items beyond it ask for another pass over the documents.
PASS_BYTES = 400_000_000


def words(text: str, memo: dict[str, list[str]]) -> list[tuple[str, int, int]]:
    """Words with their place in ``text``: lower case, without invisible characters, look-alikes as Latin letters."""
    out = []
    for m in TOKEN.finditer(text):
        t = m[0]
        parts = memo.get(t)
        if parts is None:
            parts = PARTS.findall(t.lower() if t.isascii() else skeleton(t).casefold())
            if len(memo) > 500_000:
                memo.clear()
            memo[t] = parts
        for w in parts:
            out.append((w, m.start(), m.end()))
    return out


class SuffixAutomaton:
    """Generalised suffix automaton of word sequences in flat arrays, with the places (item, end) of every state.

    Transitions lie in the order of state and word. The places of a state are those of its subtree in the tree of suffix
    links; states are numbered along that tree, so they are one run of the list of places, which thus is linear in the items.
    """

    def __init__(self, items: Iterable[tuple[int, list[str]]], least_run: int = LEAST_RUN):
        self.least = least_run
        self.vocabulary: dict[str, int] = {}
        self.names: list[int] = []
        self.size: dict[int, int] = {}
        link, length = [-1], [0]
        moves: dict[int, int] = {}  # state << 32 | word
        leaving: list[list[int]] = [[]]  # words of a state's transitions
        at_state, at_item, at_end = [], [], []

        def state(n: int, up: int, words_: list[int]) -> int:
            link.append(up)
            length.append(n)
            leaving.append(words_)
            return len(link) - 1

        def split(p: int, w: int, q: int) -> int:
            """The state of just those suffixes in ``q`` that are ``p``'s longest one and ``w``."""
            if length[q] == length[p] + 1:
                return q
            part = state(length[p] + 1, link[q], list(leaving[q]))
            for x in leaving[q]:
                moves[part << 32 | x] = moves[q << 32 | x]
            while p >= 0 and moves.get(p << 32 | w) == q:
                moves[p << 32 | w] = part
                p = link[p]
            link[q] = part
            return part

        for item, seq in items:
            self.size[item] = len(seq)
            self.names.append(item)
            last = 0
            for pos, word in enumerate(seq):
                w = self.vocabulary.setdefault(word, len(self.vocabulary))
                known = moves.get(last << 32 | w)
                if known is not None:
                    last = split(last, w, known)
                else:
                    new, p = state(length[last] + 1, 0, []), last
                    while p >= 0 and (p << 32 | w) not in moves:
                        moves[p << 32 | w] = new
                        leaving[p].append(w)
                        p = link[p]
                    if p >= 0:
                        link[new] = split(p, w, moves[p << 32 | w])
                    last = new
                at_state.append(last)
                at_item.append(len(self.names) - 1)
                at_end.append(pos + 1)
        del leaving
        self._freeze(link, length, moves, at_state, at_item, at_end)

    def _freeze(self, link: list[int], length: list[int], moves: dict[int, int], at_state: list[int], at_item: list[int], at_end: list[int]) -> None:
        n, least = len(link), self.least
        keys, to = np.fromiter(moves.keys(), np.int64, len(moves)), np.fromiter(moves.values(), np.int32, len(moves))
        moves.clear()
        order = np.argsort(keys)
        keys, self.to = keys[order], to[order]
        self.word = (keys & 0xFFFFFFFF).astype(np.int32)
        self.first = np.searchsorted(keys >> 32, np.arange(n + 1)).astype(np.int32)
        own = np.bincount(np.array(at_state, dtype=np.int64), minlength=n)
        count, by_length = own.tolist(), np.argsort(length, kind="stable").tolist()
        for s in reversed(by_length[1:]):
            count[link[s]] += count[s]
        start, free, top, above = [0] * n, [0] * n, list(range(n)), list(range(n))
        free[0] = int(own[0])
        for s in by_length[1:]:  # a state comes after the one its link leads to
            up = link[s]
            start[s] = free[up]
            free[up] += count[s]
            free[s] = start[s] + int(own[s])
            if length[up] >= least:
                top[s] = top[up]
            if length[up] > least:
                above[s] = above[up]
        order = np.argsort(at_state, kind="stable")
        where = np.array(start)[np.array(at_state, dtype=np.int64)[order]] if len(order) else np.zeros(0, np.int64)
        same = np.arange(len(order)) - np.searchsorted(np.array(at_state)[order], np.array(at_state)[order]) if len(order) else where
        self.item, self.end = np.empty(len(order), np.int32), np.empty(len(order), np.int32)
        self.item[where + same], self.end[where + same] = np.array(at_item, np.int32)[order], np.array(at_end, np.int32)[order]
        # topmost states on the way to the root that are long enough, and longer than enough
        self.link, self.length, self.start, self.count, self.top, self.above = (np.array(x, dtype=np.int32) for x in (link, length, start, count, top, above))
        self._views()

    ARRAYS = ("first", "word", "to", "link", "length", "start", "count", "top", "above", "item", "end")

    def _views(self) -> None:
        """Plain memory views, which give single numbers faster than arrays do."""
        self.view = {a: memoryview(getattr(self, a)) for a in self.ARRAYS}
        # All words lead somewhere from the root, and the root's transitions come first, in the order of the words.
        self.view["root"] = self.view["to"][: len(self.vocabulary)]
        self.memo: dict[int, int] = {}

    def _move(self, s: int, w: int) -> int:
        """The state that ``w`` leads to from ``s``, which is not the root, or -1; remembered, up to a bound."""
        first, word = self.view["first"], self.view["word"]
        low, high, t = first[s], first[s + 1], -1
        while low < high:
            mid = (low + high) >> 1
            x = word[mid]
            if x == w:
                t = self.view["to"][mid]
                break
            low, high = (mid + 1, high) if x < w else (low, mid)
        if len(self.memo) >= 500_000:
            self.memo.clear()
        self.memo[s << 32 | w] = t
        return t

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("view", "memo")} | {"vocabulary": "\n".join(self.vocabulary)}

    def __setstate__(self, d):
        self.__dict__.update(d)
        self.vocabulary = {w: i for i, w in enumerate(d["vocabulary"].split("\n"))} if d["vocabulary"] else {}
        self._views()

    def nbytes(self) -> int:
        return sum(getattr(self, a).nbytes for a in self.ARRAYS)

    def stream(self, seq: Iterable[str]) -> Iterator[tuple[int, int, int]]:
        """``(position, state, length)`` of the longest match that ends at a word, wherever it has ``least_run`` words."""
        v, known, least, memo = self.view, self.vocabulary.get, self.least, self.memo
        link, length, move, root = v["link"], v["length"], self._move, v["root"]
        s = n = 0
        for at, text in enumerate(seq):
            w = known(text, -1)
            if w < 0:
                s = n = 0
                continue
            if not s:
                s, n = root[w], 1
            else:
                t = memo.get(s << 32 | w) or move(s, w)
                if t < 0:
                    while True:
                        s = link[s]
                        if not s:
                            t = root[w]
                            break
                        t = memo.get(s << 32 | w) or move(s, w)
                        if t > 0:
                            break
                    n = length[s]
                s, n = t, n + 1
            if n >= least:
                yield at, s, n

    def covered(self, seq: list[str]) -> dict[int, tuple[int, int, list[tuple[int, int]]]]:
        """Per item: its words covered by runs, as a bit mask; the longest run; the runs' spans in ``seq``.

        A match is reported where it ends. While all places of a match go on with the next word, as in a passage that many
        items share, nothing is reported, so a passage costs its length and its places, not their product.
        """
        out: dict[int, list] = {}
        count, top, above, least = self.view["count"], self.view["top"], self.view["above"], self.least
        before = None
        for at, s, n in self.stream(seq):
            if before is not None and not (before[0] == at - 1 and n > least and count[above[s]] == count[top[before[1]]]):
                self._report(out, *before)
            before = at, s, n
        if before is not None:
            self._report(out, *before)
        return {self.names[i]: (mask, longest, spans) for i, (mask, longest, spans) in out.items()}

    def _report(self, out: dict[int, list], at: int, s: int, n: int) -> None:
        v = self.view
        start, count, item, end, link, length, stop = v["start"], v["count"], v["item"], v["end"], v["link"], v["length"], v["top"][s]
        low = high = start[s]  # places that a deeper state has reported with a longer run
        while True:
            bits, begin = (1 << n) - 1, at - n + 1
            for k in (*range(start[s], low), *range(high, start[s] + count[s])):
                mine = out.setdefault(item[k], [0, 0, []])
                mine[0] |= bits << (end[k] - n)
                mine[1] = max(mine[1], n)
                spans = mine[2]
                if spans and spans[-1][1] >= begin:
                    spans[-1] = (min(spans[-1][0], begin), at + 1)
                else:
                    spans.append((begin, at + 1))
            if s == stop:
                return
            low, high = start[s], start[s] + count[s]
            s = link[s]
            n = length[s]


def _build(block_words: int, least_run: int):
    """Automata of the test items of a partition, each of about ``block_words`` words: ``hash, bytes, automaton``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(block):
            data = pickle.dumps(SuffixAutomaton(block, least_run), protocol=5)
            return pa.RecordBatch.from_arrays([pa.array([hashlib.sha256(data).hexdigest()]), pa.array([len(data)]), pa.array([data], pa.binary())], ["hash", "bytes", "automaton"])

        block, n, memo = [], 0, {}
        for b in batches:
            for item, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                seq = [w for w, _, _ in words(text, memo)]
                if seq:
                    block.append((item, seq))
                    n += len(seq)
                if n >= block_words:
                    yield row(block)
                    block, n = [], 0
        if block:
            yield row(block)

    return run


_LOADED: dict[str, SuffixAutomaton] = {}


def _loaded(shared: list[tuple[str, bytes]]) -> list[SuffixAutomaton]:
    """The automata of a pass, made once in each Python worker whatever the number of its tasks."""
    if any(h not in _LOADED for h, _ in shared):
        _LOADED.clear()
        _LOADED.update((h, pickle.loads(data)) for h, data in shared)
    return [_LOADED[h] for h, _ in shared]


def _over_items(docs: DataFrame, items: DataFrame, item: str, text: str, least_run: int, run, schema: str) -> DataFrame:
    """``run`` over the documents with the automata of all items, in one pass for each ``PASS_BYTES`` of automata.

    Automata are built by tasks and measured; the driver hands on only their bytes, and those of one pass at a time.
    """
    spark = docs.sparkSession
    given = items.select(F.col(item).cast("bigint").alias(item), text).filter(F.col(item).isNotNull() & F.col(text).isNotNull())
    total = given.agg(F.sum(F.size(F.split(text, r"\s+")))).first()[0] or 0
    spread = given.coalesce(1) if total <= BLOCK_WORDS else given.repartition(-(-total // BLOCK_WORDS), item)
    built = materialize(spread.mapInArrow(_build(BLOCK_WORDS, least_run), "hash STRING, bytes BIGINT, automaton BINARY"), "automata")
    passes: list[list[str]] = [[]]
    held = 0
    for h, n in built.select("hash", "bytes").orderBy("hash").collect():  # a row for each BLOCK_WORDS words
        if held + n > PASS_BYTES and passes[-1]:
            passes.append([])
            held = 0
        passes[-1].append(h)
        held += n
    out = None
    for names in passes:
        rows = built.filter(F.col("hash").isin(names)).select("hash", "automaton").collect() if names else []  # at most PASS_BYTES
        shared = spark.sparkContext.broadcast([(r["hash"], bytes(r["automaton"])) for r in rows])
        part = docs.mapInArrow(run(shared), schema)
        out = part if out is None else out.union(part)
    return out


def find_leaks(docs: DataFrame, items: DataFrame, least_run: int = LEAST_RUN) -> DataFrame:
    """``doc_id, item_id, covered, item_words, longest_run`` for every document and item with a common run.

    ``docs`` holds ``doc_id, text``, ``items`` holds ``item_id, item_text``. A run is at least ``least_run`` consecutive
    words of the item that stand consecutively in the document; ``covered`` counts the item's words inside runs. Letter
    case, punctuation, line breaks, invisible characters and look-alikes make no difference. The automata of the
    items go to the workers as a broadcast of bounded size; documents are read once for all of them and never shuffled.
    Null and empty texts match nothing.
    """

    def run(shared):
        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automata, memo = _loaded(shared.value), {}
            for b in batches:
                rows = []
                for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    seq = [w for w, _, _ in words(text, memo)] if text else []
                    for automaton in automata if seq else ():
                        for i, (mask, longest, _) in automaton.covered(seq).items():
                            rows.append((doc, i, mask.bit_count(), automaton.size[i], longest))
                cols = list(zip(*rows)) or [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["doc_id", "item_id", "covered", "item_words", "longest_run"])

        return scan

    schema = "doc_id BIGINT, item_id BIGINT, covered BIGINT, item_words BIGINT, longest_run BIGINT"
    return _over_items(docs.select("doc_id", "text"), items, "item_id", "item_text", least_run, run, schema)


def leaked_items(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, item_id`` where at least half of the words of an item of 12 or more stand in the document in runs."""
    hit = (F.col("item_words") >= LEAST_WORDS) & (F.col("covered") >= F.col("item_words") * LEAST_SHARE)
    return find_leaks(docs, items).filter(hit).select("doc_id", "item_id")


def remove_leaks(docs: DataFrame, items: DataFrame, least_run: int = LEAST_RUN, least_share: float = LEAST_SHARE, long_run: int = LONG_RUN) -> DataFrame:
    """``doc_id, n_removed, text`` of documents with leaked spans, these cut out.

    A span goes if its item (of 12 or more words) is covered by ``least_share`` or more, or if it runs over ``long_run``
    words. ``n_removed`` counts removed words. Items that need more than one pass give rows for each pass.
    """

    def run(shared):
        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automata, memo = _loaded(shared.value), {}
            for b in batches:
                rows = []
                for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    if not text:
                        continue
                    seq = words(text, memo)
                    gone = set()
                    plain = [w for w, _, _ in seq]
                    for size, (mask, _, spans) in ((a.size[i], found) for a in automata for i, found in a.covered(plain).items()):
                        whole = size >= LEAST_WORDS and mask.bit_count() >= size * least_share
                        for x, y in spans:
                            if whole or y - x >= long_run:
                                gone.update(range(x, y))
                    if gone:
                        kept, at, k = [], 0, 0
                        order = sorted(gone)
                        while k < len(order):
                            j = k
                            while j + 1 < len(order) and order[j + 1] == order[j] + 1:
                                j += 1
                            kept.append(text[at : seq[order[k]][1]])
                            at, k = seq[order[j]][2], j + 1
                        rows.append((doc, len(gone), "".join(kept) + text[at:]))
                cols = list(zip(*rows)) or [()] * 3
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string())], ["doc_id", "n_removed", "text"])

        return scan

    return _over_items(docs.select("doc_id", "text"), items, "item_id", "item_text", least_run, run, "doc_id BIGINT, n_removed BIGINT, text STRING")

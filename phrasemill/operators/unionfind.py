"""Union-find on arrays: components of the edges that one task holds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd


def spread_bits(x: np.ndarray) -> np.ndarray:
    """A fixed one-to-one shuffle of 64-bit numbers (the finaliser of SplitMix64)."""
    h = x.astype(np.int64).view(np.uint64)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def stars(a: np.ndarray, b: np.ndarray, shuffled: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """``node, root`` for every node of the edges ``a, b`` that is not its component's root.

    The root is the least node, with ``shuffled`` the one that comes first in a fixed random order. Nodes become
    positions 0, 1, ... in that order; each round hooks the roots of an edge's ends to each other, the later to the
    earlier, and halves paths until every node points to its root; edges inside a tree are dropped.
    """
    both = np.concatenate([a, b])
    if shuffled:
        ids, code = np.unique(spread_bits(both), return_inverse=True)
        names = np.empty(len(ids), dtype=np.int64)
        names[code] = both
    else:
        names, code = np.unique(both, return_inverse=True)
    u, v = code[: len(a)], code[len(a) :]
    up = np.arange(len(names))
    while True:
        x, y = up[u], up[v]
        live = x != y
        if not live.any():
            break
        u, v = np.minimum(x, y)[live], np.maximum(x, y)[live]
        np.minimum.at(up, v, u)
        while True:
            nxt = up[up]
            if (nxt == up).all():
                break
            up = nxt
    below = np.flatnonzero(up != np.arange(len(up)))
    return names[below], names[up[below]]


def spanning_stars(limit: int, shuffled: bool = False):
    """For ``mapInPandas``: a partition's edges as the star rows ``node, root`` of their components.

    Rows are held up to ``limit`` and then replaced by their stars, so a partition holds at most about ``limit`` of those and
    one batch more; where the stars alone fill the limit they are given out, and the partition starts anew.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        n = 0

        def fold() -> tuple[np.ndarray, np.ndarray]:
            a, b = (np.concatenate(c) for c in zip(*held)) if held else (np.zeros(0, np.int64),) * 2
            return stars(a, b, shuffled)

        for pdf in batches:
            held.append((pdf.iloc[:, 0].to_numpy(), pdf.iloc[:, 1].to_numpy()))
            n += len(pdf)
            if n >= limit:
                node, root = fold()
                if 2 * len(node) >= limit:
                    yield pd.DataFrame({"node": node, "root": root})
                    held, n = [], 0
                else:
                    held, n = [(node, root)], len(node)
        node, root = fold()
        yield pd.DataFrame({"node": node, "root": root})

    return run

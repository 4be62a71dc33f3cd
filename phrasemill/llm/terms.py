"""Problems 3 and 4: how distinctive a term is for a record, and how often every term occurs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.balanced import spread_join
from ..operators.ranking import unique_candidates
from ..plans.storage import materialize

#: A fit has converged when a further step moves no parameter by more than this share of itself.
TOLERANCE = 1e-8
#: Steps after which a term that has not converged is reported as such (``converged`` is false).
MOST_STEPS = 5_000
#: Starts of the high component's mean, as multiples of the mean count in records that hold the term.
STARTS = (1.0, 1.5, 3.0)


def term_ids(listed: DataFrame) -> DataFrame:
    """``candidate_id, candidate, term``: usable candidates, ``term`` being the least id of the same string."""
    ids = unique_candidates(listed).select("candidate_id", "candidate")
    return ids.join(ids.groupBy("candidate").agg(F.min("candidate_id").alias("term")), "candidate").select("candidate_id", "candidate", "term")


class _Cells:
    """Histogram cells of some terms (``k`` occurrences in ``n`` records), with the records without the term."""

    def __init__(self, term_of: np.ndarray, k: np.ndarray, n: np.ndarray, zero: np.ndarray):
        terms = len(zero)
        self.of = np.concatenate([term_of, np.arange(terms)])
        order = np.argsort(self.of, kind="stable")
        self.of = self.of[order]
        self.k, self.n = np.concatenate([k, np.zeros(terms)])[order], np.concatenate([n, zero])[order]
        self.starts = np.searchsorted(self.of, np.arange(terms))
        self.total = self.sum(self.n)

    def sum(self, x: np.ndarray) -> np.ndarray:
        return np.add.reduceat(x, self.starts)

    def only(self, keep: np.ndarray) -> "_Cells":
        """The cells of the terms in the mask ``keep``."""
        out, inside = object.__new__(_Cells), keep[self.of]
        out.of = (np.cumsum(keep) - 1)[self.of[inside]]
        out.k, out.n = self.k[inside], self.n[inside]
        out.starts, out.total = np.searchsorted(out.of, np.arange(keep.sum())), self.total[keep]
        return out

    def expect(self, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Posterior of the high component per cell and log-likelihood per term (up to a constant of the data).

        ``p`` holds the logit of the share, and the logarithms of the high and the low mean.
        """
        logit, high, low = p[0][self.of], p[1][self.of], p[2][self.of]
        a = -np.logaddexp(0, -logit) + self.k * high - np.exp(high)
        b = -np.logaddexp(0, logit) + self.k * low - np.exp(low)
        both = np.logaddexp(a, b)
        return np.exp(a - both), self.sum(self.n * both)

    def em(self, r: np.ndarray) -> np.ndarray:
        """Parameters that maximise the expected likelihood under posterior ``r``."""
        w = self.n * r
        elite, occ = self.sum(w), self.sum(w * self.k)
        rest, rest_occ = self.sum(self.n - w), self.sum((self.n - w) * self.k)
        tiny = 1e-12
        return np.stack([np.log(np.maximum(elite, tiny)) - np.log(np.maximum(rest, tiny)), np.log(np.maximum(occ, tiny) / np.maximum(elite, tiny)), np.log(np.maximum(rest_occ, tiny) / np.maximum(rest, tiny))])

    def newton(self, p: np.ndarray, r: np.ndarray) -> np.ndarray:
        """A Newton step on the likelihood, uphill along every direction of its curvature and of bounded length."""
        high, low = np.exp(p[1])[self.of], np.exp(p[2])[self.of]
        share = 1 / (1 + np.exp(-p[0]))
        x, y, q = self.k - high, self.k - low, self.n * r * (1 - r)
        gradient = np.stack([self.sum(self.n * (r - share[self.of])), self.sum(self.n * r * x), self.sum(self.n * (1 - r) * y)], axis=1)
        cells = {(0, 0): q - self.n * (share * (1 - share))[self.of], (0, 1): q * x, (0, 2): -q * y, (1, 1): q * x * x - self.n * r * high, (1, 2): -q * x * y, (2, 2): q * y * y - self.n * (1 - r) * low}
        bend = np.empty((len(share), 3, 3))
        for (i, j), c in cells.items():
            bend[:, i, j] = bend[:, j, i] = -self.sum(c)
        values, axes = np.linalg.eigh(bend)
        size = np.maximum(np.abs(values), 1e-14 * np.abs(values).max(1, keepdims=True) + 1e-300)
        step = np.einsum("tij,tj->ti", axes, np.einsum("tji,tj->ti", axes, gradient) / size)
        return (step / np.maximum(np.abs(step).max(1, keepdims=True), 1)).T


def _climb(cells: _Cells, p: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Parameters, log-likelihood and convergence of every term from start ``p``.

    Each step is one of EM; where a Newton step from there is more likely still, it is taken instead, so the slow end
    of EM is passed over. A term leaves as soon as it has converged.
    """
    out, level, done = p.copy(), np.full(p.shape[1], -np.inf), np.zeros(p.shape[1], dtype=bool)
    active, part = np.arange(p.shape[1]), cells
    r, best = part.expect(p)
    for _ in range(steps):
        nxt = part.em(r)
        r, now = part.expect(nxt)
        step = part.newton(nxt, r)
        for scale in (1.0, 0.2, 0.03):
            r2, then = part.expect(nxt + scale * step)
            ok = then > now
            nxt, now, r, step = np.where(ok, nxt + scale * step, nxt), np.where(ok, then, now), np.where(ok[part.of], r2, r), np.where(ok, 0, step)
            if ok.all():
                break
        # A mean or share that runs to 0 has converged when what depends on it no longer moves.
        moved = np.abs(nxt - p)
        moved[2] = np.where(nxt[2] < -20, 0, moved[2])
        still = moved.max(0) > TOLERANCE
        out[:, active], level[active], done[active] = nxt, now, ~still
        if not still.any():
            break
        if not still.all():
            active, part, r, nxt = active[still], part.only(still), r[still[part.of]], nxt[:, still]
        p = nxt
    return out, level, done


def fit_two_poisson(term_of: np.ndarray, k: np.ndarray, n: np.ndarray, total: int, steps: int = MOST_STEPS):
    """``share, high, low, converged`` per term of the mixture of an elite and a common Poisson law over all records.

    Cells (``k`` occurrences in ``n`` records) are grouped by term; the other of ``total`` records hold it 0 times.
    Expectation-maximisation runs for all terms at once from several starts, and the likeliest end counts. Where
    counts vary no more than one Poisson law has them vary, there are no two laws to tell apart: then ``low`` is 0,
    and the elite are the records that hold the term.
    """
    terms = int(term_of[-1]) + 1 if len(term_of) else 0
    k, n, term_of = k.astype(float), n.astype(float), term_of.astype(np.int64)
    add = lambda x: np.bincount(term_of, weights=x, minlength=terms)
    df, occ = add(n), add(n * k)
    total = np.maximum(float(total), df)
    mean, spread = occ / total, add(n * k * k) / total - (occ / total) ** 2
    two = spread > mean * (1 + 1e-9)
    share, high, low = df / total, occ / df, np.zeros(terms)
    converged = np.ones(terms, dtype=bool)
    if two.any():
        cells = _Cells(term_of, k, n, total - df).only(two)
        ends = []
        for m in STARTS:
            h = np.maximum(occ / df * m, mean * 1.1)[two]
            s = np.clip(0.5 * df / total / m, 1e-9, 0.5)[two]
            ends.append(_climb(cells, np.stack([np.log(s) - np.log1p(-s), np.log(h), np.log(0.3 * mean[two])]), steps))
        pick = np.argmax([np.round(e[1], 9) for e in ends], axis=0)
        at = np.arange(two.sum())
        p, converged[two] = np.stack([e[0] for e in ends])[pick, :, at].T, np.stack([e[2] for e in ends])[pick, at]
        swap = p[1] < p[2]
        p = np.where(swap, np.stack([-p[0], p[2], p[1]]), p)
        same = p[1] - p[2] < 1e-6
        share[two] = np.where(same, share[two], 1 / (1 + np.exp(-p[0])))
        high[two], low[two] = np.where(same, high[two], np.exp(p[1])), np.where(same, 0, np.exp(p[2]))
    return share, high, np.where(low < 1e-9, 0, low), converged


def elite_posterior(k: np.ndarray, share: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Probability that ``k`` occurrences come from the elite component; with ``low`` 0, 1 for any occurrence."""
    with np.errstate(divide="ignore", invalid="ignore"):
        odds = np.log(share) - np.log1p(-share) + k * (np.log(high) - np.log(low)) - (high - low)
    return np.where(low <= 0, np.where(k > 0, 1.0, 0.0), 1 / (1 + np.exp(-np.clip(odds, -700, 700))))


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if not b.num_rows:
            continue
        cells = b.column("h")
        lens = pc.list_value_length(cells).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = cells.flatten()
        k, n = (flat.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        total, term_of = int(b.column("n_docs")[0].as_py()), np.repeat(np.arange(len(lens)), lens)
        model = fit_two_poisson(term_of, k, n, total)
        df = np.bincount(term_of, weights=n).astype(np.int64)
        yield pa.RecordBatch.from_arrays([b.column("term"), b.column("n_docs"), *map(pa.array, (df, *model))], ["term", "n_docs", "df", "share", "high", "low", "converged"])


def score_terms(mapping: DataFrame, listed: DataFrame) -> DataFrame:
    """``row_id, candidate_id, tf, df, n_docs, idf, tfidf, elite_prob, distinctiveness, converged`` of every pair of ``mapping``.

    Counted are rows with a ``row_id`` whose candidate is listed and not blank. A string's frequency histogram (records
    by occurrences) over all its ids gives ``df`` and the two-Poisson mixture. ``elite_prob`` is the posterior
    probability that the record's occurrences of the string come from the elite component; it is 1 for a string whose
    counts show no two components. ``idf`` is ``ln((N+1)/(df+1)) + 1``, ``tfidf`` is ``tf * idf``, and ``distinctiveness`` is
    ``elite_prob * idf``: the posterior says whether the record is about the term, the rarity of the term how much that
    tells. ``converged`` is false where the fit used up its steps. Occurrences fold map-side to pairs first; a histogram
    has at most about sqrt(2 * occurrences) cells, so collecting one per term is bounded. Empty tables give no rows.
    """
    ids = term_ids(listed).select("candidate_id", "term")
    named = mapping.filter("row_id is not null and candidate_id is not null").select("candidate_id", "row_id")
    pairs = named.groupBy("candidate_id", "row_id").agg(F.count(F.lit(1)).alias("tf"))
    known = materialize(spread_join(pairs, ids, "candidate_id", "row_id", named), "pairs")
    per_string = known.groupBy("term", "row_id").agg(F.sum("tf").alias("k"))
    cells = per_string.groupBy("term", "k").agg(F.count(F.lit(1)).alias("n"))
    total = known.select("row_id").distinct().agg(F.count(F.lit(1)).alias("n_docs"))
    hist = cells.groupBy("term").agg(F.collect_list(F.struct("k", "n")).alias("h")).select("term", "h", total.scalar().alias("n_docs"))
    model = hist.mapInArrow(_fit, "term BIGINT, n_docs BIGINT, df BIGINT, share DOUBLE, high DOUBLE, low DOUBLE, converged BOOLEAN")
    out = spread_join(known, model, "term", "row_id")
    idf = F.log((F.col("n_docs") + 1) / (F.col("df") + 1)) + 1
    log_odds = F.log(F.col("share")) - F.log1p(-F.col("share")) + F.col("tf") * (F.log("high") - F.log("low")) - (F.col("high") - F.col("low"))
    prob = F.when(F.col("low") <= 0, F.lit(1.0)).otherwise(1 / (1 + F.exp(-log_odds)))
    scored = out.withColumn("idf", idf).withColumn("elite_prob", prob)
    return scored.select("row_id", "candidate_id", "tf", "df", "n_docs", "idf", (F.col("tf") * F.col("idf")).alias("tfidf"), "elite_prob", (F.col("elite_prob") * F.col("idf")).alias("distinctiveness"), "converged")


def wrong_scores(ranked: DataFrame, mapping: DataFrame, listed: DataFrame, tolerance: float = 0.001) -> DataFrame:
    """``row_id, candidate_id`` of stated scores that are null, NaN or off by more than ``tolerance``.

    The stated score is a TF-IDF, so it is held against the ``tfidf`` of :func:`score_terms`, whose ``df`` and N come from
    the histograms that the mixture is fitted on; the posterior has no stated counterpart and decides no row here. A pair
    that the scored terms lack has no occurrences, so its score should be 0. Repeated rows count once.
    """
    scored = score_terms(mapping, listed).select("row_id", "candidate_id", "tfidf")
    rows = ranked.select("row_id", "candidate_id", F.col("tfidf_score").cast("double").alias("_s")).join(scored, ["row_id", "candidate_id"], "left")
    bad = F.col("_s").isNull() | F.isnan("_s") | (F.abs(F.col("_s") - F.coalesce("tfidf", F.lit(0.0))) > tolerance)
    return rows.filter(bad).select("row_id", "candidate_id").distinct()


def _runs(term: str, record: str):
    """Run-length scan of rows sorted by (term, record): per term its rows and its distinct records.

    A run that reaches the end of a batch is carried over, so what is held is one batch.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # (term, tf, df, last record)

        def out(terms, tf, df):
            return pa.RecordBatch.from_arrays([terms, pa.array(tf, pa.int64()), pa.array(df, pa.int64())], ["term", "tf", "df"])

        def changes(a: pa.Array) -> np.ndarray:
            x, y = a.slice(1), a.slice(0, len(a) - 1)
            differ = pc.fill_null(pc.not_equal(x, y), False).to_numpy(zero_copy_only=False)
            return differ | (x.is_null().to_numpy(zero_copy_only=False) != y.is_null().to_numpy(zero_copy_only=False))

        kind = None
        for b in batches:
            if not b.num_rows:
                continue
            t, r = b.column(term), b.column(record)
            kind = t.type
            new_t = np.concatenate([[True], changes(t)])
            new_r = np.concatenate([[True], changes(r)]) | new_t
            counted = new_r & ~r.is_null().to_numpy(zero_copy_only=False)
            at = np.flatnonzero(new_t)
            tf = np.diff(np.append(at, len(new_t)))
            df = np.add.reduceat(counted.astype(np.int64), at)
            first = t[0].as_py()
            if held is not None:
                if held[0] == first:
                    same = held[3] == r[0].as_py()
                    tf[0] += held[1]
                    df[0] += held[2] - (1 if same and counted[0] else 0)
                else:
                    yield out(pa.array([held[0]], kind), [held[1]], [held[2]])
            held = (t[len(t) - 1].as_py(), int(tf[-1]), int(df[-1]), r[len(r) - 1].as_py())
            if len(at) > 1:
                yield out(t.take(pa.array(at[:-1])), tf[:-1], df[:-1])
        if held is not None:
            yield out(pa.array([held[0]], kind), [held[1]], [held[2]])

    return scan


def term_frequencies(df: DataFrame, term: str, record: str) -> DataFrame:
    """``term, tf, df``: rows and distinct non-null records of every distinct value; null is a value of its own.

    Pairs are range partitioned by (term, record) and sorted externally within partitions, then scanned in runs. A
    frequent term spreads over partitions, equal pairs never do, so partial counts of a term just add up.
    """
    kind = df.schema[term].dataType.simpleString()
    ranged = df.select(term, record).repartitionByRange(F.col(term), F.col(record)).sortWithinPartitions(term, record)
    partial = ranged.mapInArrow(_runs(term, record), f"term {kind}, tf BIGINT, df BIGINT")
    return partial.groupBy("term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))


def candidate_frequencies(mapping: DataFrame, listed: DataFrame, rare_below: int = 3, common_percent: int = 5) -> DataFrame:
    """``candidate, tf, df, n_docs, mark`` of every distinct string of ``listed`` that is not null or blank.

    ``mark`` is ``rare`` if fewer than ``rare_below`` documents hold the string, ``common`` if more than
    ``common_percent`` of the N documents do, else null. Strings without occurrences have zeros and are rare.
    """
    ids = term_ids(listed)
    named = mapping.filter("row_id is not null and candidate_id is not null").select("candidate_id", "row_id")
    # Read to sample the ranges, to scan them, and for N: written once.
    rows = materialize(spread_join(named, ids.select("candidate_id", "term"), "candidate_id", "row_id").select("term", "row_id"), "rows")
    counts = term_frequencies(rows, "term", "row_id")
    total = rows.select("row_id").distinct().agg(F.count(F.lit(1)).alias("n_docs"))
    strings = ids.select("term", "candidate").distinct()
    out = strings.join(counts, "term", "left").withColumn("n_docs", total.scalar())
    df = F.coalesce("df", F.lit(0))
    mark = F.when(df < rare_below, "rare").when(df * 100 > F.col("n_docs") * common_percent, "common")
    return out.select("candidate", F.coalesce("tf", F.lit(0)).alias("tf"), df.alias("df"), "n_docs", mark.alias("mark"))

"""Problem 7: the N best items of every group, from a clustered copy whose row groups are skipped by their statistics.

The copy holds sections: some thousand rows of whole groups that need about the same score to be among a group's N best, as a
quantile sketch of each group tells. In a section rows run by descending score over all its groups, cut in row groups, so
what is read first is what every group needs, and the rest is left unread once every group has its N.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.storage import materialize, new_path, qualified

SECTION_ROWS, ROW_GROUP_ROWS = 4_000, 500
COLUMNS = ("g", "s", "t", "i")
#: Quantiles kept of each group's scores; they place a group, and split one that is larger than a section.
QUANTILES = [x / 50 for x in range(50)] + [0.99, 0.995, 0.999]


def _sections(rows_of_section: int):
    """Groups in the order of their level, cut in sections: ``g, z, k, n, cuts``. Larger groups are sections of their own."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        z, held = TaskContext.get().partitionId() << 32, ()
        for pdf in batches:
            large = pdf["n"] > rows_of_section
            alone = pdf[large].assign(z=range(z, z + large.sum()), k=1)
            z += int(large.sum())
            yield alone[["g", "z", "k", "n", "cuts"]]
            held = pd.concat([*held, pdf[~large].assign(cuts=None)]),
            part = (held[0]["n"].cumsum() - held[0]["n"]) // rows_of_section
            if len(part):
                full = part < part.max()
                out = held[0][full].assign(z=z + part[full])
                yield out.assign(k=out.groupby("z")["g"].transform("size"))[["g", "z", "k", "n", "cuts"]]
                z, held = z + int(part.max()), (held[0][~full],)
        if held and len(held[0]):
            yield held[0].assign(z=z, k=len(held[0]))[["g", "z", "k", "n", "cuts"]]

    return run


def _writer(folder: str, row_group_rows: int):
    """One file for each task, with row groups that never hold rows of two sections; gives the file's path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(folder)
        path = f"{base}/{uuid.uuid4().hex}.parquet"  # a repeated task leaves a file that nothing refers to
        sink, held = None, None

        def flush(table: pa.Table, whole: bool) -> pa.Table:
            """Write full row groups of a table that is all of one section so far, and with ``whole`` the rest."""
            at = 0
            while len(table) - at >= row_group_rows or (whole and at < len(table)):
                sink.write_table(table.slice(at, row_group_rows).combine_chunks(), row_group_size=row_group_rows)
                at += row_group_rows
            return table.slice(min(at, len(table)))

        for b in batches:
            if not b.num_rows:
                continue
            if sink is None:
                system.create_dir(base, recursive=True)
                sink = pq.ParquetWriter(path, b.schema, filesystem=system, compression="zstd", use_dictionary=["z", "k", "n", "g"])
            t = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
            z, c = t.column("z").to_numpy(), t.column("b").to_numpy()
            ends = np.append(np.flatnonzero((z[1:] != z[:-1]) | (c[1:] != c[:-1])) + 1, len(z))
            at = 0
            for end in ends[:-1]:
                flush(t.slice(at, end - at), True)
                at = end
            held = flush(t.slice(at), False)
        if sink is not None:
            flush(held, True)
            sink.close()
            yield pa.RecordBatch.from_arrays([pa.array([folder.rstrip("/") + "/" + path.rsplit("/", 1)[1]])], ["file"])

    return run


def write_clustered(df: DataFrame, group: str, score: str, second: str, item: str, n: int = 3, section_rows: int = SECTION_ROWS, row_group_rows: int = ROW_GROUP_ROWS) -> DataFrame:
    """Write the clustered copy to the shared folder; returns its files. Laid out for about ``n``, right for any number.

    Its columns are ``g, s, t, i`` (group, score, second score, item) with ``z, k, n``: the section, its groups, the
    group's rows. Rows without group or item and rows whose score is null or NaN are left out; a null or NaN second
    score is lowest; repeated rows fold map-side and then by all their columns. A group's size and quantile sketch come from one aggregate that combines map-side. A group larger
    than a section is cut at its quantiles into parts, so no task holds all of it.
    """
    number = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
    rows = df.select(F.col(group).cast("bigint").alias("g"), number(score).alias("s"), number(second).alias("t"), F.col(item).cast("bigint").alias("i")).filter("g is not null and s is not null and i is not null").distinct()
    sketch = rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("s", QUANTILES, 200).alias("cuts"))
    place = F.lit(len(QUANTILES)) - F.size(F.filter(F.array(*map(F.lit, QUANTILES)), lambda q: q > F.greatest(F.col("n") - n + 1, F.lit(0)) / F.col("n")))
    level = sketch.withColumn("level", F.element_at("cuts", F.greatest(place, F.lit(1)).cast("int")))
    groups = materialize(level.repartitionByRange("level").sortWithinPartitions("level").select("g", "n", "cuts").mapInPandas(_sections(section_rows), "g BIGINT, z BIGINT, k BIGINT, n BIGINT, cuts ARRAY<DOUBLE>"), "sections")
    # The merge hint keeps Spark from broadcasting the groups, whose number grows with the data.
    placed = rows.join(groups.hint("merge"), "g")
    part = F.coalesce(F.size(F.filter("cuts", lambda q: q <= F.col("s"))), F.lit(0))
    laid = placed.select("z", F.when(F.col("cuts").isNull(), 0).otherwise(part).cast("int").alias("b"), "k", "n", *COLUMNS)
    order = [F.col("z"), F.desc("b"), F.desc("s"), F.col("t").desc_nulls_last(), F.col("i"), F.col("g")]
    return materialize(laid.repartition("z", "b").sortWithinPartitions(*order).mapInArrow(_writer(qualified(df.sparkSession, new_path(df.sparkSession, "clustered")), row_group_rows), "file STRING"), "files")


def _open(file: str) -> pq.ParquetFile:
    system, path = fs.FileSystem.from_uri(file)
    return pq.ParquetFile(system.open_input_file(path))


def _footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for file in pdf["file"]:
            meta = _open(file).metadata
            at = {meta.schema.column(i).name: i for i in range(meta.num_columns)}
            for r in range(meta.num_row_groups):
                z, k, s = (meta.row_group(r).column(at[c]).statistics for c in ("z", "k", "s"))
                rows.append((file, r, meta.row_group(r).num_rows, z.min, k.min, s.min, s.max))
        yield pd.DataFrame(rows, columns=["file", "rg", "n", "z", "k", "s_min", "s_max"])


def plan_row_groups(files: DataFrame, n: int) -> DataFrame:
    """``file, rg, z, k, s_max`` of the row groups that footers alone don't rule out. Rows of the copy are distinct.

    A group that is a section by itself may lie in several files. Of its row groups in descending greatest score, the
    group's current N-th score is at least the least score of those before once they hold N rows; row groups whose
    greatest score is strictly below are left out. Of sections of several groups all are kept: reading decides.
    """
    stats = files.repartition(max(1, files.count()), "file").mapInPandas(_footers, "file STRING, rg INT, n BIGINT, z BIGINT, k BIGINT, s_min DOUBLE, s_max DOUBLE")
    alone = stats.filter("k = 1")
    by = Window.partitionBy("z").orderBy(F.desc("s_max"), F.desc("s_min"), "file", "rg").rowsBetween(Window.unboundedPreceding, -1)
    seen = alone.withColumn("_rows", F.coalesce(F.sum("n").over(by), F.lit(0))).withColumn("_low", F.min("s_min").over(by))
    needed = seen.filter((F.col("_rows") < n) | (F.col("s_max") >= F.col("_low")))
    return stats.filter("k > 1").union(needed.select(*stats.columns)).select("file", "rg", "z", "k", "s_max")


class _Best:
    """The best of a section's groups among the rows read so far."""

    def __init__(self, n: int, groups: int):
        self.n, self.groups = n, groups
        self.rows: dict[str, np.ndarray] = {}

    def add(self, t: pa.Table) -> None:
        new = {c: t.column(c).to_numpy() for c in ("n", *COLUMNS)}
        both = {c: np.concatenate([self.rows[c], x]) if self.rows else x for c, x in new.items()}
        order = np.lexsort((both["i"], np.where(np.isnan(both["t"]), np.inf, -both["t"]), -both["s"], both["g"]))
        self.rows = {c: x[order] for c, x in both.items()}
        g = self.rows["g"]
        self.start = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
        self.width = np.diff(np.append(self.start, len(g)))
        self.position = np.arange(len(g)) - np.repeat(self.start, self.width) + 1
        if self.groups == 1:  # a part of a large group: the rest of it can't come back
            self.rows = {c: x[: self.n] for c, x in self.rows.items()}
            self.position, self.width = self.position[: self.n], np.minimum(self.width, self.n)

    def needs(self, greatest: float) -> bool:
        """Whether rows of a score up to ``greatest`` could still be among the best of any group of the section."""
        if not self.rows or len(self.start) < self.groups:
            return True
        full = self.width >= self.n
        short = self.width[~full] < self.rows["n"][self.start[~full]]
        return bool(short.any() or (self.rows["s"][self.start[full] + self.n - 1] <= greatest).any())

    def best(self) -> pd.DataFrame:
        keep = self.position <= self.n
        return pd.DataFrame({c: self.rows[c][keep] for c in COLUMNS}).assign(position=self.position[keep], alone=self.groups == 1)


FOUND = "g BIGINT, s DOUBLE, t DOUBLE, i BIGINT, position BIGINT, alone BOOLEAN"


def _reader(n: int):
    """The best rows of each section of a file; a row without ``g`` tells how many row groups were read, of how many."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for file, plan in zip(pdf["file"], pdf["plan"]):
                source, read = _open(file), 0
                todo = pd.DataFrame([(r["z"], r["k"], r["s_max"], r["rg"]) for r in plan], columns=["z", "k", "s_max", "rg"])
                for (_, k), section in todo.sort_values(["s_max", "rg"], ascending=[False, True]).groupby(["z", "k"]):
                    best = _Best(n, k)
                    for greatest, rg in section[["s_max", "rg"]].itertuples(index=False):
                        if not best.needs(greatest):
                            break  # the ones that follow have no greater score
                        best.add(source.read_row_group(rg, columns=["n", *COLUMNS], use_threads=False))
                        read += 1
                    yield best.best()
                yield pd.DataFrame({"g": [None], "s": [None], "t": [None], "i": [source.metadata.num_row_groups], "position": [read], "alone": [False]}).astype({"g": "Int64", "s": float, "t": float})

    return run


def read_best(files: DataFrame, n: int) -> DataFrame:
    """What :func:`_reader` finds, written to the shared folder. A file's row groups are read by one task, in order."""
    parts = max(1, files.count())
    plan = plan_row_groups(files, n).groupBy("file").agg(F.collect_list(F.struct("z", "k", "s_max", "rg")).alias("plan"))  # one row for each row group of a file
    return materialize(plan.repartition(parts, "file").mapInPandas(_reader(n), FOUND), "topn")


def row_groups_read(found: DataFrame) -> DataFrame:
    """``n_read, n_row_groups``: how much of the copy was read for ``found``."""
    return found.filter("g is null").agg(F.sum("position").alias("n_read"), F.sum("i").alias("n_row_groups"))


def top_n(found: DataFrame, n: int) -> DataFrame:
    """``g, i, s, t, position`` from :func:`read_best`: parts of groups that were cut are merged by a window over ``n`` rows each."""
    order = Window.partitionBy("g").orderBy(F.desc("s"), F.col("t").desc_nulls_last(), "i")
    rows = found.filter("g is not null")
    cut = rows.filter("alone").select("g", "i", "s", "t").distinct().withColumn("position", F.row_number().over(order).cast("bigint")).filter(F.col("position") <= n)
    return rows.filter("not alone").select("g", "i", "s", "t", "position").union(cut)


def best_candidates(ranked: DataFrame, n: int = 3, section_rows: int = SECTION_ROWS, row_group_rows: int = ROW_GROUP_ROWS) -> DataFrame:
    """``row_id, candidate_id, tfidf_score, semantic_score, position`` of the ``n`` best candidates of each document.

    Order: higher TF-IDF, higher semantic score (null and NaN lowest), smaller candidate; repeated rows count once.
    Rows without document, candidate or TF-IDF (null or NaN) are left out. An empty table gives no rows.
    """
    files = write_clustered(ranked, "row_id", "tfidf_score", "semantic_score", "candidate_id", n, section_rows, row_group_rows)
    best = top_n(read_best(files, n), n)
    return best.select(F.col("g").alias("row_id"), F.col("i").alias("candidate_id"), F.col("s").alias("tfidf_score"), F.col("t").alias("semantic_score"), "position")

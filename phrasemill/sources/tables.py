"""Scans and sinks: source documents, candidate tables, blacklist, in-memory frames, CSV and parquet writers."""

from __future__ import annotations

from collections.abc import Iterable
from pathlib import PurePath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip

LIST_SCHEMA = "candidate_id BIGINT, candidate STRING, surface_form STRING, extraction_source STRING"
MAPPING_SCHEMA = "candidate_id BIGINT, row_id BIGINT"
CLUSTER_SCHEMA = "candidate_id BIGINT, candidate STRING, cluster_id BIGINT, cluster_label STRING, cluster_size BIGINT"
CLUSTER_COLUMNS = ("candidate_id", "candidate", "cluster_id", "cluster_label", "cluster_size")


def require_columns(df: DataFrame, needed: Iterable[str], what: str) -> None:
    """``ValueError`` naming missing and present columns, unless all are there."""
    missing = [c for c in needed if c not in df.columns]
    if missing:
        raise ValueError(f"{what}: missing columns {missing}; found {df.columns}")


def read_any(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Parquet or CSV by suffix (case-sensitive); a path without a suffix is a parquet folder.

    A CSV doesn't tell an empty string from none: both come as null.
    """
    suffix = PurePath(path).suffix
    if suffix in (".parquet", ""):
        return spark.read.parquet(path)
    if suffix != ".csv":
        raise ValueError(f"unsupported file type {suffix!r} of {path}; use .parquet or .csv")
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", True)
    return (reader.schema(schema) if schema else reader.option("inferSchema", False)).csv(path)


def load_source_documents(spark: SparkSession, path: str, id_column: str, title_column: str, abstract_column: str) -> DataFrame:
    """Documents as ``row_id, title, abstract`` and all other columns; ids keep the type of the source."""
    df = read_any(spark, path)
    require_columns(df, (id_column, title_column, abstract_column), path)
    names = {id_column: "row_id", title_column: "title", abstract_column: "abstract"}
    clash = [c for c in names.values() if c in df.columns and c not in names]
    return df.drop(*clash).withColumnsRenamed(names)


def latest_revision(df: DataFrame, key: str = "row_id", order: str | None = "loaded_at") -> DataFrame:
    """One ``row_id, title, abstract`` per id: the last loaded revision; ties go to the greater texts.

    Rows without an id are left out. The aggregate combines map-side, so a repeated id costs nothing extra, and its
    hash partitioning by ``key`` is what extraction and term counts group by afterwards.
    """
    texts = [F.coalesce(F.col(c), F.lit("")) for c in ("abstract", "title")]
    by = ([F.col(order)] if order and order in df.columns else []) + texts
    best = F.max_by(F.struct("title", "abstract"), F.struct(*by)).alias("_d")
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(best).select(F.col(key).alias("row_id"), "_d.title", "_d.abstract")


def _candidates(spark: SparkSession, path: str, columns: dict[str, str], schema: str, needed: tuple[str, ...]) -> DataFrame:
    renamed = {columns.get(c, c): c for c in (x.split()[0] for x in schema.split(", "))}
    df = read_any(spark, path).withColumnsRenamed({k: v for k, v in renamed.items() if k != v})
    require_columns(df, needed, path)
    types = dict(x.split() for x in schema.split(", "))
    return df.withColumns({c: F.col(c).cast(types[c]) for c in df.columns if c in types and c != "row_id"})


def load_candidates_list(spark: SparkSession, path: str, columns: dict[str, str] | None = None) -> DataFrame:
    """Candidate dictionary; only the id and the phrase are required. Literal words such as ``null`` stay as they are."""
    return _candidates(spark, path, columns or {}, LIST_SCHEMA, ("candidate_id", "candidate"))


def load_candidates_mapping(spark: SparkSession, path: str, columns: dict[str, str] | None = None) -> DataFrame:
    """Occurrences, repeated pairs kept; ``row_id`` keeps its type (a CSV gives strings, so ``0012`` survives)."""
    return _candidates(spark, path, columns or {}, MAPPING_SCHEMA, ("candidate_id", "row_id"))


def load_clusters(spark: SparkSession, path: str) -> DataFrame:
    """A clustering as :func:`write_clusters` leaves it."""
    return _candidates(spark, path, {}, CLUSTER_SCHEMA, ("candidate_id", "cluster_id"))


def load_blacklist(spark: SparkSession, path: str | None) -> DataFrame:
    """Phrases ``candidate``: stripped, lower-cased, distinct; blank lines and lines starting with ``#`` skipped.

    A comment after a phrase is part of the phrase. A missing file gives an empty table and a warning.
    """
    if path:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        if p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
            line = F.lower(strip(F.col("value"))).alias("candidate")
            return spark.read.text(path).filter(~F.col("value").startswith("#")).select(line).filter("candidate <> ''").distinct()
        import warnings

        warnings.warn(f"blacklist {path} not found; nothing is blocked", stacklevel=2)
    return spark.createDataFrame([], "candidate STRING")


def frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """In-memory source."""
    return spark.createDataFrame(rows, schema)


def write_table(df: DataFrame, path: str, fmt: str | None = None) -> str:
    """Write by suffix or ``fmt`` (``parquet``, ``csv``), replacing what is there; returns the path.

    CSV goes out as one folder of part files, quotes doubled, with a header.
    """
    fmt = fmt or ("csv" if path.endswith(".csv") else "parquet")
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).option("escape", '"').csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unsupported format {fmt!r}; use 'parquet' or 'csv'")
    return path


def write_clusters(df: DataFrame, path: str) -> str:
    """The five cluster columns only."""
    return write_table(df.select(*CLUSTER_COLUMNS), path)

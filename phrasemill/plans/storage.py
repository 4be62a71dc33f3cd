"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where the setting is absent, a plain local session (as in tests) gets a temporary folder of its own; a session
    with executors elsewhere is refused, because a machine-local folder would be lost with its machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="phrasemill-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/phrasemill/{label}-{uuid.uuid4().hex}"


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` as a URI with the scheme of its file system, for readers and writers outside Spark."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()
    return uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` below the shared folder and read it back: lineage is cut, and losing an executor loses nothing."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.phrasemill_path = path  # type: ignore[attr-defined]
    return out


def discard(df: DataFrame | None) -> None:
    """Delete the files of a table made by :func:`materialize`; anything else is left alone."""
    path = getattr(df, "phrasemill_path", None)
    if path:
        jvm = df.sparkSession._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


def clear(spark: SparkSession) -> None:
    """Delete everything the engine wrote below the shared folder; results that still read from there become unreadable."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/phrasemill")
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)

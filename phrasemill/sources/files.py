"""Small files and folders on whatever file system a path names, through Spark's own file-system layer."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(str(path))
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or a folder with all it holds; nothing happens if there is none."""
    fs, p = _at(spark, path)
    fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _at(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write the whole text beside ``path`` first and rename it, so that a reader finds the old text or the new one."""
    fs, p = _at(spark, path)
    _, beside = _at(spark, f"{path}.new")
    stream = fs.create(beside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not fs.rename(beside, p):  # some file systems don't rename onto a file
        fs.delete(p, False)
        fs.rename(beside, p)


def folders(spark: SparkSession, path: str) -> set[str]:
    """Names of the folders directly below ``path``; none if it does not exist."""
    fs, p = _at(spark, path)
    return {s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()} if fs.exists(p) else set()

"""Folders and files of a layer, through the file system that Spark itself
uses for the path (shared folders, object stores): listings, existence,
removal, publication by rename."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder or file is there: one look-up, no listing."""
    fs, p = _at(spark, path)
    return bool(fs.exists(p))


def remove(spark: SparkSession, path: str) -> bool:
    """Remove a folder or file; false if it wasn't there."""
    fs, p = _at(spark, path)
    return bool(fs.delete(p, True))


def publish(spark: SparkSession, written: str, path: str) -> None:
    """Give a folder that is completely written its final name."""
    fs, src = _at(spark, written)
    if not fs.rename(src, spark._jvm.org.apache.hadoop.fs.Path(path)):
        raise OSError(f"{written} could not be renamed to {path}")


def children(spark: SparkSession, path: str) -> list[str]:
    """The names right under a folder."""
    fs, p = _at(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def folders(spark: SparkSession, path: str, key: str) -> list[str]:
    """The names ``<key>=…`` right under ``path``, in order of the number they go on with."""
    return sorted((n for n in children(spark, path) if n.startswith(f"{key}=")), key=number)


def number(folder: str) -> int:
    """The number in a folder's name: 12 of ``n=12`` and of ``n=12_more``."""
    return int(folder.split("=", 1)[1].split("_", 1)[0])


def bytes_under(spark: SparkSession, path: str) -> int:
    fs, p = _at(spark, path)
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


def list_files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """One row per file under ``path``, subfolders included: file (the path
    relative to ``path``), path, length, modified. A frame: Spark lists large
    trees in parallel, and no content is read."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        r = r.option("pathGlobFilter", pattern)
    fs, p = _at(spark, path)
    root = fs.makeQualified(p).toUri().getPath().rstrip("/") + "/"
    found = r.load(path).select("path", "length", F.col("modificationTime").alias("modified"))
    # the part after the root, whatever scheme and authority come before it
    return found.select(F.expr("substring(path, instr(path, '{0}') + {1})".format(root.replace("'", "\\'"), len(root))).alias("file"), "path", "length", "modified")

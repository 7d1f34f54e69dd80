"""Sinks: partitioned parquet layers, append, upsert / insert-ignore table
versions, JDBC, JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockcast.operators import serve
from dockcast.sources import files
from dockcast.sources.files import exists
from dockcast.sources.readers import DATE_PART, with_date


def write_layer(df: DataFrame, path: str, *, ts: str = "extraction_ts", mode: str = "append",
                sort_by: Sequence[str] = ("id", "extraction_ts")) -> None:
    """Write a layer partitioned by the date of ``ts`` (``readers.local_date``).

    ``mode='overwrite'`` replaces only the dates present in ``df`` (dynamic
    partition overwrite), which is what re-processing a range needs. Rows
    are sorted inside each file only."""
    out = df if DATE_PART in df.columns else with_date(df, ts)
    # range partitioning on (date, sort keys): a day is spread over as many
    # tasks as its size needs (never one task per day), each task writes a
    # few date folders with files already in sort order
    keys = [DATE_PART, *[c for c in sort_by if c in out.columns]]
    out = out.repartitionByRange(*keys).sortWithinPartitions(*keys)
    w = out.write.mode(mode).partitionBy(DATE_PART)
    if mode == "overwrite":
        w = w.option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


def drop_dates(spark: SparkSession, path: str, first, last, *, keep: DataFrame, ts: str = "extraction_ts") -> list[str]:
    """Remove a layer's dates from ``first`` to ``last`` (inclusive) that
    ``keep`` has no rows of; a dynamic overwrite leaves those as they were."""
    kept = {str(r[0]) for r in with_date(keep, ts).select(DATE_PART).distinct().collect()}  # one value a day
    there = [n.split("=", 1)[1] for n in files.children(spark, path) if n.startswith(f"{DATE_PART}=")]
    gone = [d for d in there if str(first) <= d <= str(last) and d not in kept]
    for d in gone:
        files.remove(spark, f"{path}/{DATE_PART}={d}")
    return gone


BATCH = "batch"


def append_once(df: DataFrame, path: str, batch: int, *, ts: str = "extraction_ts", again: bool = True) -> None:
    """Append a numbered batch to a layer so that a batch tried again is there
    once.

    Rows carry the number in a column ``batch`` (files of other jobs have none
    and read as null), so the layout is that of :func:`write_layer`. If ``again``,
    the rows that an earlier try of the batch left, on the dates it touches,
    are set against the new ones, and only those still missing are written.
    The same input gives the same rows, so the result is the same."""
    out = with_date(df, ts).withColumn(BATCH, F.lit(batch).cast("long"))
    if again and exists(df.sparkSession, path):
        old = df.sparkSession.read.schema(out.schema).parquet(path).filter(F.col(BATCH) == batch)
        days = out.select(DATE_PART).distinct()
        out = out.exceptAll(old.join(days, DATE_PART, "left_semi").select(*out.columns))
    write_layer(out, path, ts=ts)


def last_batch(spark: SparkSession, path: str) -> int:
    """The highest batch number in a layer; -1 without any."""
    if not exists(spark, path):
        return -1
    top = spark.read.schema(f"{BATCH} long").parquet(path).agg(F.max(BATCH)).first()[0]
    return -1 if top is None else int(top)


def append(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    df.write.mode("append").format(fmt).save(path)


def write_version(df: DataFrame, base: str, version: int | str) -> str:
    """Write a new immutable table version; readers switch to it after the
    write succeeds (a path cannot be overwritten while it is being read)."""
    path = f"{base.rstrip('/')}/v={version}"
    df.write.mode("overwrite").parquet(path)
    return path


def upsert_version(spark: SparkSession, current: str, updates: DataFrame, key: Sequence[str],
                   base: str, version: int | str) -> str:
    """Status-table upsert as a new version: the full outer join of the
    current version with the updates, whole rows taken from the update."""
    state = serve.upsert(spark.read.parquet(current), updates, key)
    return write_version(state, base, version)


PART = "key_part"


def key_part(key: Sequence[str], parts: int) -> Column:
    """The part of a keyed table that a key belongs to."""
    return F.pmod(F.xxhash64(*key), F.lit(parts)).cast("int")


def write_keyed(df: DataFrame, path: str, key: Sequence[str], parts: int = 64) -> None:
    """A table in ``parts`` folders by key hash, for :func:`upsert_parts`."""
    out = df.withColumn(PART, key_part(key, parts))
    out.repartition(parts, PART).write.mode("overwrite").partitionBy(PART).parquet(path)


def read_keyed(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(path).drop(PART)


def upsert_parts(spark: SparkSession, path: str, updates: DataFrame, key: Sequence[str], schema, parts: int = 64) -> list[int]:
    """Status-table upsert in place, part by part: only the parts that hold an
    updated key are read and replaced (dynamic partition overwrite); returns
    them. The new parts are materialised first, as the old ones are read for
    them. The upsert is idempotent, so a run that broke off is run again.
    ``schema`` names the table's columns, ``parts`` is what it was written with."""
    from dockcast.session import cut_lineage
    fields = (schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)).fields
    names = [f.name for f in fields]
    new = updates.select(*names).withColumn(PART, key_part(key, parts))
    touched = sorted(r[0] for r in new.select(PART).distinct().collect())  # at most ``parts`` numbers
    if not touched:
        return []
    full = T.StructType([*fields, T.StructField(PART, T.IntegerType())])
    old = spark.read.schema(full).parquet(path).filter(F.col(PART).isin(touched))
    state = cut_lineage(serve.upsert(old.select(*names), new.select(*names), key)).withColumn(PART, key_part(key, parts))
    state.repartition(len(touched), PART).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(path)
    return touched


def insert_ignore_append(spark: SparkSession, target: str, incoming: DataFrame, key: Sequence[str]) -> int:
    """Append the rows whose key is not in the target yet; returns how many.
    The new rows are materialised first so the count and the write agree."""
    from dockcast.session import cut_lineage
    new = cut_lineage(serve.insert_ignore(spark.read.parquet(target), incoming, key))
    n = new.count()
    if n:
        new.write.mode("append").parquet(target)
    return n


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", properties: dict | None = None,
               batch_size: int = 10_000) -> None:
    """SQL-store sink through the DataFrame writer (parameterised batches,
    no hand-built INSERT text)."""
    props = dict(properties or {})
    props.setdefault("batchsize", str(batch_size))
    df.write.jdbc(url, table, mode=mode, properties=props)


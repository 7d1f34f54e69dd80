"""Files of a remote folder that a layer lacks, copied in with a written
record; and a history of files whose schemas differ, some unreadable."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockcast.session import cut_lineage
from dockcast.sources import files, sinks

BLOCK_FILES = 10_000  # files planned, read and recorded at once


# ------------------------------------------------------------------ synchronisation

def missing_files(spark: SparkSession, source: str, target: str, pattern: str | None = None) -> DataFrame:
    """file, path, length, modified of the files under ``source`` that the
    layer ``target`` has no record of. A file that has changed its length since
    it was copied is missing again."""
    found = files.list_files(spark, source, pattern)
    done = _recorded(spark, target)
    return found if done is None else found.join(done.select("file", "length"), ["file", "length"], "left_anti")


def _recorded(spark: SparkSession, target: str) -> DataFrame | None:
    """The files of all finished blocks."""
    blocks = [f"{target}/_synced/{n}" for n in _blocks(spark, target)[0]]
    return spark.read.parquet(*blocks) if blocks else None


def _blocks(spark: SparkSession, target: str) -> tuple[list[str], list[str]]:
    """Folders of finished and of planned blocks, in order."""
    return files.folders(spark, f"{target}/_synced", "n"), files.folders(spark, f"{target}/_synced", "planned")


def sync_missing(spark: SparkSession, source: str, target: str, *, schema, limit: int | None = None, pattern: str | None = None, ts: str = "extraction_ts",
                 read: Callable[[list[str]], DataFrame] | None = None, block_files: int = BLOCK_FILES) -> int:
    """Copy the rows of missing files into a date-partitioned layer, the newest
    file names first, at most ``limit`` files; returns how many were copied.

    Files go in blocks. A block's file list is written before its rows are
    (``_synced/planned=n`` in the layer, which readers skip), and gets its final
    name when they are there; so a second run copies nothing, and a run that
    broke off is taken up at its block, whose rows are then there once
    (``sinks.append_once``). The driver holds one block's names."""
    read = read or (lambda paths: spark.read.schema(schema).parquet(*paths))
    copied = 0
    while limit is None or copied < limit:
        finished, planned = _blocks(spark, target)
        n = files.number(finished[-1]) + 1 if finished else 0
        again = bool(planned)
        if not again:
            take = block_files if limit is None else min(block_files, limit - copied)
            block = missing_files(spark, source, target, pattern).orderBy(F.desc("file")).limit(take)
            draft = f"{target}/_synced/_draft"
            block.coalesce(1).write.mode("overwrite").parquet(draft)  # at most block_files rows
            if spark.read.parquet(draft).isEmpty():
                files.remove(spark, draft)
                break
            files.publish(spark, draft, f"{target}/_synced/planned={n}")
        plan = f"{target}/_synced/planned={n}"
        paths = [r[0] for r in spark.read.parquet(plan).select("path").sort("path").collect()]
        sinks.append_once(read(paths), target, n, ts=ts, again=again)
        files.publish(spark, plan, f"{target}/_synced/n={n}")
        copied += len(paths)
    return copied


# ------------------------------------------------------------------ history of differing files

def file_schemas(spark: SparkSession, path: str) -> DataFrame:
    """file, path, schema (JSON), error: what each Parquet file's own footer
    says. Footers are cut out of the files by Spark, so any store it reads will
    do, and only footers go to Python. A file without a readable footer has an
    error and no schema."""
    import sys

    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    size = F.conv(F.concat(*[F.hex(F.substring("content", -5 - i, 1)) for i in range(4)]), 16, 10).cast("long")
    tail = F.when(F.length("content") >= 12, F.expr("substring(content, -8)")).alias("tail")
    footers = r.select("path", F.col("length"), "content", tail, F.when(F.length("content") >= 12, size).alias("size"))
    whole = (F.substring(F.col("tail"), 5, 4) == F.lit(b"PAR1")) & (F.col("size") <= F.col("length") - 12)
    footers = footers.select("path", F.when(whole, F.expr("substring(content, cast(-(size + 8) as int))")).alias("footer"))
    named = files.list_files(spark, path).select("file", "path")
    return named.join(footers.mapInArrow(_read_footers, "path string, schema string, error string"), "path").select("file", "path", "schema", "error")


def _read_footers(batches):
    import io

    import pyarrow as pa
    import pyarrow.parquet as pq
    from pyspark.sql.pandas.types import from_arrow_schema

    def one(footer):
        if footer is None:
            return None, "no Parquet footer"
        try:
            found = pq.read_metadata(io.BytesIO(b"PAR1" + footer))
            own = (found.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata")
            return own.decode() if own else from_arrow_schema(found.schema.to_arrow_schema()).json(), None
        except Exception as e:  # noqa: BLE001 - whatever is wrong with a file belongs in the report
            return None, f"{type(e).__name__}: {e}"[:500]
    for b in batches:
        made = [one(x) for x in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([s for s, _ in made], pa.string()), pa.array([e for _, e in made], pa.string())], names=["path", "schema", "error"])


_WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds values of both: the wider integer, a double for
    integers with fractions, a timestamp for dates with times, else text."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if a in _WHOLE and b in _WHOLE:
        return max(a, b, key=_WHOLE.index)
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return T.DoubleType()
    times = (T.DateType, T.TimestampType, T.TimestampNTZType)
    if isinstance(a, times) and isinstance(b, times) and T.DateType() in (a, b):
        return b if isinstance(a, T.DateType) else a
    return T.StringType()


def merged_schema(schemas: Sequence[T.StructType]) -> T.StructType:
    """All columns, in the order they are first met, each as wide as needed."""
    kinds: dict[str, T.DataType] = {}
    for s in schemas:
        for f in s.fields:
            kinds[f.name] = wider(kinds[f.name], f.dataType) if f.name in kinds else f.dataType
    return T.StructType([T.StructField(n, k) for n, k in kinds.items()])


MAX_SCHEMAS = 1000


def read_history(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """All rows of a folder of Parquet files whose columns and types differ,
    and a report of files that can't be read (file, error).

    Files are read schema by schema (each under its own, so nothing is guessed),
    cast to the merged schema and put together; a column that a file lacks is
    null. The driver holds the file names, as it does for any read."""
    found = cut_lineage(file_schemas(spark, path))  # one pass over the footers
    kinds = found.filter(F.col("schema").isNotNull()).groupBy("schema").agg(F.min("file").alias("first")).orderBy("first").limit(MAX_SCHEMAS + 1).collect()
    if len(kinds) > MAX_SCHEMAS:
        raise ValueError(f"{path} has more than {MAX_SCHEMAS} different schemas")
    own = [T.StructType.fromJson(json.loads(k["schema"])) for k in kinds]
    want = merged_schema(own)
    parts = []
    for k, s in zip(kinds, own):
        paths = [r[0] for r in found.filter(F.col("schema") == k["schema"]).select("path").sort("path").collect()]
        df = spark.read.schema(s).parquet(*paths)
        parts.append(df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) if f.name in s.names else F.lit(None).cast(f.dataType).alias(f.name) for f in want.fields]))
    rows = reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], want)
    return rows, found.filter(F.col("error").isNotNull()).select("file", "error")

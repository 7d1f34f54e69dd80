"""Helpers shared by the operators of this subpackage.

Every operator takes a frame and the names of the columns it needs, selects
just those, and returns a frame of its own columns; other columns of the
input, whatever their names, never reach the result.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockcast.session import ensure_checkpoint_dir

# White space of the word rule: blank and \x09-\x0D.
SPACE = " \t\n\x0b\x0c\r"
SPACE_RE = r"[\x20\x09-\x0D]+"


def ship(name: str) -> None:
    """Python functions of this subpackage travel inside the task (pickled by
    value), so executors need no copy of the package."""
    import importlib
    for m in (name, __name__):
        cloudpickle.register_pickle_by_value(importlib.import_module(m))


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back: cuts
    the lineage with files that outlive any executor."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def append_arrow(df: DataFrame, cols: list[str], out: str, out_type: str, fn: Callable[..., object],
                 rows: int = 1024, drop: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with one more column ``out``: ``fn`` gets the Arrow arrays of
    ``cols`` for up to ``rows`` rows and returns that many values of
    ``out_type``. No shuffle; all other columns pass through untouched, but
    those of ``drop``, which don't come back from Python."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StructType, _parse_datatype_string

    kind = _parse_datatype_string(out_type)
    arrow_kind = to_arrow_type(kind)
    kept = [c for c in df.columns if c not in drop]
    schema = StructType([f for f in df.schema.fields if f.name in kept]).add(out, kind)
    at, stay = [df.columns.index(c) for c in cols], [df.columns.index(c) for c in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, rows):
                b = whole.slice(i, rows)
                made = fn(*[b.column(j) for j in at])
                if not isinstance(made, pa.Array):
                    made = pa.array(made, arrow_kind)
                yield pa.RecordBatch.from_arrays([*[b.column(j) for j in stay], made], names=[*kept, out])

    return df.mapInArrow(run, schema)


def texts_of(array) -> list[bytes]:
    """UTF-8 bytes of an Arrow string array; null gives b''."""
    import pyarrow as pa
    return [x or b"" for x in array.cast(pa.large_binary() if pa.types.is_large_string(array.type) else pa.binary()).to_pylist()]


def crc_mod5(doc_id: Column) -> Column:
    """crc32 of the id's decimal text, mod 5 (null id: of the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5


def expand(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, … (count[0] of them), start[1], …"""
    total = int(count.sum())
    ends = np.cumsum(count)
    return np.arange(total) - np.repeat(ends - count, count) + np.repeat(start, count)

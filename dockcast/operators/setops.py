"""Set operations used by the pipelines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_by_name(*frames: DataFrame, allow_missing: bool = True) -> DataFrame:
    """Stack frames by column name; missing columns become null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=allow_missing)
    return out


def stack_rows(df: DataFrame, keep: Sequence[str], variants: Sequence[dict[str, Column]],
               keep_if: Sequence[Column | None] | None = None) -> DataFrame:
    """Several output rows per input row in one pass (``inline`` of an array
    of structs), instead of a union of repeated scans. ``keep_if`` drops a
    variant's row when its condition is false."""
    structs = []
    for i, v in enumerate(variants):
        s = F.struct(*[c.alias(n) for n, c in v.items()])
        cond = keep_if[i] if keep_if else None
        structs.append(s if cond is None else F.when(cond, s))
    arr = F.filter(F.array(*structs), lambda x: x.isNotNull())
    return df.select(*keep, F.inline(arr))


def id_difference(a: DataFrame, a_col: str, b: DataFrame, b_col: str, out: str = "id") -> DataFrame:
    """Distinct ids of ``a`` not in ``b`` (SQL EXCEPT, set semantics)."""
    left = a.select(F.col(a_col).alias(out)).distinct()
    right = b.select(F.col(b_col).alias(out))
    return left.join(right, left[out].eqNullSafe(right[out]), "left_anti")

"""Whole-frame summaries in a fixed number of scans, however many columns:
``describe_all`` (counts, moments, exact quartiles, most frequent texts) and
``correlations`` (every pair of columns).

Quantiles are found by radix selection. A number has an unsigned 64-bit image
that sorts as the number does; the order statistic's image is found 16 bits at
a time: one scan counts, for all columns and all wanted ranks at once, how many
values in a rank's bracket go on with which digit, and the running count names
the next digit. Four scans find every rank exactly, whatever the ties, and a
task sends at most 65,536 counts a bracket. NaN counts as missing here, as a
null does.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockcast.operators.aggregates import _positions

QUARTILES = (0.25, 0.5, 0.75)
DIGIT_BITS, DIGITS = 16, 4


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def _ship() -> None:
    """The functions below travel with the task (see ``session.ship_package``)."""
    import sys

    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _number(df: DataFrame, name: str) -> Column:
    """Integers as they are, other numbers as doubles, NaN as null."""
    c, kind = F.col(f"`{name}`"), df.schema[name].dataType
    if isinstance(kind, T.IntegralType):
        return c.cast("long")
    d = c.cast("double")
    return F.when(~F.isnan(d), d)


# ------------------------------------------------------------------ radix selection

def image(values: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit image in the order of the numbers (-0.0 is 0.0)."""
    top = np.uint64(1 << 63)
    if values.dtype.kind == "i":
        return values.astype(np.int64).view(np.uint64) ^ top
    bits = (values + 0.0).view(np.uint64)
    return np.where(bits >= top, ~bits, bits | top)


def number(img: int, integral: bool) -> int | float:
    """The number of an image."""
    if integral:
        return int(np.uint64(img ^ (1 << 63)).view(np.int64))
    bits = img ^ (1 << 63) if img >> 63 else ~img & ((1 << 64) - 1)
    return float(np.uint64(bits).view(np.float64))


def _digit_counts(brackets: list[list[int]], depth: int):
    """Map function: (column, bracket, next digit, values) of a task.
    ``brackets[c]`` are the leading digits, as one number, of column c's ranks."""
    import pyarrow as pa
    low = 64 - DIGIT_BITS * (depth + 1)

    def run(batches):
        held: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        for b in batches:
            for c, leads in enumerate(brackets):
                if not leads:
                    continue
                v = image(b.column(c).drop_null().to_numpy(zero_copy_only=False))
                head = (v >> np.uint64(low)) >> np.uint64(DIGIT_BITS) if depth else None
                for lead in leads:
                    mine = v if head is None else v[head == np.uint64(lead)]
                    d, n = np.unique((mine >> np.uint64(low)) & np.uint64((1 << DIGIT_BITS) - 1), return_counts=True)
                    if (c, lead) in held:
                        d0, n0 = held[c, lead]
                        d, at = np.unique(np.r_[d0, d], return_inverse=True)
                        n = np.bincount(at, np.r_[n0, n]).astype(np.int64)
                    held[c, lead] = d, n
        for (c, lead), (d, n) in held.items():
            k = leads_at[c][lead]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(d), c), pa.int32()), pa.array(np.full(len(d), k), pa.int32()), pa.array(d.astype(np.int64), pa.int32()), pa.array(n, pa.int64())],
                                             names=["c", "k", "d", "n"])
    leads_at = [{lead: i for i, lead in enumerate(leads)} for leads in brackets]
    return run


def select_ranks(df: DataFrame, ranks: dict[str, Sequence[int]]) -> dict[str, dict[int, int | float]]:
    """The values at 1-based ``ranks`` of several numeric columns (nulls not
    counted), in four scans of those columns."""
    _ship()
    cols = list(ranks)
    rows = df.select(*[_number(df, c).alias(f"c{i}") for i, c in enumerate(cols)])
    # per column and rank: the leading digits found so far, and how many values lie below them
    at = [{r: (0, 0) for r in ranks[c]} for c in cols]
    spark = df.sparkSession
    for depth in range(DIGITS):
        brackets = [sorted({lead for lead, _ in a.values()}) for a in at]
        wanted = [(c, brackets[c].index(lead), r, r - below) for c, a in enumerate(at) for r, (lead, below) in a.items()]
        if not wanted:
            break
        counts = rows.mapInArrow(_digit_counts(brackets, depth), "c int, k int, d int, n long").groupBy("c", "k", "d").agg(F.sum("n").alias("n"))
        to = F.sum("n").over(Window.partitionBy("c", "k").orderBy("d").rowsBetween(Window.unboundedPreceding, 0))  # at most 65,536 rows a bracket
        want = F.broadcast(spark.createDataFrame(wanted, "c int, k int, r long, left long"))
        hits = counts.withColumn("to", to).join(want, ["c", "k"]).filter((F.col("to") >= F.col("left")) & (F.col("to") - F.col("n") < F.col("left")))
        for h in hits.select("c", "r", "d", (F.col("to") - F.col("n")).alias("under")).collect():  # one row per column and rank
            lead, below = at[h["c"]][h["r"]]
            at[h["c"]][h["r"]] = ((lead << DIGIT_BITS) | h["d"], below + h["under"])
    integral = [isinstance(df.schema[c].dataType, T.IntegralType) for c in cols]
    return {c: {r: number(lead, integral[i]) for r, (lead, _) in at[i].items()} for i, c in enumerate(cols)}


# ------------------------------------------------------------------ describe

SUMMARY = T.StructType([T.StructField("column", T.StringType()), T.StructField("n", T.LongType()), T.StructField("unique", T.LongType()), T.StructField("top", T.StringType()),
                        T.StructField("freq", T.LongType()), *[T.StructField(c, T.DoubleType()) for c in ("mean", "std", "min", "q1", "q2", "q3", "max")]])


def text_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, n, unique, top, freq: values, different values, and the most
    frequent one (ties: the least) of text columns, in one scan. Values are
    counted before they are sent, so a frequent one costs a row a task."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("v")) for c in columns])).alias("p")
    counts = df.select(pairs).select("p.column", "p.v").filter(F.col("v").isNotNull()).groupBy("column", "v").agg(F.count(F.lit(1)).alias("k"))
    best = F.min(F.struct((-F.col("k")).alias("k"), F.col("v").alias("v")))
    return counts.groupBy("column").agg(F.sum("k").alias("n"), F.count(F.lit(1)).alias("unique"), best.alias("b")) \
        .select("column", "n", "unique", F.col("b.v").alias("top"), (-F.col("b.k")).alias("freq"))


def describe_all(df: DataFrame, *, quantiles: Sequence[float] = QUARTILES, digits: int = 6) -> DataFrame:
    """One row per numeric or text column: n, and for numbers mean, std
    (sample), min, quartiles (interpolated, type 7) and max, for texts unique,
    top and freq; the others are null. Six scans: moments, texts, four digits.
    A column without values has n 0."""
    spark, numbers, texts = df.sparkSession, numeric_columns(df), text_columns(df)
    out = []
    if numbers:
        aggs = [f(_number(df, c).cast("double")).alias(f"{k}{i}") for i, c in enumerate(numbers) for k, f in
                (("n", F.count), ("mean", F.avg), ("std", F.stddev_samp), ("lo", F.min), ("hi", F.max))]
        m = df.agg(*aggs).first()
        spots = {c: [_positions(m[f"n{i}"], q) for q in quantiles] if m[f"n{i}"] else [] for i, c in enumerate(numbers)}
        found = select_ranks(df, {c: sorted({r for lo, hi, _ in s for r in (lo, hi)}) for c, s in spots.items()})
        for i, c in enumerate(numbers):
            q = [float(found[c][lo]) + (float(found[c][hi]) - float(found[c][lo])) * part for lo, hi, part in spots[c]] or [None] * len(quantiles)
            out.append((c, m[f"n{i}"], None, None, None, m[f"mean{i}"], m[f"std{i}"], m[f"lo{i}"], *q, m[f"hi{i}"]))
    names = [f"q{i + 1}" for i in range(len(quantiles))]
    schema = T.StructType([*SUMMARY.fields[:8], *[T.StructField(n, T.DoubleType()) for n in names], SUMMARY["max"]])
    whole = spark.createDataFrame(out, schema)
    rounded = whole.select(*[F.round(f.name, digits).alias(f.name) if f.name in ("mean", "std", *names) else F.col(f.name) for f in schema.fields])
    if not texts:
        return rounded
    t = spark.createDataFrame([(c,) for c in texts], "column string").join(text_summary(df, texts), "column", "left")
    t = t.select("column", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("unique", F.lit(0)).alias("unique"), "top", "freq")
    return rounded.unionByName(t.select(*[F.col(f.name) if f.name in t.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]))


# ------------------------------------------------------------------ correlations

def _gram(n: int, shift: list[float]):
    """Map function: the sums of every pair of columns over the rows where
    both have a value, from products of whole batches (x less its shift; m = 1
    where there is a value)."""
    import pyarrow as pa

    def run(batches):
        total = np.zeros((5, n, n))
        for b in batches:
            x = np.column_stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(n)]) - np.array(shift)
            m = ~np.isnan(x)
            x, m = np.where(m, x, 0.0), m.astype(float)
            total += np.stack([m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x, m.T @ x])
        i, j = (a.ravel() for a in np.indices((n, n)))
        sums = [t.ravel() for t in total]
        sums.append(total[2].T.ravel())  # squares of the second column where the first has a value
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), *[pa.array(s, pa.float64()) for s in sums]], names=["i", "j", "n", "sx", "sxx", "sxy", "sy", "syy"])
    return run


def correlations(df: DataFrame, columns: Sequence[str] | None = None, *, digits: int = 6) -> DataFrame:
    """a, b, n, r: the Pearson correlation of every pair of numeric columns
    over the n rows where both have a value (null if either is constant
    there). One matrix of sums a task, summed in one exchange; the columns are
    shifted by their means (one aggregate before) so that sums of squares keep
    their digits."""
    _ship()
    cols = list(columns) if columns is not None else numeric_columns(df)
    if not cols:
        return df.sparkSession.createDataFrame([], "a string, b string, n long, r double")
    rows = df.select(*[_number(df, c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    means = rows.agg(*[F.avg(f"c{i}").alias(f"m{i}") for i in range(len(cols))]).first()
    shift = [m if m is not None and np.isfinite(m) else 0.0 for m in means]
    sums = rows.mapInArrow(_gram(len(cols), shift), "i int, j int, n double, sx double, sxx double, sxy double, sy double, syy double") \
        .groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sxx", "sxy", "sy", "syy")])
    n = F.col("n")
    vx, vy = n * F.col("sxx") - F.col("sx") * F.col("sx"), n * F.col("syy") - F.col("sy") * F.col("sy")
    flat = (vx <= F.lit(1e-12) * n * F.col("sxx")) | (vy <= F.lit(1e-12) * n * F.col("syy"))
    r = F.when(~flat, (n * F.col("sxy") - F.col("sx") * F.col("sy")) / F.sqrt(vx * vy))
    names = F.array(*[F.lit(c) for c in cols])
    return sums.select(F.element_at(names, F.col("i") + 1).alias("a"), F.element_at(names, F.col("j") + 1).alias("b"), n.cast("long").alias("n"), F.round(r, digits).alias("r"))

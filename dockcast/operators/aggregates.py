"""Profiling and summary aggregates. All are hash aggregates with partial
(map-side) combine; the exact quantiles come from sketches and counts of
distinct values, not from a buffer of values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockcast.functions.scalar import col
from dockcast.operators import sequence as sq


def key_uniqueness(df: DataFrame, key: Sequence[str], n: str = "n", groups: str = "groups") -> DataFrame:
    """Histogram of rows per key: how many keys occur n times."""
    per_key = df.groupBy(*[col(c) for c in key]).agg(F.count(F.lit(1)).alias(n))
    return per_key.groupBy(n).agg(F.count(F.lit(1)).alias(groups))


def null_profile(df: DataFrame, columns: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Null count per column; ``columns`` maps output name → input column."""
    if not isinstance(columns, Mapping):
        columns = {f"{c}_nulls": c for c in columns}
    return df.agg(*[F.count_if(col(c).isNull()).cast("long").alias(o) for o, c in columns.items()])


def value_counts(df: DataFrame, column: str, n: str = "n") -> DataFrame:
    return df.groupBy(col(column)).agg(F.count(F.lit(1)).alias(n))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(col(column)).distinct()


def ratio_by_group(df: DataFrame, group: str, predicate: Column, out: str = "r", digits: int | None = 6,
                   empty_as_null: bool = False) -> DataFrame:
    """Share of rows meeting ``predicate`` per group. ``empty_as_null`` gives
    null instead of 0 for groups where no row meets it (the result of
    aligning two separately counted series by group)."""
    hits = F.count_if(predicate)
    r = hits / F.count(F.lit(1))
    if empty_as_null:
        r = F.when(hits > 0, r)
    return df.groupBy(col(group)).agg((F.round(r, digits) if digits is not None else r).alias(out))


def check_sums(df: DataFrame, identity: Column, bad: str = "bad", n: str = "n") -> DataFrame:
    """Rows where an identity (e.g. space = full + empty) fails, and all rows.
    A null comparison does not count as a failure."""
    return df.agg(F.count_if(~F.coalesce(identity, F.lit(True))).cast("long").alias(bad),
                  F.count(F.lit(1)).alias(n))


# accuracy of the bracketing sketch: rank error ≤ n / QUANTILE_ACCURACY
QUANTILE_ACCURACY = 10_000
# brackets with more values than this are narrowed by another sketch
BRACKET_VALUES = 1_000_000


def _positions(n: int, q: float) -> tuple[int, int, float]:
    """1-based ranks of the two order statistics around quantile q and the
    interpolation weight (type 7, as quantile_cont)."""
    h = (n - 1) * float(q)
    lo = int(h // 1) + 1
    return lo, min(lo + 1, n), h - (lo - 1)


def order_statistics(df: DataFrame, column: str, ranks: Sequence[int], bracket_values: int = BRACKET_VALUES) -> dict[int, float]:
    """Exact values at 1-based ``ranks`` of the non-null column.

    A coarse sketch brackets each rank, (value below, value above]; while the
    bracket holds more than ``bracket_values`` different values, a sketch of
    the bracket's distinct counts narrows it. Then a running count over the
    bracket's distinct values (one row each, however many ties it has) finds
    the value. Nothing is buffered; the driver sees a few numbers per rank.
    """
    v = df.select(col(column).cast("double").alias("v")).filter(F.col("v").isNotNull())
    out = {}
    todo = {r: (None, None, 0) for r in ranks}  # rank: over lo, up to hi, values at or under lo
    while todo:
        stats = v.agg(*[e for r, (lo, hi, _) in todo.items() for e in _bracket_stats(lo, hi, r)]).first()
        wide = {}
        for r, (lo, hi, below) in todo.items():
            if stats[f"lo{r}"] == stats[f"hi{r}"]:
                out[r] = stats[f"lo{r}"]
            elif stats[f"d{r}"] <= bracket_values:
                out[r] = _counted(v, lo, hi, r - below)
            else:
                wide[r] = (lo, hi, below)
        if not wide:
            break
        probes = v.agg(*[F.percentile_approx(F.when(_inside(lo, hi), F.col("v")), _around(r - below, stats[f"n{r}"]), QUANTILE_ACCURACY).alias(f"p{r}")
                         for r, (lo, hi, below) in wide.items()]).first()
        at = v.agg(*[F.count_if(F.col("v") <= F.lit(p)).alias(f"c{r}_{k}") for r in wide for k, p in enumerate(probes[f"p{r}"])]).first()
        todo = {}
        for r, (lo, hi, below) in wide.items():
            ends = [(p, at[f"c{r}_{k}"]) for k, p in enumerate(probes[f"p{r}"])]
            lo2, below2 = max([x for x in ends if x[1] < r], default=(lo, below))
            hi2 = min([x[0] for x in ends if x[1] >= r], default=hi)
            if (lo2, hi2) == (lo, hi):  # a sketch can't part these values: count them
                out[r] = _counted(v, lo, hi, r - below)
            else:
                todo[r] = (lo2, hi2, below2)
    return out


def _counted(v: DataFrame, lo, hi, r: int) -> float:
    """The r-th value of a bracket by a running count over its distinct values."""
    counts = v.filter(_inside(lo, hi)).groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    to = F.sum("n").over(Window.orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    return counts.select("v", to.alias("to")).filter(F.col("to") >= r).agg(F.min("v")).first()[0]


def _inside(lo, hi) -> Column:
    c = F.lit(True)
    if lo is not None:
        c = c & (F.col("v") > F.lit(lo))
    return c if hi is None else c & (F.col("v") <= F.lit(hi))


def _bracket_stats(lo, hi, i: int) -> list[Column]:
    inside = F.when(_inside(lo, hi), F.col("v"))
    return [F.count(inside).alias(f"n{i}"), F.min(inside).alias(f"lo{i}"), F.max(inside).alias(f"hi{i}"), F.approx_count_distinct(inside).alias(f"d{i}")]


def _around(r: int, n: int) -> list[float]:
    """Probes on both sides of rank r of n, and at it."""
    p, slack = (r - 1) / max(n - 1, 1), 2.0 / QUANTILE_ACCURACY
    return [max(p - slack, 0.0), p, min(p + slack, 1.0)]


def exact_quantiles(df: DataFrame, column: str, qs: Sequence[float]) -> DataFrame:
    """Exact interpolated quantiles (type 7, as quantile_cont), one row with
    columns "0", "1", … (see ``order_statistics``); nulls ignored."""
    return _quantile_frame(df, column, qs, {})


def _quantile_frame(df: DataFrame, column: str, qs: Sequence[float], extra: dict[str, Column]) -> DataFrame:
    """One row: ``extra`` aggregates over ``df`` plus the exact quantiles
    (columns "0", "1", …) of ``column``, nulls ignored."""
    n = int(df.agg(F.count(col(column).cast("double")).alias("n")).first()["n"])
    spots = [_positions(n, q) for q in qs] if n else []
    at = order_statistics(df, column, sorted({r for lo, hi, _ in spots for r in (lo, hi)})) if n else {}
    values = [at[lo] + (at[hi] - at[lo]) * frac for lo, hi, frac in spots] if n else [None] * len(qs)
    outs = [F.lit(x).cast("double").alias(str(i)) for i, x in enumerate(values)]
    if not extra:
        return df.sparkSession.range(1).select(*outs)
    return df.agg(*[c.alias(k) for k, c in extra.items()]).select(*extra, *outs)


def describe(df: DataFrame, column: str, *, digits: int = 6) -> DataFrame:
    """count, mean, std, min, quartiles, max of one column (exact quartiles,
    see ``exact_quantiles``); the moments ride along in the second pass."""
    c = col(column).cast("double")
    moments = {"n": F.count(c), "mean": F.avg(c), "std": F.stddev_samp(c), "lo": F.min(c), "hi": F.max(c)}
    row = _quantile_frame(df, column, [0.25, 0.5, 0.75], moments)
    return row.select("n", F.round("mean", digits).alias("mean"), F.round("std", digits).alias("std"), "lo",
                      *[F.round(F.col(str(i)), digits).alias(f"q{i + 1}") for i in range(3)], "hi")


def group_mean(df: DataFrame, keys: Mapping[str, Column], value: Column, out: str, digits: int | None = 6) -> DataFrame:
    """Mean of ``value`` per computed keys (e.g. hour × day of week)."""
    m = F.avg(value)
    return df.groupBy(*[c.alias(n) for n, c in keys.items()]).agg(
        (F.round(m, digits) if digits is not None else m).alias(out))


def right_closed_bins(x: Column, edges: Sequence[float]) -> Column:
    """Label of the right-closed bin (a, b] holding x; null outside all bins.
    (ML ``Bucketizer`` is left-closed, so it is not used.)"""
    out = None
    for a, b in zip(edges[:-1], edges[1:]):
        label = f"({_num(a)},{_num(b)}]"
        cond = (x > F.lit(a)) & (x <= F.lit(b))
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out


def _num(v: float) -> str:
    return str(int(v)) if float(v).is_integer() else str(v)


def bin_histogram(df: DataFrame, column: str, edges: Sequence[float], label: str = "b", n: str = "n") -> DataFrame:
    return df.groupBy(right_closed_bins(col(column), edges).alias(label)).agg(F.count(F.lit(1)).alias(n))


def corr_matrix(df: DataFrame, pairs: Mapping[str, tuple[str, str]], digits: int = 6) -> DataFrame:
    """Pearson correlation for named column pairs, one pass."""
    return df.agg(*[F.round(F.corr(col(a), col(b)), digits).alias(o) for o, (a, b) in pairs.items()])


def latest_rows(df: DataFrame, ts: str | Column, unit: str | None = None) -> DataFrame:
    """Rows at the greatest ``ts`` (optionally truncated to ``unit``).

    The max is a one-row aggregate joined back with a broadcast (bound: one
    row), so no unpartitioned window is needed.
    """
    t = col(ts)
    key = t if unit is None else F.date_trunc(unit, t)
    top = df.agg(F.max(key).alias("_top"))
    return df.join(F.broadcast(top), key == F.col("_top"), "left_semi")


# Multiplicative hashing constant (Knuth) and 32-bit range.
HASH_MULT = 2654435761
HASH_RANGE = 1 << 32


def hash_sample(df: DataFrame, key: str, fraction: float) -> DataFrame:
    """Deterministic sample: keep rows whose integer key hashes below
    ``fraction`` of the 32-bit range (same rows on every run and engine;
    ``df.sample(fraction, seed)`` is the random form)."""
    # exact decimal arithmetic: id × constant would overflow 64 bits for ids
    # above ~3.5e9 (an error under ANSI mode)
    k = col(key).cast("decimal(20,0)")
    h = (k * F.lit(HASH_MULT).cast("decimal(10,0)")) % F.lit(HASH_RANGE).cast("decimal(11,0)")
    return df.filter(h < F.lit(int(fraction * HASH_RANGE)))


def sample_keys(df: DataFrame, key: str, n: int = 1, seed: int = 0) -> DataFrame:
    """All rows of ``n`` pseudo-randomly chosen keys (e.g. one station's whole
    series): the keys with the smallest seeded ``xxhash64`` — a top-n over
    distinct keys (each task keeps n), then a semi join."""
    chosen = df.select(col(key).alias("_sk")).distinct().orderBy(
        F.xxhash64(F.col("_sk"), F.lit(seed)), F.col("_sk")).limit(n)
    return df.join(F.broadcast(chosen) if n <= 1_000_000 else chosen, col(key) == F.col("_sk"), "left_semi")


def overview(df: DataFrame, key: str, ts: str) -> DataFrame:
    """Distinct stations, newest snapshot time, row count (one row)."""
    return df.agg(F.count_distinct(col(key)).alias("n_stations"), F.max(col(ts)).alias("latest"),
                  F.count(F.lit(1)).alias("n_rows"))

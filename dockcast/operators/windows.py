"""Time-series features per key (station): lags, leads, rolling means,
forward targets, forward fill, last-n rows.

All bounded-frame features of one key/order are declared together and
evaluated by ``sequence.row_frames`` in a single window pass (one exchange
and one sort for all of them), with hot keys split into chunks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockcast.functions.scalar import col
from dockcast.operators import sequence as sq


class FrameSpec:
    """Collects bounded-frame columns over one (key, order)."""

    def __init__(self) -> None:
        self._items: list = []
        self.preceding = 0
        self.following = 0

    def lag(self, out: str, value, n: int = 1):
        self._items.append((out, lambda w: F.lag(col(value), n).over(w)))
        self.preceding = max(self.preceding, n)
        return self

    def lead(self, out: str, value, n: int = 1):
        self._items.append((out, lambda w: F.lead(col(value), n).over(w)))
        self.following = max(self.following, n)
        return self

    def rolling_mean(self, out: str, value, rows: int, min_periods: int | None = None):
        """Mean of the last ``rows`` rows (current included); null until at
        least ``min_periods`` (default: all ``rows``) non-null values."""
        need = rows if min_periods is None else min_periods

        def f(w):
            frame = w.rowsBetween(-(rows - 1), 0)
            return F.when(F.count(col(value)).over(frame) >= F.lit(need), F.avg(col(value)).over(frame))
        self._items.append((out, f))
        self.preceding = max(self.preceding, rows - 1)
        return self

    def expr(self, out: str, fn, preceding: int = 0, following: int = 0):
        """Any window expression ``fn(w)`` within the declared frame."""
        self._items.append((out, fn))
        self.preceding = max(self.preceding, preceding)
        self.following = max(self.following, following)
        return self

    def apply(self, df: DataFrame, key, order, cfg: sq.SkewConfig | None = None) -> DataFrame:
        items = list(self._items)
        return sq.row_frames(df, key, order, lambda w: {o: f(w) for o, f in items},
                             preceding=self.preceding, following=self.following, cfg=cfg)


def lag_rows(df, key, order, value, n: int, out: str, cfg=None) -> DataFrame:
    return FrameSpec().lag(out, value, n).apply(df, key, order, cfg)


def lead_rows(df, key, order, value, n: int, out: str, cfg=None) -> DataFrame:
    return FrameSpec().lead(out, value, n).apply(df, key, order, cfg)


def rolling_mean(df, key, order, value, rows: int, out: str, min_periods: int | None = None,
                 cfg=None) -> DataFrame:
    return FrameSpec().rolling_mean(out, value, rows, min_periods).apply(df, key, order, cfg)


def lead_columns(df: DataFrame, key, order, columns: dict[str, str], n: int = 1,
                 cfg=None) -> DataFrame:
    """Next-row values of several columns (weather: the next hour's reading)."""
    spec = FrameSpec()
    for out, c in columns.items():
        spec.lead(out, c, n)
    return spec.apply(df, key, order, cfg)


def target_change(df: DataFrame, key, order, value: str, n: int = 3, fwd: str = "fwd",
                  change: str = "change", cfg=None) -> DataFrame:
    """Value ``n`` rows ahead and the relative change value − ahead (the
    training target's sign convention)."""
    out = lead_rows(df, key, order, value, n, fwd, cfg)
    return out.withColumn(change, col(value) - F.col(fwd))


def forward_fill(df: DataFrame, key, order, value: str | Column, out: str, cfg=None) -> DataFrame:
    """Carry the last non-null value forward within each key (never across
    keys)."""
    return sq.carry_forward(df, key, order, value, out, cfg=cfg)


def tail_n(df: DataFrame, key, order, n: int, cfg=None) -> DataFrame:
    """Last ``n`` rows of each key by ``order``."""
    p = sq.position(df, key, order, out="_tail_pos", descending=True, cfg=cfg)
    return p.filter(F.col("_tail_pos") <= n).drop("_tail_pos")


def time_rolling_mean(df: DataFrame, key, ts: str, value, seconds: int, out: str, *,
                      tie: Sequence[str], cfg: sq.SkewConfig | None = None) -> DataFrame:
    """Time-based twin of the rolling mean: per key, the mean of the
    non-null ``value`` of all rows with ts − ``seconds`` ≤ t ≤ ts (a RANGE
    frame, for irregular snapshot spacing). ``tie`` makes rows unique
    within a key.

    Cold keys: a plain RANGE window. Hot keys are cut into time buckets of
    ``seconds``; a frame reaches at most one bucket back, so each bucket's rows
    are copied into the next one as a halo and the same RANGE window runs per
    (key, bucket). Both paths add the same values of the same frame, so nulls,
    NaN and large values have the same effect on either.
    """
    cfg = sq.current_skew(cfg)
    keys = [key] if isinstance(key, str) else list(key)
    tie = list(tie)
    width = seconds * 1_000_000
    us = F.unix_micros(col(ts).cast("timestamp"))
    split = sq.split_hot_keys(df, keys, cfg)
    parts = []
    if split.cold is not None:
        w = Window.partitionBy(*keys).orderBy(us).rangeBetween(-width, 0)
        parts.append(split.cold.withColumn(out, F.avg(col(value)).over(w)))
    if split.hot is not None:
        home = F.struct(F.floor(us / F.lit(width)).alias("b"), F.lit(False).alias("halo"))
        ahead = F.when(us.isNotNull(), F.struct((F.floor(us / F.lit(width)) + 1).alias("b"), F.lit(True).alias("halo")))
        x = split.hot.withColumn("_tr", F.explode(F.filter(F.array(home, ahead), lambda c: c.isNotNull())))
        w = Window.partitionBy(*keys, F.col("_tr.b")).orderBy(us).rangeBetween(-width, 0)
        parts.append(x.withColumn(out, F.avg(col(value)).over(w)).filter(~F.col("_tr.halo")).drop("_tr"))
    return sq._union(parts)


def as_of_columns(df: DataFrame, key, ts: str, columns: Mapping[str, str | Column], seconds: float, *, tie: Sequence[str],
                  ahead: bool = False, max_age: float | None = None, found_at: str | None = None,
                  cfg: sq.SkewConfig | None = None) -> DataFrame:
    """Time-based twin of lag and lead, for irregular snapshot spacing.

    Each row gets the ``columns`` {out: value} of the last row of its key at
    or before ts − ``seconds`` or, with ``ahead``, of the first row at or after
    ts + ``seconds``. Of rows at one time the last by ``tie`` counts (ahead: the
    first); ``tie`` makes rows unique within a key and time. The row found is
    taken whole: where its value is null, the result is null. ``max_age``
    bounds how many seconds the row found may lie beyond the time asked for;
    ``found_at`` names a column for its time. A null ``ts`` finds nothing and
    is never found; without a row the result is null.

    One search for all columns: every row also goes in as a probe, placed
    ``seconds`` away, and a fill over the time-sorted union of rows and probes
    carries the last row on to each probe (``sequence.carry_forward_all``: one
    exchange; hot keys are cut into chunks). Only key, time, ``tie`` and the
    asked columns are doubled.
    """
    keys, tie = ([key] if isinstance(key, str) else list(key)), list(tie)
    us = F.unix_micros(col(ts).cast("timestamp"))
    sign = 1 if ahead else -1
    shift = sign * round(seconds * 1_000_000)
    row = F.struct(us.alias("at"), *[col(v).alias(o) for o, v in columns.items()])
    at_same = 1 if ahead else 0  # rows come before the probes of their time, in either direction
    base = df.select(F.struct("*").alias("_row"), *[col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[col(t).alias(f"_t{i}") for i, t in enumerate(tie)], us.alias("_us"), row.alias("_v"))
    k, t = [f"_k{i}" for i in range(len(keys))], [f"_t{i}" for i in range(len(tie))]
    points = base.filter(F.col("_us").isNotNull()).select(*k, *t, F.col("_us").alias("_at"), F.lit(at_same).alias("_side"), "_v", F.lit(None).cast(base.schema["_row"].dataType).alias("_row"))
    probes = base.select(*k, *t, (F.col("_us") + shift).alias("_at"), F.lit(1 - at_same).alias("_side"), F.lit(None).cast(base.schema["_v"].dataType).alias("_v"), "_row")
    both = points.unionByName(probes)
    filled = sq.carry_forward_all(both, k, ["_at", "_side", *t], {"_found": "_v"}, descending=ahead, cfg=cfg)
    hits = filled.filter(F.col("_row").isNotNull())
    use = F.col("_at").isNotNull() & F.col("_found").isNotNull()
    if max_age is not None:
        use = use & (F.abs(F.col("_found.at") - F.col("_at")) <= round(max_age * 1_000_000))
    outs = [F.when(use, F.col("_found").getField(o)).alias(o) for o in columns]
    if found_at is not None:
        outs.append(F.when(use, F.timestamp_micros("_found.at")).cast(df.schema[ts].dataType).alias(found_at))
    return hits.select(*[F.col("_row").getField(c).alias(c) for c in df.columns], *outs)

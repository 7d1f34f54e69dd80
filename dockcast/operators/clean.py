"""Row validation and de-duplication of station snapshots.

De-duplication is written as aggregation, not as a window: a group of
identical copies may be huge, and a partial aggregate leaves one row of it per
map task instead of sorting it inside one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockcast.functions.scalar import any_null, any_true, col
from dockcast.operators.sequence import _join_ns as join_null_safe


def filter_valid(df: DataFrame, required: Sequence[str] = (), rules: Sequence[Column] = ()) -> DataFrame:
    """Drop every row that has a null in ``required`` or for which any rule
    is true. A rule that evaluates to null (comparison with a null) does not
    drop the row, as with a boolean mask."""
    bad = any_true([any_null(list(required))] + list(rules)) if required else any_true(list(rules))
    return df.filter(~bad)


def station_rules(cutoff_ts: Column | str, *, min_lat: float = 21.89, min_lng: float = 120.0,
                  excess_slack: int | None = 10) -> list[Column]:
    """Validity rules for a raw station snapshot (a row is dropped if any holds):
    not a type-2 station, negative empty docks, no space, south/west of the
    main island, updated before the cut-off, more bikes+docks than space+slack.
    ``cutoff_ts`` is a parameter (midnight of as-of − 8 days, local time),
    never a hidden current time."""
    cutoff = F.lit(cutoff_ts) if isinstance(cutoff_ts, str) else cutoff_ts
    return [
        ~F.col("type").eqNullSafe(2),
        F.col("empty") < 0,
        F.col("space") < 1,
        F.col("lat") < F.lit(min_lat),
        F.col("lng") < F.lit(min_lng),
        F.col("last_update_ts") < cutoff,
    ] + ([F.col("space") < F.col("full") + F.col("empty") - F.lit(excess_slack)] if excess_slack is not None else [])


def eda_rules(cutoff_ts: Column | str) -> list[Column]:
    """The exploratory variant: a fixed cut-off date and no capacity rule
    (use with ``required=['city']``)."""
    return station_rules(cutoff_ts, excess_slack=None)


def staleness_cutoff(as_of, days: int = 8, tz: str = "Asia/Taipei") -> Column:
    """Midnight (in ``tz``) of ``as_of`` minus ``days``, as an instant."""
    local_day = F.to_date(F.from_utc_timestamp(F.lit(as_of).cast("timestamp"), tz))
    return F.to_utc_timestamp(F.date_sub(local_day, days).cast("timestamp"), tz)


def dedupe_first(df: DataFrame, subset: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Keep one row per ``subset``: the first by ``order`` then by the
    remaining columns (a stated, input-order-free tie-break).

    ``min(struct(order…, rest…))`` per group is partially aggregated, so a
    group holding a third of the table is reduced map-side. A struct buffer
    makes Spark plan a sort aggregate (it sorts, and can spill, each side).
    """
    subset, order = list(subset), list(order)
    rest = [c for c in df.columns if c not in subset and c not in order]
    packed = F.struct(*[col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                      *[col(c).alias(c) for c in rest]).alias("_keep")
    if not order and not rest:
        return df.select(*subset).distinct()
    agg = df.groupBy(*[col(c) for c in subset]).agg(F.min(packed).alias("_keep"))
    outs = []
    for c in df.columns:
        if c in subset:
            outs.append(col(c))
        elif c in order:
            outs.append(F.col(f"_keep._o{order.index(c)}").alias(c))
        else:
            outs.append(F.col("_keep").getField(c).alias(c))
    return agg.select(*outs)


def drop_shared(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Drop *all* rows whose ``key`` occurs more than once; keep singletons.

    count + min per column in one partial aggregate: a key with millions of
    copies leaves one partial row per map task, never a whole group in memory.
    A kept key has a single row, so the columns' separate minima are that row;
    with fixed-width columns the plan is a hash aggregate (text columns make
    Spark plan a sort aggregate).
    """
    key = list(key)
    rest = [c for c in df.columns if c not in key]
    agg = (df.groupBy(*[col(c) for c in key])
             .agg(F.count(F.lit(1)).alias("_n"), *[F.min(col(c)).alias(c) for c in rest])
             .filter(F.col("_n") == 1))
    return agg.select(*[col(c) for c in df.columns])


def group_size(df: DataFrame, key: Sequence[str], out: str = "group_size") -> DataFrame:
    """Rows per key attached to every row: aggregate, then join back (AQE
    splits a skewed key on the big side; the count side has one row per key).
    Null keys form a group, as in a GROUP BY."""
    key = list(key)
    sizes = df.groupBy(*key).agg(F.count(F.lit(1)).alias(out))
    return join_null_safe(df, sizes, key, "left")


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[col(c) for c in columns])

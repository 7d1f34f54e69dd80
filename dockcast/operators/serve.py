"""Serving-table operators: freshness, stale-forecast detection, upsert and
insert-ignore as DataFrame plans, wide forecast view, rankings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockcast.functions.scalar import col, percent_text


def _ts_lit(as_of, like: DataFrame | None = None, column: str | None = None) -> Column:
    c = F.lit(as_of)
    if like is not None and column is not None:
        return c.cast(like.schema[column].dataType)
    return c.cast("timestamp")


def filter_fresh(df: DataFrame, ts: str, as_of, minutes: int = 5) -> DataFrame:
    """Rows stamped within the last ``minutes`` before ``as_of`` (exclusive).
    ``as_of`` is a parameter, never the wall clock."""
    return df.filter(F.col(ts) > _ts_lit(as_of, df, ts) - F.expr(f"INTERVAL {int(minutes)} MINUTES"))


def needs_refresh(df: DataFrame, ts: str, as_of, minutes: int = 5, out: str = "stale") -> DataFrame:
    """One row: is the newest stamp older than ``minutes`` before ``as_of``?
    (The original looked at the first row only; the max is what it meant.)"""
    newest = F.max(F.col(ts))
    return df.agg(F.coalesce(newest <= _ts_lit(as_of, df, ts) - F.expr(f"INTERVAL {int(minutes)} MINUTES"),
                             F.lit(True)).alias(out))


def stale_ids(requested: DataFrame, forecasts: DataFrame, id_col: str, ts: str, as_of, minutes: int = 5) -> DataFrame:
    """Requested ids without a fresh forecast (these need a new forecast)."""
    fresh = filter_fresh(forecasts, ts, as_of, minutes).select(id_col)
    return requested.select(id_col).distinct().join(fresh, id_col, "left_anti")


def one_per_key(df: DataFrame, key: Sequence[str], pick) -> DataFrame:
    """One row per key: ``pick`` (min or max) of the other columns as a struct,
    partially aggregated."""
    rest = [c for c in df.columns if c not in key]
    if not rest:
        return df.distinct()
    g = df.groupBy(*key).agg(pick(F.struct(*[F.col(c) for c in rest])).alias("_row"))
    return g.select(*[F.col(c) if c in key else F.col("_row").getField(c).alias(c) for c in df.columns])


def upsert(target: DataFrame, updates: DataFrame, key: Sequence[str]) -> DataFrame:
    """New table state: for each key the update row if there is one, else the
    target row (whole-row take by key, not a per-column coalesce).

    The target's keys are unique (a status table). Of updates that share a
    key one is taken: the greatest in the remaining columns, in their order.
    """
    key = list(key)
    updates = one_per_key(updates.select(*target.columns), key, F.max)
    cols = [c for c in target.columns if c not in key]
    t = target.select(*key, *[F.col(c).alias(f"_t_{c}") for c in cols], F.lit(True).alias("_t_hit"))
    u = updates.select(*key, *[F.col(c).alias(f"_u_{c}") for c in cols], F.lit(True).alias("_u_hit"))
    j = t.join(u, key, "full_outer")
    take_u = F.col("_u_hit").isNotNull()
    return j.select(*key, *[F.when(take_u, F.col(f"_u_{c}")).otherwise(F.col(f"_t_{c}")).alias(c) for c in cols])


def insert_ignore(target: DataFrame, incoming: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of ``incoming`` whose key is not yet in ``target`` (what an
    INSERT … ON CONFLICT DO NOTHING adds). Append these to the target. Of
    incoming rows that share a key one is added: the least in the remaining
    columns, in their order. Null keys conflict with nothing and all go in."""
    key = list(key)
    new = incoming.join(target.select(*key), key, "left_anti")
    # a row with a null key is a group of its own in the one aggregate
    any_null = F.greatest(*[F.col(k).isNull().cast("int") for k in key], F.lit(0)) == 1
    own = F.when(any_null, F.monotonically_increasing_id()).alias("_own")
    return one_per_key(new.select("*", own), [*key, "_own"], F.min).drop("_own")


def insert_ignore_state(target: DataFrame, incoming: DataFrame, key: Sequence[str]) -> DataFrame:
    """Table state after insert-ignore: target ∪ new rows."""
    return target.unionByName(insert_ignore(target, incoming, key))


def pivot_horizons(df: DataFrame, key: str, horizon: str, value: str, horizons: Sequence,
                   names: Sequence[str] | None = None, agg: str = "avg", digits: int | None = 6,
                   drop_incomplete: bool = False, latest_by: str | None = None) -> DataFrame:
    """Long (key, horizon, value) → wide (key, value per horizon).

    The horizon values are given, so the pivot is one partially aggregated
    ``groupBy(key)`` with a conditional aggregate per horizon (``pivot()``
    would first aggregate by (key, horizon): a second shuffle).
    ``drop_incomplete`` keeps only keys with every horizon (inner-join form).
    ``latest_by`` takes, per key and horizon, the value of the row with the
    greatest ``latest_by`` (e.g. the newest forecast run) instead of ``agg``.
    """
    names = list(names) if names else [str(h) for h in horizons]
    v, h = col(value), col(horizon)

    def one(hv):
        picked = F.when(h == F.lit(hv), v)
        if latest_by is not None:
            return F.max(F.when(h == F.lit(hv), F.struct(col(latest_by).alias("o"), v.alias("v"))))["v"]
        if agg == "first":
            return F.first(picked, ignorenulls=True)
        return getattr(F, agg)(picked)
    aggs = []
    for hv, n in zip(horizons, names):
        a = one(hv)
        aggs.append((F.round(a, digits) if digits is not None else a).alias(n))
    out = df.groupBy(key).agg(*aggs)
    return out.dropna(subset=names) if drop_incomplete else out


def unpivot_horizons(wide: DataFrame, key: str, columns: dict[str, object], horizon: str = "relative_ts",
                     value: str = "fill_rate") -> DataFrame:
    """Wide → long: one row per (key, horizon) from columns {name: horizon},
    in one pass (``unpivot``). Nulls are dropped, so unpivot(pivot(x)) = x."""
    names = list(columns)
    long = wide.select(key, *[col(n).alias(f"_h{i}") for i, n in enumerate(names)]).unpivot(
        [key], [f"_h{i}" for i in range(len(names))], "_name", value)
    kv = []
    for i, n in enumerate(names):
        kv += [F.lit(f"_h{i}"), F.lit(columns[n])]
    return (long.filter(F.col(value).isNotNull())
                .select(key, F.element_at(F.create_map(*kv), F.col("_name")).alias(horizon), value))


def avg_fill(a, b) -> Column:
    return (col(a) + col(b)) / F.lit(2.0)


def top_k(df: DataFrame, by: str | Column, k: int, tie: Sequence[str] = (), descending: bool = False) -> DataFrame:
    """k rows with the least (or greatest) ``by``; ties broken by ``tie``.
    Nulls sort last either way. Planned as TakeOrderedAndProject: each task
    keeps its own top k, the driver merges k × tasks rows."""
    c = col(by) if isinstance(by, str) else by
    first = c.desc_nulls_last() if descending else c.asc_nulls_last()
    return df.orderBy(first, *[F.col(t).asc() for t in tie]).limit(k)


def station_ranking(obs: DataFrame, key: str, value: Column, k: int = 10, out: str = "a",
                    descending: bool = False, digits: int = 6) -> DataFrame:
    """Mean of ``value`` per station, then the k lowest (shortage) or highest."""
    m = obs.groupBy(key).agg(F.round(F.avg(value), digits).alias(out))
    return top_k(m, out, k, tie=[key], descending=descending)


def display_view(df: DataFrame, columns: dict[str, str], percent: Sequence[str] = ()) -> DataFrame:
    """Select and rename for display; fractions shown as whole percents."""
    return df.select(*[(percent_text(src) if src in percent else col(src)).alias(dst)
                       for dst, src in columns.items()])


def decode_requests(df: DataFrame, body: str, keep: Sequence[str] = ()) -> DataFrame:
    """A text column of JSON requests → one row per requested station:
    ``keep``, service, station_id and problem. A body without a service, one
    that is no JSON object, or an unknown service gives one row with the
    problem and no station; the status service names no stations."""
    r = F.from_json(col(body), "service string, station_id array<bigint>, extended boolean")
    d = df.select(*keep, r.alias("_r"))
    service = F.col("_r.service")
    problem = F.when(service.isNull(), "missing service").when(~service.isin("fill_rate_forecast", "bike_station_status"), "unknown service") \
        .when((service == "fill_rate_forecast") & (F.coalesce(F.size("_r.station_id"), F.lit(0)) <= 0), "no stations")
    ids = F.when(problem.isNull() & (service == "fill_rate_forecast"), F.col("_r.station_id"))
    return d.select(*keep, service.alias("service"), F.explode_outer(ids).alias("station_id"), problem.alias("problem"))


def to_json_rows(df: DataFrame, out: str = "json") -> DataFrame:
    """Each row as one JSON object string (the response encoding)."""
    return df.select(F.to_json(F.struct(*[col(c) for c in df.columns])).alias(out))

"""Flagship query: the stations most short of bikes right now.

parquet snapshots → occupancy ratio → 30-minute lag and 120-minute rolling
mean per station (one window pass) → each station's latest snapshot → the
10 stations with the lowest rolling fill.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockcast.operators import serve, windows
from dockcast.plans import catalog


def latest_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Each key's last row by ``order``: ``max_by`` is partially aggregated,
    so a station with a third of all rows is reduced map-side."""
    rest = [c for c in df.columns if c != key]
    packed = F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")
    return df.groupBy(key).agg(packed).select(key, *[F.col(f"_r.{c}").alias(c) for c in rest])


def shortage_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = catalog.observations(spark, sf_dir)
    spec = windows.FrameSpec().lag("lag3", "pct", 3).rolling_mean("m120", "pct", 12)
    f = spec.apply(obs, catalog.KEY, catalog.ORDER)
    latest = latest_per_key(f.select("user_id", "ts", "event_id", "pct", "lag3", "m120"),
                            "user_id", ["ts", "event_id"])
    ranked = latest.select("user_id", F.round("pct", 6).alias("pct_full"), F.round("lag3", 6).alias("lag_30m"),
                           F.round("m120", 6).alias("avg_120m"))
    return serve.top_k(ranked, "avg_120m", 10, tie=["user_id"])


FLAGSHIP_SQL = (
    catalog._OBS +
    ", f as (select *, lag(pct,3) over w lag3, case when count(pct) over w12 = 12 then avg(pct) over w12 end m120 "
    "from obs window w as (partition by user_id order by ts, event_id), "
    "w12 as (partition by user_id order by ts, event_id rows between 11 preceding and current row)), "
    "l as (select *, row_number() over (partition by user_id order by ts desc, event_id desc) rn from f) "
    "select user_id, round(pct,6) pct_full, round(lag3,6) lag_30m, round(m120,6) avg_120m from l where rn=1 "
    "order by round(m120,6) nulls last, user_id limit 10"
)

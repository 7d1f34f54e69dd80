"""Joins: dimension lookups, weather-by-hour, nearest zone, anti/semi joins.

Dimension sides are broadcast only behind a checked row bound; beyond it the
planner's shuffle join (with AQE skew splitting) is used.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockcast.functions.scalar import col, euclid, hour_floor
from dockcast.operators.sequence import remember_persisted
from dockcast.session import broadcast_if_bounded

DIM_BROADCAST_ROWS = 1_000_000


def lookup_join(df: DataFrame, dim: DataFrame, on, how: str = "left",
                max_broadcast_rows: int = DIM_BROADCAST_ROWS) -> DataFrame:
    """Fact ⋈ dimension; the dimension is broadcast if its row count is
    checked to be at most ``max_broadcast_rows``."""
    return df.join(broadcast_if_bounded(dim, max_broadcast_rows), on, how)


def join_zone_names(obs: DataFrame, stations: DataFrame, zones: DataFrame, *,
                    obs_id: str = "station_id", station_id: str = "id", station_zone: str = "weather_zone_id",
                    zone_id: str = "id", zone_name: str = "name", out: str = "weather_zone") -> DataFrame:
    """snapshot → station (zone id) → zone name, both left joins."""
    st = stations.select(F.col(station_id).alias(obs_id), F.col(station_zone).alias("_zid"))
    zn = zones.select(F.col(zone_id).alias("_zid"), F.rtrim(F.col(zone_name)).alias(out))
    return lookup_join(lookup_join(obs, st, obs_id), zn, "_zid").drop("_zid")


def join_weather_hour(obs: DataFrame, weather: DataFrame, *, zone: str, ts: str,
                      weather_zone: str, weather_hour: str, columns: Sequence[str],
                      shift_hours: int = 0) -> DataFrame:
    """Attach the weather reading of the observation's hour (plus
    ``shift_hours``) in its zone: a left equi-join on (zone, hour).

    Weather is hourly per zone (zones × hours rows), orders of magnitude
    smaller than the snapshots; AQE broadcasts it when it is small enough.
    """
    key = hour_floor(ts)
    if shift_hours:
        key = key + F.expr(f"INTERVAL {int(shift_hours)} HOURS")
    o = obs.withColumn("_wx_h", key)
    w = weather.select(F.col(weather_zone).alias("_wx_z"), F.col(weather_hour).alias("_wx_h"),
                       *[col(c) for c in columns])
    return (o.join(w, (o[zone] == w["_wx_z"]) & (o["_wx_h"] == w["_wx_h"]), "left")
             .drop("_wx_z", "_wx_h"))


def _floor(c: Column) -> Column:
    """Floor as a double (``floor`` gives a long, which a far point overflows)."""
    return c - F.pmod(c, F.lit(1.0))


def _finite(c: str) -> Column:
    """The coordinate as a double; null unless it is a finite number."""
    v = F.col(c).cast("double")
    return F.when(F.abs(v) < F.lit(float("inf")), v)  # NaN sorts above infinity


def nearest_zone(points: DataFrame, zones: DataFrame, *, point_id: str, px: str, py: str,
                 zone_id: str, zx: str, zy: str, out: str = "zone",
                 max_literal_zones: int = 1_024, cell: float | None = None) -> DataFrame:
    """For each point row, the zone at the least Euclidean distance; ties go to
    the smallest zone id. Ids keep their types; repeated points stay repeated;
    a point without finite coordinates gets null, a zone without them is never
    chosen.

    Zones are a small dimension. When a bounded job proves there are at most
    ``max_literal_zones`` of them, they are inlined as a literal array (like a
    literal lookup map) and each point folds over it with ``aggregate``,
    keeping the least (distance, zone id): a projection, no join. Above the
    bound the exact grid search ``nearest_zone_grid`` runs on equi-joins, over
    distinct coordinates, with the same result.
    """
    z = zones.select(F.col(zone_id).alias("_z_id"), _finite(zx).alias("_z_x"), _finite(zy).alias("_z_y")) \
        .filter("_z_x is not null and _z_y is not null and _z_id is not null").distinct()
    p = points.select(F.col(point_id), _finite(px).alias("_p_x"), _finite(py).alias("_p_y"))
    small = z.limit(max_literal_zones + 1).collect()  # bounded: ≤ max_literal_zones + 1 rows
    id_type = z.schema["_z_id"].dataType
    if not small:
        return p.select(point_id, F.lit(None).cast(id_type).alias(out))
    if len(small) > max_literal_zones:
        at = p.filter("_p_x is not null and _p_y is not null").select("_p_x", "_p_y").distinct()
        return p.join(nearest_zone_grid(at, z, out=out, cell=cell), ["_p_x", "_p_y"], "left").select(point_id, out)
    arr = F.array(*[F.struct(F.lit(r["_z_id"]).cast(id_type).alias("id"), F.lit(r["_z_x"]).cast("double").alias("x"),
                             F.lit(r["_z_y"]).cast("double").alias("y")) for r in small])
    start = F.struct(F.lit(None).cast("double").alias("d"), F.lit(None).cast(id_type).alias("z"))

    def step(acc, zz):
        d = F.sqrt(F.pow(F.col("_p_x") - zz["x"], 2) + F.pow(F.col("_p_y") - zz["y"], 2))
        cand = F.struct(d.alias("d"), zz["id"].alias("z"))
        better = acc["d"].isNull() | (d < acc["d"]) | ((d == acc["d"]) & (zz["id"] < acc["z"]))
        return F.when(d.isNotNull() & better, cand).otherwise(acc)
    return p.select(point_id, F.aggregate(arr, start, step)["z"].alias(out))


def nearest_zone_grid(at: DataFrame, zones: DataFrame, *, out: str = "zone", cell: float | None = None) -> DataFrame:
    """Exact nearest zone of distinct finite coordinates (_p_x, _p_y) among
    many zones (_z_id, _z_x, _z_y).

    Level l lays a square grid of cell·2^l. A point's own and its eight
    neighbouring cells hold every zone within one cell's width, so a point
    whose best distance is at most that is settled; the others go on to a
    coarser grid. Each level is one equi-join with nine copies of the zone
    table. Points far outside the zones' box skip the levels that cannot
    reach it.
    """
    box = zones.agg(F.min("_z_x").alias("x0"), F.max("_z_x").alias("x1"), F.min("_z_y").alias("y0"), F.max("_z_y").alias("y1"),
                    F.count(F.lit(1)).alias("n")).first()
    if cell is None:
        cell = max(((box["x1"] - box["x0"]) * (box["y1"] - box["y0"]) / max(int(box["n"]), 1)) ** 0.5, 1e-9)
    away = F.greatest(F.lit(box["x0"]) - F.col("_p_x"), F.col("_p_x") - F.lit(box["x1"]),
                      F.lit(box["y0"]) - F.col("_p_y"), F.col("_p_y") - F.lit(box["y1"]), F.lit(0.0))
    around = F.explode(F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx in (-1, 0, 1) for dy in (-1, 0, 1)]))
    pending, settled, level = at, None, 0
    while True:  # no level cap: every point is settled exactly
        size = cell * 2.0 ** level
        # whole-numbered doubles: a far point's cell has no integer overflow
        ring = (zones.withColumn("_o", around)
                     .select("_z_id", "_z_x", "_z_y", (_floor(F.col("_z_x") / size) + F.col("_o.dx")).alias("_c_x"),
                             (_floor(F.col("_z_y") / size) + F.col("_o.dy")).alias("_c_y")))
        here = pending.withColumn("_c_x", _floor(F.col("_p_x") / size)).withColumn("_c_y", _floor(F.col("_p_y") / size))
        best = (here.join(ring, ["_c_x", "_c_y"], "left")
                    .withColumn("_c", F.when(F.col("_z_id").isNotNull(), F.struct(
                        euclid("_p_x", "_p_y", "_z_x", "_z_y").alias("d"), F.col("_z_id").alias("z"))))
                    .groupBy("_p_x", "_p_y").agg(F.min("_c").alias("_b")))
        best = remember_persisted(best.persist())  # released by sequence.release_cached()
        done = F.col("_b").isNotNull() & (F.col("_b.d") <= F.lit(size))
        part = best.filter(done).select("_p_x", "_p_y", F.col("_b.z").alias(out))
        settled = part if settled is None else settled.unionByName(part)
        pending = best.filter(~F.coalesce(done, F.lit(False))).select("_p_x", "_p_y")
        left = pending.agg(F.count(F.lit(1)).alias("n"), F.min(away).alias("away")).first()
        if not left["n"]:
            return settled
        level += 1
        if left["away"] > cell:
            level = max(level, math.floor(math.log2(left["away"] / cell)))


def anti_join(df: DataFrame, other: DataFrame, on) -> DataFrame:
    """Rows of ``df`` with no match in ``other`` (NOT EXISTS)."""
    return df.join(other, on, "left_anti")


def not_in(df: DataFrame, column: str, other: DataFrame, other_column: str) -> DataFrame:
    """Rows whose ``column`` is none of the listed values (a negated ``isin``):
    nulls in the list are no values, and a row with a null ``column`` stays."""
    o = other.select(F.col(other_column).alias("_ni")).filter(F.col("_ni").isNotNull()).distinct()
    return df.join(o, F.col(column) == F.col("_ni"), "left_anti")


def filter_ids(df: DataFrame, column: str, ids) -> DataFrame:
    """Keep requested ids: ``isin`` for a short literal list, semi join for
    a DataFrame of ids."""
    if isinstance(ids, DataFrame):
        k = ids.columns[0]
        return df.join(ids.select(F.col(k).alias(column)).distinct(), column, "left_semi")
    return df.filter(F.col(column).isin(list(ids)))


def validate_ids(requested: DataFrame, known: DataFrame, column: str) -> DataFrame:
    """Requested ids that are unknown (empty result = request is valid)."""
    return requested.select(column).distinct().join(known.select(column), column, "left_anti")

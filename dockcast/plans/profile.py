"""Profiling a snapshot layer: the exploratory checks as one set of Spark
aggregates (sum identities, key uniqueness, nulls, categorical counts,
open-share per group, distribution of the fill level, shared positions)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockcast import schemas
from dockcast.functions.scalar import occupancy_ratio
from dockcast.operators import aggregates as agg


def snapshot_profile(raw: DataFrame) -> dict[str, DataFrame]:
    """Named result frames for a raw snapshot layer (RAW_SNAPSHOT columns)."""
    out = {
        # docks: space = full + empty; bikes: full = both bike kinds
        "space_identity": agg.check_sums(raw, F.col("space") == F.col("full") + F.col("empty"), "bad", "n"),
        "bike_identity": agg.check_sums(raw, F.col("full") == F.col("bike_yb2") + F.col("bike_eyb"), "bad", "n"),
        # rows per (snapshot, station): more than one means duplicated pulls
        "key_uniqueness": agg.key_uniqueness(raw, ["extraction_ts", "id"], "n", "groups"),
        "nulls": agg.null_profile(raw, [f.name for f in schemas.RAW_SNAPSHOT.fields]),
        "types": agg.value_counts(raw, "type", "n"),
        "cities": agg.value_counts(raw, "city", "n"),
        "bad_space_by_open": agg.ratio_by_group(raw, "is_open",
                                                F.col("space") != F.col("full") + F.col("empty"), "r"),
        "fill_level": agg.describe(raw.withColumn("pct_full", occupancy_ratio("full", "empty")), "pct_full"),
        # stations sharing a position inside one snapshot
        "shared_positions": (raw.groupBy("lat", "lng", "extraction_ts").agg(F.count(F.lit(1)).alias("n"))
                                .filter(F.col("n") > 1).groupBy().agg(F.count(F.lit(1)).alias("positions"),
                                                                      F.sum("n").alias("rows"))),
    }
    return out

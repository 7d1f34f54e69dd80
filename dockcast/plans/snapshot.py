"""Snapshot ingestion: raw snapshot rows → clean layer, and re-processing a
time range of the raw layer."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockcast import schemas
from dockcast.functions import fixed_values as fv
from dockcast.functions.scalar import map_default
from dockcast.operators import clean
from dockcast.session import cut_lineage
from dockcast.sources import readers, sinks

# tie-break for exact duplicates: lowest name, then the remaining columns
DEDUPE_ORDER = ["name"]


def row_cutoff(ts: str = "extraction_ts", days: int = fv.STALE_DAYS, tz: str = fv.LOCAL_TZ) -> Column:
    """Per-row staleness cut-off: local midnight of the row's own extraction
    day minus ``days`` (used when re-processing old snapshots)."""
    local_day = F.to_date(F.from_utc_timestamp(F.col(ts).cast("timestamp"), tz))
    return F.to_utc_timestamp(F.date_sub(local_day, days).cast("timestamp"), tz)


def clean_snapshot(df: DataFrame, *, as_of=None, cutoff: Column | None = None,
                   city_names: Mapping[str, str] = fv.CITY_NAMES,
                   area_names: Mapping[str, str] = fv.AREA_NAMES, check: bool = True) -> DataFrame:
    """Raw snapshot rows → clean rows.

    schema check → validity rules → exact-duplicate removal (13-column
    subset, one kept) → rows sharing a position in one snapshot all dropped
    → city/area romanised (unknown → "N/A") → 13 clean columns → check.

    ``as_of`` fixes the staleness cut-off (local midnight of as_of − 8 days);
    without it each row is judged against its own extraction day.
    """
    if check:
        schemas.check_schema(df, schemas.RAW_SNAPSHOT)
    if cutoff is None:
        cutoff = clean.staleness_cutoff(as_of, fv.STALE_DAYS, fv.LOCAL_TZ) if as_of is not None else row_cutoff()
    valid = clean.filter_valid(df, schemas.REQUIRED_RAW, clean.station_rules(cutoff))
    deduped = clean.dedupe_first(valid, schemas.DUPLICATE_SUBSET, DEDUPE_ORDER)
    single = clean.drop_shared(deduped, ["lat", "lng", "extraction_ts"])
    named = (single.withColumn("city", map_default("city", city_names))
                   .withColumn("area", map_default("area", area_names)))
    out = named.select(*[f.name for f in schemas.CLEAN_SNAPSHOT.fields])
    if check:
        schemas.check_schema(out, schemas.CLEAN_SNAPSHOT)
    return out


def ingest_snapshot(spark: SparkSession, raw_df: DataFrame, raw_path: str, clean_path: str, *, as_of=None) -> None:
    """One scheduled pull: persist raw rows, clean them, append to the clean
    layer (both partitioned by extraction date)."""
    sinks.write_layer(raw_df, raw_path)
    sinks.write_layer(clean_snapshot(raw_df, as_of=as_of), clean_path)


def reprocess_range(spark: SparkSession, raw_path: str, clean_path: str, oldest, newest) -> DataFrame:
    """Re-clean every raw snapshot with oldest < extraction_ts ≤ newest and
    replace those rows of the clean layer. Whole dates are overwritten, so the
    clean rows of the first and last date outside the range are written back
    with them; dates of the range that have no clean row any more are removed. Staleness is judged per row against its own extraction day."""
    raw = readers.read_snapshots(spark, raw_path)
    cleaned = reclean(raw, oldest, newest)
    state = cleaned
    if sinks.exists(spark, clean_path):
        state = cleaned.unionByName(untouched(readers.read_snapshots(spark, clean_path), oldest, newest).select(*cleaned.columns))
    state = cut_lineage(state)  # written out before the dates it was read from are replaced
    sinks.write_layer(state, clean_path, mode="overwrite")
    kind = cleaned.schema["extraction_ts"].dataType
    first, last = spark.range(1).select(*[readers.local_date(F.lit(x).cast(kind), kind) for x in (oldest, newest)]).first()
    sinks.drop_dates(spark, clean_path, first, last, keep=state)
    return cleaned


def reclean(raw: DataFrame, oldest, newest) -> DataFrame:
    """Clean rows of the raw snapshots with oldest < extraction_ts ≤ newest."""
    return clean_snapshot(readers.scan_time_range(raw, "extraction_ts", oldest, newest, inclusive="right").drop(readers.DATE_PART))


def untouched(layer: DataFrame, oldest, newest, ts: str = "extraction_ts") -> DataFrame:
    """Rows of a layer outside (oldest, newest], on the dates that range touches."""
    kind = layer.schema[ts].dataType
    lo, hi = (F.lit(x).cast(kind) for x in (oldest, newest))
    d = layer if readers.DATE_PART in layer.columns else readers.with_date(layer, ts)
    return d.filter((F.col(readers.DATE_PART) >= readers.local_date(lo, kind)) & (F.col(readers.DATE_PART) <= readers.local_date(hi, kind))
                    & ((F.col(ts) <= lo) | (F.col(ts) > hi))).select(*layer.columns)


def new_stations(snapshot: DataFrame, stations: DataFrame, zones: DataFrame, *, created_at) -> DataFrame:
    """Stations in the snapshot that the station table lacks, with their
    nearest weather zone id and a creation time (rows to insert). Of several
    rows of one id the least by name, then by the other columns, is taken."""
    from dockcast.operators.joins import anti_join, nearest_zone
    latest = clean.dedupe_first(snapshot.select("id", "lat", "lng", "city", "name", "area"), ["id"], DEDUPE_ORDER)
    fresh = anti_join(latest, stations.select("id"), "id")
    z = zones.select(F.col("id").alias("zone_id"), "lat", "lng")
    near = nearest_zone(fresh, z, point_id="id", px="lat", py="lng", zone_id="zone_id", zx="lat", zy="lng",
                        out="weather_zone_id")
    return (fresh.join(near, "id", "left")
                 .withColumn("created_at", F.lit(created_at).cast("timestamp")))

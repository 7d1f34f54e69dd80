"""Readers and scans: snapshot CSV/parquet layers, weather, dimensions,
time-range scans with partition pruning, latest-file scans, and the hourly
landing-array explode."""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockcast import schemas
from dockcast.functions import fixed_values as fv
from dockcast.functions.scalar import col, epoch_seconds_to_ts
from dockcast.operators import sequence as sq

DATE_PART = "extraction_date"


def read_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """One parquet table of a data directory (``{dir}/{name}.parquet``)."""
    return spark.read.parquet(f"{base_dir.rstrip('/')}/{name}.parquet")


MAX_HEADERS = 1000
MAX_BROADCAST_FILES = 200_000


def _csv_text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"))


def _bare(line: str) -> Column:
    """A line without a byte-order mark."""
    return F.when(F.col(line).startswith("\ufeff"), F.expr(f"substring({line}, 2)")).otherwise(F.col(line))


def csv_headers(text: DataFrame) -> DataFrame:
    """file, header: the first line of each file. Its place is the least row
    number in the first block of the file, a hash aggregate over numbers; the
    line is then taken from its place (one number per file is broadcast), so no
    texts are sorted or moved. Both scans are of one frame, whose files and
    splits, and so its row numbers, are the same."""
    rows = text.filter(F.col("block") == 0).select("file", "line", F.monotonically_increasing_id().alias("row"))
    places = rows.groupBy("file").agg(F.min("row").alias("row"))
    return rows.join(F.broadcast(places.select("row")), "row").select("file", _bare("line").alias("header"))


def csv_lines(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    """file, header, line: every data line of a file or folder of CSV files
    beside its own file's header (the file's first line). Blank lines and
    repeats of the header are left out. With it, the different headers. Lines
    are not moved to their headers, these go to the lines (up to
    MAX_BROADCAST_FILES files)."""
    text = _csv_text(spark, path)
    headers = csv_headers(text)
    found = headers.groupBy("header").agg(F.count(F.lit(1)).alias("n")).limit(MAX_HEADERS + 1).collect()
    heads = [r["header"] for r in found]
    few = len(heads) <= MAX_HEADERS and sum(r["n"] for r in found) <= MAX_BROADCAST_FILES
    lines = text.join(F.broadcast(headers) if few else headers, "file").filter((F.trim("line") != "") & (_bare("line") != F.col("header"))).select("file", "header", "line")
    if len(heads) > MAX_HEADERS:  # those of files without data lines don't count
        heads = [r[0] for r in lines.select("header").distinct().limit(MAX_HEADERS + 1).collect()]
    if len(heads) > MAX_HEADERS:
        raise ValueError(f"{path} has more than {MAX_HEADERS} different headers: not one feed")
    return lines, heads


def _csv_columns(header: str) -> list[str]:
    """Column names of a header; of names that repeat, the first counts."""
    names = [c.strip().strip('"').strip() for c in header.split(",")]
    return [n if n and n not in names[:i] else f"_unused_{i}" for i, n in enumerate(names)]


def _of_feed(known: Collection[str]) -> Callable[[Column], Column]:
    """bad, row: from a parsed line, as a lambda that names it, so that the line
    is parsed once however many columns are taken of it."""
    return lambda got: F.struct(
        got.getField("_corrupt").isNotNull().alias("bad"),
        F.struct(*[(got.getField(f.name) if f.name in known else F.lit(None).cast(f.dataType)).alias(f.name) for f in schemas.STATION_CSV.fields]).alias("row"))


def _parse_lines(lines: DataFrame, heads: list[str]) -> DataFrame:
    """The frame of :func:`parse_snapshot_csv` from those of :func:`csv_lines`."""
    fields = schemas.STATION_CSV.fields
    parsed = F.lit(None)
    for h in heads:  # one expression per header, not per file
        names = _csv_columns(h)
        known = {f.name: f for f in fields if f.name in names}
        kind = T.StructType([known.get(n, T.StructField(n, T.StringType())) for n in names] + [T.StructField("_corrupt", T.StringType())])
        got = F.from_csv("line", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kind.fields), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
        parsed = F.when(F.col("header") == h, F.transform(F.array(got), _of_feed(known))[0]).otherwise(parsed)
    if not heads:
        parsed = F.struct(F.lit(False).alias("bad"), F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields]).alias("row"))
    return lines.select("file", "line", "header", parsed.alias("_p")).select("file", "line", "header", F.col("_p.bad").alias("bad"), F.col("_p.row").alias("row"))


def parse_snapshot_csv(spark: SparkSession, path: str) -> DataFrame:
    """file, line, bad, row: each line read under its own file's header into
    the feed's columns. Columns are matched by name, so files may order them
    differently, lack some (null) or bring others (ignored). ``bad`` marks lines
    with too few or too many fields, or with a value that is not of its
    column's type; such a value is null in ``row``."""
    return _parse_lines(*csv_lines(spark, path))


def read_snapshot_csv(spark: SparkSession, path: str, pulled_at=None) -> DataFrame:
    """Station CSV as pulled (explicit schema, no inference), normalised:
    ``updated_at`` epoch s → ``last_update_ts``. ``path`` may be a folder whose
    files have different headers (:func:`parse_snapshot_csv`). The feed carries
    no pull time: ``pulled_at`` (an instant) stamps every row that has none of
    its own; without it every file must have an ``extraction_ts`` column."""
    lines, heads = csv_lines(spark, path)
    timeless = [h for h in heads if "extraction_ts" not in [c.replace('"', "").strip(" ") for c in h.split(",")]]
    if pulled_at is None and timeless:  # else no line has to be read for it
        lacks = lines.filter(F.col("header").isin(timeless)).select("file").first()
        if lacks is not None:
            raise ValueError(f"{lacks['file']} has no extraction_ts column: pass pulled_at, the time of the pull")
    df = _parse_lines(lines, heads).select("row.*")
    if pulled_at is None:
        return normalize_snapshot_ts(df)
    stamp = F.lit(pulled_at).cast("timestamp")
    return normalize_snapshot_ts(df, F.coalesce(F.col("extraction_ts"), stamp))


def snapshot_csv_rejects(spark: SparkSession, path: str) -> DataFrame:
    """file, line: the lines of a feed that don't read as its header says."""
    return parse_snapshot_csv(spark, path).filter("bad").select("file", "line")


def normalize_snapshot_ts(df: DataFrame, extraction_ts: Column | None = None) -> DataFrame:
    """epoch seconds → timestamp, pull time truncated to the second,
    ``updated_at`` dropped."""
    out = df.withColumn("last_update_ts", epoch_seconds_to_ts("updated_at"))
    if extraction_ts is not None:
        out = out.withColumn("extraction_ts", F.date_trunc("second", extraction_ts))
    elif "extraction_ts" in df.columns:
        out = out.withColumn("extraction_ts", F.date_trunc("second", F.col("extraction_ts")))
    return out.drop("updated_at")


def read_snapshots(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """A raw or clean snapshot layer (partitioned by extraction_date).
    Explicit schema; files missing a column read it as null."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    """Hourly weather table; a ``datetime`` stored as long nanoseconds (as
    pandas writes it) is normalised to a timestamp."""
    df = spark.read.parquet(path)
    if df.schema["datetime"].dataType.simpleString() in ("bigint", "long"):
        df = df.withColumn("datetime", F.timestamp_micros(F.floor(F.col("datetime") / 1000).cast("long")))
    return df


def read_weather_csv(spark: SparkSession, path: str, tz: str = "Asia/Taipei") -> DataFrame:
    """Older weather history in CSV: one row per (datetime, lat, lng),
    timestamps converted from ``tz`` wall clock to instants."""
    df = spark.read.schema(schemas.WEATHER_CSV).option("header", True).csv(path)
    df = df.withColumn("datetime", F.to_utc_timestamp(F.try_to_timestamp(F.col("datetime")), tz))
    from dockcast.operators.clean import dedupe_first
    return dedupe_first(df, ["datetime", "lat", "lng"], [c for c in df.columns if c not in ("datetime", "lat", "lng")])


def local_date(ts: str | Column, kind: T.DataType) -> Column:
    """Partition day of a time of type ``kind``: an instant's day in
    ``LOCAL_TZ``, whatever the session's zone; a wall-clock time's own day."""
    if isinstance(kind, T.TimestampNTZType):
        return F.to_date(col(ts))
    utc = F.timestamp_add("MICROSECOND", F.unix_micros(col(ts)), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(fv.LOCAL_TZ), utc))


def with_date(df: DataFrame, ts: str) -> DataFrame:
    """``df`` with the partition column of its ``ts``."""
    return df.withColumn(DATE_PART, local_date(ts, df.schema[ts].dataType))


def scan_time_range(df: DataFrame, ts: str, oldest, newest, *, inclusive: str = "left") -> DataFrame:
    """Rows with oldest ≤ ts < newest (``inclusive='left'``) or
    oldest < ts ≤ newest (``'right'``, the rerun convention).

    When the layer is partitioned by ``extraction_date``, the matching date
    predicate is added too, so the scan prunes whole partitions (Catalyst
    does not derive it from the timestamp predicate by itself).
    """
    t = F.col(ts)
    lo = F.lit(oldest).cast(df.schema[ts].dataType)
    hi = F.lit(newest).cast(df.schema[ts].dataType)
    cond = (t >= lo) & (t < hi) if inclusive == "left" else (t > lo) & (t <= hi)
    if DATE_PART in df.columns:
        kind = df.schema[ts].dataType
        cond = cond & (F.col(DATE_PART) >= local_date(lo, kind)) & (F.col(DATE_PART) <= local_date(hi, kind))
    return df.filter(cond)


def scan_latest_file(df: DataFrame) -> DataFrame:
    """Rows of the newest landed file (the greatest file path, as run
    timestamps are in the names) among those that ``df``, a frame read from
    files, has rows of. Filters and columns of ``df`` stay as they are. The
    name comes from a scan of no columns but those that ``df`` filters by; the
    rows are filtered by path, and by partition date if ``df`` has it, so
    other files aren't read."""
    path = F.col("_metadata.file_path")
    date = F.col(DATE_PART) if DATE_PART in df.columns else F.lit(None)
    newest, day = df.agg(F.max(path), F.max_by(date, path)).first()
    if newest is None:
        return df.limit(0)
    latest = df.filter(path == newest)
    return latest if day is None else latest.filter(F.col(DATE_PART) == F.lit(day))


def run_ts_from_path(pattern: str = r"(\d{4}-\d{2}-\d{2}_\d{2}:\d{2}:\d{2})") -> Column:
    """Run timestamp parsed out of the source file name."""
    from dockcast.functions.fixed_values import FILE_TS_FORMAT
    return F.try_to_timestamp(F.regexp_extract(F.col("_metadata.file_path"), pattern, 1), F.lit(FILE_TS_FORMAT))


def hourly_landing(df: DataFrame, key: str, order: Sequence[str], value: str, *, start: str,
                   chunk_hours: int = 24 * 7, cfg: sq.SkewConfig | None = None) -> DataFrame:
    """Build landing rows in the weather-response layout from a table: per
    key, consecutive values as hourly arrays beginning at ``start``.
    Arrays are cut every ``chunk_hours`` positions so no group is unbounded.
    Columns: key, start (timestamp), end, interval (s), <value> array."""
    p = sq.position(df, key, list(order), out="_pos", cfg=cfg)
    p = p.withColumn("_chunk", F.floor((F.col("_pos") - 1) / F.lit(chunk_hours)).cast("long"))
    base = F.lit(start).cast(df.schema[order[0]].dataType)
    g = (p.groupBy(key, "_chunk")
          .agg(F.array_sort(F.collect_list(F.struct(F.col("_pos").alias("p"), F.col(value).alias("v")))).alias("_a")))
    return g.select(key,
                    (base + F.make_dt_interval(hours=(F.col("_chunk") * chunk_hours).cast("int"))).alias("start"),
                    (base + F.make_dt_interval(hours=(F.col("_chunk") * chunk_hours + F.size("_a")).cast("int"))).alias("end"),
                    F.lit(3600).alias("interval"),
                    F.transform("_a", lambda s: s["v"]).alias(value))


def explode_hourly(landing: DataFrame, keep: Sequence[str], arrays: Sequence[str],
                   start: str = "start", interval: str = "interval", out: str = "datetime", end: str = "end") -> DataFrame:
    """Parallel hourly arrays + start/interval → one row per hour: the i-th
    elements with time start + i·interval, in the half-open range [start, end):
    elements at or beyond ``end`` are dropped (null end: none are)."""
    z = F.arrays_zip(*[F.col(a) for a in arrays])
    ends = [end] if end in landing.columns else []
    e = landing.select(*keep, start, interval, *ends, F.posexplode(z).alias("_i", "_z"))
    secs = (F.col("_i").cast("long") * F.col(interval).cast("long")).cast("decimal(18,6)")
    e = e.withColumn("_at", F.col(start) + F.make_dt_interval(secs=secs))
    if ends:
        e = e.filter(F.col(end).isNull() | (F.col("_at") < F.col(end)))
    return e.select(*keep, F.col("_at").alias(out), *[F.col("_z").getField(a).alias(a) for a in arrays])


def landing_from_epoch(df: DataFrame) -> DataFrame:
    """Weather landing rows carry start/end as epoch seconds."""
    return df.withColumn("start", F.timestamp_seconds("start")).withColumn("end", F.timestamp_seconds("end"))


def read_dims(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A dimension table (stations, zones) from parquet; JDBC sources use
    ``spark.read.jdbc`` with the same schema."""
    return spark.read.parquet(f"{path.rstrip('/')}/{name}")


def missing_keys(source: DataFrame, target: DataFrame, key: str, limit: int | None = None) -> DataFrame:
    """Keys present in ``source`` but not in ``target``, newest first,
    optionally the first ``limit`` (what a sync copies next)."""
    out = source.select(key).distinct().join(target.select(key), key, "left_anti").orderBy(F.col(key).desc())
    return out.limit(limit) if limit else out

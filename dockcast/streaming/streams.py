"""Structured Streaming forms of the scheduled flows.

* ``stream_clean``: new raw snapshot files → clean layer, per micro-batch.
* ``stream_status``: latest status per station as streaming state, its
  changes logged per batch.
* ``stream_staleness``: the 8-day cut-off as a watermark, with duplicate
  rows dropped within it.
* ``stream_occupancy_window``: 120-minute sliding mean per station.
* ``stream_clean_watermarked``: snapshots split over micro-batches.
* ``stream_forecasts``: the forecast service driven by status batches.

Each streaming query uses the same DataFrame functions as its batch twin.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from dockcast.functions.scalar import col


def as_event_time(df: DataFrame, ts: str) -> DataFrame:
    """Watermarks need TIMESTAMP (instant); wall-clock NTZ inputs are read
    as instants in the session time zone."""
    if df.schema[ts].dataType.simpleString() == "timestamp_ntz":
        return df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df


def occupancy_windows(df: DataFrame, key: str, ts: str, value: str, *, length: str = "120 minutes",
                      slide: str = "10 minutes", out_window: str = "w", out_value: str = "v") -> DataFrame:
    """Mean of ``value`` per key over sliding windows (batch or stream):
    each row counts in every window [start, start+length) containing it,
    starts aligned to ``slide``. ``length`` must be a multiple of ``slide``: rows
    are first summed per key and pane of ``slide``, and only the panes are
    copied into the windows that hold them."""
    pane = F.window(col(ts), slide)
    panes = (df.groupBy(col(key), pane.alias("_p"))
               .agg(F.sum(col(value).cast("double")).alias("_s"), F.count(col(value)).alias("_n")))
    return (panes.groupBy(col(key), F.window(F.col("_p.start"), length, slide).alias("_w"))
                 .agg((F.sum("_s") / F.nullif(F.sum("_n"), F.lit(0))).alias(out_value))
                 .select(key, F.col("_w.start").alias(out_window), out_value))


def stream_occupancy_window(stream: DataFrame, key: str, ts: str, value: str, *, delay: str = "8 days",
                            length: str = "120 minutes", slide: str = "10 minutes", append: bool = False) -> DataFrame:
    """Streaming twin: watermark on event time, windows emitted (append
    mode) once the watermark passes their end. With ``append``, for append mode
    only, the state holds sums per pane of ``slide`` instead of per window
    (:func:`closed_windows`): as many times less as a window has panes."""
    if append:
        return closed_windows(stream, key, ts, value, delay=delay, length=length, slide=slide)
    s = as_event_time(stream, ts).withWatermark(ts, delay)
    return (s.groupBy(col(key), F.window(col(ts), length, slide).alias("_w"))
             .agg(F.avg(col(value)).alias("v"))
             .select(key, F.col("_w.start").alias("w"), F.col("_w.end").alias("w_end"), "v"))


STATE_BUCKETS = 1024  # fixed: the state of a checkpoint is kept by bucket


def _micros(spark: SparkSession, *intervals: str) -> list[int]:
    zero = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
    return list(spark.sql("SELECT " + ", ".join(f"timestampdiff(MICROSECOND, {zero}, {zero} + INTERVAL '{i}')" for i in intervals)).first())


def closed_windows(stream: DataFrame, key: str, ts: str, value: str, *, delay: str = "8 days",
                   length: str = "120 minutes", slide: str = "10 minutes") -> DataFrame:
    """key, w, w_end, v (double): the sliding means that the watermark has
    closed, for append mode. ``length`` must be a multiple of ``slide``.

    The state is one table of (key, pane, sum, count) for each of STATE_BUCKETS
    hash buckets of the keys. A batch first emits the windows that its
    watermark has newly passed, then adds its rows: a row counts in the
    windows that are still open at the watermark of its batch. A pane goes when its last
    window is closed. Spark itself drops a late row only if none of its windows
    is open, so the watermark it keeps lies ``length`` further back; a bucket
    whose next window closes is called by its event-time timeout."""
    from pyspark.sql.streaming.state import GroupStateTimeout
    wait, long, step = _micros(stream.sparkSession, delay, length, slide)
    if step <= 0 or long % step or step % 1000:
        raise ValueError(f"{length} must be a multiple of {slide}, both in whole milliseconds")
    s = as_event_time(stream, ts)
    kind = s.schema[key].dataType
    plain = "long" if kind.typeName() in ("byte", "short", "integer", "long") else "string"
    number, micros = col(value).cast("double"), F.unix_micros(col(ts))
    rows = s.filter(col(ts).isNotNull()).withWatermark(ts, f"{(wait + long) // 1000} milliseconds").select(
        F.when(col(key).isNull(), -1).otherwise(F.pmod(F.xxhash64(col(key)), F.lit(STATE_BUCKETS))).cast("int").alias("_b"), col(ts).alias("_ts"),
        F.coalesce(col(key).cast(plain), F.lit(0 if plain == "long" else "")).alias("_k"),
        F.floor((micros - F.pmod(micros, F.lit(step))) / step).cast("long").alias("_p"),
        F.coalesce(number, F.lit(0.0)).alias("_s"), number.isNotNull().cast("long").alias("_n"))
    found = rows.groupBy("_b").applyInPandasWithState(
        _pane_state(plain, long // step, step // 1000), f"_b int, _k {plain}, _w long, _s double, _n long", "done long, panes binary", "append", GroupStateTimeout.EventTimeTimeout)
    return found.select(F.when(F.col("_b") >= 0, F.col("_k")).cast(kind).alias(key),
                        F.timestamp_micros(F.col("_w") * step).alias("w"), F.timestamp_micros(F.col("_w") * step + long).alias("w_end"),
                        (F.col("_s") / F.nullif(F.col("_n"), F.lit(0).cast("long"))).alias("v"))


def _pane_state(plain: str, panes: int, step_ms: int):
    """The function of a bucket (:func:`closed_windows`): times are counted in
    steps of the windows, a window of start w closes at w + ``panes``. It holds
    all it needs, so it runs where the package is not installed."""
    at_once = 100_000

    def combined(tables):
        import pyarrow as pa
        t = pa.concat_tables(tables).group_by(["_k", "_p"]).aggregate([("_s", "sum"), ("_n", "sum")])
        return t.select(["_k", "_p", "_s_sum", "_n_sum"]).rename_columns(["_k", "_p", "_s", "_n"])

    def windows(t, done: int, now: int):
        """Frames of the windows that close after ``done`` and up to ``now``; ``t`` is sorted."""
        import numpy as np
        import pandas as pd
        codes = t["_k"].combine_chunks().dictionary_encode()
        keys, code = codes.dictionary, codes.indices.to_numpy(zero_copy_only=False).astype("int64")
        p, s, n = (t[c].to_numpy() for c in ("_p", "_s", "_n"))
        new = np.flatnonzero(np.diff(code)) + 1  # a part ends where a key does
        near = np.searchsorted(new, np.arange(at_once, len(code), at_once))
        cuts = [0, *np.unique(new[near[near < len(new)]]), len(code)]
        for a, b in zip(cuts, cuts[1:]):
            w = np.concatenate([p[a:b] - j for j in range(panes)])
            i = np.tile(np.arange(a, b), panes)
            closes = (w + panes > done) & (w + panes <= now)
            w, i = w[closes], i[closes]
            if not len(w):
                continue
            low = w.min()
            place = code[i] * (w.max() - low + 1) + (w - low)
            order = np.argsort(place, kind="stable")
            place, w, i = place[order], w[order], i[order]
            first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
            yield pd.DataFrame({"_k": keys.take(code[i[first]]).to_pandas(), "_w": w[first], "_s": np.add.reduceat(s[i], first), "_n": np.add.reduceat(n[i], first)})

    def bucket(key, frames, state):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        back = state.getCurrentWatermarkMs()
        now = (back // step_ms) + panes if back > 0 else 0  # in whole steps: all windows end at one
        held = None
        if state.exists:
            done, blob = state.get
            held = pa.ipc.open_stream(blob).read_all()
            if now > done:
                for out in windows(held, done, now):
                    out.insert(0, "_b", key[0])
                    yield out
                held = held.filter(pc.greater(held["_p"], now - panes))
        parts = [] if held is None else [held]
        kinds = pa.schema([("_k", pa.int64() if plain == "long" else pa.string()), ("_p", pa.int64()), ("_s", pa.float64()), ("_n", pa.int64())])
        for f in frames:
            if f.empty:  # a bucket called by its timeout
                continue
            t = pa.Table.from_pandas(f[kinds.names], schema=kinds, preserve_index=False)
            parts.append(t.filter(pc.greater(t["_p"], now - panes)))
            if sum(len(x) for x in parts[1:]) > 10 * at_once:
                parts = [combined(parts)]
        held = combined(parts).sort_by([("_k", "ascending"), ("_p", "ascending")]) if parts else None
        if held is None or not len(held):
            if state.exists:
                state.remove()
            return
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, held.schema) as w:
            w.write_table(held)
        state.update((int(now), sink.getvalue().to_pybytes()))
        closes = max(int(np.min(held["_p"].to_numpy())), now) + 1  # the next end of a window
        state.setTimeoutTimestamp(max(1, back, (closes - panes) * step_ms - 1))
    return bucket


def stream_staleness(stream: DataFrame, ts: str, subset: list[str], delay: str = "8 days") -> DataFrame:
    """Rows later than the watermark are dropped; exact duplicates on
    ``subset`` are dropped while the watermark keeps their state."""
    s = as_event_time(stream, ts).withWatermark(ts, delay)
    return s.dropDuplicatesWithinWatermark(subset)


def read_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def for_each_batch(stream: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str,
                   available_now: bool = True) -> DataStreamWriter:
    """Writer that runs ``fn(batch_df, batch_id)`` per micro-batch; the
    checkpoint folder must be on shared storage so a restart resumes."""
    w = stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    return w.trigger(availableNow=True) if available_now else w


def to_layer(stream: DataFrame, path: str, checkpoint: str, *, ts: str = "extraction_ts",
             fn: Callable[[DataFrame], DataFrame] | None = None) -> DataStreamWriter:
    """Writer of a stream into a date-partitioned layer, with the layout of the
    batch sinks (``sinks.append_once``), ``fn`` applied to each micro-batch.
    Only batches up to the layer's last one at the start can have been tried
    before."""
    from dockcast.operators.sequence import cached_scope
    from dockcast.sources.sinks import append_once, last_batch
    known: list[int] = []

    def batch(df: DataFrame, batch_id: int) -> None:
        if not known:
            known.append(last_batch(df.sparkSession, path))
        with cached_scope():
            append_once(fn(df) if fn else df, path, batch_id, ts=ts, again=batch_id <= known[0])
    return for_each_batch(stream, batch, checkpoint)


def to_files(stream: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Writer of a stream into Parquet files, exactly once (the sink's own log
    names the files that count)."""
    return (stream.writeStream.format("parquet").outputMode("append").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True))


def stream_clean(spark: SparkSession, raw_path: str, clean_path: str, checkpoint: str, *, schema,
                 clean_fn: Callable[[DataFrame], DataFrame]):
    """Each micro-batch of raw snapshot files is cleaned as a batch (the
    per-snapshot de-duplication needs whole snapshots, which a file brings)
    and appended to the clean layer (:func:`to_layer`)."""
    return to_layer(read_stream(spark, raw_path, schema), clean_path, checkpoint, fn=clean_fn).start()


def stream_clean_watermarked(stream: DataFrame, *, delay: str = "8 days") -> DataFrame:
    """Clean snapshots in a stream whose snapshots may arrive split over
    several micro-batches.

    The validity rules are stateless (each row against its own extraction
    day); only valid rows move the watermark. The two per-snapshot
    de-duplications are watermarked streaming
    aggregations keyed by ``extraction_ts`` — keep one row per 13-column
    subset, then drop every position held twice in one snapshot — so a
    snapshot is emitted (append mode) once the watermark has passed its
    time, whatever the batch boundaries. Rows later than ``delay`` are
    dropped by the watermark (the staleness cut-off).
    """
    from dockcast import schemas
    from dockcast.functions import fixed_values as fv
    from dockcast.functions.scalar import map_default
    from dockcast.operators import clean
    from dockcast.plans.snapshot import DEDUPE_ORDER, row_cutoff

    s = as_event_time(stream, "extraction_ts")
    valid = clean.filter_valid(s, schemas.REQUIRED_RAW, clean.station_rules(row_cutoff())).withWatermark("extraction_ts", delay)
    sub = schemas.DUPLICATE_SUBSET
    rest = DEDUPE_ORDER + [c for c in valid.columns if c not in sub and c not in DEDUPE_ORDER]
    kept = (valid.groupBy(*sub).agg(F.min(F.struct(*rest)).alias("_r"))
                 .select(*sub, *[F.col(f"_r.{c}").alias(c) for c in rest]))
    pos = ["lat", "lng", "extraction_ts"]
    others = [c for c in kept.columns if c not in pos]
    single = (kept.groupBy(*pos)
                  .agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct(*others)).alias("_r"))
                  .filter(F.col("_n") == 1)
                  .select(*pos, *[F.col(f"_r.{c}").alias(c) for c in others]))
    named = (single.withColumn("city", map_default("city", fv.CITY_NAMES))
                   .withColumn("area", map_default("area", fv.AREA_NAMES)))
    return named.select(*[f.name for f in schemas.CLEAN_SNAPSHOT.fields])


# ---------------------------------------------------------------------------
# Status table: streaming state, a log of changes, a base of older ones
# ---------------------------------------------------------------------------

def latest_per_key(rows: DataFrame, key: str, ts: str) -> DataFrame:
    """The latest row of each key (batch or stream): greatest ``ts``, a null
    one last; of rows at one time the least in the other columns."""
    rest = [c for c in rows.columns if c != key]
    order = [F.col(ts).isNull().alias("_o0"), (-F.unix_micros(F.col(ts).cast("timestamp"))).alias("_o1")]
    top = F.min(F.struct(*order, *[F.col(c) for c in rest])).alias("_row")
    return rows.groupBy(key).agg(top).select(*[F.col(c) if c == key else F.col("_row").getField(c).alias(c) for c in rows.columns])


COMPACT_BYTES = 64 << 20


def stream_status(spark: SparkSession, snapshots: DataFrame, status_path: str, checkpoint: str, *,
                  key: str = "id", ts: str = "extraction_ts", compact_bytes: int = COMPACT_BYTES):
    """Keep one status row per station, the latest snapshot (a late row never
    replaces a newer one).

    The latest row of each station is state of the streaming query (update
    mode), so a batch reads and writes the state of its own stations only.
    What it emits, their current rows, becomes one folder of a log; a batch
    that is tried again replaces its own folder. The table (``read_status``)
    is the latest row of each station over the log and the newest version of
    the state. When the log outweighs that version (and ``compact_bytes``), both
    are merged into a new version, so a row is rewritten a bounded number of
    times on average, and old folders go. A version that cannot be read fails
    the run."""
    from dockcast.sources import files
    begun = []

    def batch(df: DataFrame, batch_id: int) -> None:
        version = status_version(spark, status_path)
        if not begun and version is not None:
            read_status(spark, status_path, key=key, ts=ts)  # its schema: the files are there and readable
        begun.append(batch_id)
        logs = files.folders(spark, f"{status_path}/log", "n")
        mine = f"_{df.sparkSession.sparkContext.getLocalProperty('sql.streaming.queryId')}_{batch_id}"
        nth = max([version if version is not None else -1, *map(files.number, logs)]) + 1
        folder = next((x for x in logs if x.endswith(mine)), f"n={nth}{mine}")
        df.write.mode("overwrite").parquet(f"{status_path}/log/{folder}")
        grown = sum(files.bytes_under(spark, f"{status_path}/log/{x}") for x in {*logs, folder} if version is None or files.number(x) > version)
        if version is None or grown > max(compact_bytes, files.bytes_under(spark, f"{status_path}/state/v={version}")):
            compact_status(spark, status_path, key=key, ts=ts)
    w = latest_per_key(snapshots, key, ts).writeStream.outputMode("update").foreachBatch(batch)
    return w.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def status_version(spark: SparkSession, status_path: str) -> int | None:
    """The newest version of the state: the number of the last log folder in it."""
    from dockcast.sources import files
    versions = files.folders(spark, f"{status_path}/state", "v")
    return files.number(versions[-1]) if versions else None


def read_status(spark: SparkSession, status_path: str, *, key: str = "id", ts: str = "extraction_ts") -> DataFrame:
    """The current status table."""
    from dockcast.sources import files
    version = status_version(spark, status_path)
    paths = [] if version is None else [f"{status_path}/state/v={version}"]
    paths += [f"{status_path}/log/{x}" for x in files.folders(spark, f"{status_path}/log", "n") if version is None or files.number(x) > version]
    parts = [spark.read.parquet(p) for p in paths]  # each names its own columns: no partition columns from folder names
    table = parts[0]
    for p in parts[1:]:
        table = table.unionByName(p)
    return latest_per_key(table, key, ts)


def compact_status(spark: SparkSession, status_path: str, *, key: str = "id", ts: str = "extraction_ts") -> None:
    """Merge the log into a new version of the state. The version gets its
    name once it is complete; the one before it, and the log that one lacks,
    stay one round longer for readers that have begun."""
    from dockcast.sources import files
    version = status_version(spark, status_path)
    logs = files.folders(spark, f"{status_path}/log", "n")
    if not logs or (version is not None and files.number(logs[-1]) <= version):
        return
    draft = f"{status_path}/state/_draft"
    read_status(spark, status_path, key=key, ts=ts).write.mode("overwrite").parquet(draft)
    files.publish(spark, draft, f"{status_path}/state/v={files.number(logs[-1])}")
    if version is not None:
        for x in files.folders(spark, f"{status_path}/state", "v"):
            if files.number(x) < version:
                files.remove(spark, f"{status_path}/state/{x}")
        for x in logs:
            if files.number(x) <= version:
                files.remove(spark, f"{status_path}/log/{x}")


def stream_forecasts(spark: SparkSession, status_stream: DataFrame, *, clean_layer: DataFrame,
                     stations: DataFrame, zones: DataFrame, weather_latest: DataFrame, model_path: str,
                     forecasts_path: str, checkpoint: str, available_now: bool = True):
    """Continuous forecast service: every status micro-batch requests
    forecasts for its stations, as of the batch's newest status time; fresh
    forecasts are served from the table, the rest are computed and
    insert-ignored (``plans.jobs.forecast``)."""
    from dockcast.plans import jobs

    def batch(df: DataFrame, batch_id: int) -> None:
        as_of = df.agg(F.max("updated_at")).first()[0]
        if as_of is None:
            return
        requested = df.select(F.col("id").cast("int").alias("station_id")).distinct()
        jobs.forecast(spark, requested, df, clean_layer, stations, zones, weather_latest,
                      model_path=model_path, forecasts_path=forecasts_path, as_of=as_of)
    return for_each_batch(status_stream, batch, checkpoint, available_now).start()

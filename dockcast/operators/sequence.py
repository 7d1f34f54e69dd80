"""Per-key ordered series operations (lag, lead, rolling frames, position,
carry-forward, sequential recurrences) that stay parallel when a key is hot.

A station's time series is ordered by time, and every feature is a bounded
row frame over that order. A plain ``Window.partitionBy(key)`` puts a whole
key into one task; if one key holds a third of all rows, that task holds a
third of the data. So each operator here first splits keys in two:

* cold keys (at most ``hot_rows`` rows): the plain window, one shuffle;
* hot keys (more rows, found by a partially aggregated count): rows are
  numbered without a per-key task (range partitioning on (key, order) spreads
  a key over many partitions; per-partition counts give the offsets), then
  cut into chunks of ``chunk_rows`` positions. A bounded row frame only needs
  a halo of ``preceding``/``following`` rows from the neighbouring chunks, so
  the window runs per (key, chunk) with those halo rows copied in.

The list of hot keys is bounded by ``max_hot_keys`` (checked by a bounded
job) and broadcast; beyond that bound every key takes the chunked path.

Order columns must make rows unique within a key (add an id as tie-break),
so the numbering is deterministic on recomputation.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pyspark import StorageLevel

from dockcast.session import cut_lineage, row_count_at_most, ship_package, shuffle_partitions


@dataclass(frozen=True)
class SkewConfig:
    """When a key counts as hot, and how the split path is cut.

    A key is hot when its rows exceed both ``hot_rows`` and ``hot_share`` ×
    (all rows / shuffle partitions): alone it would be more than an even
    partition's share of the work, i.e. a straggler. Above
    ``rows_per_partition`` rows a key is hot whatever its share.
    """
    hot_rows: int = 1 << 20        # floor: smaller keys never pay for splitting (one task, ~1 s)
    hot_share: float = 1.0         # fraction of an even partition share above which a key is hot
    chunk_rows: int = 1 << 16      # positions per chunk on the split path
    max_hot_keys: int = 100_000    # bound for broadcasting the hot-key list
    materialize: str = "persist"   # or "checkpoint" (shared checkpoint folder)
    rows_per_partition: int = 1 << 22  # range partitions on the split path are sized by this


DEFAULT_SKEW = SkewConfig()
_PERSISTED: ContextVar[list[DataFrame]] = ContextVar("persisted", default=[])  # kept for lazy results


def remember_persisted(df: DataFrame) -> DataFrame:
    """Register a frame persisted for a lazy result, to be released with its
    scope once the result has been written."""
    _PERSISTED.get().append(df)
    return df


def release_cached() -> int:
    """Unpersist the relations that this scope's split paths persisted; call
    after the results built on them have been written."""
    kept = _PERSISTED.get()
    n = len(kept)
    while kept:
        kept.pop().unpersist()
    return n


@contextmanager
def cached_scope():
    """A job's own list of persisted relations, released when the job ends;
    those of other jobs, running at the same time or around it, stay."""
    token = _PERSISTED.set([])
    try:
        yield
    finally:
        release_cached()
        _PERSISTED.reset(token)
MAX_BROADCAST_ROWS = 2_000_000  # broadcast bound for the offsets table
_ACTIVE: list[SkewConfig] = [DEFAULT_SKEW]


def current_skew(cfg: SkewConfig | None = None) -> SkewConfig:
    """The explicit config, else the innermost ``skew_config`` block's."""
    return cfg if cfg is not None else _ACTIVE[-1]


@contextmanager
def skew_config(cfg: SkewConfig):
    """Run the enclosed plan construction with another skew config (tests
    use tiny thresholds to push every key through the split path)."""
    _ACTIVE.append(cfg)
    try:
        yield cfg
    finally:
        _ACTIVE.pop()

_RANK, _PID, _LRN, _CHUNK, _HALO = "_sq_rank", "_sq_pid", "_sq_lrn", "_sq_chunk", "_sq_halo"


def _as_list(x) -> list:
    if x is None:
        return []
    return [x] if isinstance(x, (str, Column)) else list(x)


def _join_ns(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``on`` that also matches null keys (<=>), keeping one copy
    of the key columns. Still planned as a hash/sort-merge join."""
    r = right.select(*[F.col(c).alias(f"_r_{c}") for c in on], *[c for c in right.columns if c not in on])
    cond = None
    for c in on:
        e = left[c].eqNullSafe(r[f"_r_{c}"])
        cond = e if cond is None else cond & e
    out = left.join(r, cond, how)
    return out if how in ("left_semi", "left_anti") else out.drop(*[f"_r_{c}" for c in on])


def _order_exprs(order: Sequence, descending: bool) -> list[Column]:
    out = []
    for o in order:
        c = F.col(o) if isinstance(o, str) else o
        out.append(c.desc() if descending else c.asc())
    return out


@dataclass
class KeySplit:
    cold: DataFrame | None   # rows of keys with at most hot_rows rows
    hot: DataFrame | None    # rows of the longer keys
    hot_rows: int            # how many rows the hot side has (sizes its partitioning)

    def __iter__(self):
        return iter((self.cold, self.hot))


def hot_threshold(spark, total_rows: int, cfg: SkewConfig) -> int:
    """Rows above which one key is split (see ``SkewConfig``). However large
    the table, a key of more than ``rows_per_partition`` rows is split."""
    share = int(total_rows * cfg.hot_share / max(shuffle_partitions(spark), 1))
    return max(cfg.hot_rows, min(share, cfg.rows_per_partition))


def split_hot_keys(df: DataFrame, key: Sequence[str], cfg: SkewConfig | None = None) -> KeySplit:
    """Cold rows and hot rows; either may be None when empty.

    The count per key is a partial (map-side) aggregate over the key columns
    only, so a hot key costs one partial row per map task.
    """
    cfg = current_skew(cfg)
    key = list(key)
    counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_sq_n"))
    top = counts.agg(F.sum("_sq_n").alias("total"), F.max("_sq_n").alias("top")).first()  # one row
    total, largest = int(top["total"] or 0), int(top["top"] or 0)
    threshold = hot_threshold(df.sparkSession, total, cfg)
    if largest <= threshold:  # the common case ends here, after one job
        return KeySplit(df, None, 0)
    # a hot key exists: a second pass over the key column lists the hot keys
    hot_counts = counts.filter(F.col("_sq_n") > F.lit(threshold))
    listed = hot_counts.limit(cfg.max_hot_keys + 1).collect()  # bounded: ≤ max_hot_keys + 1 rows
    if len(listed) > cfg.max_hot_keys:
        total_hot = int(hot_counts.agg(F.sum("_sq_n")).first()[0])
        return KeySplit(None, df, total_hot)
    hot_total = sum(int(r["_sq_n"]) for r in listed)
    # the listed keys become a local relation: the plan does not aggregate again
    schema = df.select(*key).schema
    hk = F.broadcast(df.sparkSession.createDataFrame([tuple(r[k] for k in key) for r in listed], schema))
    return KeySplit(_join_ns(df, hk, key, "left_anti"), _join_ns(df, hk, key, "left_semi"), hot_total)


def _range_partitions(spark, rows: int | None, cfg: SkewConfig) -> int:
    """At least the session's shuffle partitions, more when the split rows
    would exceed ``rows_per_partition`` per partition."""
    n = shuffle_partitions(spark)
    if rows:
        n = max(n, -(-rows // cfg.rows_per_partition))
    return n


def global_position(df: DataFrame, key: Sequence[str], order: Sequence, *,
                    descending: bool = False, out: str = _RANK,
                    small_key_count: bool = True, cfg: SkewConfig | None = None,
                    rows: int | None = None) -> DataFrame:
    """1-based position of each row within its key, without a per-key task.

    Range partitioning on (key, order) splits a long key over many
    partitions; after a sort within each partition,
    ``monotonically_increasing_id`` numbers rows in order (its upper bits are
    the partition index). A key's offset in a partition is its row count in
    earlier partitions, from a table of at most (#partitions + #keys) rows.

    The numbered relation is read twice (offsets, rows), so it is
    materialised once: persisted (lost blocks are recomputed from the same
    range exchange, hence the same partition contents) or, with
    ``cfg.materialize == 'checkpoint'``, written to the checkpoint folder.
    """
    cfg = current_skew(cfg)
    key = list(key)
    n = _range_partitions(df.sparkSession, rows, cfg)
    ordered = [F.col(k).asc() for k in key] + _order_exprs(order, descending)
    r = (df.repartitionByRange(n, *ordered)
           .sortWithinPartitions(*ordered)
           .withColumn(_LRN, F.monotonically_increasing_id()))
    if cfg.materialize == "checkpoint":
        r = cut_lineage(r)
    else:
        r = remember_persisted(r.persist(StorageLevel.MEMORY_AND_DISK))
    r = r.withColumn(_PID, F.shiftright(F.col(_LRN), 33))
    stats = r.groupBy(*key, _PID).agg(F.min(_LRN).alias("_sq_min"), F.count(F.lit(1)).alias("_sq_cnt"))
    before = Window.partitionBy(*key).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offs = stats.select(*key, _PID, "_sq_min",
                        F.coalesce(F.sum("_sq_cnt").over(before), F.lit(0)).alias("_sq_off"))
    if small_key_count and n + cfg.max_hot_keys <= MAX_BROADCAST_ROWS:
        offs = F.broadcast(offs)  # ≤ #partitions + max_hot_keys rows, checked just above
    elif row_count_at_most(offs, MAX_BROADCAST_ROWS):
        offs = F.broadcast(offs)  # many keys, but the offsets table is checked small
    # otherwise a shuffle join on (key, partition): evenly spread, as partitions split keys
    return (_join_ns(r, offs, key + [_PID])
             .withColumn(out, (F.col("_sq_off") + F.col(_LRN) - F.col("_sq_min") + 1).cast("long"))
             .drop(_PID, _LRN, "_sq_off", "_sq_min"))


def _chunked(df: DataFrame, chunk_rows: int) -> DataFrame:
    return df.withColumn(_CHUNK, F.floor((F.col(_RANK) - 1) / F.lit(chunk_rows)).cast("long"))


def row_frames(df: DataFrame, key: Sequence[str] | str, order: Sequence | str,
               build: Callable[[Window], dict[str, Column]], *,
               preceding: int = 0, following: int = 0,
               cfg: SkewConfig | None = None) -> DataFrame:
    """Add window columns whose frames stay within ``preceding`` rows before
    and ``following`` rows after the current row of the same key.

    ``build(w)`` receives a window spec partitioned by key and ordered by
    ``order`` and returns {name: expression over w}. Ranking/offset functions
    (lag/lead) and ``w.rowsBetween(-p, f)`` frames with p ≤ preceding and
    f ≤ following are allowed; unbounded frames are not.
    """
    cfg = current_skew(cfg)
    key, order = _as_list(key), _as_list(order)
    split = split_hot_keys(df, key, cfg)
    cold, hot = split.cold, split.hot
    parts = []
    if cold is not None:
        w = Window.partitionBy(*key).orderBy(*_order_exprs(order, False))
        cols = build(w)
        parts.append(cold.select("*", *[c.alias(n) for n, c in cols.items()]))
    if hot is not None:
        c = cfg.chunk_rows
        if c < max(preceding, following):
            raise ValueError("chunk_rows must cover the frame on each side")
        r = _chunked(global_position(hot, key, order, small_key_count=cold is not None, cfg=cfg, rows=split.hot_rows), c)
        pos = (F.col(_RANK) - 1) % F.lit(c)
        home = F.struct(F.col(_CHUNK).alias("c"), F.lit(False).alias("h"))
        to_next = F.when(pos >= F.lit(c - preceding), F.struct((F.col(_CHUNK) + 1).alias("c"), F.lit(True).alias("h")))
        to_prev = F.when(pos < F.lit(following), F.struct((F.col(_CHUNK) - 1).alias("c"), F.lit(True).alias("h")))
        copies = F.filter(F.array(home, to_next, to_prev), lambda x: x.isNotNull())
        x = (r.withColumn("_sq_t", F.explode(copies))
              .withColumn(_CHUNK, F.col("_sq_t.c")).withColumn(_HALO, F.col("_sq_t.h")).drop("_sq_t"))
        w = Window.partitionBy(*key, _CHUNK).orderBy(_RANK)
        cols = build(w)
        out = (x.select("*", *[cc.alias(n) for n, cc in cols.items()])
                .filter(~F.col(_HALO)).drop(_HALO, _CHUNK, _RANK))
        parts.append(out)
    return _union(parts)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def position(df: DataFrame, key, order, out: str = "position", *, descending: bool = False,
             cfg: SkewConfig | None = None) -> DataFrame:
    """1-based row position per key (``row_number``), skew-safe."""
    cfg = current_skew(cfg)
    key, order = _as_list(key), _as_list(order)
    split = split_hot_keys(df, key, cfg)
    cold, hot = split.cold, split.hot
    parts = []
    if cold is not None:
        w = Window.partitionBy(*key).orderBy(*_order_exprs(order, descending))
        parts.append(cold.withColumn(out, F.row_number().over(w).cast("long")))
    if hot is not None:
        parts.append(global_position(hot, key, order, descending=descending, out=out,
                                     small_key_count=cold is not None, cfg=cfg, rows=split.hot_rows))
    return _union(parts)


def carry_forward(df: DataFrame, key, order, value: str | Column, out: str, *,
                  cfg: SkewConfig | None = None) -> DataFrame:
    """Last non-null ``value`` at or before each row of the key (forward fill)."""
    return carry_forward_all(df, key, order, {out: value}, cfg=cfg)


def carry_forward_all(df: DataFrame, key, order, values: dict[str, str | Column], *, descending: bool = False,
                      cfg: SkewConfig | None = None) -> DataFrame:
    """Forward fill of several columns {out: value}, all in one pass; with
    ``descending`` every order column runs backward (a backward fill).

    Split path: a two-level scan — last non-null per chunk, carried across
    chunks by a window over the (rows / chunk_rows)-sized chunk table.
    """
    cfg = current_skew(cfg)
    key, order = _as_list(key), _as_list(order)
    vs = {o: F.col(v) if isinstance(v, str) else v for o, v in values.items()}
    split = split_hot_keys(df, key, cfg)
    cold, hot = split.cold, split.hot
    parts = []
    if cold is not None:
        w = (Window.partitionBy(*key).orderBy(*_order_exprs(order, descending))
             .rowsBetween(Window.unboundedPreceding, 0))
        parts.append(cold.select("*", *[F.last(v, ignorenulls=True).over(w).alias(o) for o, v in vs.items()]))
    if hot is not None:
        outs = list(vs)
        r = _chunked(global_position(hot, key, order, descending=descending, small_key_count=cold is not None, cfg=cfg, rows=split.hot_rows), cfg.chunk_rows)
        r = r.select("*", *[v.alias(f"_sq_v{i}") for i, v in enumerate(vs.values())])
        wl = (Window.partitionBy(*key, _CHUNK).orderBy(_RANK)
              .rowsBetween(Window.unboundedPreceding, 0))
        r = r.select("*", *[F.last(f"_sq_v{i}", ignorenulls=True).over(wl).alias(f"_sq_local{i}") for i in range(len(outs))])
        # a chunk without a non-null value has a null tail; the window over the
        # chunk table (rows / chunk_rows per key) carries the last one on
        tail = r.groupBy(*key, _CHUNK).agg(*[F.max(F.when(F.col(f"_sq_v{i}").isNotNull(), F.struct(F.col(_RANK).alias("r"), F.col(f"_sq_v{i}").alias("v")))).alias(f"_sq_t{i}")
                                             for i in range(len(outs))])
        wc = Window.partitionBy(*key).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        fill = tail.select(*key, _CHUNK, *[F.last(F.col(f"_sq_t{i}.v"), ignorenulls=True).over(wc).alias(f"_sq_prev{i}") for i in range(len(outs))])
        r = _join_ns(r, fill, key + [_CHUNK], "left")
        parts.append(r.select(*hot.columns, *[F.coalesce(f"_sq_local{i}", f"_sq_prev{i}").alias(o) for i, o in enumerate(outs)]))
    return _union(parts)


def prefix_sums(df: DataFrame, key, order, sums: dict[str, Column], *,
                cfg: SkewConfig | None = None) -> DataFrame:
    """Running (inclusive) sums per key in ``order``: {out: value column}.

    Split path: sums inside each chunk, plus the total of all earlier chunks
    from a window over the chunk table (rows / chunk_rows per key).
    """
    cfg = current_skew(cfg)
    key, order = _as_list(key), _as_list(order)
    split = split_hot_keys(df, key, cfg)
    cold, hot = split.cold, split.hot
    parts = []
    if cold is not None:
        w = (Window.partitionBy(*key).orderBy(*_order_exprs(order, False))
             .rowsBetween(Window.unboundedPreceding, 0))
        parts.append(cold.select("*", *[F.sum(c).over(w).alias(o) for o, c in sums.items()]))
    if hot is not None:
        r = _chunked(global_position(hot, key, order, small_key_count=cold is not None, cfg=cfg,
                                     rows=split.hot_rows), cfg.chunk_rows)
        r = r.select("*", *[c.alias(f"_sq_s_{o}") for o, c in sums.items()])
        wl = (Window.partitionBy(*key, _CHUNK).orderBy(_RANK)
              .rowsBetween(Window.unboundedPreceding, 0))
        r = r.select("*", *[F.sum(f"_sq_s_{o}").over(wl).alias(f"_sq_l_{o}") for o in sums])
        tot = r.groupBy(*key, _CHUNK).agg(*[F.sum(f"_sq_s_{o}").alias(f"_sq_t_{o}") for o in sums])
        wc = Window.partitionBy(*key).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        before = tot.select(*key, _CHUNK, *[F.coalesce(F.sum(f"_sq_t_{o}").over(wc), F.lit(0)).alias(f"_sq_b_{o}")
                                            for o in sums])
        r = _join_ns(r, before, key + [_CHUNK], "left")
        parts.append(r.select(*[c for c in hot.columns],
                              *[(F.col(f"_sq_l_{o}") + F.col(f"_sq_b_{o}")).alias(o) for o in sums]))
    return _union(parts)


# ---------------------------------------------------------------------------
# Sequential recurrence x_n = clamp(a_n * x_{n-1} + b_n, lo, hi)
#
# Maps of the form x -> clamp(a x + b, lo, hi) are closed under composition,
# so a per-key recurrence is an associative scan: compose each chunk's maps
# (bounded groups), scan the much smaller chunk table the same way, then
# replay each chunk from its carried-in value.
# ---------------------------------------------------------------------------

class _Null:
    """Stands for a null key so that null == null when finding group starts."""

    def __eq__(self, other):
        return isinstance(other, _Null)

    def __hash__(self):
        return 0


_NULL = _Null()


def _key_of(pdf: pd.DataFrame, cols: list[str], i: int) -> tuple:
    return tuple(_NULL if pd.isna(pdf[c].iloc[i]) else pdf[c].iloc[i] for c in cols)


def _group_starts(pdf: pd.DataFrame, cols: list[str], prev_key) -> np.ndarray:
    """Boolean vector: row i starts a new group (vs row i-1 / the previous
    batch). Null keys form one group, as in a GROUP BY."""
    n = len(pdf)
    starts = np.zeros(n, dtype=bool)
    for c in cols:
        s = pdf[c]
        prev = s.shift(1)
        changed = (s != prev) & ~(s.isna() & prev.isna())
        starts |= changed.to_numpy(dtype=bool)
    if n:
        starts[0] = prev_key is None or _key_of(pdf, cols, 0) != prev_key
    return starts


def _walk(new, a, b, a1, b1, c, lo, hi, st, x: float) -> tuple[np.ndarray, float]:
    """One batch of the recurrence, ``x`` carried in and out. Groups of the
    batch advance in step, one vector operation per position; a batch that is
    mostly one long group has nothing to put beside it and is walked alone."""
    n = len(new)
    res = np.empty(n, dtype="float64")
    first = np.flatnonzero(new)
    if not new[0]:
        first = np.append(0, first)
    size = np.diff(np.append(first, n))
    af, bf, cf = np.where(new, a1, a), np.where(new, b1, b), np.where(new, 0.0, c)
    x0 = np.where(new[first], st[first] if st is not None else 0.0, x)
    if size.max() * 16 > n:
        cols = [v.tolist() for v in (new, af, bf, cf, lo, hi)]
        starts = iter(x0[new[first]].tolist())
        for i, (is_new, ai, bi, ci, l, h) in enumerate(zip(*cols)):
            if is_new:
                x = next(starts)
            y = bi if ai == 0.0 else ai * x + bi
            if ci != 0.0:
                y = y + ci  # second offset term added last, as written
            x = y if y != y else min(max(y, l), h)
            res[i] = x
        return res, x
    order = np.argsort(-size, kind="stable")
    first, size, x0 = first[order], size[order], x0[order].astype("float64")
    live = np.searchsorted(-size, -np.arange(int(size[0])), "left")
    for k in range(int(size[0])):
        m = live[k]
        i = first[:m] + k
        ai = af[i]
        y = np.where(ai == 0.0, bf[i], ai * x0[:m] + bf[i])
        y = np.where(cf[i] != 0.0, y + cf[i], y)
        x0[:m] = np.where(np.isnan(y), y, np.minimum(np.maximum(y, lo[i]), hi[i]))
        res[i] = x0[:m]
    return res, float(res[n - 1])


def _replay(df: DataFrame, group: list[str], order: list, out: str, start: str | None) -> DataFrame:
    """Sequential replay of x = clamp(a·x_prev + b, lo, hi) within each group.

    Rows are hash-partitioned by group and sorted by (group, order); one
    Python call per Arrow batch walks the rows and carries (group, x) across
    batches, so memory stays at one batch whatever the group size. The first
    row of a group uses (_sq_a1, _sq_b1) and starts from ``start`` (or 0); a
    null start makes the chain null.
    """
    ship_package(df.sparkSession)
    out_schema = T.StructType(df.schema.fields + [T.StructField(out, T.DoubleType(), True)])

    def run(it):
        prev_key, x = None, 0.0
        for pdf in it:
            n = len(pdf)
            if n == 0:
                continue
            new = _group_starts(pdf, group, prev_key)
            a = pdf["_sq_a"].to_numpy("float64")
            b = pdf["_sq_b"].to_numpy("float64")
            a1 = pdf["_sq_a1"].to_numpy("float64")
            b1 = pdf["_sq_b1"].to_numpy("float64")
            c = pdf["_sq_c"].to_numpy("float64") if "_sq_c" in pdf.columns else np.zeros(n)
            lo = pdf["_sq_lo"].to_numpy("float64")
            hi = pdf["_sq_hi"].to_numpy("float64")
            st = pdf[start].to_numpy("float64") if start else None
            res, x = _walk(new, a, b, a1, b1, c, lo, hi, st, x)
            prev_key = _key_of(pdf, group, n - 1)
            pdf[out] = res
            yield pdf
    ordered = [F.col(g).asc() for g in group] + _order_exprs(order, False)
    return (df.repartition(*[F.col(g) for g in group])
              .sortWithinPartitions(*ordered)
              .mapInPandas(run, schema=out_schema))


_MAP_COLS = ["_sq_a", "_sq_b", "_sq_lo", "_sq_hi"]


def _compose_all(a: np.ndarray, b: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[float, float, float, float]:
    """The composition of all maps of a chunk, first to last, by halving: maps
    beside each other are composed in one vector operation per level. The map
    (a, b, lo, hi) is x -> clamp(a x + b, lo, hi); a null step makes the rest
    null, up to a step that forgets what came before it (a = 0)."""
    null = np.flatnonzero(np.isnan(b))
    if len(null):  # what comes before the last null step can't matter
        last = null[-1]
        a, b, lo, hi = (v[last:].copy() for v in (a, b, lo, hi))
        a[0], b[0], lo[0], hi[0] = 0.0, np.nan, -np.inf, np.inf
    while len(a) > 1:
        odd = tuple(v[-1:] for v in (a, b, lo, hi)) if len(a) % 2 else None
        n = len(a) // 2 * 2
        a1, b1, l1, h1 = (v[0:n:2] for v in (a, b, lo, hi))
        a2, b2, l2, h2 = (v[1:n:2] for v in (a, b, lo, hi))
        flat = a2 == 0.0
        const = np.minimum(np.maximum(b2, l2), h2)
        with np.errstate(invalid="ignore"):
            p, q = a2 * l1 + b2, a2 * h1 + b2
            low, high = np.where(a2 > 0, p, q), np.where(a2 > 0, q, p)
            low, high = np.where(np.isnan(low), -np.inf, low), np.where(np.isnan(high), np.inf, high)
            low, high = np.minimum(np.maximum(low, l2), h2), np.minimum(np.maximum(high, l2), h2)
            made = [np.where(flat, 0.0, a2 * a1), np.where(flat, const, a2 * b1 + b2), np.where(flat, const, low), np.where(flat, const, high)]
        a, b, lo, hi = (np.append(m, o) for m, o in zip(made, odd)) if odd else made
    return float(a[0]), float(b[0]), float(lo[0]), float(hi[0])


def _compose_chunks(df: DataFrame, key: list[str], pos: str, chunk: str, key_schema: str) -> DataFrame:
    ship_package(df.sparkSession)
    def comp(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(pos)
        res = pdf[key].iloc[:1].copy()
        res[chunk] = int(pdf[chunk].iloc[0])
        res["_sq_a"], res["_sq_b"], res["_sq_lo"], res["_sq_hi"] = _compose_all(*[pdf[c].to_numpy("float64") for c in _MAP_COLS])
        return res
    return (df.select(*key, pos, chunk, *_MAP_COLS)
              .groupBy(*key, chunk)
              .applyInPandas(comp, schema=f"{key_schema}, {chunk} long, _sq_a double, _sq_b double, _sq_lo double, _sq_hi double"))


def _scan(df: DataFrame, key: list[str], pos: str, cfg: SkewConfig, depth: int = 0) -> DataFrame:
    """Chunked scan for long keys. df: key, pos (1..n per key), map
    columns, with the first row's map already in place → key, pos, _sq_x.

    Each chunk's maps are composed (groups of ``chunk_rows``), the chunk
    table (n / chunk_rows rows per key) is scanned the same way — recursively
    while it is still long — and every chunk is replayed from the value
    carried in from the end of the previous chunk.
    """
    cfg = current_skew(cfg)
    counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_sq_n"))
    key_schema = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in key)
    if row_count_at_most(counts.filter(F.col("_sq_n") > cfg.hot_rows), 0) or depth > 8:
        d = df.withColumn("_sq_a1", F.col("_sq_a")).withColumn("_sq_b1", F.col("_sq_b"))
        return _replay(d, key, [pos], "_sq_x", None).select(*key, pos, "_sq_x")
    ch = f"_sq_c{depth}"
    c = cfg.chunk_rows
    d = df.withColumn(ch, F.floor((F.col(pos) - 1) / F.lit(c)).cast("long"))
    summary = _compose_chunks(d, key, pos, ch, key_schema).withColumn("_sq_p", F.col(ch) + 1)
    ends = _scan(summary.drop(ch).withColumnRenamed("_sq_p", pos), key, pos, cfg, depth + 1)
    carry = ends.select(*key, F.col(pos).alias(ch), F.col("_sq_x").alias("_sq_start"))
    # the first chunk starts from 0; a later one from its carry, null included
    d = (_join_ns(d, carry, key + [ch], "left")
          .withColumn("_sq_start", F.when(F.col(ch) == 0, F.lit(0.0)).otherwise(F.col("_sq_start")))
          .withColumn("_sq_a1", F.col("_sq_a")).withColumn("_sq_b1", F.col("_sq_b")))
    # replay each (key, chunk), bounded by chunk_rows, from its carried-in value
    return _replay(d, key + [ch], [pos], "_sq_x", "_sq_start").select(*key, pos, "_sq_x")


def clamped_affine_scan(df: DataFrame, key, order, *, a: Column, b: Column,
                        a_first: Column, b_first: Column, c: Column | None = None,
                        lo: float = float("-inf"), hi: float = float("inf"),
                        out: str = "x", cfg: SkewConfig | None = None) -> DataFrame:
    """Per key, in ``order``: x_1 = clamp(a_first·0 + b_first, lo, hi) (pass
    a_first = 0: the first row does not depend on a previous value),
    x_n = clamp((a_n·x_{n-1} + b_n) + c_n, lo, hi). ``c`` is an optional
    second offset added last, so the sequential replay performs the same
    floating-point operations as the step written out. A null offset yields
    null from there on (until a row whose a is 0).

    Keys up to ``hot_rows`` rows are replayed in one streaming pass over
    key-partitioned sorted rows; longer keys go through the chunked scan.
    """
    cfg = current_skew(cfg)
    key, order = _as_list(key), _as_list(order)
    split = split_hot_keys(df, key, cfg)
    cold, hot = split.cold, split.hot
    c = F.lit(0.0) if c is None else c
    maps = [a.cast("double").alias("_sq_a"), b.cast("double").alias("_sq_b"),
            a_first.cast("double").alias("_sq_a1"), b_first.cast("double").alias("_sq_b1"),
            c.cast("double").alias("_sq_c"),
            F.lit(lo).cast("double").alias("_sq_lo"), F.lit(hi).cast("double").alias("_sq_hi")]
    helper = ["_sq_a", "_sq_b", "_sq_a1", "_sq_b1", "_sq_c", "_sq_lo", "_sq_hi"]
    parts = []
    if cold is not None:
        r = _replay(cold.select("*", *maps), key, order, "_sq_x", None)
        parts.append(r.drop(*helper))
    if hot is not None:
        p = global_position(hot, key, order, out="_sq_pos", small_key_count=cold is not None, cfg=cfg,
                            rows=split.hot_rows)
        first = F.col("_sq_pos") == 1
        m = p.select("*", *maps)
        m = (m.withColumn("_sq_a", F.when(first, F.col("_sq_a1")).otherwise(F.col("_sq_a")))
              .withColumn("_sq_b", F.when(first, F.col("_sq_b1"))
                          .otherwise(F.col("_sq_b") + F.col("_sq_c"))))
        xs = _scan(m.select(*key, "_sq_pos", *_MAP_COLS), key, "_sq_pos", cfg)
        parts.append(_join_ns(p, xs, key + ["_sq_pos"]).drop("_sq_pos"))
    return (_union(parts)
            .withColumn(out, F.when(F.isnan("_sq_x"), F.lit(None)).otherwise(F.col("_sq_x")))
            .drop("_sq_x"))

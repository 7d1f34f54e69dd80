"""Super-k-mer exchange: consecutive windows of a text that share a minimiser
travel together, as one packed string, to the bucket of the minimiser.

A window is ``window`` consecutive units (words or bytes). Its minimiser is
the least hash of its ``k``-unit parts, so equal windows have equal minimisers
and meet in one bucket whatever text they come from. Within a map task equal
packed strings are kept once with the list of places they come from. The
strings of one bucket and task are one row: a compressed block. Blocks are
shuffled and sorted by bucket; a reducer holds one bucket at a time.

Equal texts in large groups are exchanged once: a group of ``copies`` rows or
more, and of more than one row in 100,000 of all, sends one of its rows (so
there are at most 100,000 such groups, whatever the input, and their digests
can be broadcast). What the other rows lose follows from being a copy.

A bucket is sized to a few MB. A minimiser with more than ``hot`` different
strings in a bucket (a phrase that very many texts share), or with strings at
more than 50 * ``hot`` places, is not held: its strings leave the reducer and
are exchanged once more with k = window, where a key has one string only and
places stream through; none is cut.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockcast.llm.common import staged

OUT = "kind int, d long, h long, start long, stop long, packed binary"
FLUSH_BYTES = 64 << 20
PARTITION_BYTES = 128 << 20  # of packed strings, before compression
MOST_GROUPS = 100_000  # of copies that are broadcast
PLACES = 50  # places of a hot minimiser for each string of one


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def part_hashes(units: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k units: doubled runs, joined by the bits of k."""
    run, size, out, done = units, 1, None, 0
    with np.errstate(over="ignore"):
        while True:
            if k & size:
                if out is None:
                    out, done = run, size
                else:
                    n = len(units) - done - size + 1
                    out = out[:n] * np.uint64(0x9E3779B97F4A7C15 + 2 * size) + run[done:done + n]
                    done += size
            if done == k:
                return mix(out)
            n = len(run) - size
            run = run[:n] * np.uint64(0xD6E8FEB86659FD93 + 2 * size) + run[size:size + n]
            size *= 2


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    size = 1
    while size * 2 <= w:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[:len(x) - (w - size)], x[w - size:]) if w > size else x


def runs_of(units: np.ndarray, window: int, k: int, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one minimiser: key, first window, end (exclusive)."""
    if len(units) < window:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none
    least = sliding_min(part_hashes(units, k), window - k + 1)
    new = np.ones(len(least), bool)
    new[1:] = least[1:] != least[:-1]
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(least)))
    if size.max() > longest:  # long runs (repetitive text) in pieces
        pieces = -(-size // longest)
        at = np.repeat(first, pieces) + longest * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
        first, size = at, np.diff(np.append(at, len(least)))
    return least[first], first, first + size


class Block:
    """Strings of one bucket: key and places of each."""

    HEAD = "<III"

    @staticmethod
    def pack(keys: np.ndarray, packed: list[bytes], counts: np.ndarray, docs: np.ndarray, table: np.ndarray, starts: np.ndarray) -> bytes:
        raw = b"".join([struct.pack(Block.HEAD, len(packed), len(docs), len(table)), keys.astype("<u4").tobytes(), np.fromiter(map(len, packed), np.dtype("<u4"), len(packed)).tobytes(),
                        counts.astype("<u4").tobytes(), docs.astype("<u4").tobytes(), starts.astype("<i8").tobytes(), table.astype("<i8").tobytes(), *packed])
        return zstandard.ZstdCompressor(level=3).compress(raw)

    def __init__(self, data: bytes):
        raw = zstandard.ZstdDecompressor().decompress(data)
        n, m, t = struct.unpack_from(self.HEAD, raw)
        at = struct.calcsize(self.HEAD)

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(raw, kind, count, at)
            at += out.nbytes
            return out

        self.keys, sizes, self.counts = take("<u4", n), take("<u4", n), take("<u4", n)
        docs, self.starts = take("<u4", m), take("<i8", m)
        table = take("<i8", 2 * t).reshape(t, 2)
        self.d, self.h = table[docs, 0], table[docs, 1]
        ends = at + np.cumsum(sizes, dtype=np.int64)
        self.packed = [raw[a:b] for a, b in zip((ends - sizes).tolist(), ends.tolist())]


def block_rows(items: list[tuple], buckets: int) -> Iterator[tuple[int, bytes]]:
    """Blocks of (key, packed, d, h, start) columns gathered by a map task."""
    keys = np.concatenate([x[0] for x in items])
    packed = [p for x in items for p in x[1]]
    table = np.array([(x[2], x[3]) for x in items], np.int64)
    doc = np.repeat(np.arange(len(items)), [len(x[1]) for x in items])
    starts = np.concatenate([x[4] for x in items])
    bucket = (keys >> np.uint64(32)) % np.uint64(buckets)
    low = (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
    order = np.lexsort((low, bucket))
    b, low = bucket[order].astype(np.int64), low[order]
    # equal strings side by side: sort the strings of a key that has several
    new = np.ones(len(order), bool)
    new[1:] = (b[1:] != b[:-1]) | (low[1:] != low[:-1])
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(order)))
    for a, n in zip(first[size > 1].tolist(), size[size > 1].tolist()):
        part = order[a:a + n].tolist()
        part.sort(key=packed.__getitem__)
        order[a:a + n] = part
    o = order.tolist()
    fresh = new
    many = np.flatnonzero(~new)
    fresh[many] = [packed[o[i]] != packed[o[i - 1]] for i in many.tolist()]
    cut = np.flatnonzero(np.append(True, b[1:] != b[:-1]))
    for a, e in zip(cut.tolist(), np.append(cut[1:], len(o)).tolist()):
        f = a + np.flatnonzero(fresh[a:e])
        counts = np.diff(np.append(f, e))
        used, docs = np.unique(doc[order[a:e]], return_inverse=True)
        yield int(b[a]), Block.pack(low[f], [packed[o[i]] for i in f.tolist()], counts, docs, table[used], starts[order[a:e]])


def exchange(rows: DataFrame, cut: Callable, size: int, bucket_bytes: int, reduce: Callable) -> DataFrame:
    """``rows`` (d, h, at, data): data is cut into (keys, packed, starts) by
    ``cut``, some ``size`` bytes of packed strings in all; starts count from
    ``at``. ``reduce`` gets the blocks of a bucket one by one and yields rows of
    OUT. Buckets and, beyond the session's own number, partitions grow with size."""
    buckets = 1 << max(4, (size // bucket_bytes).bit_length())
    parts = min(buckets, size // PARTITION_BYTES)
    own = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def mapped(batches):
        import pyarrow as pa

        def out(items):
            got = list(block_rows(items, buckets))
            for i in range(0, len(got), 256):
                part = got[i:i + 256]
                yield pa.RecordBatch.from_pydict({"bucket": pa.array([x[0] for x in part], pa.int64()), "block": pa.array([x[1] for x in part], pa.binary())})

        items, held = [], 0
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                for d, h, at, data in zip(*[part.column(c).to_pylist() for c in ("d", "h", "at", "data")]):
                    keys, packed, starts = cut(data or b"")
                    if len(packed):
                        items.append((keys, packed, d, h, starts + at))
                        held += sum(map(len, packed))
                if held > FLUSH_BYTES:
                    yield from out(items)
                    items, held = [], 0
        if items:
            yield from out(items)

    def reduced(batches):
        import pyarrow as pa

        def blocks():
            for batch in batches:
                for i in range(0, batch.num_rows, 64):
                    part = batch.slice(i, 64)
                    yield from zip(part.column("bucket").to_pylist(), part.column("block").to_pylist())

        def groups():
            from itertools import groupby
            for _, g in groupby(blocks(), key=lambda x: x[0]):
                yield (Block(x[1]) for x in g)

        held: list[tuple] = []
        for g in groups():
            for row in reduce(g):
                held.append(row)
                if len(held) >= 4096:
                    yield to_batch(held, pa)
                    held = []
        if held:
            yield to_batch(held, pa)

    made = rows.select("d", "h", "at", "data").mapInArrow(mapped, "bucket long, block binary")
    dealt = made.repartition(parts, "bucket") if parts > own else made.repartition("bucket")
    return dealt.sortWithinPartitions("bucket").mapInArrow(reduced, OUT)


def to_batch(rows: list[tuple], pa):
    kinds = {"kind": pa.int32(), "d": pa.int64(), "h": pa.int64(), "start": pa.int64(), "stop": pa.int64(), "packed": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds.values())], names=list(kinds))


class Held:
    """The strings of one bucket, gathered from its blocks; strings of hot keys
    leave at once."""

    def __init__(self, hot: int):
        self.hot, self.blocks, self.hot_keys = hot, [], set()
        self.n = self.places = 0
        self.next, self.next_places = 8 * hot, 2 * PLACES * hot

    def add(self, block: Block) -> Iterator[tuple]:
        if self.hot_keys:
            yield from self._drop(block)
        self.blocks.append(block)
        self.n += len(block.keys)
        self.places += len(block.d)
        if self.n >= self.next or self.places >= self.next_places:
            keys, which, counts = np.unique(np.concatenate([b.keys for b in self.blocks]), return_inverse=True, return_counts=True)
            places = np.bincount(which, np.concatenate([b.counts for b in self.blocks]), len(keys))
            new = set(keys[(counts > self.hot) | (places > PLACES * self.hot)].tolist()) - self.hot_keys
            self.hot_keys |= new
            if new:
                for b in self.blocks:
                    yield from self._drop(b)
                self.n, self.places = (sum(len(x) for x in xs) for xs in zip(*[(b.keys, b.d) for b in self.blocks]))
            self.next, self.next_places = self.n + 8 * self.hot, self.places + 2 * PLACES * self.hot

    def _drop(self, b: Block) -> Iterator[tuple]:
        out = np.isin(b.keys, list(self.hot_keys))
        if not out.any():
            return
        ends = np.cumsum(b.counts, dtype=np.int64)
        for i in np.flatnonzero(out).tolist():
            for j in range(int(ends[i] - b.counts[i]), int(ends[i])):
                yield 1, int(b.d[j]), int(b.h[j]), int(b.starts[j]), None, b.packed[i]
        stay = np.repeat(~out, b.counts)
        b.d, b.h, b.starts = b.d[stay], b.h[stay], b.starts[stay]
        b.packed = [p for p, o in zip(b.packed, out.tolist()) if not o]
        b.keys, b.counts = b.keys[~out], b.counts[~out]


def copied(docs: DataFrame, name: str, n: int, copies: int) -> tuple[DataFrame, DataFrame]:
    """``docs`` (d, h, text, …) of n rows with ``least``, the smallest id of the
    row's large group of equal texts (null: in none), and the rows to exchange:
    those of no such group, and one of smallest id of each."""
    digest = F.unhex(F.sha2(F.col("text"), 256))
    large = docs.groupBy(digest.alias("digest")).agg(F.count("*").alias("n"), F.min("d").alias("least"))
    large = staged(large.filter(F.col("n") >= max(copies, 2, n // MOST_GROUPS + 1)).drop("n"), f"{name}-copies")
    if large.isEmpty():
        return docs.withColumn("least", F.lit(None).cast("long")), docs.select("d", "h", "text")
    known = docs.withColumn("digest", digest).join(F.broadcast(large), "digest", "left")  # at most MOST_GROUPS rows
    one = known.filter("d = least").groupBy("digest").agg(*[F.first(c).alias(c) for c in ("d", "h", "text")]).drop("digest")
    return known.drop("digest"), known.filter("least IS NULL").select("d", "h", "text").unionByName(one)


def marked(docs: DataFrame, name: str, cut: Callable, cut_hot: Callable, reduce: Callable, reduce_hot: Callable, blow_up: int, bucket_bytes: int,
           copies: int) -> tuple[DataFrame, DataFrame]:
    """``docs`` (d, h, text, …) with ``least`` (see :func:`copied`), and covered
    intervals (d, h, start, stop) of the rows exchanged."""
    size = docs.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    docs, once = copied(docs, name, size["n"], copies)
    rows = once.select("d", "h", F.lit(0).cast("long").alias("at"), F.col("text").cast("binary").alias("data"))
    found = staged(exchange(rows, cut, 4 * size["bytes"], bucket_bytes, reduce), name)
    hot = found.filter("kind = 1").select("d", "h", F.col("start").alias("at"), F.col("packed").alias("data"))
    spans = found.filter("kind = 0").select("d", "h", "start", "stop")
    n = hot.agg(F.coalesce(F.sum(F.length("data")), F.lit(0)).alias("n")).first()["n"]
    if n:  # strings of hot keys, window by window
        again = staged(exchange(hot, cut_hot, blow_up * n, bucket_bytes, reduce_hot), f"{name}-hot")
        spans = spans.unionByName(again.select("d", "h", "start", "stop"))
    return docs, spans


def key_columns(id: str, text: str) -> tuple[Column, Column]:
    """What names a row: its id (a null id sorts after all others) and the hash of its text."""
    return F.coalesce(F.col(id).cast("long"), F.lit((1 << 63) - 1)), F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))


def row_key(docs: DataFrame, id: str, text: str) -> DataFrame:
    """doc_id, text (null: empty) and the row's key d, h."""
    d, h = key_columns(id, text)
    return docs.select(F.col(id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"), d.alias("d"), h.alias("h"))


def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``docs`` with the list of its covered intervals (no more than it has units)."""
    per = spans.groupBy("d", "h").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    return docs.join(per, ["d", "h"], "left")


def merged(spans) -> list[tuple[int, int]]:
    """Sorted, non-overlapping, non-touching intervals."""
    out: list[list[int]] = []
    for a, b in sorted((s["start"], s["stop"]) for s in spans or ()):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]

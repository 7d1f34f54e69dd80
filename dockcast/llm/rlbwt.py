"""Suffix-array dedup with a run-length index: remove every byte covered by a
``window``-byte string that also starts anywhere else.

Byte windows are exchanged by minimiser (see :mod:`dockcast.llm.buckets`), so
all places of a repeated string meet in one bucket. Of a large group of equal
texts one row is exchanged; all windows of the group's rows repeat. A string that occurs once
under its minimiser, and cannot repeat within itself, is done. Equal strings
are kept once with their places. All others of a bucket go into a run-length
index (:class:`RunIndex`): suffix order, Burrows-Wheeler transform, its runs,
and samples at the run ends. Longest matches are compared only at the samples;
in text order every other position's match is one shorter than its
predecessor's, so the matching statistics of all strings against the whole
collection stream off the samples. Windows that match ``window`` bytes
elsewhere are marked and all places of their string are covered.

Rules. Texts are UTF-8 bytes; matches never cross documents; strings are
judged on the input; overlapping occurrences and occurrences inside one
document count; repeated rows are occurrences like any other. Null and empty
texts have no bytes. A null id is carried along. Texts shorter than
``window`` bytes keep all; very long texts are cut into strings like any
other, one text being held by its task. Empty tables give an empty result. Other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockcast.llm.buckets import Block, Held, marked, merged, row_key, runs_of, with_spans
from dockcast.llm.common import append_arrow, ship, texts_of


class RunIndex:
    """Run-compressed Burrows-Wheeler transform of a collection of texts, each
    ended by a terminator of its own, with samples at both ends of its runs."""

    def __init__(self, texts: list[bytes]):
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.first = np.cumsum(sizes) - sizes
        n, m = int(sizes.sum()), len(texts)
        raw = np.frombuffer(b"".join(texts) + bytes(8), np.uint8)
        at = np.arange(n)
        owner = np.repeat(np.arange(m), sizes)
        self.rest = np.repeat(self.first + sizes, sizes) - at  # bytes to the end of the text
        words = np.zeros(n, np.uint64)
        for j in range(8):
            words = words << np.uint64(8) | raw[j:n + j].astype(np.uint64)
        self.words, self.n = words, n
        cut = (np.uint64(8) * (8 - np.minimum(self.rest, 8)).astype(np.uint64))
        masked = np.where(self.rest >= 8, words, words >> np.minimum(cut, np.uint64(63)) << np.minimum(cut, np.uint64(63)))
        order = np.lexsort((np.minimum(self.rest, 8), masked))
        same = (masked[order][1:] == masked[order][:-1]) & (np.minimum(self.rest, 8)[order][1:] == np.minimum(self.rest, 8)[order][:-1])
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.append(0, ~same))
        step = 8
        while n and (rank.max() < n - 1):  # doubled prefixes until all suffixes differ
            after = np.where(self.rest > step, rank[np.minimum(at + step, n - 1)], owner - m)
            key = rank * (n + m + 1) + (after + m)
            order = np.argsort(key, kind="stable")
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.append(0, np.diff(key[order]) != 0))
            step *= 2
        before = np.append(0, raw[:n - 1]).astype(np.int64) if n else np.zeros(0, np.int64)
        before[self.first[sizes > 0]] = 256 + np.flatnonzero(sizes > 0)  # terminators, all different
        bwt = before[order]
        change = np.append(True, bwt[1:] != bwt[:-1]) if n else np.zeros(0, bool)
        heads = np.flatnonzero(change)
        self.runs = len(heads)
        # samples: text positions at run heads with their match to the suffix before,
        # and at run ends with their match to the suffix after
        inner = heads[heads > 0]
        both = self._common(order[inner - 1], order[inner])
        self.head_at, self.head_match = order[heads], np.append(np.zeros(len(heads) - len(inner), np.int64), both)
        self.end_at = np.append(order[inner - 1], order[-1:])
        self.end_match = np.append(both, np.zeros(1 if n else 0, np.int64))

    def _common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of suffixes a and b, inside their texts."""
        most = np.minimum(self.rest[a], self.rest[b])
        out = np.zeros(len(a), np.int64)
        live = np.arange(len(a))
        while len(live):
            k = out[live]
            x = self.words[np.minimum(a[live] + k, self.n - 1)] ^ self.words[np.minimum(b[live] + k, self.n - 1)]
            equal = np.zeros(len(live), np.int64)
            for j in range(8):
                equal += (equal == j) & (x >> np.uint64(56 - 8 * j) == 0)
            out[live] = np.minimum(k + equal, most[live])
            live = live[(equal == 8) & (out[live] < most[live])]
        return out

    def _stream(self, at: np.ndarray, match: np.ndarray) -> np.ndarray:
        full = np.zeros(self.n, np.int64)
        mark = np.zeros(self.n, np.int64)
        full[at] = match
        mark[at] = at
        last = np.maximum.accumulate(mark)
        return full[last] - (np.arange(self.n) - last)

    def matching_statistics(self) -> np.ndarray:
        """For every position the longest match that also starts elsewhere."""
        if not self.n:
            return np.zeros(0, np.int64)
        return np.maximum(self._stream(self.head_at, self.head_match), self._stream(self.end_at, self.end_match))


def cutter(window: int, k: int):
    """Text bytes to (keys, packed strings, first bytes)."""
    def cut(data: bytes):
        if len(data) < window:
            return (), (), ()
        keys, first, end = runs_of(np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1), window, k, window if k < window else 1)
        return keys, [data[a:b] for a, b in zip(first.tolist(), (end + window - 1).tolist())], first

    return cut


def repeats_itself(p: bytes, window: int) -> bool:
    """False only if no window of ``p`` occurs twice in it: all windows hold its
    middle, which would occur twice as well."""
    return len(p) > window and (len(p) >= 2 * window or p.find(p[len(p) - window:window], len(p) - window + 1) >= 0)


def true_runs(mask: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def reducer(window: int, hot: int, index_bytes: int = 4 << 20):
    def reduce(blocks: Iterator[Block]) -> Iterator[tuple]:
        held = Held(hot)
        for b in blocks:
            yield from held.add(b)
        bs = [b for b in held.blocks if len(b.keys)]
        if not bs:
            return
        keys = np.concatenate([b.keys for b in bs])
        packed = [p for b in bs for p in b.packed]
        counts = np.concatenate([b.counts for b in bs]).astype(np.int64)
        d, h, starts = (np.concatenate([getattr(b, x) for b in bs]) for x in ("d", "h", "starts"))
        end = np.cumsum(counts)

        def places(i: int, runs) -> Iterator[tuple]:
            for j in range(int(end[i] - counts[i]), int(end[i])):
                s = int(starts[j])
                for a, e in runs:
                    yield 0, int(d[j]), int(h[j]), s + a, s + e - 1 + window, None

        order = np.argsort(keys, kind="stable")
        sorted_keys = keys[order]
        first = np.flatnonzero(np.append(True, sorted_keys[1:] != sorted_keys[:-1]))
        last = np.append(first[1:], len(order))
        texts: list[bytes] = []
        members: list[list[int]] = []
        size = 0

        def indexed() -> Iterator[tuple]:
            index = RunIndex(texts)
            long = index.matching_statistics() >= window
            for t, a, who in zip(texts, index.first.tolist(), members):
                again = len(who) > 1 or counts[who[0]] > 1
                runs = [(0, len(t) - window + 1)] if again else true_runs(long[a:a + len(t) - window + 1])
                for i in who:
                    yield from places(i, runs)

        for a, e in zip(first.tolist(), last.tolist()):
            if e - a == 1:
                i = int(order[a])
                if counts[i] > 1:
                    yield from places(i, [(0, len(packed[i]) - window + 1)])
                    continue
                if not repeats_itself(packed[i], window):
                    continue
            group: dict[bytes, list[int]] = {}
            for i in order[a:e].tolist():
                group.setdefault(packed[i], []).append(i)
            if len(group) == 1 and e - a > 1:
                for i in order[a:e].tolist():
                    yield from places(i, [(0, len(packed[i]) - window + 1)])
                continue
            texts += group
            members += group.values()
            size += sum(map(len, group))
            if size >= index_bytes:  # a minimiser's strings are never parted
                yield from indexed()
                texts, members, size = [], [], 0
        if texts:
            yield from indexed()

    return reduce


def hot_reducer(window: int):
    """Strings are single windows: the first place of each waits for a second."""
    def reduce(blocks: Iterator[Block]) -> Iterator[tuple]:
        state: dict[bytes, tuple | None] = {}
        for b in blocks:
            a = 0
            for p, e in zip(b.packed, np.cumsum(b.counts, dtype=np.int64).tolist()):
                for j in range(a, e):
                    here = 0, int(b.d[j]), int(b.h[j]), int(b.starts[j]), int(b.starts[j]) + window, None
                    if p not in state:
                        state[p] = here
                        continue
                    if state[p] is not None:
                        yield state[p]
                        state[p] = None
                    yield here
                a = e

    return reduce


def dedup_bytes(docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = 200, k: int = 32, hot: int = 20_000,
                bucket_bytes: int = 4 << 20, copies: int = 1000) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256
    and kept (the remaining bytes) of every row."""
    ship(__name__)
    ship(row_key.__module__)
    d, spans = marked(row_key(docs, id, text), "rlbwt", cutter(window, k), cutter(window, window), reducer(window, hot), hot_reducer(window),
                      window, bucket_bytes, copies)

    def apply(texts, spans, again):
        out = []
        for t, s, whole in zip(texts_of(texts), spans.to_pylist(), again.to_pylist()):
            kept, at, gone = [], 0, 0
            runs = [(0, len(t))] if whole and len(t) >= window else merged(s)
            for a, b in runs:
                kept.append(t[at:a])
                at, gone = b, gone + b - a
            left = b"".join([*kept, t[at:]])
            out.append({"n_bytes": len(t), "n_removed": gone, "n_spans": len(runs), "kept_sha256": hashlib.sha256(left).hexdigest(), "kept": left})
        return out

    rows = with_spans(d, spans).withColumn("again", F.col("least").isNotNull())
    made = append_arrow(rows, ["text", "spans", "again"], "r", "struct<n_bytes:long,n_removed:long,n_spans:long,kept_sha256:string,kept:binary>", apply, rows=256, drop=("text", "spans", "again"))
    return made.select("doc_id", "r.*")


# Bytes as pairs of hexadecimal digits; windows are compared by their md5.
SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
win AS (SELECT r, i, md5(substr(x, 2 * i + 1, 400)) AS k FROM (SELECT r, x, unnest(range(0, length(x) // 2 - 199)) AS i FROM d WHERE length(x) >= 400)),
rep AS (SELECT r, i FROM win WHERE k IN (SELECT k FROM win GROUP BY k HAVING count(*) > 1)),
lagged AS (SELECT r, i, i > coalesce(lag(i) OVER (PARTITION BY r ORDER BY i) + 200, -1) AS starts FROM rep),
isl AS (SELECT r, i, sum(starts::INT) OVER (PARTITION BY r ORDER BY i) AS g FROM lagged),
run AS (SELECT r, g, min(i) AS a, max(i) + 200 AS e FROM isl GROUP BY r, g),
gap AS (SELECT r, e AS a, coalesce(lead(a) OVER (PARTITION BY r ORDER BY a), 4611686018427387903) AS e FROM run
        UNION ALL SELECT r, 0, min(a) FROM run GROUP BY r),
kept AS (SELECT d.r, string_agg(substr(x, 2 * gap.a + 1, least(2 * (gap.e - gap.a), length(x))), '' ORDER BY gap.a) AS x FROM gap JOIN d USING (r) GROUP BY d.r),
cnt AS (SELECT r, sum(e - a) AS n, count(*) AS s FROM run GROUP BY r)
SELECT doc_id, (length(d.x) // 2)::BIGINT AS n_bytes, coalesce(n, 0)::BIGINT AS n_removed, coalesce(s, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept.x, d.x))) AS kept_sha256
FROM d LEFT JOIN kept USING (r) LEFT JOIN cnt USING (r)
"""

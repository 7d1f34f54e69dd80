"""Substring dedup: remove every word covered by a window of ``window`` words
whose word sequence also starts in a document with a smaller id.

Windows are exchanged as super-k-mers (see :mod:`dockcast.llm.buckets`): runs
of windows with one minimiser, as one packed string of words. In a bucket the
strings are sorted by minimiser; those of a minimiser that more than one
document has are opened, and each window's sequence is compared exactly, so
hashes only decide where strings meet. Of a large group of equal texts one row
of smallest id is exchanged: all windows of the rows with larger ids start there.

Rules. Words: runs of characters other than blank and \\x09-\\x0D, unchanged.
Windows are judged on the input. Null text has no words. A null id counts as
larger than all others; rows that share an id are one document in the
comparison (neither removes the other's words) and each gets its own result.
Texts of fewer than ``window`` words keep all; very long texts are cut into
strings like any other, one text being held by its task. Empty tables give an
empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockcast.llm.buckets import Block, Held, marked, merged, mix, row_key, runs_of, with_spans
from dockcast.llm.common import append_arrow, ship, texts_of


def cutter(window: int, k: int):
    """Text bytes to (keys, packed strings, first words)."""
    known: dict[bytes, int] = {}

    def cut(data: bytes):
        words = data.split()
        if len(words) < window:
            return (), (), ()
        if len(known) > 1_000_000:
            known.clear()
        get = known.get
        hashes = []
        for w in words:
            v = get(w)
            if v is None:
                v = known[w] = zlib.crc32(w) | len(w) << 32
            hashes.append(v)
        keys, first, end = runs_of(mix(np.array(hashes, np.uint64)), window, k, 4 * window if k < window else 1)
        text = b" ".join(words)
        at = np.cumsum([0, *(len(w) + 1 for w in words)])
        return keys, [text[a:b] for a, b in zip(at[first].tolist(), (at[end + window - 1] - 1).tolist())], first

    return cut


def windows(packed: bytes, window: int) -> list[bytes]:
    words = packed.split(b" ")
    at = [0]
    for w in words:
        at.append(at[-1] + len(w) + 1)
    return [packed[at[i]:at[i + window] - 1] for i in range(len(words) - window + 1)]


def spans_below(least: list[int], d: int, h: int, start: int, window: int) -> Iterator[tuple]:
    """Covered words of one place whose windows have these smallest ids."""
    i, n = 0, len(least)
    while i < n:
        if least[i] < d:
            j = i
            while j + 1 < n and least[j + 1] < d:
                j += 1
            yield 0, d, h, start + i, start + j + window, None
            i = j + 1
        else:
            i += 1


def reducer(window: int, hot: int):
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
        low, high = np.minimum.reduceat(d, end - counts), np.maximum.reduceat(d, end - counts)
        order = np.argsort(keys, kind="stable")
        sorted_keys = keys[order]
        first = np.flatnonzero(np.append(True, sorted_keys[1:] != sorted_keys[:-1]))
        shared = np.minimum.reduceat(low[order], first) < np.maximum.reduceat(high[order], first)
        last = np.append(first[1:], len(order))
        for a, e in zip(first[shared].tolist(), last[shared].tolist()):
            group = order[a:e].tolist()
            if len({packed[i] for i in group}) == 1:  # one string: all its windows start in the smallest id
                least = int(min(low[i] for i in group))
                n = packed[group[0]].count(b" ") + 1
                for i in group:
                    for j in range(int(end[i] - counts[i]), int(end[i])):
                        if d[j] > least:
                            yield 0, int(d[j]), int(h[j]), int(starts[j]), int(starts[j]) + n, None
                continue
            best: dict[bytes, int] = {}
            opened = {}
            for i in group:
                ws = opened.get(packed[i])
                if ws is None:
                    ws = opened[packed[i]] = windows(packed[i], window)
                x = int(low[i])
                for w in ws:
                    if best.get(w, x) >= x:
                        best[w] = x
            for i in group:
                least = [best[w] for w in opened[packed[i]]]
                if min(least) < high[i]:
                    for j in range(int(end[i] - counts[i]), int(end[i])):
                        yield from spans_below(least, int(d[j]), int(h[j]), int(starts[j]), window)

    return reduce


def hot_reducer(window: int):
    """Strings are single windows: places stream by, those of the smallest id so far wait."""
    def reduce(blocks: Iterator[Block]) -> Iterator[tuple]:
        state: dict[bytes, tuple[int, list]] = {}
        for b in blocks:
            end = np.cumsum(b.counts, dtype=np.int64).tolist()
            a = 0
            for p, e in zip(b.packed, end):
                for j in range(a, e):
                    d, at = int(b.d[j]), (int(b.h[j]), int(b.starts[j]))
                    least, wait = state.get(p, (d, []))
                    if d > least:
                        yield 0, d, at[0], at[1], at[1] + window, None
                        continue
                    if d < least:
                        for h, s in wait:
                            yield 0, least, h, s, s + window, None
                        wait = []
                    wait.append(at)
                    state[p] = d, wait
                a = e

    return reduce


def dedup_words(docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = 13, k: int = 3, hot: int = 20_000,
                bucket_bytes: int = 4 << 20, copies: int = 1000) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (kept words joined by a blank)
    and kept (that text) of every row."""
    ship(__name__)
    ship(row_key.__module__)
    d, spans = marked(row_key(docs, id, text), "superkmer", cutter(window, k), cutter(window, window), reducer(window, hot), hot_reducer(window),
                      window, bucket_bytes, copies)

    def apply(texts, spans, again):
        out = []
        for t, s, whole in zip(texts_of(texts), spans.to_pylist(), again.to_pylist()):
            words = t.split()
            kept, at, gone = [], 0, 0
            for a, b in [(0, len(words))] if whole and len(words) >= window else merged(s):
                kept += words[at:a]
                at, gone = b, gone + b - a
            kept = b" ".join(kept + words[at:])
            out.append({"n_words": len(words), "n_removed": gone, "kept_sha256": hashlib.sha256(kept).hexdigest(), "kept": kept.decode()})
        return out

    rows = with_spans(d, spans).withColumn("again", F.coalesce(F.col("d") > F.col("least"), F.lit(False)))
    made = append_arrow(rows, ["text", "spans", "again"], "r", "struct<n_words:long,n_removed:long,kept_sha256:string,kept:string>", apply, rows=256, drop=("text", "spans", "again"))
    return made.select("doc_id", "r.*")


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT r, id, i, array_to_string(w[i:i + 12], ' ') AS k FROM (SELECT r, id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
low AS (SELECT k, min(id) AS id FROM win GROUP BY k),
cov AS (SELECT DISTINCT r, i + o AS i FROM (SELECT win.r, win.i FROM win JOIN low USING (k) WHERE win.id > low.id), (SELECT unnest(range(0, 13)) AS o)),
kept AS (SELECT r, i, x FROM (SELECT r, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS x FROM d) WHERE (r, i) NOT IN (SELECT (r, i) FROM cov)),
txt AS (SELECT r, string_agg(x, ' ' ORDER BY i) AS t FROM kept GROUP BY r),
gone AS (SELECT r, count(*) AS n FROM cov GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(gone.n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN txt USING (r) LEFT JOIN gone USING (r)
"""

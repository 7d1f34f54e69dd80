"""Benchmark decontamination with suffix arrays of the training text.

Each task turns its documents, some hundred thousand words at a time, into a
shard: an array of word numbers and the suffix array over it. Every suffix of
the test items is binary-searched in every shard; the equal range holds all
locations of its first ``window`` words, and each left-maximal location is
extended to the longest verbatim match. Documents never move: the test items
go to the documents, in blocks of about ``block_bytes`` of text, one narrow pass
per block. After each ``passes`` blocks what was found is written, before the
next are read: the driver and a plan hold that many blocks, whatever the size
of the benchmark. A single item of more text is a block of its own.

Training suffixes whose first words do not all occur in the test items match
no window; they are left out of the array (the result is the same).

Rules. Words: runs of ASCII letters and digits and of all non-ASCII
characters, A-Z lowered. A window is ``window`` consecutive words of an item;
an item with fewer words, but some, is one window. A document word inside any
occurrence of a window is hit. Null or empty text (document or item) has no
words: no hit, and such an item is never found. Very long texts are one
document of a shard. Repeated rows of ``docs`` each
get their own result; rows of the benchmark that share an ``item_id`` count as
one item; a null ``item_id`` counts as the id ''. Empty tables give an empty
result or no hits. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockcast.llm.common import append_arrow, free_name, ship, staged, texts_of

# Bytes to word bytes: A-Z lowered, all that is no word character to a blank.
_TABLE = bytes((b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32) for b in range(256))

MATCHES = "array<struct<start:long,length:long,item_id:string,item_start:long>>"


def words(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


class TestItems:
    """One block of test items: word numbers, the suffixes to search, and the
    items in which each suffix starts a window."""

    def __init__(self, rows: list[tuple[str, bytes]], window: int):
        self.window, self.number = window, {}
        ids, starts, lengths, owner, flat = [], [], [], [], []
        for item, text in rows:
            ws = words(text)
            if not ws:
                continue
            n, at = min(window, len(ws)), len(flat)
            flat += [self.number.setdefault(w, len(self.number) + 1) for w in ws]
            flat.append(0)
            k = len(ws) - n + 1
            starts += range(at, at + k)
            lengths += [n] * k
            owner += [len(ids)] * k
            ids.append((item, at))
        self.flat = np.array(flat + [0] * window, np.uint32)
        self.items, self.owner = ids, np.array(owner, np.int64)
        self.starts, self.lengths = np.array(starts, np.int64), np.array(lengths, np.int64)
        self.least = int(self.lengths.min()) if len(starts) else 0

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Lowest and highest key that begins with each searched suffix."""
        k = self.flat[self.starts[:, None] + np.arange(self.window)]
        past = np.arange(self.window)[None, :] >= self.lengths[:, None]
        return _key(np.where(past, 0, k)), _key(np.where(past, np.uint32(0xFFFFFFFF), k))


def _key(rows: np.ndarray) -> np.ndarray:
    """Word numbers of each row as one big-endian byte string that sorts alike."""
    n = rows.shape[1]
    return np.ascontiguousarray(rows.astype(">u4")).view(f"S{4 * n}").ravel() if len(rows) else np.empty(0, f"S{4 * n}")


def search_shard(docs: list[list[int]], test: TestItems, keys) -> list[tuple[np.ndarray, list, list]]:
    """For each document: mask of hit words, found items, longest matches."""
    size = np.array([len(d) for d in docs], np.int64)
    first = np.concatenate([[0], np.cumsum(size + 1)])  # one separator after each
    flat = np.zeros(int(first[-1]) + test.window, np.uint32)
    for a, d in zip(first, docs):
        flat[a:a + len(d)] = d
    n = int(first[-1])
    hit = np.zeros(n + 1, np.int32)
    found: list[set] = [set() for _ in docs]
    longest: list[list] = [[] for _ in docs]
    if test.least:
        stop = np.flatnonzero(flat == 0)
        run = stop[np.searchsorted(stop, np.arange(n))] - np.arange(n)
        at = np.flatnonzero(run >= test.least)
        rows = flat[at[:, None] + np.arange(test.window)] * (np.arange(test.window)[None, :] < run[at][:, None])
        key = _key(rows)
        order = np.argsort(key, kind="stable")
        array, key = at[order], key[order]  # the shard's suffix array
        lo, hi = np.searchsorted(key, keys[0], "left"), np.searchsorted(key, keys[1], "right")
        got = np.flatnonzero(hi > lo)
        step = 0
        while step < len(got):  # bounded numbers of locations at a time
            end = step + max(1, int(np.searchsorted(np.cumsum((hi - lo)[got[step:]]), 2_000_000)))
            s, step = got[step:end], end
            count = (hi - lo)[s]
            pos = array[np.repeat(lo[s] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())]
            j, length = np.repeat(test.starts[s], count), np.repeat(test.lengths[s], count)
            np.add.at(hit, pos, 1)
            np.add.at(hit, pos + length, -1)
            doc = np.searchsorted(first, pos, "right") - 1
            pair = np.unique(doc * len(test.items) + np.repeat(test.owner[s], count))
            for d, o in zip(*np.divmod(pair, len(test.items))):
                found[d].add(test.items[o][0])
            before = np.where(pos > 0, flat[pos - 1], 0)
            left = (pos == first[doc]) | (before == 0) | (np.where(j > 0, test.flat[j - 1], 0) != before)
            p, t, grown, who = pos[left], j[left], length[left].copy(), np.repeat(test.owner[s], count)[left]
            live = np.arange(len(p))
            while len(live):
                a, b = flat[p[live] + grown[live]], test.flat[t[live] + grown[live]]
                live = live[(a == b) & (a != 0)]
                grown[live] += 1
            for d, a, b, x, o in zip(doc[left], p, t, grown, who):
                longest[d].append((int(a - first[d]), int(x), test.items[o][0], int(b - test.items[o][1])))
    cover = np.cumsum(hit)[:n] > 0
    return [(cover[a:a + k], f, m) for a, k, f, m in zip(first, size, found, longest)]


def _pass(test: TestItems, shard_words: int):
    """Arrow function of one block: (text, what earlier blocks found) to what is found now."""
    def run(text, before):
        import pyarrow as pa
        keys = test.keys()
        number = test.number.get
        out, shard, n = [], [], 0

        def flush():
            out.extend(search_shard(shard, test, keys))

        for b in texts_of(text):
            ws = words(b)
            shard.append([number(w, 0) for w in ws])
            n += len(ws)
            if n >= shard_words:
                flush()
                shard, n = [], 0
        flush()
        made = []
        for (mask, items, matches), old in zip(out, before.to_pylist()):
            if old:
                mask = mask | np.unpackbits(np.frombuffer(old["mask"], np.uint8), count=len(mask)).astype(bool)
                items, matches = items | set(old["items"]), old["matches"] + [dict(zip(("start", "length", "item_id", "item_start"), m)) for m in matches]
            made.append({"n_words": len(mask), "mask": np.packbits(mask).tobytes(), "items": sorted(items), "matches": matches})
        return pa.array(made, pa.struct([("n_words", pa.int64()), ("mask", pa.binary()), ("items", pa.list_(pa.string())), ("matches", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("item_id", pa.string()), ("item_start", pa.int64())])))]))
    return run


def _summary(found):
    out = []
    for x in found.to_pylist():
        n_hit = int(np.unpackbits(np.frombuffer(x["mask"], np.uint8), count=x["n_words"]).sum()) if x["n_words"] else 0
        out.append({"n_words": x["n_words"], "n_hit": n_hit, "n_items": len(x["items"]), "items_sha256": hashlib.sha256(",".join(x["items"]).encode()).hexdigest(),
                    "contaminated": n_hit > 0, "longest": max((m["length"] for m in x["matches"]), default=0), "items": x["items"],
                    "matches": sorted(x["matches"], key=lambda m: (m["start"], m["item_id"], m["item_start"]))})
    return out


def mark(docs: DataFrame, benchmark: DataFrame, out: str, text: str = "text", item_id: str = "item_id", item_text: str = "text",
         window: int = 10, block_bytes: int = 8 << 20, shard_words: int = 300_000, passes: int = 8) -> DataFrame:
    """All columns of ``docs`` and a struct ``out``: n_words, n_hit, n_items,
    items_sha256, contaminated, longest (words of the longest match), items,
    matches (every left-maximal match: start word, length, item, word of the item)."""
    ship(__name__)
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), F.coalesce(F.col(item_text), F.lit("")).cast("binary").alias("text")) \
                     .filter(F.length("text") > 0)
    size = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first()["n"]
    blocks = 1 + int(2 * size // block_bytes) if size > block_bytes else 1
    kind = f"struct<n_words:long,mask:binary,items:array<string>,matches:{MATCHES}>"
    acc = free_name(docs, "_found")
    df = docs.withColumn(acc, F.lit(None).cast(kind))
    if blocks > 1:
        items = staged(items.distinct(), "test-items")
    for b in range(blocks):  # a block is collected and sent with the pass's tasks
        part = items if blocks == 1 else items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b)
        test = TestItems([(r["item"], bytes(r["text"])) for r in part.sort("item", "text").collect()], window)
        sent = free_name(df, "_next")
        df = append_arrow(df, [text, acc], sent, kind, _pass(test, shard_words)).drop(acc).withColumnRenamed(sent, acc)
        if b % passes == passes - 1 and b < blocks - 1:
            df = staged(df, "test-passes")
    made = f"struct<n_words:long,n_hit:long,n_items:long,items_sha256:string,contaminated:boolean,longest:long,items:array<string>,matches:{MATCHES}>"
    return append_arrow(df, [acc], out, made, _summary).drop(acc)


def find_leaks(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", **kw) -> DataFrame:
    """One row per row of ``docs``: the id and the fields of :func:`mark`."""
    d = docs.select(F.col(id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return mark(d, benchmark, "found", **kw).select("doc_id", "found.*")


def remove_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", **kw) -> DataFrame:
    """The rows of ``docs`` in which no test window occurs, all columns kept."""
    out = free_name(docs, "_leak")
    return mark(docs, benchmark, out, text=text, **kw).filter(~F.col(f"`{out}`.contaminated")).drop(out)


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT row_number() OVER () AS b, coalesce(item_id::VARCHAR, '') AS item,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT b, item, n, j, array_to_string(w[j:j + n - 1], ' ') AS k
       FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS j FROM (SELECT *, least(10, len(w)) AS n FROM b WHERE len(w) > 0))),
dw AS (SELECT r, n, p, array_to_string(w[p:p + n - 1], ' ') AS k
       FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
hit AS (SELECT r, b, item, n, p, j FROM dw JOIN bw USING (n, k)),
cov AS (SELECT r, count(DISTINCT p + o) AS n_hit FROM (SELECT DISTINCT r, p, n FROM hit), (SELECT unnest(range(0, 10)) AS o) WHERE o < n GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r),
isl AS (SELECT r, b, n, p - j AS diag, p - row_number() OVER (PARTITION BY r, b, p - j ORDER BY p) AS g FROM hit),
lon AS (SELECT r, max(m) AS longest FROM (SELECT r, count(*) + any_value(n) - 1 AS m FROM isl GROUP BY r, b, diag, g) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated, coalesce(longest, 0)::BIGINT AS longest
FROM d LEFT JOIN cov USING (r) LEFT JOIN its USING (r) LEFT JOIN lon USING (r)
"""

"""Ranked lexical search with hashed max-sketches.

**Index** (one pass over the texts, written to the checkpoint folder): each
document's term impacts are folded into a sketch of 65,536 hashed coordinates,
each the maximum over the terms that hash to it. The impact of a term grows
with its count in the document once the document's length is known, so the
sketch holds the largest *count* per coordinate (one byte; 255 stands for any
larger count) and serves whatever the corpus averages turn out to be. Only
coordinates that are not zero are stored. Beside the rows, each task writes
partial counts of the documents that hold a term.

**Search**: items are taken in blocks of bounded size. A block's weights, by
coordinate, travel with the tasks; a lookup of a batch of sketches gives an
upper bound of every (document, item) score. The ``first`` highest bounds of
each item are rescored on the whole texts; the k-th exact score is the item's
threshold, and then every document whose bound still reaches it, in descending
bounds, is rescored. No document below is able to enter, so the ranks are
exact; nothing is capped.

Results: one row per (item, rank) with score above 0. Null and empty texts
have no terms, as documents (never found, not counted in N) and as items (no
rows). Equal scores go by ascending doc_id, a null doc_id last. Repeated
document rows are documents of their own; repeated item rows are items of
their own. Very long texts are read whole. Empty tables give an empty result.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from dataclasses import dataclass
from itertools import islice

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockcast.llm.common import expand, ship, staged, texts_of

SLOTS = 1 << 16
FULL = 255               # this count or more
TOP_IMPACT = 1_000_000   # no impact is above
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased."""
    return text.translate(FOLD).split()


def norm(n, n_docs: int, n_terms: int):
    """A document's length against the mean, as used by :func:`impact`."""
    return 75 + (25 * n * n_docs) // n_terms


def impact(tf, m):
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


# ------------------------------------------------------------------ index

@dataclass
class Index:
    rows: DataFrame   # key, doc_id, text, n, slots, tops: one row per document
    holds: DataFrame  # term, df: partial counts, several rows per term
    n_docs: int       # documents with at least one term
    n_terms: int      # all their terms


def _sketches(vocab: int):
    """Map function: documents to rows of the index, and partial counts of
    terms (at most ``vocab`` of them held at once)."""
    import pyarrow as pa

    def fold(table, slot_of):
        texts = texts_of(table.column("text"))
        n, doc, slot, tf, seen = [], [], [], [], []
        for i, t in enumerate(texts):
            words = terms(t)
            c = Counter(words)
            n.append(len(words))
            doc.append(len(c))
            tf.extend(c.values())
            for w in c:
                s = slot_of.get(w)
                if s is None:
                    s = slot_of[w] = zlib.crc32(w) & (SLOTS - 1)
                slot.append(s)
            seen.append(c.keys())
        where = np.repeat(np.arange(len(texts), dtype=np.int64), doc) * SLOTS + np.array(slot, np.int64)
        order = np.argsort(where, kind="stable")
        where = where[order]
        top = np.minimum(np.array(tf, np.int64), FULL)[order]
        first = np.flatnonzero(np.r_[True, where[1:] != where[:-1]]) if len(where) else np.zeros(0, np.int64)
        top = np.maximum.reduceat(top, first).astype(np.uint8) if len(first) else np.zeros(0, np.uint8)
        where = where[first]
        ends = np.searchsorted(where, (np.arange(len(texts)) + 1) * SLOTS).astype(np.int32)
        ends = np.r_[np.int32(0), ends]

        def packed(data, size):
            return pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer((ends * size).astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())])
        return n, packed((where % SLOTS).astype(np.uint16), 2), packed(top, 1), seen

    held_type = pa.list_(pa.struct([("term", pa.string()), ("df", pa.int64())]))

    def counts(held, id_type):
        pairs = iter(held.items())
        while part := list(islice(pairs, 10_000)):
            made = [[{"term": t.decode("utf-8", "replace"), "df": k} for t, k in part]]
            yield pa.RecordBatch.from_arrays([pa.nulls(1, id_type), pa.nulls(1, pa.string()), pa.array([-1], pa.int64()), pa.array([b""], pa.binary()),
                                              pa.array([b""], pa.binary()), pa.array(made, held_type)], names=["doc_id", "text", "n", "slots", "tops", "held"])

    def run(batches):
        held, slot_of, id_type = Counter(), {}, None
        for whole in batches:
            id_type = whole.column(0).type
            for i in range(0, whole.num_rows, 512):
                b = whole.slice(i, 512)
                n, slots, tops, seen = fold(b, slot_of)
                for s in seen:
                    held.update(s)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()), slots, tops, pa.nulls(b.num_rows, held_type)],
                                                 names=["doc_id", "text", "n", "slots", "tops", "held"])
                if len(held) > vocab:
                    yield from counts(held, id_type)
                    held.clear()
                if len(slot_of) > vocab:
                    slot_of.clear()
        if held:
            yield from counts(held, id_type)
    return run


def build_index(docs: DataFrame, id: str = "doc_id", text: str = "text", vocab: int = 300_000) -> Index:
    """Sketch every document; the index lives in the checkpoint folder."""
    ship(__name__)
    d = docs.select(F.col(id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([d.schema["doc_id"], T.StructField("text", T.StringType()), T.StructField("n", T.LongType()), T.StructField("slots", T.BinaryType()),
                           T.StructField("tops", T.BinaryType()), T.StructField("held", T.ArrayType(T.StructType([T.StructField("term", T.StringType()), T.StructField("df", T.LongType())])))])
    made = staged(d.mapInArrow(_sketches(vocab), schema).withColumn("key", F.monotonically_increasing_id()), "sketches")
    rows = made.filter("n >= 0").drop("held")
    total = rows.filter("n > 0").agg(F.count("n").alias("n"), F.sum("n").alias("l")).first()
    return Index(rows, made.filter("n < 0").select(F.explode("held").alias("h")).select("h.term", "h.df"), total["n"], total["l"] or 0)


# ------------------------------------------------------------------ search

class Block:
    """The items of a block as weights by coordinate (for bounds) and by term
    (for scores)."""

    def __init__(self, texts: list[bytes], df: dict[bytes, int], n_docs: int, n_terms: int):
        self.n_docs, self.n_terms, self.items = n_docs, n_terms, len(texts)
        self.term: dict[bytes, int] = {}
        by_term: list[list[tuple[int, int]]] = []
        for q, t in enumerate(texts):
            for word, times in Counter(terms(t)).items():
                w = weight(df[word], n_docs) if word in df else 0
                if w > 0:
                    i = self.term.setdefault(word, len(by_term))
                    if i == len(by_term):
                        by_term.append([])
                    by_term[i].append((q, w * times))
        self.exact = self._rows(by_term)
        merged: dict[int, Counter] = {}
        for word, i in self.term.items():
            c = merged.setdefault(zlib.crc32(word) & (SLOTS - 1), Counter())
            for q, w in by_term[i]:
                c[q] += w
        self.lookup = np.full(SLOTS, -1, np.int32)
        self.lookup[np.array(list(merged), np.int64)] = np.arange(len(merged))
        self.bound = self._rows([list(c.items()) for c in merged.values()])

    @staticmethod
    def _rows(lists):
        at = np.cumsum([0, *map(len, lists)])
        flat = [x for row in lists for x in row]
        return at, np.array([q for q, _ in flat], np.int64), np.array([w for _, w in flat], np.int64)

    def _sums(self, rows, doc, slot, f, docs: int):
        """Σ weight × f by (document, item): the cells that are not zero."""
        at, item, w = rows
        count = at[slot + 1] - at[slot]
        x = expand(at[slot], count)
        cell = np.repeat(doc, count) * self.items + item[x]
        part = w[x] * np.repeat(f, count)
        size = docs * self.items  # summed in two halves: doubles hold each exactly
        total = np.bincount(cell, part >> 20, size).astype(np.int64) * (1 << 20) + np.bincount(cell, part & ((1 << 20) - 1), size).astype(np.int64)
        hit = np.flatnonzero(total)
        return hit // self.items, hit % self.items, total[hit]

    def bounds(self, n, slots, tops):
        """(row, item, bound) of a batch; arrays of lengths and lists of packed sketches."""
        for lo, hi in self._parts(np.array([len(t) for t in tops])):
            doc = np.repeat(np.arange(hi - lo), [len(t) for t in tops[lo:hi]])
            slot = self.lookup[np.frombuffer(b"".join(slots[lo:hi]), np.uint16)]
            tf = np.frombuffer(b"".join(tops[lo:hi]), np.uint8)
            known = slot >= 0
            doc, slot, tf = doc[known], slot[known].astype(np.int64), tf[known].astype(np.int64)
            f = np.where(tf == FULL, TOP_IMPACT, impact(tf, norm(n[lo:hi], self.n_docs, self.n_terms)[doc]))
            d, q, b = self._sums(self.bound, doc, slot, f, hi - lo)
            yield d + lo, q, b

    def scores(self, text: bytes):
        """(items, scores) of one text."""
        words = terms(text)
        known = [(self.term[w], k) for w, k in Counter(words).items() if w in self.term]
        if not known:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        term, tf = np.array(known, np.int64).T
        _, q, s = self._sums(self.exact, np.zeros(len(term), np.int64), term, impact(tf, norm(len(words), self.n_docs, self.n_terms)), 1)
        return q, s

    def _parts(self, sizes, cells: int = 1 << 21):
        """Slices of a batch whose (document, item) cells and lookups stay bounded."""
        per = np.maximum(np.minimum(sizes, len(self.bound[0])) * max(1, len(self.bound[1]) // max(1, len(self.bound[0]) - 1)), self.items)
        group = np.cumsum(per) // cells
        cuts = [0, *(np.flatnonzero(group[1:] != group[:-1]) + 1).tolist(), len(sizes)]
        return [(a, b) for a, b in zip(cuts, cuts[1:]) if a < b]


BOUND = "q long, key long, id long, bound long"
LAST = (1 << 63) - 1


def _ids(column):
    """Ids as 64-bit integers for ties; null, or ids of another type, last."""
    import pyarrow as pa
    if not pa.types.is_integer(column.type):
        return np.full(len(column), LAST)
    return column.cast(pa.int64()).fill_null(LAST).to_numpy(zero_copy_only=False)


def _highest(block, first: int):
    """Map function: the ``first`` highest bounds of each item in a task."""
    import pyarrow as pa

    def best(x):
        q, b, i, k = x
        order = np.lexsort((k, i, -b, q))
        q = q[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        return [c[order][place < first] for c in x]

    def run(batches):
        t = block.value
        floor = np.zeros(t.items, np.int64)
        held, waiting, size = [np.zeros(0, np.int64) for _ in range(4)], [], 0
        for rows in batches:
            n, keys, ids = rows.column("n").to_numpy(), rows.column("key").to_numpy(), _ids(rows.column("doc_id"))
            for d, q, b in t.bounds(n, rows.column("slots").to_pylist(), rows.column("tops").to_pylist()):
                use = b >= floor[q]
                waiting.append((q[use], b[use], ids[d[use]], keys[d[use]]))
                size += int(use.sum())
                if size > max(200_000, 2 * first * t.items):
                    held = best([np.concatenate([h, *w]) for h, w in zip(held, zip(*waiting))])
                    waiting, size = [], 0
                    full = np.bincount(held[0], minlength=t.items) >= first
                    low = np.full(t.items, LAST)
                    np.minimum.at(low, held[0], held[1])
                    floor = np.where(full, low, 0)
        if waiting:
            held = best([np.concatenate([h, *w]) for h, w in zip(held, zip(*waiting))])
        q, b, i, k = held
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (q, k, i, b)], names=["q", "key", "id", "bound"])
    return run


def _reaching(block, limits):
    """Map function: all bounds that reach an item's threshold, but those
    rescored before. ``limits``: per item the last one rescored (bound, id,
    key) and the k-th score and id."""
    import pyarrow as pa

    def run(batches):
        t = block.value
        last_b, last_i, last_k, least, at = limits.value
        for rows in batches:
            n, keys, ids = rows.column("n").to_numpy(), rows.column("key").to_numpy(), _ids(rows.column("doc_id"))
            for d, q, b in t.bounds(n, rows.column("slots").to_pylist(), rows.column("tops").to_pylist()):
                i, k = ids[d], keys[d]
                after = (b < last_b[q]) | (b == last_b[q]) & ((i > last_i[q]) | (i == last_i[q]) & (k > last_k[q]))
                use = after & ((b > least[q]) | (b == least[q]) & (i <= at[q]))
                yield pa.RecordBatch.from_arrays([pa.array(x[use], pa.int64()) for x in (q, k, i, b)], names=["q", "key", "id", "bound"])
    return run


def _rescore(index: Index, block, found: DataFrame, few: bool) -> DataFrame:
    """q, doc_id, key, bound, score of candidates, on the whole texts. A text
    comes once, with all its items (at most a block's)."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_type

    asked = found.groupBy("key").agg(F.collect_list(F.struct("q", "bound")).alias("asked"))
    id_field = index.rows.schema["doc_id"]
    id_type = to_arrow_type(id_field.dataType)

    def run(batches):
        t = block.value
        for rows in batches:
            out = []
            for key, doc, text, asked in zip(rows.column("key").to_pylist(), rows.column("doc_id").to_pylist(), texts_of(rows.column("text")), rows.column("asked").to_pylist()):
                q, s = t.scores(text)
                score = dict(zip(q.tolist(), s.tolist()))
                out += [(a["q"], doc, key, a["bound"], score.get(a["q"], 0)) for a in asked]
            cols = list(zip(*out)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(cols, (pa.int64(), id_type, pa.int64(), pa.int64(), pa.int64()))],
                                             names=["q", "doc_id", "key", "bound", "score"])

    schema = T.StructType([T.StructField("q", T.LongType()), id_field, *[T.StructField(c, T.LongType()) for c in ("key", "bound", "score")]])
    texts = index.rows.select("key", "doc_id", "text")
    return texts.join(F.broadcast(asked) if few else asked, "key").mapInArrow(run, schema).filter("score > 0")


def _ranked(df: DataFrame, k: int, *order) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(*order))).filter(F.col("rank") <= k)


def search(index: Index, items: DataFrame, item_id: str = "item_id", text: str = "text", k: int = 20, first: int = 64,
           block_bytes: int = 1 << 20, block_items: int = 1024) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of every item."""
    ship(__name__)
    first = max(first, k)
    spark = items.sparkSession
    by_score = (F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("key"))
    asked = staged(items.select(F.col(item_id).alias("item_id"), F.col(text).cast("string").cast("binary").alias("text")).filter(F.length("text") > 0)
                   .withColumn("row", F.monotonically_increasing_id()), "items")
    size = asked.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("b"), F.count("text").alias("n")).first()
    blocks = 1 + 2 * max(size["b"] // block_bytes, size["n"] // block_items)
    out = None
    for b in range(blocks):
        mine = asked if blocks == 1 else asked.filter(F.pmod(F.xxhash64("row"), F.lit(blocks)) == b)
        rows = [(r["row"], bytes(r["text"])) for r in mine.select("row", "text").sort("row").collect()]  # a block: bounded
        if not rows or not index.n_docs:
            continue
        words = sorted({w for _, t in rows for w in terms(t)})
        wanted = spark.createDataFrame([(w.decode("utf-8", "replace"),) for w in words], "term string")
        df = {r["term"].encode(): r["df"] for r in index.holds.join(F.broadcast(wanted), "term").groupBy("term").agg(F.sum("df").alias("df")).collect()}
        block = spark.sparkContext.broadcast(Block([t for _, t in rows], df, index.n_docs, index.n_terms))
        sketches = index.rows.filter("n > 0").select("doc_id", "key", "n", "slots", "tops")

        top = staged(_ranked(sketches.mapInArrow(_highest(block, first), BOUND), first, F.desc("bound"), F.asc("id"), F.asc("key")), "top")
        scored = staged(_rescore(index, block, top, few=True), "scored")
        last_b, last_i, last_k, least, at = (np.zeros(len(rows), np.int64) for _ in range(5))
        least[:] = 1  # fewer than k found: whatever scores at all
        at[:] = LAST
        for r in top.filter(F.col("rank") == first).collect():  # one row per item
            last_b[r["q"]], last_i[r["q"]], last_k[r["q"]] = r["bound"], r["id"], r["key"]
        whole = isinstance(scored.schema["doc_id"].dataType, T.IntegralType)
        for r in _ranked(scored, k, *by_score).filter(F.col("rank") == k).collect():
            least[r["q"]] = r["score"]
            at[r["q"]] = r["doc_id"] if whole and r["doc_id"] is not None else LAST
        limits = spark.sparkContext.broadcast((last_b, last_i, last_k, least, at))
        more = staged(_rescore(index, block, sketches.mapInArrow(_reaching(block, limits), BOUND), few=False), "scored")
        best = _ranked(scored.unionByName(more), k, *by_score)
        names = spark.createDataFrame([(i, r) for i, (r, _) in enumerate(rows)], "q long, row long")
        best = staged(best.join(F.broadcast(names), "q").drop("q", "key", "bound"), "ranks")
        out = best if out is None else out.unionByName(best)
    if out is None:
        return spark.createDataFrame([], T.StructType([asked.schema["item_id"], T.StructField("rank", T.IntegerType(), False), index.rows.schema["doc_id"], T.StructField("score", T.LongType())]))
    return out.join(asked.select("row", "item_id"), "row").select("item_id", "rank", "doc_id", "score")


SQL = r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
d AS (SELECT r, doc_id, len(w)::BIGINT AS n, w FROM t WHERE len(w) > 0),
c AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM d),
m AS (SELECT r, doc_id, 75 + (25 * n * n_docs) // n_terms AS m FROM d, c),
i AS (SELECT row_number() OVER () AS q, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark),
it AS (SELECT q, item_id, term, count(*)::BIGINT AS times FROM (SELECT q, item_id, unnest(w) AS term FROM i) GROUP BY ALL),
tf AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM it) GROUP BY ALL),
df AS (SELECT term, count(*)::BIGINT AS df FROM tf GROUP BY term),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM df, c),
s AS (SELECT q, item_id, r, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
      FROM it JOIN w USING (term) JOIN tf USING (term) JOIN m USING (r) GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id ASC NULLS LAST) AS k FROM s WHERE score > 0)
SELECT item_id, k::INTEGER AS rank, doc_id, score FROM k WHERE k <= 20
"""

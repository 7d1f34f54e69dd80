"""Near-duplicate groups by HyperMinHash.

A text's set of 64-bit shingle hashes is dealt into ``REGISTERS`` buckets by
its top bits; of the smallest hash in a bucket only the leading-zero count (6
bits) and the 10 bits after the first one are stored. An empty bucket takes the
register of another by a fixed probe order. Bands of registers group the
texts; inside a group the Jaccard similarity is estimated from equal registers,
corrected for chance collisions, and pairs that pass are confirmed on the full
shingle sets.

Texts with equal sets are one class from the start, so copies make no pairs.
Round one pairs each member of a band group with the group's first class, and
the confirmed links are joined into components. Round two takes the groups that
still hold several components and compares their members across components
inside tasks, in blocks of ``block`` classes: sketches first, then the full
sets of pairs that pass, best estimates first; no pair inside a component is
tried, and only links that join components leave a task. So no link that
shares a band is lost, and what is shuffled or written for a group of near
copies grows with its size, not its square.

Chances: at similarity 0.85, 32 bands of 6 registers miss a link with
probability 3e-7; the estimate has a standard error of 0.024 there from
``SMALL`` shingles up and drops only pairs estimated ``slack`` = 0.12 below the
limit. In a smaller set one shingle fills many registers, so an estimate drops
no pair of one; there, pairs go whose sizes alone keep them from the limit.

Scale: sketches are 512 bytes a text; band groups come from a partially
aggregated count; joins on hot keys are plain equi-joins that Spark splits;
the sets of a hot first class's partners are confirmed in parts of ``block``.
Nothing is collected; intermediate tables are written to the checkpoint folder.

Rules. A-Z is lowered; words are runs of characters other than blank and
\\x09-\\x0D; shingles are five words; a text of fewer words, but some, is one
shingle; without words the set is empty and linked with nothing. A null id
never names a component unless all its rows have null ids; then component_id
is null and kept is true. Repeated rows are one class. Empty tables give an
empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockcast.llm.buckets import mix, part_hashes, row_key
from dockcast.llm.common import append_arrow, ship, staged, texts_of

REGISTERS, BANDS, BAND = 256, 32, 6
MANTISSA = 10
SMALL = 64  # shingles; estimates of smaller sets drop no pair


def shingles(text: bytes, known: dict, n: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-word shingles."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(known) > 1_000_000:
        known.clear()
    hashes = []
    get = known.get
    for w in words:
        v = get(w)
        if v is None:
            v = known[w] = int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little")
        hashes.append(v)
    units = np.array(hashes, np.uint64)
    k = min(n, len(units))
    out = part_hashes(units, k)
    if k < n:  # sequences of different lengths stay different
        out = mix(out + np.uint64(k))
    return np.unique(out)


def probe_order() -> np.ndarray:
    """Which other buckets an empty one asks, attempt by attempt."""
    return np.random.default_rng(1).integers(0, REGISTERS, (24, REGISTERS))


def sketch(hashes: np.ndarray, probes: np.ndarray) -> np.ndarray:
    """Registers of a non-empty sorted set."""
    shift = np.uint64(64 - 8)
    bucket, first = np.unique(hashes >> shift, return_index=True)
    value = hashes[first] << np.uint64(8)  # the bits below the bucket's, at the top
    # leading zeros, exactly: halve the search
    zeros, x = np.zeros(len(value), np.int64), value.copy()
    for s in (32, 16, 8, 4, 2, 1):
        high = x >> np.uint64(64 - s) == 0
        zeros += np.where(high, s, 0)
        x = np.where(high, x << np.uint64(s), x)
    zeros = np.minimum(zeros, 63)
    reg = np.full(REGISTERS, -1, np.int64)
    reg[bucket.astype(np.int64)] = zeros << MANTISSA | ((x << np.uint64(1)) >> np.uint64(64 - MANTISSA)).astype(np.int64)
    full = reg >= 0
    out = reg.copy()
    empty = np.flatnonzero(~full)
    for asked in probes:
        if not len(empty):
            break
        out[empty] = reg[asked[empty]]
        empty = empty[out[empty] < 0]
    if len(empty):  # the next one that is not empty
        there = np.flatnonzero(full)
        out[empty] = reg[there[np.searchsorted(there, empty) % len(there)]]
    return out.astype(np.uint16)


def chance(n_a, n_b) -> np.ndarray:
    """Probability that registers of disjoint sets of these sizes agree."""
    i = np.arange(0, 56)[:, None]
    def zeros(n):
        rate = np.maximum(np.asarray(n, float) / REGISTERS, 1.0)
        return np.exp(-rate * 2.0 ** -(i + 1.0)) - np.exp(-rate * 2.0 ** -i)
    return (zeros(n_a) * zeros(n_b)).sum(0) / 2 ** MANTISSA


def estimate(equal: np.ndarray, n_a, n_b) -> np.ndarray:
    """Jaccard similarity from equal registers, corrected for chance."""
    c = chance(n_a, n_b)
    return (equal / REGISTERS - c) / (1 - c)


def promising(est: np.ndarray, n_a, n_b, least: float, min_pct: int) -> np.ndarray:
    """Which pairs are to be confirmed on their full sets."""
    few, many = np.minimum(n_a, n_b), np.maximum(n_a, n_b)
    return np.where(few < SMALL, 100 * few >= min_pct * many, est >= least)


def sketched(docs: DataFrame) -> DataFrame:
    """doc_id, d, h, set (digest of the shingle set; null if empty), n, regs."""
    known: dict = {}
    probes = probe_order()

    def run(column):
        out = []
        for t in texts_of(column):
            s = shingles(t, known)
            out.append({"set": hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None, "n": len(s), "regs": sketch(s, probes).tobytes() if len(s) else None})
        return out

    return append_arrow(docs, ["text"], "s", "struct<set:binary,n:long,regs:binary>", run, drop=("text",)).select("doc_id", "d", "h", "s.set", "s.n", "s.regs")


def passing(pairs: DataFrame, sketches: DataFrame, least: float, min_pct: int) -> DataFrame:
    """Pairs (a, b) that are :func:`promising`."""
    one = sketches.select(F.col("set").alias("a"), F.col("n").alias("na"), F.col("regs").alias("ra"))
    two = sketches.select(F.col("set").alias("b"), F.col("n").alias("nb"), F.col("regs").alias("rb"))

    def run(na, ra, nb, rb):
        if not len(na):
            return []
        x, y = (np.frombuffer(b"".join(r.to_pylist()), np.uint16).reshape(-1, REGISTERS) for r in (ra, rb))
        a, b = na.to_numpy(), nb.to_numpy()
        return promising(estimate((x == y).sum(1), a, b), a, b, least, min_pct).tolist()

    both = pairs.join(two, "b").join(one, "a")
    return append_arrow(both, ["na", "ra", "nb", "rb"], "ok", "boolean", run).filter("ok").select("a", "b")


def confirmed(pairs: DataFrame, texts: DataFrame, min_pct: int, block: int) -> DataFrame:
    """Pairs (a, b) linked by their full sets. A class a with many partners is
    dealt into parts of about ``block``; its text goes to each part once."""
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / F.lit(block)).alias("parts"))
    right = pairs.join(parts, "a").withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts"))) \
        .join(texts.select(F.col("set").alias("b"), F.col("data").alias("data")), "b").select("a", "part", "b", "data")
    left = parts.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")) \
        .join(texts.select(F.col("set").alias("a"), "data"), "a").select("a", "part", F.lit(None).cast("binary").alias("b"), "data")
    rows = left.unionByName(right).repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())

    def run(batches):
        import pyarrow as pa
        known: dict = {}
        now, mine = None, None
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                links = []
                part = batch.slice(i, 256)
                for a, p, b, data in zip(*[part.column(c).to_pylist() for c in ("a", "part", "b", "data")]):
                    s = shingles(data, known)
                    if b is None:
                        now, mine = (a, p), s
                    elif now == (a, p):
                        both = len(np.intersect1d(mine, s, assume_unique=True))
                        if 100 * both >= min_pct * (len(mine) + len(s) - both):
                            links.append((a, b))
                if links:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*links)], names=["a", "b"])

    return rows.mapInArrow(run, "a binary, b binary")


def components(edges: DataFrame, name: str) -> DataFrame:
    """(v, label): label is the least vertex of v's component. Large-star and
    small-star steps in turn, each on partially aggregated minima, until the
    edges no longer change."""
    def state(e: DataFrame):
        r = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        return r["n"], r["s"]

    def star(e: DataFrame, large: bool) -> DataFrame:
        # e has a > b; each vertex's least neighbour, itself included
        near = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else e
        least = near.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        out = near.join(least, "a")
        if large:
            return out.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        out = out.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        return out.filter(F.col("a") > F.col("b")).distinct()

    e = staged(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct(), name)
    now = state(e)
    while now[0]:
        e = staged(star(star(e, True), False), name)
        before, now = now, state(e)
        if now == before:
            break
    return e.select(F.col("a").alias("v"), F.col("b").alias("label")).unionByName(e.select(F.col("b").alias("v"), F.col("b").alias("label")).distinct())


def across(rows: DataFrame, least: float, min_pct: int, block: int) -> DataFrame:
    """Links (a, b) between different labels of a band group. rows: key, set,
    label, n, regs, data. Members whose pair is promising are confirmed on their
    full sets inside the task, best estimate first, and a link joins two
    labels, so a unit yields fewer links than it has labels. Groups above
    ``block`` rows are compared block against block, each two in a unit."""
    size = rows.groupBy("key").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("blocks"))
    r = rows.join(size, "key").withColumn("own", F.pmod(F.xxhash64("set"), F.col("blocks")).cast("int"))
    r = r.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
    r = r.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "set").select("key", "i", "j", "own", "set", "label", "n", "regs", "data")

    def linked(g: list, known: dict) -> list:
        labels = np.unique([x[5].hex() for x in g], return_inverse=True)[1]
        if labels.max() == 0:
            return []
        regs = np.frombuffer(b"".join(x[7] for x in g), np.uint16).reshape(-1, REGISTERS)
        n, own = np.array([x[6] for x in g]), np.array([x[3] for x in g])
        one_block = g[0][1] == g[0][2]
        pairs = []
        for x in range(len(g) - 1):
            rest = x + 1 + np.flatnonzero((labels[x + 1:] != labels[x]) & (one_block | (own[x + 1:] != own[x])))
            est = estimate((regs[rest] == regs[x]).sum(1), np.full(len(rest), n[x]), n[rest])
            ok = promising(est, n[x], n[rest], least, min_pct)
            pairs.append(np.stack([est[ok], np.full(ok.sum(), x), rest[ok]]))
        est, xs, ys = np.concatenate(pairs, 1)
        up, sets, found = list(range(labels.max() + 1)), {}, []

        def root(i):
            while up[i] != i:
                up[i] = up[up[i]]
                i = up[i]
            return i

        def full(i):
            if i not in sets:
                sets[i] = shingles(g[i][8], known)
            return sets[i]

        for k in np.argsort(-est, kind="stable").tolist():
            x, y = int(xs[k]), int(ys[k])
            p, q = root(labels[x]), root(labels[y])
            if p != q and 100 * (both := len(np.intersect1d(full(x), full(y), assume_unique=True))) >= min_pct * (n[x] + n[y] - both):
                up[p] = q
                found.append((g[x][4], g[y][4]))
        return found

    def run(batches):
        import pyarrow as pa
        from itertools import groupby
        known: dict = {}

        def each():
            for b in batches:
                for i in range(0, b.num_rows, 512):
                    part = b.slice(i, 512)
                    yield from zip(*[part.column(c).to_pylist() for c in ("key", "i", "j", "own", "set", "label", "n", "regs", "data")])

        for _, g in groupby(each(), key=lambda x: x[:3]):
            if found := linked(list(g), known):
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*found)], names=["a", "b"])

    return r.mapInArrow(run, "a binary, b binary").distinct()


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", min_pct: int = 85, slack: float = 0.12, block: int = 500) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, and d and h (which name the row)
    of every row."""
    ship(__name__)
    ship(row_key.__module__)
    d = row_key(docs, id, text)
    s = staged(sketched(d), "hmh-sketches")
    classes = s.filter("set is not null").groupBy("set").agg(F.min("doc_id").alias("rep"), F.min(F.struct("d", "h")).alias("at"), F.min("n").alias("n"), F.min("regs").alias("regs"))
    classes = staged(classes, "hmh-classes")
    band = F.explode(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(i, F.substring("regs", i * (2 * BAND) + 1, F.lit(2 * BAND)))))
    bands = classes.select(band.alias("key"), "set")
    groups = bands.groupBy("key").agg(F.count("*").alias("size"), F.min("set").alias("first")).filter("size > 1")
    members = staged(bands.join(groups.select("key", "first"), "key"), "hmh-members")

    least = min_pct / 100 - slack
    star = members.filter("set <> first").select(F.col("first").alias("a"), F.col("set").alias("b")).distinct()
    involved = members.select("set").distinct().join(classes, "set")
    involved = staged(involved.select("set", "at.d", "at.h", "n", "regs"), "hmh-involved")
    texts = d.join(involved.select("d", "h", "set"), ["d", "h"]).select("set", F.col("text").cast("binary").alias("data")).dropDuplicates(["set"])
    texts = staged(texts, "hmh-texts")
    links = staged(confirmed(staged(passing(star, involved, least, min_pct), "hmh-pairs"), texts, min_pct, block), "hmh-links")
    labels = components(links, "hmh-cc")

    r = members.select("key", "set").join(labels.withColumnRenamed("v", "set"), "set", "left").withColumn("label", F.coalesce("label", "set"))
    open_groups = r.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi").select("key")
    r = r.join(open_groups, "key").join(involved.select("set", "n", "regs"), "set").join(texts, "set")
    more = staged(across(r, least, min_pct, block), "hmh-across")
    if not more.isEmpty():
        links = links.unionByName(more)
        labels = components(links, "hmh-cc2")
    labels = labels.withColumnRenamed("v", "set")
    comp = classes.select("set", "rep").join(labels, "set").groupBy("label").agg(F.min("rep").alias("smallest"))
    named = classes.select("set", "rep").join(labels, "set", "left").join(comp, "label", "left").select("set", F.coalesce("smallest", "rep").alias("component"))
    out = s.select("doc_id", "d", "h", "set", "n").join(named, "set", "left")
    comp_id = F.when(F.col("set").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), comp_id.alias("component_id"), F.col("doc_id").eqNullSafe(comp_id).alias("kept"), "d", "h")


_SQL = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (SELECT DISTINCT r, s FROM (SELECT r, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0))),
n AS (SELECT r, count(*) AS n FROM sh GROUP BY r),
st AS (SELECT r, n, md5(string_agg(s, chr(10) ORDER BY s)) AS k FROM sh JOIN n USING (r) GROUP BY r, n),
rep AS (SELECT k, min(r) AS r, any_value(n) AS n FROM st GROUP BY k),
rs AS (SELECT sh.r, s FROM sh JOIN rep USING (r)),
prs AS (SELECT a.r AS a, b.r AS b, count(*) AS c FROM rs a JOIN rs b ON a.s = b.s AND a.r < b.r GROUP BY 1, 2),
lnk AS (SELECT a, b FROM prs JOIN rep x ON x.r = a JOIN rep y ON y.r = b WHERE 100 * c >= {min_pct} * (x.n + y.n - c)),
e AS (SELECT a, b FROM lnk UNION ALL SELECT b, a FROM lnk),
reach AS (SELECT r, r AS t FROM rep UNION SELECT reach.r, e.b FROM reach JOIN e ON reach.t = e.a),
comp AS (SELECT reach.r, min(doc_id) AS c FROM reach JOIN rep x ON x.r = reach.t JOIN st ON st.k = x.k JOIN d ON d.r = st.r GROUP BY reach.r)
SELECT d.doc_id, coalesce(st.n, 0)::BIGINT AS n_shingles, CASE WHEN st.r IS NULL THEN d.doc_id ELSE comp.c END AS component_id,
       d.doc_id IS NOT DISTINCT FROM (CASE WHEN st.r IS NULL THEN d.doc_id ELSE comp.c END) AS kept
FROM d LEFT JOIN st USING (r) LEFT JOIN rep ON rep.k = st.k LEFT JOIN comp ON comp.r = rep.r
"""


def sql(min_pct: int) -> str:
    """The rows of :func:`near_duplicates` in SQL, but for d and h."""
    return _SQL.replace("{min_pct}", str(min_pct))


SQL = sql(85)

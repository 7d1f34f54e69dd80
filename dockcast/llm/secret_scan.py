"""Secret scans in DataFrame functions: fixed patterns, and sliding-window
Shannon entropy over candidate strings.

Base spans: for each pattern the leftmost non-overlapping matches; matches
below the pattern's length are dropped. The text between matches and the
matches themselves come from ``split`` and ``regexp_extract_all``, whose
lengths add up to positions in code points.

Entropy spans: candidates are runs of at least ``window`` characters of the
token alphabet. A candidate belongs to the first character class that matches
it whole, and each class has its own threshold in bits per character. A window
of ``window`` characters slides over the candidate. The counts of its
characters are carried along, packed into a few integers; a step changes two
of them, and sum(c * log2 c) by their change, in whole millionths, so results
don't depend on rounding. Windows that overlap a match of an allow-list
pattern are suppressed. The span runs from the first to the last other window
at or over the threshold. Spans inside a base span are dropped; base spans
always stay.

Scale: one narrow pass over the texts, no shuffle, nothing leaves the JVM; a
text that a pattern can't match costs one search. Positions, overlaps and the
mask are running folds in pieces of ``PIECE`` matches, so that a text's time
grows with its matches, not with their square.

Rules. Null text is an empty one: no spans. Texts of any length are scanned whole. Repeated rows each get their
result, null ids stay null, empty tables give an empty result. Columns other
than the text are passed through by :func:`scan` and dropped by
:func:`find_secrets`.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockcast.llm.common import free_name

# Kind, pattern, group whose length counts, least length. Runs
# of one class and a least length are asked for in the pattern itself: the
# matches that pass are the same.
BASE = [
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]{14,}", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),
]
TOKEN = "[A-Za-z0-9+/_=-]"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
# Character classes: name, whole-string pattern, bits per character.
CLASSES = [
    ("digits", r"^[0-9]+$", 3.2),
    ("hex", r"^(?=.*[0-9])[0-9A-Fa-f]+$", 3.0),
    ("lower", r"^[a-z]+$", 4.0),
    ("upper", r"^[A-Z]+$", 4.0),
    ("letters", r"^[A-Za-z]+$", 4.0),
    ("base64", r"^(?=.*[0-9])(?=.*[A-Za-z])[A-Za-z0-9+/_=-]+$", 3.7),
    ("marked", r"^[A-Za-z+/_=-]+$", 4.0),
    ("numbers", r"^[0-9+/_=-]+$", 3.4),
]
# Allow-list: identifiers in the common dashed form, and plain alphabets.
ALLOW = [
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"(?i)(0123456789|1234567890|abcdefghij|example|placeholder)",
]
SPAN = "array<struct<start:int,kind:int,end:int>>"
PIECE = 128


def micro(c: int) -> int:
    """c * log2(c) in millionths, rounded."""
    return round(c * math.log2(c) * 1e6) if c > 1 else 0


def let(value: Column, fn) -> Column:
    """fn(value), with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def piece(xs: Column, i: Column) -> Column:
    return F.slice(xs, i * PIECE + 1, F.lit(PIECE))


def pieces(xs: Column) -> Column:
    """Numbers of the pieces of an array."""
    return F.sequence(F.lit(0), (F.greatest(F.size(xs) - 1, F.lit(0)) / PIECE).cast("int"))


def running(xs: Column, step) -> Column:
    """For each element the fold (from 0) of those before it."""
    def whole(xs: Column) -> Column:
        first = F.aggregate(pieces(xs), F.array(F.lit(0)), lambda a, i: F.array_append(a, F.aggregate(piece(xs, i), F.element_at(a, -1), step)))

        def inside(first: Column) -> Column:
            return F.flatten(F.transform(pieces(xs), lambda i: F.slice(
                F.aggregate(piece(xs, i), F.array(F.get(first, i)), lambda a, x: F.array_append(a, step(F.element_at(a, -1), x))), F.lit(1), F.size(piece(xs, i)))))

        return let(first, inside)

    return let(xs, whole)


def matches(text: Column, pattern: str, group: int) -> Column:
    """start, end, hit (text) and n (length of the group) of each match."""
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"),
                         F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("g"))

    def placed(parts: Column) -> Column:
        def one(p: Column, at: Column) -> Column:
            begin = at + F.length(p["gap"])
            return F.struct(begin.alias("start"), (begin + F.length(p["hit"])).alias("end"), p["hit"].alias("hit"), F.length(p["g"]).alias("n"))

        return F.zip_with(parts, running(parts, lambda at, p: at + F.length(p["gap"]) + F.length(p["hit"])), one)

    # the last gap has no match after it
    found = let(F.filter(parts, lambda p: p["hit"].isNotNull()), placed)
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast("array<struct<start:int,end:int,hit:string,n:int>>"))


def dense_part(token: Column, window: int, limit: Column, allowed: Column) -> Column:
    """first and last: ends of the first and last window of ``token`` whose
    sum(c * log2 c) is at most ``limit`` millionths and that overlaps none of
    the spans ``allowed``; -1 if there is none."""
    bits = (window + 1).bit_length()
    per = 63 // bits  # counts in one integer
    table = F.array(*[F.lit(micro(c)).cast("long") for c in range(window + 1)])

    def count(packed: Column, symbol: Column) -> Column:
        at = F.get(packed, (symbol / per).cast("int"))
        return F.call_function("shiftright", at, symbol % per * bits).bitwiseAND(F.lit((1 << bits) - 1)).cast("int")

    def one(j: Column, symbol: Column) -> Column:
        return F.when(j == (symbol / per).cast("int"), F.call_function("shiftleft", F.lit(1).cast("long"), symbol % per * bits)).otherwise(F.lit(0).cast("long"))

    def sums(symbols: Column) -> Column:
        def step(a: Column, i: Column) -> Column:
            gone, new = F.get(symbols, i - window), F.get(symbols, i)
            full = i >= window
            old_n = count(a["c"], gone)
            new_n = count(a["c"], new) - F.when(full & (gone == new), 1).otherwise(0)
            s = a["s"] + F.when(full, F.get(table, old_n - 1) - F.get(table, old_n)).otherwise(F.lit(0).cast("long")) + F.get(table, new_n + 1) - F.get(table, new_n)
            c = F.transform(a["c"], lambda w, j: w + one(j, new) - F.when(full, one(j, gone)).otherwise(F.lit(0).cast("long")))
            ok = (i >= window - 1) & (s <= limit) & ~F.exists(allowed, lambda x: (x["start"] <= i) & (x["end"] > i - window + 1))
            return F.struct(c.alias("c"), s.alias("s"), F.when(ok & (a["first"] < 0), i).otherwise(a["first"]).alias("first"), F.when(ok, i).otherwise(a["last"]).alias("last"))

        none = F.array(*[F.lit(0).cast("long")] * -(-len(ALPHABET) // per))
        start = F.struct(none.alias("c"), F.lit(0).cast("long").alias("s"), F.lit(-1).alias("first"), F.lit(-1).alias("last"))
        return F.aggregate(F.sequence(F.lit(0), F.size(symbols) - 1), start, step)

    symbols = F.transform(F.regexp_extract_all(token, F.lit("."), F.lit(0)), lambda x: F.instr(F.lit(ALPHABET), x) - 1)
    return F.element_at(F.transform(F.array(symbols), sums), 1)


def entropy_spans(text: Column, window: int, classes, allow) -> Column:
    found = matches(text, TOKEN + "{" + str(window) + ",}", 0)

    def allowed(m: Column) -> Column:
        empty = F.array().cast("array<struct<start:int,end:int,hit:string,n:int>>")
        return F.concat(empty, *[matches(m["hit"], a, 0) for a in allow])

    def limit(m: Column) -> Column:
        """Most sum(c * log2 c) of a window, by the first class that matches."""
        return F.coalesce(*[F.when(m["hit"].rlike(p), F.lit(math.floor(window * (math.log2(window) - bits) * 1e6)).cast("long")) for _, p, bits in classes])

    found = F.filter(found, lambda m: limit(m).isNotNull())

    def span(m: Column) -> Column:
        part = F.element_at(F.transform(F.array(dense_part(m["hit"], window, limit(m), allowed(m))), lambda p: F.struct(
            (m["start"] + p["first"] - window + 1).alias("start"), F.lit(len(BASE)).alias("kind"), F.when(p["first"] >= 0, m["start"] + p["last"] + 1).alias("end"))), 1)
        return part

    return F.filter(F.transform(found, span), lambda s: s["end"].isNotNull())


def _long_enough(found: Column, kind: int, least: int) -> Column:
    return F.transform(F.filter(found, lambda m: m["n"] >= least), lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end")))


def _of_kind(spans: str, kind: int) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")


def scan(docs: DataFrame, out: str, text: str = "text", window: int = 20, classes=CLASSES, allow=ALLOW) -> DataFrame:
    """All columns of ``docs`` and a struct ``out``: base and spans, each an
    array of (start, kind number, end) in order."""
    t, b = free_name(docs, "_t"), free_name(docs, "_spans")
    d = docs.withColumn(t, F.coalesce(F.col(text).cast("string"), F.lit("")))
    T = F.col(t)
    base = F.array().cast(SPAN)
    for k, (_, pattern, group, least) in enumerate(BASE):
        base = F.concat(base, _long_enough(matches(T, pattern, group), k, least))
    d = d.withColumn(b, F.struct(F.array_sort(base).alias("base"), entropy_spans(T, window, classes, allow).cast(SPAN).alias("dense")))
    base, dense = F.col(f"{b}.base"), F.col(f"{b}.dense")
    return d.withColumn(out, F.struct(base.alias("base"), F.when(F.size(dense) == 0, base).otherwise(together(base, dense)).alias("spans"))).drop(t, b)


def together(base: Column, dense: Column) -> Column:
    """Base spans, and the others that no base span holds, in order."""
    def kept(both: Column) -> Column:
        # a base span that holds another one comes before it
        ends = running(both, lambda a, s: F.greatest(a, F.when(s["kind"] < len(BASE), s["end"]).otherwise(0)))
        return F.transform(F.filter(F.arrays_zip(both.alias("s"), ends.alias("past")), lambda x: (x["s"]["kind"] < len(BASE)) | (x["s"]["end"] > x["past"])), lambda x: x["s"])

    return let(F.array_sort(F.concat(base, dense)), kept)


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k, *_ in BASE], F.lit("entropy"))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_secrets(docs: DataFrame, id: str = "doc_id", text: str = "text", **kw) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans of every row."""
    d = scan(docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text")), "s", **kw)
    n = [_of_kind("s.base", k).alias(f"n_{name}") for k, (name, *_) in enumerate(BASE)]
    return d.select("doc_id", *n, F.sha2(listed(F.col("s.base")).cast("binary"), 256).alias("base_sha256"), listed(F.col("s.spans")).alias("spans"))


def mask(text: Column, spans: Column, by: str = "[SECRET]") -> Column:
    """``text`` with each run of overlapping ``spans`` replaced by ``by``."""
    def runs(spans: Column) -> Column:
        """at (end of the last run) and start of each run."""
        ends = running(spans, lambda a, s: F.greatest(a, s["end"]))
        return F.filter(F.zip_with(spans, ends, lambda s, at: F.struct(at.alias("at"), s["start"].alias("start"))), lambda x: x["start"] >= x["at"])

    def of_piece(some: Column) -> Column:
        first, last = F.element_at(some, 1)["at"], F.element_at(some, -1)["start"]
        return let(F.substring(text, first + 1, last - first), lambda part: F.array_join(
            F.transform(some, lambda x: F.concat(F.substring(part, x["at"] - first + 1, x["start"] - x["at"]), F.lit(by))), ""))

    out = let(runs(spans), lambda xs: F.array_join(F.transform(pieces(xs), lambda i: let(piece(xs, i), of_piece)), ""))
    rest = F.substring(text, F.array_max(F.transform(spans, lambda s: s["end"])) + 1, F.length(text))
    return F.when(F.size(spans) > 0, F.concat(out, rest)).otherwise(text)


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
p(kind, name, pat, grp, least) AS (VALUES
  (0, 'assign', '(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 12),
  (1, 'access', 'AKIA[A-Z0-9]+', 0, 18), (2, 'hex', '[0-9a-f]+', 0, 16), (3, 'entropy', '[A-Za-z0-9+/_=-]{20,}', 0, 20)),
a AS (SELECT r, t, 0 AS kind, 12 AS least, string_split_regex(t, '(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)') AS gap,
             regexp_extract_all(t, '(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)') AS hit,
             regexp_extract_all(t, '(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2) AS g FROM d
      UNION ALL SELECT r, t, 1, 18, string_split_regex(t, 'AKIA[A-Z0-9]+'), regexp_extract_all(t, 'AKIA[A-Z0-9]+'), regexp_extract_all(t, 'AKIA[A-Z0-9]+') FROM d
      UNION ALL SELECT r, t, 2, 16, string_split_regex(t, '[0-9a-f]+'), regexp_extract_all(t, '[0-9a-f]+'), regexp_extract_all(t, '[0-9a-f]+') FROM d
      UNION ALL SELECT r, t, 3, 20, string_split_regex(t, '[A-Za-z0-9+/_=-]{20,}'), regexp_extract_all(t, '[A-Za-z0-9+/_=-]{20,}'), regexp_extract_all(t, '[A-Za-z0-9+/_=-]{20,}') FROM d),
m AS (SELECT r, kind, least, generate_subscripts(gap, 1) AS i, unnest(gap) AS gap, unnest(hit) AS hit, unnest(g) AS g FROM a WHERE len(hit) > 0),
pos AS (SELECT r, kind, least, i, hit, length(g) AS n,
               sum(length(gap) + length(hit)) OVER (PARTITION BY r, kind ORDER BY i) AS stop FROM m WHERE hit IS NOT NULL),
base AS (SELECT r, kind, (stop - length(hit))::BIGINT AS start, stop::BIGINT AS stop FROM pos WHERE kind < 3 AND n >= least),
cand AS (SELECT r, (stop - length(hit))::BIGINT AS start, hit,
                CASE WHEN regexp_matches(hit, '^[0-9]+$') THEN 3.2::DOUBLE
                     WHEN regexp_matches(hit, '^[0-9A-Fa-f]+$') AND regexp_matches(hit, '[0-9]') THEN 3.0::DOUBLE
                     WHEN regexp_matches(hit, '^[A-Za-z]+$') THEN 4.0::DOUBLE
                     WHEN regexp_matches(hit, '[0-9]') AND regexp_matches(hit, '[A-Za-z]') THEN 3.7::DOUBLE
                     WHEN regexp_matches(hit, '[0-9]') THEN 3.4::DOUBLE ELSE 4.0::DOUBLE END AS bits
         FROM pos WHERE kind = 3 AND NOT regexp_matches(hit, '^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$')),
ag AS (SELECT r, start, string_split_regex(hit, '(?i)(0123456789|1234567890|abcdefghij|example|placeholder)') AS gap,
              regexp_extract_all(hit, '(?i)(0123456789|1234567890|abcdefghij|example|placeholder)') AS found FROM cand),
au AS (SELECT r, start, generate_subscripts(gap, 1) AS i, unnest(gap) AS gap, unnest(found) AS found FROM ag WHERE len(found) > 0),
al AS (SELECT r, start, length(found) AS n, sum(length(gap) + length(found)) OVER (PARTITION BY r, start ORDER BY i) AS stop FROM au WHERE found IS NOT NULL),
wins AS (SELECT r, start, bits, hit, unnest(range(1, length(hit) - 18)) AS i FROM cand),
win AS (SELECT r, start, bits, i, unnest(string_split(hit[i:i + 19], '')) AS ch FROM wins
        WHERE NOT EXISTS (SELECT 1 FROM al WHERE al.r = wins.r AND al.start = wins.start AND al.stop >= wins.i AND al.stop - al.n < wins.i + 19)),
cnt AS (SELECT r, start, bits, i, ch, count(*) AS c FROM win GROUP BY ALL),
ent AS (SELECT r, start, bits, i, sum(round(c * log2(c) * 1e6)) AS s FROM cnt GROUP BY ALL),
den AS (SELECT r, 3 AS kind, start + min(i) - 1 AS start, start + max(i) + 19 AS stop FROM ent
        WHERE s <= floor(20 * (log2(20) - bits) * 1e6) GROUP BY r, ent.start),
extra AS (SELECT * FROM den WHERE NOT EXISTS (SELECT 1 FROM base WHERE base.r = den.r AND base.start <= den.start AND base.stop >= den.stop)),
alls AS (SELECT r, kind, start, stop FROM base UNION ALL SELECT r, kind, start, stop FROM extra),
lst AS (SELECT r, string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, alls.kind) AS spans,
               string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, alls.kind) FILTER (WHERE alls.kind < 3) AS base,
               count(*) FILTER (WHERE alls.kind = 0) AS n0, count(*) FILTER (WHERE alls.kind = 1) AS n1, count(*) FILTER (WHERE alls.kind = 2) AS n2
        FROM alls JOIN p USING (kind) GROUP BY r)
SELECT doc_id, coalesce(n0, 0)::BIGINT AS n_assign, coalesce(n1, 0)::BIGINT AS n_access, coalesce(n2, 0)::BIGINT AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN lst USING (r)
"""

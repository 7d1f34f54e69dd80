"""Quality rules with cross-document line frequency, in DataFrame functions.

Per document: word and symbol counts, repeated lines, and words inside
repeated 5-word windows (windows compared by a 64-bit hash of their word
hashes, inside one text only). Across documents: lines are normalised (ends
trimmed, lower case), hashed, and the distinct documents that hold a line are
counted per host. A line is over the limit in ``max_docs`` documents of a host
or more, whatever the host's size, or in at least ``min_docs`` and more than
``max_share`` of its host's documents (small hosts); it is removed there. A
document that keeps less than ``min_left`` of its words is depleted and
rejected.

Scale: a document is known by its text's hash in these counts, so a group of
copies counts once; counting is a two-step aggregate (distinct host, line,
document; then counts per host and line), so neither a hot host nor a hot line
meets one task. The lines over the limit, a written table, are joined by
(host, line) and become one row per distinct document with the places of its
own lines, joined by (host, text hash); no list grows with a host, and none is
broadcast by hint. The counts of a document are made before that join, so its
text is shuffled only where the text without the lines is asked for.

Rules. Words are runs of characters other than blank and \\x09-\\x0D. Null
text has no words and fails the base rule (under ``min_words`` words). A null
host is a host of its own; ids are only carried along. Repeated rows each get
their result. Empty tables give an empty result. Texts of any length are read whole;
the work on lines is linear in the text. Columns other than host and text are passed through by :func:`judge` and dropped by :func:`line_rules`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockcast.llm.common import SPACE, SPACE_RE, free_name, staged

SYMBOLS = "[#*$%&|<>]"  # fixed value


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE_RE), "")


def repeat_words(words: Column, n: int = 5) -> Column:
    """Words inside n-word windows that occur twice or more in ``words``."""
    def covered(h: Column) -> Column:
        at = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        dup = let(F.array_sort(at), lambda s: F.filter(s, lambda x, i: ((i > 0) & (F.get(s, i - 1)["h"] == x["h"])) | ((i < F.size(s) - 1) & (F.get(s, i + 1)["h"] == x["h"]))))
        first = F.struct(F.lit(-n).alias("last"), F.lit(0).alias("sum"))
        return F.aggregate(F.sort_array(F.transform(dup, lambda x: x["i"])), first,
                           lambda a, i: F.struct(i.alias("last"), (a["sum"] + F.least(F.lit(n), i - a["last"])).alias("sum")), lambda a: a["sum"])

    def windows(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(h) - n), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(n)]))

    found = let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: let(windows(h), lambda x: F.when(F.size(F.array_distinct(x)) == F.size(x), F.lit(0)).otherwise(covered(x))))
    return F.when(F.size(words) < n, F.lit(0)).otherwise(found).cast("long")


def line_key(line: Column) -> Column:
    return F.xxhash64(F.lower(F.btrim(line, F.lit(SPACE))))


def has_word(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACE)) != ""


def over_limit(docs: DataFrame, host: str, text: str, max_docs: int, max_share: float, min_docs: int) -> DataFrame:
    """One row per distinct document with lines over the limit: host, doc (its
    key) and at (the places of these lines among the text's lines)."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    d = docs.select(F.col(host).cast("string").alias("host"), text_key(t).alias("doc"), F.split(t, "\n").alias("lines"))
    held = d.select("host", "doc", F.posexplode(F.transform("lines", lambda x: F.when(has_word(x), line_key(x)))).alias("at", "line")).filter(F.col("line").isNotNull())
    each = held.groupBy("host", "line").agg(F.countDistinct("doc").alias("n")).filter(F.col("n") >= min(max_docs, min_docs))
    hosts = d.groupBy("host").agg(F.countDistinct("doc").alias("n_host")).withColumnRenamed("host", "of")
    often = each.join(hosts, F.col("host").eqNullSafe(F.col("of"))) \
        .filter((F.col("n") >= max_docs) | ((F.col("n") >= min_docs) & (F.col("n") > max_share * F.col("n_host"))))
    often = staged(often.select("of", F.col("line").alias("l")), "frequent-lines")
    found = held.join(often, F.col("host").eqNullSafe(F.col("of")) & (F.col("line") == F.col("l")), "left_semi")
    return staged(found.groupBy("host", "doc").agg(F.collect_set("at").alias("at")), "lines-over-limit")


def text_key(text: Column) -> Column:
    return F.struct(F.xxhash64(text), F.hash(text))


def judged(docs: DataFrame, host: str = "source", text: str = "text", max_docs: int = 20, max_share: float = 0.1, min_docs: int = 3,
           min_words: int = 10, max_repeat_pct: int = 20, min_left: float = 0.5) -> tuple[DataFrame, list[Column], list[str]]:
    """``docs`` with scratch columns, the fields of :func:`judge` over them
    (text_left, the only one that needs the text, last) and the scratch names."""
    over = over_limit(docs, host, text, max_docs, max_share, min_docs)
    t, w, of, key, cut, made, each = (free_name(docs, x) for x in ("_t", "_w", "_host", "_doc", "_at", "_base", "_line_words"))
    d = docs.withColumn(t, F.coalesce(F.col(text).cast("string"), F.lit(""))).withColumn(w, words_of(F.col(t)))
    T, words = F.col(t), F.col(w)
    with_word = F.filter(F.split(T, "\n"), has_word)
    base = F.struct(F.size(words).cast("long").alias("n_words"), F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
                    (F.size(F.split(T, SYMBOLS)) - 1).cast("long").alias("n_symbols"),
                    let(with_word, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
                    repeat_words(words).alias("n_repeat_words"))
    d = d.withColumns({made: base, each: F.transform(F.split(T, "\n"), lambda x: F.size(words_of(x))), key: text_key(T)}).drop(w, t)
    # sort-merge: the side of documents over the limit grows with the input
    over = over.select(F.col("host").alias(of), F.col("doc").alias(f"{key}_"), F.col("at").alias(cut)).hint("merge")
    d = d.join(over, F.col(host).cast("string").eqNullSafe(F.col(of)) & (F.col(key) == F.col(f"{key}_")), "left").drop(of, key, f"{key}_")
    at, b, n = F.col(cut), F.col(made), F.col(f"{made}.n_words")
    n_cut = F.coalesce(F.size(at), F.lit(0)).cast("long")
    lost = F.coalesce(F.aggregate(at, F.lit(0).cast("long"), lambda a, i: a + F.get(F.col(each), i)), F.lit(0).cast("long"))
    T = F.coalesce(F.col(text).cast("string"), F.lit(""))
    stay = let(F.split(T, "\n"), lambda x: F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(x) - 1), at), lambda i: F.get(x, i)), "\n"))
    failed = (n < min_words) | (100 * F.col(f"{made}.n_repeat_words") > max_repeat_pct * n)
    words_left = n - lost
    fields = [*[b[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")], failed.alias("base_failed"),
              (~failed & ~(words_left < min_left * n)).alias("kept"), n_cut.alias("n_cut_lines"), words_left.alias("words_left"),
              F.when(at.isNull(), T).otherwise(stay).alias("text_left")]
    return d, fields, [cut, made, each]


def judge(docs: DataFrame, out: str, **kw) -> DataFrame:
    """All columns of ``docs`` and a struct ``out``: n_words, word_chars,
    n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_cut_lines,
    words_left, text_left (the text without the lines over the limit)."""
    d, fields, scratch = judged(docs, **kw)
    return d.withColumn(out, F.struct(*fields)).drop(*scratch)


def line_rules(docs: DataFrame, id: str = "doc_id", host: str = "source", text: str = "text", **limits) -> DataFrame:
    """The id and the fields of :func:`judge`, but text_left, for every row."""
    d = docs.select(F.col(id).alias("doc_id"), F.col(host).alias("source"), F.col(text).alias("text"))
    d, fields, _ = judged(d, **limits)
    return d.select("doc_id", *fields[:-1])


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
ln AS (SELECT r, source, t, unnest(string_split(t, chr(10))) AS line FROM d),
lw AS (SELECT r, source, t, line, lower(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))) AS k FROM ln WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM lw GROUP BY 1),
fr AS (SELECT source, k, count(DISTINCT t) AS n FROM lw GROUP BY 1, 2),
ho AS (SELECT source, count(DISTINCT t) AS n FROM d GROUP BY 1),
ov AS (SELECT fr.source, fr.k FROM fr JOIN ho ON fr.source IS NOT DISTINCT FROM ho.source WHERE fr.n >= 20 OR (fr.n >= 3 AND fr.n > 0.1::DOUBLE * ho.n)),
cut AS (SELECT r, count(*) AS n, sum(len(regexp_extract_all(line, '[^\x20\x09-\x0D]+'))) AS lost
        FROM lw JOIN ov ON lw.k = ov.k AND lw.source IS NOT DISTINCT FROM ov.source GROUP BY 1),
win AS (SELECT r, unnest(range(1, len(w) - 3)) AS i, w FROM d WHERE len(w) >= 5),
wk AS (SELECT r, i, array_to_string(w[i:i + 4], ' ') AS k FROM win),
rep AS (SELECT r, i FROM (SELECT *, count(*) OVER (PARTITION BY r, k) AS n FROM wk) WHERE n > 1),
cov AS (SELECT r, count(DISTINCT i + o) AS n FROM rep, (SELECT unnest(range(0, 5)) AS o) GROUP BY 1),
b AS (SELECT d.r, doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
             len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
             coalesce(cut.n, 0)::BIGINT AS n_cut_lines, len(w)::BIGINT - coalesce(cut.lost, 0)::BIGINT AS words_left
      FROM d LEFT JOIN dup USING (r) LEFT JOIN cov USING (r) LEFT JOIN cut USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND NOT (words_left < 0.5::DOUBLE * n_words) AS kept, n_cut_lines, words_left
FROM b
"""

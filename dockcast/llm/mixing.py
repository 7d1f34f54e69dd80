"""Mixing sources to target weights by Pareto order sampling.

Sources, ordered by name (code points, null last), take the weights in turn
and share a budget of words (by default all words of the table); a source's
share is held to ``most`` times its own words and the excess goes to the
others by weight until none is above (:func:`targets`).

Inside a source, a document's expected copies are ``min(most, c * m)``: the
measure ``m`` = 8 + bit length of its size, less one, favours longer documents
mildly, and ``c`` is solved from the source's table of size classes so that
expected words equal the target. The whole part is taken for certain. The
fraction is an inclusion probability p: documents are ranked by their random
odds over their inclusion odds, (u / (1 - u)) / (p / (1 - p)), and taken in
that order up to the words still missing - a sample of fixed size in words
with unequal probabilities. One closing document, whose size is nearest to the
gap that is left, ends the sample.

Scale: after one pass over the texts only (id, source, size, u) moves. The
rank's threshold is found through counts of 4,096 rank buckets per source,
then 4,096 buckets inside the one that holds the threshold, then the few
documents of that bucket, so no source is sorted in one task however large.
Tables of one row per source and size class are joined as plain equi-joins,
which Spark broadcasts only if their written size is below its threshold.

Rules. u comes from the md5 of seed, id and text, and of rows that repeat these
in one source from their number among those: each row is drawn by itself, and
reruns agree, as such rows are interchangeable. Null text has size 0 and is
never taken; a null source is a source of its own; a null id counts as the
empty text in the draw. Very long texts are counted whole. Empty tables give
an empty result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockcast.llm.common import staged
from dockcast.operators.sequence import position

WORD_RE = r"[^\x20\x09-\x0D]+"
BUCKETS = 4096


def sized(docs: DataFrame, id: str, text: str, source: str, seed: int) -> DataFrame:
    """doc_id, source, size (words), k (size class) and u of every row."""
    said = F.coalesce(F.col(text).cast("string"), F.lit(""))
    words = F.size(F.regexp_extract_all(said, F.lit(WORD_RE), F.lit(0))).cast("long")
    rows = staged(docs.select(F.col(id).alias("doc_id"), F.col(source).cast("string").alias("source"), words.alias("size"), F.md5(said.cast("binary")).alias("h"),
                              F.monotonically_increasing_id().alias("row")), "mix-rows")
    # rows that repeat id, source and text are numbered, so each has a draw of its own
    again = rows.groupBy("doc_id", "source", "h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if again.isEmpty():
        rows = rows.withColumn("nth", F.lit(1).cast("long"))
    else:
        again = again.select(F.col("doc_id").alias("_id"), F.col("source").alias("_s"), F.col("h").alias("_h"))
        same = rows["doc_id"].eqNullSafe(again["_id"]) & rows["source"].eqNullSafe(again["_s"]) & (rows["h"] == again["_h"])
        rows = rows.join(again, same, "left_anti").withColumn("nth", F.lit(1).cast("long")) \
            .unionByName(position(rows.join(again, same, "left_semi"), ["doc_id", "source", "h"], ["row"], "nth"))
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("h"), F.when(F.col("nth") > 1, F.concat(F.lit(":"), F.col("nth").cast("string"))).otherwise(""))
    draw = F.md5(name.cast("binary"))
    return rows.select("doc_id", "source", "size", ((F.conv(F.substring(draw, 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))).alias("u")) \
        .withColumn("k", F.length(F.bin(F.greatest("size", F.lit(1)))).cast("long") - 1)


def targets(sources: DataFrame, weights: tuple[int, ...], most: int, budget: int | None) -> DataFrame:
    """source, source_size, target from one row (source, source_size) each."""
    everything = Window.partitionBy()
    turn = F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(weights)))
    s = sources.withColumn("w", F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (turn + 1).cast("int")).cast("long")) \
        .withColumn("total", F.lit(budget).cast("long") if budget is not None else F.sum("source_size").over(everything))
    up = Window.orderBy(F.col("source_size") / F.col("w"), F.col("source").asc_nulls_last())
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    # in order of words over weight, a source is held at its limit while the share exceeds it
    s = s.withColumn("left", F.col("total") - most * F.coalesce(F.sum("source_size").over(before), none)) \
         .withColumn("w_left", F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), none)) \
         .withColumn("held", most * F.col("source_size") * F.col("w_left") <= F.col("w") * F.col("left"))
    free = F.when(~F.col("held"), 1)
    share = (F.col("total") - F.sum(F.when(F.col("held"), most * F.col("source_size")).otherwise(0)).over(everything)) / F.sum(free * F.col("w")).over(everything)
    return s.withColumn("share", share) \
        .select("source", "source_size", F.when(F.col("held"), (most * F.col("source_size")).cast("double")).otherwise(F.col("w") * F.col("share")).alias("target"))


def copies(classes: DataFrame, most: int) -> DataFrame:
    """Per source and size class: whole copies and the inclusion probability p."""
    w = Window.partitionBy("source").orderBy(F.col("k").desc()).rowsBetween(Window.unboundedPreceding, -1)
    mine = Window.partitionBy("source")
    c = classes.withColumn("m", F.col("k") + 8).withColumn("ms", F.col("m") * F.col("words"))
    c = c.withColumn("left", F.col("target") - most * F.coalesce(F.sum("words").over(w), F.lit(0)).cast("double")) \
         .withColumn("ms_left", F.sum("ms").over(mine) - F.coalesce(F.sum("ms").over(w), F.lit(0))) \
         .withColumn("full", F.col("m") * F.col("left") >= F.lit(float(most)) * F.col("ms_left"))
    each = F.try_divide(F.col("target") - most * F.sum(F.when(F.col("full"), F.col("words")).otherwise(0)).over(mine).cast("double"),
                        F.sum(F.when(~F.col("full"), F.col("ms")).otherwise(0)).over(mine).cast("double"))
    c = c.withColumn("e", F.when(F.col("full"), F.lit(float(most))).otherwise(F.least(F.lit(float(most)), F.coalesce(each, F.lit(0.0)) * F.col("m"))))
    return c.withColumn("whole", F.floor("e")).withColumn("p", F.col("e") - F.floor("e")) \
        .withColumn("need", F.col("target") - F.sum(F.col("whole") * F.col("words")).over(mine).cast("double")) \
        .select("source", "k", "source_size", "target", "whole", "p", "need")


def same_source(a: DataFrame, b: DataFrame, how: str, *more: str) -> DataFrame:
    """Join on source (null equals null) and ``more``; b's keys are dropped."""
    r = b.select([F.col(c).alias(f"_{c}" if c in ("source", *more) else c) for c in b.columns])
    on = a["source"].eqNullSafe(r["_source"])
    for c in more:
        on = on & (a[c] == r[f"_{c}"])
    return a.join(r, on, how).drop("_source", *[f"_{c}" for c in more])


def crossing(counts: DataFrame, level: str) -> DataFrame:
    """Of (source, level, words, need): the first bucket in which the running
    words reach what is needed, and the words before it."""
    w = Window.partitionBy("source").orderBy(level).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("before", F.coalesce(F.sum("words").over(w), F.lit(0))) \
        .filter((F.col("before") <= F.col("need")) & (F.col("before") + F.col("words") > F.col("need"))) \
        .select("source", level, (F.col("need") - F.col("before")).alias("need"))


def mix(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = (5, 2, 1),
        most: int = 3, budget: int | None = None, seed: int = 0) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken (words the
    mix takes: copies * size) of every row."""
    d = staged(sized(docs, id, text, source, seed), "mix-sizes")
    by_class = d.groupBy("source", "k").agg(F.sum("size").alias("words"))
    goal = targets(by_class.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most, budget)
    plan = staged(copies(same_source(by_class, goal, "inner"), most), "mix-plan")

    v = F.col("u") / (1 - F.col("u")) / (F.col("p") / (1 - F.col("p")))
    v = F.when(F.col("p") > 0, v / (1 + v))  # the rank on (0, 1); null: nothing is drawn
    d = same_source(d, plan, "inner", "k").withColumn("v", v) \
        .withColumn("b1", F.least(F.floor(F.col("v") * BUCKETS), F.lit(BUCKETS - 1))) \
        .withColumn("b2", F.floor((F.col("v") * BUCKETS - F.floor(F.col("v") * BUCKETS)) * BUCKETS))
    drawn = d.filter(F.col("v").isNotNull() & (F.col("size") > 0))
    c1 = crossing(drawn.groupBy("source", "b1", "need").agg(F.sum("size").alias("words")), "b1").withColumnRenamed("need", "need1")
    in1 = same_source(drawn, c1, "inner", "b1")
    c2 = crossing(in1.groupBy("source", "b1", "b2", F.col("need1").alias("need")).agg(F.sum("size").alias("words")).drop("b1"), "b2").withColumnRenamed("need", "need2")
    last = same_source(in1, c2, "inner", "b2").groupBy("source", "v", "doc_id", "need2").agg(F.sum("size").alias("words"))
    w = Window.partitionBy("source").orderBy("v", F.col("doc_id").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    last = last.withColumn("before", F.coalesce(F.sum("words").over(w), F.lit(0))) \
        .filter((F.col("before") <= F.col("need2")) & (F.col("before") + F.col("words") > F.col("need2"))) \
        .select("source", F.struct("v", "doc_id").alias("end"), (F.col("need2") - F.col("before")).alias("gap"))
    cut = staged(last, "mix-cut")  # one row per source: the first document beyond the words needed

    d = same_source(d, cut, "left")
    rank = F.struct("v", "doc_id")
    # no crossing: all that can be drawn is needed
    d = d.withColumn("in", F.col("v").isNotNull() & (F.col("end").isNull() | (rank < F.col("end"))))
    off = F.abs(F.col("gap") - F.col("size"))
    close = d.filter(F.col("v").isNotNull() & ~F.col("in") & (off < F.col("gap"))) \
        .groupBy("source").agg(F.min(F.struct(off.alias("off"), F.col("v"), F.col("doc_id"))).alias("close"))
    close = close.select("source", F.struct("close.v", "close.doc_id").alias("close"))
    d = same_source(d, staged(close, "mix-close"), "left")
    n = F.col("whole") + (F.col("in") | F.coalesce(rank == F.col("close"), F.lit(False))).cast("long")
    return d.select("doc_id", "source", "size", "source_size", "target", n.alias("copies"), (n * F.col("size")).alias("taken"))


SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         (('0x' || left(md5('0:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, '')) || CASE WHEN nth > 1 THEN ':' || nth::VARCHAR ELSE '' END), 13))::BIGINT
          + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
  FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, source, coalesce(text, '')) AS nth FROM documents)),
e AS (SELECT *, (length(bin(greatest(size, 1))) - 1)::BIGINT AS k FROM d),
cl AS (SELECT source, k, sum(size)::BIGINT AS words FROM e GROUP BY 1, 2),
s0 AS (SELECT source, sum(words)::BIGINT AS source_size FROM cl GROUP BY 1),
s1 AS (SELECT *, [5, 2, 1][(((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1)::INT]::BIGINT AS w,
              (sum(source_size) OVER ())::BIGINT AS total FROM s0),
s2 AS (SELECT *, total - 3 * coalesce(sum(source_size) OVER up, 0)::BIGINT AS lft,
              (sum(w) OVER () - coalesce(sum(w) OVER up, 0))::BIGINT AS w_left
       FROM s1 WINDOW up AS (ORDER BY source_size::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s3 AS (SELECT *, 3 * source_size * w_left <= w * lft AS held FROM s2),
s4 AS (SELECT *, (total - sum(CASE WHEN held THEN 3 * source_size ELSE 0 END) OVER ())::BIGINT::DOUBLE
                 / (sum(CASE WHEN held THEN NULL ELSE w END) OVER ())::BIGINT::DOUBLE AS share FROM s3),
goal AS (SELECT source, source_size, CASE WHEN held THEN (3 * source_size)::DOUBLE ELSE w * share END AS target FROM s4),
c1 AS (SELECT cl.source, k, words, source_size, target, k + 8 AS m, (k + 8) * words AS ms
       FROM cl JOIN goal ON cl.source IS NOT DISTINCT FROM goal.source),
c2 AS (SELECT *, target - (3 * coalesce(sum(words) OVER dn, 0))::DOUBLE AS lft,
              (sum(ms) OVER (PARTITION BY source) - coalesce(sum(ms) OVER dn, 0))::BIGINT AS ms_left
       FROM c1 WINDOW dn AS (PARTITION BY source ORDER BY k DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c3 AS (SELECT *, m * lft >= 3.0::DOUBLE * ms_left AS fll FROM c2),
c4 AS (SELECT *, (target - (3 * sum(CASE WHEN fll THEN words ELSE 0 END) OVER mine)::DOUBLE)
                 / nullif((sum(CASE WHEN fll THEN 0 ELSE ms END) OVER mine)::DOUBLE, 0) AS each
       FROM c3 WINDOW mine AS (PARTITION BY source)),
c5 AS (SELECT *, CASE WHEN fll THEN 3.0::DOUBLE ELSE least(3.0::DOUBLE, coalesce(each, 0.0::DOUBLE) * m) END AS e FROM c4),
plan AS (SELECT source, k, source_size, target, floor(e)::BIGINT AS whole, e - floor(e) AS p,
                target - (sum(floor(e)::BIGINT * words) OVER (PARTITION BY source))::DOUBLE AS need FROM c5),
r AS (SELECT e.doc_id, e.source, e.size, e.u, source_size, target, whole, p, need,
             CASE WHEN p > 0 THEN u / (1 - u) / (p / (1 - p)) END AS q
      FROM e JOIN plan ON e.source IS NOT DISTINCT FROM plan.source AND e.k = plan.k),
v AS (SELECT *, q / (1 + q) AS v FROM r),
g AS (SELECT source, v, doc_id, need, sum(size)::BIGINT AS words FROM v WHERE v IS NOT NULL AND size > 0 GROUP BY ALL),
h AS (SELECT *, coalesce(sum(words) OVER (PARTITION BY source ORDER BY v, doc_id NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM g),
cut AS (SELECT source, v AS end_v, doc_id AS end_id, need - before AS gap FROM h WHERE before <= need AND before + words > need),
x AS (SELECT v.*, gap, v IS NOT NULL AND (end_v IS NULL OR v < end_v OR (v = end_v AND (doc_id < end_id OR (doc_id IS NULL AND end_id IS NOT NULL)))) AS taken_in
      FROM v LEFT JOIN cut ON v.source IS NOT DISTINCT FROM cut.source),
cand AS (SELECT source, v AS close_v, doc_id AS close_id,
                row_number() OVER (PARTITION BY source ORDER BY abs(gap - size), v, doc_id NULLS FIRST) AS rn
         FROM x WHERE v IS NOT NULL AND NOT taken_in AND abs(gap - size) < gap),
cl1 AS (SELECT * FROM cand WHERE rn = 1)
SELECT doc_id, x.source, size, source_size, target,
       whole + (taken_in OR coalesce(x.v = close_v AND doc_id IS NOT DISTINCT FROM close_id, false))::BIGINT AS copies,
       (whole + (taken_in OR coalesce(x.v = close_v AND doc_id IS NOT DISTINCT FROM close_id, false))::BIGINT) * size AS taken
FROM x LEFT JOIN cl1 ON x.source IS NOT DISTINCT FROM cl1.source
"""

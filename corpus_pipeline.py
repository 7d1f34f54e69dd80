"""Corpus cleaning in stages, each one operator of ``dockcast.llm``.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a frame. :func:`run` writes each stage's result as Parquet to the
checkpoint folder and reads it again for the next one. All stages but the last
return the columns of ``documents``, in their order and types; further columns
pass through. Rows are named by id and text, so nulls, repeated rows and empty
tables go through every stage under the rules its operator states.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockcast.llm import buckets, decontam, hyperminhash, line_rules, mixing, secret_scan
from dockcast.llm.common import free_name, staged, table
from dockcast.operators.serve import one_per_key


def with_text(docs: DataFrame, text: Column, columns: list[str]) -> DataFrame:
    """``columns`` of ``docs`` with a new text and its length."""
    t = free_name(docs, "_text")  # a column of its own: inside one select, an expression over the old text could meet the new one
    new = {"text": F.col(t), "n_chars": F.length(t).cast("long")}
    return docs.withColumn(t, text).select([new[c].alias(c) if c in new else F.col(f"`{c}`") for c in columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; lines over the limit go from the others."""
    q = free_name(docs, "_q")
    kept = line_rules.judge(docs, q).filter(F.col(f"{q}.kept"))
    return with_text(kept, F.col(f"{q}.text_left"), docs.columns)


NEAR_PCT = 80  # similarity from which documents are near duplicates


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays. Rows that repeat a kept document's id
    and text (null ids are one id) are copies of it: of those the least in the
    other columns stays."""
    d, h, n = (free_name(docs, c) for c in ("_d", "_h", "_n"))
    keep = hyperminhash.near_duplicates(docs, min_pct=NEAR_PCT).filter("kept").groupBy(F.col("d").alias(d), F.col("h").alias(h)).agg(F.count(F.lit(1)).alias(n))
    keep = staged(keep, "near-kept")
    named = docs.withColumns(dict(zip((d, h), buckets.key_columns("doc_id", "text"))))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    once = named.join(keep.filter(F.col(n) == 1).drop(n), [d, h], "left_semi").select(*columns)
    again = keep.filter(F.col(n) > 1).drop(n)
    if again.isEmpty():
        return once
    return once.unionByName(one_per_key(named.join(again, [d, h], "left_semi"), [d, h], F.min).select(*columns))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontam.remove_leaks(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of secrets are replaced by a mark; every document stays."""
    s = free_name(docs, "_s")
    return with_text(secret_scan.scan(docs, s), secret_scan.mask(F.col("text"), F.col(f"{s}.spans")), docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document."""
    return mixing.mix(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("secret scans", mask_secrets),
    ("mixing sources to target weights", mix_sources),
]



def _parts(sql: str) -> tuple[str, str]:
    """A query's named parts and its last SELECT."""
    head, _, last = sql.strip().rpartition("\nSELECT ")
    return head.removeprefix("WITH "), "SELECT " + last


def _oracle_sql() -> str:
    """The stages as nested queries, each over the one before by the name ``documents``."""
    rules, verdict = _parts(line_rules.SQL)
    scan, _ = _parts(secret_scan.SQL)
    near = _parts(hyperminhash.sql(NEAR_PCT))
    return rf"""
WITH s1 AS (
  WITH {rules},
  pq AS ({verdict}),
  pl AS (SELECT doc_id, source, generate_subscripts(string_split(text, chr(10)), 1) AS i, unnest(string_split(text, chr(10))) AS line FROM documents WHERE text IS NOT NULL),
  pc AS (SELECT pl.*, regexp_matches(line, '[^\x20\x09-\x0D]') AND EXISTS (SELECT 1 FROM ov WHERE ov.source IS NOT DISTINCT FROM pl.source
          AND ov.k = lower(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)))) AS gone FROM pl),
  pt AS (SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '') AS text FROM pc GROUP BY doc_id)
  SELECT doc_id, pt.text, x.lang, x.source, length(pt.text)::BIGINT AS n_chars FROM documents x JOIN pt USING (doc_id) JOIN pq USING (doc_id) WHERE pq.kept),
s2 AS (SELECT s1.* FROM s1 JOIN (SELECT * FROM (WITH RECURSIVE documents AS (SELECT * FROM s1), {near[0].removeprefix("RECURSIVE ")}
  {near[1]})) n USING (doc_id) WHERE n.kept QUALIFY row_number() OVER (PARTITION BY doc_id, text ORDER BY lang NULLS FIRST, source NULLS FIRST) = 1),
s3 AS (SELECT s2.* FROM s2 JOIN (SELECT * FROM (WITH documents AS (SELECT * FROM s2), {_parts(decontam.SQL)[0]} {_parts(decontam.SQL)[1]})) n USING (doc_id) WHERE NOT n.contaminated),
s4 AS (
  WITH documents AS (SELECT * FROM s3), {scan},
  po AS (SELECT r, start, stop, coalesce(start >= max(stop) OVER (PARTITION BY r ORDER BY start, kind, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS new FROM alls),
  pg AS (SELECT r, start, stop, sum(new::INT) OVER (PARTITION BY r ORDER BY start, stop, new) AS g FROM po),
  pu AS (SELECT r, min(start) AS a, max(stop) AS e FROM pg GROUP BY r, g),
  pf AS (SELECT r, a, coalesce(lag(e) OVER (PARTITION BY r ORDER BY a), 0) AS before, e FROM pu),
  pm AS (SELECT d.r, string_agg(substr(t, before + 1, a - before) || '[SECRET]', '' ORDER BY a) || substr(any_value(t), max(e) + 1) AS text FROM pf JOIN d USING (r) GROUP BY d.r),
  pz AS (SELECT d.doc_id, coalesce(pm.text, d.t) AS text FROM d LEFT JOIN pm USING (r))
  SELECT s3.doc_id, pz.text, lang, source, length(pz.text)::BIGINT AS n_chars FROM s3 JOIN pz USING (doc_id)),
documents_mixed AS (SELECT * FROM (WITH documents AS (SELECT * FROM s4), {_parts(mixing.SQL)[0]} {_parts(mixing.SQL)[1]}))
SELECT * FROM documents_mixed
"""


ORACLE_SQL = _oracle_sql()


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staged(docs, "stage")
    return docs

"""The registered queries against their SQL, and the pipeline against its
stages done by hand."""

import os
import re
import sys

import pytest

import corpus_pipeline
from dockcast.llm import queries

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.join(ROOT, "tools"))
SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", [*sorted(queries.ORACLE_SQL), "pipeline"])
def test_query_equals_sql(spark, name):
    import oracle_check
    ok, why = oracle_check.compare(spark, SF, [name], strict=True)[name]
    assert ok, why


def test_names():
    assert [sum(n.startswith(f"op{i}_") for n in queries.QUERIES) for i in range(1, 14)] == [1] * 13


def test_contract_columns(spark):
    want = {1: "doc_id size source_size target taken", 2: "doc_id n_words n_removed kept_sha256", 3: "doc_id n_bytes n_tokens over_limit", 4: "doc_id n_words n_hit n_items items_sha256 contaminated",
            5: "doc_id held_out score predicted", 6: "doc_id n_bytes n_removed n_spans kept_sha256", 7: "doc_id n_shingles component_id kept", 8: "doc_id n_assign n_access n_hex base_sha256 spans",
            9: "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept", 10: "doc_id held_out lang_pred score", 11: "word form root n n_near form_n",
            12: "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars", 13: "item_id rank doc_id score"}
    n = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    for name, f in queries.QUERIES.items():
        df = f(spark, "/root/testdata/sf0.001")
        op = int(re.match(r"op(\d+)", name)[1])
        assert set(want[op].split()) <= set(df.columns)
        if op < 11:
            assert df.count() == n


def test_native_queries_run_no_python(spark):
    from dockcast.session import plan_text
    for name, f in queries.QUERIES.items():
        if name.startswith(("op1_", "op8_", "op9_")):
            assert not re.search("Python|Pandas|Arrow", plan_text(f(spark, "/root/testdata/sf0.001")))


def test_pipeline_stages(spark):
    """Each stage's rows follow from its operator's rows on what it was given."""
    from dockcast.llm import decontam, hyperminhash, line_rules, secret_scan
    from dockcast.llm.common import staged
    given = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    docs, seen = given, []
    for name, f in corpus_pipeline.STAGES[:-1]:
        out = staged(f(spark, docs, SF), "test")
        assert out.dtypes == given.dtypes
        seen.append((docs, out))
        docs = out
    assert ids(seen[0][1]) == ids(line_rules.line_rules(seen[0][0]).filter("kept"))
    assert ids(seen[1][1]) == ids(hyperminhash.near_duplicates(seen[1][0], min_pct=80).filter("kept"))
    assert ids(seen[2][1]) == ids(decontam.find_leaks(seen[2][0], bench).filter("not contaminated"))
    assert ids(seen[3][1]) == ids(seen[3][0])
    assert secret_scan.find_secrets(seen[3][1]).filter("spans <> ''").count() <= 0.02 * secret_scan.find_secrets(seen[3][0]).filter("spans <> ''").count()
    assert all(r.n_chars == len(r.text) for r in docs.collect())
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert sorted(map(repr, last.collect())) == sorted(map(repr, corpus_pipeline.run(spark, SF).collect()))


SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
import __spark_entry__ as ent
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
for q in sorted(ent.llm_queries.QUERIES) + ["pipeline"]:
    print("QUERY", q, ent.queries()[q](spark, "/root/testdata/sf0.001").count())
"""


def test_executors_need_no_copy_of_the_package(tmp_path):
    import subprocess
    r = subprocess.run([sys.executable, "-c", SCRIPT], cwd=str(tmp_path), capture_output=True, text=True, timeout=600)
    assert r.returncode == 0, r.stderr[-2000:]
    assert r.stdout.count("QUERY") == 14

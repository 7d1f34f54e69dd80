"""The driver contract loaded the way a harness loads it: from the file
path, in a fresh process whose working directory is not the repo, with a
plain session (default settings)."""

import os
import subprocess
import sys
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = textwrap.dedent(f"""
    import importlib.util
    spec = importlib.util.spec_from_file_location("spark_entry", {os.path.join(ROOT, '__spark_entry__.py')!r})
    ent = importlib.util.module_from_spec(spec); spec.loader.exec_module(ent)
    from pyspark.sql import SparkSession
    spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
    assert set(ent.queries()) >= set(ent.oracle_sql())
    df = ent.entry(spark)
    print("ENTRY", df.count(), ",".join(df.columns))
    for q in ["recursive_forecast", "ridge_fit_station"]:
        print("QUERY", q, ent.queries()[q](spark, "/root/testdata/sf0.001").count())
""")


def test_contract_from_foreign_cwd(tmp_path):
    r = subprocess.run([sys.executable, "-c", SCRIPT], cwd=str(tmp_path), capture_output=True, text=True, timeout=600)
    out = r.stdout
    assert r.returncode == 0, r.stderr[-2000:]
    assert "ENTRY 10 user_id,pct_full,lag_30m,avg_120m" in out
    assert "QUERY recursive_forecast 1000" in out
    assert "QUERY ridge_fit_station 15" in out

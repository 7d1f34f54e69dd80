"""Every registered query against its DuckDB oracle at sf0.01 (the
correctness gate), plus the smoke entry on sf0.001."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

from conftest import SF01  # noqa: E402


@pytest.fixture(scope="module")
def results(spark):
    """Exact equality after rounding to 6 digits (as a value hash sees it)."""
    import oracle_check
    return oracle_check.compare(spark, SF01, sorted(own_queries()), strict=True)


def own_queries():
    """The library's own queries, without the optional subpackage's."""
    import __spark_entry__ as ent
    optional = set(ent.llm_queries.QUERIES) | {"pipeline"} if ent.llm_queries else set()
    return set(ent.queries()) - optional


def test_every_query_has_an_oracle():
    import __spark_entry__ as ent
    assert own_queries() <= set(ent.oracle_sql())


def test_queries_match_oracle(results):
    bad = {k: why for k, (ok, why) in results.items() if not ok}
    assert not bad, bad


def test_entry_smoke(spark):
    import __spark_entry__ as ent
    df = ent.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 10
    assert df.columns == ["user_id", "pct_full", "lag_30m", "avg_120m"]


SEQUENCE_QUERIES = ["lag_occupancy", "rolling_mean", "target_lead", "ffill", "tail_n", "lead_weather",
                    "null_profile", "union_horizons", "explode_hourly", "ridge_fit", "forecast_rows", "r2",
                    "recursive_forecast", "flagship_shortage", "training_features", "drop_na_features",
                    "ridge_fit_station", "describe", "zone_rolling", "time_rolling_mean"]


def test_split_path_matches_oracle(spark):
    """The same queries with every station forced through the hot-key
    (range-numbered, chunked) path must give identical results."""
    import oracle_check
    from dockcast.operators import sequence as sq
    with sq.skew_config(sq.SkewConfig(hot_rows=8, hot_share=0.0, chunk_rows=16, max_hot_keys=1_000_000)):
        res = oracle_check.compare(spark, SF01, SEQUENCE_QUERIES)
    bad = {k: why for k, (ok, why) in res.items() if not ok}
    assert not bad, bad

"""Plan-shape rules over every registered query (plans only, built on the
smallest tables): no keyless joins anywhere; keep-first de-duplication is a
partial aggregate, not a window; the flagship needs one shuffle."""

import re

import pytest

from dockcast.session import plan_text

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plans(spark):
    import __spark_entry__ as ent
    return {name: plan_text(fn(spark, SF0001), "simple") for name, fn in ent.queries().items()}


def test_no_keyless_joins(plans):
    bad = [n for n, p in plans.items() if "CartesianProduct" in p or "BroadcastNestedLoopJoin" in p]
    assert not bad, bad


def test_keep_first_is_a_partial_aggregate(plans):
    for name in ("dedupe_subset", "drop_shared_position", "dedupe_weather"):
        p = plans[name]
        assert "partial_min" in p and "Window" not in p, name


def test_flagship_shuffles_once(plans):
    assert len(re.findall(r"Exchange hashpartitioning", plans["flagship_shortage"])) == 1


def test_pushdown_and_pruning(plans):
    scan = plans["scan_time_range"]
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in scan and "LessThan(ts," in scan
    # occupancy needs event_id, value and props only
    rs = re.findall(r"ReadSchema: struct<([^>]*)>", plans["occupancy_ratio"])
    assert rs and set(rs[0].split(",")) == {"event_id:bigint", "value:double", "props:string"}

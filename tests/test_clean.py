"""clean_snapshot: one fixture row per rule."""

from datetime import datetime, timedelta

import pytest

from dockcast import schemas
from dockcast.plans.snapshot import clean_snapshot

# as_of 2024-04-17 12:00 Taipei → cut-off = 2024-04-09 00:00 Taipei = 2024-04-08 16:00 UTC
AS_OF = "2024-04-17 04:00:00"
CUTOFF = datetime(2024, 4, 8, 16, 0, 0)
T1 = datetime(2024, 4, 17, 3, 0, 0)
T2 = datetime(2024, 4, 17, 3, 10, 0)


def raw(id, *, name="st", type=2, space=20, full=5, empty=15, city="台北市", area="大安區",
        lat=25.0, lng=121.5, upd=T1, ts=T1):
    return (id, name, type, space, full, empty, 0, full, 0, city, area, lat, lng, None, "addr", 1, upd, ts)


def fixture_rows():
    return [
        raw(1, lat=25.001),
        raw(2, city=None, lat=25.002),
        raw(3, type=1, lat=25.003),
        raw(4, empty=-1, lat=25.004),
        raw(5, space=0, lat=25.005),
        raw(6, lat=21.88),
        raw(7, lng=119.9, lat=25.007),
        raw(8, upd=CUTOFF, lat=25.008),
        raw(9, upd=CUTOFF - timedelta(seconds=1), lat=25.009),
        raw(10, space=10, full=5, empty=15, lat=25.010),   # space = full+empty-10 → kept
        raw(11, space=9, full=5, empty=15, lat=25.011),    # space = full+empty-11 → dropped
        raw(12, name="B", lat=25.012),                      # exact duplicate pair, names differ
        raw(12, name="A", lat=25.012),
        raw(13, lat=25.013, lng=121.6),                     # two ids, one position, one snapshot
        raw(14, lat=25.013, lng=121.6),
        raw(15, lat=25.015, lng=121.7, ts=T1),              # one position, two snapshots
        raw(16, lat=25.015, lng=121.7, ts=T2, upd=T2),
        raw(17, city="外星市", lat=25.017),
        raw(18, area="蘆竹區", lat=25.018),
        raw(19, area="路竹區", lat=25.019),
    ]


@pytest.fixture(scope="module")
def cleaned(spark):
    df = spark.createDataFrame(fixture_rows(), schemas.RAW_SNAPSHOT)
    return {r.id: r for r in clean_snapshot(df, as_of=AS_OF).collect()}


def test_kept_ids(cleaned):
    assert sorted(cleaned) == [1, 8, 10, 12, 15, 16, 17, 18, 19]


def test_duplicate_keeps_lowest_name(cleaned):
    assert cleaned[12].name == "A"


def test_mapping_with_default(cleaned):
    assert cleaned[1].city == "TaiBeiShi" and cleaned[1].area == "DaAnQu"
    assert cleaned[17].city == "N/A"
    assert cleaned[18].area == cleaned[19].area == "LuZhuQu"


def test_output_schema(spark):
    df = spark.createDataFrame(fixture_rows(), schemas.RAW_SNAPSHOT)
    out = clean_snapshot(df, as_of=AS_OF)
    assert out.columns == [f.name for f in schemas.CLEAN_SNAPSHOT.fields]


def test_no_shared_position_survives(spark):
    df = spark.createDataFrame(fixture_rows(), schemas.RAW_SNAPSHOT)
    out = clean_snapshot(df, as_of=AS_OF)
    assert out.groupBy("lat", "lng", "extraction_ts").count().filter("count > 1").count() == 0


def test_per_row_cutoff_keeps_old_snapshots(spark):
    """Re-processing: each row is judged against its own extraction day, so
    a 2023 snapshot is not dropped for being older than today − 8 days."""
    old = datetime(2023, 1, 5, 3, 0, 0)
    df = spark.createDataFrame([raw(1, upd=old, ts=old)], schemas.RAW_SNAPSHOT)
    assert clean_snapshot(df).count() == 1
    assert clean_snapshot(df, as_of=AS_OF).count() == 0


def test_schema_check_raises(spark):
    df = spark.createDataFrame(fixture_rows(), schemas.RAW_SNAPSHOT)
    with pytest.raises(schemas.SchemaMismatch, match="columns"):
        schemas.check_schema(df.drop("name"), schemas.RAW_SNAPSHOT)
    with pytest.raises(schemas.SchemaMismatch, match="'space'"):
        schemas.check_schema(df.withColumn("space", df.space.cast("int")), schemas.RAW_SNAPSHOT)
    with pytest.raises(schemas.SchemaMismatch, match="missing"):
        schemas.check_schema(df.drop("name"), schemas.RAW_SNAPSHOT, exact_count=False)


def test_snapshot_profile(spark):
    from dockcast.plans.profile import snapshot_profile
    df = spark.createDataFrame(fixture_rows(), schemas.RAW_SNAPSHOT)
    p = snapshot_profile(df)
    assert p["space_identity"].first().n == len(fixture_rows())
    assert p["nulls"].first()["city_nulls"] == 1
    assert {r.n: r.groups for r in p["key_uniqueness"].collect()}[2] == 1  # id 12 twice in one snapshot
    shared = p["shared_positions"].first()
    assert shared.positions == 2 and shared.rows == 4  # ids 13/14 and the id-12 copies
    assert p["fill_level"].first().n == len(fixture_rows())

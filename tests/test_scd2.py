"""SCD-2 properties on the events stand-in."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from slicewarden.operators import scd2
from slicewarden.plans.standins import customer_days, table

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def snaps(spark):
    days = customer_days(table(spark, SF_SMALL, "events"))
    return scd2.snapshots_by_day(days, "customer_id", "region", "day").cache()


def _days(snaps):
    return [r.day.isoformat() for r in snaps.select("day").distinct().orderBy("day").collect()]


def _day(snaps, d):
    return snaps.where(F.col("day") == F.to_date(F.lit(d))).select(
        "customer_id", F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("email"),
        "region", "hash_diff")


def test_history_equals_day_loop(spark, snaps):
    loop = scd2.fold_days(spark, snaps, _days(snaps), compact_every=4)
    window = scd2.build_history(snaps)
    assert sorted(map(repr, loop.collect())) == sorted(map(repr, window.collect()))


def test_one_current_row_and_no_overlap(spark, snaps):
    h = scd2.build_history(snaps)
    assert h.where("is_current").groupBy("customer_id").count().where("count <> 1").count() == 0
    w = Window.partitionBy("customer_id").orderBy("eff_from")
    bad = h.withColumn("nxt", F.lead("eff_from").over(w)).where(
        (F.col("eff_to") >= F.col("nxt")) | (F.col("eff_to") < F.col("eff_from")))
    assert bad.count() == 0


def test_rerun_same_day_is_noop(spark, snaps):
    d = _days(snaps)
    dim = scd2.merge_day(scd2.empty_dimension(spark), _day(snaps, d[0]), d[0])
    dim = scd2.merge_day(dim, _day(snaps, d[1]), d[1])
    again = scd2.merge_day(dim, _day(snaps, d[1]), d[1])
    assert sorted(map(repr, dim.collect())) == sorted(map(repr, again.collect()))


def test_older_day_rejected(spark, snaps):
    d = _days(snaps)
    dim = scd2.merge_day(scd2.empty_dimension(spark), _day(snaps, d[3]), d[3])
    with pytest.raises(ValueError):
        scd2.checked_merge_day(dim, _day(snaps, d[0]), d[0])


def test_null_keys_dropped_and_hash_keeps_null(spark):
    df = spark.createDataFrame([(None, "x"), (1, None), (2, "y")], "customer_id long, region string")
    s = {r.customer_id: r for r in scd2.daily_snapshot(df).collect()}
    assert set(s) == {"1", "2"}
    assert s["1"].hash_diff != s["2"].hash_diff
    import hashlib
    assert s["2"].hash_diff == hashlib.sha256(b'{"region":"y"}').hexdigest()
    assert s["1"].hash_diff == hashlib.sha256(b'{"region":null}').hexdigest()

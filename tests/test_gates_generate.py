"""Gates on small inventories, and the generator."""

import datetime as dt

from pyspark.sql import functions as F

from slicewarden.operators import gates
from slicewarden.sources.generate import generate_orders
from slicewarden.functions import suites
from slicewarden.operators.split import split_rows


def inv(spark, rows):
    return spark.createDataFrame(rows, "prefix string, name string, updated timestamp")


def test_landing_readiness(spark):
    t = dt.datetime(2024, 1, 1, 10, 0)
    df = inv(spark, [("a/", "a/_SUCCESS", dt.datetime(2020, 1, 1)),
                     ("b/", "b/x.PARQUET", t), ("c/", "c/x.json", t),
                     ("d/", "d/x.parquet", dt.datetime(2023, 12, 31))])
    out = {r.prefix: r.outcome for r in gates.landing_readiness(
        df, now="2024-01-01 11:00:00", max_input_age_minutes=180, enforce_today_only=False).collect()}
    assert out == {"a/": "READY_MARKER", "b/": "READY", "c/": "SKIP_TOO_FEW_FILES", "d/": "SKIP_STALE"}


def test_publish_check_and_decisions(spark):
    t = dt.datetime(2024, 1, 1, 10, 0)
    df = inv(spark, [("a/", "a/_SUCCESS", t), ("a/", "a/_MANIFEST.json", t), ("b/", "b/_SUCCESS", t)])
    st = {r.prefix: r.status for r in gates.publish_check(df, now="2024-01-01 10:30:00").collect()}
    assert st == {"a/": "OK", "b/": "FAIL_MISSING"}
    runs = spark.createDataFrame([("d1", True, 0, False), ("d2", False, 2, False), ("d3", False, 0, False),
                                  ("d4", True, 1, True)],
                                 "run_date string, success boolean, staged_files long, already_published boolean")
    act = {r.run_date: r.action for r in gates.publish_decision(runs, export_good_on_failure=True).collect()}
    assert act == {"d1": "publish", "d2": "publish", "d3": "mark_failed", "d4": "skip_already_published"}
    res = spark.createDataFrame([("d1", True, True), ("d1", False, True), ("d2", False, False), ("d3", True, False)],
                                "run_date string, success boolean, good_exported boolean")
    oc = {r.run_date: r.status for r in gates.run_outcome(res).collect()}
    assert oc == {"d1": "partial_ok", "d2": "fail", "d3": "ok"}


def test_generator_is_clean_and_sized(spark):
    df = generate_orders(spark, "2024-01-15", rows=5000, partitions=4)
    assert df.count() == 5000 and df.select("order_id").distinct().count() == 5000
    s = split_rows(df, suites.EXPORT_BAD_CONDITIONS)
    assert s.bad.count() == 0 and s.undecided.count() == 0
    assert df.where(F.col("order_date") != F.lit("2024-01-15").cast("date")).count() == 0
    again = generate_orders(spark, "2024-01-15", rows=5000, partitions=2)
    assert sorted(map(repr, df.collect())) == sorted(map(repr, again.collect()))


def test_gates_answer_for_folders_without_objects(spark):
    import pytest

    t = dt.datetime(2024, 1, 1, 10, 0)
    df = inv(spark, [("a/", "a/_SUCCESS", t), ("a/", "a/_MANIFEST.json", t)])
    want = spark.createDataFrame([("a/",), ("none/",), ("none/",)], "prefix string")
    now = "2024-01-01 10:30:00"
    rows = gates.landing_readiness(df, now=now, enforce_today_only=False, expected=want).collect()
    assert {(r.prefix, r.outcome, r.n_objects) for r in rows} == {
        ("a/", "READY_MARKER", 2), ("none/", "SKIP_TOO_FEW_FILES", 0)} and len(rows) == 2
    st = {r.prefix: r.status for r in gates.publish_check(df, now=now, expected=want).collect()}
    assert st == {"a/": "OK", "none/": "FAIL_MISSING"}
    with pytest.raises(ValueError):
        gates.landing_readiness(df, now=now)

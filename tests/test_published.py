"""Versioned publishes and scans by the manifest table."""

import datetime as dt
import os
from decimal import Decimal

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicewarden.sources import published as pub
from slicewarden.sources import versions


def orders(spark, lo, hi, parts=4):
    return (spark.range(lo, hi).repartitionByRange(parts, "id").select(
        F.col("id").alias("k"), (F.col("id") / 2).alias("v"), F.concat(F.lit("s"), F.lpad("id", 6, "0")).alias("s"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int") % 300).alias("d"),
        F.timestamp_seconds(F.col("id") * 3600).alias("t"), F.col("id").cast("decimal(12,2)").alias("m"),
        F.when(F.col("id") % 2 == 0, F.col("id")).alias("n"), F.array("id").alias("a")))


def publish(spark, root, date, df, **more):
    args = {"run_id": "r1", "success": True} | more
    return pub.publish(spark, df, root=root, run_date=date, **args)


@pytest.fixture()
def root(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "ready")
    publish(spark, root, "2024-01-01", orders(spark, 0, 1000))
    publish(spark, root, "2024-01-02", orders(spark, 1000, 1600), files_per_shard=2)
    return root


def rows(df):
    return sorted(map(repr, df.collect()))


def test_reads_equal_the_published_rows(spark, root):
    df = orders(spark, 0, 1600)
    want = rows(df)
    for k in (1, 3):
        assert rows(pub.read(spark, root, df.schema, files_per_task=k)) == want
    assert rows(pub.read_folders(spark, root, df.schema)) == want
    two = T.StructType([df.schema["s"], df.schema["k"]])
    assert rows(pub.read(spark, root, two, dates=["2024-01-02"])) == rows(orders(spark, 1000, 1600).select("s", "k"))
    more = T.StructType([df.schema["k"], T.StructField("added_later", T.StringType())])
    assert pub.read(spark, root, more).where("added_later is null").count() == 1600


@pytest.mark.parametrize("where", [
    [("k", ">=", 900), ("k", "<", 1100)], [("s", "=", "s000007")], [("v", "<=", 3.5)], [("k", "in", [5, 1500])],
    [("t", ">", dt.datetime(1970, 2, 20))], [("d", "=", dt.date(2024, 1, 8))], [("m", "<", Decimal("12.00"))],
    [("n", ">", 1500)], [("k", "=", -1)]])
def test_conditions_keep_the_right_rows(spark, root, where):
    df = orders(spark, 0, 1600)
    want = df
    for c in where:
        want = want.where(pub._condition(*c))
    assert rows(pub.read(spark, root, df.schema, where)) == rows(want)


def data_folder(root, spark, date):
    return versions.Store(spark, root).folders(f"good/date={date}")[0]


def test_a_filtered_read_opens_fewer_files(spark, root):
    """Files out of range may even be gone."""
    df = orders(spark, 0, 1600)
    entries = pub.manifest_table(spark, root).collect()
    assert sum(e.rows for e in entries) == 1600 and len(entries) == 8
    far = [e for e in entries if int(e.stats["k"].lo) >= 1000 and int(e.stats["k"].hi) < 1400]
    os.remove(far[0].uri.removeprefix("file:"))
    assert pub.read(spark, root, df.schema, [("k", "<", 1000)]).count() == 1000
    with pytest.raises(Exception, match="missing"):
        pub.read(spark, root, df.schema).count()
    assert pub.read(spark, root, df.schema, strict=False).count() == 1600 - far[0].rows
    status = {e.status for e in pub.check(spark, root).collect()}
    assert status == {"ok", "missing"}


def test_changed_files_are_found(spark, root):
    entries = pub.manifest_table(spark, root).orderBy("uri").collect()
    paths = [e.uri.removeprefix("file:") for e in entries]
    with open(paths[0], "ab") as f:
        f.write(b"x")
    os.utime(paths[1], (1, 1))
    status = {e.uri: e.status for e in pub.check(spark, root).collect()}
    assert [status[e.uri] for e in entries] == ["size_mismatch", "modified"] + ["ok"] * 6
    with pytest.raises(Exception, match="size_mismatch"):
        pub.read(spark, root, orders(spark, 0, 1).schema).count()


def test_a_published_date_is_left_alone(spark, root):
    before = set(os.listdir(os.path.join(root, "data")))
    got = publish(spark, root, "2024-01-01", orders(spark, 0, 5))
    assert got.action == "skip_already_published" and not got.published
    assert set(os.listdir(os.path.join(root, "data"))) == before                # nothing staged
    again = publish(spark, root, "2024-01-01", orders(spark, 0, 5), allow_republish=True)
    assert again.published and pub.read(spark, root, orders(spark, 0, 1).schema).count() == 605


def test_runs_that_may_not_publish(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "ready")
    bad = publish(spark, root, "2024-01-01", orders(spark, 0, 5), success=False, export_good_on_failure=False)
    few = publish(spark, root, "2024-01-01", orders(spark, 0, 5), success=False, min_files=99, run_id="r2")
    assert (bad.action, few.action) == ("mark_failed", "mark_failed") and pub.published_dates(spark, root) == []
    failed = spark.read.json(versions.Store(spark, root).folders("failed"))
    assert sorted((r.run_id, r.staged_file_count > 0) for r in failed.collect()) == [("r1", False), ("r2", True)]
    partial = publish(spark, root, "2024-01-01", orders(spark, 0, 5), success=False, run_id="r3")
    assert partial.published and publish(spark, root, "x", orders(spark, 0, 5), dry_run=True).action == "dry_run"
    assert pub.published_dates(spark, root) == ["2024-01-01"]


def test_an_empty_partition_and_wrong_conditions(spark, tmpdir_path):
    root, schema = os.path.join(tmpdir_path, "ready"), orders(spark, 0, 1).schema
    assert pub.read(spark, root, schema).count() == 0
    publish(spark, root, "2024-01-01", orders(spark, 0, 0))
    assert pub.read(spark, root, schema, [("k", ">", 1)]).count() == 0
    for wrong in [("k", "like", 1), ("nothing", "=", 1)]:
        with pytest.raises(ValueError):
            pub.read(spark, root, schema, [wrong])


def test_statistics_that_do_not_decide():
    kinds = {"x": pa.float64(), "b": pa.binary()}
    assert pub.may_hold({"x": {"lo": None, "hi": None}}, [["x", "=", "1"]], kinds)
    assert pub.may_hold({"x": {"lo": "nan", "hi": "nan"}}, [["x", "=", "1"]], kinds)
    assert pub.may_hold({}, [["x", "=", "1"]], kinds) and not pub.may_hold({"x": {"lo": "2", "hi": "3"}}, [["x", "=", "1"]], kinds)

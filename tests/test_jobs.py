"""End-to-end jobs on temporary tables."""

import os

from pyspark.sql import functions as F

from slicewarden.plans import jobs
from slicewarden.sources import files, publish, published
from slicewarden.sources.generate import generate_orders

from test_csv_source import make_feed
from test_paths_backfill import graph


def write_days(spark, root, days, rows=200):
    for i, d in enumerate(days):
        df = generate_orders(spark, d, rows=rows, partitions=2, seed=42 + i)
        if i == len(days) - 1:   # defects on the last day
            df = df.withColumn("currency", F.when(F.col("order_id") % 10 == 0, "XX").otherwise(F.col("currency")))
        df.write.mode("overwrite").parquet(os.path.join(root, f"date={d}"))


def test_validate_day_partial_publish(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "orders")
    write_days(spark, root, ["2024-01-01", "2024-01-02"])
    ready, err = os.path.join(tmpdir_path, "ready"), os.path.join(tmpdir_path, "error")
    res = os.path.join(tmpdir_path, "results")
    out = jobs.validate_day(spark, root, "2024-01-02", "basic", ready_root=ready, error_root=err,
                            results_path=res, run_id="r1")
    assert out["counts"] == {"rows_total": 200, "rows_good": 180, "rows_bad": 20, "rows_undecided": 0}
    assert out["summary"]["success"] is False and out["summary"]["slice_row_count"] == 200
    assert out["publish"].action == "publish"
    assert publish.read_published(spark, os.path.join(ready, "date=2024-01-02")).count() == 180
    assert spark.read.parquet(os.path.join(err, "date=2024-01-02")).count() == 20
    ok = jobs.validate_day(spark, root, "2024-01-01", "cross", ready_root=ready, error_root=err,
                           results_path=res, run_id="r2")
    assert ok["summary"]["success"] is True and ok["counts"]["rows_bad"] == 0
    assert not files.exists(spark, os.path.join(err, "date=2024-01-01"))
    jobs.validate_day(spark, root, "2024-01-01", "cross", ready_root=ready, error_root=err, results_path=res, run_id="r2")
    assert sorted(r.run_date for r in jobs.run_summaries(spark, res).collect()) == ["2024-01-01", "2024-01-02"]
    from slicewarden.sources.partitions import has_partition, read_table
    assert has_partition(read_table(spark, root), "2024-01-02")
    assert not has_partition(read_table(spark, root), "2024-01-05")
    versioned = os.path.join(tmpdir_path, "versioned")
    for action in ("publish", "skip_already_published"):
        out = jobs.validate_day(spark, root, "2024-01-02", "basic", ready_root=versioned, error_root=err,
                                results_path=res, run_id="r3", layout="versions")
        assert out["publish"].action == action
    schema = read_table(spark, root).drop("date").schema
    assert published.read(spark, versioned, schema, dates=["2024-01-02"]).count() == 180
    whole = jobs.validate_day(spark, root, "2024-01-01", "basic", ready_root=ready, error_root=err,
                              results_path=res, scope="table", dry_run=True)
    assert whole["summary"]["slice_row_count"] == 200 and whole["publish"].action == "dry_run"


def test_csv_to_dedup_table(spark, tmpdir_path):
    raw = os.path.join(tmpdir_path, "raw")
    os.makedirs(raw)
    make_feed(raw)
    out = os.path.join(tmpdir_path, "out")
    r = jobs.csv_to_dedup_table(spark, raw, out, rows_per_part=1)
    assert r["partition"] == "ingest_dt=2024-01-02"
    good = jobs.csv_output(spark, out, "parquet", "ingest_dt=2024-01-02")
    assert sorted(x.order_id for x in good.collect()) == ["1"]
    assert jobs.csv_output(spark, out, "orders_dedup").count() == 1
    q = jobs.csv_output(spark, out, "quarantine", "ingest_dt=2024-01-02")
    assert q.count() == 6 and "_failed_rules" in q.columns
    assert jobs.csv_output(spark, out, "rule_counts").count() == 3
    suite = jobs.csv_output(spark, out, "file_suite")
    c_views = suite.where("_file LIKE '%c.csv' AND `column` = 'views'").collect()
    assert [(r.expectation_type, r.success) for r in c_views] == [("expect_column_to_exist", False)]
    assert suite.where("_file LIKE '%a.csv' AND expectation_type LIKE '%unique'").first().unexpected_count == 2


def test_reports_of_earlier_days_stay(spark, tmpdir_path):
    """Two days with odd headers, one of them ingested twice."""
    raw, out = os.path.join(tmpdir_path, "raw"), os.path.join(tmpdir_path, "out")
    day1 = make_feed(raw)
    with open(os.path.join(day1, "d.csv"), "w") as f:
        f.write("order_id,amount,views,source,source,,a.b,source.1\n71,1,1,Apple,x,y,z,w\n72,-1,1,Apple,x,y,z,w\n")
    jobs.csv_to_dedup_table(spark, raw, out)
    day2 = os.path.join(raw, "ingest_dt=2024-01-03")
    os.makedirs(day2)
    with open(os.path.join(day2, "e.csv"), "w") as f:
        f.write("order_id,amount,views,source\n81,1,1,Apple\n82,1,1,Nobody\n")
    for _ in range(2):
        got = jobs.csv_to_dedup_table(spark, raw, out)
    assert got["partition"] == "ingest_dt=2024-01-03" and got["summary"][0]["rows_bad"] == 1
    summary = {(os.path.basename(r._file), r.rows_total, r.rows_bad): r
               for r in jobs.csv_output(spark, out, "file_summary").collect()}
    assert sorted(summary) == [("a.csv", 3, 2), ("b.csv", 2, 2), ("c.csv", 2, 2), ("d.csv", 2, 1), ("e.csv", 2, 1)]
    # The addresses lead to the day's own reports.
    for name, reader in (("bad_sample_uri", spark.read.option("header", "true").csv),
                         ("quarantine_uri", spark.read.option("header", "true").csv)):
        assert reader(summary[("d.csv", 2, 1)][name]).where("_file like '%d.csv'").count() == 1
        assert reader(summary[("e.csv", 2, 1)][name]).count() == 1
    good = jobs.csv_output(spark, out, "parquet", "ingest_dt=2024-01-02").where("order_id = '71'").first().asDict()
    assert {k: good[k] for k in ("source", "source.2", "Unnamed: 5", "a.b", "source.1")} == {
        "source": "Apple", "source.2": "x", "Unnamed: 5": "y", "a.b": "z", "source.1": "w"}
    assert sorted(r.order_id for r in jobs.csv_output(spark, out, "orders_dedup").collect()) == ["81"]
    assert files.exists(spark, summary[("a.csv", 3, 2)]["rule_counts_uri"])


def test_fold_equals_rebuild(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "bronze")
    for i, d in enumerate(["2024-01-01", "2024-01-02", "2024-01-03"]):
        generate_orders(spark, d, rows=300, partitions=1, seed=i).withColumn(
            "customer_id", F.col("customer_id") % 50).write.mode("overwrite").parquet(os.path.join(root, f"date={d}"))
    dim = os.path.join(tmpdir_path, "dim")
    for d in ["2024-01-01", "2024-01-02", "2024-01-03"]:
        jobs.fold_dimension_day(spark, root, dim, d)
    jobs.fold_dimension_day(spark, root, dim, "2024-01-03")          # rerun: no change
    full = os.path.join(tmpdir_path, "dim_full")
    jobs.rebuild_dimension(spark, root, full)
    a = sorted(map(repr, jobs.read_dimension(spark, dim).collect()))
    b = sorted(map(repr, jobs.read_dimension(spark, full).collect()))
    assert a == b and len(a) > 50
    cur = jobs.read_dimension(spark, dim).where("is_current")
    assert cur.count() == cur.select("customer_id").distinct().count() == 50
    assert jobs.folded_days(spark, dim) == jobs.folded_days(spark, full) == ["2024-01-01", "2024-01-02", "2024-01-03"]


def test_plan_backfill_writes_ops_tables(spark, tmpdir_path):
    ops = os.path.join(tmpdir_path, "ops")
    jobs.ensure_ops_tables(spark, ops)
    nodes, edges = graph(spark)
    inv = spark.createDataFrame([], "dataset string, kind string, partition_date date")
    items = jobs.plan_backfill(spark, nodes, edges, ops_root=ops, inventory=inv, root="root.job",
                               run_date="2024-03-02", created_by="test").collect()
    assert [r.priority for r in items] == [100, 110, 120]
    assert jobs.read_ops(spark, ops, "backfill_plan_items").count() == 3
    assert jobs.read_ops(spark, ops, "backfill_plan").first().status == "PLANNED"
    assert {r.job_name for r in jobs.read_ops(spark, ops, "task_map").collect()} == {"root.job", "etl.b"}


def test_a_stopped_plan_leaves_nothing(spark, tmpdir_path, monkeypatch):
    import pytest

    ops = os.path.join(tmpdir_path, "ops")
    nodes, edges = graph(spark)
    inv = spark.createDataFrame([], "dataset string, kind string, partition_date date")

    def plan():
        return jobs.plan_backfill(spark, nodes, edges, ops_root=ops, inventory=inv, root="root.job",
                                  run_date="2024-03-02", created_by="test").count()

    real = files.create_new
    monkeypatch.setattr(files, "create_new", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        plan()
    assert all(jobs.read_ops(spark, ops, t).count() == 0 for t in jobs.OPS_TABLES)
    monkeypatch.setattr(files, "create_new", real)
    assert plan() == 3
    counts = {t: jobs.read_ops(spark, ops, t).count() for t in jobs.OPS_TABLES}
    assert counts == {"config_job_cadence": 0, "task_map": 2, "backfill_plan": 1, "backfill_plan_items": 3}


def test_slices_overwrite_and_inventories(spark, tmpdir_path):
    import pytest

    from slicewarden.operators import backfill, lineage
    from slicewarden.sources import files, sinks
    from slicewarden.sources.partitions import partition_slice, path_slice, read_table

    root = os.path.join(tmpdir_path, "t")
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-01"), (3, "2024-01-02")], "v long, d string")
    df = df.withColumn("date", F.to_date("d")).drop("d")
    sinks.write_sized_parts(df, root, rows_per_part=1, partition_by=["date"])
    t = read_table(spark, root)
    assert partition_slice(t, "2024-01-01").count() == 2
    raw = spark.read.option("basePath", root).parquet(os.path.join(root, "date=2024-01-01"))
    assert path_slice(raw, "2024-01-01").count() == 2
    # dynamic overwrite replaces only the partitions present in the new data
    sinks.write_sized_parts(df.where("v = 3").withColumn("v", F.lit(30).cast("long")), root, partition_by=["date"])
    assert sorted(r.v for r in read_table(spark, root).collect()) == [1, 2, 30]
    inv = backfill.external_partitions(files.inventory(spark, root), "proj.bronze.t")
    st = {r["__inv_ds"]: r["__exists"] for r in backfill.partition_status(inv, "2024-01-02").collect()}
    assert st == {"proj.bronze.t": True}
    st = {r["__inv_ds"]: r["__exists"] for r in backfill.partition_status(inv, "2024-01-03").collect()}
    assert st == {"proj.bronze.t": False}
    with pytest.raises(ValueError):
        lineage.root_job_name("ns:bootstrap.seed")


def test_small_helpers(spark, tmpdir_path):
    from slicewarden.operators import backfill
    from slicewarden.session import shuffle_partitions_for
    from slicewarden.sources import files
    from slicewarden.sources.partitions import register_table

    root = os.path.join(tmpdir_path, "lake", "brand_1")
    for d in ["2024-01-01", "2024-01-02"]:
        spark.range(3).write.mode("overwrite").parquet(os.path.join(root, f"date={d}"))
    folders = backfill.file_folders(files.inventory(spark, os.path.join(tmpdir_path, "lake")))
    got = sorted((r.dataset.rsplit("lake/", 1)[-1], str(r.partition_date)) for r in folders.collect())
    assert got == [("brand_1/date=2024-01-01/", "2024-01-01"), ("brand_1/date=2024-01-02/", "2024-01-02")]
    assert shuffle_partitions_for(40 * 1024 ** 4) == 163_840 and shuffle_partitions_for(1) == 8
    register_table(spark.range(4), "sw_tmp_view")
    assert spark.table("sw_tmp_view").count() == 4

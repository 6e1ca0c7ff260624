"""Dataset-name rules and the backfill plan on a hand-made graph."""

import datetime as dt

from pyspark.sql import functions as F

from slicewarden.functions import paths
from slicewarden.operators import backfill, lineage


def names(spark, xs):
    return spark.createDataFrame([(x,) for x in xs], "n string")


def test_normalise_and_retarget(spark):
    df = names(spark, ["gcs:bkt/a//b/date=2024-01-01", "gcs:bktdate=2024-01-01", "bigquery:p.d.t",
                       "p.d.t", "gcs:a/b/DATE=2023-05-05/x/date=2022-01-01/", None])
    out = df.select(paths.normalise(F.col("n")).alias("norm"),
                    paths.retarget_date(paths.normalise(F.col("n")), "2024-02-02").alias("t")).collect()
    assert [r.norm for r in out] == ["bkt/a/b/date=2024-01-01/", "bkt/date=2024-01-01/", "p.d.t", "p.d.t",
                                     "a/b/DATE=2023-05-05/x/date=2022-01-01/", None]
    # slashes around the segment are kept; only the first segment changes
    assert out[0].t == "bkt/a/b/date=2024-02-02/"
    assert out[4].t == "a/b/date=2024-02-02/x/date=2022-01-01/"


def graph(spark):
    nodes = spark.createDataFrame([
        ("J1", "JOB", "root.job"), ("J2", "JOB", "etl.b"), ("J3", "JOB", "bootstrap.x"),
        ("D1", "DATASET", "gcs:bkt/out/date=2024-01-01"), ("D2", "DATASET", "bigquery:p.s.t2"),
        ("D3", "DATASET", "bigquery:p.s.t3"), ("D4", "DATASET", "bigquery:p.s.src"),
        ("D5", "DATASET", "bigquery:p.s.boot")], "id string, type string, name string")
    edges = spark.createDataFrame([("D4", "J1"), ("J1", "D1"), ("J1", "D2"), ("J2", "D3"), ("D1", "J2"),
                                   ("J3", "D5"), ("J2", "ZZ")], "source string, target string")
    return nodes, edges


def test_job_io_and_neighbourhood(spark):
    nodes, edges = graph(spark)
    io = {r.job_name: r for r in lineage.job_io_lists(lineage.job_io_edges(nodes, edges)).collect()}
    assert set(io) == {"root.job", "etl.b"}
    assert io["root.job"].outputs == ["bigquery:p.s.t2", "gcs:bkt/out/date=2024-01-01"]
    assert io["etl.b"].inputs == ["gcs:bkt/out/date=2024-01-01"]
    _, e = lineage.neighbourhood(nodes, edges, "ns:root.job")
    assert e.count() == 3


def test_plan_items(spark):
    nodes, edges = graph(spark)
    cad = spark.createDataFrame([("etl.b", "daily", " biz_date ", "o", True)], backfill.CADENCE_SCHEMA)
    tm = spark.createDataFrame([("root.job", "dag_r", None, None)], backfill.TASK_MAP_SCHEMA)
    inv = spark.createDataFrame([("p.s.t2", "NATIVE", dt.date(2024, 3, 1)),
                                 ("bkt/out/date=2024-03-02/", "FILES", dt.date(2024, 3, 2))],
                                backfill.INVENTORY_SCHEMA)
    items = backfill.build_plan_items(nodes, edges, cad, tm, inv, root="root.job", run_date="2024-03-02",
                                      plan_id="p1", created_at="2024-03-03 00:00:00").orderBy("priority").collect()
    assert [(r.downstream_table, r.priority) for r in items] == [("p.s.t2", 100), ("p.s.t3", 110)]
    assert items[0].recommended_cmd == "airflow dags backfill dag_r -s 2024-03-02 -e 2024-03-02"
    assert items[0].reason == "Missing 2024-03-02; no task mapping for root.job"
    assert items[1].recommended_cmd.startswith("-- Add task_map row")
    assert items[1].reason == "Missing 2024-03-02; producing job unmapped: etl.b (stubbed ops.task_map)"
    assert items[1].task_map_stubbed and not items[0].task_map_stubbed
    up = {r.job_name: r for r in backfill.upsert_task_map_stubs(
        tm, spark.createDataFrame([("etl.b",), ("root.job",)], "job_name string")).collect()}
    assert up["etl.b"].notes == "stubbed by planner" and up["root.job"].dag_id == "dag_r"
    assert up["root.job"].notes == "stubbed by planner"


def test_task_command_with_field(spark):
    nodes, edges = graph(spark)
    cad = spark.createDataFrame([("etl.b", "daily", " biz_date ", "o", True)], backfill.CADENCE_SCHEMA)
    tm = spark.createDataFrame([("etl.b", "dag_b", "t_b", "n")], backfill.TASK_MAP_SCHEMA)
    inv = spark.createDataFrame([], backfill.INVENTORY_SCHEMA)
    items = {r.downstream_table: r for r in backfill.build_plan_items(
        nodes, edges, cad, tm, inv, root="root.job", run_date="2024-03-02", plan_id="p",
        created_at="2024-03-03 00:00:00").collect()}
    r = items["p.s.t3"]
    assert r.recommended_cmd == "airflow tasks run dag_b t_b 2024-03-02 --local"
    assert r.reason == "Missing 2024-03-02 in p.s.t3 (field: biz_date)"
    assert "bkt/out/date=2024-03-02/" in items


def test_plan_is_empty_when_nothing_is_missing(spark):
    nodes, edges = graph(spark)
    cad = spark.createDataFrame([], backfill.CADENCE_SCHEMA)
    tm = spark.createDataFrame([], backfill.TASK_MAP_SCHEMA)
    inv = spark.createDataFrame([("p.s.t2", "UNPARTITIONED", None), ("p.s.t3", "NATIVE", dt.date(2024, 3, 2)),
                                 ("bkt/out/date=2024-03-02/", "FILES", dt.date(2024, 3, 2))],
                                backfill.INVENTORY_SCHEMA)
    items = backfill.build_plan_items(nodes, edges, cad, tm, inv, root="root.job", run_date="2024-03-02",
                                      plan_id="p", created_at="2024-03-03 00:00:00")
    assert items.count() == 0


def test_job_io_chunks_exact_and_bounded(spark):
    nodes, edges = graph(spark)
    io = lineage.job_io_edges(nodes, edges)
    lists = {r.job_name: r for r in lineage.job_io_lists(io).collect()}
    for size in (1, 1000):
        rows = lineage.job_io_chunks(io, chunk_size=size, hot_rows=1).collect()
        assert all(len(r.datasets) <= size for r in rows)
        for job, r in lists.items():
            for direction, want in (("in", r.inputs), ("out", r.outputs)):
                got = [d for c in sorted((x for x in rows if x.job_name == job and x.direction == direction),
                                         key=lambda x: x.chunk) for d in c.datasets]
                assert got == list(want)


def test_root_graph_plans_own_outputs_and_refuses_other_roots(spark):
    import pytest

    nodes, edges = lineage.root_graph(*graph(spark), "ns:root.job")
    io = lineage.job_io_edges(nodes, edges)
    assert {r.job_name for r in io.collect()} == {"root.job"}
    cad, tm = spark.createDataFrame([], backfill.CADENCE_SCHEMA), spark.createDataFrame([], backfill.TASK_MAP_SCHEMA)
    inv = spark.createDataFrame([], backfill.INVENTORY_SCHEMA)
    items = backfill.build_plan_items(nodes, edges, cad, tm, inv, root="root.job", run_date="2024-03-02", plan_id="p",
                                      created_at="2024-03-03 00:00:00").collect()
    assert items and {r.producing_job for r in items} == {"root.job"}
    for bad in ("no.such.job", "bootstrap.x"):
        with pytest.raises(ValueError):
            lineage.root_graph(*graph(spark), bad)


def test_partition_status_reads_the_run_date_only(spark):
    d, other = dt.date(2024, 3, 2), dt.date(2024, 3, 1)
    inv = spark.createDataFrame([("a", "NATIVE", other), ("b", "NATIVE", d), ("b", "NATIVE", other),
                                 ("c", "EXTERNAL", d), ("d", "EXTERNAL", other), ("e", "UNPARTITIONED", None),
                                 ("f", "UNPARTITIONED", other), ("g/date=2024-03-02/", "FILES", d)],
                                backfill.INVENTORY_SCHEMA)
    for rows in (inv, backfill.dated_inventory(inv, "2024-03-02")):
        got = {r["__inv_ds"] for r in backfill.partition_status(rows, "2024-03-02").where("__exists").collect()}
        assert got == {"b", "c", "e", "f", "g/date=2024-03-02/"}


def plain_downstream(edges, root, limit=None):
    depth, todo = {root: 0}, [root]
    while todo:
        at = todo.pop(0)
        if limit is None or depth[at] < limit:
            for s, t in edges:
                if s == at and t not in depth:
                    depth[t] = depth[at] + 1
                    todo.append(t)
    return depth


def test_downstream_over_all_hops_with_cycles(spark):
    from slicewarden.operators import lineage

    edges = [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("a", "c"), ("x", "y"), ("d", "d"), ("a", "b"), ("d", None)]
    edges += [(f"n{k}", f"n{k + 1}") for k in range(12)] + [("d", "n0")]
    df = spark.createDataFrame(edges, "source string, target string")
    for root, limit in (("a", None), ("a", 2), ("a", 0), ("y", None), ("unknown", None)):
        got = lineage.downstream(df, spark.createDataFrame([(root,)], "id string"), limit)
        want = {k: v for k, v in plain_downstream(edges, root, limit).items() if k is not None}
        assert {r.id: r.depth for r in got.where("id is not null").collect()} == want


def test_missing_ranges(spark):
    import datetime as dt

    from slicewarden.operators import backfill

    made = spark.createDataFrame([("t.days", "j1"), ("t.days", "j0"), ("t.whole", "j2"), ("t.unknown", None),
                                  ("lake/a/date=2024-01-01/", "j3")], "ds_norm string, producing_job string")
    held = [("t.days", "NATIVE", d) for d in (1, 2, 5, 9)] + [("t.whole", "UNPARTITIONED", None)]
    held += [(f"lake/a/date=2024-01-{d:02d}/", "FILES", d) for d in (2, 3, 4, 5, 6, 7)]
    inv = spark.createDataFrame([(n, k, d and dt.date(2024, 1, d)) for n, k, d in held], backfill.INVENTORY_SCHEMA)
    got = backfill.missing_ranges(made, inv, "2024-01-01", "2024-01-08").collect()
    assert sorted((r.dataset, r.producing_job, r.from_date.day, r.to_date.day, [d.day for d in r.missing_partitions])
                  for r in got) == [
        ("lake/a/date=*/", "j3", 1, 1, [1]), ("lake/a/date=*/", "j3", 8, 8, [8]), ("t.days", "j1", 3, 4, [3, 4]),
        ("t.days", "j1", 6, 8, [6, 7, 8]), ("t.unknown", None, 1, 8, list(range(1, 9)))]


def shuffled(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_neighbourhood_and_hot_keys_leave_the_edges_where_they_lie(spark, monkeypatch, no_size_broadcast):
    from slicewarden.functions import joins

    nodes, edges = graph(spark)
    monkeypatch.setattr(lineage, "materialize", lambda df: df)          # the plans themselves
    hood_nodes, hood = lineage.neighbourhood(nodes, edges, "ns:root.job")
    assert "SortMergeJoin" not in shuffled(hood) and shuffled(hood).count("BroadcastHashJoin") == 2
    assert "SortMergeJoin" not in shuffled(hood_nodes)
    want = {x for r in hood.collect() for x in (r.source, r.target)}
    assert {r.id for r in hood_nodes.collect()} == want & {r.id for r in nodes.collect()}
    many = spark.range(40).selectExpr("cast(if(id < 9, 1, id) as string) as k")
    hot = joins.hot_keys(many, "k", 4)
    # Rows are counted by part first, and by key only in parts that may hold a hot one.
    assert "BroadcastHashJoin" in shuffled(hot) and {(r["__hk"], r["__salts"]) for r in hot.collect()} == {("1", 3)}


def test_downstream_writes_its_edges_once(spark, monkeypatch):
    kept = []
    store = lineage.stored
    monkeypatch.setattr(lineage, "stored", lambda df, name: kept.append(store(df, name)) or kept[-1])
    pairs = [(f"n{i}", f"n{i + 1}") for i in range(5)] * 3
    got = lineage.downstream(spark.createDataFrame(pairs, "source string, target string"),
                             spark.createDataFrame([("n0",)], "id string"))
    assert {(r.id, r.depth) for r in got.collect()} == {(f"n{i}", i) for i in range(6)}
    assert len(kept) == 1 and kept[0].count() == 5


def test_downstream_query_follows_chains_to_their_end(spark, tmpdir_path):
    import duckdb

    from slicewarden.plans import ORACLE, QUERIES

    # part k → job k → part k + 1 …: 15 hops, the last part back to job 3.
    chain = [(1, k, k) for k in range(1, 9)] + [(2, k + 1, k) for k in range(1, 9)] + [(1, 9, 3), (1, 90, 91)]
    rows = spark.createDataFrame(chain, "l_linenumber int, l_partkey long, l_suppkey long")
    rows.write.parquet(f"{tmpdir_path}/lineitem.parquet")
    got = [tuple(r) for r in QUERIES["lin_downstream"](spark, tmpdir_path).collect()]
    hops = [(f"part:{p}", f"job:{s}") if n == 1 else (f"job:{s}", f"part:{p}") for n, p, s in chain]
    want = plain_downstream(hops, "job:1")
    assert {i: d for i, d, _ in got} == want and max(want.values()) == 15
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS FROM read_parquet('{tmpdir_path}/lineitem.parquet/*.parquet')")
    assert sorted(got) == sorted(con.execute(ORACLE["lin_downstream"]).fetchall())


def test_lineage_graph_broadcasts_lookups_by_their_rows(spark, tmpdir_path, monkeypatch):
    import duckdb

    from slicewarden.functions import joins
    from slicewarden.plans import ORACLE, QUERIES, standins

    monkeypatch.setattr(joins, "FEW_KEYS", 3)
    plans, stored = {}, standins.stored
    monkeypatch.setattr(standins, "stored", lambda df, name: (plans.update({name: shuffled(df)}), stored(df, name))[1])
    # Keys come twice, with other attributes or the same; some are null.
    tables = {"lineitem": ("l_suppkey long, l_partkey long", [(s, p) for s in (1, 2, 3, None) for p in (1, 2, 3, 4, 9, None)]),
              "supplier": ("s_suppkey long, s_nationkey int", [(1, 0), (1, 5), (1, 6), (2, 7), (2, 7), (3, None), (None, 1)]),
              "part": ("p_partkey long, p_brand string, p_size int",
                       [(1, "Brand#1", 1), (1, "Brand#2", 30), (2, "Brand#1", 10), (2, "Brand#1", 11), (3, None, 3),
                        (4, "Brand#4", None), (None, "Brand#5", 5)])}
    con = duckdb.connect()
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmpdir_path}/{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS FROM read_parquet('{tmpdir_path}/{name}.parquet/*.parquet')")
    for query in ("lin_job_io", "lin_produced_datasets"):
        want = con.execute(ORACLE[query])
        columns = [d[0] for d in want.description]
        got = QUERIES[query](spark, tmpdir_path).select(*columns).collect()
        assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want.fetchall()))
    # The files are tiny, but more keys than are broadcast: both lookups go through a shuffle.
    assert "BroadcastHashJoin" not in plans["met"] and plans["met"].count("SortMergeJoin") == 2
    monkeypatch.setattr(joins, "FEW_KEYS", 100)
    QUERIES["lin_job_io"](spark, tmpdir_path)
    assert plans["met"].count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plans["met"]

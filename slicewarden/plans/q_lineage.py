"""Queries: lineage I/O, dataset names, backfill planning, task-map upsert."""

from __future__ import annotations

from pyspark.sql import functions as F

from slicewarden.functions import paths
from slicewarden.operators import backfill, lineage
from slicewarden.operators.dedupe import global_positions
from slicewarden.plans.registry import register
from slicewarden.plans.standins import (cadence_table, lineage_graph, partition_inventory, table,
                                        task_map_table)

ROOT = "etl.supplier_1"
RUN_DATE = "1996-03-15"
PLAN_ID = "plan-1996-03-15"
CREATED_AT = "2024-02-01 00:00:00"

LINEAGE_SQL = """
pairs AS (
  SELECT DISTINCT
    CASE WHEN s.s_nationkey = 0 THEN 'bootstrap.' ELSE 'etl.' END || 'supplier_' || CAST(s.s_suppkey AS VARCHAR)
      AS job,
    'bigquery:proj.bronze.part_' || CAST(l.l_partkey AS VARCHAR) AS input,
    CASE WHEN p.p_size < 5
           THEN 'gcs:lake' || replace(lower(p.p_brand), '#', '_') || '_n' || CAST(s.s_nationkey AS VARCHAR)
                || 'date=1995-01-01'
         WHEN p.p_size < 25
           THEN 'gcs:lake/silver//' || replace(lower(p.p_brand), '#', '_') || '_n' || CAST(s.s_nationkey AS VARCHAR)
                || '/date=1995-01-01'
         ELSE 'bigquery:proj.silver.' || replace(lower(p.p_brand), '#', '_') || '_n'
              || CAST(s.s_nationkey AS VARCHAR) END AS output
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN part p ON l.l_partkey = p.p_partkey
),
nodes AS (
  SELECT DISTINCT * FROM (
    SELECT 'JOB:ns:' || job AS id, 'JOB' AS type, job AS name FROM pairs
    UNION ALL SELECT 'DATASET:' || input, 'DATASET', input FROM pairs
    UNION ALL SELECT 'DATASET:' || output, 'DATASET', output FROM pairs)
),
edges AS (
  SELECT DISTINCT * FROM (
    SELECT 'DATASET:' || input AS source, 'JOB:ns:' || job AS target FROM pairs
    UNION ALL SELECT 'JOB:ns:' || job, 'DATASET:' || output FROM pairs)
),
resolved AS (
  SELECT sn.type AS st, sn.name AS sname, tn.type AS tt, tn.name AS tname
  FROM edges e JOIN nodes sn ON e.source = sn.id JOIN nodes tn ON e.target = tn.id
),
io AS (
  SELECT DISTINCT job_name, direction, dataset FROM (
    SELECT sname AS job_name, 'out' AS direction, tname AS dataset FROM resolved WHERE st = 'JOB' AND tt = 'DATASET'
    UNION ALL
    SELECT tname, 'in', sname FROM resolved WHERE st = 'DATASET' AND tt = 'JOB')
  WHERE NOT starts_with(job_name, 'bootstrap.')
)"""


def _ns(x: str) -> str:
    return f"(CASE WHEN strpos({x}, ':') > 0 THEN split_part({x}, ':', 1) ELSE '' END)"


def _name(x: str) -> str:
    return f"(CASE WHEN strpos({x}, ':') > 0 THEN substr({x}, strpos({x}, ':') + 1) ELSE {x} END)"


def _fix(x: str) -> str:
    n0 = f"trim(COALESCE({x}, ''))"
    n1 = (f"(CASE WHEN strpos({n0}, '/') = 0 AND strpos({n0}, 'date=') > 1 "
          f"THEN substr({n0}, 1, strpos({n0}, 'date=') - 1) || '/' || substr({n0}, strpos({n0}, 'date=')) "
          f"ELSE {n0} END)")
    n2 = f"replace({n1}, '//', '/')"
    return f"(CASE WHEN ends_with({n2}, '/') THEN {n2} ELSE {n2} || '/' END)"


def _norm(x: str) -> str:
    return f"(CASE WHEN {_ns(x)} = 'gcs' THEN {_fix(_name(x))} ELSE {_name(x)} END)"


def _retarget(x: str) -> str:
    return f"regexp_replace({x}, '(?i)^((?:.*?/)?)date=\\d{{4}}-\\d{{2}}-\\d{{2}}(/|$)', '\\1date={RUN_DATE}\\2')"


CONFIG_SQL = """
cadence AS (
  SELECT 'etl.supplier_' || CAST(s_suppkey AS VARCHAR) AS job_name, 'daily' AS cadence,
         CASE WHEN s_acctbal < 0 THEN NULL WHEN s_suppkey % 3 = 0 THEN '  ship_date ' ELSE '_ingestion_date' END
           AS expected_partition_field,
         'owner_' || CAST(s_nationkey AS VARCHAR) AS owner, s_nationkey % 5 <> 1 AS active
  FROM supplier
),
task_map AS (
  SELECT 'etl.supplier_' || CAST(s_suppkey AS VARCHAR) AS job_name,
         CASE WHEN s_nationkey % 4 <> 2 THEN 'dag_nation_' || CAST(s_nationkey AS VARCHAR) END AS dag_id,
         CASE WHEN s_suppkey % 2 = 0 THEN 'load_' || CAST(s_suppkey AS VARCHAR) END AS task_id,
         CASE WHEN s_suppkey % 7 = 0 THEN 'hand written' END AS notes
  FROM supplier WHERE s_nationkey % 4 <> 3
),
inv AS (
  SELECT DISTINCT * FROM (
    SELECT CASE WHEN p.p_size < 5 THEN 'lake' ELSE 'lake/silver/' END || replace(lower(p.p_brand), '#', '_')
             || '_n' || CAST(s.s_nationkey AS VARCHAR)
             || '/date=' || CAST(CAST(l.l_shipdate AS DATE) AS VARCHAR) || '/' AS dataset,
           'FILES' AS kind, CAST(l.l_shipdate AS DATE) AS partition_date
    FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN supplier s ON l.l_suppkey = s.s_suppkey
    WHERE p.p_size < 25
    UNION ALL
    SELECT 'proj.silver.' || replace(lower(p.p_brand), '#', '_') || '_n' || CAST(s.s_nationkey AS VARCHAR),
           CASE WHEN CAST(regexp_extract(p.p_brand, '#(\\d+)', 1) AS INTEGER) % 2 = 0 THEN 'NATIVE'
                ELSE 'UNPARTITIONED' END,
           CASE WHEN CAST(regexp_extract(p.p_brand, '#(\\d+)', 1) AS INTEGER) % 2 = 0
                THEN CAST(l.l_shipdate AS DATE) END
    FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN supplier s ON l.l_suppkey = s.s_suppkey
    WHERE p.p_size >= 25)
)"""

CANDIDATES_SQL = f"""
outs AS (
  SELECT job_name, dataset AS raw, {_norm('dataset')} AS ds_norm, {_ns('dataset')} = 'gcs' AS is_file
  FROM io WHERE direction = 'out'
),
cand AS (
  SELECT ds_norm, MAX(job_name) AS producing_job, BOOL_OR(job_name = '{ROOT}') AS is_bronze_output,
         BOOL_OR(is_file) AS is_file
  FROM outs GROUP BY ds_norm
),
cad AS (
  SELECT job_name, MAX(trim(COALESCE(expected_partition_field, ''))) AS field
  FROM cadence WHERE active GROUP BY job_name
),
st AS (
  SELECT dataset, MAX(kind) AS kind,
         BOOL_OR(COALESCE(partition_date = DATE '{RUN_DATE}', FALSE)) AS has_date
  FROM inv GROUP BY dataset
),
c AS (
  SELECT cand.*,
         CASE WHEN is_file THEN {_fix(_retarget('ds_norm'))} ELSE {_retarget('ds_norm')} END AS ds_target,
         CASE WHEN is_bronze_output THEN NULL
              ELSE COALESCE(CASE WHEN cad.job_name IS NOT NULL THEN cad.field END, '_ingestion_date') END
           AS part_field
  FROM cand LEFT JOIN cad ON cand.producing_job = cad.job_name
),
c2 AS (
  SELECT c.*, COALESCE(CASE WHEN st.kind IN ('UNPARTITIONED', 'FILES') THEN TRUE ELSE st.has_date END, FALSE)
           AS partition_exists
  FROM c LEFT JOIN st ON c.ds_target = st.dataset
),
tm AS (SELECT job_name, MAX(dag_id) AS dag_id, MAX(task_id) AS task_id FROM task_map GROUP BY job_name),
m AS (
  SELECT c2.*, tm.dag_id, tm.task_id,
         COALESCE(tm.dag_id, '') = '' AND COALESCE(c2.producing_job, '') <> '' AS task_map_stubbed
  FROM c2 LEFT JOIN tm ON c2.producing_job = tm.job_name WHERE NOT c2.partition_exists
),
items AS (
  SELECT '{PLAN_ID}' AS plan_id, ds_target AS downstream_table, COALESCE(producing_job, 'unknown') AS producing_job,
         '{RUN_DATE}' AS missing_partitions,
         CASE WHEN COALESCE(dag_id, '') <> '' AND COALESCE(task_id, '') <> ''
                THEN 'airflow tasks run ' || dag_id || ' ' || task_id || ' {RUN_DATE} --local'
              WHEN COALESCE(dag_id, '') <> ''
                THEN 'airflow dags backfill ' || dag_id || ' -s {RUN_DATE} -e {RUN_DATE}'
              ELSE '-- Add task_map row for producing job to get precise command' END AS recommended_cmd,
         CASE WHEN COALESCE(dag_id, '') <> '' AND COALESCE(task_id, '') <> ''
                THEN 'Missing {RUN_DATE} in ' || ds_target
                     || CASE WHEN part_field IS NULL THEN '' ELSE ' (field: ' || part_field || ')' END
              WHEN COALESCE(dag_id, '') <> ''
                THEN 'Missing {RUN_DATE}; no task mapping for ' || COALESCE(producing_job, 'unknown')
              ELSE 'Missing {RUN_DATE}; producing job unmapped: ' || COALESCE(producing_job, 'unknown')
                   || CASE WHEN task_map_stubbed THEN ' (stubbed ops.task_map)' ELSE '' END END AS reason,
         CAST(90 + 10 * ROW_NUMBER() OVER (ORDER BY ds_norm) AS BIGINT) AS priority,
         task_map_stubbed, TIMESTAMP '{CREATED_AT}' AS created_at
  FROM m
)"""


def _graph(spark, sf_dir):
    return lineage_graph(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "supplier"),
                         table(spark, sf_dir, "part"))


@register("lin_job_io", f"""
WITH {LINEAGE_SQL.strip()}
SELECT job_name,
       COALESCE(STRING_AGG(dataset, '|' ORDER BY dataset) FILTER (WHERE direction = 'in'), '') AS inputs,
       COALESCE(STRING_AGG(dataset, '|' ORDER BY dataset) FILTER (WHERE direction = 'out'), '') AS outputs,
       COUNT(*) FILTER (WHERE direction = 'in') AS n_inputs,
       COUNT(*) FILTER (WHERE direction = 'out') AS n_outputs
FROM io GROUP BY job_name""")
def lin_job_io(spark, sf_dir):
    """LIN-1/JOIN-8/AGG-10/FLT-10: per job sorted distinct inputs and outputs."""
    nodes, edges = _graph(spark, sf_dir)
    lists = lineage.job_io_lists(lineage.job_io_edges(nodes, edges))
    return lists.select("job_name", F.array_join("inputs", "|").alias("inputs"),
                        F.array_join("outputs", "|").alias("outputs"),
                        F.size("inputs").cast("long").alias("n_inputs"),
                        F.size("outputs").cast("long").alias("n_outputs"))


@register("lin_job_io_hot", f"""
WITH {LINEAGE_SQL.strip()}
SELECT DISTINCT job_name, direction, dataset FROM io""")
def lin_job_io_hot(spark, sf_dir):
    """JOIN-8 on its branch for hot keys: node ids with more than ten edges are
    dealt to salts."""
    nodes, edges = _graph(spark, sf_dir)
    return lineage.job_io_edges(nodes, edges, hot_rows=10)


@register("lin_produced_datasets", f"""
WITH {LINEAGE_SQL.strip()}
SELECT DISTINCT dataset FROM io WHERE direction = 'out'""")
def lin_produced_datasets(spark, sf_dir):
    """AGG-11: distinct datasets written by non-system jobs."""
    nodes, edges = _graph(spark, sf_dir)
    return lineage.produced_datasets(lineage.job_io_edges(nodes, edges))


@register("lin_neighbourhood", f"""
WITH {LINEAGE_SQL.strip()},
root AS (SELECT id FROM nodes WHERE type = 'JOB' AND name = '{ROOT}')
SELECT DISTINCT source, target FROM edges WHERE source IN (SELECT id FROM root) OR target IN (SELECT id FROM root)""")
def lin_neighbourhood(spark, sf_dir):
    """LIN-2: edges one hop around the root job."""
    nodes, edges = _graph(spark, sf_dir)
    _, hood_edges = lineage.neighbourhood(nodes, edges, ROOT)
    return hood_edges.select("source", "target")


@register("lin_neighbourhood_nodes", f"""
WITH {LINEAGE_SQL.strip()},
root AS (SELECT id FROM nodes WHERE type = 'JOB' AND name = '{ROOT}'),
hood AS (SELECT source, target FROM edges
         WHERE source IN (SELECT id FROM root) OR target IN (SELECT id FROM root))
SELECT id, type, name FROM nodes WHERE id IN (SELECT source FROM hood UNION SELECT target FROM hood)""")
def lin_neighbourhood_nodes(spark, sf_dir):
    """LIN-2: nodes one hop around the root job."""
    hood_nodes, _ = lineage.root_graph(*_graph(spark, sf_dir), ROOT)
    return hood_nodes.select("id", "type", "name")


@register("dsn_dataset_names", f"""
WITH {LINEAGE_SQL.strip()},
d AS (SELECT DISTINCT dataset FROM io WHERE direction = 'out')
SELECT dataset, {_ns('dataset')} AS namespace, {_norm('dataset')} AS ds_norm,
       CASE WHEN {_ns('dataset')} = 'gcs' THEN {_fix(_retarget(_norm('dataset')))}
            ELSE {_retarget(_norm('dataset'))} END AS ds_target
FROM d""")
def dsn_dataset_names(spark, sf_dir):
    """DSN-1: namespace, normalised name and date-retargeted name."""
    nodes, edges = _graph(spark, sf_dir)
    d = lineage.produced_datasets(lineage.job_io_edges(nodes, edges))
    norm = paths.normalise(F.col("dataset"))
    tgt = paths.retarget_date(norm, RUN_DATE)
    return d.select("dataset", paths.namespace(F.col("dataset")).alias("namespace"), norm.alias("ds_norm"),
                    F.when(paths.is_file_dataset(F.col("dataset")), paths.fix_file_path(tgt)).otherwise(tgt)
                    .alias("ds_target"))


def _config(spark, sf_dir):
    sup = table(spark, sf_dir, "supplier")
    inv = partition_inventory(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part"), sup)
    return cadence_table(sup), task_map_table(sup), inv


def _items(spark, sf_dir):
    nodes, edges = _graph(spark, sf_dir)
    cad, tm, inv = _config(spark, sf_dir)
    return backfill.build_plan_items(nodes, edges, cad, tm, inv, root=ROOT, run_date=RUN_DATE, plan_id=PLAN_ID,
                                     created_at=CREATED_AT)


@register("bkf_plan_items", f"""
WITH {LINEAGE_SQL.strip()}, {CONFIG_SQL.strip()}, {CANDIDATES_SQL.strip()}
SELECT * FROM items""")
def bkf_plan_items(spark, sf_dir):
    """BKF-5 (BKF-1/2/3, DSN-1, JOIN-5/6/7, WIN-3, SRT-2): plan items for
    every produced dataset missing the run date."""
    items = _items(spark, sf_dir)
    rendered = {"missing_partitions": F.array_join(F.transform("missing_partitions", lambda x: x.cast("string")), ","),
                "created_at": F.col("created_at").cast("timestamp_ntz")}
    return items.select(*[rendered[c].alias(c) if c in rendered else F.col(c) for c in items.columns])


ROOT_CANDIDATES_SQL = CANDIDATES_SQL.replace(
    "FROM io WHERE direction = 'out'", f"FROM io WHERE direction = 'out' AND job_name = '{ROOT}'")


@register("bkf_root_plan_items", f"""
WITH {LINEAGE_SQL.strip()}, {CONFIG_SQL.strip()}, {ROOT_CANDIDATES_SQL.strip()}
SELECT downstream_table, producing_job, missing_partitions, recommended_cmd, reason, priority, task_map_stubbed
FROM items""")
def bkf_root_plan_items(spark, sf_dir):
    """BKF-5 for the root job only: its own outputs that miss the run date."""
    nodes, edges = lineage.root_graph(*_graph(spark, sf_dir), ROOT)
    cad, tm, inv = _config(spark, sf_dir)
    items = backfill.build_plan_items(nodes, edges, cad, tm, inv, root=ROOT, run_date=RUN_DATE, plan_id=PLAN_ID,
                                      created_at=CREATED_AT)
    dates = F.array_join(F.transform("missing_partitions", lambda x: x.cast("string")), ",")
    return items.select("downstream_table", "producing_job", dates.alias("missing_partitions"), "recommended_cmd",
                        "reason", "priority", "task_map_stubbed")


@register("bkf_partition_status", f"""
WITH {LINEAGE_SQL.strip()}, {CONFIG_SQL.strip()}, {CANDIDATES_SQL.strip()}
SELECT ds_target AS dataset, partition_exists FROM c2""")
def bkf_partition_status(spark, sf_dir):
    """BKF-1/JOIN-7: does each retargeted candidate hold the run date?"""
    nodes, edges = _graph(spark, sf_dir)
    cad, _, inv = _config(spark, sf_dir)
    cands = backfill.plan_candidates(nodes, edges, cad, inv, root=ROOT, run_date=RUN_DATE)
    return cands.select(F.col("ds_target").alias("dataset"), "partition_exists")


@register("bkf_task_map_upsert", f"""
WITH {LINEAGE_SQL.strip()}, {CONFIG_SQL.strip()}, {CANDIDATES_SQL.strip()},
stubs AS (SELECT DISTINCT producing_job AS job_name FROM items WHERE task_map_stubbed)
SELECT COALESCE(t.job_name, s.job_name) AS job_name, t.dag_id, t.task_id,
       CASE WHEN s.job_name IS NOT NULL THEN COALESCE(t.notes, 'stubbed by planner') ELSE t.notes END AS notes
FROM task_map t FULL OUTER JOIN stubs s ON t.job_name = s.job_name""")
def bkf_task_map_upsert(spark, sf_dir):
    """BKF-4/JOIN-4: task map after upserting stubs for unmapped producers."""
    nodes, edges = _graph(spark, sf_dir)
    cad, tm, inv = _config(spark, sf_dir)
    cands = backfill.plan_candidates(nodes, edges, cad, inv, root=ROOT, run_date=RUN_DATE)
    missing = backfill.missing_with_mapping(cands, tm)
    return backfill.upsert_task_map_stubs(tm, backfill.stub_targets(missing))


CHUNK = 100


@register("lin_job_io_chunks", f"""
WITH {LINEAGE_SQL.strip()},
ranked AS (SELECT job_name, direction, dataset,
                  (ROW_NUMBER() OVER (PARTITION BY job_name, direction ORDER BY dataset) - 1) // {CHUNK} AS chunk
           FROM io)
SELECT job_name, direction, CAST(chunk AS BIGINT) AS chunk, STRING_AGG(dataset, '|' ORDER BY dataset) AS datasets,
       COUNT(*) AS n_datasets
FROM ranked GROUP BY job_name, direction, chunk""")
def lin_job_io_chunks(spark, sf_dir):
    """AGG-10 bounded: each job's sorted inputs / outputs in chunks of 100."""
    nodes, edges = _graph(spark, sf_dir)
    chunks = lineage.job_io_chunks(lineage.job_io_edges(nodes, edges), chunk_size=CHUNK)
    return chunks.select("job_name", "direction", "chunk", F.array_join("datasets", "|").alias("datasets"),
                         F.size("datasets").cast("long").alias("n_datasets"))


RANGE = ("1995-01-01", "1995-01-30")


def _undated_sql(x: str) -> str:
    return f"regexp_replace({x}, '(?i)date=\\d{{4}}-\\d{{2}}-\\d{{2}}', 'date=*')"


@register("bkf_missing_ranges", f"""
WITH {LINEAGE_SQL.strip()}, {CONFIG_SQL.strip()}, {CANDIDATES_SQL.strip()},
wanted AS (SELECT {_undated_sql('ds_norm')} AS dataset, MAX(producing_job) AS producing_job FROM cand GROUP BY 1),
kept AS (SELECT * FROM wanted WHERE dataset NOT IN (SELECT dataset FROM inv WHERE kind = 'UNPARTITIONED')),
days AS (SELECT CAST(d AS DATE) AS day FROM range(DATE '{RANGE[0]}', DATE '{RANGE[1]}' + 1, INTERVAL 1 DAY) t(d)),
held AS (SELECT DISTINCT {_undated_sql('dataset')} AS dataset, partition_date AS day FROM inv),
gaps AS (SELECT k.*, d.day FROM kept k, days d
         WHERE NOT EXISTS (SELECT 1 FROM held h WHERE h.dataset = k.dataset AND h.day = d.day)),
runs AS (SELECT *, day - CAST(ROW_NUMBER() OVER (PARTITION BY dataset ORDER BY day) AS INTEGER) AS island FROM gaps)
SELECT dataset, MAX(producing_job) AS producing_job, MIN(day) AS from_date, MAX(day) AS to_date,
       STRING_AGG(CAST(day AS VARCHAR), ',' ORDER BY day) AS missing_partitions
FROM runs GROUP BY dataset, island""")
def bkf_missing_ranges(spark, sf_dir):
    """BKF-5/JOIN-7 over 30 days: every missing date of every produced dataset,
    as runs of neighbouring days."""
    nodes, edges = _graph(spark, sf_dir)
    cad, _, inv = _config(spark, sf_dir)
    made = backfill.plan_candidates(nodes, edges, cad, inv, root=ROOT, run_date=RUN_DATE)
    found = backfill.missing_ranges(made, inv, *RANGE)
    return found.withColumn("missing_partitions", F.array_join(
        F.transform("missing_partitions", lambda d: d.cast("string")), ","))


# Jobs (suppliers) that read a part's table where a line is the first of its
# order and write it elsewhere: a graph of several hops with cycles.
_HOPS_SQL = """
hops AS (
  SELECT DISTINCT CASE WHEN l_linenumber = 1 THEN 'part:' || l_partkey ELSE 'job:' || l_suppkey END AS source,
         CASE WHEN l_linenumber = 1 THEN 'job:' || l_suppkey ELSE 'part:' || l_partkey END AS target
  FROM lineitem WHERE l_partkey IS NOT NULL AND l_suppkey IS NOT NULL),
start AS (SELECT 'job:' || MIN(l_suppkey) AS id FROM lineitem)"""


@register("lin_downstream", f"""
WITH RECURSIVE {_HOPS_SQL.strip()},
near(id, depth) USING KEY (id) AS (
  SELECT id, 0 FROM start
  UNION
  SELECT h.target, MIN(w.depth) + 1 FROM near w JOIN hops h ON h.source = w.id
  WHERE NOT EXISTS (SELECT 1 FROM recurring.near n WHERE n.id = h.target) GROUP BY h.target)
SELECT id, depth, CAST(90 + 10 * ROW_NUMBER() OVER (ORDER BY depth, id) AS BIGINT) AS priority FROM near""")
def lin_downstream(spark, sf_dir):
    """LIN-2/BKF-5 over all hops: what can be reached from a root job through
    a graph with cycles, priorities in dependency order."""
    rows = table(spark, sf_dir, "lineitem").where("l_partkey is not null and l_suppkey is not null")
    job, part = F.concat(F.lit("job:"), F.col("l_suppkey")), F.concat(F.lit("part:"), F.col("l_partkey"))
    reads = F.col("l_linenumber") == 1
    edges = rows.select(F.when(reads, part).otherwise(job).alias("source"), F.when(reads, job).otherwise(part).alias("target"))
    start = rows.agg(F.concat(F.lit("job:"), F.min("l_suppkey")).alias("id"))
    found = lineage.downstream(edges, start)
    ranked = global_positions(found, [F.col("depth"), F.col("id")], name="position")
    return ranked.select("id", "depth", (90 + 10 * F.col("position")).alias("priority"))

"""Backfill planning from lineage: which produced datasets miss a date, who
produces them, and the command to rerun.

One plan of joins replaces the per-dataset loop of remote probes:

    lineage edges → produced datasets (normalised) → producer lookup
      → partition inventory (anti test) → cadence / task map lookups
      → command and reason texts → priority by name order
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicewarden.functions import paths, text
from slicewarden.operators.dedupe import global_positions
from slicewarden.operators.lineage import job_io_edges

# Fixed values.
DEFAULT_PARTITION_FIELD = "_ingestion_date"
FIRST_PRIORITY = 100
PRIORITY_STEP = 10
PLAN_STATUS = "PLANNED"
STUB_NOTE = "stubbed by planner"

# Kinds in a partition inventory (dataset, kind, partition_date):
#   FILES          folder prefix ending in date=YYYY-MM-DD/ that holds files
#   EXTERNAL       table over hive-style files; partitions by file date
#   NATIVE         date-partitioned table
#   UNPARTITIONED  table without partitions (always available)
INVENTORY_SCHEMA = T.StructType([
    T.StructField("dataset", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("partition_date", T.DateType()),
])

CADENCE_SCHEMA = T.StructType([
    T.StructField("job_name", T.StringType()), T.StructField("cadence", T.StringType()),
    T.StructField("expected_partition_field", T.StringType()), T.StructField("owner", T.StringType()),
    T.StructField("active", T.BooleanType()),
])
TASK_MAP_SCHEMA = T.StructType([
    T.StructField("job_name", T.StringType()), T.StructField("dag_id", T.StringType()),
    T.StructField("task_id", T.StringType()), T.StructField("notes", T.StringType()),
])
PLAN_SCHEMA = T.StructType([
    T.StructField("plan_id", T.StringType()), T.StructField("requested_date", T.DateType()),
    T.StructField("root_bronze_table", T.StringType()), T.StructField("created_at", T.TimestampType()),
    T.StructField("created_by", T.StringType()), T.StructField("status", T.StringType()),
])
PLAN_ITEM_SCHEMA = T.StructType([
    T.StructField("plan_id", T.StringType()), T.StructField("downstream_table", T.StringType()),
    T.StructField("producing_job", T.StringType()),
    T.StructField("missing_partitions", T.ArrayType(T.DateType())),
    T.StructField("recommended_cmd", T.StringType()), T.StructField("reason", T.StringType()),
    T.StructField("priority", T.LongType()), T.StructField("created_at", T.TimestampType()),
])


def file_folders(file_paths: DataFrame, path_col: str = "path") -> DataFrame:
    """FILES inventory rows from a file listing: the folder up to and
    including the first ``date=YYYY-MM-DD/`` segment of each file."""
    folder = F.regexp_extract(F.col(path_col), r"(?i)^((?:.*?/)?date=\d{4}-\d{2}-\d{2}/)", 1)
    day = F.to_date(F.regexp_extract(F.col(path_col), r"(?i)date=(\d{4}-\d{2}-\d{2})", 1))
    return (file_paths.select(folder.alias("dataset"), F.lit("FILES").alias("kind"), day.alias("partition_date"))
            .where(F.col("dataset") != "").distinct())


def external_partitions(file_paths: DataFrame, dataset: str, path_col: str = "path") -> DataFrame:
    """EXTERNAL inventory rows of a table over hive-style files: the dates
    found in its file paths (``date=YYYY-MM-DD``)."""
    day = F.to_date(F.regexp_extract(F.col(path_col), r"date=(\d{4}-\d{2}-\d{2})", 1))
    return (file_paths.select(F.lit(dataset).alias("dataset"), F.lit("EXTERNAL").alias("kind"),
                              day.alias("partition_date"))
            .where(F.col("partition_date").isNotNull()).distinct())


def dated_inventory(inventory: DataFrame, run_date: str) -> DataFrame:
    """Inventory rows that can make the run date exist: those of other dates
    are cut before any shuffle (a folder's date is part of its name)."""
    day = F.col("partition_date")
    return inventory.where((day == F.to_date(F.lit(run_date))) | day.isNull() | (F.col("kind") == "UNPARTITIONED"))


def partition_status(inventory: DataFrame, run_date: str) -> DataFrame:
    """Per dataset: does the run date exist?  Absent datasets are missing;
    unpartitioned tables always exist; partitioned ones need the date."""
    d = F.to_date(F.lit(run_date))
    agg = inventory.groupBy("dataset").agg(
        F.max("kind").alias("kind"),
        F.bool_or(F.coalesce(F.col("partition_date") == d, F.lit(False))).alias("has_date"),
    )
    exists = F.when(F.col("kind").isin("UNPARTITIONED", "FILES"), F.lit(True)).otherwise(F.col("has_date"))
    return agg.select(F.col("dataset").alias("__inv_ds"), exists.alias("__exists"))


def plan_candidates(nodes: DataFrame, edges: DataFrame, cadence: DataFrame, inventory: DataFrame, *,
                    root: str, run_date: str) -> DataFrame:
    """Every dataset produced in the graph, normalised and retargeted to the
    run date, with its producer, partition field and whether the run date
    exists: ds_norm, ds_target, producing_job, is_bronze_output, part_field,
    partition_exists.

    When several jobs write the same dataset the greatest job name is taken
    (the original kept whichever it saw last).
    """
    io = job_io_edges(nodes, edges)
    outs = io.where(F.col("direction") == "out").select(
        "job_name", paths.normalise(F.col("dataset")).alias("ds_norm"),
        paths.is_file_dataset(F.col("dataset")).alias("is_file"))
    candidates = outs.groupBy("ds_norm").agg(
        F.max("job_name").alias("producing_job"),
        F.bool_or(F.col("job_name") == F.lit(root)).alias("is_bronze_output"),
        F.bool_or("is_file").alias("is_file"),
    )
    cad = (cadence.where(F.col("active"))
           .groupBy("job_name").agg(F.max(F.trim(F.coalesce(F.col("expected_partition_field"), F.lit(""))))
                                   .alias("__field"))
           .withColumnRenamed("job_name", "__cad_job"))
    target = paths.retarget_date(F.col("ds_norm"), run_date)
    target = F.when(F.col("is_file"), paths.fix_file_path(target)).otherwise(target)
    c = candidates.withColumn("ds_target", target)
    c = c.join(cad, c["producing_job"] == cad["__cad_job"], "left")
    part_field = F.when(F.col("is_bronze_output"), F.lit(None).cast("string")).otherwise(
        F.coalesce(F.when(F.col("__cad_job").isNotNull(), F.col("__field")), F.lit(DEFAULT_PARTITION_FIELD)))
    status = partition_status(dated_inventory(inventory, run_date), run_date)
    c = c.withColumn("part_field", part_field).join(status, F.col("ds_target") == status["__inv_ds"], "left")
    return c.select("ds_norm", "ds_target", "producing_job", "is_bronze_output", "part_field",
                    F.coalesce(F.col("__exists"), F.lit(False)).alias("partition_exists"))


def _undated(dataset: Column) -> Column:
    """A folder's name without its date, so that all its dates meet."""
    return F.regexp_replace(dataset, r"(?i)date=\d{4}-\d{2}-\d{2}", "date=*")


def missing_ranges(datasets: DataFrame, inventory: DataFrame, start: str, end: str) -> DataFrame:
    """Gaps of a whole calendar: for each dataset (columns ``ds_norm``,
    ``producing_job``) the runs of neighbouring days from ``start`` to ``end`` that
    it misses: dataset, producing_job, from_date, to_date, missing_partitions.

    Unpartitioned tables miss nothing, datasets the inventory does not know
    miss every day; folders of one name that differ in their date are one
    dataset.  The calendar is unfolded per dataset and one equality join with
    the inventory finds the days that are there; a dataset's window holds at
    most a row a day.
    """
    days = F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)))
    wanted = (datasets.groupBy(_undated(F.col("ds_norm")).alias("dataset"))
              .agg(F.max("producing_job").alias("producing_job")))
    held = inventory.where(F.col("kind") == "UNPARTITIONED").select(F.col("dataset").alias("whole")).distinct()
    wanted = wanted.join(held, wanted["dataset"] == held["whole"], "left_anti")
    there = (inventory.where(F.col("partition_date").between(F.to_date(F.lit(start)), F.to_date(F.lit(end))))
             .select(_undated(F.col("dataset")).alias("ds"), F.col("partition_date").alias("held_on")).distinct())
    missing = (wanted.select("*", F.explode(days).alias("day"))
               .join(there, (F.col("dataset") == F.col("ds")) & (F.col("day") == F.col("held_on")), "left_anti"))
    order = Window.partitionBy("dataset").orderBy("day")
    island = F.date_sub(F.col("day"), F.row_number().over(order))
    return (missing.withColumn("island", island).groupBy("dataset", "island")
            .agg(F.max("producing_job").alias("producing_job"), F.min("day").alias("from_date"),
                 F.max("day").alias("to_date"), F.array_sort(F.collect_list("day")).alias("missing_partitions"))
            .drop("island"))


def missing_with_mapping(candidates: DataFrame, task_map: DataFrame, auto_stub: bool = True) -> DataFrame:
    """Candidates missing the run date, with the producer's dag and task and
    whether a task-map stub is attempted (no dag known)."""
    tm = (task_map.groupBy("job_name").agg(F.max("dag_id").alias("dag_id"), F.max("task_id").alias("task_id"))
          .withColumnRenamed("job_name", "__tm_job"))
    missing = candidates.where(~F.col("partition_exists"))
    missing = missing.join(tm, missing["producing_job"] == tm["__tm_job"], "left")
    has_dag = F.coalesce(F.col("dag_id"), F.lit("")) != ""
    # The stub is attempted for unmapped producers (the flag means "attempted").
    stubbed = (~has_dag & (F.coalesce(F.col("producing_job"), F.lit("")) != "")) if auto_stub else F.lit(False)
    return missing.select("ds_norm", "ds_target", "producing_job", "part_field", "dag_id", "task_id",
                          stubbed.alias("task_map_stubbed"))


def build_plan_items(nodes: DataFrame, edges: DataFrame, cadence: DataFrame, task_map: DataFrame,
                     inventory: DataFrame, *, root: str, run_date: str, plan_id: str,
                     created_at: str, auto_stub: bool = True) -> DataFrame:
    """Plan items for every produced dataset that misses ``run_date``.

    Columns: plan_id, downstream_table, producing_job, missing_partitions,
    recommended_cmd, reason, priority, task_map_stubbed, created_at.
    Priorities follow the normalised names: 100, 110, 120, ...
    """
    cands = plan_candidates(nodes, edges, cadence, inventory, root=root, run_date=run_date)
    items = missing_with_mapping(cands, task_map, auto_stub)
    ranked = global_positions(items, [F.col("ds_norm")], name="__pos")
    dag, task, job = F.col("dag_id"), F.col("task_id"), F.col("producing_job")
    return ranked.select(
        F.lit(plan_id).alias("plan_id"),
        F.col("ds_target").alias("downstream_table"),
        F.coalesce(job, F.lit(text.UNKNOWN_JOB)).alias("producing_job"),
        F.array(F.to_date(F.lit(run_date))).alias("missing_partitions"),
        text.command(dag, task, run_date).alias("recommended_cmd"),
        text.reason(dag, task, F.col("ds_target"), job, F.col("part_field"), F.col("task_map_stubbed"),
                    run_date).alias("reason"),
        (F.lit(FIRST_PRIORITY - PRIORITY_STEP) + F.lit(PRIORITY_STEP) * F.col("__pos")).cast("long").alias("priority"),
        F.col("task_map_stubbed"),
        F.to_timestamp(F.lit(created_at)).alias("created_at"),
    )


def plan_header(spark, *, plan_id: str, run_date: str, root: str, created_by: str, created_at: str) -> DataFrame:
    """The plan's header row (root without namespace, status PLANNED)."""
    import datetime as _dt

    row = (plan_id, _dt.date.fromisoformat(run_date), root.split(":", 1)[-1],
           _dt.datetime.fromisoformat(created_at), created_by, PLAN_STATUS)
    return spark.createDataFrame([row], PLAN_SCHEMA)


def upsert_task_map_stubs(task_map: DataFrame, jobs: DataFrame, note: str = STUB_NOTE) -> DataFrame:
    """Insert a stub row for each job without one; for jobs that have one,
    fill only NULL fields (dag_id, task_id from the stub are NULL; notes gets
    the note when empty).  A full outer join on job_name, i.e. a MERGE.
    """
    s = jobs.select(F.col("job_name").alias("__s_job")).where(F.col("__s_job").isNotNull()).distinct()
    t = task_map.alias("t")
    j = t.join(s, F.col("t.job_name") == F.col("__s_job"), "full_outer")
    matched_or_target = F.col("t.job_name").isNotNull()
    return j.select(
        F.when(matched_or_target, F.col("t.job_name")).otherwise(F.col("__s_job")).alias("job_name"),
        F.col("t.dag_id").alias("dag_id"),
        F.col("t.task_id").alias("task_id"),
        F.when(F.col("__s_job").isNotNull(), F.coalesce(F.col("t.notes"), F.lit(note)))
        .otherwise(F.col("t.notes")).alias("notes"),
    )


def stub_targets(items: DataFrame) -> DataFrame:
    """Producing jobs whose task-map row the planner stubs."""
    return items.where(F.col("task_map_stubbed")).select(F.col("producing_job").alias("job_name")).distinct()

"""Backfill command and reason texts, built as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of backfill plan items; the other texts stand in the functions below.
NO_MAPPING_CMD = "-- Add task_map row for producing job to get precise command"
STUBBED_SUFFIX = " (stubbed ops.task_map)"
UNKNOWN_JOB = "unknown"


def _present(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) != ""


def command(dag: Column, task: Column, run_date: str) -> Column:
    """Task command when dag and task are known, dag backfill when only the
    dag is, else a hint."""
    return (
        F.when(
            _present(dag) & _present(task),
            F.concat(F.lit("airflow tasks run "), dag, F.lit(" "), task, F.lit(f" {run_date} --local")),
        )
        .when(_present(dag), F.concat(F.lit("airflow dags backfill "), dag, F.lit(f" -s {run_date} -e {run_date}")))
        .otherwise(F.lit(NO_MAPPING_CMD))
    )


def reason(dag: Column, task: Column, target: Column, job: Column, part_field: Column,
           stubbed: Column, run_date: str) -> Column:
    job_txt = F.coalesce(job, F.lit(UNKNOWN_JOB))
    field_txt = F.when(part_field.isNull(), F.lit("")).otherwise(
        F.concat(F.lit(" (field: "), part_field, F.lit(")")))
    return (
        F.when(_present(dag) & _present(task),
               F.concat(F.lit(f"Missing {run_date} in "), target, field_txt))
        .when(_present(dag), F.concat(F.lit(f"Missing {run_date}; no task mapping for "), job_txt))
        .otherwise(F.concat(F.lit(f"Missing {run_date}; producing job unmapped: "), job_txt,
                            F.when(stubbed, F.lit(STUBBED_SUFFIX)).otherwise(F.lit(""))))
    )

"""Incremental validation of newly landed partitions (Structured Streaming).

The original runs the split once a day on a schedule.  Here new files under
the landing root are picked up by a file stream and processed with
``trigger(availableNow=True)``: a scheduled run processes everything that
landed since the previous run and stops, and the stream's checkpoint (in the
shared checkpoint folder) remembers which files were done, so a failed run
resumes without reprocessing or losing files.

Each micro-batch is split into good / bad / undecided rows with the same
rules as the batch job, and each output is written under
``<out>/<kind>/batch=<id>/`` with overwrite: replaying a batch after a
failure rewrites the same folder, so the sink is idempotent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicewarden.functions.rules import Rule
from slicewarden.functions.suites import EXPORT_BAD_CONDITIONS
from slicewarden.operators.split import split_rows


def landing_stream(spark: SparkSession, landing_root: str, schema: T.StructType,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of rows from parquet files landing under ``landing_root``
    (hive folders ``date=YYYY-MM-DD/``; include ``date`` in ``schema``)."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "false")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(landing_root)


def _write_batch(out_root: str, rules: list[Rule], partition_col: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        # Four outputs read the batch: keep it for the duration.
        batch = batch.persist()
        try:
            _write_outputs(batch, batch_id)
        finally:
            batch.unpersist()

    def _write_outputs(batch: DataFrame, batch_id: int) -> None:
        parts = split_rows(batch, rules)
        base = out_root.rstrip("/")
        for kind, df in (("good", parts.good), ("bad", parts.bad), ("undecided", parts.undecided)):
            df.write.mode("overwrite").partitionBy(partition_col).parquet(f"{base}/{kind}/batch={batch_id}")
        counts = batch.groupBy(partition_col).agg(
            F.count(F.lit(1)).alias("rows_total"),
            F.count_if(~_bad(rules)).alias("rows_good"),
            F.count_if(_bad(rules)).alias("rows_bad"),
            F.count_if(_bad(rules).isNull()).alias("rows_undecided"),
        ).withColumn("batch_id", F.lit(batch_id).cast("long"))
        counts.write.mode("overwrite").parquet(f"{base}/runs/batch={batch_id}")

    return write


def _bad(rules):
    from slicewarden.functions.rules import any_violation

    return any_violation(rules)


def run_landing(spark: SparkSession, landing_root: str, schema: T.StructType, out_root: str,
                checkpoint: str, rules: list[Rule] | None = None, partition_col: str = "date",
                max_files_per_trigger: int | None = None) -> None:
    """Process everything landed since the last run, then stop."""
    stream = landing_stream(spark, landing_root, schema, max_files_per_trigger)
    q = (stream.writeStream.foreachBatch(_write_batch(out_root, rules or EXPORT_BAD_CONDITIONS, partition_col))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()

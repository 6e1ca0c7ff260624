"""Helpers shared by the operators: tables, shared-folder storage, batch size."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slicewarden.session import ensure_checkpoint_dir

# Rows per Arrow batch handed to Python.  Spark's default of 10,000 rows would
# put gigabytes of very long texts into one batch.
BATCH_ROWS = 500


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Lower the session's Arrow batch size to ``rows`` (never raise it): it
    bounds memory and changes no result."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to a new shared folder and read it back.

    Cuts the lineage like a reliable checkpoint, and gives later joins plain
    inputs of known size, whose skewed partitions Spark can split.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def utf8(text: Column) -> Column:
    """The text's bytes; null counts as empty."""
    return F.coalesce(text, F.lit("")).cast("binary")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only.  ``lower`` maps other letters too, so it serves
    texts without any; the rest goes through ``translate``."""
    plain = F.octet_length(text) == F.char_length(text)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))

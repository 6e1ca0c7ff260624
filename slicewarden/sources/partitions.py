"""Partitioned table scans (hive-style ``date=YYYY-MM-DD/`` folders)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the date taken from a file path.
PATH_DATE = r"date=([0-9-]+)"


def read_table(spark: SparkSession, root: str, schema=None, fmt: str = "parquet") -> DataFrame:
    """SRC-2/SRC-5: the whole table under ``root`` (partition columns are
    discovered from the folder names)."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(root)


def partition_slice(df: DataFrame, run_date: str, part_col: str = "date") -> DataFrame:
    """SRC-1: rows of one run date through the partition column.  The filter
    is a partition filter: only that folder's files are listed and read."""
    return df.where(F.col(part_col) == F.to_date(F.lit(run_date)))


def path_date(df: DataFrame) -> F.Column:
    """Run date parsed from the file path ('' when the path has none)."""
    return F.regexp_extract(F.col("_metadata.file_path"), PATH_DATE, 1)


def path_slice(df: DataFrame, run_date: str) -> DataFrame:
    """SRC-1, path form: rows whose file path carries ``date=<run_date>``.
    Prefer :func:`partition_slice`; this form is for tables read without
    partition discovery."""
    return df.where(path_date(df) == F.lit(run_date))


def day_slice(df: DataFrame, run_date: str, ts_col: str) -> DataFrame:
    """Rows whose timestamp falls on the run date (tables without folders)."""
    return df.where(F.to_date(F.col(ts_col)) == F.to_date(F.lit(run_date)))


def latest_partition(df: DataFrame, part_col: str) -> DataFrame:
    """SRC-4/AGG-8: the greatest partition value (NULL when empty) as a
    one-row frame; partition values are resolved from file metadata."""
    return df.agg(F.max(F.col(part_col)).alias(f"latest_{part_col}"))


def register_table(df: DataFrame, name: str) -> DataFrame:
    """SRC-5: (re)define a named view on written parts."""
    df.createOrReplaceTempView(name)
    return df


def has_partition(df: DataFrame, run_date: str, part_col: str = "date") -> bool:
    """LIM-1: does the table hold any row for the run date?  A partition
    filter plus ``limit(1)``: Spark stops after the first matching row."""
    return not partition_slice(df, run_date, part_col).limit(1).isEmpty()

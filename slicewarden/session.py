"""Session construction and shared-folder handling."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on.  AQE re-plans joins at runtime: a join side
# whose measured shuffle output is under the adaptive broadcast threshold is
# broadcast, a skewed partition of the streamed side is split.
BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    # Static plans only broadcast what the planner can size from statistics.
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    # Lets the optimizer put a partial per-group limit before the shuffle of
    # capped samples (row_number() <= cap) up to this cap.
    "spark.sql.optimizer.windowGroupLimitThreshold": "20000",
    # Fewer, larger scan tasks for multi-TB tables (each split still fits an
    # executor core's memory comfortably).
    "spark.sql.files.maxPartitionBytes": "256MB",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
    # Publishing writes its own _SUCCESS marker after the manifest.
    "spark.hadoop.mapreduce.fileoutputcommitter.marksuccessfuljobs": "false",
}


# SQL settings that can change on a live session (applied to sessions this
# package did not build, e.g. a driver's).
RUNTIME_SQL_CONF = {k: v for k, v in BASE_CONF.items()
                    if k.startswith("spark.sql.") and k != "spark.sql.sources.partitionOverwriteMode"}


def apply_runtime_conf(spark: SparkSession) -> None:
    """Set the runtime SQL settings the operators assume (UTC session time
    zone, AQE with skew-join handling, partial window-group limits)."""
    for k, v in RUNTIME_SQL_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)


def get_session(
    app: str = "slicewarden",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume.

    On a cluster leave ``master`` unset and size ``shuffle_partitions`` to the
    data (about 128-256 MB of shuffle data per partition); AQE then coalesces
    small ones.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def shuffle_partitions_for(shuffle_bytes: int, target_bytes: int = 256 << 20, minimum: int = 8) -> int:
    """Shuffle partitions so that each holds about ``target_bytes``; AQE then
    coalesces the small ones.  E.g. 40 TB of shuffle data → 163,840."""
    return max(minimum, -(-shuffle_bytes // target_bytes))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there and it is used as is.  Only when it
    is unset and Spark runs in local mode (tests, benches) is a scratch folder
    created; a cluster without the setting is an error, because a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="slicewarden-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder for intermediate tables, under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}-{os.getpid()}"


def materialize(df):
    """Write ``df`` once to the shared checkpoint folder and cut its lineage.

    An eager reliable checkpoint computes the plan in the job that writes
    the files; later plans read the files, and a lost executor re-reads them
    instead of recomputing the lineage.
    """
    return df.checkpoint(eager=True)


def stored(df, name: str):
    """Write ``df`` as Parquet to a new folder under the shared checkpoint folder
    and read it back: like :func:`materialize` without the rows' order, but
    columns nobody reads stay on disk and repeated values take little room."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

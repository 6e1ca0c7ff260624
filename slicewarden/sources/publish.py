"""Staged publish of a partition with a manifest and markers, and the reader
side that trusts only published partitions.

Publish order: write good rows under ``<final>/_staging/<run_id>/`` (hidden
from readers of the table), decide, delete the old parts, move the staged
parts in, write ``_MANIFEST.json``, write ``_SUCCESS`` last.  Object-store
renames are not atomic, so readers go through :func:`published_files`, which
requires ``_SUCCESS`` and lists files from the manifest.
"""

from __future__ import annotations

import datetime as _dt
import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicewarden.operators.gates import FAILED_MARKER, MANIFEST_MARKER, SUCCESS_MARKER
from slicewarden.sources import files

MANIFEST_VERSION = 1
PART_PREFIX = "part-"

MANIFEST_FILE_SCHEMA = T.StructType([
    T.StructField("uri", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("size", T.LongType()), T.StructField("updated", T.StringType()),
    T.StructField("md5", T.StringType()), T.StructField("etag", T.StringType()),
    T.StructField("crc32c", T.StringType()), T.StructField("content_type", T.StringType()),
])


@dataclass
class PublishOutcome:
    run_date: str
    should_publish: bool
    published: bool
    action: str
    staged_files: int
    staging: str
    final: str
    manifest: dict | None = None
    plan: list[dict] = field(default_factory=list)


def _now() -> str:
    return _dt.datetime.now(_dt.timezone.utc).isoformat()


def _join(prefix: str, name: str) -> str:
    return prefix.rstrip("/") + "/" + name


def manifest_entries(spark: SparkSession, final_prefix: str, checksums: bool = False) -> DataFrame:
    """FILE-2 file entries: uri, name, size, updated for the parts under the
    final prefix, from the listing alone; md5 (reads every file, each at most
    2 GB) when ``checksums``; etag, crc32c and content_type stay NULL."""
    inv = files.inventory(spark, final_prefix, glob="*.parquet", checksums=checksums)
    if not checksums:
        inv = inv.withColumn("md5", F.lit(None).cast("string"))
    return inv.select(
        F.col("path").alias("uri"), F.col("name"), F.col("size").cast("long").alias("size"),
        F.date_format(F.col("updated"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("updated"),
        F.col("md5"), F.lit(None).cast("string").alias("etag"), F.lit(None).cast("string").alias("crc32c"),
        F.lit(None).cast("string").alias("content_type"))


def build_manifest(spark: SparkSession, final_prefix: str, run_meta: dict, checksums: bool = False) -> dict:
    """Header plus one entry per published file (a partition's file list)."""
    entries = [r.asDict() for r in manifest_entries(spark, final_prefix, checksums).orderBy("name").collect()]
    return {"version": MANIFEST_VERSION, "partition": final_prefix, "run": run_meta, "files": entries,
            "file_count": len(entries), "generated_at": _now()}


def publish_partition(spark: SparkSession, good: DataFrame, *, final_prefix: str, run_date: str, run_id: str,
                      mode: str, success: bool, export_good_on_failure: bool, min_files: int = 1,
                      allow_republish: bool = False, dry_run: bool = False,
                      max_records_per_file: int | None = None, checksums: bool = False) -> PublishOutcome:
    """SNK-9/SNK-10/GATE-4/FILE-1: stage, decide, publish or mark failed.

    ``dry_run`` writes nothing and returns the file plan.  A run that may not
    publish, or finds the partition published, stages nothing.  ``_SUCCESS`` is written only when the manifest
    lists exactly the staged files with their sizes.
    """
    final = final_prefix.rstrip("/") + "/"
    staging = _join(final, f"_staging/{run_id}") + "/"
    if dry_run:
        plan = [{"op": "write", "to": staging}, {"op": "delete", "prefix": _join(final, PART_PREFIX)},
                {"op": "move", "from": staging, "to": final},
                {"op": "write", "to": _join(final, MANIFEST_MARKER)},
                {"op": "write", "to": _join(final, SUCCESS_MARKER)}]
        return PublishOutcome(run_date, False, False, "dry_run", 0, staging, final, None, plan)

    if (success or (export_good_on_failure and min_files <= 0)) and not allow_republish and files.exists(
            spark, _join(final, SUCCESS_MARKER)):
        return PublishOutcome(run_date, True, False, "skip_already_published", 0, staging, final)
    if success or export_good_on_failure:
        writer = good.write.mode("overwrite")
        if max_records_per_file:
            writer = writer.option("maxRecordsPerFile", max_records_per_file)
        writer.parquet(staging)
    staged = {p: size for p, size, _ in files.list_names(spark, staging) if p.endswith(".parquet")}
    should = bool(success or (export_good_on_failure and len(staged) >= min_files))
    if not should:
        meta = {"run_date": run_date, "run_id": run_id, "mode": mode, "at": _now(),
                "validation_success": bool(success), "partial_publish": False, "staged_file_count": len(staged)}
        files.write_text(spark, _join(staging, FAILED_MARKER), json.dumps(meta))
        return PublishOutcome(run_date, False, False, "mark_failed", len(staged), staging, final)
    if not allow_republish and files.exists(spark, _join(final, SUCCESS_MARKER)):
        return PublishOutcome(run_date, True, False, "skip_already_published", len(staged), staging, final)

    # Readers must not trust the partition while it changes.
    files.delete(spark, _join(final, SUCCESS_MARKER), recursive=False)
    files.delete_children(spark, final, PART_PREFIX)
    files.rename_all(spark, [(p, _join(final, p.rsplit("/", 1)[-1])) for p in staged])
    run_meta = {"run_date": run_date, "run_id": run_id, "mode": mode, "source_staging": staging,
                "published_at": _now(), "validation_success": bool(success), "partial_publish": not success,
                "staged_file_count": len(staged)}
    manifest = build_manifest(spark, final, run_meta, checksums)
    want = {p.rsplit("/", 1)[-1]: size for p, size in staged.items()}
    if {f["name"]: f["size"] for f in manifest["files"]} != want:
        raise OSError(f"{final} does not hold the files staged in {staging}; not published")
    files.write_text(spark, _join(final, MANIFEST_MARKER), json.dumps(manifest, separators=(",", ":")))
    files.write_text(spark, _join(final, SUCCESS_MARKER), "")
    return PublishOutcome(run_date, True, True, "publish", len(staged), staging, final, manifest)


def load_manifest(spark: SparkSession, partition: str) -> dict:
    """SRC-8: the partition's manifest; FileNotFoundError when absent."""
    path = _join(partition, MANIFEST_MARKER)
    if not files.exists(spark, path):
        raise FileNotFoundError(f"Missing manifest: {path}")
    return files.read_json(spark, path)


def manifest_frame(spark: SparkSession, manifest: dict) -> DataFrame:
    rows = [tuple(f.get(k.name) for k in MANIFEST_FILE_SCHEMA.fields) for f in manifest.get("files", [])]
    return spark.createDataFrame(rows, MANIFEST_FILE_SCHEMA)


def verify_manifest(spark: SparkSession, manifest: dict, partition: str, strict: bool = True) -> DataFrame:
    """FILE-3/JOIN-9: each listed file against the files actually present.

    status: ok, missing, size_mismatch, checksum_mismatch, modified (no checksum
    listed, and written again since: the modification time differs).  Strict mode
    raises on anything but ok; loose mode drops missing files and keeps the
    rest.  Sorted by name.
    """
    listed = manifest_frame(spark, manifest).alias("m")
    deep = any(f.get("md5") for f in manifest.get("files", []))
    actual = files.inventory(spark, partition, glob="*.parquet", checksums=deep)
    actual = (actual if deep else actual.withColumn("md5", F.lit(None).cast("string"))).alias("a")
    j = listed.join(actual, F.col("m.uri") == F.col("a.path"), "left")
    status = (F.when(F.col("a.path").isNull(), F.lit("missing"))
              .when(F.col("m.size").isNotNull() & (F.col("m.size") != F.col("a.size")), F.lit("size_mismatch"))
              .when(F.col("m.md5").isNotNull() & (F.col("m.md5") != F.col("a.md5")), F.lit("checksum_mismatch"))
              .when(F.col("m.md5").isNull() & (F.try_to_timestamp(F.col("m.updated")) != F.col("a.updated")), F.lit("modified"))
              .otherwise(F.lit("ok")))
    out = j.select(F.col("m.uri").alias("uri"), F.coalesce(F.col("m.name"), F.col("m.uri")).alias("name"),
                   F.col("a.size").alias("size"), F.col("a.md5").alias("md5"), status.alias("status"))
    if strict:
        bad = out.where(F.col("status") != "ok").orderBy("name").limit(1).collect()
        if bad:
            raise ValueError(f"manifest check failed: {bad[0]['uri']} is {bad[0]['status']}")
    else:
        out = out.where(F.col("status") != "missing")
    return out.orderBy("name")


def published_files(spark: SparkSession, partition: str, strict: bool = True) -> list[str]:
    """SRC-7: sorted file URIs of a published partition (``_SUCCESS`` required)."""
    if not files.exists(spark, _join(partition, SUCCESS_MARKER)):
        raise RuntimeError(f"Partition not published (no _SUCCESS): {partition}")
    manifest = load_manifest(spark, partition)
    checked = verify_manifest(spark, manifest, partition, strict=strict)
    return [r["uri"] for r in checked.select("uri", "name").orderBy("name").collect()]


def read_published(spark: SparkSession, partition: str, strict: bool = True) -> DataFrame:
    uris = published_files(spark, partition, strict=strict)
    return spark.read.parquet(*uris)

"""Published partitions in a versioned store, read through a manifest table.

A publish writes the good rows of a date to a folder of its own, lists the
files of that folder in a manifest table, and makes both visible in one commit:
no file is moved, and readers see the date's old or new files, whole.  The
manifest has a row for each file: its address, size, time, row count and, for
each column, smallest and largest value and number of nulls, taken from the
file's footer by the tasks that list it.  It is stored in shards of a bounded
number of files.

:func:`read` scans a published table by its manifest.  The driver knows the
shards, never the files: each task opens its shard, drops the files whose
values cannot meet the conditions given, checks the others against the listed
size, and reads the wanted columns.  :func:`read_folders` reads the same rows
through Spark's own Parquet reader, without the checks.
"""

from __future__ import annotations

import datetime as _dt
import json
from collections.abc import Iterator
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from slicewarden.sources import files, versions
from slicewarden.sources.publish import PublishOutcome

GOOD, MANIFEST, FAILED = "good", "manifest", "failed"
FILES_PER_SHARD = 256
FILES_PER_TASK = 8
OPERATORS = ("=", "<", "<=", ">", ">=", "in")
ENTRY = ("uri string, name string, size long, updated timestamp, rows long, "
         "stats map<string, struct<lo: string, hi: string, nulls: long>>")


def _slot(kind: str, run_date: str) -> str:
    return f"{kind}/date={run_date}"


def _plain(value) -> str | None:
    """A column statistic as text that :func:`_typed` reads back."""
    if value is None or isinstance(value, bytes):
        return None
    if isinstance(value, (_dt.date, _dt.datetime)):
        return value.isoformat()
    return str(value)


def _typed(text: str | None, kind: pa.DataType):
    if text is None:
        return None
    if pa.types.is_integer(kind):
        return int(text)
    if pa.types.is_floating(kind):
        return float(text)
    if pa.types.is_decimal(kind):
        return Decimal(text)
    if pa.types.is_date(kind):
        return _dt.date.fromisoformat(text[:10])
    if pa.types.is_timestamp(kind):
        at = _dt.datetime.fromisoformat(text)
        return at if at.tzinfo else at.replace(tzinfo=_dt.timezone.utc)
    if pa.types.is_string(kind):
        return text
    return None


def _open(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def footer_stats(uri: str) -> tuple[int, dict]:
    """Rows of a Parquet file and, for each plain column, (lo, hi, nulls) over
    its row groups; lo and hi are null where a row group does not say."""
    import pyarrow.parquet as pq

    store, path = _open(uri)
    meta = pq.read_metadata(path, filesystem=store)
    found: dict[str, dict] = {}
    for g in range(meta.num_row_groups):
        for c in range(meta.num_columns):
            column = meta.row_group(g).column(c)
            name, s = column.path_in_schema, column.statistics
            if "." in name:
                continue
            whole = s is not None and s.has_null_count
            old = found.setdefault(name, {"lo": None, "hi": None, "nulls": 0, "known": True})
            old["nulls"] = None if not whole or old["nulls"] is None else old["nulls"] + s.null_count
            if whole and s.null_count == column.num_values:
                continue                                          # nulls alone: nothing to compare
            if s is None or s.physical_type == "INT96" or not s.has_min_max:
                old["known"] = False
            elif old["known"]:
                old["lo"] = s.min if old["lo"] is None else min(old["lo"], s.min)
                old["hi"] = s.max if old["hi"] is None else max(old["hi"], s.max)
    return meta.num_rows, {n: {"lo": _plain(v["lo"]) if v["known"] else None,
                               "hi": _plain(v["hi"]) if v["known"] else None, "nulls": v["nulls"]}
                           for n, v in found.items()}


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """A row (``ENTRY``) for each Parquet file under ``folder``."""
    listed = files.inventory(spark, folder, glob="*.parquet").select("path", "name", "size", "updated")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, stats = [], []
            for uri in batch.column("path").to_pylist():
                n, found = footer_stats(uri)
                rows.append(n)
                stats.append(list(found.items()))
            kind = pa.map_(pa.string(), pa.struct([("lo", pa.string()), ("hi", pa.string()), ("nulls", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(rows, pa.int64()), pa.array(stats, kind)],
                ["uri", "name", "size", "updated", "rows", "stats"])

    return listed.mapInArrow(run, ENTRY)


def publish(spark: SparkSession, good: DataFrame, *, root: str, run_date: str, run_id: str, success: bool,
            export_good_on_failure: bool = True, min_files: int = 1, allow_republish: bool = False,
            dry_run: bool = False, rows_per_file: int | None = None,
            files_per_shard: int = FILES_PER_SHARD) -> PublishOutcome:
    """SNK-9/SNK-10/GATE-4/FILE-1/FILE-2 in one commit of the store at ``root``.

    A date that is published already is left alone before anything is written,
    unless ``allow_republish``; a run that may not publish leaves a ``failed``
    entry and no data; a dry run leaves nothing.
    """
    change = versions.Store(spark, root).change()
    slot = _slot(GOOD, run_date)
    there = bool(change.base.names(slot))

    def outcome(should: bool, action: str, n: int = 0, at: str = "") -> PublishOutcome:
        return PublishOutcome(run_date, should, action == "publish", action, n, at, f"{change.store.root}/{slot}")

    if dry_run:
        plan = outcome(False, "dry_run")
        plan.plan = [{"op": "write", "to": slot}, {"op": "write", "to": _slot(MANIFEST, run_date)}, {"op": "commit"}]
        return plan
    may = success or export_good_on_failure
    if may and there and not allow_republish:
        return outcome(True, "skip_already_published")
    n = 0
    if may:
        folder = change.save(slot, lambda p: good.write.options(
            **({"maxRecordsPerFile": rows_per_file} if rows_per_file else {})).parquet(p))
        entries = manifest(spark, folder)
        n = entries.select("uri").count()
    if not may or (not success and n < min_files):
        failed = versions.Store(spark, root).change()
        row = spark.createDataFrame([(run_date, run_id, bool(success), n)],
                                    "run_date string, run_id string, validation_success boolean, staged_file_count long")
        failed.save(f"{_slot(FAILED, run_date)}/run_id={run_id}", row.write.json)
        failed.commit()
        return outcome(False, "mark_failed", n)
    shards = max(1, -(-n // files_per_shard))
    meta = {"run_id": F.lit(run_id), "validation_success": F.lit(bool(success)), "partial_publish": F.lit(not success)}
    change.write(_slot(MANIFEST, run_date), entries.withColumns(meta).repartition(shards))
    change.commit()
    return outcome(True, "publish", n, folder)


def published_dates(spark: SparkSession, root: str) -> list[str]:
    return [s.rsplit("=", 1)[-1] for s in versions.Store(spark, root).latest().names(GOOD)]


def manifest_table(spark: SparkSession, root: str) -> DataFrame:
    """SRC-8: the manifest rows of all published dates, with the date."""
    store = versions.Store(spark, root)
    at = store.latest()
    rows = spark.createDataFrame([], f"date string, {ENTRY}")
    schema = T.StructType(spark.createDataFrame([], ENTRY).schema.fields)
    for slot in at.names(MANIFEST):
        part = store.read(slot, schema, at)
        rows = rows.unionByName(part.withColumn("date", F.lit(slot.rsplit("=", 1)[-1])))
    return rows


def read_folders(spark: SparkSession, root: str, schema: T.StructType, dates: list[str] | None = None) -> DataFrame:
    """Published rows through Spark's Parquet reader (columns and filters are
    pushed down); files are trusted as committed."""
    dates = published_dates(spark, root) if dates is None else dates
    return versions.Store(spark, root).read(GOOD, schema, slots=[_slot(GOOD, d) for d in dates])


def check(spark: SparkSession, root: str) -> DataFrame:
    """FILE-3/JOIN-9: the status of every listed file of all dates: ok, missing,
    size_mismatch, modified (written again at the same size)."""
    listed = manifest_table(spark, root).alias("m")
    folders = versions.Store(spark, root).folders(GOOD)
    there = None
    for f in folders:                                             # a folder a date
        inv = files.inventory(spark, f, glob="*.parquet").select("path", "size", "updated")
        there = inv if there is None else there.unionByName(inv)
    there = (there if there is not None else spark.createDataFrame(
        [], "path string, size long, updated timestamp")).alias("a")
    status = (F.when(F.col("a.path").isNull(), "missing").when(F.col("m.size") != F.col("a.size"), "size_mismatch")
              .when(F.col("m.updated") != F.col("a.updated"), "modified").otherwise("ok"))
    return listed.join(there, F.col("m.uri") == F.col("a.path"), "left").select(
        "m.date", "m.uri", "m.name", "m.size", "m.rows", status.alias("status"))


# -- the scan --------------------------------------------------------------------

def may_hold(stats: dict, conditions: list[list], kinds: dict[str, pa.DataType]) -> bool:
    """Whether a file with these column statistics can hold a row that meets all
    conditions (column, operator, value); unknown statistics can."""
    for column, op, value in conditions:
        s = stats.get(column)
        lo, hi = (None, None) if s is None else (_typed(s[k], kinds[column]) for k in ("lo", "hi"))
        if lo is None or hi is None:
            continue
        values = [_typed(_plain(v), kinds[column]) for v in (value if op == "in" else [value])]
        if None in values or any(v != v for v in (lo, hi, *values)):                     # NaN compares with nothing
            continue
        if op in ("=", "in"):
            fits = any(lo <= v <= hi for v in values)
        else:
            fits = {"<": lo < values[0], "<=": lo <= values[0], ">": hi > values[0], ">=": hi >= values[0]}[op]
        if not fits:
            return False
    return True


class Shard(InputPartition):
    def __init__(self, uri: str, part: int, of: int):
        self.uri, self.part, self.of = uri, part, of


class PublishedReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        from pyspark.sql.pandas.types import to_arrow_schema

        self.arrow = to_arrow_schema(schema)
        self.shards, self.per_task = json.loads(options["shards"]), int(options["files_per_task"])
        self.per_shard, self.conditions = int(options["files_per_shard"]), json.loads(options["conditions"])
        self.strict = options["strict"] == "true"

    def partitions(self) -> list[Shard]:
        of = max(1, -(-self.per_shard // self.per_task))
        return [Shard(uri, k, of) for uri in self.shards for k in range(of)]

    def read(self, shard: Shard | None) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        if shard is None:                # nothing is published
            return
        store, path = _open(shard.uri)
        entries = sorted(pq.read_table(path, filesystem=store, columns=["uri", "size", "stats"]).to_pylist(),
                         key=lambda e: e["uri"])
        kinds = {f.name: f.type for f in self.arrow}
        for e in entries[shard.part::shard.of]:
            if not may_hold(dict(e["stats"]), self.conditions, kinds):
                continue
            store, path = _open(e["uri"])
            info = store.get_file_info(path)
            if not info.is_file and not self.strict:
                continue
            if not info.is_file or (self.strict and info.size != e["size"]):
                raise ValueError(f"manifest check failed: {e['uri']} is "
                                 + ("size_mismatch" if info.is_file else "missing"))
            with store.open_input_file(path) as source:
                data = pq.ParquetFile(source)
                have = set(data.schema_arrow.names)
                for batch in data.iter_batches(columns=[f.name for f in self.arrow if f.name in have]):
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(f.name).cast(f.type) if f.name in have else pa.nulls(batch.num_rows, f.type)
                         for f in self.arrow], schema=self.arrow)


class PublishedSource(DataSource):
    """Scan of manifest shards; use :func:`read`, which finds them."""

    @classmethod
    def name(cls) -> str:
        return "published"

    def reader(self, schema: T.StructType) -> PublishedReader:
        return PublishedReader(schema, self.options)


def _condition(column: str, op: str, value) -> Column:
    c = F.col(f"`{column}`")
    return {"=": lambda: c == value, "<": lambda: c < value, "<=": lambda: c <= value, ">": lambda: c > value,
            ">=": lambda: c >= value, "in": lambda: c.isin(list(value))}[op]()


def read(spark: SparkSession, root: str, schema: T.StructType, where: list[tuple] | None = None,
         dates: list[str] | None = None, strict: bool = True, files_per_task: int = FILES_PER_TASK,
         files_per_shard: int = FILES_PER_SHARD) -> DataFrame:
    """SRC-7: the columns of ``schema`` of the published rows that meet all
    conditions ``where`` (column, operator, value; operators in ``OPERATORS``),
    scanned by the manifest.

    Files that cannot meet them are not opened.  A listed file that is missing
    or has another size ends a strict read and is left out (or read as it is)
    otherwise.  Stores: those pyarrow opens (local, HDFS, S3, GCS).
    """
    where = where or []
    names = {f.name for f in schema.fields}
    for column, op, _ in where:
        if op not in OPERATORS or column not in names:
            raise ValueError(f"no condition {op!r} on {column!r} can be given")
    store = versions.Store(spark, root)
    at = store.latest()
    wanted = at.names(MANIFEST) if dates is None else [_slot(MANIFEST, d) for d in dates if _slot(MANIFEST, d) in at.slots]
    shards = [p for s in wanted for f in at.slots[s] for p, _, _ in files.list_names(spark, f"{store.root}/{f.path}")
              if p.endswith(".parquet")]
    conditions = [[c, op, [_plain(v) for v in value] if op == "in" else _plain(value)] for c, op, value in where]
    spark.dataSource.register(PublishedSource)
    rows = (spark.read.format("published").schema(schema)
            .options(shards=json.dumps(shards), conditions=json.dumps(conditions), strict=str(strict).lower(),
                     files_per_task=files_per_task, files_per_shard=files_per_shard).load())
    for condition in where:
        rows = rows.where(_condition(*condition))
    return rows

"""Queries: derived columns, export split, suites, summaries, slices."""

from __future__ import annotations

from pyspark.sql import functions as F

from slicewarden.functions import suites
from slicewarden.functions.derive import with_cross_checks
from slicewarden.operators import split as split_ops
from slicewarden.operators import validate
from slicewarden.plans import sqltext as S
from slicewarden.plans.registry import register
from slicewarden.plans.standins import orders_like, table
from slicewarden.sources import files
from slicewarden.sources.partitions import day_slice

ORDER_COLS = [c.strip() for c in S.ORDER_COLUMNS.split(",")]
RUN_DATE = "2024-01-15"
RUN_TS = "2024-01-16T05:00:00+00:00"


def _orders(spark, sf_dir):
    return orders_like(table(spark, sf_dir, "lineitem"))


def _cross(spark, sf_dir):
    return with_cross_checks(_orders(spark, sf_dir).select(*ORDER_COLS))


CROSS_COLS = ORDER_COLS + ["amt_diff", "ts_date_mismatch_flag", "discount_excess", "discount_excess_flag"]


@register("prj_cross_checks", f"""
WITH {S.ORDERS_LIKE.strip()}, {S.CROSS_CHECKS.strip()}
SELECT {S.ORDER_COLUMNS}, amt_diff, ts_date_mismatch_flag, discount_excess, discount_excess_flag
FROM cross_checks""")
def prj_cross_checks(spark, sf_dir):
    """PRJ-1..5: every column plus the four derived cross-check columns."""
    return _cross(spark, sf_dir).select(*CROSS_COLS)


def _split(spark, sf_dir):
    return split_ops.split_rows(_orders(spark, sf_dir).select(*ORDER_COLS), suites.EXPORT_BAD_CONDITIONS)


@register("flt_export_bad", f"""
WITH {S.ORDERS_LIKE.strip()}
SELECT {S.ORDER_COLUMNS} FROM orders_like WHERE {S.BAD_PREDICATE}""")
def flt_export_bad(spark, sf_dir):
    """FLT-1/FLT-3: rows where the 18-condition bad predicate is TRUE."""
    return _split(spark, sf_dir).bad


@register("flt_export_good", f"""
WITH {S.ORDERS_LIKE.strip()}
SELECT {S.ORDER_COLUMNS} FROM orders_like WHERE NOT {S.BAD_PREDICATE}""")
def flt_export_good(spark, sf_dir):
    """FLT-2: rows where the bad predicate is FALSE."""
    return _split(spark, sf_dir).good


@register("flt_undecided", f"""
WITH {S.ORDERS_LIKE.strip()}
SELECT {S.ORDER_COLUMNS} FROM orders_like WHERE {S.BAD_PREDICATE} IS NULL""")
def flt_undecided(spark, sf_dir):
    """FLT-4: rows in neither output (bad predicate NULL)."""
    return _split(spark, sf_dir).undecided


@register("agg_split_counts", f"""
WITH {S.ORDERS_LIKE.strip()}
SELECT COUNT(*) AS rows_total,
       COUNT(*) FILTER (WHERE NOT {S.BAD_PREDICATE}) AS rows_good,
       COUNT(*) FILTER (WHERE {S.BAD_PREDICATE}) AS rows_bad,
       COUNT(*) FILTER (WHERE {S.BAD_PREDICATE} IS NULL) AS rows_undecided
FROM orders_like""")
def agg_split_counts(spark, sf_dir):
    """AGG-1/AGG-2: total, good, bad and undecided counts in one pass."""
    return _split(spark, sf_dir).counts


@register("val_basic_suite", f"""
WITH {S.ORDERS_LIKE.strip()}, {S.CROSS_CHECKS.strip()}
{S.suite_sql(suites.BASIC_SUITE, 'cross_checks')}""")
def val_basic_suite(spark, sf_dir):
    """VAL-2..8: the 20-rule basic suite, one aggregation plus the key pass."""
    return validate.run_suite(_cross(spark, sf_dir), suites.BASIC_SUITE)


@register("val_incremental_suite", f"""
WITH {S.ORDERS_LIKE.strip()}, {S.CROSS_CHECKS.strip()}
{S.suite_sql(suites.BASIC_SUITE, 'cross_checks')}""")
def val_incremental_suite(spark, sf_dir):
    """VAL-3/VAL-8 with table scope: the table arrives year by year, one year
    first without its keys and then corrected; results from the state."""
    import uuid

    from slicewarden.operators import suite_state
    from slicewarden.session import scratch_path

    root = scratch_path(spark, f"state-{uuid.uuid4().hex}")
    rows = _cross(spark, sf_dir).withColumn("year", F.coalesce(F.year("order_date").cast("string"), F.lit("none")))
    rows.write.partitionBy("year").parquet(f"{root}/rows")
    years = sorted(f.rsplit("=", 1)[-1] for f in files.list_folders(spark, f"{root}/rows"))
    stored = spark.read.schema(rows.schema).parquet(f"{root}/rows")
    wrong = stored.where(F.col("year") == years[0]).withColumn("order_id", F.lit(None).cast("long"))
    suite_state.fold_day(spark, f"{root}/state", wrong, years[0], suites.BASIC_SUITE)
    for y in reversed(years):
        suite_state.fold_day(spark, f"{root}/state", stored.where(F.col("year") == y), y, suites.BASIC_SUITE)
    return suite_state.results(spark, f"{root}/state", suites.BASIC_SUITE)


@register("val_cross_suite", f"""
WITH {S.ORDERS_LIKE.strip()}, {S.CROSS_CHECKS.strip()}
{S.suite_sql(suites.CROSS_SUITE, 'cross_checks')}""")
def val_cross_suite(spark, sf_dir):
    """VAL-4/5/7/8: the 5-rule cross suite on the derived columns."""
    return validate.run_suite(_cross(spark, sf_dir), suites.CROSS_SUITE)


def _details_sql(suite, keep: str) -> str:
    cols = ("CASE WHEN \"column\" IS NULL THEN 'null' ELSE '[\"' || \"column\" || '\"]' END")
    item = "'{\"expectation_type\":\"' || expectation_type || '\",\"columns\":' || " + cols + " || '}'"
    return (f"'{{\"failed_expectations\":[' || COALESCE(STRING_AGG({item}, ',' ORDER BY rule_index) "
            f"FILTER (WHERE {keep}), '') || ']}}'")


@register("val_run_summary", f"""
WITH {S.ORDERS_LIKE.strip()}, {S.CROSS_CHECKS.strip()},
results AS ({S.suite_sql(suites.BASIC_SUITE, 'cross_checks')})
SELECT '{RUN_DATE}' AS run_date, '{RUN_TS}' AS run_ts, BOOL_AND(success) AS success,
       COUNT(*) AS expectations_total, COUNT(*) FILTER (WHERE success) AS expectations_passed,
       COUNT(*) FILTER (WHERE NOT success) AS expectations_failed,
       MAX(element_count) AS slice_row_count, 'orders_suite' AS suite_name,
       'lineitem_source' AS datasource, 'orders_like' AS data_asset,
       {_details_sql(suites.BASIC_SUITE, 'NOT success')} AS details
FROM results""")
def val_run_summary(spark, sf_dir):
    """VAL-9/AGG-6/VAL-10: one summary row with totals and failed details."""
    res = validate.run_suite(_cross(spark, sf_dir), suites.BASIC_SUITE)
    return validate.run_summary(res, run_date=RUN_DATE, run_ts=RUN_TS, suite_name="orders_suite",
                                datasource="lineitem_source", data_asset="orders_like")


@register("agg_counts_by_type", f"""
WITH {S.ORDERS_LIKE.strip()}, {S.CROSS_CHECKS.strip()},
results AS ({S.suite_sql(suites.BASIC_SUITE, 'cross_checks')})
SELECT expectation_type, COUNT(*) FILTER (WHERE success) AS passed,
       COUNT(*) FILTER (WHERE NOT success) AS failed
FROM results GROUP BY expectation_type""")
def agg_counts_by_type(spark, sf_dir):
    """AGG-7: passed / failed expectations per expectation type."""
    return validate.counts_by_type(validate.run_suite(_cross(spark, sf_dir), suites.BASIC_SUITE))


@register("val_duplicate_ids", f"""
WITH {S.ORDERS_LIKE.strip()}
SELECT order_id, COUNT(*) AS copies FROM orders_like WHERE order_id IS NOT NULL
GROUP BY order_id HAVING COUNT(*) > 1""")
def val_duplicate_ids(spark, sf_dir):
    """VAL-3 detail: repeated order ids and their number of copies."""
    return validate.duplicate_values(_orders(spark, sf_dir), "order_id")


@register("val_detail_lists", f"""
WITH {S.ORDERS_LIKE.strip()}, {S.CROSS_CHECKS.strip()},
results AS ({S.suite_sql(suites.BASIC_SUITE, 'cross_checks')})
SELECT
  '[' || COALESCE(STRING_AGG('{{"expectation_type":"' || expectation_type || '","columns":' ||
      CASE WHEN "column" IS NULL THEN 'null' ELSE '["' || "column" || '"]' END || '}}', ',' ORDER BY rule_index)
      FILTER (WHERE NOT success), '') || ']' AS failed,
  '[' || COALESCE(STRING_AGG('{{"expectation_type":"' || expectation_type || '","columns":' ||
      CASE WHEN "column" IS NULL THEN 'null' ELSE '["' || "column" || '"]' END || '}}', ',' ORDER BY rule_index)
      FILTER (WHERE success), '') || ']' AS passed
FROM results""")
def val_detail_lists(spark, sf_dir):
    """VAL-10/LIM-3: failed and passed expectation lists."""
    d = validate.detail_lists(validate.run_suite(_cross(spark, sf_dir), suites.BASIC_SUITE))
    opts = {"ignoreNullFields": "false"}
    return d.select(F.to_json("failed", opts).alias("failed"), F.to_json("passed", opts).alias("passed"))


@register("src_slice_rows", f"""
SELECT event_id, ts, user_id, event_type, value FROM events
WHERE CAST(ts AS DATE) = DATE '{RUN_DATE}'""")
def src_slice_rows(spark, sf_dir):
    """SRC-1: all rows of one run date."""
    ev = table(spark, sf_dir, "events")
    return day_slice(ev, RUN_DATE, ts_col="ts").select("event_id", "ts", "user_id", "event_type", "value")


@register("agg_slice_counts", """
SELECT CAST(ts AS DATE) AS run_date, COUNT(*) AS slice_row_count FROM events GROUP BY 1""")
def agg_slice_counts(spark, sf_dir):
    """AGG-1 for every day at once: row count per daily slice."""
    ev = table(spark, sf_dir, "events")
    return ev.groupBy(F.to_date("ts").alias("run_date")).agg(F.count(F.lit(1)).alias("slice_row_count"))


@register("pub_published_good_rows", f"""
WITH {S.ORDERS_LIKE.strip()}
SELECT {S.ORDER_COLUMNS} FROM orders_like WHERE NOT {S.BAD_PREDICATE}""")
def pub_published_good_rows(spark, sf_dir):
    """SNK-9/FILE-2/FILE-3/SRC-7/SRC-8: good rows staged, published with a
    manifest and ``_SUCCESS``, then read back through the manifest check."""
    import uuid

    from slicewarden.session import scratch_path
    from slicewarden.sources import publish

    final = scratch_path(spark, f"ready-{uuid.uuid4().hex}") + f"/date={RUN_DATE}"
    good = _split(spark, sf_dir).good
    out = publish.publish_partition(spark, good, final_prefix=final, run_date=RUN_DATE, run_id="bench",
                                    mode="basic", success=True, export_good_on_failure=True,
                                    max_records_per_file=20_000)
    if not out.published:
        raise RuntimeError(f"publish did not happen: {out.action}")
    return publish.read_published(spark, final, strict=True).select(*ORDER_COLS)


def _published_versions(spark, sf_dir):
    """All good rows published to a store of versions, files by amount."""
    import uuid

    from slicewarden.session import scratch_path
    from slicewarden.sources import published

    root = scratch_path(spark, f"versions-{uuid.uuid4().hex}")
    good = _split(spark, sf_dir).good.repartitionByRange(8, "order_amount")
    out = published.publish(spark, good, root=root, run_date=RUN_DATE, run_id="query", success=True, files_per_shard=3)
    if not out.published:
        raise RuntimeError(f"publish did not happen: {out.action}")
    return root, good.schema


SCAN_FROM = 60_000.0


@register("pub_manifest_scan", f"""
WITH {S.ORDERS_LIKE.strip()}
SELECT {S.ORDER_COLUMNS} FROM orders_like WHERE NOT {S.BAD_PREDICATE} AND order_amount >= {SCAN_FROM}""")
def pub_manifest_scan(spark, sf_dir):
    """SRC-7/SRC-8/FILE-1/FILE-2: good rows published in one commit and scanned
    by the sharded manifest; files whose largest amount is too small stay shut."""
    from slicewarden.sources import published

    root, schema = _published_versions(spark, sf_dir)
    return published.read(spark, root, schema, [("order_amount", ">=", SCAN_FROM)], files_per_task=1).select(*ORDER_COLS)


@register("pub_manifest_status", f"""
WITH {S.ORDERS_LIKE.strip()}
SELECT COUNT(*) AS listed_rows, CAST(1 AS BIGINT) AS missing, CAST(1 AS BIGINT) AS size_mismatch,
       CAST(1 AS BIGINT) AS modified FROM orders_like WHERE NOT {S.BAD_PREDICATE}""")
def pub_manifest_status(spark, sf_dir):
    """FILE-3/JOIN-9 with files gone and changed after the publish: one deleted,
    one cut to another size, one written again at the same size."""
    from slicewarden.sources import published

    root, _ = _published_versions(spark, sf_dir)
    gone, cut, again = [r["uri"] for r in published.manifest_table(spark, root).orderBy("uri").limit(3).collect()]
    files.delete(spark, gone)
    files.write_text(spark, cut, "cut")
    files.touch(spark, again, 1_000_000_000_000)
    found = published.check(spark, root)
    return found.agg(F.sum("rows").alias("listed_rows"), *[
        F.count_if(F.col("status") == s).alias(s) for s in ("missing", "size_mismatch", "modified")])


JOB_DATE = "1996-01-01"


@register("job_validate_day_summary", f"""
WITH {S.ORDERS_LIKE.strip()}, {S.CROSS_CHECKS.strip()},
day AS (SELECT * FROM cross_checks WHERE date_trunc('year', order_date) = DATE '{JOB_DATE}'),
results AS ({S.suite_sql(suites.BASIC_SUITE, 'day')})
SELECT '{JOB_DATE}' AS run_date, BOOL_AND(success) AS success,
       COUNT(*) AS expectations_total, COUNT(*) FILTER (WHERE success) AS expectations_passed,
       COUNT(*) FILTER (WHERE NOT success) AS expectations_failed,
       MAX(element_count) AS slice_row_count, 'orders_suite' AS suite_name,
       'orders_source' AS datasource, 'orders_with_derived' AS data_asset,
       {_details_sql(suites.BASIC_SUITE, 'NOT success')} AS details
FROM results""")
def job_validate_day_summary(spark, sf_dir):
    """VAL-9/SNK-6/SNK-5/GATE-4 through the daily job: orders written as a
    ``date``-partitioned table (one partition per ship year), the 1996 slice
    validated, bad rows exported, good rows published, and the appended run
    summary read back."""
    import uuid

    from slicewarden.plans import jobs
    from slicewarden.session import scratch_path

    base = scratch_path(spark, f"validate-{uuid.uuid4().hex}")
    orders = _orders(spark, sf_dir).select(*ORDER_COLS).withColumn("date", F.trunc("order_date", "year"))
    orders.write.mode("overwrite").partitionBy("date").parquet(f"{base}/orders")
    for _ in range(2):               # the rerun's row takes the place of the first one's
        jobs.validate_day(spark, f"{base}/orders", JOB_DATE, "basic", ready_root=f"{base}/ready",
                          error_root=f"{base}/error", results_path=f"{base}/results", run_id="job")
    return jobs.run_summaries(spark, f"{base}/results").drop("run_ts")


@register("job_error_rows", f"""
WITH {S.ORDERS_LIKE.strip()}, {S.CROSS_CHECKS.strip()},
day AS (SELECT *, {S.BAD_PREDICATE} AS bad FROM orders_like WHERE date_trunc('year', order_date) = DATE '{JOB_DATE}')
SELECT {S.ORDER_COLUMNS}, CASE WHEN bad THEN 'bad' ELSE 'undecided' END AS kind
FROM day WHERE bad OR bad IS NULL""")
def job_error_rows(spark, sf_dir):
    """SNK-5 through the daily job: the bad and undecided rows it exported,
    read back from the error folders."""
    import uuid

    from slicewarden.plans import jobs
    from slicewarden.session import scratch_path

    base = scratch_path(spark, f"errors-{uuid.uuid4().hex}")
    orders = _orders(spark, sf_dir).select(*ORDER_COLS).withColumn("date", F.trunc("order_date", "year"))
    orders.write.mode("overwrite").partitionBy("date").parquet(f"{base}/orders")
    jobs.validate_day(spark, f"{base}/orders", JOB_DATE, "basic", ready_root=f"{base}/ready", layout="versions",
                      error_root=f"{base}/error", results_path=f"{base}/results", run_id="job")
    kinds = {"bad": f"{base}/error/date={JOB_DATE}", "undecided": f"{base}/error_undecided/date={JOB_DATE}"}
    schema = orders.drop("date").schema
    parts = [spark.read.schema(schema).parquet(path).withColumn("kind", F.lit(kind))
             for kind, path in kinds.items() if files.exists(spark, path)]
    return parts[0].unionByName(parts[1]) if len(parts) == 2 else parts[0]


_PROBED = [f"{y}-01-01" for y in range(1990, 2001)]


@register("src_partition_probes", "\nUNION ALL\n".join(f"""
SELECT '{d}' AS partition_date, COUNT(*) AS held_rows, COUNT(*) > 0 AS there
FROM lineitem WHERE date_trunc('year', l_shipdate) = DATE '{d}'""" for d in _PROBED))
def src_partition_probes(spark, sf_dir):
    """SRC-5/LIM-1: a stored table registered under a name, and for each year
    whether it holds that partition (first row found) and how many rows."""
    import uuid

    from slicewarden.session import scratch_path
    from slicewarden.sources.partitions import has_partition, read_table, register_table

    name = f"lines_{uuid.uuid4().hex}"
    root = scratch_path(spark, name)
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", F.trunc("l_shipdate", "year").alias("date"))
    rows.write.partitionBy("date").parquet(root)
    register_table(read_table(spark, root), name)
    held = spark.table(name)
    counts = held.groupBy(F.col("date").cast("string").alias("held")).agg(F.count(F.lit(1)).alias("n"))
    probes = spark.createDataFrame([(d, has_partition(held, d)) for d in _PROBED], "partition_date string, there boolean")
    found = probes.join(counts, F.col("partition_date") == F.col("held"), "left")
    return found.select("partition_date", F.coalesce("n", F.lit(0)).alias("held_rows"), "there")

"""Queries: customer snapshots and the type-2 history dimension (events)."""

from __future__ import annotations

from pyspark.sql import functions as F

from slicewarden.operators import scd2
from slicewarden.plans.registry import register
from slicewarden.plans.standins import customer_days, table
from slicewarden.session import materialize

SNAP_DAY = "2024-01-15"
FOLD_DAYS = [f"2024-01-{d:02d}" for d in range(1, 31)]        # the days of the events table


def _hash_sql(col: str) -> str:
    return (f"sha256('{{\"region\":' || CASE WHEN {col} IS NULL THEN 'null' "
            f"ELSE '\"' || {col} || '\"' END || '}}')")


SNAP_SQL = f"""
snap AS (
  SELECT CAST(user_id AS VARCHAR) AS customer_id, CAST(ts AS DATE) AS day, MIN(event_type) AS region
  FROM events WHERE user_id IS NOT NULL GROUP BY user_id, CAST(ts AS DATE)
),
h AS (SELECT customer_id, day, region, {_hash_sql('region')} AS hash_diff FROM snap)"""

DIM_COLS = "customer_id, name, email, region, eff_from, eff_to, is_current, hash_diff"


def _fold_sql(days: list[str]) -> str:
    ctes = [SNAP_SQL.strip(),
            "dim0 AS (SELECT CAST(NULL AS VARCHAR) AS customer_id, CAST(NULL AS VARCHAR) AS name, "
            "CAST(NULL AS VARCHAR) AS email, CAST(NULL AS VARCHAR) AS region, CAST(NULL AS DATE) AS eff_from, "
            "CAST(NULL AS DATE) AS eff_to, CAST(NULL AS BOOLEAN) AS is_current, CAST(NULL AS VARCHAR) AS hash_diff "
            "WHERE FALSE)"]
    for i, d in enumerate(days, 1):
        prev = f"dim{i - 1}"
        ctes.append(f"s{i} AS (SELECT customer_id, region, hash_diff FROM h WHERE day = DATE '{d}')")
        changed = (f"t.is_current AND EXISTS (SELECT 1 FROM s{i} s WHERE s.customer_id = t.customer_id "
                   f"AND s.hash_diff != t.hash_diff)")
        ctes.append(f"""dim{i} AS (
  SELECT t.customer_id, t.name, t.email, t.region, t.eff_from,
         CASE WHEN {changed} THEN DATE '{d}' - 1 ELSE t.eff_to END AS eff_to,
         CASE WHEN {changed} THEN FALSE ELSE t.is_current END AS is_current, t.hash_diff
  FROM {prev} t
  UNION ALL
  SELECT s.customer_id, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), s.region, DATE '{d}', DATE '9999-12-31',
         TRUE, s.hash_diff
  FROM s{i} s LEFT JOIN {prev} t ON t.customer_id = s.customer_id AND t.is_current
  WHERE t.customer_id IS NULL OR t.hash_diff != s.hash_diff)""")
    return "WITH " + ",\n".join(ctes) + f"\nSELECT {DIM_COLS} FROM dim{len(days)}"


def _snapshots(spark, sf_dir):
    days = customer_days(table(spark, sf_dir, "events"))
    return scd2.snapshots_by_day(days, "customer_id", "region", "day")


def _day(snaps, d):
    return snaps.where(F.col("day") == F.to_date(F.lit(d))).select(
        "customer_id", F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("email"),
        "region", "hash_diff")


@register("scd2_snapshot_day", f"""
SELECT CAST(user_id AS VARCHAR) AS customer_id, CAST(NULL AS VARCHAR) AS name, CAST(NULL AS VARCHAR) AS email,
       MIN(event_type) AS region, {_hash_sql('MIN(event_type)')} AS hash_diff
FROM events WHERE CAST(ts AS DATE) = DATE '{SNAP_DAY}' AND user_id IS NOT NULL GROUP BY user_id""")
def scd2_snapshot_day(spark, sf_dir):
    """SCD2-1/AGG-3/PRJ-7/PRJ-8: one row per key for the day with its hash."""
    days = customer_days(table(spark, sf_dir, "events"))
    return scd2.daily_snapshot(days.where(F.col("day") == F.to_date(F.lit(SNAP_DAY))))


def _days(snaps):
    return [r["day"].isoformat() for r in snaps.select("day").distinct().orderBy("day").collect()]


@register("scd2_merge_3days", _fold_sql(FOLD_DAYS))
def scd2_merge_3days(spark, sf_dir):
    """SCD2-4 (with SCD2-2, SCD2-3, SET-2): every day found, one merge per
    day; the first three in one plan, the rest from there."""
    snaps = _snapshots(spark, sf_dir)
    days = _days(snaps)
    dim = scd2.empty_dimension(spark)
    for i, d in enumerate(days):
        dim = scd2.merge_day(dim, _day(snaps, d), d)
        if i % 3 == 2 and d != days[-1]:
            dim = materialize(dim)
    return dim


# The dimension as of the day before the last, and the last day's snapshot.
_LAST_DAY_SQL = f"""
WITH {SNAP_SQL.strip()},
l AS (SELECT MAX(day) AS last FROM h),
m AS (SELECT h.*, LAG(hash_diff) OVER (PARTITION BY customer_id ORDER BY day) AS prev FROM h, l WHERE day < last),
v AS (SELECT *, LEAD(day) OVER (PARTITION BY customer_id ORDER BY day) AS next FROM m
      WHERE prev IS NULL OR prev <> hash_diff),
dim AS (SELECT customer_id, region, day AS eff_from, hash_diff FROM v WHERE next IS NULL),
s2 AS (SELECT h.* FROM h, l WHERE day = last)"""


def _before_last(spark, sf_dir):
    snaps = _snapshots(spark, sf_dir)
    last = _days(snaps)[-1]
    return scd2.build_history(snaps.where(F.col("day") < F.to_date(F.lit(last)))), _day(snaps, last), last


@register("scd2_close_changed", _LAST_DAY_SQL + """
SELECT t.customer_id, CAST(NULL AS VARCHAR) AS name, CAST(NULL AS VARCHAR) AS email, t.region, t.eff_from,
       l.last - 1 AS eff_to, FALSE AS is_current, t.hash_diff
FROM dim t, l WHERE EXISTS (SELECT 1 FROM s2 s WHERE s.customer_id = t.customer_id AND s.hash_diff != t.hash_diff)""")
def scd2_close_changed(spark, sf_dir):
    """SCD2-2/JOIN-1: versions of all earlier days closed by the last day."""
    dim, snap, last = _before_last(spark, sf_dir)
    return scd2.closed_versions(dim, snap, last)


@register("scd2_insert_new", _LAST_DAY_SQL + """
SELECT s.customer_id, CAST(NULL AS VARCHAR) AS name, CAST(NULL AS VARCHAR) AS email, s.region,
       s.day AS eff_from, DATE '9999-12-31' AS eff_to, TRUE AS is_current, s.hash_diff
FROM s2 s LEFT JOIN dim t ON t.customer_id = s.customer_id
WHERE t.customer_id IS NULL OR t.hash_diff != s.hash_diff""")
def scd2_insert_new(spark, sf_dir):
    """SCD2-3/JOIN-2/JOIN-3/PRJ-9: new and changed keys of the last day."""
    dim, snap, last = _before_last(spark, sf_dir)
    return scd2.new_versions(dim, snap, last)


_HISTORY_SQL = f"""
WITH {SNAP_SQL.strip()},
m AS (SELECT *, LAG(hash_diff) OVER (PARTITION BY customer_id ORDER BY day) AS prev FROM h),
s AS (SELECT * FROM m WHERE prev IS NULL OR prev <> hash_diff)
SELECT customer_id, CAST(NULL AS VARCHAR) AS name, CAST(NULL AS VARCHAR) AS email, region, day AS eff_from,
       COALESCE(LEAD(day) OVER w - 1, DATE '9999-12-31') AS eff_to, LEAD(day) OVER w IS NULL AS is_current,
       hash_diff
FROM s WINDOW w AS (PARTITION BY customer_id ORDER BY day)"""


@register("scd2_history", _HISTORY_SQL)
def scd2_history(spark, sf_dir):
    """SCD2-5: the whole history from all daily snapshots in one pass."""
    return scd2.build_history(_snapshots(spark, sf_dir))


@register("scd2_history_by_fold", _fold_sql(FOLD_DAYS))
def scd2_history_by_fold(spark, sf_dir):
    """SCD2-4 repeated over all 30 days (the daily job's loop), checkpointed
    every few days; equals :func:`scd2_history`."""
    snaps = _snapshots(spark, sf_dir)
    return scd2.fold_days(spark, snaps, _days(snaps))


def _bronze(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("customer_id"), F.col("event_type").alias("region"), F.to_date("ts").alias("date"))


@register("scd2_stored_dimension", _fold_sql(FOLD_DAYS))
def scd2_stored_dimension(spark, sf_dir):
    """SCD2-4/SRC-1/SNK-13 as the stored daily job: events written as a
    date-partitioned bronze table, every day folded (partition-pruned reads)
    into ``current/`` + ``history/``, and the dimension read back."""
    import uuid

    from slicewarden.plans import jobs
    from slicewarden.session import scratch_path

    base = scratch_path(spark, f"scd2-{uuid.uuid4().hex}")
    # The whole table is written; each day's fold reads its own partition.
    _bronze(spark, sf_dir).write.mode("overwrite").partitionBy("date").parquet(f"{base}/bronze")
    for d in FOLD_DAYS:
        jobs.fold_dimension_day(spark, f"{base}/bronze", f"{base}/dim", d)
    return jobs.read_dimension(spark, f"{base}/dim")


# Days that arrive after later ones, and one first delivered wrong.
LATE_DAYS, WRONG_DAY = ("2024-01-19", "2024-01-07"), "2024-01-12"


@register("scd2_late_days", _HISTORY_SQL)
def scd2_late_days(spark, sf_dir):
    """SCD2-4 out of order: all days but two late ones make the stored
    dimension, one of them with wrong values and under other keys as well; the
    corrected day, the late days and the newest day again are then folded.  The
    result is the history over all days in order."""
    import uuid

    from slicewarden.plans import jobs
    from slicewarden.session import scratch_path

    base = scratch_path(spark, f"late-{uuid.uuid4().hex}")
    rows = _bronze(spark, sf_dir)
    rows.write.mode("overwrite").partitionBy("date").parquet(f"{base}/bronze")
    wrong = F.col("date") == F.lit(WRONG_DAY).cast("date")
    first = rows.where(~F.col("date").isin(*[F.lit(d).cast("date") for d in LATE_DAYS])).withColumn(
        "region", F.when(wrong, F.reverse("region")).otherwise(F.col("region")))
    other_keys = first.where(wrong).withColumn("customer_id", -F.col("customer_id") - 1)
    first.unionByName(other_keys).write.mode("overwrite").partitionBy("date").parquet(f"{base}/first")
    jobs.rebuild_dimension(spark, f"{base}/first", f"{base}/dim")
    for d in (WRONG_DAY, *LATE_DAYS, FOLD_DAYS[-1]):
        jobs.fold_dimension_day(spark, f"{base}/bronze", f"{base}/dim", d)
    return jobs.read_dimension(spark, f"{base}/dim")

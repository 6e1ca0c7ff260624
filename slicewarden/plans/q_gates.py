"""Queries: landing and publish gates, run outcome, publish decision, latest
partition, synthetic orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from slicewarden.operators import gates
from slicewarden.functions import suites
from slicewarden.plans.registry import register
from slicewarden.plans.standins import expected_folders, object_inventory, suite_runs, table
from slicewarden.sources import generate
from slicewarden.sources.generate import orders_from_ids
from slicewarden.sources.partitions import latest_partition

# "Now" of each check, fixed so results repeat: the landing check runs early
# on the 31st, the today-only variant late on the 30th, the publish check on
# the morning of the 30th.
NOW = "2024-01-31 04:00:00"
NOW_TODAY = "2024-01-30 22:00:00"
NOW_PUBLISH = "2024-01-30 06:00:00"
MAX_AGE = 600

INVENTORY_SQL = """
objects AS (
  SELECT 'landing/date=' || CAST(CAST(ts AS DATE) AS VARCHAR) || '/' AS prefix,
         'landing/date=' || CAST(CAST(ts AS DATE) AS VARCHAR) || '/' ||
         CASE WHEN event_type = 'error' AND dayofmonth(ts) % 4 = 1 THEN '_SUCCESS'
              WHEN event_type = 'signup' AND dayofmonth(ts) % 4 IN (1, 2) THEN '_MANIFEST.json'
              WHEN dayofmonth(ts) % 7 = 0 THEN 'part-' || CAST(event_id AS VARCHAR) || '.csv'
              WHEN event_type = 'purchase' THEN 'part-' || CAST(event_id AS VARCHAR) || '.PARQUET'
              WHEN event_type = 'click' THEN 'part-' || CAST(event_id AS VARCHAR) || '.json'
              ELSE 'part-' || CAST(event_id AS VARCHAR) || '.parquet' END AS name,
         CAST(ts AS TIMESTAMP) AS updated, CAST(ts AS DATE) AS ds
  FROM events
)"""

EXPECTED_SQL = """
expected AS (
  SELECT 'landing/date=' || CAST(ds AS VARCHAR) || '/' AS prefix, ds
  FROM (SELECT CAST(unnest(generate_series(MIN(CAST(ts AS DATE)), MAX(CAST(ts AS DATE)) + INTERVAL 2 DAY,
                                           INTERVAL 1 DAY)) AS DATE) AS ds FROM events)
)"""

RUNS_SQL = """
basic AS (
  SELECT CAST(ts AS DATE) AS run_date,
         COUNT(*) FILTER (WHERE event_type = 'error') * 5 <= COUNT(*) AS success,
         CASE WHEN dayofmonth(CAST(ts AS DATE)) % 9 = 0 THEN 0
              ELSE COUNT(*) FILTER (WHERE event_type = 'purchase') END AS staged_files,
         dayofmonth(CAST(ts AS DATE)) % 5 = 0 AS already_published
  FROM events GROUP BY 1
),
cross_runs AS (
  SELECT CAST(ts AS DATE) AS run_date, dayofmonth(CAST(ts AS DATE)) % 3 <> 0 AS success,
         CASE WHEN dayofmonth(CAST(ts AS DATE)) % 9 = 0 THEN 0
              ELSE COUNT(*) FILTER (WHERE event_type = 'view') END AS staged_files,
         FALSE AS already_published
  FROM events GROUP BY 1
),
runs AS (
  SELECT *, 'basic' AS mode, success OR staged_files >= 1 AS good_exported FROM basic
  UNION ALL
  SELECT *, 'cross' AS mode, success OR staged_files >= 1 AS good_exported FROM cross_runs
)"""


def _age(col: str, now: str = NOW) -> str:
    return f"CAST(epoch_us(TIMESTAMP '{now}') - epoch_us({col}) AS DOUBLE) / 60000000.0"


@register("gate_landing_ready", f"""
WITH {INVENTORY_SQL.strip()},
g AS (
  SELECT prefix, COUNT(*) AS n_objects, BOOL_OR(ends_with(name, '_SUCCESS')) AS has_success,
         COUNT(*) FILTER (WHERE ends_with(lower(name), '.parquet')) AS n_matching,
         MAX(updated) FILTER (WHERE ends_with(lower(name), '.parquet')) AS newest
  FROM objects GROUP BY prefix
),
o AS (
  SELECT *, {_age('newest')} AS age_minutes,
         CASE WHEN has_success THEN 'READY_MARKER' WHEN n_matching < 1 THEN 'SKIP_TOO_FEW_FILES'
              WHEN newest IS NULL THEN 'SKIP_NO_TIMESTAMP' WHEN {_age('newest')} > {float(MAX_AGE)} THEN 'SKIP_STALE'
              ELSE 'READY' END AS outcome
  FROM g
)
SELECT prefix, n_objects, has_success, n_matching, newest, age_minutes, starts_with(outcome, 'READY') AS ready,
       outcome FROM o""")
def gate_landing_ready(spark, sf_dir):
    """GATE-1/AGG-8/AGG-9: per landing folder, marker or fresh-enough files."""
    inv = object_inventory(table(spark, sf_dir, "events"))
    return gates.landing_readiness(inv, now=NOW, min_files=1, required_suffix=".parquet",
                                   max_input_age_minutes=MAX_AGE, enforce_today_only=False)


@register("gate_landing_today", f"""
WITH {INVENTORY_SQL.strip()}
SELECT prefix, ds,
       CASE WHEN CAST(ds AS VARCHAR) <> '{NOW_TODAY[:10]}' THEN 'SKIP_NOT_TODAY'
            WHEN BOOL_OR(ends_with(name, '_SUCCESS')) THEN 'READY_MARKER'
            WHEN COUNT(*) FILTER (WHERE ends_with(lower(name), '.parquet')) < 1 THEN 'SKIP_TOO_FEW_FILES'
            WHEN {_age("MAX(updated) FILTER (WHERE ends_with(lower(name), '.parquet'))", NOW_TODAY)}
                 > {float(MAX_AGE)} THEN 'SKIP_STALE'
            ELSE 'READY' END AS outcome
FROM objects GROUP BY prefix, ds""")
def gate_landing_today(spark, sf_dir):
    """GATE-1 with the today-only rule: other dates are skipped first."""
    inv = object_inventory(table(spark, sf_dir, "events"))
    r = gates.landing_readiness(inv, now=NOW_TODAY, max_input_age_minutes=MAX_AGE, enforce_today_only=True,
                                ds_col="ds")
    return r.select("prefix", "ds", "outcome")


@register("gate_publish_check", f"""
WITH {INVENTORY_SQL.strip()},
g AS (
  SELECT prefix, MAX(updated) FILTER (WHERE ends_with(name, '_MANIFEST.json')) AS manifest_updated,
         MAX(updated) FILTER (WHERE ends_with(name, '_SUCCESS')) AS success_updated
  FROM objects GROUP BY prefix
)
SELECT prefix, manifest_updated, success_updated, {_age('manifest_updated', NOW_PUBLISH)} AS manifest_age_minutes,
       {_age('success_updated', NOW_PUBLISH)} AS success_age_minutes,
       CASE WHEN manifest_updated IS NULL OR success_updated IS NULL THEN 'FAIL_MISSING'
            WHEN {_age('manifest_updated', NOW_PUBLISH)} > {float(MAX_AGE)}
              OR {_age('success_updated', NOW_PUBLISH)} > {float(MAX_AGE)} THEN 'FAIL_STALE'
            ELSE 'OK' END AS status
FROM g""")
def gate_publish_check(spark, sf_dir):
    """GATE-2: both publish markers present and fresh."""
    inv = object_inventory(table(spark, sf_dir, "events"))
    return gates.publish_check(inv, now=NOW_PUBLISH, max_publish_age_minutes=MAX_AGE)


@register("gate_landing_expected", f"""
WITH {INVENTORY_SQL.strip()}, {EXPECTED_SQL.strip()},
g AS (
  SELECT e.prefix, COUNT(o.name) AS n_objects, COALESCE(BOOL_OR(ends_with(o.name, '_SUCCESS')), FALSE) AS has_success,
         COUNT(*) FILTER (WHERE ends_with(lower(o.name), '.parquet')) AS n_matching,
         MAX(o.updated) FILTER (WHERE ends_with(lower(o.name), '.parquet')) AS newest
  FROM expected e LEFT JOIN objects o ON e.prefix = o.prefix GROUP BY e.prefix
)
SELECT prefix, n_objects, n_matching,
       CASE WHEN has_success THEN 'READY_MARKER' WHEN n_matching < 1 THEN 'SKIP_TOO_FEW_FILES'
            WHEN {_age('newest')} > {float(MAX_AGE)} THEN 'SKIP_STALE' ELSE 'READY' END AS outcome
FROM g""")
def gate_landing_expected(spark, sf_dir):
    """GATE-1 over the expected folders, also those without any object."""
    ev = table(spark, sf_dir, "events")
    r = gates.landing_readiness(object_inventory(ev), now=NOW, max_input_age_minutes=MAX_AGE, enforce_today_only=False,
                                expected=expected_folders(ev))
    return r.select("prefix", "n_objects", "n_matching", "outcome")


@register("gate_publish_expected", f"""
WITH {INVENTORY_SQL.strip()}, {EXPECTED_SQL.strip()},
g AS (
  SELECT e.prefix, MAX(o.updated) FILTER (WHERE ends_with(o.name, '_MANIFEST.json')) AS manifest_updated,
         MAX(o.updated) FILTER (WHERE ends_with(o.name, '_SUCCESS')) AS success_updated
  FROM expected e LEFT JOIN objects o ON e.prefix = o.prefix GROUP BY e.prefix
)
SELECT prefix, CASE WHEN manifest_updated IS NULL OR success_updated IS NULL THEN 'FAIL_MISSING'
                    WHEN {_age('manifest_updated', NOW_PUBLISH)} > {float(MAX_AGE)}
                      OR {_age('success_updated', NOW_PUBLISH)} > {float(MAX_AGE)} THEN 'FAIL_STALE'
                    ELSE 'OK' END AS status
FROM g""")
def gate_publish_expected(spark, sf_dir):
    """GATE-2 over the expected folders, also those without any object."""
    ev = table(spark, sf_dir, "events")
    return gates.publish_check(object_inventory(ev), now=NOW_PUBLISH, max_publish_age_minutes=MAX_AGE,
                               expected=expected_folders(ev)).select("prefix", "status")


@register("gate_run_outcome", f"""
WITH {RUNS_SQL.strip()}
SELECT run_date, COUNT(*) AS suites_run, BOOL_AND(success) AS all_success, BOOL_OR(good_exported) AS good_exported,
       CASE WHEN BOOL_AND(success) THEN 'ok' WHEN BOOL_OR(good_exported) THEN 'partial_ok' ELSE 'fail' END AS status
FROM runs GROUP BY run_date""")
def gate_run_outcome(spark, sf_dir):
    """GATE-3: ok / partial_ok / fail per run date over both suites."""
    return gates.run_outcome(suite_runs(table(spark, sf_dir, "events")), export_good_on_failure=True)


@register("gate_publish_decision", f"""
WITH {RUNS_SQL.strip()}
SELECT run_date, mode, success, staged_files, already_published,
       success OR staged_files >= 1 AS should_publish,
       CASE WHEN (success OR staged_files >= 1) AND already_published THEN 'skip_already_published'
            WHEN success OR staged_files >= 1 THEN 'publish' ELSE 'mark_failed' END AS action,
       (success OR staged_files >= 1) AND NOT already_published AS published,
       (success OR staged_files >= 1) AND NOT already_published AND NOT success AS partial_publish
FROM runs""")
def gate_publish_decision(spark, sf_dir):
    """GATE-4: publish, keep the existing publish, or mark failed."""
    runs = suite_runs(table(spark, sf_dir, "events")).select(
        "run_date", "mode", "success", "staged_files", "already_published")
    return gates.publish_decision(runs, export_good_on_failure=True, min_files=1, allow_republish=False)


@register("src_latest_partition", """
SELECT MAX(CAST(ts AS DATE)) AS latest_ds FROM events""")
def src_latest_partition(spark, sf_dir):
    """SRC-4/AGG-8: the newest partition date."""
    ev = table(spark, sf_dir, "events").select(F.to_date("ts").alias("ds"))
    return latest_partition(ev, "ds")


def _pick_sql(values, draw: int) -> str:
    items = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)
    return f"list_extract([{items}], u{draw} * {len(values)} // 4294967296 + 1)"


@register("src_generated_orders", f"""
WITH o AS (
  SELECT CAST(o_orderkey AS BIGINT) AS order_id, CAST(o_orderdate AS DATE) AS order_date FROM orders),
d AS (SELECT *, {' || '.join(f"md5(CAST(order_id AS VARCHAR) || '|{k}|{generate.SEED}')" for k in range(3))} AS digest FROM o),
u AS (SELECT order_id, order_date, {', '.join(f"CAST('0x' || substr(digest, {8 * k + 1}, 8) AS BIGINT) AS u{k}"
                                               for k in range(12))} FROM d),
a AS (SELECT *, {generate.AMOUNT_CENTS[0]} + u1 * {generate.AMOUNT_CENTS[1] - generate.AMOUNT_CENTS[0] + 1} // 4294967296
             AS amount FROM u),
t AS (SELECT *, (amount * ({generate.TAX_BASIS_POINTS[0]} + u2 * {generate.TAX_BASIS_POINTS[1] - generate.TAX_BASIS_POINTS[0] + 1}
             // 4294967296) + 5000) // 10000 AS tax FROM a),
x AS (SELECT *, ((amount + tax) * {_pick_sql(generate.DISCOUNT_PERCENTS, 3)} + 50) // 100 AS discount FROM t)
SELECT order_id, CAST({generate.CUSTOMER_RANGE[0]} + u4 * {generate.CUSTOMER_RANGE[1] - generate.CUSTOMER_RANGE[0] + 1}
         // 4294967296 AS BIGINT) AS customer_id, order_date,
       CAST(order_date AS TIMESTAMP) + to_seconds(u0 * 86400 // 4294967296) AS order_timestamp,
       {_pick_sql(suites.ORDER_STATUS_VALUES, 5)} AS order_status,
       {_pick_sql(suites.PAYMENT_METHOD_VALUES, 6)} AS payment_method, 'INR' AS currency, amount / 100.0::DOUBLE AS order_amount,
       tax / 100.0::DOUBLE AS tax_amount, discount / 100.0::DOUBLE AS discount_amount,
       (amount + tax - discount) / 100.0::DOUBLE AS net_amount, u7 * 2 // 4294967296 = 0 AS is_first_order,
       {_pick_sql(suites.REGION_VALUES, 8)} AS region, {_pick_sql(suites.CATEGORY_VALUES, 9)} AS category,
       CAST({generate.ITEM_RANGE[0]} + u10 * {generate.ITEM_RANGE[1] - generate.ITEM_RANGE[0] + 1} // 4294967296 AS BIGINT)
         AS item_count
FROM x""")
def src_generated_orders(spark, sf_dir):
    """SRC-10: seeded synthetic orders, one per driver order key on its
    order date."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_id"),
                                              F.to_date("o_orderdate").alias("d"))
    return orders_from_ids(o, F.col("d"))

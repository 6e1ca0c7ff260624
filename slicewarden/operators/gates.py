"""Readiness and outcome gates, as aggregations over inventories and results.

An object inventory has one row per stored object:
``(prefix, name, updated)`` — ``prefix`` is the partition folder the gate
looks at, ``name`` the object's path, ``updated`` its modification time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Marker names.
SUCCESS_MARKER = "_SUCCESS"
MANIFEST_MARKER = "_MANIFEST.json"
FAILED_MARKER = "_FAILED"


def _age_minutes(now: Column, then: Column) -> Column:
    """Minutes between two timestamps (either kind; wall-clock values are
    read in the session time zone, UTC)."""
    return (F.unix_micros(now.cast("timestamp")) - F.unix_micros(then.cast("timestamp"))).cast("double") \
        / F.lit(60_000_000.0)


def _ts(value: str) -> Column:
    return F.to_timestamp(F.lit(value))


def _for_expected(found: DataFrame, expected: DataFrame, cols: list[str]) -> DataFrame:
    """One row per expected folder, with what was found in it."""
    return expected.select(*cols).distinct().join(found, cols, "left")


def landing_readiness(inventory: DataFrame, *, now: str, min_files: int = 1, required_suffix: str = ".parquet",
                      accept_success_marker: bool = True, max_input_age_minutes: float = 180,
                      enforce_today_only: bool = True, ds_col: str | None = None,
                      expected: DataFrame | None = None) -> DataFrame:
    """Per prefix: is the landing partition ready?

    Ready when a ``_SUCCESS`` object is present (this bypasses the freshness
    test), or when at least ``min_files`` objects end with the suffix and the
    newest of them is at most ``max_input_age_minutes`` old.  With
    ``enforce_today_only`` a partition whose date (``ds_col``) is not today's
    is skipped first; without ``ds_col`` that rule cannot be checked and
    raises.  Outcome is READY or SKIP.  ``expected`` (prefix, and ``ds_col`` if
    given) lists the folders to answer for: one without objects is skipped
    for too few files; without it only folders that hold objects have a row.
    """
    if enforce_today_only and not ds_col:
        raise ValueError("enforce_today_only needs ds_col, the partition's date")
    nowc = _ts(now)
    suffix_hit = F.lower(F.col("name")).endswith(required_suffix.lower())
    grouped_cols = ["prefix"] + ([ds_col] if ds_col else [])
    g = inventory.groupBy(*grouped_cols).agg(
        F.count(F.lit(1)).alias("n_objects"),
        F.bool_or(F.col("name").endswith(SUCCESS_MARKER)).alias("has_success"),
        F.count_if(suffix_hit).alias("n_matching"),
        F.max(F.when(suffix_hit, F.col("updated"))).alias("newest"),
    )
    if expected is not None:
        g = _for_expected(g, expected, grouped_cols).fillna({"n_objects": 0, "n_matching": 0, "has_success": False})
    age = _age_minutes(nowc, F.col("newest"))
    not_today = F.coalesce(F.col(ds_col).cast("string") != F.date_format(nowc, "yyyy-MM-dd"), F.lit(True)) \
        if enforce_today_only else F.lit(False)
    marker = F.col("has_success") & F.lit(accept_success_marker)
    outcome = (F.when(not_today, F.lit("SKIP_NOT_TODAY"))
               .when(marker, F.lit("READY_MARKER"))
               .when(F.col("n_matching") < min_files, F.lit("SKIP_TOO_FEW_FILES"))
               .when(F.col("newest").isNull(), F.lit("SKIP_NO_TIMESTAMP"))
               .when(age > F.lit(float(max_input_age_minutes)), F.lit("SKIP_STALE"))
               .otherwise(F.lit("READY")))
    return g.select(
        *grouped_cols, "n_objects", "has_success", "n_matching", "newest",
        age.alias("age_minutes"),
        outcome.startswith("READY").alias("ready"),
        outcome.alias("outcome"),
    )


def publish_check(inventory: DataFrame, *, now: str, max_publish_age_minutes: float = 180,
                  expected: DataFrame | None = None) -> DataFrame:
    """Per prefix: both publish markers present and each fresh → OK, else FAIL.
    An ``expected`` prefix without objects fails as missing."""
    nowc = _ts(now)
    g = inventory.groupBy("prefix").agg(
        F.max(F.when(F.col("name").endswith(MANIFEST_MARKER), F.col("updated"))).alias("manifest_updated"),
        F.max(F.when(F.col("name").endswith(SUCCESS_MARKER), F.col("updated"))).alias("success_updated"),
    )
    if expected is not None:
        g = _for_expected(g, expected, ["prefix"])
    age_m = _age_minutes(nowc, F.col("manifest_updated"))
    age_s = _age_minutes(nowc, F.col("success_updated"))
    lim = F.lit(float(max_publish_age_minutes))
    status = (F.when(F.col("manifest_updated").isNull() | F.col("success_updated").isNull(), F.lit("FAIL_MISSING"))
              .when((age_m > lim) | (age_s > lim), F.lit("FAIL_STALE"))
              .otherwise(F.lit("OK")))
    return g.select("prefix", "manifest_updated", "success_updated", age_m.alias("manifest_age_minutes"),
                    age_s.alias("success_age_minutes"), status.alias("status"))


def run_outcome(results: DataFrame, *, export_good_on_failure: bool = True) -> DataFrame:
    """Per run date over the suite results ``(run_date, mode, success,
    good_exported)``: all suites pass → ok; else good rows exported and
    allowed → partial_ok; else fail."""
    g = results.groupBy("run_date").agg(
        F.every(F.col("success")).alias("all_success"),
        F.bool_or(F.col("good_exported")).alias("good_exported"),
        F.count(F.lit(1)).alias("suites_run"),
    )
    status = (F.when(F.col("all_success"), F.lit("ok"))
              .when(F.lit(export_good_on_failure) & F.col("good_exported"), F.lit("partial_ok"))
              .otherwise(F.lit("fail")))
    return g.select("run_date", "suites_run", "all_success", "good_exported", status.alias("status"))


def publish_decision(runs: DataFrame, *, export_good_on_failure: bool, min_files: int = 1,
                     allow_republish: bool = False) -> DataFrame:
    """Per run ``(run_date, success, staged_files, already_published)``:
    publish when the suite passed, or when good rows may be exported on
    failure and enough files are staged; an existing publish is kept unless
    republishing is allowed.  ``published`` is the real outcome."""
    should = F.col("success") | (F.lit(export_good_on_failure) & (F.col("staged_files") >= min_files))
    blocked = F.col("already_published") & ~F.lit(allow_republish)
    action = (F.when(should & blocked, F.lit("skip_already_published"))
              .when(should, F.lit("publish"))
              .otherwise(F.lit("mark_failed")))
    return runs.select("*", should.alias("should_publish"), action.alias("action"),
                       (should & ~blocked).alias("published"),
                       (should & ~blocked & ~F.col("success")).alias("partial_publish"))

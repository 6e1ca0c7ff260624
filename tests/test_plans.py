"""Plan-shape tests: the scale properties the operators promise."""

import re

from slicewarden.functions import suites
from slicewarden.operators import dedupe, validate
from slicewarden.operators.split import split_rows
from slicewarden.plans.q_validate import ORDER_COLS
from slicewarden.plans.standins import orders_like, table
from slicewarden.functions.derive import with_cross_checks

from conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def lineitem(spark):
    return table(spark, SF_SMALL, "lineitem")


def test_keep_first_combines_map_side_without_window(spark):
    p = plan(dedupe.keep_first(lineitem(spark), ["l_orderkey"], ["l_linenumber", "l_partkey"]))
    assert "Window" not in p
    assert re.search(r"(Sort|Hash)Aggregate\(keys?=\[l_orderkey#\d+L\], functions=\[partial_min", p)


def test_duplicate_flags_without_window(spark):
    p = plan(dedupe.flag_duplicates(lineitem(spark), ["l_orderkey", "l_linenumber"]))
    assert "Window" not in p
    assert "partial_count" in p


def test_capped_sample_limits_before_shuffles(spark):
    df = dedupe.capped_sample(lineitem(spark), ["l_returnflag"], ["l_orderkey", "l_linenumber"], cap=100)
    opt = optimized(df)
    assert opt.count("WindowGroupLimit") >= 2
    p = plan(df)
    assert p.count("WindowGroupLimit") >= 2


def test_suite_is_one_scan_plus_key_pass(spark):
    asset = with_cross_checks(orders_like(lineitem(spark)).select(*ORDER_COLS))
    p = plan(validate.run_suite(asset, suites.BASIC_SUITE))
    assert p.count("FileScan parquet") == 2          # all row rules + the uniqueness key pass
    key_scan = [ln for ln in p.split("\n") if "FileScan parquet" in ln and "ReadSchema: struct<l_orderkey:bigint>" in ln]
    assert key_scan, "uniqueness pass must read the key column only"


def test_split_prunes_columns(spark):
    s = split_rows(orders_like(lineitem(spark)).select(*ORDER_COLS), suites.EXPORT_BAD_CONDITIONS)
    p = plan(s.counts)
    assert p.count("FileScan parquet") == 1
    assert "l_quantity" in p and "props" not in p

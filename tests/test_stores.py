"""Stored tables read back equal their SQL twins; row limits of the suites."""

import duckdb
import pytest

from slicewarden.functions import suites
from slicewarden.functions.rules import ROW_COUNT
from slicewarden.operators import dedupe, validate
from slicewarden.plans import ORACLE, QUERIES
from slicewarden.plans.standins import TABLES

from conftest import SF_SMALL

STORED = ["snk_replaced_partition", "snk_quarantine_csv", "snk_rule_counts_json", "flt_pass_through",
          "src_latest_ingest", "src_file_folders", "bkf_external_status", "src_generated_suite",
          "job_csv_dedup_table", "bkf_stored_plan"]


def _plain(v):
    return float(f"{v:.9g}") if isinstance(v, float) else v


def _rows(cols, rows):
    at = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr([_plain(r[i]) for i in at]) for r in rows)


@pytest.mark.parametrize("name", STORED)
def test_read_back_equals_twin(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = QUERIES[name](spark, SF_SMALL)
    cur = con.execute(ORACLE[name])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    got = _rows(df.columns, df.collect())
    assert got == _rows(cols, cur.fetchall()) and got


def test_row_limit_is_a_parameter(spark):
    rows = spark.range(5).withColumnRenamed("id", "order_id")

    def passes(max_rows):
        rules = [r for r in suites.with_row_limit(suites.BASIC_SUITE, max_rows) if r.kind == ROW_COUNT]
        return validate.run_suite(rows, rules).first().success

    assert passes(None) and passes(5) and not passes(4)


def test_capped_sample_default_fan_in(spark):
    df = spark.range(0, 1000, 1, 7).selectExpr("id AS pos", "id % 3 AS file")
    got = dedupe.capped_sample(df, ["file"], ["pos"], cap=4)
    want = sorted((f, p, (p - f) // 3 + 1) for f in range(3) for p in range(f, 12, 3))
    assert sorted((r.file, r.pos, r._sample_rank) for r in got.collect()) == want

"""Driver contract at sf0.001 against DuckDB, and the landing stream."""

import datetime as dt
import os
import re

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from slicewarden.functions import suites
from slicewarden.sources.generate import generate_orders
from slicewarden.streaming.landing import run_landing

from conftest import SF_SMALL


def test_entry_runs(spark):
    rows = entry(spark).collect()
    assert len(rows) == len(suites.BASIC_SUITE)


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_duckdb(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF_SMALL):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{SF_SMALL}/{f}')")
    df = queries()[name](spark, SF_SMALL)
    cur = con.execute(oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    key = sorted(dcols)
    s = sorted(repr(tuple(_norm(r[c]) for c in key)) for r in df.collect())
    d = sorted(repr(tuple(_norm(dict(zip(dcols, r))[c]) for c in key)) for r in cur.fetchall())
    assert s == d


def test_every_query_has_oracle_or_test():
    assert set(oracle_sql()) <= set(queries())
    # The training-data queries without SQL are tested with their subpackage.
    own = {q for q in queries() if not re.match(r"op\d+_|pipeline$", q)}
    assert own - set(oracle_sql()) == {"src_generated_orders"}


def test_landing_stream_incremental(spark, tmpdir_path):
    landing = os.path.join(tmpdir_path, "landing")
    out = os.path.join(tmpdir_path, "out")
    ck = os.path.join(tmpdir_path, "ck")
    day1 = generate_orders(spark, "2024-01-01", rows=100, partitions=1)
    day1.write.mode("append").parquet(os.path.join(landing, "date=2024-01-01"))
    schema = spark.read.parquet(landing).schema
    run_landing(spark, landing, schema, out, ck)
    assert spark.read.parquet(os.path.join(out, "good")).count() == 100
    bad = generate_orders(spark, "2024-01-02", rows=40, partitions=1).selectExpr(
        "*", "'XXX' AS currency2").drop("currency").withColumnRenamed("currency2", "currency")
    bad.select(*day1.columns).write.mode("append").parquet(os.path.join(landing, "date=2024-01-02"))
    run_landing(spark, landing, schema, out, ck)   # only the new day is read
    runs = spark.read.parquet(os.path.join(out, "runs")).collect()
    assert sorted((str(r.date), r.rows_good, r.rows_bad) for r in runs) == [
        ("2024-01-01", 100, 0), ("2024-01-02", 0, 40)]


def test_queries_without_the_training_data_operators(monkeypatch):
    """A library that those operators need is missing: the others stay."""
    import sys

    import __spark_entry__ as entry

    everything = set(entry.queries())
    for gone in ("slicewarden.llm.queries", "corpus_pipeline"):
        monkeypatch.delitem(sys.modules, gone, raising=False)
        monkeypatch.setitem(sys.modules, gone, None)
    left = set(entry.queries())
    assert left == {q for q in everything if not q.startswith("op") and q != "pipeline"} and len(left) > 60
    assert set(entry.oracle_sql()) <= left

"""Queries: raw-CSV tags, profile, quarantine, sample, deduplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from slicewarden.functions import suites
from slicewarden.operators import dedupe, profile, validate
from slicewarden.plans import sqltext as S
from slicewarden.plans.registry import register
from slicewarden.plans.standins import CSV_SOURCE_ORDER, csv_feed, table

CSV_COLS = [c.strip() for c in S.CSV_COLUMNS.split(",")]
LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
CSV_ORDER_SQL = ", ".join(CSV_SOURCE_ORDER)


def _tagged(spark, sf_dir):
    return profile.tag_rows(csv_feed(table(spark, sf_dir, "lineitem")))


def _with(ctes: str) -> str:
    return f"WITH {S.CSV_FEED.strip()}, {S.CSV_TAGGED.strip()}{ctes}"


@register("csv_tagged_rows", _with("") + f"\nSELECT {S.CSV_COLUMNS}, _failed_rules FROM csv_tagged")
def csv_tagged_rows(spark, sf_dir):
    """FLT-5/FLT-6/WIN-2: every row with its comma list of failed rules."""
    return _tagged(spark, sf_dir).select(*CSV_COLS, "_failed_rules")


@register("csv_good_rows", _with("") + f"\nSELECT {S.CSV_COLUMNS} FROM csv_tagged WHERE _failed_rules = ''")
def csv_good_rows(spark, sf_dir):
    """FLT-7 good side: rows failing no rule."""
    return profile.good_rows(_tagged(spark, sf_dir)).select(*CSV_COLS)


@register("csv_quarantine_rows",
          _with("") + f"\nSELECT {S.CSV_COLUMNS}, _failed_rules FROM csv_tagged WHERE _failed_rules <> ''")
def csv_quarantine_rows(spark, sf_dir):
    """FLT-7 bad side / SNK-4 content: failing rows with their tags."""
    return profile.bad_rows(_tagged(spark, sf_dir)).select(*CSV_COLS, "_failed_rules")


@register("csv_rule_counts", _with("") + """
SELECT _file, rule, COUNT(*) AS failing_rows
FROM (SELECT _file, UNNEST(string_split(_failed_rules, ',')) AS rule FROM csv_tagged WHERE _failed_rules <> '')
GROUP BY _file, rule""")
def csv_rule_counts(spark, sf_dir):
    """AGG-4: per file and rule, the number of failing rows."""
    return profile.rule_counts(_tagged(spark, sf_dir))


@register("csv_file_summary", _with("") + f"""
SELECT _file, COUNT(*) AS rows_total, COUNT(*) FILTER (WHERE _failed_rules <> '') AS rows_bad,
       COUNT(*) FILTER (WHERE _failed_rules <> '') AS sampled_bad
FROM csv_tagged GROUP BY _file""")
def csv_file_summary(spark, sf_dir):
    """AGG-5/VAL-11: rows_total, rows_bad, sampled_bad per source file."""
    return profile.file_summary(_tagged(spark, sf_dir))


@register("csv_bad_sample", _with(f""",
ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY _file ORDER BY {CSV_ORDER_SQL}) AS sample_rank
           FROM csv_tagged WHERE _failed_rules <> '')""") + f"""
SELECT {S.CSV_COLUMNS}, _failed_rules, sample_rank FROM ranked""")
def csv_bad_sample(spark, sf_dir):
    """LIM-2/SNK-8: every bad row, tagged, with its rank in its file."""
    s = profile.bad_sample(_tagged(spark, sf_dir), CSV_SOURCE_ORDER)
    return s.select(*CSV_COLS, "_failed_rules", F.col("sample_rank").cast("long").alias("sample_rank"))


@register("dedup_good_orders", _with(f""",
good AS (SELECT * FROM csv_tagged WHERE _failed_rules = ''),
ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY _file, {CSV_ORDER_SQL}) AS rn FROM good)""")
    + f"\nSELECT {S.CSV_COLUMNS} FROM ranked WHERE rn = 1")
def dedup_good_orders(spark, sf_dir):
    """DEDUP-1/WIN-1/PRJ-6: good rows, first copy of each order id by file
    then position."""
    good = profile.good_rows(_tagged(spark, sf_dir)).select(*CSV_COLS)
    return dedupe.keep_first(good, ["order_id"], ["_file"] + CSV_SOURCE_ORDER)


@register("win_duplicate_flags", f"""
SELECT {', '.join(LINEITEM_COLS)}, COUNT(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 AS _dup
FROM lineitem""")
def win_duplicate_flags(spark, sf_dir):
    """WIN-2: every copy of a repeated (l_orderkey, l_linenumber) flagged."""
    li = table(spark, sf_dir, "lineitem").select(*LINEITEM_COLS)
    return dedupe.flag_duplicates(li, ["l_orderkey", "l_linenumber"])


@register("win_duplicate_flags_hot", f"""
SELECT {', '.join(LINEITEM_COLS)}, COUNT(*) OVER (PARTITION BY l_returnflag, l_suppkey) > 1 AS _dup,
       COUNT(*) OVER (PARTITION BY l_linestatus) > 1 AS _dup_status FROM lineitem""")
def win_duplicate_flags_hot(spark, sf_dir):
    """WIN-2 on its branch for hot keys: of the first keys some are hot and some
    are not, each of the others holds about half of all rows."""
    li = table(spark, sf_dir, "lineitem").select(*LINEITEM_COLS)
    some = dedupe.flag_duplicates(li, ["l_suppkey"], scope=["l_returnflag"], hot_rows=50)
    return dedupe.flag_duplicates(some, ["l_linestatus"], name="_dup_status", hot_rows=50)


_LI_REST = [c for c in LINEITEM_COLS if c not in ("l_orderkey", "l_linenumber")]


@register("win_dedup_lineitem", f"""
SELECT {', '.join(LINEITEM_COLS)} FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY {', '.join(c + ' NULLS FIRST' for c in _LI_REST)}) AS rn
  FROM lineitem) WHERE rn = 1""")
def win_dedup_lineitem(spark, sf_dir):
    """WIN-1: first row per (l_orderkey, l_linenumber) in a total order."""
    li = table(spark, sf_dir, "lineitem").select(*LINEITEM_COLS)
    return dedupe.keep_first(li, ["l_orderkey", "l_linenumber"], _LI_REST)


@register("dedup_documents", """
SELECT doc_id, lang, source, n_chars FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1""")
def dedup_documents(spark, sf_dir):
    """WIN-1 on whole texts: the lowest doc id of each exact text.

    The whole text is hashed on the map side and the group key is
    (SHA-256, length): 40 bytes per row cross the shuffle instead of the
    document, and the texts themselves never leave their scan task.
    """
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", "source", "n_chars",
        F.sha2(F.col("text"), 256).alias("text_sha"), F.length("text").alias("text_len"))
    kept = dedupe.keep_first(docs, ["text_sha", "text_len"], ["doc_id"])
    return kept.select("doc_id", "lang", "source", "n_chars")


ROUNDTRIP_SQL = f"""
WITH {S.CSV_FEED.strip()}
SELECT replace(replace(_file, 'ingest/part-', ''), '.csv', '') AS label, order_id, amount, views, source,
       CASE WHEN lacks_views THEN 'views' ELSE '' END AS missing, src_orderkey, src_linenumber
FROM csv_feed"""


@register("src_csv_header_groups", ROUNDTRIP_SQL)
def src_csv_header_groups(spark, sf_dir):
    """SRC-3/SET-1/SNK-4: the CSV feed written as real CSV files in two header
    layouts (the RF file lacks ``views`` and orders its columns differently),
    read back by header group with typed required columns."""
    import uuid

    from slicewarden.functions.suites import CSV_REQUIRED_COLUMNS
    from slicewarden.plans.jobs import CSV_TYPES
    from slicewarden.session import scratch_path
    from slicewarden.sources.csv_source import read_csv_groups

    feed = csv_feed(table(spark, sf_dir, "lineitem")).withColumn(
        "label", F.regexp_extract("_file", r"part-(\w+)\.csv", 1))
    folder = scratch_path(spark, f"csv-{uuid.uuid4().hex}") + "/ingest_dt=1995-01-01"
    keys = ["src_orderkey", "src_linenumber"]
    full = feed.where(F.col("label") != "RF").select("order_id", "amount", "views", "source", *keys, "label")
    lacks = feed.where(F.col("label") == "RF").select("source", *keys, "order_id", "amount", "label")
    for part in (full, lacks):
        part.write.mode("append").option("header", "true").partitionBy("label").csv(folder)
    back = read_csv_groups(spark, folder, CSV_REQUIRED_COLUMNS, CSV_TYPES | {"order_id": "bigint"})
    return back.select(
        F.regexp_extract("_file", r"label=(\w+)", 1).alias("label"), "order_id", "amount", "views", "source",
        F.array_join("_missing", ",").alias("missing"),
        F.col("src_orderkey").cast("long").alias("src_orderkey"),
        F.col("src_linenumber").cast("int").alias("src_linenumber"))


@register("csv_file_suite", f"""
WITH {S.CSV_FEED.strip()}
{S.suite_sql(suites.CSV_SUITE, 'csv_feed', by='_file', present={'views': 'NOT lacks_views'})}""")
def csv_file_suite(spark, sf_dir):
    """VAL-1/VAL-11: the CSV suite per source file in one aggregation
    (required columns exist, order id not null and unique, ranges, source
    set); rules on a column a file lacks are not evaluated for it."""
    feed = csv_feed(table(spark, sf_dir, "lineitem"))
    return validate.run_suite(feed, suites.CSV_SUITE, by=["_file"], missing_col="_missing")

"""SQL twins of the stand-in projections and rule suites (DuckDB dialect).

These are written independently of the Spark code; the oracle check runs
them next to the DataFrame plans on the same parquet tables.
"""

from __future__ import annotations

import re

from slicewarden.functions.rules import (BETWEEN, EXISTS, EXPRESSION, IN_SET, LENGTH_BETWEEN, NOT_NULL, ROW_COUNT,
                                         UNIQUE, Rule)
from slicewarden.functions.suites import EXPORT_BAD_CONDITIONS

ORDERS_LIKE = """
orders_like AS (
  SELECT
    CASE WHEN l_orderkey <> 0 THEN l_orderkey END AS order_id,
    CASE WHEN l_orderkey <> 0 THEN l_partkey END AS customer_id,
    CAST(l_shipdate AS DATE) AS order_date,
    CASE WHEN l_linenumber = 7 THEN CAST(l_shipdate AS TIMESTAMP) + INTERVAL 1 DAY
         ELSE CAST(l_shipdate AS TIMESTAMP) END AS order_timestamp,
    CASE WHEN l_quantity = 50 THEN NULL WHEN l_quantity = 49 THEN 'LOST'
         WHEN l_returnflag = 'N' THEN 'NEW' WHEN l_returnflag = 'A' THEN 'SHIPPED'
         WHEN l_linestatus = 'F' THEN 'DELIVERED' ELSE 'CANCELLED' END AS order_status,
    CASE l_linenumber WHEN 1 THEN 'Credit Card' WHEN 2 THEN 'Wallet' WHEN 3 THEN 'COD' WHEN 4 THEN 'UPI'
         WHEN 5 THEN 'Wallet' WHEN 6 THEN 'Credit Card' ELSE 'Cheque' END AS payment_method,
    CASE WHEN l_discount = 0.0 THEN 'IN' WHEN l_discount = 0.1 THEN 'INRR' ELSE 'INR' END AS currency,
    CASE WHEN l_quantity = 2 THEN -l_extendedprice ELSE l_extendedprice END AS order_amount,
    (CASE WHEN l_tax <> 0.0 THEN l_tax END) * l_extendedprice AS tax_amount,
    l_discount * l_extendedprice AS discount_amount,
    l_extendedprice + l_tax * l_extendedprice - l_discount * l_extendedprice
      + CASE WHEN l_quantity = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS net_amount,
    l_linenumber = 1 AS is_first_order,
    CASE WHEN l_suppkey % 25 = 0 THEN NULL WHEN l_suppkey % 4 = 0 THEN 'IN-N' WHEN l_suppkey % 4 = 1 THEN 'IN-S'
         WHEN l_suppkey % 4 = 2 THEN 'IN-E' ELSE 'IN-W' END AS region,
    'cat-' || l_linestatus AS category,
    CAST(l_quantity AS BIGINT) - 1 AS item_count,
    l_orderkey AS src_orderkey, l_linenumber AS src_linenumber, l_partkey AS src_partkey,
    l_suppkey AS src_suppkey, l_extendedprice AS src_price, l_shipdate AS src_shipdate,
    l_quantity AS src_quantity, l_discount AS src_discount, l_tax AS src_tax,
    l_returnflag AS src_returnflag, l_linestatus AS src_linestatus
  FROM lineitem
)"""

ORDER_COLUMNS = ("order_id, customer_id, order_date, order_timestamp, order_status, payment_method, currency, "
                 "order_amount, tax_amount, discount_amount, net_amount, is_first_order, region, category, "
                 "item_count")

CROSS_CHECKS = """
cross_checks AS (
  SELECT *,
    ABS(net_amount - (order_amount + tax_amount - discount_amount)) AS amt_diff,
    CASE WHEN CAST(order_timestamp AS DATE) != order_date THEN 1 ELSE 0 END AS ts_date_mismatch_flag,
    CASE WHEN discount_amount - (order_amount + tax_amount) IS NULL THEN NULL
         ELSE GREATEST(discount_amount - (order_amount + tax_amount), 0.0::DOUBLE) END AS discount_excess,
    CASE WHEN discount_amount > (order_amount + tax_amount) THEN 1 ELSE 0 END AS discount_excess_flag
  FROM orders_like
)"""

CSV_FEED = """
csv_feed AS (
  SELECT
    'ingest/part-' || l_returnflag || l_linestatus || '.csv' AS _file,
    CASE WHEN l_partkey <> 0 THEN l_orderkey * 10 + l_linenumber END AS order_id,
    l_extendedprice * CASE WHEN l_discount = 0.1 THEN 10.0::DOUBLE ELSE 1.0::DOUBLE END AS amount,
    CASE WHEN NOT (l_returnflag = 'R' AND l_linestatus = 'F') THEN (l_quantity - 1.0::DOUBLE) * 210.0::DOUBLE END
      AS views,
    CASE l_linenumber WHEN 1 THEN 'Google' WHEN 2 THEN 'Microsoft' WHEN 3 THEN 'Facebook' WHEN 4 THEN 'Apple'
         WHEN 5 THEN 'Amazon' WHEN 6 THEN 'Yahoo' END AS source,
    (l_returnflag = 'R' AND l_linestatus = 'F') AS lacks_views,
    l_orderkey AS src_orderkey, l_linenumber AS src_linenumber, l_partkey AS src_partkey,
    l_suppkey AS src_suppkey, l_extendedprice AS src_extendedprice, l_shipdate AS src_shipdate,
    l_quantity AS src_quantity, l_discount AS src_discount, l_tax AS src_tax
  FROM lineitem
)"""

# Per-file duplicate evidence and the comma list of failed rules (NULL fails).
CSV_TAGGED = """
csv_counts AS (
  SELECT _file, order_id, COUNT(*) AS n FROM csv_feed GROUP BY _file, order_id
),
csv_tagged AS (
  SELECT f.*,
    concat_ws(',',
      CASE WHEN f.lacks_views THEN 'missing:views' END,
      CASE WHEN f.order_id IS NULL THEN 'nn:order_id' END,
      CASE WHEN NOT f.lacks_views AND NOT COALESCE(f.views >= 0 AND f.views <= 10000, FALSE) THEN 'range:views' END,
      CASE WHEN NOT COALESCE(f.amount >= 0 AND f.amount <= 1000000, FALSE) THEN 'range:amount' END,
      CASE WHEN NOT COALESCE(f.source IN ('Google','Microsoft','Facebook','Apple','Amazon'), FALSE)
           THEN 'isin:source' END,
      CASE WHEN c.n > 1 THEN 'uniq:order_id' END
    ) AS _failed_rules
  FROM csv_feed f JOIN csv_counts c
    ON f._file = c._file AND f.order_id IS NOT DISTINCT FROM c.order_id
)"""

CSV_COLUMNS = ("_file, order_id, amount, views, source, src_orderkey, src_linenumber, src_partkey, src_suppkey, "
               "src_extendedprice, src_shipdate, src_quantity, src_discount, src_tax")


def _lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    return repr(v)


def _violation(r: Rule) -> str:
    c = r.column
    if r.kind == NOT_NULL:
        return f"{c} IS NULL"
    if r.kind in (BETWEEN, LENGTH_BETWEEN):
        s = f"LENGTH({c})" if r.kind == LENGTH_BETWEEN else c
        parts = []
        if r.min_value is not None:
            parts.append(f"{s} < {_lit(r.min_value)}")
        if r.max_value is not None:
            parts.append(f"{s} > {_lit(r.max_value)}")
        return "(" + " OR ".join(parts) + ")"
    if r.kind == IN_SET:
        return f"{c} NOT IN ({', '.join(_lit(v) for v in r.values)})"
    if r.kind == EXPRESSION:
        return f"NOT ({re.sub(r'to_date[(](.*?)[)]', r'CAST(\1 AS DATE)', r.expr)})"
    raise ValueError(r.kind)


BAD_PREDICATE = "(" + " OR ".join(_violation(r) for r in EXPORT_BAD_CONDITIONS) + ")"


def _success(considered: str, unexpected: str, mostly: float) -> str:
    return (f"CASE WHEN {considered} = 0 THEN TRUE ELSE "
            f"CAST({considered} - {unexpected} AS DOUBLE) / CAST({considered} AS DOUBLE) >= CAST({float(mostly)!r} AS DOUBLE) END")


def suite_sql(rules: list[Rule], source: str, by: str | None = None, present: dict | None = None) -> str:
    """UNION ALL of one SELECT per rule over ``source`` (a CTE or table),
    optionally per group ``by``; ``present`` maps a column to the SQL
    condition under which it exists (rules are skipped where it does not)."""
    present = present or {}
    lead = f"{by}, " if by else ""
    group = f" GROUP BY {by}" if by else ""
    selects = []
    for i, r in enumerate(rules):
        head = f"SELECT {lead}CAST({i} AS INTEGER) AS rule_index, '{r.kind}' AS expectation_type, "
        col = f"'{r.column}'" if r.column else "CAST(NULL AS VARCHAR)"
        head += f"{col} AS \"column\", "
        m = r.mostly
        mostly = f"CAST({float(m)!r} AS DOUBLE) AS mostly"
        where = f" WHERE {present[r.column]}" if r.column in present else ""
        if r.kind == NOT_NULL:
            body = (f"COUNT(*) AS element_count, COUNT(*) FILTER (WHERE {r.column} IS NULL) AS missing_count, "
                    f"COUNT(*) FILTER (WHERE {r.column} IS NULL) AS unexpected_count, "
                    f"CAST(NULL AS BIGINT) AS observed_value, {mostly}, "
                    f"{_success('COUNT(*)', f'COUNT(*) FILTER (WHERE {r.column} IS NULL)', m)} AS success "
                    f"FROM {source}{where}{group}")
        elif r.kind in (BETWEEN, LENGTH_BETWEEN, IN_SET):
            u = f"COUNT(*) FILTER (WHERE {r.column} IS NOT NULL AND COALESCE({_violation(r)}, FALSE))"
            nn = f"COUNT({r.column})"
            body = (f"COUNT(*) AS element_count, COUNT(*) - {nn} AS missing_count, {u} AS unexpected_count, "
                    f"CAST(NULL AS BIGINT) AS observed_value, {mostly}, "
                    f"{_success(nn, u, m)} AS success FROM {source}{where}{group}")
        elif r.kind == ROW_COUNT:
            conds = ["TRUE"]
            if r.min_value is not None:
                conds.append(f"COUNT(*) >= {r.min_value}")
            if r.max_value is not None:
                conds.append(f"COUNT(*) <= {r.max_value}")
            body = ("COUNT(*) AS element_count, CAST(NULL AS BIGINT) AS missing_count, "
                    "CAST(NULL AS BIGINT) AS unexpected_count, COUNT(*) AS observed_value, "
                    f"{mostly}, ({' AND '.join(conds)}) AS success FROM {source}{group}")
        elif r.kind == UNIQUE:
            c = r.column
            inner = f"(SELECT {lead}{c} AS v, COUNT(*) AS n FROM {source}{where} GROUP BY {lead}{c})"
            rows = "COALESCE(SUM(n), 0)"
            miss = "COALESCE(SUM(CASE WHEN v IS NULL THEN n END), 0)"
            u = "COALESCE(SUM(CASE WHEN v IS NOT NULL AND n > 1 THEN n END), 0)"
            body = (f"CAST({rows} AS BIGINT) AS element_count, CAST({miss} AS BIGINT) AS missing_count, "
                    f"CAST({u} AS BIGINT) AS unexpected_count, CAST(NULL AS BIGINT) AS observed_value, "
                    f"{mostly}, {_success(f'({rows} - {miss})', u, m)} AS success FROM {inner} g{group}")
        elif r.kind == EXISTS:
            ok = f"BOOL_AND({present[r.column]})" if r.column in present else "TRUE"
            body = ("CAST(NULL AS BIGINT) AS element_count, CAST(NULL AS BIGINT) AS missing_count, "
                    "CAST(NULL AS BIGINT) AS unexpected_count, CAST(NULL AS BIGINT) AS observed_value, "
                    f"{mostly}, {ok} AS success FROM {source}{group}")
        elif r.kind == EXPRESSION:
            raise ValueError("not used in SQL twins")
        else:
            raise ValueError(r.kind)
        selects.append(head + body)
    return "\nUNION ALL\n".join(selects)

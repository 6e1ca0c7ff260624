"""Derived cross-check columns and small column helpers (pure Column code)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN_END_DATE = "9999-12-31"


def amt_diff(net="net_amount", order="order_amount", tax="tax_amount", discount="discount_amount") -> Column:
    """|net - (order + tax - discount)|, same operand order as the SQL so the
    doubles agree bit for bit."""
    return F.abs(F.col(net) - (F.col(order) + F.col(tax) - F.col(discount)))


def ts_date_mismatch_flag(ts="order_timestamp", day="order_date") -> Column:
    """1 when the timestamp's date differs from the date column, else 0
    (a NULL comparison gives 0, as a CASE does)."""
    return F.when(F.to_date(F.col(ts)) != F.col(day), F.lit(1)).otherwise(F.lit(0))


def discount_excess(order="order_amount", tax="tax_amount", discount="discount_amount") -> Column:
    """GREATEST(discount - (order + tax), 0) with SQL NULL semantics.

    Spark's ``greatest`` skips NULLs (it would give 0); the SQL form gives
    NULL when the difference is NULL, so the NULL is kept explicitly.
    """
    d = F.col(discount) - (F.col(order) + F.col(tax))
    return F.when(d.isNotNull(), F.greatest(d, F.lit(0.0)))


def discount_excess_flag(order="order_amount", tax="tax_amount", discount="discount_amount") -> Column:
    return F.when(F.col(discount) > (F.col(order) + F.col(tax)), F.lit(1)).otherwise(F.lit(0))


def with_cross_checks(df: DataFrame, **names) -> DataFrame:
    """All columns plus amt_diff, ts_date_mismatch_flag, discount_excess and
    discount_excess_flag.  ``names`` maps the logical amount/date names
    (net, order, tax, discount, ts, day) to the frame's columns."""
    amounts = {k: names[k] for k in ("net", "order", "tax", "discount") if k in names}
    money = {k: v for k, v in amounts.items() if k != "net"}
    dates = {k: names[k] for k in ("ts", "day") if k in names}
    return df.select(
        "*",
        amt_diff(**amounts).alias("amt_diff"),
        ts_date_mismatch_flag(**dates).alias("ts_date_mismatch_flag"),
        discount_excess(**money).alias("discount_excess"),
        discount_excess_flag(**money).alias("discount_excess_flag"),
    )

"""Rule compile modes, the export split and failure tags."""

import datetime as dt

from pyspark.sql import functions as F

from slicewarden.functions import suites
from slicewarden.functions.rules import Rule
from slicewarden.operators import split as split_ops

ORDERS_DDL = ("order_id long, customer_id long, order_date date, order_timestamp timestamp, order_status string, "
              "payment_method string, currency string, order_amount double, tax_amount double, "
              "discount_amount double, net_amount double, is_first_order boolean, region string, "
              "category string, item_count long")

D = dt.date(2024, 1, 15)
TS = dt.datetime(2024, 1, 15, 10, 0, 0)


def good_row(**over):
    row = dict(order_id=1, customer_id=1000, order_date=D, order_timestamp=TS, order_status="NEW",
               payment_method="UPI", currency="INR", order_amount=100.0, tax_amount=10.0, discount_amount=5.0,
               net_amount=105.0, is_first_order=True, region="IN-N", category="Books", item_count=1)
    row.update(over)
    return row


# One row per condition of the bad predicate, plus undecided NULL variants.
DEFECTS = [
    dict(order_id=None), dict(customer_id=None), dict(order_date=None), dict(order_timestamp=None),
    dict(order_amount=None), dict(net_amount=None), dict(order_amount=-1.0, net_amount=-116.0),
    dict(tax_amount=-1.0, net_amount=94.0), dict(discount_amount=-1.0, net_amount=111.0),
    dict(net_amount=-1.0), dict(item_count=0),
    dict(order_status="LOST"), dict(payment_method="Cash"), dict(region="EU"), dict(currency="IN"),
    dict(currency="INRR"), dict(net_amount=106.0), dict(order_timestamp=dt.datetime(2024, 1, 16, 1, 0)),
]
UNDECIDED = [dict(tax_amount=None), dict(order_status=None), dict(region=None)]


def frame(spark, rows):
    cols = [c.split()[0] for c in ORDERS_DDL.split(", ")]
    return spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], ORDERS_DDL)


def test_each_defect_is_bad_and_nulls_are_undecided(spark):
    rows = [good_row(order_id=100 + i, **d) if "order_id" not in d else good_row(**d) for i, d in enumerate(DEFECTS)]
    rows += [good_row(order_id=500 + i, **d) for i, d in enumerate(UNDECIDED)]
    rows += [good_row(order_id=900)]
    df = frame(spark, rows)
    s = split_ops.split_rows(df, suites.EXPORT_BAD_CONDITIONS)
    assert s.bad.count() == len(DEFECTS)
    assert sorted(r.order_id for r in s.undecided.collect()) == [500, 501, 502]
    assert [r.order_id for r in s.good.collect()] == [900]
    c = s.counts.first()
    assert c.rows_total == c.rows_good + c.rows_bad + c.rows_undecided == len(rows)


def test_filter_switch_passes_everything(spark):
    df = frame(spark, [good_row(order_id=None), good_row()])
    s = split_ops.split_rows(df, suites.EXPORT_BAD_CONDITIONS, filter_bad=False)
    assert s.good.count() == 2 and s.bad.count() == 0


def test_three_null_readings(spark):
    df = spark.createDataFrame([(None,), (5.0,), (-1.0,)], "x double")
    r = Rule.between("x", min_value=0)
    out = df.select(r.violation().alias("v"), r.strict_failure().alias("s"), r.counted_violation().alias("c"))
    got = [tuple(x) for x in out.collect()]
    assert got == [(None, True, False), (False, False, False), (True, True, True)]


def test_failure_tags_order_and_skip(spark):
    df = spark.createDataFrame([(1, -1), (None, 5), (2, 5)], "a long, b long")
    tags = split_ops.failure_tags([("nn:a", F.col("a").isNull()), ("range:b", F.col("b") < 0)])
    assert [r[0] for r in df.select(tags).collect()] == ["range:b", "nn:a", ""]

"""Property tests: Spark expressions against plain-Python evaluations."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from slicewarden.functions import paths, suites
from slicewarden.operators.split import split_rows

from test_rules_split import ORDERS_DDL, frame

NUM = st.one_of(st.none(), st.sampled_from([-2.0, 0.0, 0.004, 1.0, 5.0, 100.0]))
ROW = st.fixed_dictionaries({
    "order_id": st.one_of(st.none(), st.integers(1, 5)),
    "customer_id": st.one_of(st.none(), st.just(7)),
    "order_date": st.one_of(st.none(), st.sampled_from([dt.date(2024, 1, 1), dt.date(2024, 1, 2)])),
    "order_timestamp": st.one_of(st.none(), st.sampled_from([dt.datetime(2024, 1, 1, 5), dt.datetime(2024, 1, 2, 23)])),
    "order_status": st.one_of(st.none(), st.sampled_from(["NEW", "LOST"])),
    "payment_method": st.one_of(st.none(), st.sampled_from(["UPI", "Cash"])),
    "currency": st.one_of(st.none(), st.sampled_from(["INR", "IN", "INRR", "USD"])),
    "order_amount": NUM, "tax_amount": NUM, "discount_amount": NUM, "net_amount": NUM,
    "is_first_order": st.booleans(),
    "region": st.one_of(st.none(), st.sampled_from(["IN-N", "EU"])),
    "category": st.just("Books"),
    "item_count": st.one_of(st.none(), st.integers(0, 2)),
})


def _or(vals):
    """SQL OR over True / False / None."""
    if any(v is True for v in vals):
        return True
    return None if any(v is None for v in vals) else False


def _cmp(a, op, b):
    return None if a is None or b is None else op(a, b)


def py_bad(r):
    lt = lambda a, b: a < b
    ne = lambda a, b: a != b
    notin = lambda v, s: None if v is None else v not in s
    bal = None
    if None not in (r["net_amount"], r["order_amount"], r["tax_amount"], r["discount_amount"]):
        bal = abs(r["net_amount"] - (r["order_amount"] + r["tax_amount"] - r["discount_amount"])) > 0.01
    cur_len = None if r["currency"] is None else (len(r["currency"]) < 3 or len(r["currency"]) > 4)
    ts_day = None if r["order_timestamp"] is None else r["order_timestamp"].date()
    return _or([
        r["order_id"] is None, r["customer_id"] is None, r["order_date"] is None, r["order_timestamp"] is None,
        r["order_amount"] is None, r["net_amount"] is None,
        _cmp(r["order_amount"], lt, 0), _cmp(r["tax_amount"], lt, 0), _cmp(r["discount_amount"], lt, 0),
        _cmp(r["net_amount"], lt, 0), _cmp(r["item_count"], lt, 1),
        notin(r["order_status"], suites.ORDER_STATUS_VALUES), notin(r["payment_method"], suites.PAYMENT_METHOD_VALUES),
        notin(r["region"], suites.REGION_VALUES), cur_len, notin(r["currency"], suites.CURRENCY_VALUES),
        bal, _cmp(ts_day, ne, r["order_date"]),
    ])


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(ROW, min_size=1, max_size=40))
def test_split_matches_python_three_valued_logic(spark, rows):
    rows = [dict(r, order_id=(None if r["order_id"] is None else i)) for i, r in enumerate(rows)]
    s = split_rows(frame(spark, rows), suites.EXPORT_BAD_CONDITIONS)
    want = {True: set(), False: set(), None: set()}
    for i, r in enumerate(rows):
        want[py_bad(r)].add(repr(sorted((k, str(v)) for k, v in r.items())))
    cols = [c.split()[0] for c in ORDERS_DDL.split(", ")]

    def keyset(df):
        return {repr(sorted((c, str(x[c])) for c in cols)) for x in df.collect()}
    assert keyset(s.bad) == want[True]
    assert keyset(s.good) == want[False]
    assert keyset(s.undecided) == want[None]


def py_fix(name):
    name = (name or "").strip(" ")
    if "/" not in name and "date=" in name and name.find("date=") > 0:
        i = name.find("date=")
        name = name[:i] + "/" + name[i:]
    name = name.replace("//", "/")
    return name if name.endswith("/") else name + "/"


def py_norm(s):
    ns, name = s.split(":", 1) if ":" in s else ("", s)
    return py_fix(name) if ns == "gcs" else name


PART = st.sampled_from(["a", "b", "date=2024-01-01", "DATE=2023-02-03", "x.y", "", "date=", "gcs"])
NAME = st.builds(lambda ns, parts, seps: ns + "".join(p + s for p, s in zip(parts, seps)),
                 st.sampled_from(["", "gcs:", "bigquery:", "s3:"]),
                 st.lists(PART, min_size=1, max_size=4), st.lists(st.sampled_from(["/", "//", ""]), min_size=4,
                                                                  max_size=4))


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(NAME, min_size=1, max_size=30))
def test_normalise_matches_python(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in df.select(paths.normalise(F.col("n"))).collect()]
    assert got == [py_norm(n) for n in names]

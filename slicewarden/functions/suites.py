"""Rule suites for the `orders` slice and the raw order CSV files.

The lists below are fixed values: rule kinds, columns, bounds, sets and
`mostly` shares that must equal the original pipeline's for equal results.
"""

from __future__ import annotations

from slicewarden.functions.rules import ROW_COUNT, Rule

# ---------------------------------------------------------------------------
# Fixed values (must match the original pipeline; keep in this order).
# ---------------------------------------------------------------------------
ORDER_STATUS_VALUES = ("NEW", "SHIPPED", "DELIVERED", "CANCELLED")
PAYMENT_METHOD_VALUES = ("Credit Card", "Wallet", "COD", "UPI")
REGION_VALUES = ("IN-N", "IN-S", "IN-E", "IN-W")
CURRENCY_VALUES = ("INR",)
CATEGORY_VALUES = ("Electronics", "Books", "Apparel", "Home", "Toys")
BALANCE_TOLERANCE = 0.01

# "basic" suite, 20 rules.
BASIC_SUITE = [
    Rule.not_null("order_id"),
    Rule.not_null("customer_id"),
    Rule.not_null("order_date"),
    Rule.not_null("order_timestamp"),
    Rule.not_null("order_amount"),
    Rule.not_null("net_amount"),
    Rule.unique("order_id"),
    Rule.between("order_amount", min_value=0, mostly=0.999),
    Rule.between("tax_amount", min_value=0, mostly=0.999),
    Rule.between("discount_amount", min_value=0, mostly=0.999),
    Rule.between("net_amount", min_value=0, mostly=0.999),
    Rule.between("item_count", min_value=1, mostly=0.999),
    Rule.in_set("order_status", ORDER_STATUS_VALUES, mostly=0.99),
    Rule.in_set("payment_method", PAYMENT_METHOD_VALUES, mostly=0.99),
    Rule.in_set("region", REGION_VALUES, mostly=0.99),
    Rule.length_between("currency", min_value=3, max_value=4),
    Rule.in_set("currency", CURRENCY_VALUES, mostly=1.0),
    Rule.row_count(min_value=0),
    Rule.between("amt_diff", min_value=0, max_value=0.05, mostly=0.999),
    Rule.in_set("ts_date_mismatch_flag", (0,), mostly=0.99),
]

# "cross" suite, 5 rules, on the derived cross-check columns.
CROSS_SUITE = [
    Rule.between("amt_diff", min_value=0, max_value=0.01, mostly=1.0),
    Rule.in_set("ts_date_mismatch_flag", (0,), mostly=1.0),
    Rule.row_count(min_value=1),
    Rule.between("discount_excess", min_value=0, max_value=0, mostly=1.0),
    Rule.in_set("discount_excess_flag", (0,), mostly=1.0),
]

# Export split: a row is bad when any of these 18 conditions is TRUE.
EXPORT_BAD_CONDITIONS = [
    Rule.not_null("order_id"),
    Rule.not_null("customer_id"),
    Rule.not_null("order_date"),
    Rule.not_null("order_timestamp"),
    Rule.not_null("order_amount"),
    Rule.not_null("net_amount"),
    Rule.between("order_amount", min_value=0),
    Rule.between("tax_amount", min_value=0),
    Rule.between("discount_amount", min_value=0),
    Rule.between("net_amount", min_value=0),
    Rule.between("item_count", min_value=1),
    Rule.in_set("order_status", ORDER_STATUS_VALUES),
    Rule.in_set("payment_method", PAYMENT_METHOD_VALUES),
    Rule.in_set("region", REGION_VALUES),
    Rule.length_between("currency", min_value=3, max_value=4),
    Rule.in_set("currency", CURRENCY_VALUES),
    Rule.expression(
        "balance",
        f"abs(net_amount - (order_amount + tax_amount - discount_amount)) <= {BALANCE_TOLERANCE}",
    ),
    Rule.expression("date_match", "to_date(order_timestamp) = order_date"),
]

# Raw CSV rules.
CSV_REQUIRED_COLUMNS = ("order_id", "amount", "views", "source")
CSV_RANGES = (("views", 0, 10_000), ("amount", 0, 1_000_000))
CSV_UNIQUE_WITHIN_FILE = ("order_id",)
CSV_SOURCE_VALUES = ("Google", "Microsoft", "Facebook", "Apple", "Amazon")
CSV_SAMPLE_BAD_MAX = 10_000
CSV_TARGET_PART_ROWS = 300_000

# Per-file CSV suite: required columns exist, order_id present and unique,
# ranges inclusive, source in its set (rules on absent columns are skipped).
CSV_SUITE = ([Rule.exists(c) for c in CSV_REQUIRED_COLUMNS]
             + [Rule.not_null("order_id"), Rule.unique("order_id")]
             + [Rule.between(c, lo, hi) for c, lo, hi in CSV_RANGES]
             + [Rule.in_set("source", CSV_SOURCE_VALUES)])

SUITES = {"basic": BASIC_SUITE, "cross": CROSS_SUITE}
SUITE_NAMES = {"basic": "orders_suite", "cross": "orders_cross_suite"}
# ---------------------------------------------------------------------------


def with_row_limit(rules: list[Rule], max_rows: int | None) -> list[Rule]:
    """``rules`` whose row counts may not exceed ``max_rows`` (None: no upper
    bound, as in the lists above; a fixed bound would fail every larger slice)."""
    return [Rule.row_count(r.min_value, max_rows) if r.kind == ROW_COUNT else r for r in rules]


def csv_rules() -> list[tuple[str, Rule]]:
    """The raw-CSV row rules with their tag keys, in tag order (after the
    ``missing:*`` tags and before ``uniq:*``)."""
    out = [("nn:order_id", Rule.not_null("order_id"))]
    for col, lo, hi in CSV_RANGES:
        out.append((f"range:{col}", Rule.between(col, lo, hi)))
    out.append(("isin:source", Rule.in_set("source", CSV_SOURCE_VALUES)))
    return out

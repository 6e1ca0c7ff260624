"""Seeded synthetic orders for a run date (SRC-10).

Rows are derived on the executors from MD5 digests of a row id and a seed, so
any part of the data can be regenerated independently (no driver loop, no
shared random state), and in whole numbers (cents, hundredths of a per cent), so
that any engine gets the same values.  Value distributions follow the original
generator; the exact values differ (it drew from one sequential RNG).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slicewarden.functions.suites import CATEGORY_VALUES, ORDER_STATUS_VALUES, PAYMENT_METHOD_VALUES, REGION_VALUES

# Fixed values of the generator.
SEED = 42
EST_ROW_BYTES = 200
CHUNK_ROWS = 500_000
DISCOUNT_PERCENTS = (0, 5, 10, 20, 30)
AMOUNT_CENTS = (10_000, 100_000)
TAX_BASIS_POINTS = (500, 1800)
CUSTOMER_RANGE = (1000, 9999)
ITEM_RANGE = (1, 5)


def digest(key: Column, seed: int) -> Column:
    """96 hex digits drawn from a key and the seed: twelve draws of eight."""
    return F.concat(*[F.md5(F.concat_ws("|", key.cast("string"), F.lit(str(k)), F.lit(str(seed))).cast("binary"))
                      for k in range(3)])


def _below(draw: int, n: int) -> Column:
    """The row's draw (0 to 11) as a whole number from 0 to n - 1."""
    value = F.conv(F.substring("__digest", 8 * draw + 1, 8), 16, 10).cast("long")
    return F.shiftright(value * F.lit(n), 32)


def _between(draw: int, bounds: tuple[int, int]) -> Column:
    return F.lit(bounds[0]) + _below(draw, bounds[1] - bounds[0] + 1)


def _pick(values, draw: int) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (_below(draw, len(values)) + 1).cast("int"))


def orders_from_ids(ids: DataFrame, run_date_col: Column, id_col: str = "order_id", seed: int = SEED) -> DataFrame:
    """Synthetic order rows for each ``id_col`` on the given date column."""
    drawn = ids.select(F.col(id_col).cast("long").alias("order_id"), F.to_date(run_date_col).alias("order_date"),
                       digest(F.col(id_col).cast("long"), seed).alias("__digest"))
    midnight = F.unix_timestamp(F.col("order_date").cast("timestamp"))
    drawn = drawn.select("*", _between(1, AMOUNT_CENTS).alias("__amount"))
    drawn = drawn.select("*", ((F.col("__amount") * _between(2, TAX_BASIS_POINTS) + 5000) / 10_000)
                         .cast("long").alias("__tax"))
    drawn = drawn.select("*", (((F.col("__amount") + F.col("__tax")) * _pick(DISCOUNT_PERCENTS, 3) + 50) / 100)
                         .cast("long").alias("__discount"))
    return drawn.select(
        "order_id",
        _between(4, CUSTOMER_RANGE).cast("long").alias("customer_id"),
        "order_date",
        F.timestamp_seconds(midnight + _below(0, 86_400)).cast("timestamp_ntz").alias("order_timestamp"),
        _pick(ORDER_STATUS_VALUES, 5).alias("order_status"),
        _pick(PAYMENT_METHOD_VALUES, 6).alias("payment_method"),
        F.lit("INR").alias("currency"),
        (F.col("__amount") / 100).alias("order_amount"), (F.col("__tax") / 100).alias("tax_amount"),
        (F.col("__discount") / 100).alias("discount_amount"),
        ((F.col("__amount") + F.col("__tax") - F.col("__discount")) / 100).alias("net_amount"),
        (_below(7, 2) == 0).alias("is_first_order"),
        _pick(REGION_VALUES, 8).alias("region"),
        _pick(CATEGORY_VALUES, 9).alias("category"),
        _between(10, ITEM_RANGE).cast("long").alias("item_count"),
    )


def row_count_for(target_bytes: int | None = None, rows: int | None = None) -> int:
    """Rows to generate: ``rows`` if given, else max(chunk, bytes // 200)."""
    if rows is not None:
        return rows
    return max(CHUNK_ROWS, (target_bytes or 0) // EST_ROW_BYTES)


def generate_orders(spark: SparkSession, run_date: str, rows: int | None = None, target_bytes: int | None = None,
                    seed: int = SEED, partitions: int | None = None) -> DataFrame:
    n = row_count_for(target_bytes, rows)
    ids = spark.range(0, n, 1, partitions).withColumnRenamed("id", "order_id")
    return orders_from_ids(ids, F.lit(run_date), seed=seed)

"""Projections of the driver's tables onto the pipeline's data model.

The pipeline works on daily ``orders`` slices, raw order CSV feeds, customer
snapshots and lineage graphs.  The driver's tables are TPC-H-like, so each
operator is exercised on a deterministic projection of them.  Each projection
is a pure DataFrame expression over a whole table, with a SQL twin in
:mod:`slicewarden.plans.sqltext` that uses the same operand order, so the
doubles agree bit for bit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slicewarden.functions.joins import broadcast_or_merge
from slicewarden.session import stored

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------------------
# lineitem → orders-shaped rows (one per line item, defects included)
# ---------------------------------------------------------------------------
def orders_like(lineitem: DataFrame) -> DataFrame:
    """Reference ``orders`` schema over lineitem.

    Defects arise from the data itself: order 0 has NULL ids; quantity 2 has a
    negative amount; quantity 1 has item_count 0 and an unbalanced net; tax 0
    gives a NULL tax (rows can then be undecided); quantity 49/50 give an
    unknown or NULL status; line 7 a foreign payment method and a timestamp a
    day after the date; discount 0 / 0.10 a short / unknown currency; supplier
    keys divisible by 25 have no region.
    """
    ep, disc, tax, qty, line = (F.col(c) for c in ("l_extendedprice", "l_discount", "l_tax", "l_quantity",
                                                      "l_linenumber"))
    order_amount = F.when(qty == 2, -ep).otherwise(ep)
    tax_amount = F.when(tax != 0.0, tax) * ep
    discount_amount = disc * ep
    net_amount = ep + tax * ep - disc * ep + F.when(qty == 1, F.lit(1.0)).otherwise(F.lit(0.0))
    status = (F.when(qty == 50, F.lit(None).cast("string"))
              .when(qty == 49, F.lit("LOST"))
              .when(F.col("l_returnflag") == "N", F.lit("NEW"))
              .when(F.col("l_returnflag") == "A", F.lit("SHIPPED"))
              .when(F.col("l_linestatus") == "F", F.lit("DELIVERED"))
              .otherwise(F.lit("CANCELLED")))
    payment = (F.when(line == 1, "Credit Card").when(line == 2, "Wallet").when(line == 3, "COD")
               .when(line == 4, "UPI").when(line == 5, "Wallet").when(line == 6, "Credit Card")
               .otherwise("Cheque"))
    sk = F.col("l_suppkey")
    region = (F.when(sk % 25 == 0, F.lit(None).cast("string")).when(sk % 4 == 0, "IN-N")
              .when(sk % 4 == 1, "IN-S").when(sk % 4 == 2, "IN-E").otherwise("IN-W"))
    currency = F.when(disc == 0.0, "IN").when(disc == 0.1, "INRR").otherwise("INR")
    ts = F.col("l_shipdate").cast("timestamp_ntz")
    order_ts = F.when(line == 7, ts + F.expr("INTERVAL 1 DAY")).otherwise(ts)
    ok = F.col("l_orderkey")
    return lineitem.select(
        F.when(ok != 0, ok).alias("order_id"),
        F.when(ok != 0, F.col("l_partkey")).alias("customer_id"),
        F.to_date(F.col("l_shipdate")).alias("order_date"),
        order_ts.alias("order_timestamp"),
        status.alias("order_status"),
        payment.alias("payment_method"),
        currency.alias("currency"),
        order_amount.alias("order_amount"),
        tax_amount.alias("tax_amount"),
        discount_amount.alias("discount_amount"),
        net_amount.alias("net_amount"),
        (line == 1).alias("is_first_order"),
        region.alias("region"),
        F.concat(F.lit("cat-"), F.col("l_linestatus")).alias("category"),
        (qty.cast("long") - 1).alias("item_count"),
        # Total order of the source rows (stands in for file position).
        F.col("l_orderkey").alias("src_orderkey"),
        F.col("l_linenumber").alias("src_linenumber"),
        F.col("l_partkey").alias("src_partkey"),
        F.col("l_suppkey").alias("src_suppkey"),
        F.col("l_extendedprice").alias("src_price"),
        F.col("l_shipdate").alias("src_shipdate"),
        F.col("l_quantity").alias("src_quantity"),
        F.col("l_discount").alias("src_discount"),
        F.col("l_tax").alias("src_tax"),
        F.col("l_returnflag").alias("src_returnflag"),
        F.col("l_linestatus").alias("src_linestatus"),
    )


SOURCE_ORDER = ["src_orderkey", "src_linenumber", "src_partkey", "src_suppkey", "src_price", "src_shipdate",
                "src_quantity", "src_discount", "src_tax", "src_returnflag", "src_linestatus"]


# ---------------------------------------------------------------------------
# lineitem → raw order CSV feed (one "file" per return flag / line status)
# ---------------------------------------------------------------------------
def csv_feed(lineitem: DataFrame) -> DataFrame:
    """Parsed raw-CSV rows with the file they came from.

    File ``ingest/part-RF.csv`` lacks the ``views`` column (all its rows
    fail ``missing:views``); ``_missing`` lists a file's absent required
    columns, as the header check of the CSV reader reports them.
    """
    file = F.concat(F.lit("ingest/part-"), F.col("l_returnflag"), F.col("l_linestatus"), F.lit(".csv"))
    lacks_views = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
    line = F.col("l_linenumber")
    source = (F.when(line == 1, "Google").when(line == 2, "Microsoft").when(line == 3, "Facebook")
              .when(line == 4, "Apple").when(line == 5, "Amazon").when(line == 6, "Yahoo"))
    amount = F.col("l_extendedprice") * F.when(F.col("l_discount") == 0.1, F.lit(10.0)).otherwise(F.lit(1.0))
    views = F.when(~lacks_views, (F.col("l_quantity") - 1.0) * 210.0)
    order_id = F.when(F.col("l_partkey") != 0, F.col("l_orderkey") * 10 + line)
    return lineitem.select(
        file.alias("_file"),
        order_id.alias("order_id"),
        amount.alias("amount"),
        views.alias("views"),
        source.alias("source"),
        F.when(lacks_views, F.array(F.lit("views"))).otherwise(F.array().cast("array<string>")).alias("_missing"),
        *[F.col(c).alias(f"src_{c[2:]}") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                                    "l_extendedprice", "l_shipdate", "l_quantity", "l_discount",
                                                    "l_tax")],
    )


CSV_SOURCE_ORDER = ["src_orderkey", "src_linenumber", "src_partkey", "src_suppkey", "src_extendedprice",
                    "src_shipdate", "src_quantity", "src_discount", "src_tax"]


# ---------------------------------------------------------------------------
# events → customer slices (key user_id, attribute event_type, day)
# ---------------------------------------------------------------------------
def customer_days(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("user_id").alias("customer_id"),
        F.col("event_type").alias("region"),
        F.to_date(F.col("ts")).alias("day"),
    )


# ---------------------------------------------------------------------------
# lineitem + supplier + part → lineage graph, config tables, inventory
# ---------------------------------------------------------------------------
def lineage_graph(lineitem: DataFrame, supplier: DataFrame, part: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Jobs are suppliers, datasets are part brands per supplier nation.

    A supplier job reads ``bigquery:proj.bronze.part_<partkey>`` and writes
    the (brand, nation) output: an object-store folder for small parts
    (written without slashes for sizes under 5, to exercise the path fix), a
    table otherwise.  Suppliers of nation 0 are system (``bootstrap.``) jobs.
    """
    # Names are put together where they are used; what is shuffled and stored are keys.
    def numbered(df: DataFrame, keys: list[str], first: str) -> DataFrame:
        """Distinct rows, of which one a key is its first."""
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*df.columns))
        return stored(df.distinct().withColumn(first, rank == 1), "lookup")

    system = F.coalesce(F.col("s_nationkey") == 0, F.lit(False)).alias("system")
    sup = numbered(supplier.where(F.col("s_suppkey").isNotNull()).select("s_suppkey", "s_nationkey", system),
                   ["s_suppkey", "system"], "s_first")
    kind = F.when(F.col("p_size") < 5, 0).when(F.col("p_size") < 25, 1).otherwise(2)
    prt = numbered(part.where(F.col("p_partkey").isNotNull())
                   .select("p_partkey", F.regexp_replace(F.lower(F.col("p_brand")), "#", "_").alias("brand"),
                           kind.alias("kind")), ["p_partkey"], "p_first")
    # Stored once: reads and writes below both come from it.  Pairs of keys are distinct, and meet each key's first
    # row once.  Parts may be many while their file is small, so how they are joined follows from their number.
    met = (lineitem.select("l_suppkey", "l_partkey").distinct()
           .join(broadcast_or_merge(sup), F.col("l_suppkey") == F.col("s_suppkey"))
           .join(broadcast_or_merge(prt), F.col("l_partkey") == F.col("p_partkey"))
           .select("l_suppkey", "system", "l_partkey", "s_nationkey", "brand", "kind",
                   (F.col("s_first") & F.col("p_first")).alias("first")))
    met = stored(met, "met")
    reads = met.where("first").select("l_suppkey", "system", "l_partkey")
    writes = stored(met.select("l_suppkey", "system", "s_nationkey", "brand", "kind").distinct(), "writes")
    job = F.concat(F.when(F.col("system"), F.lit("bootstrap.")).otherwise(F.lit("etl.")), F.lit("supplier_"),
                   F.col("l_suppkey").cast("string"))
    table_in = F.concat(F.lit("bigquery:proj.bronze.part_"), F.col("l_partkey").cast("string"))
    made = F.concat(F.col("brand"), F.lit("_n"), F.col("s_nationkey").cast("string"))
    out = (F.when(F.col("kind") == 0, F.concat(F.lit("gcs:lake"), made, F.lit("date=1995-01-01")))
           .when(F.col("kind") == 1, F.concat(F.lit("gcs:lake/silver//"), made, F.lit("/date=1995-01-01")))
           .otherwise(F.concat(F.lit("bigquery:proj.silver."), made)))

    def node(df: DataFrame, prefix: str, kind: str, name) -> DataFrame:
        return df.select(F.concat(F.lit(prefix), name).alias("id"), F.lit(kind).alias("type"), name.alias("name"))

    # Ids of the three sorts differ, and so do edges into and out of a job; keys
    # make names one to one, but for outputs without a brand or nation.
    outs = writes.select("brand", "s_nationkey", "kind").distinct()
    nodes = (node(reads.select("l_suppkey", "system").distinct(), "JOB:ns:", "JOB", job)
             .unionByName(node(reads.select("l_partkey").distinct(), "DATASET:", "DATASET", table_in))
             .unionByName(node(outs, "DATASET:", "DATASET", out).distinct()))
    job_id, in_id, out_id = (F.concat(F.lit("JOB:ns:"), job), F.concat(F.lit("DATASET:"), table_in),
                             F.concat(F.lit("DATASET:"), out))
    edges = (reads.select(in_id.alias("source"), job_id.alias("target"))
             .unionByName(writes.select(job_id.alias("source"), out_id.alias("target")).distinct()))
    return nodes, edges


def cadence_table(supplier: DataFrame) -> DataFrame:
    sk = F.col("s_suppkey")
    return supplier.select(
        F.concat(F.lit("etl.supplier_"), sk.cast("string")).alias("job_name"),
        F.lit("daily").alias("cadence"),
        F.when(F.col("s_acctbal") < 0, F.lit(None).cast("string"))
        .when(sk % 3 == 0, F.lit("  ship_date "))
        .otherwise(F.lit("_ingestion_date")).alias("expected_partition_field"),
        F.concat(F.lit("owner_"), F.col("s_nationkey").cast("string")).alias("owner"),
        (F.col("s_nationkey") % 5 != 1).alias("active"),
    )


def task_map_table(supplier: DataFrame) -> DataFrame:
    sk = F.col("s_suppkey")
    return supplier.where(F.col("s_nationkey") % 4 != 3).select(
        F.concat(F.lit("etl.supplier_"), sk.cast("string")).alias("job_name"),
        F.when(F.col("s_nationkey") % 4 != 2, F.concat(F.lit("dag_nation_"), F.col("s_nationkey").cast("string")))
        .alias("dag_id"),
        F.when(sk % 2 == 0, F.concat(F.lit("load_"), sk.cast("string"))).alias("task_id"),
        F.when(sk % 7 == 0, F.lit("hand written")).alias("notes"),
    )


def partition_inventory(lineitem: DataFrame, part: DataFrame, supplier: DataFrame) -> DataFrame:
    """Which (brand, nation) outputs hold which ship dates.

    Folders (FILES) for small parts; tables for the rest, NATIVE
    (date-partitioned) for even brand numbers and UNPARTITIONED for odd ones.
    Dates come from the ship dates of the line items, so holes are natural.
    """
    # What follows from a part alone is worked out once a part, not once a line.
    brand = F.regexp_replace(F.lower(F.col("p_brand")), "#", "_")
    native = F.regexp_extract(F.col("p_brand"), r"#(\d+)", 1).cast("int") % 2 == 0
    j = (lineitem.select("l_partkey", "l_suppkey", "l_shipdate")
         .join(part.select("p_partkey", "p_size", brand.alias("brand"), native.alias("native")),
               F.col("l_partkey") == F.col("p_partkey"))
         .join(supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey")))
    brand = F.concat(F.col("brand"), F.lit("_n"), F.col("s_nationkey").cast("string"))
    day = F.to_date(F.col("l_shipdate"))
    size = F.col("p_size")
    folder = F.concat(F.when(size < 5, F.lit("lake")).otherwise(F.lit("lake/silver/")), brand,
                      F.lit("/date="), day.cast("string"), F.lit("/"))
    dataset = F.when(size < 25, folder).otherwise(F.concat(F.lit("proj.silver."), brand))
    native = F.col("native")
    kind = F.when(size < 25, F.lit("FILES")).when(native, F.lit("NATIVE")).otherwise(F.lit("UNPARTITIONED"))
    return j.select(dataset.alias("dataset"), kind.alias("kind"),
                    F.when((size < 25) | native, day).alias("partition_date")).distinct()


# ---------------------------------------------------------------------------
# events → object inventory (landing and publish folders) and run results
# ---------------------------------------------------------------------------
def object_inventory(events: DataFrame) -> DataFrame:
    """Objects under ``landing/date=<day>/``, one per event.  Per-day
    properties (day of month) decide the layout, so every gate branch occurs
    at any scale: on days ≡ 1 (mod 4) errors are ``_SUCCESS`` markers; on days
    ≡ 1 or 2 (mod 4) signups are ``_MANIFEST.json``; on days divisible by 7
    the data files are CSV; otherwise purchases are ``.PARQUET``, clicks
    ``.json`` and the rest ``.parquet``."""
    day = F.to_date(F.col("ts"))
    dom = F.dayofmonth(F.col("ts"))
    part = F.concat(F.lit("part-"), F.col("event_id").cast("string"))
    leaf = (F.when((F.col("event_type") == "error") & (dom % 4 == 1), F.lit("_SUCCESS"))
            .when((F.col("event_type") == "signup") & (dom % 4).isin(1, 2), F.lit("_MANIFEST.json"))
            .when(dom % 7 == 0, F.concat(part, F.lit(".csv")))
            .when(F.col("event_type") == "purchase", F.concat(part, F.lit(".PARQUET")))
            .when(F.col("event_type") == "click", F.concat(part, F.lit(".json")))
            .otherwise(F.concat(part, F.lit(".parquet"))))
    prefix = F.concat(F.lit("landing/date="), day.cast("string"), F.lit("/"))
    return events.select(prefix.alias("prefix"), F.concat(prefix, leaf).alias("name"),
                         F.col("ts").cast("timestamp_ntz").alias("updated"), day.alias("ds"))


def expected_folders(events: DataFrame) -> DataFrame:
    """Landing folders from the first day to two days after the last, which
    hold no objects."""
    first, last = F.min(F.to_date("ts")), F.date_add(F.max(F.to_date("ts")), 2)
    days = events.agg(first.alias("first"), last.alias("last")).where("first IS NOT NULL")
    days = days.select(F.explode(F.sequence("first", "last")).alias("ds"))
    return days.select(F.concat(F.lit("landing/date="), F.col("ds").cast("string"), F.lit("/")).alias("prefix"), "ds")


def suite_runs(events: DataFrame) -> DataFrame:
    """Per day and suite mode: did the suite pass (basic: at most a fifth of
    events are errors; cross: fails on days divisible by 3), how many
    files were staged (none on days divisible by 9), was the day already
    published (basic, days divisible by 5), were good rows exported."""
    day = F.to_date(F.col("ts"))
    n = F.count(F.lit(1))
    none_staged = F.dayofmonth("run_date") % 9 == 0
    basic = events.groupBy(day.alias("run_date")).agg(
        (F.count_if(F.col("event_type") == "error") * 5 <= n).alias("success"),
        F.count_if(F.col("event_type") == "purchase").alias("__staged"))
    basic = basic.select("run_date", "success",
                         F.when(none_staged, F.lit(0).cast("long")).otherwise(F.col("__staged")).alias("staged_files"),
                         (F.dayofmonth("run_date") % 5 == 0).alias("already_published"))
    cross = events.groupBy(day.alias("run_date")).agg(
        F.count_if(F.col("event_type") == "view").alias("__staged"))
    cross = cross.select("run_date", (F.dayofmonth("run_date") % 3 != 0).alias("success"),
                         F.when(none_staged, F.lit(0).cast("long")).otherwise(F.col("__staged")).alias("staged_files"),
                         F.lit(False).alias("already_published"))
    return (basic.withColumn("mode", F.lit("basic")).unionByName(cross.withColumn("mode", F.lit("cross")))
            .withColumn("good_exported", F.col("success") | (F.col("staged_files") >= 1)))

"""Sharding by a two-pass external shuffle, native.

Pass one scatters the records uniformly into memory-sized buckets by a seeded
hash; pass two puts each bucket into a fixed order, shuffles it with Spark's
``shuffle`` (Fisher-Yates) and writes it to the shared folder.  The buckets in
turn are one random order of all records; cut into equal stretches it gives
shards whose row counts differ by at most one (law ``rows``).

A bucket is sorted before it is shuffled and buckets stay in numeric order
within a task, so a task that runs again yields the same order.

Defined cases: null texts and ids are ordinary values; equal rows are spread
like others (their place in the scan is part of the hash); with fewer rows
than shards the last shards are empty; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slicewarden.llm.common import stored

BUCKET_BYTES = 32 << 20


def shuffled_buckets(df: DataFrame, seed: int, bucket_bytes: int = BUCKET_BYTES, text_col: str = "text") -> DataFrame:
    """(bucket, place, row): every record once, written to the shared folder."""
    spark = df.sparkSession
    size = F.coalesce(F.octet_length(text_col), F.lit(0)) + 8
    total = df.agg(F.sum(size)).first()[0] or 0
    # Never fewer buckets than shuffle partitions, so that all tasks work.
    buckets = max(-(-total // bucket_bytes), int(spark.conf.get("spark.sql.shuffle.partitions")))
    record = F.struct(*[F.col(c) for c in df.columns])
    place = F.monotonically_increasing_id()
    scattered = (df.select(record.alias("row"), place.alias("i"),
                           F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("crc"))
                 .withColumn("h", F.xxhash64(F.lit(seed), "crc", "i"))
                 .withColumn("bucket", F.pmod("h", F.lit(buckets)).cast("int")))

    def by_hash(a, b):
        return (F.when(a["h"] < b["h"], -1).when(a["h"] > b["h"], 1).when(a["i"] < b["i"], -1)
                .when(a["i"] > b["i"], 1).otherwise(0))

    packed = (scattered.repartition(buckets, "bucket").groupBy("bucket")
              .agg(F.collect_list(F.struct("h", "i", "row")).alias("rows"))
              .select("bucket", F.array_sort("rows", by_hash).alias("rows")).sortWithinPartitions("bucket"))
    dealt = (packed.select("bucket", F.shuffle("rows", F.lit(seed)).alias("rows"))
             .select("bucket", F.posexplode("rows").alias("place", "r")).select("bucket", "place", F.col("r.row").alias("row")))
    return stored(dealt, "buckets")


def shards(df: DataFrame, count: int, seed: int = 17, bucket_bytes: int = BUCKET_BYTES, text_col: str = "text"
           ) -> DataFrame:
    """``df``'s rows (struct ``row``) with ``shard`` (0 to count - 1) and
    ``slot`` (0, 1, ... within the shard)."""
    dealt = shuffled_buckets(df, seed, bucket_bytes, text_col)
    sizes = dealt.groupBy("bucket").agg(F.count("*").alias("n"))
    # One row per bucket: bytes / bucket_bytes, or the shuffle partitions.
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    n = dealt.count()
    each, longer = divmod(n, count)
    cut = longer * (each + 1)           # rows in the shards that hold one more
    at = F.col("first") + F.col("place")
    placed = dealt.join(F.broadcast(starts), "bucket").withColumn("at", at)
    late = F.col("at") - cut
    step = max(each, 1)
    return placed.select(
        "row",
        F.when(late < 0, F.floor(F.col("at") / (each + 1))).otherwise(longer + F.floor(late / step)).cast("int").alias("shard"),
        F.when(late < 0, F.pmod("at", F.lit(each + 1))).otherwise(F.pmod(late, F.lit(step))).cast("long").alias("slot"))


def write_shards(df: DataFrame, path: str, count: int, seed: int = 17, bucket_bytes: int = BUCKET_BYTES) -> None:
    """Write ``path``/shard=N with all columns of ``df`` and ``slot``."""
    done = shards(df, count, seed, bucket_bytes)
    names = [c for c in df.columns if c not in ("shard", "slot")]
    (done.select(*[F.col(f"row.{c}").alias(c) for c in names], "slot", "shard")
     .repartition("shard", F.floor(F.col("slot") / 1_000_000)).sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))

"""Deduplication, duplicate flags, capped samples and global positions.

A window partitioned by a key sends every row of that key to one task; if one
key holds a third of the rows, one task does a third of the work.  Each
operator here is therefore written as an aggregation that combines map-side,
or as a join that AQE's skew handling can split:

* keep-first  = ``groupBy(key).agg(min(struct(order…, row)))``: each map task
  reduces a hot key to one row before the shuffle.
* duplicate flag = counts of key hashes, then of the keys whose hash repeats.
  If these are few they are broadcast and no row moves; otherwise the counts are
  joined back once, rows of hot keys (over a row bound) flagged and salted.
* capped sample = two-level top-k: per (group, input partition bucket), then
  per group, each level led by a map-side partial limit.
* global position = sort, then partition offsets (one row per partition).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slicewarden.functions.joins import FEW_KEYS, HOT_ROWS, hottest, row_hash
from slicewarden.functions.names import quoted
from slicewarden.session import materialize


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def keep_first(df: DataFrame, keys: list[str], order: list, row_cols: list[str] | None = None) -> DataFrame:
    """Keep, per key, the row that sorts first by ``order`` (ascending, NULL
    first).  Same rows as ``row_number() over (partition by keys order by
    order) = 1`` when ``order`` is a total order; NULL keys form one group.

    ``order`` items may be column names or expressions such as
    ``F.col("_metadata.file_path")``.
    """
    row_cols = row_cols or [c for c in df.columns if c not in keys]
    order_struct = [c.alias(f"__o{i}") for i, c in enumerate(_cols(order))]
    packed = F.struct(*order_struct, F.struct(*[F.col(q).alias(f"c{i}") for i, q in enumerate(quoted(row_cols))]).alias("__row"))
    best = df.groupBy(*quoted(keys)).agg(F.min(packed).alias("__best"))
    row = [F.col("__best.__row")[f"c{i}"].alias(c) for i, c in enumerate(row_cols)]
    return best.select(*quoted(keys), *row).select(*quoted(df.columns))


def key_counts(df: DataFrame, keys: list, name: str = "__copies") -> DataFrame:
    """Rows per key combination (NULL keys counted together)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def repeated_keys(df: DataFrame, keys: list[str]) -> tuple[DataFrame, int]:
    """Key combinations that occur more than once, with their ``__copies``
    (NULLs equal to each other), and how many hashes repeat (``FEW_KEYS`` + 1
    stands for any larger number).

    Copies of a key share its hash, so hashes are counted first: what is
    shuffled is two numbers for each key, however long it is.  If few hashes
    repeat, only the rows that have them are counted by key, which tells keys of
    one hash apart; otherwise all rows are.
    """
    key_hash = F.xxhash64(*[F.col(k) for k in keys])
    hashes = key_counts(df.select(key_hash.alias("__hash")), ["__hash"]).where(F.col("__copies") > 1).select("__hash")
    hashes = materialize(hashes)
    n = hashes.limit(FEW_KEYS + 1).count()
    rows = df.select(*keys, key_hash.alias("__h"))
    if n <= FEW_KEYS:
        rows = rows.join(F.broadcast(hashes), F.col("__h") == F.col("__hash"), "left_semi")
    return key_counts(rows, keys).where(F.col("__copies") > 1), n


def flag_duplicates(df: DataFrame, keys: list[str], scope: list[str] | None = None,
                    name: str = "_dup", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add ``name`` = TRUE on every copy of a key repeated within ``scope``
    (all copies flagged, NULL keys equal to each other).

    The repeated keys (:func:`repeated_keys`) are broadcast if they are few.
    Otherwise copies are counted with ``groupBy`` (map-side combine), and the
    rows are joined once to the repeated keys.  The rows of a hot key (more than
    ``hot_rows`` copies, at most ``MAX_HOT`` keys, broadcast) need no partner:
    they are flagged at once and go to salts of their own, so no task receives
    them all.  (AQE's skew split does not apply here: the count side of the
    join is an aggregate, not a plain shuffle.)
    """
    scope = scope or []
    grp = scope + keys
    found, n = repeated_keys(df, grp)
    if n == 0:
        return df.withColumn(name, F.lit(False))

    def named(prefix):
        return [F.col(k).alias(f"{prefix}{i}") for i, k in enumerate(grp)]

    def on(left, prefix):
        return [left[k].eqNullSafe(F.col(f"{prefix}{i}")) for i, k in enumerate(grp)]

    if n <= FEW_KEYS:
        few = F.broadcast(found.select(*named("__k"), F.lit(True).alias("__rep")))
        joined = df.join(few, on=on(df, "__k"), how="left")
        return joined.select(*[df[c] for c in quoted(df.columns)], F.coalesce("__rep", F.lit(False)).alias(name))

    hot = hottest(found, "__copies", hot_rows).select(*named("__h"), F.lit(True).alias("__hot"))
    repeated = found.select(*named("__k"), F.lit(0).alias("__part"),
                                                          F.lit(True).alias("__rep"))
    salt = F.when(F.col("__hot"), 1 + F.pmod(row_hash(df), F.lit(1 << 20)).cast("int")).otherwise(F.lit(0))
    tagged = df.join(F.broadcast(hot), on=on(df, "__h"), how="left").select(
        *[df[c] for c in quoted(df.columns)], "__hot", salt.alias("__salt"))
    joined = tagged.join(repeated, on=[*on(tagged, "__k"), F.col("__salt") == F.col("__part")], how="left")
    return joined.select(*[tagged[c] for c in quoted(df.columns)],
                         F.coalesce(F.col("__hot"), F.col("__rep"), F.lit(False)).alias(name))


def capped_sample(df: DataFrame, group: list[str], order: list, cap: int, fan_in: int | None = None,
                  name: str = "_sample_rank") -> DataFrame:
    """First ``cap`` rows of each group by ``order`` (a total order), exactly.

    Level one ranks within (group, input-partition bucket) and level two within
    the group.  With ``spark.sql.optimizer.windowGroupLimitThreshold`` ≥ cap
    the optimizer puts a partial limit before each shuffle, so a map task ships
    at most ``cap`` rows per group, a level-one task sees at most
    ``cap × partitions / fan_in`` and a level-two task ``cap × fan_in`` rows,
    whatever the group's size.  ``fan_in`` defaults to the square root of the
    shuffle partitions (64 at least), which are sized to the data, so both
    levels grow alike.
    """
    order_cols = _cols(order)
    key = "spark.sql.optimizer.windowGroupLimitThreshold"
    spark = df.sparkSession
    if fan_in is None:
        fan_in = max(64, math.isqrt(int(spark.conf.get("spark.sql.shuffle.partitions"))))
    if int(spark.conf.get(key, "1000")) < cap:
        spark.conf.set(key, str(cap))
    staged = df.withColumn("__bucket", F.pmod(F.spark_partition_id(), F.lit(fan_in)))
    w1 = Window.partitionBy(*group, "__bucket").orderBy(*order_cols)
    level1 = staged.withColumn("__r1", F.row_number().over(w1)).where(F.col("__r1") <= cap)
    w2 = Window.partitionBy(*group).orderBy(*order_cols)
    level2 = level1.withColumn(name, F.row_number().over(w2)).where(F.col(name) <= cap)
    return level2.drop("__bucket", "__r1")


def global_positions(df: DataFrame, order: list, name: str = "position", start: int = 1) -> DataFrame:
    """Dense 1-based position of every row in the total order ``order``,
    without a single-partition window.

    The frame is range-partitioned and sorted, each row takes its partition
    and in-partition index from ``monotonically_increasing_id`` (partition in
    the upper bits), and is materialised once with ``checkpoint()`` so that
    both uses below see the same layout.  Partition sizes (one row per
    partition) are prefix-summed and joined back by broadcast: that side is
    bounded by the number of partitions, not by the data.
    """
    ordered = df.orderBy(*_cols(order)).withColumn("__mid", F.monotonically_increasing_id())
    ordered = materialize(ordered)
    ordered = ordered.select("*", F.shiftright("__mid", 33).alias("__pid"),
                             (F.col("__mid").bitwiseAND(F.lit((1 << 33) - 1))).alias("__local"))
    sizes = ordered.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    offsets = sizes.select(
        "__pid",
        (F.sum("__n").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1))).alias("__off"),
    )
    out = ordered.join(F.broadcast(offsets), "__pid", "left")
    pos = F.coalesce(F.col("__off"), F.lit(0)) + F.col("__local") + F.lit(start)
    return out.select(*quoted(df.columns), pos.cast("long").alias(name))

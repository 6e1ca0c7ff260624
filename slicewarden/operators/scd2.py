"""Type-2 history dimension: daily snapshot, one-day merge, whole-history build.

Dimension schema: customer_id, name, email, region, eff_from, eff_to,
is_current, hash_diff.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicewarden.functions.derive import OPEN_END_DATE
from slicewarden.functions.hashing import hash_diff
from slicewarden.session import materialize

DIM_SCHEMA = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("eff_from", T.DateType()),
    T.StructField("eff_to", T.DateType()),
    T.StructField("is_current", T.BooleanType()),
    T.StructField("hash_diff", T.StringType()),
])
DIM_COLUMNS = [f.name for f in DIM_SCHEMA.fields]


def empty_dimension(spark) -> DataFrame:
    return spark.createDataFrame([], DIM_SCHEMA)


def daily_snapshot(slice_df: DataFrame, key: str = "customer_id", attr: str = "region") -> DataFrame:
    """One row per key of a day's slice: key as string, NULL name/email, the
    attribute and its hash.

    The attribute is ``min`` per key, so the hashed value and the stored value
    always agree and reruns are stable.  Rows without a key are dropped (a
    NULL key never matches, so it would be re-inserted on every run).
    """
    per_key = (slice_df.where(F.col(key).isNotNull())
               .groupBy(F.col(key).cast("string").alias("customer_id"))
               .agg(F.min(F.col(attr)).alias("region")))
    return per_key.select(
        "customer_id",
        F.lit(None).cast("string").alias("name"),
        F.lit(None).cast("string").alias("email"),
        "region",
        hash_diff("region").alias("hash_diff"),
    )


def snapshots_by_day(df: DataFrame, key: str, attr: str, day: str) -> DataFrame:
    """Snapshots of every day at once: (customer_id, day, region, hash_diff)."""
    per = (df.where(F.col(key).isNotNull())
           .groupBy(F.col(key).cast("string").alias("customer_id"), F.col(day).alias("day"))
           .agg(F.min(F.col(attr)).alias("region")))
    return per.select("customer_id", "day", "region", hash_diff("region").alias("hash_diff"))


def merge_day(dim: DataFrame, snapshot: DataFrame, process_date: str, with_history: bool = True) -> DataFrame:
    """Fold one day's snapshot into the dimension.

    Current rows whose key arrives with another hash are closed
    (eff_to = day - 1, is_current = false); new keys and changed keys get a
    current row from the day on; keys absent from the snapshot stay current;
    a rerun of the same day changes nothing.  Historic rows pass through
    untouched, so only current rows and the snapshot are shuffled, in one
    full outer join on the key; each joined row yields its kept-or-closed
    version and, when new or changed, its new version in a single pass.
    ``with_history=False`` skips the pass-through of non-current rows (for
    callers that keep closed versions elsewhere).
    """
    d = F.to_date(F.lit(process_date))
    current = dim.where(F.col("is_current")).alias("t")
    src = snapshot.alias("s")
    j = current.join(src, F.col("t.customer_id") == F.col("s.customer_id"), "full_outer")
    has_t = F.col("t.customer_id").isNotNull()
    has_s = F.col("s.customer_id").isNotNull()
    changed = has_t & has_s & (F.col("t.hash_diff") != F.col("s.hash_diff"))

    kept_or_closed = F.when(has_t, F.struct(
        F.col("t.customer_id").alias("customer_id"), F.col("t.name").alias("name"),
        F.col("t.email").alias("email"), F.col("t.region").alias("region"),
        F.col("t.eff_from").alias("eff_from"),
        F.when(changed, F.date_sub(d, 1)).otherwise(F.col("t.eff_to")).alias("eff_to"),
        F.when(changed, F.lit(False)).otherwise(F.col("t.is_current")).alias("is_current"),
        F.col("t.hash_diff").alias("hash_diff"),
    ))
    inserted = F.when(has_s & (~has_t | changed), F.struct(
        F.col("s.customer_id").alias("customer_id"), F.col("s.name").alias("name"),
        F.col("s.email").alias("email"), F.col("s.region").alias("region"),
        d.alias("eff_from"), F.to_date(F.lit(OPEN_END_DATE)).alias("eff_to"),
        F.lit(True).alias("is_current"), F.col("s.hash_diff").alias("hash_diff"),
    ))
    versions = (j.select(F.explode(F.array(kept_or_closed, inserted)).alias("__v"))
                .where(F.col("__v").isNotNull()).select("__v.*"))
    if not with_history:
        return versions
    return dim.where(~F.col("is_current")).select(*DIM_COLUMNS).unionByName(versions)


def latest_eff_from(dim: DataFrame):
    row = dim.agg(F.max("eff_from").alias("m")).first()
    return row["m"] if row else None


def checked_merge_day(dim: DataFrame, snapshot: DataFrame, process_date: str) -> DataFrame:
    """:func:`merge_day` that refuses a day older than the newest version
    (replaying an old day would close newer rows and invert intervals)."""
    import datetime as _dt

    latest = latest_eff_from(dim)
    if latest is not None and _dt.date.fromisoformat(process_date) < latest:
        raise ValueError(f"{process_date} is older than the newest version ({latest}); rebuild with build_history")
    return merge_day(dim, snapshot, process_date)


def fold_days(spark, snapshots: DataFrame, days: list[str], dim: DataFrame | None = None,
              compact_every: int = 5, partitions: int | None = None) -> DataFrame:
    """Apply :func:`merge_day` day after day (the daily job's loop).

    Only current rows take part in a day's join; closed versions are
    append-only and set aside.  Each day's merge result is written once with a
    reliable ``checkpoint()`` (to the shared checkpoint folder), so the plan
    does not grow with the number of days and a lost executor recomputes at
    most one day.  The closed versions are compacted every few days.
    """
    dim = dim if dim is not None else empty_dimension(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The day filters below would each recompute the snapshot aggregation
    # over the whole source; write it once.
    snapshots = materialize(snapshots)
    closed = dim.where(~F.col("is_current"))
    current = dim.where(F.col("is_current"))
    for i, day in enumerate(days, 1):
        snap = snapshots.where(F.col("day") == F.to_date(F.lit(day))).select(
            "customer_id", F.lit(None).cast("string").alias("name"),
            F.lit(None).cast("string").alias("email"), "region", "hash_diff")
        # Coalesce: the union of yesterday's partitions and the join's would
        # otherwise add partitions every day.
        step = materialize(merge_day(current, snap, day, with_history=False).coalesce(n))
        current = step.where(F.col("is_current"))
        closed = closed.unionByName(step.where(~F.col("is_current")))
        if compact_every and i % compact_every == 0:
            closed = materialize(closed.coalesce(n))
    return closed.unionByName(current)


def build_history(snapshots: DataFrame) -> DataFrame:
    """The whole dimension from all daily snapshots at once.

    A version starts on each day whose hash differs from the key's previous
    present day; it ends the day before the next version starts.  Equal to
    folding the days in order from an empty dimension.  Each key has at most
    one row per day here, so a key's window holds at most the number of days.
    """
    w = Window.partitionBy("customer_id").orderBy("day")
    marked = snapshots.withColumn("__prev", F.lag("hash_diff").over(w))
    starts = marked.where(F.col("__prev").isNull() | (F.col("__prev") != F.col("hash_diff")))
    nxt = F.lead("day").over(w)
    return starts.select(
        "customer_id",
        F.lit(None).cast("string").alias("name"),
        F.lit(None).cast("string").alias("email"),
        "region",
        F.col("day").alias("eff_from"),
        F.coalesce(F.date_sub(nxt, 1), F.to_date(F.lit(OPEN_END_DATE))).alias("eff_to"),
        nxt.isNull().alias("is_current"),
        "hash_diff",
    )


# -- versions that know the days they were observed on ------------------------------
#
# A version says from when to when a value held, not on which days it was seen:
# from 3 to 5 may mean seen on 3, 4 and 5, or on 3 alone.  A late day needs to
# know, so stored versions carry ``seen``: runs of calendar days, in order.
SEEN = T.StructField("seen", T.ArrayType(T.StructType([T.StructField("lo", T.DateType()),
                                                       T.StructField("hi", T.DateType())])))
SEEN_SCHEMA = T.StructType(DIM_SCHEMA.fields + [SEEN])
SEEN_COLUMNS = [f.name for f in SEEN_SCHEMA.fields]


def _run(lo, hi):
    return F.struct(F.to_date(lo).alias("lo"), F.to_date(hi).alias("hi"))


def seen_on(day: Column) -> Column:
    """Whether a version was observed on ``day``."""
    return F.exists("seen", lambda r: (r["lo"] <= day) & (r["hi"] >= day))


def fold_day(current: DataFrame, snapshot: DataFrame, process_date: str) -> DataFrame:
    """:func:`merge_day` over current rows with ``seen``, for a day after all
    days folded before: a key that arrives with the hash it has is observed
    once more."""
    d = F.to_date(F.lit(process_date))
    j = current.alias("t").join(snapshot.alias("s"), F.col("t.customer_id") == F.col("s.customer_id"), "full_outer")
    has_t, has_s = F.col("t.customer_id").isNotNull(), F.col("s.customer_id").isNotNull()
    changed = has_t & has_s & (F.col("t.hash_diff") != F.col("s.hash_diff"))
    last = F.element_at("t.seen", -1)
    longer = F.when(last["hi"] == F.date_sub(d, 1), F.concat(
        F.slice("t.seen", F.lit(1), F.size("t.seen") - 1), F.array(_run(last["lo"], d)))).otherwise(
        F.concat("t.seen", F.array(_run(d, d))))
    kept = F.when(has_t, F.struct(
        *[F.col(f"t.{c}").alias(c) for c in DIM_COLUMNS[:5]],
        F.when(changed, F.date_sub(d, 1)).otherwise(F.col("t.eff_to")).alias("eff_to"),
        (~changed).alias("is_current"), F.col("t.hash_diff").alias("hash_diff"),
        F.when(has_s & ~changed, longer).otherwise(F.col("t.seen")).alias("seen")))
    opened = F.when(has_s & (~has_t | changed), F.struct(
        *[F.col(f"s.{c}").alias(c) for c in DIM_COLUMNS[:4]], d.alias("eff_from"),
        F.to_date(F.lit(OPEN_END_DATE)).alias("eff_to"), F.lit(True).alias("is_current"),
        F.col("s.hash_diff").alias("hash_diff"), F.array(_run(d, d)).alias("seen")))
    return (j.select(F.explode(F.array(kept, opened)).alias("__v")).where(F.col("__v").isNotNull()).select("__v.*"))


def chain(runs: DataFrame) -> DataFrame:
    """Versions (with ``seen``) from observation runs (customer_id, region,
    hash_diff, lo, hi) that do not overlap within a key.

    Neighbouring runs of equal hash are one version; it holds until the day
    before the next one starts, the last one for ever.  A key's window holds at
    most a run for each day.
    """
    w = Window.partitionBy("customer_id").orderBy("lo")
    before = F.lag("hash_diff").over(w)
    first = before.isNull() | (before != F.col("hash_diff"))
    gap = first | (F.date_add(F.lag("hi").over(w), 1) != F.col("lo"))
    marked = runs.select("*", first.alias("__first"), gap.alias("__gap"))
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    numbered = marked.select("*", F.sum(F.col("__first").cast("int")).over(so_far).alias("__version"),
                             F.sum(F.col("__gap").cast("int")).over(so_far).alias("__island"))
    # Clustered by the key already: neither step shuffles again.
    islands = numbered.groupBy("customer_id", "__version", "__island").agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("region").alias("region"),
        F.min("hash_diff").alias("hash_diff"))
    found = islands.groupBy("customer_id", "__version").agg(
        F.min("lo").alias("eff_from"), F.min("region").alias("region"), F.min("hash_diff").alias("hash_diff"),
        F.array_sort(F.collect_list(F.struct("lo", "hi"))).alias("seen"))
    nxt = F.lead("eff_from").over(Window.partitionBy("customer_id").orderBy("eff_from"))
    none = F.lit(None).cast("string")
    return found.select(
        "customer_id", none.alias("name"), none.alias("email"), "region", "eff_from",
        F.coalesce(F.date_sub(nxt, 1), F.to_date(F.lit(OPEN_END_DATE))).alias("eff_to"),
        nxt.isNull().alias("is_current"), "hash_diff", "seen")


def splice_day(versions: DataFrame, snapshot: DataFrame, process_date: str) -> DataFrame:
    """Put a past day's snapshot into the version chains it falls in.

    ``versions`` holds, of every key that the snapshot has or that was observed
    on that day, the versions from the one before the day's to the current one
    (with ``seen``).  What was observed on the day before is forgotten; the
    snapshot's observation splits the version it falls in, joins a neighbour of
    equal hash, or stands alone.  Returns the chains as they are now; keys that
    are left without any observation have none.
    """
    d = F.to_date(F.lit(process_date))
    kept = (versions.select("customer_id", "region", "hash_diff", F.explode("seen").alias("r"))
            .select("customer_id", "region", "hash_diff", F.explode(F.array(
                F.struct(F.col("r.lo").alias("lo"), F.least("r.hi", F.date_sub(d, 1)).alias("hi")),
                F.struct(F.greatest("r.lo", F.date_add(d, 1)).alias("lo"), F.col("r.hi").alias("hi")))).alias("r"))
            .where("r.lo <= r.hi").select("customer_id", "region", "hash_diff", "r.lo", "r.hi"))
    new = snapshot.select("customer_id", "region", "hash_diff", d.alias("lo"), d.alias("hi"))
    return chain(kept.unionByName(new))


def chain_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Versions that differ between two states of the same chains: rows with
    ``old`` and ``new`` structs, one of them null for a version that came or went."""
    o = old.select(F.struct(*SEEN_COLUMNS).alias("old"))
    n = new.select(F.struct(*SEEN_COLUMNS).alias("new"))
    both = o.join(n, (F.col("old.customer_id") == F.col("new.customer_id"))
                  & (F.col("old.eff_from") == F.col("new.eff_from")), "full_outer")
    return both.where(~F.col("old").eqNullSafe(F.col("new")))


def closed_versions(dim: DataFrame, snapshot: DataFrame, process_date: str) -> DataFrame:
    """SCD2-2 alone: current rows whose key arrives with another hash, closed
    (eff_to = day - 1, is_current = false).  An EXISTS with a residual:
    a left semi join on the key with ``hash_diff !=`` as extra condition."""
    t, s = dim.where(F.col("is_current")).alias("t"), snapshot.alias("s")
    hit = t.join(s, (F.col("t.customer_id") == F.col("s.customer_id"))
                 & (F.col("t.hash_diff") != F.col("s.hash_diff")), "left_semi")
    return hit.select(
        "customer_id", "name", "email", "region", "eff_from",
        F.date_sub(F.to_date(F.lit(process_date)), 1).alias("eff_to"),
        F.lit(False).alias("is_current"), "hash_diff")


def new_versions(dim: DataFrame, snapshot: DataFrame, process_date: str) -> DataFrame:
    """SCD2-3 alone: snapshot rows with no current row of the same key, or
    whose current row has another hash, as open current versions (left join
    on the key against current rows, kept when unmatched or changed)."""
    cur = dim.where(F.col("is_current")).select(F.col("customer_id").alias("__k"),
                                                 F.col("hash_diff").alias("__h"))
    j = snapshot.join(cur, snapshot["customer_id"] == cur["__k"], "left")
    keep = j.where(F.col("__k").isNull() | (F.col("__h") != F.col("hash_diff")))
    return keep.select(
        "customer_id", "name", "email", "region",
        F.to_date(F.lit(process_date)).alias("eff_from"), F.to_date(F.lit(OPEN_END_DATE)).alias("eff_to"),
        F.lit(True).alias("is_current"), "hash_diff")

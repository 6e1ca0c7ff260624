"""Suites over a whole table, kept up day by day.

Counts of rows, missing and unexpected values add up over days, so a stored
state needs no second look at days it has seen.  Uniqueness does not add up:
the state holds how often each key occurs, in a table bucketed by key, and what
the newest days change about it.  A day only adds its own changes; every
``merge_every`` days they are merged into the table, without a shuffle of it, so
that a key is written once for many days and not again each day.  A day that
comes again takes the place of its earlier self.  The results equal
:func:`validate.run_suite` over all days together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicewarden.functions.rules import EXISTS, ROW_COUNT, UNIQUE, Rule
from slicewarden.operators import validate
from slicewarden.sources import versions

COUNTS, DAY_KEYS, KEYS, CHANGES = "counts", "day_keys", "keys", "key_changes"
# Days whose key counts wait beside the table until one merge takes them all.
MERGE_EVERY = 16
COUNT_SCHEMA = T.StructType([
    T.StructField("rule_index", T.IntegerType()), T.StructField("elements", T.LongType()),
    T.StructField("missing", T.LongType()), T.StructField("unexpected", T.LongType()),
    T.StructField("present", T.BooleanType())])
KEY_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()), T.StructField("rule_index", T.IntegerType()),
    T.StructField("copies", T.LongType())])


def day_counts(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """What a day adds to each rule (``COUNT_SCHEMA``), in one aggregation; the
    repeated keys of uniqueness rules are not in it, only their rows and nulls."""
    unique = [i for i, r in enumerate(rules) if r.kind == UNIQUE]
    # A not-null rule counts the rows and nulls of a unique column.
    found = validate.run_suite(df, [Rule.not_null(r.column) if r.kind == UNIQUE else r for r in rules])
    return found.select("rule_index", F.coalesce("element_count", "observed_value").alias("elements"),
                        F.col("missing_count").alias("missing"),
                        F.when(~F.col("rule_index").isin(unique), F.col("unexpected_count")).alias("unexpected"),
                        (F.col("rule_index").isin(unique) | F.col("success") | (F.col("expectation_type") != EXISTS))
                        .alias("present"))


def day_keys(df: DataFrame, rules: list[Rule]) -> DataFrame | None:
    """Copies of every key of each uniqueness rule (``KEY_SCHEMA``)."""
    found = None
    for i, r in enumerate(rules):
        if r.kind == UNIQUE:
            keys = (df.where(F.col(r.column).isNotNull()).groupBy(F.col(r.column).cast("string").alias("key"))
                    .agg(F.count(F.lit(1)).alias("copies"))
                    .select("key", F.lit(i).alias("rule_index"), "copies"))
            found = keys if found is None else found.unionByName(keys)
    return found


def _added(state: DataFrame, changes: DataFrame, n: int) -> DataFrame:
    """Copies of every key (``KEY_SCHEMA``): those of ``state``, in ``n`` buckets
    by key, and those that ``changes`` adds or takes away."""
    # Dealt like the buckets: a day holds a key once a rule, so no key is hot.
    more = (changes.repartition(n, "key").groupBy("key", "rule_index").agg(F.sum("copies").alias("more"))
            .select(F.col("key").alias("k"), F.col("rule_index").alias("r"), "more"))
    both = state.join(more, (F.col("key") == F.col("k")) & (F.col("rule_index") == F.col("r")), "full_outer")
    return both.select(
        F.coalesce("key", "k").alias("key"), F.coalesce("rule_index", "r").alias("rule_index"),
        (F.coalesce("copies", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("copies")).where("copies > 0")


def fold_day(spark: SparkSession, root: str, day: DataFrame, run_date: str, rules: list[Rule],
             buckets: int | None = None, merge_every: int = MERGE_EVERY) -> None:
    """Fold the rows of one day into the state at ``root``, in one commit; a
    day folded before is replaced.  Only the day's rows are read, and the keys
    of all days when ``merge_every`` days of changes wait to be merged."""
    change = versions.Store(spark, root).change()
    change.write(f"{COUNTS}/date={run_date}", day_counts(day, rules))
    keys = day_keys(day, rules)
    if keys is not None:
        slot = f"{DAY_KEYS}/date={run_date}"
        before = change.read(DAY_KEYS, KEY_SCHEMA, [slot])
        path = change.save(slot, keys.write.parquet)
        if change.base.slots.get(slot):
            # What changes for each key: new copies less those counted for the day before.
            now = spark.read.schema(KEY_SCHEMA).parquet(path)
            change.append(CHANGES, now.unionByName(before.withColumn("copies", -F.col("copies")))
                          .groupBy("key", "rule_index").agg(F.sum("copies").alias("copies")).where("copies <> 0"))
        else:
            change.added.setdefault(CHANGES, []).extend(change.set[slot])
    done = change.commit()
    if len(done.slots.get(CHANGES, ())) >= merge_every:
        _merge(spark, root, buckets)


def _merge(spark: SparkSession, root: str, buckets: int | None) -> None:
    """The waiting changes go into the table of keys, in a commit of their own."""
    change = versions.Store(spark, root).change()
    there = change.base.slots.get(KEYS, ())
    n = there[0].buckets if there else buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    state = change.read(KEYS, KEY_SCHEMA)
    state = state if there else state.repartition(n, "key")
    merged = _added(state, change.read(CHANGES, KEY_SCHEMA), n)
    change.put(KEYS, versions.Folder(change.write_bucketed(merged, "key", n), n, "key"))
    change.drop(CHANGES)
    try:
        change.commit()
    except versions.Conflict:            # another day came between: a later fold merges
        pass


def results(spark: SparkSession, root: str, rules: list[Rule]) -> DataFrame:
    """The suite's result rows over all days folded."""
    store = versions.Store(spark, root)
    at = store.latest()
    counts, keys = store.read(COUNTS, COUNT_SCHEMA, at), store.read(KEYS, KEY_SCHEMA, at)
    if at.slots.get(CHANGES):
        changes, there = store.read(CHANGES, KEY_SCHEMA, at), at.slots.get(KEYS, ())
        keys = (_added(keys, changes, there[0].buckets) if there else
                changes.groupBy("key", "rule_index").agg(F.sum("copies").alias("copies")))

    def of(i: int, column: str):
        return F.sum(F.when(F.col("rule_index") == i, F.col(column)))

    aggs = []
    for i, _ in enumerate(rules):
        aggs += [F.coalesce(of(i, c), F.lit(0)).alias(f"{c}{i}") for c in ("elements", "missing", "unexpected")]
        aggs.append(F.coalesce(F.bool_and(F.when(F.col("rule_index") == i, F.col("present"))), F.lit(True))
                    .alias(f"present{i}"))
    sums = counts.agg(*aggs)
    copies = [F.coalesce(F.sum(F.when((F.col("rule_index") == i) & (F.col("copies") > 1), F.col("copies"))), F.lit(0))
              .alias(f"repeated{i}") for i, r in enumerate(rules) if r.kind == UNIQUE]
    if copies:
        sums = sums.join(F.broadcast(keys.agg(*copies)))                    # one row each
    null, rows = F.lit(None), []
    for i, r in enumerate(rules):
        n, m, u = (F.col(f"{c}{i}") for c in ("elements", "missing", "unexpected"))
        if r.is_row_level:
            considered = n if r.kind == "expect_column_values_to_not_be_null" or not r.column else n - m
            rows.append(validate._row(i, r, n, m if r.column else null, u, null,
                                      validate._mostly_success(considered, u, r.mostly)))
        elif r.kind == ROW_COUNT:
            rows.append(validate._row(i, r, n, null, null, n, validate._between_ok(n, r.min_value, r.max_value)))
        elif r.kind == EXISTS:
            rows.append(validate._row(i, r, null, null, null, null, F.col(f"present{i}")))
        else:
            u = F.col(f"repeated{i}")
            rows.append(validate._row(i, r, n, m, u, null, validate._mostly_success(n - m, u, r.mostly)))
    out = sums.select(F.inline(F.array(*rows)))
    return out.select(*[F.col(f.name).cast(f.dataType) for f in validate.RESULT_SCHEMA.fields])

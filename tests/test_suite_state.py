"""Suite state kept up day by day against full runs."""

import os
import random

from pyspark.sql import functions as F

from slicewarden.functions.rules import Rule
from slicewarden.operators import suite_state, validate
from slicewarden.plans import jobs
from slicewarden.sources import versions
from slicewarden.sources.generate import generate_orders

RULES = [Rule.unique("k"), Rule.not_null("k", mostly=0.5), Rule.between("v", 0, 5, mostly=0.8), Rule.unique("s", mostly=0.4),
         Rule.in_set("s", ("a", "b")), Rule.row_count(min_value=0, max_value=60), Rule.exists("v"), Rule.exists("gone")]


def rows(df):
    return sorted(map(repr, df.collect()))


def test_any_order_of_days_equals_the_full_run(spark, tmpdir_path):
    rnd, root, days = random.Random(3), os.path.join(tmpdir_path, "state"), {}

    def frame(data):
        return spark.createDataFrame(data, "k long, v long, s string")

    def day():
        return [(rnd.choice([None, 1, 2, *range(10, 60)]), rnd.choice([None, -1, 2, 3]), rnd.choice([None, "a", "b", "zz"]))
                for _ in range(rnd.randrange(0, 12))]

    for d in ["02", "01", "03", "02", "01"]:                      # late and corrected days among them
        days[d] = day()
        suite_state.fold_day(spark, root, frame(days[d]), f"2024-01-{d}", RULES, buckets=3)
        whole = frame([r for data in days.values() for r in data])
        assert rows(suite_state.results(spark, root, RULES)) == rows(validate.run_suite(whole, RULES)), d
    keys = versions.Store(spark, root).read("keys", suite_state.KEY_SCHEMA)
    assert keys.where("copies <= 0").count() == 0 and keys.count() == keys.select("key", "rule_index").distinct().count()


def test_no_days_and_no_unique_rule(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "state")
    assert [r.element_count for r in suite_state.results(spark, root, RULES[1:2]).collect()] == [0]
    suite_state.fold_day(spark, root, spark.createDataFrame([(1,)], "k long"), "2024-01-01", RULES[1:2])
    assert [r.success for r in suite_state.results(spark, root, RULES[1:2]).collect()] == [True]


def test_daily_job_reads_its_day_only(spark, tmpdir_path):
    table, state = os.path.join(tmpdir_path, "orders"), os.path.join(tmpdir_path, "state")
    out = {}
    for i, d in enumerate(["2024-01-01", "2024-01-02"]):
        # The same ids every day: unique within a day, not over the table.
        df = generate_orders(spark, d, rows=40, partitions=1, seed=i)
        df.withColumn("order_id", F.col("order_id") % 30).write.parquet(os.path.join(table, f"date={d}"))
        args = {"ready_root": os.path.join(tmpdir_path, "ready"), "error_root": os.path.join(tmpdir_path, "error"),
                "results_path": os.path.join(tmpdir_path, "results"), "scope": "table"}
        out[d] = jobs.validate_day(spark, table, d, "basic", state_root=state, layout="versions", **args)["summary"]
    full = jobs.validate_day(spark, table, "2024-01-02", "basic", dry_run=True, **args)["summary"]
    assert {k: v for k, v in out["2024-01-02"].items() if k != "run_ts"} == {k: v for k, v in full.items() if k != "run_ts"}


def test_a_day_leaves_the_keys_of_other_days_where_they_are(spark, tmpdir_path):
    root, data = os.path.join(tmpdir_path, "state"), {}
    tables, sizes = [], []
    for i, d in enumerate(["01", "02", "01", "03", "04", "02", "05"]):          # two days come again
        data[d] = [(k, 1, "a") for k in (None, 1, i, 10 + i)]
        suite_state.fold_day(spark, root, spark.createDataFrame(data[d], "k long, v long, s string"), f"2024-01-{d}",
                             RULES, buckets=2, merge_every=3)
        at = versions.Store(spark, root).latest()
        tables.append(at.slots.get("keys"))
        sizes.append(len(at.slots.get("key_changes", ())))
        whole = spark.createDataFrame([r for rows_ in data.values() for r in rows_], "k long, v long, s string")
        assert rows(suite_state.results(spark, root, RULES)) == rows(validate.run_suite(whole, RULES)), d
    assert sizes == [1, 2, 0, 1, 2, 0, 1]
    assert tables[2] == tables[3] == tables[4] != tables[5] == tables[6]          # written again by a merge only
    keys = versions.Store(spark, root).read("keys", suite_state.KEY_SCHEMA)
    assert keys.where("copies <= 0").count() == 0 and keys.count() == keys.select("key", "rule_index").distinct().count() > 0

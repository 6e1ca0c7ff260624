"""Skew-safe window replacements against brute force, with a hot key."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from slicewarden.operators import dedupe


def bag(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def skewed(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        k = 0 if i % 3 == 0 else rnd.randint(1, 400)   # key 0 holds a third of the rows
        if i % 97 == 0:
            k = None
        rows.append((k, rnd.choice(["f1", "f2", "f3"]), i, rnd.random()))
    return spark.createDataFrame(rows, "k long, file string, pos long, v double").repartition(6)


def test_keep_first_matches_row_number(spark):
    df = skewed(spark)
    got = dedupe.keep_first(df, ["k"], ["file", "pos"])
    w = Window.partitionBy("k").orderBy("file", "pos")
    want = df.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
    assert bag(got) == bag(want)


def test_flag_duplicates_matches_window_count(spark):
    df = skewed(spark)
    got = dedupe.flag_duplicates(df, ["k"], scope=["file"])
    want = df.withColumn("_dup", F.count(F.lit(1)).over(Window.partitionBy("file", "k")) > 1)
    assert bag(got) == bag(want)


def test_capped_sample_exact_when_cap_binds(spark):
    df = skewed(spark)
    got = dedupe.capped_sample(df, ["file"], ["pos"], cap=50, fan_in=3)
    w = Window.partitionBy("file").orderBy("pos")
    want = df.withColumn("_sample_rank", F.row_number().over(w)).where("_sample_rank <= 50")
    assert bag(got) == bag(want)


def test_global_positions_dense(spark):
    df = skewed(spark).select("pos", "v")
    got = dedupe.global_positions(df, ["v", "pos"], name="p").collect()
    ordered = sorted(got, key=lambda r: (r.v, r.pos))
    assert [r.p for r in ordered] == list(range(1, len(got) + 1))


def test_flag_duplicates_hot_path_matches_window_count(spark):
    df = skewed(spark)                      # key 0 has ~1000 rows
    got = dedupe.flag_duplicates(df, ["k"], scope=["file"], hot_rows=100)
    want = df.withColumn("_dup", F.count(F.lit(1)).over(Window.partitionBy("file", "k")) > 1)
    assert bag(got) == bag(want)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_hot_split_lookup_equals_join(spark):
    from slicewarden.functions.joins import hot_split_lookup
    big = skewed(spark).select("k", "pos")
    small = spark.createDataFrame([(k, f"n{k}") for k in range(0, 300)], "id long, name string")
    got = hot_split_lookup(big, small, "k", "id", hot_rows=100)
    want = big.join(small, big["k"] == small["id"])
    assert bag(got.select("k", "pos", "id", "name")) == bag(want.select("k", "pos", "id", "name"))
    assert "BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()


def test_salted_joins_with_hot_null_and_repeated_rows(spark):
    from collections import Counter

    from slicewarden.functions.joins import hot_keys, hot_split_lookup

    rows = [("hot", i % 7) for i in range(900)] + [("warm", i) for i in range(40)] + [(None, i) for i in range(300)]
    big = spark.createDataFrame(rows, "k string, v int")
    small = spark.createDataFrame([("hot", "x"), ("hot", "y"), ("warm", "z"), ("cold", "w"), (None, "n")],
                                  "id string, w string")
    want = Counter(map(tuple, big.join(small, big["k"] == small["id"]).collect()))
    for bound in (1, 100, 10_000):
        assert Counter(map(tuple, hot_split_lookup(big, small, "k", "id", hot_rows=bound).collect())) == want
    assert {r["__hk"]: r["__salts"] for r in hot_keys(big, "k", 100).collect()}["hot"] == 9
    for bound in (1, 100, 10_000):
        got = Counter((r.k, r.v, r["_dup"]) for r in dedupe.flag_duplicates(big, ["k"], hot_rows=bound).collect())
        assert got == Counter((k, v, True) for k, v in rows)


def test_duplicate_flags_move_no_rows_when_few_keys_repeat(spark, monkeypatch, no_size_broadcast):
    from slicewarden.operators import dedupe

    data = [(f, k, i) for i, (f, k) in enumerate([("a", "x"), ("a", "x"), ("b", "x"), ("b", None), ("b", None), (None, "y"),
                                                  (None, "y"), ("c", "z")])]
    df = spark.createDataFrame(data, "f string, k string, v long")
    want = {0, 1, 3, 4, 5, 6}
    few = dedupe.flag_duplicates(df, ["k"], scope=["f"])
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 2
    monkeypatch.setattr(dedupe, "FEW_KEYS", 1)
    many = dedupe.flag_duplicates(df, ["k"], scope=["f"])
    none = dedupe.flag_duplicates(df, ["v"])
    for got, flagged in ((few, want), (many, want), (none, set())):
        assert {r.v for r in got.collect() if r._dup} == flagged and got.count() == len(data)
        assert got.columns == ["f", "k", "v", "_dup"]

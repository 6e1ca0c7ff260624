"""Hot-key check: the largest shuffle read of any single task, per operator.

A third of lineitem's rows are put on one key.  Each operator is run in its
own job group; Spark's event log (written to a scratch folder, no UI) gives
per-task shuffle-read records.  A naive window puts the hot key's third of
the rows into one task; the skew-safe operators should not.

Usage: python scripts/skew_check.py [sf_dir]  → prints a markdown table.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from slicewarden.operators import dedupe  # noqa: E402
from slicewarden.session import get_session  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    logdir = tempfile.mkdtemp(prefix="run-skew-")
    spark = get_session(master="local[8]", shuffle_partitions=16, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": logdir, "spark.eventLog.compress": "false",
        # let AQE treat a partition as skewed at this small scale
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256KB",
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    })
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    hot = li.select(F.when(F.col("l_orderkey") % 3 == 0, F.lit(0)).otherwise(F.col("l_orderkey")).alias("k"),
                    F.when(F.col("l_orderkey") % 3 == 0, F.lit("hot")).otherwise(F.col("l_returnflag")).alias("g"),
                    "l_linenumber", "l_partkey", "l_extendedprice", "l_shipdate")
    total = hot.count()
    order = ["l_linenumber", "l_partkey", "l_extendedprice", "l_shipdate"]
    w = Window.partitionBy("k").orderBy(*order)
    runs = {
        "window row_number (naive keep-first)":
            lambda: hot.withColumn("rn", F.row_number().over(w)).where("rn = 1"),
        "keep_first (min struct per key)": lambda: dedupe.keep_first(hot, ["k"], order),
        "window count (naive duplicate flag)":
            lambda: hot.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("k"))),
        "flag_duplicates (hot keys broadcast, rest joined)":
            lambda: dedupe.flag_duplicates(hot, ["k"], hot_rows=10_000),
        "window top-1000 per group (naive sample)":
            lambda: hot.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy(*order)))
            .where("r <= 1000"),
        "capped_sample (two-level, partial limits)": lambda: dedupe.capped_sample(hot, ["g"], order, 1000),
    }
    sc = spark.sparkContext
    for name, build in runs.items():
        sc.setJobGroup(name, name)
        build().write.format("noop").mode("overwrite").save()
    app = sc.applicationId
    spark.stop()

    stage_group: dict[int, str] = {}
    task_reads: dict[int, list[int]] = defaultdict(list)
    found = glob.glob(os.path.join(logdir, f"*{app}*"))[0]
    files = sorted(glob.glob(os.path.join(found, "events_*"))) if os.path.isdir(found) else [found]
    lines = (ln for f in files for ln in open(f))
    for line in lines:
        ev = json.loads(line)
        kind = ev.get("Event")
        if kind == "SparkListenerJobStart":
            group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
            for sid in ev.get("Stage IDs", []):
                if group:
                    stage_group[sid] = group
        elif kind == "SparkListenerTaskEnd":
            m = ev.get("Task Metrics") or {}
            rd = (m.get("Shuffle Read Metrics") or {})
            task_reads[ev["Stage ID"]].append(int(rd.get("Total Records Read", 0)))
    worst: dict[str, int] = defaultdict(int)
    for sid, reads in task_reads.items():
        g = stage_group.get(sid)
        if g:
            worst[g] = max(worst[g], max(reads))
    if os.environ.get("SKEW_DETAIL"):
        for sid in sorted(task_reads):
            r = sorted(task_reads[sid])
            if stage_group.get(sid) and r[-1]:
                print(f"stage {sid} {stage_group[sid][:40]:40s} tasks={len(r)} max={r[-1]} median={r[len(r) // 2]}")
    print(f"rows: {total:,}; hot key / group holds {total // 3:,} rows (a third)\n")
    print("| operator | largest shuffle read of one task (records) | share of all rows |")
    print("|---|---|---|")
    for name in runs:
        print(f"| {name} | {worst[name]:,} | {worst[name] / total:.1%} |")


if __name__ == "__main__":
    main()

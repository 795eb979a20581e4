"""Skew check: one asset holds a third of all readings; the ordered operators
must still spread it over many tasks.

Builds 3M one-second readings (asset 0: 1M rows over ~11.6 days; 200 other
assets share the rest), runs islands, the forward sliding average and the
trailing z-score, and reports per stage the task count and the largest task's
share of the stage's input records (from the event log). A hot key in one
task would show a share near 1/3 of all rows in a single task.

    python tools/skew_check.py
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

import bench  # noqa: E402
from sensorlake.operators import islands as isl  # noqa: E402
from sensorlake.operators import windows as wn  # noqa: E402
from sensorlake.session import get_spark  # noqa: E402


def main() -> None:
    scratch = tempfile.mkdtemp(prefix="sl-skew-")
    ev = os.path.join(scratch, "ev")
    os.makedirs(ev)
    spark = get_spark("local[8]", shuffle_partitions=32,
                      extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": ev,
                             "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    spark.sparkContext.setLogLevel("OFF")
    n = 3_000_000
    df = (spark.range(n, numPartitions=16)
               .select(F.when(F.col("id") < n // 3, F.lit(0)).otherwise(F.col("id") % 200 + 1).alias("asset_id"),
                       F.when(F.col("id") < n // 3, F.col("id")).otherwise(F.floor(F.col("id") / 200)).cast("long").alias("epoch"),
                       (F.sin(F.col("id") / 1000.0) * 10 + 50).alias("value")))
    path = os.path.join(scratch, "readings")
    df.write.parquet(path)
    r = spark.read.parquet(path)
    runs = {
        "islands": lambda: isl.islands(r.filter(F.col("value") > 55), ["asset_id"], "epoch", 1),
        "islands, 12-hour limit": lambda: isl.islands(r.filter(F.col("value") > 55), ["asset_id"], "epoch", 43_199),
        "forward_average": lambda: wn.forward_average(r, ["asset_id"], "epoch", "value", 600),
        "trailing_zscore_blocks": lambda: wn.trailing_zscore(r, ["asset_id"], "epoch", "value", 3600),
        "trailing_zscore_running": lambda: wn.trailing_zscore(r, ["asset_id"], "epoch", "value", 3600,
                                                              method="running"),
        "trailing_zscore_exact": lambda: wn.trailing_zscore(r, ["asset_id"], "epoch", "value", 3600,
                                                            method="exact"),
    }
    for name, fn in runs.items():
        spark.sparkContext.setJobGroup(name, name)
        t0 = time.time()
        fn().write.format("noop").mode("overwrite").save()
        print(f"{name}: {time.time() - t0:.1f}s")
    spark.stop()

    stage_group, tasks = {}, {}
    for line in bench._event_lines(ev):
        e = json.loads(line)
        if e.get("Event") == "SparkListenerJobStart":
            g = (e.get("Properties") or {}).get("spark.jobGroup.id")
            for sid in e.get("Stage IDs", []):
                stage_group[sid] = g
        elif e.get("Event") == "SparkListenerTaskEnd":
            tm = e.get("Task Metrics") or {}
            recs = (tm.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
            tasks.setdefault(e["Stage ID"], []).append(recs)
    print("stage group tasks max_task_records total_records max_share")
    for sid in sorted(tasks):
        recs = tasks[sid]
        tot = sum(recs)
        if tot < 100_000:
            continue
        print(sid, stage_group.get(sid), len(recs), max(recs), tot, round(max(recs) / tot, 3))


if __name__ == "__main__":
    main()

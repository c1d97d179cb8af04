"""Stage times of registered queries from Spark's event log (no UI needed).

usage: python scripts/stage_times.py SF_DIR QUERY [QUERY ...]

Runs the queries in a fresh local session whose event log goes to a new
scratch folder (``mktemp``-style, never reused), then prints, per query, the
summed stage time and stage count, and the slowest stages overall.
"""

from __future__ import annotations

import collections
import glob
import io
import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def read_events(log_dir: str):
    import zstandard
    for path in sorted(glob.glob(os.path.join(log_dir, "**", "events_*"), recursive=True)):
        with open(path, "rb") as fh:
            raw = zstandard.ZstdDecompressor().stream_reader(fh) if path.endswith(".zstd") else fh
            for line in io.TextIOWrapper(raw, encoding="utf-8"):
                yield json.loads(line)


def main():
    if len(sys.argv) < 3:
        sys.exit(__doc__)
    sf_dir, names = sys.argv[1], sys.argv[2:]
    log_dir = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    from pyspark.sql import SparkSession
    from panelgap.plans import catalog
    from panelgap.session import ensure_checkpoint_dir
    spark = (SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]")
             .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir).getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    qs = catalog.queries()
    wall = {}
    for n in names:
        spark.sparkContext.setJobGroup(n, n)
        t = time.perf_counter()
        qs[n](spark, sf_dir).collect()
        wall[n] = time.perf_counter() - t
    spark.stop()

    stage_query, stages = {}, {}
    for e in read_events(log_dir):
        if e["Event"] == "SparkListenerJobStart":
            group = (e.get("Properties") or {}).get("spark.jobGroup.id", "?")
            for s in e["Stage IDs"]:
                stage_query[s] = group
        elif e["Event"] == "SparkListenerStageCompleted":
            i = e["Stage Info"]
            stages[i["Stage ID"]] = ((i.get("Completion Time", 0) - i.get("Submission Time", 0)) / 1000,
                                     i["Number of Tasks"], i["Stage Name"][:70])
    per = collections.defaultdict(lambda: [0.0, 0])
    for sid, (dur, _, _) in stages.items():
        q = stage_query.get(sid, "?")
        per[q][0] += dur
        per[q][1] += 1
    print(f"event log: {log_dir}")
    for n in names:
        print(f"{n:28s} wall {wall[n]:6.2f}s  stage-time {per[n][0]:6.2f}s  stages {per[n][1]}")
    print("slowest stages:")
    for sid, (dur, tasks, name) in sorted(stages.items(), key=lambda kv: -kv[1][0])[:10]:
        print(f"  {dur:6.2f}s tasks={tasks:4d} {stage_query.get(sid, '?'):24s} {name}")


if __name__ == "__main__":
    main()

"""Per-query job/stage counts and the slowest stages, from Spark's event log.

Usage: python tools/stage_times.py SF_DIR QUERY [QUERY ...]

Runs each query (into the ``noop`` sink) with the event log written to a fresh
scratch folder (``mktemp -d``), then reads the log back: jobs and stages per
query, total job time, and every stage over 150 ms with its task count and
slowest task. No UI or REST endpoint is used.
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

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _events(log_dir: str) -> list[dict]:
    import zstandard

    out = []
    for path in glob.glob(f"{log_dir}/**/*", recursive=True):
        if not os.path.isfile(path) or "events" not in os.path.basename(path):
            continue
        raw = open(path, "rb").read()
        if path.endswith(".zstd"):
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        for line in raw.decode("utf-8", "replace").splitlines():
            try:
                out.append(json.loads(line))
            except ValueError:
                pass
    return out


def main() -> None:
    from pyspark.sql import SparkSession

    from kestrel.plans import QUERIES

    sf_dir, names = sys.argv[1], sys.argv[2:]
    log_dir = tempfile.mkdtemp(prefix="kestrel-evlog-", dir="/tmp")
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir)
             .config("spark.sql.shuffle.partitions", "16").getOrCreate())
    for name in names:
        spark.sparkContext.setJobGroup(name, name)
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        print(f"{name}: {time.time() - t0:.2f} s")
    spark.stop()

    evs = _events(log_dir)
    stage_group, job_start = {}, {}
    jobs, stages, job_ms = collections.Counter(), collections.Counter(), collections.Counter()
    tasks = collections.defaultdict(list)
    for e in evs:
        kind = e["Event"]
        if kind == "SparkListenerJobStart":
            group = e.get("Properties", {}).get("spark.jobGroup.id")
            jobs[group] += 1
            stages[group] += len(e["Stage IDs"])
            job_start[e["Job ID"]] = (group, e["Submission Time"])
            for sid in e["Stage IDs"]:
                stage_group[sid] = group
        elif kind == "SparkListenerJobEnd" and e["Job ID"] in job_start:
            group, t = job_start[e["Job ID"]]
            job_ms[group] += e["Completion Time"] - t
        elif kind == "SparkListenerTaskEnd":
            info = e["Task Info"]
            tasks[e["Stage ID"]].append(info["Finish Time"] - info["Launch Time"])
    for group in names:
        print(f"{group:28s} jobs={jobs[group]:3d} stages={stages[group]:3d} job_time={job_ms[group]} ms")
    for e in evs:
        if e["Event"] != "SparkListenerStageCompleted":
            continue
        info = e["Stage Info"]
        if "Completion Time" not in info or "Submission Time" not in info:
            continue
        ms = info["Completion Time"] - info["Submission Time"]
        if ms >= 150:
            t = tasks.get(info["Stage ID"], [])
            print(f"  {stage_group.get(info['Stage ID'])!s:26s} stage {info['Stage ID']:4d} {ms:6d} ms "
                  f"tasks={len(t):4d} slowest={max(t) if t else 0:6d} ms  {info['Stage Name'][:50]}")
    print(f"event log: {log_dir}")


if __name__ == "__main__":
    main()

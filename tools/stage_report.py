"""Shuffle volume and task skew per query, from Spark's event log.

Usage: python tools/stage_report.py [sf_dir] [query ...]
Runs each query into the noop sink with the event log written to a fresh
scratch folder (no UI, no server), then reads the JSON event log and prints,
per query: jobs, stages, tasks, shuffle write bytes, and for the stage with
the longest task the max/median task time ratio.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    names = sys.argv[2:] or ["card_features", "card_features_volume", "card_amount_q95", "roc_auc"]
    log_dir = tempfile.mkdtemp(prefix="cardlens-eventlog-")
    from cardlens.plans.queries import QUERIES
    from cardlens.session import get_session

    spark = get_session(
        "local[8]",
        16,
        app_name="cardlens-stage-report",
        extra_conf={
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": log_dir,
            "spark.eventLog.compress": "false",
        },
    )
    marks = []
    for name in names:
        spark.sparkContext.setJobGroup(name, name)
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        marks.append((name, time.perf_counter() - t0))
    spark.stop()

    (path,) = glob.glob(os.path.join(log_dir, "*"))
    files = sorted(glob.glob(os.path.join(path, "events_*"))) if os.path.isdir(path) else [path]
    job_group, stage_group = {}, {}
    tasks: dict[int, list[float]] = {}
    shuffle: dict[int, int] = {}
    lines = [ln for f in files for ln in open(f, encoding="utf-8")]
    for line in lines:
        if line.strip():
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                job_group[ev["Job ID"]] = group
                for sid in ev.get("Stage IDs", []):
                    stage_group[sid] = group
            elif kind == "SparkListenerTaskEnd":
                sid = ev["Stage ID"]
                info, metrics = ev.get("Task Info", {}), ev.get("Task Metrics") or {}
                tasks.setdefault(sid, []).append(info.get("Finish Time", 0) - info.get("Launch Time", 0))
                sw = (metrics.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                shuffle[sid] = shuffle.get(sid, 0) + sw
    detail = os.environ.get("STAGE_DETAIL")
    names_by_stage = {}
    for line in lines:
        if line.strip() and '"SparkListenerStageCompleted"' in line:
            info = json.loads(line)["Stage Info"]
            names_by_stage[info["Stage ID"]] = (info.get("Stage Name", ""), info.get("Details", "").split("\n")[0:1])
    for name, secs in marks:
        if detail == name:
            for s_ in sorted((s for s, g in stage_group.items() if g == name and s in tasks), key=lambda s: -max(tasks[s]))[:6]:
                print(name, "stage", s_, "tasks", len(tasks[s_]), "max_ms", max(tasks[s_]),
                      "median_ms", statistics.median(tasks[s_]), "shuffle", shuffle.get(s_, 0), names_by_stage.get(s_))
        stages = [s for s, g in stage_group.items() if g == name and s in tasks]
        n_tasks = sum(len(tasks[s]) for s in stages)
        sbytes = sum(shuffle.get(s, 0) for s in stages)
        worst = max(stages, key=lambda s: max(tasks[s]), default=None)
        skew = (
            max(tasks[worst]) / max(statistics.median(tasks[worst]), 1)
            if worst is not None
            else 0.0
        )
        jobs = sum(1 for g in job_group.values() if g == name)
        print(
            json.dumps(
                {
                    "query": name,
                    "seconds": round(secs, 3),
                    "jobs": jobs,
                    "stages": len(stages),
                    "tasks": n_tasks,
                    "shuffle_write_bytes": sbytes,
                    "worst_stage_max_over_median_task_ms": round(skew, 2),
                }
            )
        )


if __name__ == "__main__":
    main()

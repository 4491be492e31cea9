"""Session paths with one user holding a third of the rows: built-in vs chunked plan.

    python tools/skew_experiment.py [sf_dir] [copies] [gap_minutes] [stretch] [--stream]

The input is derived by Spark from the given ``events`` table: the mapped events
are replicated ``copies`` times (``explode(sequence(...))``), each copy shifted by
one day (the mapped data spans one day), optionally stretched in time
(``stretch``: offsets from the first event multiplied), and a third of the events
(by a hash of their fields) are re-keyed to one user.  With dense events the hot
user has one endless session -- one result row that any plan builds in one task;
with sparse events (e.g. gap 1, stretch 30) it has many sessions.  Prints, per plan, the wall time and the
largest task time (from Spark's event log in a fresh scratch folder), and whether
both plans return the same sessions.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DAY_MS = 86_400_000


def skewed_events(spark, sf: str, copies: int, stretch: int = 1):
    from pyspark.sql import functions as F

    from trailmark.operators import prepare_events
    from trailmark.sources.tables import events_table, web_events_from_table

    web = web_events_from_table(events_table(spark, sf))
    hot = F.pmod(F.xxhash64("timestamp", "eventType", "userId"), F.lit(3)) == 0
    web = web.withColumn("userId", F.when(hot, F.lit("hot-user")).otherwise(F.col("userId")))
    web = web.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    t0 = F.lit(1704067200000)
    shifted = t0 + (F.col("timestamp") - t0) * F.lit(stretch) + F.col("copy") * F.lit(DAY_MS * stretch)
    web = web.withColumn("timestamp", shifted).drop("copy")
    return prepare_events(web)


def task_times(log_dir: str) -> dict[str, int]:
    job_desc, stage_job, worst = {}, {}, {}
    for f in glob.glob(f"{log_dir}/**/*", recursive=True):
        if os.path.isdir(f):
            continue
        for line in open(f):
            e = json.loads(line)
            if e.get("Event") == "SparkListenerJobStart":
                job_desc[e["Job ID"]] = (e.get("Properties") or {}).get("spark.job.description", "")
                for sid in e.get("Stage IDs", []):
                    stage_job[sid] = e["Job ID"]
            elif e.get("Event") == "SparkListenerTaskEnd":
                ti = e["Task Info"]
                desc = job_desc.get(stage_job.get(e["Stage ID"]), "").split("\n")[0]  # streaming: query name first
                worst[desc] = max(worst.get(desc, 0), ti["Finish Time"] - ti["Launch Time"])
    return worst


def run_streams(spark, events, gap: int) -> dict[str, float]:
    """Streaming: per-user ``session_window`` state vs the spread (user, second, page) state."""
    from trailmark.operators import session_paths, with_event_watermark
    from trailmark.session import scratch_dir
    from trailmark.sources import read_events_files, write_events_json
    from trailmark.streaming.sessions import start_session_cells
    from trailmark.streaming.sinks import start_parquet_sink
    from trailmark.operators import prepare_events

    base = scratch_dir(spark, "skew-stream")
    write_events_json(events.drop("eventTime"), f"{base}/in")
    wall = {}
    for name in ("stream_session_window", "stream_spread_state"):
        spark.sparkContext.setJobDescription(name)
        src = prepare_events(read_events_files(spark, f"{base}/in", streaming=True))
        t0 = time.perf_counter()
        if name == "stream_session_window":
            q = start_parquet_sink(session_paths(with_event_watermark(src, gap), gap, strategy="session_window"),
                                   f"{base}/{name}", f"{base}/{name}_chk", trigger={"availableNow": True},
                                   query_name=name)
        else:
            q = start_session_cells(src, f"{base}/{name}", f"{base}/{name}_chk", gap, trigger={"availableNow": True},
                                    query_name=name)
        q.awaitTermination()
        wall[name] = round(time.perf_counter() - t0, 2)
    return wall


def main() -> None:
    from pyspark.sql import functions as F

    from trailmark.operators import session_paths
    from trailmark.session import build_session

    stream = "--stream" in sys.argv
    args = [a for a in sys.argv[1:] if a != "--stream"]
    sf = args[0] if len(args) > 0 else "/root/testdata/sf0.1"
    copies = int(args[1]) if len(args) > 1 else 10
    gap = int(args[2]) if len(args) > 2 else 30
    stretch = int(args[3]) if len(args) > 3 else 1
    log_dir = tempfile.mkdtemp(prefix="skew-eventlog-")
    spark = build_session("local[8]", shuffle_partitions=32, extra={
        "spark.ui.showConsoleProgress": "false", "spark.eventLog.enabled": "true",
        "spark.eventLog.dir": log_dir, "spark.eventLog.compress": "false"})
    events = skewed_events(spark, sf, copies, stretch)
    rows = events.count()
    hot_rows = events.filter(F.col("userId") == "hot-user").count()
    wall = run_streams(spark, events, gap) if stream else {}
    for strategy in ("session_window", "chunked"):
        spark.sparkContext.setJobDescription(strategy)
        t0 = time.perf_counter()
        session_paths(events, gap, strategy=strategy).write.format("noop").mode("overwrite").save()
        wall[strategy] = round(time.perf_counter() - t0, 2)
    spark.sparkContext.setJobDescription("compare")
    a = session_paths(events, gap, strategy="session_window")
    b = session_paths(events, gap, strategy="chunked")
    sessions = b.count()
    hot_sessions = b.filter(F.col("userId") == "hot-user").count()
    same = a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    spark.stop()
    worst = task_times(log_dir)
    print(json.dumps({"rows": rows, "hot_user_rows": hot_rows, "copies": copies, "gap_minutes": gap,
                      "stretch": stretch, "sessions": sessions, "hot_user_sessions": hot_sessions,
                      "same_sessions": same,
                      "wall_sec": wall, "max_task_ms": {k: worst.get(k) for k in wall}}))


if __name__ == "__main__":
    main()

"""Explain every batch contract query and summarise the plan facts that matter at scale.

    python tools/explain_all.py [sf_dir] > PLANS.md

For each query: scans with their pushed filters and read schema, shuffles
(Exchange), broadcasts, joins, windows, sorts and aggregates of the physical plan
Spark chooses before execution (AQE may still coalesce or switch joins at run time).
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from trailmark.plans.contract import queries  # noqa: E402

STREAMING = ("stream_", "snapshot_", "delta_", "quarantine_bad", "jsonl_source")


def explain(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summarise(name: str, text: str) -> list[str]:
    tree = text.split("\n\n")[0]
    ops = re.findall(r"[+:\- ]*([A-Z][A-Za-z]+)(?: [A-Za-z]+)* \(\d+\)", tree)
    count = {}
    for op in ops:
        count[op] = count.get(op, 0) + 1
    lines = [f"### `{name}`", ""]
    keep = ["Exchange", "BroadcastExchange", "BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin",
            "Window", "Sort", "HashAggregate", "ObjectHashAggregate", "SortAggregate", "TakeOrderedAndProject"]
    lines.append("Operators: " + ", ".join(f"{k} x{count[k]}" for k in keep if k in count))
    for m in re.finditer(r"\(\d+\) Scan parquet[^\n]*\n(.*?)(?:\n\n|\Z)", text, re.S):
        block = m.group(1)
        pushed = re.search(r"PushedFilters: (.*)", block)
        schema = re.search(r"ReadSchema: (.*)", block)
        lines.append(f"- Scan: PushedFilters {pushed.group(1) if pushed else '[]'}; "
                     f"ReadSchema `{schema.group(1) if schema else '?'}`")
    for m in re.finditer(r"Arguments: ((?:hash|range)partitioning\(.*?\d+\)|RoundRobinPartitioning\(\d+\)"
                         r"|SinglePartition)", text):
        lines.append(f"- Exchange: `{re.sub(r'#[0-9]+L?', '', m.group(1))}`")
    lines.append("")
    return lines


def streaming_plans(spark) -> list[str]:
    """Physical plans of the streaming queries (explained, not started)."""
    from pyspark.sql import functions as F

    from trailmark.operators import prepare_events
    from trailmark.operators.events import fill_event_defaults, with_event_watermark
    from trailmark.session import scratch_dir
    from trailmark.sources import read_events_files
    from trailmark.streaming.pipeline import build_queries

    src = scratch_dir(spark, "explain-input")
    spark.range(0).write.mode("overwrite").json(src)  # an existing, empty input folder
    events = prepare_events(read_events_files(spark, src, streaming=True))
    plans = dict(build_queries(events, 30))
    wm = with_event_watermark(events, 30)
    plans["paths (spread state)"] = wm.filter(F.col("eventTime").isNotNull()).groupBy(
        "userId", "eventTime", "pageUrl").count()
    plans["user paths (bounded state)"] = fill_event_defaults(wm).filter(F.col("pageUrl") != "").groupBy(
        "userId", F.window("eventTime", "1 minute")).agg(F.collect_set(F.struct("timestamp", "pageUrl")))
    out = ["## Streaming plans", "",
           "The state operators (`StateStoreRestore/Save`, `SessionWindowStateStore*`) sit after a partial",
           "aggregate and one hash exchange; the click/error filters sit below `EventTimeWatermark`.", ""]
    for name, df in plans.items():
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        tree = [re.sub(r"#[0-9]+L?|-T[0-9]+ms", "", ln)[:160] for ln in buf.getvalue().splitlines()
                if ln.strip() and not ln.startswith("==")]
        out += [f"### `{name}`", "", "```", *tree, "```", ""]
    return out


def reused_exchange(spark, sf: str) -> list[str]:
    """The exchanges and scans that the session plan ran (AQE's final plan)."""
    df = queries()["session_paths_30m"](spark, sf)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    lines = [re.sub(r"#[0-9]+L?|, \[plan_id=\d+\]", "", line.strip(" :+-"))[:150] for line in final.splitlines()
             if re.search("Exchange|Scan parquet|Join", line)]
    return ["### `session_paths_30m`, as run", "", "```", *lines, "```", ""]


def main() -> None:
    from trailmark.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=16, extra={"spark.ui.showConsoleProgress": "false"})
    out = ["# Physical plans of the batch queries", "",
           f"Generated by `python tools/explain_all.py {sf}` (Spark {spark.version}, plans before AQE).", "",
           "What to check: click/error filters appear as `PushedFilters` on the Parquet scan; `ReadSchema`",
           "lists only the columns a query needs; aggregates are partial + final around one hash exchange;",
           "the session plan joins its per-(user, chunk) rows with a shuffled hash join (they grow with the",
           "data, so they are never broadcast) and re-partitions by (user, session start) before building",
           "paths, so no task holds a whole user.  Both branches of that join are the same subtree here; at",
           "run time the second one is a `ReusedExchange` of the first (shown at the end).", ""]
    for name, q in queries().items():
        if name.startswith(STREAMING):
            continue
        out += summarise(name, explain(q(spark, sf)))
    out += reused_exchange(spark, sf)
    out += streaming_plans(spark)
    print("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()

"""Command line of the streaming job (J2, J3), for ``spark-submit``.

    spark-submit --py-files trailmark.zip run_job.py --inputPath=/data/clicks --outputPath=/data/results \
        --checkpointPath=/data/state --trigger="1 minute" --errorsSink=parquet_updates --allTime
"""

from __future__ import annotations

import sys

from .session import STATE_STORE

# Option names and defaults of the reference job.
DEFAULT_OPTIONS = {
    "source": "files",
    "inputPath": "./data/events",
    "outputPath": "./out",
    "checkpointPath": "./chk",
    "sessionTimeoutMinutes": "30",
    "kafkaBrokers": "localhost:9092",
    "kafkaTopic": "webevents",
    "kafkaStartingOffsets": "earliest",
}
# The reference reads exactly one new file per trigger; here it is an option
# (unset = every new file in the next trigger), e.g. --maxFilesPerTrigger=1.
# --trigger=availableNow processes what is there and stops; --trigger="5 seconds"
# sets a processing-time trigger; unset = Spark's default (as the reference).
# --sessionState=spread keeps the open sessions as a table spread over (user, second, page) instead of
# a state entry per user (see trailmark.streaming.open_sessions); cells writes the counts only.
# --heatmapSink, --pathsSink, --errorsSink choose parquet, parquet_updates, parquet_upserts (not for paths) or console.
# --allTime also writes the all-time snapshots of paths and heatmap; --allTime=deltas keeps them as stores of deltas.
# --report prints the busiest cells, errors by page and a preview of paths with every trigger.
# --pathOrder=arrival keeps the paths of --allTime=deltas and --report in the order of the topic.
# --quarantine keeps records that cannot be read, with reasons.
# --maxLeadMinutes=N gives no event time to rows more than N minutes ahead of their arrival.
# --kafkaOption.NAME=VALUE goes to the Kafka source (maxOffsetsPerTrigger, minPartitions, failOnDataLoss).
# --maxEventTime="2100-01-01" nulls event times after that instant, so one absurd
# timestamp cannot push the watermarks past all real data.


EXTRA_OPTIONS = {"maxFilesPerTrigger", "trigger", "sessionState", "maxEventTime", "heatmapSink", "pathsSink", "errorsSink",
                 "allTime", "report", "quarantine", "maxLeadMinutes", "pathOrder"}
KAFKA_PREFIX = "kafkaOption."


def trigger_of(value: str | None) -> dict | None:
    if not value:
        return None
    if value == "availableNow":
        return {"availableNow": True}
    return {"processingTime": value}


def parse_args(argv: list[str]) -> dict[str, str]:
    """``--k=v`` -> k: v (split on the first ``=``); bare ``--flag`` -> "true";
    entries without the ``--`` prefix are ignored; the last occurrence wins."""
    out: dict[str, str] = {}
    for arg in argv:
        if not arg.startswith("--"):
            continue
        key, sep, value = arg[2:].partition("=")
        if sep:
            out[key] = value
        elif key:
            out[key] = "true"
    return out


def options(argv: list[str]) -> dict[str, str]:
    """Parsed options over the defaults."""
    return {**DEFAULT_OPTIONS, **parse_args(argv)}


def check_options(opts: dict[str, str]) -> None:
    unknown = sorted(k for k in opts if k not in DEFAULT_OPTIONS and k not in EXTRA_OPTIONS and not k.startswith(KAFKA_PREFIX))
    if unknown:
        raise ValueError(f"unknown options: {', '.join('--' + k for k in unknown)}")


def job_session():
    """The session the job needs: UTC, and a state store that does not live on the heap."""
    from pyspark.sql import SparkSession

    return (
        SparkSession.builder.appName("trailmark")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
        .getOrCreate()
    )


def main(argv: list[str] | None = None) -> None:
    from .streaming.pipeline import await_all, await_any, rejected_so_far, run_pipeline

    opts = options(sys.argv[1:] if argv is None else argv)
    check_options(opts)
    queries = run_pipeline(
        job_session(),
        source=opts["source"],
        output_path=opts["outputPath"],
        checkpoint_path=opts["checkpointPath"],
        session_timeout_minutes=int(opts["sessionTimeoutMinutes"]),
        input_path=opts["inputPath"],
        brokers=opts["kafkaBrokers"],
        topic=opts["kafkaTopic"],
        starting_offsets=opts["kafkaStartingOffsets"],
        options={k.removeprefix(KAFKA_PREFIX): v for k, v in opts.items() if k.startswith(KAFKA_PREFIX)},
        max_files_per_trigger=int(opts["maxFilesPerTrigger"]) if opts.get("maxFilesPerTrigger") else None,
        trigger=trigger_of(opts.get("trigger")),
        sinks={q: opts[f"{q}Sink"] for q in ("heatmap", "paths", "errors") if f"{q}Sink" in opts},
        session_state=opts.get("sessionState", "per_user"),
        max_event_time=opts.get("maxEventTime"),
        all_time={None: False, "false": False, "true": True}.get(opts.get("allTime"), opts.get("allTime")),
        report=opts.get("report") == "true",
        quarantine=opts.get("quarantine") == "true",
        max_lead_minutes=float(opts["maxLeadMinutes"]) if opts.get("maxLeadMinutes") else None,
        path_order=opts.get("pathOrder", "time"),
    )
    try:
        if opts.get("trigger") == "availableNow":
            await_all(queries)
        else:
            await_any(queries)
    finally:
        print("rows and records set aside:", rejected_so_far(queries))


if __name__ == "__main__":
    main()

"""Kafka: event stream source (S2), value decode (S3, S4), encode and publish (K8).

The connector jar (``spark-sql-kafka``) must be on the classpath for the read and
write calls; the codec functions work on any DataFrame with a ``value`` column and
are what the tests exercise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import ARRIVAL_OFFSET, ARRIVAL_PARTITION, ARRIVAL_TIME, EVENT_COLUMNS, EVENT_SCHEMA


def read_events_kafka_raw(
    spark: SparkSession,
    brokers: str,
    topic: str,
    starting_offsets: str = "earliest",
    streaming: bool = True,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Kafka rows (``key, value, topic, partition, offset, timestamp, ...``).

    ``failOnDataLoss`` is off as in the reference, so offsets that the broker has dropped are
    skipped in silence; ``options={"failOnDataLoss": "true"}`` fails instead.
    """
    reader = spark.readStream if streaming else spark.read
    reader = (
        reader.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", "false")
    )
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load()


def decode_events(df: DataFrame, value_col: str = "value", with_arrival: bool = False, with_position: bool = False) -> DataFrame:
    """S3 + S4: ``CAST(value AS STRING)`` -> ``from_json`` (explicit schema) -> 11 columns.

    A value that is not a JSON object gives an all-NULL row.  ``with_arrival`` adds ``arrivalTime``, the
    broker's ``timestamp``; ``with_position`` adds ``arrivalPartition`` and ``arrivalOffset``, the record's place in
    the topic.
    """
    parsed = F.from_json(F.col(value_col).cast("string"), EVENT_SCHEMA)
    extra = {ARRIVAL_TIME: F.col("timestamp").cast("timestamp")} if with_arrival else {}
    if with_position:
        extra |= {ARRIVAL_PARTITION: F.col("partition").cast("int"), ARRIVAL_OFFSET: F.col("offset").cast("long")}
    return df.select(parsed.alias("data"), *[c.alias(name) for name, c in extra.items()]).select("data.*", *extra)


def read_events_kafka(
    spark: SparkSession,
    brokers: str,
    topic: str,
    starting_offsets: str = "earliest",
    streaming: bool = True,
    options: dict[str, str] | None = None,
    with_arrival: bool = False,
    with_position: bool = False,
) -> DataFrame:
    """S2 -> S4: the event stream of a topic."""
    records = read_events_kafka_raw(spark, brokers, topic, starting_offsets, streaming, options)
    return decode_events(records, with_arrival=with_arrival, with_position=with_position)


def encode_events(events: DataFrame, key_col: str | None = "userId") -> DataFrame:
    """K8 codec: ``key, value`` with ``value`` = the event as a JSON object.

    The reference publishes with a NULL key, which spreads one user over all topic
    partitions; keying by user keeps a user's events ordered in one partition.
    Pass ``key_col=None`` for the reference's NULL key.
    """
    value = F.to_json(F.struct(*[F.col(c) for c in EVENT_COLUMNS])).cast("binary")
    key = F.col(key_col).cast("binary") if key_col else F.lit(None).cast("binary")
    return events.select(key.alias("key"), value.alias("value"))


def start_events_kafka_sink(
    events: DataFrame,
    brokers: str,
    topic: str,
    checkpoint: str,
    key_col: str | None = "userId",
    trigger: dict | None = None,
):
    """K8 (streaming): publish a stream of events to ``topic``."""
    w = (
        encode_events(events, key_col)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def write_events_kafka(events: DataFrame, brokers: str, topic: str, key_col: str | None = "userId") -> None:
    """K8 (batch): publish events to ``topic``."""
    (
        encode_events(events, key_col)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("topic", topic)
        .save()
    )

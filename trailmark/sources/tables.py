"""The driver's ``events`` table seen as web events.

The table has no page, element or coordinates and spreads 30 days of events so
thin that 30-minute sessions are single events.  This mapping derives the missing
fields from existing columns and compresses time 30:1, so every analysis has
real work to do; some rows lack a user, time, page, element or coordinate, and some
coordinates are negative.  It is a projection only (no shuffle); Catalyst prunes the
columns a query does not use and pushes filters into the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import EVENT_COLUMNS
from ..session import ensure_utc

# Fixed values of the test mapping: time origin (2024-01-01T00:00:00Z, ms) and
# compression factor, page URL stem and count, the "no page" marker, element
# prefix and count, x/y ranges, y multiplier, and screen sizes by user_id % 3.
MAP_EPOCH_MS = 1704067200000
MAP_TIME_COMPRESSION = 30
MAP_PAGE_STEM = "https://site.example/p"
MAP_PAGES = 5
MAP_NO_PAGE_K = 99
MAP_NO_USER_K = 98
# event_id modulus and remainder of rows without a time, without and with an empty element, without x
MAP_NO_TIME = (101, 7)
MAP_NO_ELEMENT = (23, 5)
MAP_EMPTY_ELEMENT = (23, 6)
MAP_NO_X = (29, 3)
# coordinates start below zero
MAP_X_FROM = -60
MAP_Y_FROM = -40
MAP_ELEMENT_STEM = "#e"
MAP_ELEMENTS = 2
MAP_X_RANGE = 200
MAP_Y_RANGE = 150
MAP_Y_MULTIPLIER = 37
MAP_SCREENS = [(1280, 800), (1440, 900), (1920, 1080)]


def events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def stream_events_table(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The same table as a stream of its Parquet files (one file, or a folder of files)."""
    path = f"{sf_dir.rstrip('/')}/events.parquet"
    raw = spark.read.parquet(path)
    first = raw.select("_metadata.file_path").first()
    reader = spark.readStream.schema(raw.schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if first is None or not first[0].endswith("/events.parquet"):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir.rstrip("/"))


# Arrivals in four batches of six compressed hours, up to 96 minutes late.
ARRIVAL_BATCHES = 4
ARRIVAL_BATCH_MS = 6 * 3_600_000
ARRIVAL_DELAYS_MINUTES = 97


def arrivals(raw: DataFrame, batch: int) -> DataFrame:
    """The rows of ``events`` that arrive in a batch: event time plus a delay of the row's own."""
    at = (f"(unix_millis(cast(ts AS timestamp)) - {MAP_EPOCH_MS}) div {MAP_TIME_COMPRESSION}"
          f" + event_id % {ARRIVAL_DELAYS_MINUTES} * 60000")
    return raw.filter(f"greatest(0, least({ARRIVAL_BATCHES - 1}, ({at}) div {ARRIVAL_BATCH_MS})) = {batch}")


def _screen(i: int) -> str:
    whens = " ".join(f"WHEN {n} THEN {dims[i]}" for n, dims in enumerate(MAP_SCREENS))
    return f"CASE user_id % {len(MAP_SCREENS)} {whens} END"


def _is(rule: tuple[int, int]) -> str:
    return f"event_id % {rule[0]} = {rule[1]}"


# One SQL expression per event field (a single ``selectExpr``: one analysis pass).
_MAPPING = [
    f"CASE WHEN k IS NULL OR k <> {MAP_NO_USER_K} THEN concat('u', cast(user_id AS string)) END AS userId",
    f"CASE WHEN NOT {_is(MAP_NO_TIME)} THEN "
    f"{MAP_EPOCH_MS} + (unix_millis(cast(ts AS timestamp)) - {MAP_EPOCH_MS}) div {MAP_TIME_COMPRESSION} END AS timestamp",
    "event_type AS eventType",
    f"CASE WHEN k = {MAP_NO_PAGE_K} THEN NULL ELSE concat('{MAP_PAGE_STEM}', cast(k % {MAP_PAGES} AS string)) END"
    " AS pageUrl",
    "'' AS referrer",
    f"CASE WHEN {_is(MAP_NO_ELEMENT)} THEN NULL WHEN {_is(MAP_EMPTY_ELEMENT)} THEN '' "
    f"ELSE concat('{MAP_ELEMENT_STEM}', cast(event_id % {MAP_ELEMENTS} AS string)) END AS element",
    f"CASE WHEN event_type = 'click' AND NOT {_is(MAP_NO_X)} THEN cast(floor(value) AS int) % {MAP_X_RANGE} + {MAP_X_FROM} END AS x",
    f"CASE WHEN event_type = 'click' THEN cast((event_id * {MAP_Y_MULTIPLIER}) % {MAP_Y_RANGE} AS int) + {MAP_Y_FROM} END AS y",
    f"{_screen(0)} AS screenWidth",
    f"{_screen(1)} AS screenHeight",
    "props AS meta",
]


def web_events_from_table(raw: DataFrame, *extra: str) -> DataFrame:
    """``event_id, ts, user_id, event_type, value, props`` -> the 11 event fields (and ``extra`` expressions)."""
    with_k = raw.selectExpr("*", "cast(get_json_object(props, '$.k') AS int) AS k")
    return with_k.selectExpr(*_MAPPING, *extra)


# A third of the rows belong to this user in the tests of a hot key.
HOT_USER, HOT_SHARE = "u_hot", 3


def hot_web_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web events of which every third (by event_id) is of one user."""
    ensure_utc(spark)
    rows = web_events_from_table(events_table(spark, sf_dir), f"event_id % {HOT_SHARE} = 0 AS hot")
    user = F.when(F.col("hot"), F.lit(HOT_USER)).otherwise(F.col("userId"))
    return rows.withColumn("userId", user).select(*EVENT_COLUMNS)


# Planted damage by event_id (modulus, remainder): a record cut off, one that is no object, one with bad fields.
CUT_OFF, NO_OBJECT, BAD_FIELDS = (41, 1), (43, 2), (47, 3)


def damaged_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as JSON records (column ``value``), some of them damaged."""
    ensure_utc(spark)
    rows = web_events_from_table(events_table(spark, sf_dir), "event_id", "user_id")
    record = F.to_json(F.struct(*EVENT_COLUMNS))
    ident = F.col("event_id").cast("string")
    value = (
        F.when(F.expr(_is(CUT_OFF)), F.concat(F.lit('{"userId":"u'), F.col("user_id").cast("string"), F.lit('","timestamp":')))
        .when(F.expr(_is(NO_OBJECT)), F.concat(F.lit('"event '), ident, F.lit('"')))
        .when(F.expr(_is(BAD_FIELDS)), F.concat(F.lit('{"userId":"u'), F.col("user_id").cast("string"), F.lit('","timestamp":"t'), ident, F.lit('","eventType":"view","x":"wide"}')))
        .otherwise(record))
    return rows.select(value.alias("value"))


# Fixed values of the planted positions: partitions of the topic, and a permutation of event_id inside blocks of a prime.
TOPIC_PARTITIONS, OFFSET_BLOCK, OFFSET_STEP = 4, 1_000_003, 7_919


def topic_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as records of a topic keyed by user (``value, partition, offset``), in an order unlike that of their times;
    every seventh record is there twice."""
    ensure_utc(spark)
    rows = web_events_from_table(
        events_table(spark, sf_dir), f"cast(user_id % {TOPIC_PARTITIONS} AS int) AS partition",
        f"event_id div {OFFSET_BLOCK} * {OFFSET_BLOCK} + event_id * {OFFSET_STEP} % {OFFSET_BLOCK} AS offset",
        "explode(sequence(0, CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END)) AS copy")
    return rows.select(F.to_json(F.struct(*EVENT_COLUMNS)).cast("binary").alias("value"), "partition", F.col("offset").cast("long"))


def web_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web events of ``<sf_dir>/events.parquet`` (session time zone forced to UTC)."""
    ensure_utc(spark)
    return web_events_from_table(events_table(spark, sf_dir)).select(*EVENT_COLUMNS)


def stream_web_events(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming counterpart of ``web_events``."""
    ensure_utc(spark)
    return web_events_from_table(stream_events_table(spark, sf_dir, max_files_per_trigger)).select(*EVENT_COLUMNS)

"""Event model: the 11-field web event and the names of derived columns."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values that must equal the reference job's behaviour.
# Field names, types and order of one web event (one JSON object per line / message).
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("userId", T.StringType(), False),
        T.StructField("timestamp", T.LongType(), False),  # epoch milliseconds
        T.StructField("eventType", T.StringType(), False),
        T.StructField("pageUrl", T.StringType(), True),
        T.StructField("referrer", T.StringType(), True),
        T.StructField("element", T.StringType(), True),
        T.StructField("x", T.IntegerType(), True),
        T.StructField("y", T.IntegerType(), True),
        T.StructField("screenWidth", T.IntegerType(), True),
        T.StructField("screenHeight", T.IntegerType(), True),
        T.StructField("meta", T.StringType(), True),
    ]
)

# Analysis constants of the reference job.
CLICK = "click"
ERROR = "error"
HEATMAP_WINDOW = "10 minutes"
ERROR_WINDOW = "5 minutes"
BUCKET_SIZE = 50
DEFAULT_SESSION_GAP_MINUTES = 30
PATH_SEPARATOR = " -> "
TOP_HEATMAP_CELLS = 10
PREVIEW_USERS = 5

# Defaults used by the all-time (non-windowed) results for missing fields.
MISSING_USER = "?"
MISSING_PAGE = ""
MISSING_ELEMENT = "body"
MISSING_EVENT_TYPE = ""
MISSING_COORDINATE = 0

EVENT_COLUMNS = [f.name for f in EVENT_SCHEMA.fields]
EVENT_TIME = "eventTime"

HEATMAP_KEYS = ["pageUrl", "element", "xBucket", "yBucket"]

#: When a record reached its source: the broker's time, or the time its file was written.
ARRIVAL_TIME = "arrivalTime"

#: Where a record lies in its source: partition and offset of the topic.
ARRIVAL_PARTITION, ARRIVAL_OFFSET = "arrivalPartition", "arrivalOffset"

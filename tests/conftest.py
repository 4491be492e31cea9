from __future__ import annotations

import os
import sys
import tempfile

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from trailmark.schema import EVENT_SCHEMA  # noqa: E402
from trailmark.session import build_session  # noqa: E402

T0 = 1_704_067_200_000  # 2024-01-01T00:00:00Z in ms
MIN = 60_000


@pytest.fixture(scope="session")
def spark():
    chk = tempfile.mkdtemp(prefix="trailmark-test-chk-")
    s = build_session(
        "local[4]",
        app_name="trailmark-tests",
        shuffle_partitions=8,
        extra={"spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": chk},
    )
    yield s
    s.stop()


def ev(userId="u1", timestamp=T0, eventType="view", pageUrl="p1", element="#e", x=None, y=None,
       referrer="", screenWidth=1280, screenHeight=800, meta="{}"):
    """One event row in EVENT_SCHEMA order."""
    return (userId, timestamp, eventType, pageUrl, referrer, element, x, y, screenWidth, screenHeight, meta)


# Sources give every field as nullable (the declared NOT NULL is documentation only).
NULLABLE_SCHEMA = T.StructType([T.StructField(f.name, f.dataType, True) for f in EVENT_SCHEMA.fields])


def events_df(spark, rows):
    return spark.createDataFrame(rows, NULLABLE_SCHEMA)


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="trailmark-test-")

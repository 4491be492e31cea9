"""Sample events (S6) as a Spark job: ``range(rounds)`` x a fixed template."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import EVENT_SCHEMA

# The sample generator's template (per round: user, ms offset, type,
# page, element, x, y, screen width, screen height), round spacing and lead time.
SAMPLE_BASE_URL = "http://localhost/sandbox"
SAMPLE_TEMPLATE = [
    ("u1", 0, "view", f"{SAMPLE_BASE_URL}/page1", "body", None, None, 1280, 800),
    ("u1", 50, "click", f"{SAMPLE_BASE_URL}/page1", "#btn-cta", 300, 400, 1280, 800),
    ("u2", 100, "view", f"{SAMPLE_BASE_URL}/page2", "body", None, None, 1440, 900),
]
SAMPLE_ROUNDS = 5
SAMPLE_STEP_MS = 500
SAMPLE_LEAD_MS = 5000


def generate_events(spark: SparkSession, start_ms: int, rounds: int = SAMPLE_ROUNDS) -> DataFrame:
    """``rounds`` x 3 events; round ``i`` starts at ``start_ms - 5000 + 500*i``.

    Deterministic (no wall clock) and distributed: every round is a row of
    ``spark.range``, exploded against the template.
    """
    template = F.array(
        *[
            F.struct(
                F.lit(u).alias("userId"),
                F.lit(off).cast("long").alias("off"),
                F.lit(ty).alias("eventType"),
                F.lit(page).alias("pageUrl"),
                F.lit(el).alias("element"),
                F.lit(x).cast("int").alias("x"),
                F.lit(y).cast("int").alias("y"),
                F.lit(w).cast("int").alias("screenWidth"),
                F.lit(h).cast("int").alias("screenHeight"),
            )
            for (u, off, ty, page, el, x, y, w, h) in SAMPLE_TEMPLATE
        ]
    )
    rows = spark.range(rounds).select(F.col("id").alias("i"), F.explode(template).alias("e"))
    ts = F.lit(start_ms - SAMPLE_LEAD_MS) + F.col("i") * F.lit(SAMPLE_STEP_MS) + F.col("e.off")
    out = rows.select(
        F.col("e.userId").alias("userId"),
        ts.cast("long").alias("timestamp"),
        F.col("e.eventType").alias("eventType"),
        F.col("e.pageUrl").alias("pageUrl"),
        F.lit("").alias("referrer"),
        F.col("e.element").alias("element"),
        F.col("e.x").alias("x"),
        F.col("e.y").alias("y"),
        F.col("e.screenWidth").alias("screenWidth"),
        F.col("e.screenHeight").alias("screenHeight"),
        F.lit("{}").alias("meta"),
    )
    return out.select(*[F.col(f.name).cast(f.dataType) for f in EVENT_SCHEMA.fields])

"""Records that cannot be read, kept instead of lost.

The permissive parse turns a malformed record into an all-NULL row, which every result then drops, and
a field of the wrong type into a NULL field.  ``check_records`` parses each record once with the
event schema and once as a map of texts, and compares: a record that is no JSON object is *malformed*, and a
field that is given but came out NULL has a *reason*, ``<field>: not a <type>``.

* ``good_events`` -- the event rows (11 fields).  Malformed records are left out; a record with bad
  fields stays, with those fields NULL, as before.
* ``bad_records`` -- the records with their reasons, malformed ones and those with bad fields.
* ``count_reasons`` -- records per reason.

``start_quarantine`` keeps bad records of a stream in Parquet beside the job's results, one row per
record and exactly once through its checkpoint.  Everything is an expression on the row: no shuffle, no
UDF; the counts are a partial aggregate.  Both parses are generated columns: a column that ``withColumn`` adds is
written out wherever it is used, filters included, and a record would be parsed anew for every field.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..schema import EVENT_COLUMNS, EVENT_SCHEMA

MALFORMED = "not a JSON object"


def _given(name: str) -> Column:
    """Whether the record has a value for a field (a JSON null is none)."""
    return F.col("__texts")[name].isNotNull()


def check_records(records: DataFrame, value_col: str = "value") -> DataFrame:
    """Adds ``data`` (the event, NULL if malformed) and ``reasons`` (empty for a good record) to ``records``.

    A blank record counts as malformed, as ``from_json`` reads it.
    """
    text = F.col(value_col).cast("string")
    parses = F.struct(F.from_json(text, "map<string,string>"), F.from_json(text, EVENT_SCHEMA))
    parsed = records.select("*", F.inline(F.array(parses)).alias("__texts", "__data"))
    malformed = F.col("__texts").isNull()
    wrong = [
        F.when(_given(f.name) & F.col("__data")[f.name].isNull(), F.lit(f"{f.name}: not a {f.dataType.simpleString()}"))
        for f in EVENT_SCHEMA.fields
    ]
    reasons = F.when(malformed, F.array(F.lit(MALFORMED))).otherwise(F.array_compact(F.array(*wrong)))
    return parsed.withColumn("data", F.when(~malformed, F.col("__data"))).withColumn("reasons", reasons).drop("__texts", "__data")


def good_events(checked: DataFrame) -> DataFrame:
    """The 11 event fields of every record that is a JSON object."""
    return checked.filter(F.col("data").isNotNull()).select("data.*").select(*EVENT_COLUMNS)


def bad_records(checked: DataFrame, value_col: str = "value") -> DataFrame:
    """``record, reasons`` of every record that lost something."""
    return checked.filter(F.size("reasons") > 0).select(F.col(value_col).cast("string").alias("record"), "reasons")


def count_reasons(checked: DataFrame) -> DataFrame:
    """``reason, records``: how many records have each reason (a record with two counts in both)."""
    return checked.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("records"))


def read_records(spark: SparkSession, path: str, streaming: bool = True, max_files_per_trigger: int | None = None) -> DataFrame:
    """Files of lines as records (column ``value``); blank lines are passed over, as the JSON reader does."""
    reader = spark.readStream if streaming else spark.read
    if streaming and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.text(path).filter(F.trim("value") != "")


def start_quarantine(records: DataFrame, out: str, checkpoint: str, value_col: str = "value", trigger: dict | None = None) -> StreamingQuery:
    """Append the bad records of a stream (``record, reasons``) to Parquet; the good ones' counts are observed as ``records``.

    ``spark.read.parquet(out)`` gives the records; ``count_reasons`` on them the counts.
    """
    checked = check_records(records, value_col).observe(
        "records", F.count(F.lit(1)).alias("read"), F.count(F.when(F.size("reasons") > 0, 1)).alias("bad"),
        F.count(F.when(F.col("data").isNull(), 1)).alias("malformed"))
    w = bad_records(checked, value_col).writeStream.outputMode("append").format("parquet").option("path", out)
    w = w.option("checkpointLocation", checkpoint)
    return (w.trigger(**trigger) if trigger else w).start()

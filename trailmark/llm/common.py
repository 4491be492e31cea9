"""Helpers shared by the training-data operators."""

from __future__ import annotations

from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..session import remove_path, scratch_dir

#: Rows of one numbering block: the most that one window group holds.
BLOCK_ROWS = 65_536


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Where the tables of ``stored`` lie.
_PATHS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def stored(df: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """Write ``df`` once below the shared checkpoint folder and read it back.

    Cuts the lineage at a table that survives a lost executor; the schema is passed
    on, so an empty table reads back too.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    out = spark.read.schema(T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema])).parquet(path)
    _PATHS[out] = path
    return out


def dropped(df: DataFrame) -> None:
    """Remove a table of ``stored`` that nothing will read again."""
    remove_path(df.sparkSession, _PATHS.pop(df))


def text_key() -> Column:
    """With doc_id, what tells rows apart in joins: a hash of the text."""
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def keep_rows(docs: DataFrame, winners: DataFrame) -> DataFrame:
    """The rows of ``docs`` named by ``winners`` (doc_id, row_key), one of each; all columns of ``docs``.

    Rows meet on a hash of both, so no key is hot beyond repeated rows; null ids match.
    """
    key = ["__keep_id", "__keep_none", "__keep_key"]
    none, some = F.col("doc_id").isNull(), F.coalesce(F.col("doc_id").cast("long"), F.lit(0))
    named = winners.select(some.alias(key[0]), none.alias(key[1]), F.col("row_key").alias(key[2])).distinct()
    rows = docs.select("*", some.alias(key[0]), none.alias(key[1]), text_key().alias(key[2]))
    return rows.join(named, key, "left_semi").dropDuplicates(key).select(*docs.columns)


def number_within(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Add ``name``: a gapless number from 0 within each value of ``keys``.

    ``rows`` must come straight from ``stored``: a row's address (file, row index) is
    fixed, so the numbers are the same in every retry, whatever the keys' skew.  Rows
    are numbered inside blocks of ``BLOCK_ROWS`` file rows; the blocks' counts (one
    row per key and block) give each block its offset.  No window group holds more
    than one block.
    """
    placed = rows.select(
        "*",
        F.col("_metadata.file_name").alias("__file"),
        F.col("_metadata.row_index").alias("__row"),
    ).withColumn("__block", F.floor(F.col("__row") / BLOCK_ROWS))
    block = [*keys, "__file", "__block"]
    ahead = Window.partitionBy(*keys).orderBy("__file", "__block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(*block).agg(F.count(F.lit(1)).alias("__n"))
        .select(*block, F.coalesce(F.sum("__n").over(ahead), F.lit(0)).alias("__base"))
    )
    inside = placed.withColumn("__in", F.row_number().over(Window.partitionBy(*block).orderBy("__row")) - 1)
    left, right = inside.alias("l"), offsets.alias("r")
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in block]
    on = same[0]
    for s in same[1:]:
        on = on & s
    return left.join(right, on).select(
        *[F.col(f"l.{c}") for c in rows.columns], (F.col("l.__in") + F.col("r.__base")).cast("long").alias(name)
    )

"""The training-data pipeline: language ID, exact dedup, SimHash near-dedup, mixing, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame that is written as Parquet and read again as the next one's docs.  All
but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.llm.common import keep_rows, stored, table
from trailmark.llm.exact_dedup import earlier_half, exact_dedup
from trailmark.llm.language_id import accepted_documents, learn
from trailmark.llm.mixing import domain_of_labels, mixed_documents
from trailmark.llm.packing import pack
from trailmark.llm.simhash import near_dedup, representatives


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents whose language is rejected go."""
    return accepted_documents(docs, learn(docs))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: of equal texts the winner stays."""
    return keep_rows(docs, exact_dedup(docs, earlier_half(F.col("doc_id"))).filter("winner"))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: of every class of linked fingerprints the smallest document stays."""
    return keep_rows(docs, representatives(near_dedup(docs)))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: every document is taken as often as its rate says."""
    return mixed_documents(docs, domain_of_labels(table(spark, sf_dir, "labels")))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: pieces with their sequence and offset."""
    return pack(docs)


STAGES = [
    ("language_id", language_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: Language ID, SimHash and the fit have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs

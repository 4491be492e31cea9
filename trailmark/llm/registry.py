"""The queries of the training-data operators and the SQL of those that have one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .chat_format import OP7_SQL, op7_chat_formatting
from .exact_dedup import OP6_SQL, op6_exact_dedup
from .html_extract import op9_html_extraction
from .language_id import op3_language_id
from .lexical_search import OP11_SQL, op11_lexical_search
from .mixing import op1_mixing
from .packing import op10_packing
from .phrase_mining import OP12_SQL, op12_phrase_mining
from .rlbwt_dedup import op8_rlbwt_dedup
from .secret_scan import OP13_SQL, op13_secret_scan
from .sharding import op2_sharding
from .simhash import op5_simhash
from .topk import OP4_SQL, op4_topk


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # at the repository top, beside __spark_entry__.py

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_mixing": op1_mixing,
        "op2_sharding": op2_sharding,
        "op3_language_id": op3_language_id,
        "op4_topk": op4_topk,
        "op5_simhash": op5_simhash,
        "op6_exact_dedup": op6_exact_dedup,
        "op7_chat_formatting": op7_chat_formatting,
        "op8_rlbwt_dedup": op8_rlbwt_dedup,
        "op9_html_extraction": op9_html_extraction,
        "op10_packing": op10_packing,
        "op11_lexical_search": op11_lexical_search,
        "op12_phrase_mining": op12_phrase_mining,
        "op13_secret_scan": op13_secret_scan,
        "pipeline": pipeline,
    }


def oracles() -> dict[str, str]:
    return {
        "op4_topk": OP4_SQL,
        "op6_exact_dedup": OP6_SQL,
        "op7_chat_formatting": OP7_SQL,
        "op11_lexical_search": OP11_SQL,
        "op12_phrase_mining": OP12_SQL,
        "op13_secret_scan": OP13_SQL,
    }

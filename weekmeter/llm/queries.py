"""The queries of this package by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from weekmeter.llm.ann import op10_ann
from weekmeter.llm.bpe import op6_bpe
from weekmeter.llm.chat import op1_chat
from weekmeter.llm.common import prepared
from weekmeter.llm.fim import op12_fill_in_middle
from weekmeter.llm.line_dedup import op11_line_dedup
from weekmeter.llm.mixing import op7_mixing
from weekmeter.llm.ngram_join import op8_ngram_join
from weekmeter.llm.oracles import SQL
from weekmeter.llm.quality_knn import op2_quality_knn
from weekmeter.llm.quality_rules import op9_quality_rules
from weekmeter.llm.sharding import op3_sharding
from weekmeter.llm.substring_dedup import op4_substring_dedup
from weekmeter.llm.warc import op5_warc
from weekmeter.llm.whitening import op13_embedding_whitening


QUERIES = (
    op1_chat,
    op2_quality_knn,
    op3_sharding,
    op4_substring_dedup,
    op5_warc,
    op6_bpe,
    op7_mixing,
    op8_ngram_join,
    op9_quality_rules,
    op10_ann,
    op11_line_dedup,
    op12_fill_in_middle,
    op13_embedding_whitening,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: prepared(query) for query in QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)

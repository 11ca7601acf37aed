"""A corpus prepared for training, in five stages over whole tables.

Each stage takes (spark, docs, folder) and works on all rows its predecessor kept; its result is written
as Parquet and read again as the next one's input. The last stage adds token ids and digests.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from weekmeter.llm import bpe, mixing, ngram_join, quality_rules, substring_dedup
from weekmeter.llm.common import prepare, prepared, remove, shared_path

STAGES = [
    ("quality rules", prepared(quality_rules.keep_good)),
    ("n-gram Jaccard join", prepared(ngram_join.keep_one_of_each)),
    ("substring dedup", prepared(substring_dedup.cut_repeats)),
    ("mixing sources to target weights", prepared(mixing.take_mix)),
    ("BPE encoding and decoding", prepared(bpe.tokenize)),
]

# Line labelling, similarity joins and merges have no SQL form; tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents of a folder.

    Each stage's result is written to the shared folder, and removed once the next one is written; the
    last one stays for the frame that is returned.
    """
    prepare(spark)
    target = f"{shared_path(spark)}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{target}/{number}")
        docs = spark.read.parquet(f"{target}/{number}")
        if number:
            remove(spark, f"{target}/{number - 1}")
    return docs

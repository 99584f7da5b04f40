"""Corpus pipeline: quality rules, near-duplicates, personal data, source mix, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read
again as the next stage's ``docs``.  All stages but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lanwatch.llm import common, mixing, packing, quality, simhash, surrogates

STAGES = [
    ("quality_rules", quality.stage),        # rows that the rules reject go
    ("simhash_near_dedup", simhash.stage),   # one row of each group stays
    ("pii_surrogates", surrogates.stage),    # personal data is replaced in the texts
    ("source_mixing", mixing.stage),         # rows repeat by their source's target, in training order
    ("best_fit_packing", packing.stage),     # pieces in windows of 4096 tokens
]

# XXH64 with a seed and tokenizer ids have no SQL form; tests/llm/test_pipeline.py checks run() against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

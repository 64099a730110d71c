"""The corpus pipeline: quality rules, near duplicates, repeated passages, benchmark leaks, token ids.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; its result is written as
Parquet and read back as the documents of the next stage. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakestrata.llm import byte_bpe, decontaminate, near_dups, quality_rules, repeats
from lakestrata.llm.common import documents, stored

STAGES = [
    ("quality_rules", quality_rules.stage),
    ("near_dups", near_dups.stage),
    ("substring_dedup", repeats.stage),
    ("decontamination", decontaminate.stage),
    ("byte_bpe", byte_bpe.stage),
]

# The verdict of the learned rules cannot be written in SQL; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""The corpus pipeline: quality rules, n-gram Jaccard join, substring dedup, decontamination, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet and read again as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from issuelens.llm import stages
from issuelens.llm.common import scratch
from issuelens.session import cut_lineage, drop_table, last_table

STAGES = [
    ("quality_rules", stages.quality_rules),
    ("ngram_jaccard_join", stages.near_duplicates),
    ("substring_dedup", stages.shared_passages),
    ("benchmark_decontamination", stages.decontamination),
    ("best_fit_packing", stages.packed),
]

#: Token ids of the last stage can't be had in SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written before the next one reads them.

    A stage's own working tables are deleted when its rows are written, and its
    input when its rows are; the last stage's input stays for its result.
    """
    docs, held = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES[:-1]:
        with scratch(spark):
            docs = cut_lineage(stage(spark, docs, sf_dir))
        made = last_table()
        if held:
            drop_table(spark, held)
        held = made
    return STAGES[-1][1](spark, docs, sf_dir)

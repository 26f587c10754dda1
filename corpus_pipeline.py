"""The corpus pipeline: stages over ``documents``, each written as Parquet and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from listrata.llm import stages
from listrata.llm.frames import stored

STAGES: list[tuple[str, stages.Stage]] = [
    ("toxicity", stages.toxicity),
    ("line_dedup", stages.line_deduplicated),
    ("near_dedup", stages.near_deduplicated),
    ("decontamination", stages.decontaminated),
    ("packing", stages.packed),
]

#: SQL cannot express the trained scores, the alignment and the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another, over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

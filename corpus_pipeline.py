"""The corpus pipeline: documents to packed training windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from korvane.llm.common import stage
from korvane.llm.langid import keep_identified
from korvane.llm.mixing import mixed
from korvane.llm.packing import packed
from korvane.llm.quality import keep_good
from korvane.llm.simhash import keep_one

STAGES = [
    ("quality classifier", keep_good),
    ("language ID", keep_identified),
    ("SimHash near-dedup", keep_one),
    ("mixing sources to target weights", mixed),
    ("packing", packed),
]

#: The classifiers, fingerprints and the tokenizer are no SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents, each over the written rows of the one before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage_of) in enumerate(STAGES):
        docs = stage_of(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stage(docs, f"pipeline-{k}")
    return docs

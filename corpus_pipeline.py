"""A training-data pipeline over ``documents``: toxic texts, near duplicates and benchmark
leaks go, personal data are replaced, and what stays is tokenised.  Each stage's rows are
written as Parquet to the shared scratch folder and are the next stage's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quire.llm import stages
from quire.llm.common import run_folder, scratch, table
from quire.sources.store import delete_tree

STAGES = [
    ("toxicity", stages.drop_toxic),
    ("simhash_near_dedup", stages.drop_near_duplicates),
    ("decontamination", stages.drop_contaminated),
    ("pii", stages.replace_personal_data),
    ("byte_bpe", stages.tokenize),
]

#: None: the fingerprints, the classifier and the tokenizer have no SQL; ``tests/llm/test_pipeline.py`` compares with
#: plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages.  What a stage wrote is deleted when the next one has been written; the last one's rows stay."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        with run_folder(spark, f"work-{name}"):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            delete_tree(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs

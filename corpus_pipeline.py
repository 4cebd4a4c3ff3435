"""From raw documents to packed training sequences.

Toxic documents go, one document of each group of near-duplicates stays, passages that repeat are
removed, and what is left is tokenized and packed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from civicflow.llm import stages
from civicflow.llm.components import stored
from civicflow.llm.queries import table

STAGES = [
    ("toxicity", stages.toxicity),
    ("minhash_near_dedup", stages.near_duplicates),
    ("substring_dedup", stages.substrings),
    ("packing", stages.packed),
]

# A classifier and tokenization are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the documents table; every one starts from written rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs

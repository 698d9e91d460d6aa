"""The corpus pipeline: documents to packed training sequences, in stages that are each stored."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketlens.llm.common import staged, table
from marketlens.llm.decontaminate import not_contaminated
from marketlens.llm.exact_dedup import without_copies
from marketlens.llm.near_dedup import without_near_duplicates
from marketlens.llm.packing import packed_stage
from marketlens.llm.toxicity import not_toxic

# (name, function of session, documents and table folder). All but the last keep the columns of documents.
STAGES = [
    ("toxicity", not_toxic),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_duplicates),
    ("decontamination", not_contaminated),
    ("packing", packed_stage),
]

# A trained classifier and a packing order are no SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of the last stage. Every stage's result is stored in the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

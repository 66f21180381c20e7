"""A training corpus from ``documents``, in five stages.

quality rules -> near-duplicates -> repeated passages -> source mix ->
packed sequences. Each stage takes the table that the one before it kept
(written as Parquet and read again) and, but for the last, returns the
columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cargolens.llm.common import materialise
from cargolens.llm.mixing import mix_documents
from cargolens.llm.near_dup import keep_one
from cargolens.llm.packing import pack_documents
from cargolens.llm.quality import keep_good
from cargolens.llm.repeats import without_repeats
from cargolens.sources.tables import table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go (operator 4)."""
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays (operator 7)."""
    return keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that a document with a smaller id holds are cut (operator 10)."""
    return without_repeats(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix draws it (operator 8)."""
    return mix_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their sequence and offset (operator 5)."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("source_mix", source_mix),
    ("packing", packing),
]

#: Near-duplicate classes, byte-level repeats and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

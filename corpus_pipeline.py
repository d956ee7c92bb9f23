"""From raw documents to packed sequences: each stage takes what the one before it has kept.

Stages: quality rules (rejected documents go), exact dedup (of equal texts the largest doc_id
stays), MinHash near dedup (one document of each group stays), mixing to target weights (every
document stays, small sources repeat), best-fit packing. Each stage's result is written as
Parquet to the shared folder and read back as the next one's documents.

Defined cases, as the stages define them: a null text is the empty text (it fails the quality
rules, so it goes first); a null doc_id is kept as given and never wins a tie against an id;
repeated rows count each until exact dedup keeps one; an empty table gives empty stages and no
pieces; extra columns ride along through the first four stages, which return the documents'
columns, and only the packing stage returns pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from jobsignals.llm import exact_dedup, mixing, near_dedup, pattern_packing, quality_rules
from jobsignals.llm.common import save, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(docs)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.deduplicate(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """No budget is given, so that every document stays and small sources are repeated."""
    return mixing.mixed(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pattern_packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", good_documents),
    ("exact dedup", distinct_texts),
    ("near dedup", one_of_near_duplicates),
    ("mixing", mixed_sources),
    ("packing", packed_sequences),
]

#: Token ids and shingle comparisons are no SQL; a plain version in the tests takes its place.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = save(docs, name.replace(" ", "-"))
    return docs

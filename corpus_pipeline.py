"""The training-data pipeline: each stage works on all that its predecessor kept.

Null texts pass every stage but the last as they are, empty ones too; the last packs both as an end mark alone.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstone.llm import decontaminate, line_dedup, near_dedup, packing, toxicity
from wardstone.llm.storage import modest_batches, stored
from wardstone.sources.tables import read_table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score toxicity.THRESHOLD or more go."""
    modest_batches(spark)
    return toxicity.accepted(docs, read_table(spark, sf_dir, "labels", "doc_id", "toxic"))


def delete_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of lines that stood before are deleted; documents of which nothing is left go."""
    modest_batches(spark)
    left = line_dedup.deduplicated(docs)
    return left.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def keep_first_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, by five-word shingles and a similarity of 0.8."""
    modest_batches(spark)
    return near_dedup.first_of_each(docs)


def reject_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    modest_batches(spark)
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark", "item_id", "text"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of what is left, with its place in a sequence of packing.CAPACITY tokens."""
    modest_batches(spark)
    return packing.packed(docs, public_tokenizers.path(packing.VOCABULARY))


STAGES = [
    ("toxicity", reject_toxic),
    ("line dedup", delete_repeated_lines),
    ("near dedup", keep_first_of_near_copies),
    ("benchmark decontamination", reject_benchmark),
    ("packing", pack),
]

#: SQL has neither the scoring nor the tokenizer; tests/llm compares the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again by the next."""
    docs = read_table(spark, sf_dir, "documents")
    for at, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = stored(docs)
    return docs

"""The training-data pipeline over ``documents``: filters, then tokens, each stage on all that the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents. ``run``
applies them to the whole table, and every stage is written to the shared folder and read back before the next begins.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outagegrid.llm import bpe, decontaminate, exact_dedup, near_dedup, toxicity
from outagegrid.llm.common import stored, table
from outagegrid.session import configure


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    return toxicity.reject(docs, table(spark, sf_dir, "labels"))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for the case of A-Z, the row with the largest doc_id stays."""
    return exact_dedup.keep_one(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 0.8 of their five-word shingles, the one with the smallest doc_id stays."""
    return near_dedup.keep_one(docs, width=5, percent=80)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit), ids_sha256, decoded_sha256."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode(docs, path, public_tokenizers.PATTERN).select(
        "doc_id", (F.length("tokens") / 4).cast("long").alias("n_tokens"), F.col("tokens").alias("ids"),
        F.sha2("tokens", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )



def _configured(stage):
    """A stage may be run on its own; the batches of its Python tasks are then bounded as in ``run``."""
    return lambda spark, docs, sf_dir: stage(configure(spark), docs, sf_dir)


STAGES = [
    (name, _configured(stage))
    for name, stage in (
        ("toxicity", reject_toxic),
        ("exact_dedup", exact_duplicates),
        ("near_dedup", near_duplicates),
        ("decontamination", benchmark_leaks),
        ("byte_bpe", token_ids),
    )
]

#: The toxicity model, the tiling and the merges are not expressible in SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

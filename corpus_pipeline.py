"""From raw documents to packed batches, stage by stage.

Each stage takes what the one before kept, as a table with the columns of
``documents``, and applies its decisions: toxic documents go, one document of
each near-duplicate group stays, documents that hold benchmark windows go,
secrets are replaced in the texts, and what is left is packed into batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from replyloom.llm import decontamination, near_dedup, packing, secret_scan, toxicity
from replyloom.llm.common import read, spread_rows, store


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine, fitted on these, scores below its threshold; null texts are empty."""
    return toxicity.without_toxic(spread_rows(docs), read(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component of fingerprints within two bits.

    Copies, repeated rows, and texts without words (null ones too) are one group each.
    """
    return near_dedup.one_of_each_group(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item; those without words stay."""
    return decontamination.without_benchmark(docs, read(spark, sf_dir, "benchmark"))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by a mark; n_chars stays that of the source."""
    return secret_scan.redact_secrets(docs)


def pack_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every sequence of every document, with its bucket, batch and slot."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark),
    ("secret_scan", hide_secrets),
    ("packing", pack_batches),
]

#: A fitted model and connected components over digests have no SQL; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and read again."""
    rows, before = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        table = store(stage(spark, rows, sf_dir), f"pipeline-{name}")
        if before is not None:
            before.drop()  # the next table is written and needs it no more
        rows, before = table.rows, table
    return rows

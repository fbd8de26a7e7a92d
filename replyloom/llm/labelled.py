"""Bounded training samples of labelled documents."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replyloom.llm.common import bounded_sample, held_out


def training_rows(
    documents: DataFrame, labels: DataFrame, label: str, features: Column, bound: int, key: str = "doc_id"
) -> pa.Table:
    """(label, features) of about ``bound`` labelled documents outside the held-out fold.

    ``features`` is an expression over ``text``.  Labels other than 0 and 1 and
    null keys teach nothing; a key with both labels counts as 1, and a key with
    several texts gives its least features.  The keys are sampled by a hash
    before the documents are read, so what is broadcast and collected is bounded
    whatever the size of the tables and however often a key occurs.
    """
    known = labels.select(F.col(key).alias("__key"), F.col(label).cast("int").alias("__label"))
    known = known.filter(F.col("__key").isNotNull() & F.col("__label").isin(0, 1) & ~held_out("__key"))
    known = known.groupBy("__key").agg(F.max("__label").alias("__label"))
    known = bounded_sample(known, known.count(), bound, "__key")
    rows = documents.select(F.col(key).alias("__key"), F.col("text")).join(F.broadcast(known), "__key")
    taught = rows.select("__key", "__label", features.alias("__features"))
    return taught.groupBy("__key", "__label").agg(F.min("__features").alias("__features")).drop("__key").toArrow()

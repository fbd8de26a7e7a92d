"""Packing of variable-length texts into padded batches.

A text longer than the limit becomes several sequences, so lengths are bounded
and the global histogram is small however large the corpus is.  Dynamic
programming over the histogram finds the bucket bounds with the least padding.
Inside a bucket every sequence gets its exact rank in key order, and a fixed
number of sequences, as many as the token budget holds, forms a batch.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from replyloom.llm.common import store

WORD = r"[^\x20\x09-\x0D]+"
MAX_LENGTH = 2048
BUCKETS = 12
TOKEN_BUDGET = 65_536


class Plan(NamedTuple):
    """Upper bounds of the buckets in rising order, and the padding they cost in all."""

    bounds: tuple[int, ...]
    padding: int


def word_count(text: str | Column) -> Column:
    """Words of a text as its length; pass a tokenizer's count instead where there is one."""
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(column, F.lit(WORD)), F.lit(0)).cast("long")


def sequences(documents: DataFrame, key: str, length: Column, max_length: int = MAX_LENGTH) -> DataFrame:
    """(key, chunk, start, n_tokens): consecutive pieces of at most ``max_length``.

    A document of length zero is one sequence of length zero.
    """
    pieces = F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0).cast("long"), F.floor((F.col("__n") - 1) / max_length)))
    return (
        documents.select(F.col(key), length.cast("long").alias("__n"))
        .select(key, "__n", F.explode(pieces).alias("chunk"))
        .select(
            key,
            "chunk",
            (F.col("chunk") * max_length).alias("start"),
            F.least(F.lit(max_length).cast("long"), F.col("__n") - F.col("chunk") * max_length).alias("n_tokens"),
        )
    )


def plan_buckets(lengths: list[int], counts: list[int], buckets: int = BUCKETS) -> Plan:
    """The bounds that pad least; with equal padding, those whose last bucket begins earliest.

    ``lengths`` rise.  ``best[j]`` is the least padding of the first j lengths;
    one more bucket may begin after any i < j and pads lengths i..j-1 to the last.
    """
    m = len(lengths)
    if not m:
        return Plan((), 0)
    v = np.array(lengths, dtype=np.int64)
    c = np.concatenate([[0], np.cumsum(np.array(counts, dtype=np.int64))])
    s = np.concatenate([[0], np.cumsum(np.array(counts, dtype=np.int64) * v)])
    best = v * c[1:] - s[1:]
    origins = [np.zeros(m, dtype=np.int64)]
    for _ in range(1, min(buckets, m)):
        after, origin = np.empty_like(best), np.empty_like(best)
        for j in range(m):
            options = v[j] * (c[j + 1] - c[: j + 1]) - (s[j + 1] - s[: j + 1])
            options[1:] += best[:j]
            origin[j] = int(np.argmin(options))
            after[j] = options[origin[j]]
        best = after
        origins.append(origin)
    bounds, j = [], m
    for origin in reversed(origins):
        if j <= 0:
            break
        bounds.append(int(v[j - 1]))
        j = int(origin[j - 1])
    return Plan(tuple(reversed(bounds)), int(best[-1]))


def length_plan(rows: DataFrame, buckets: int = BUCKETS) -> Plan:
    """Plan for a table with ``n_tokens``; its histogram has a row per distinct length."""
    histogram = sorted((r["n_tokens"], r["n"]) for r in rows.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).collect())
    return plan_buckets([n for n, _ in histogram], [c for _, c in histogram], buckets)


def pack(
    documents: DataFrame,
    key: str = "doc_id",
    length: Column | None = None,
    max_length: int = MAX_LENGTH,
    buckets: int = BUCKETS,
    token_budget: int = TOKEN_BUDGET,
) -> DataFrame:
    """One row per sequence: key, chunk, start, n_tokens, pad_to, batch, slot.

    Batches of a bucket are numbered from zero in the order of key, then chunk
    (null keys first); each holds ``token_budget // pad_to`` sequences, one at
    least, the last of a bucket perhaps fewer.  ``length`` defaults to the words
    of ``text``; null and empty texts have length zero and are packed like any
    other.  Repeated rows are separate sequences.  An empty table gives no rows.

    A hot bucket is no hot task: rows are dealt out by range of (bucket, key,
    chunk), counted per range, and ranked inside their range plus the rows of
    the ranges before.
    """
    counted = store(sequences(documents, key, word_count("text") if length is None else length, max_length), "lengths")
    plan = length_plan(counted.rows, buckets)
    pad_to = F.lit(0)
    for bound in reversed(plan.bounds):
        pad_to = F.when(F.col("n_tokens") <= bound, F.lit(bound)).otherwise(pad_to)
    ranges = max(1, int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = store(
        counted.rows.withColumn("pad_to", pad_to.cast("long"))
        .repartitionByRange(ranges, "pad_to", key, "chunk")
        .withColumn("__range", F.spark_partition_id()),
        "ranges",
    )
    counted.drop()
    sizes = dealt.rows.groupBy("pad_to", "__range").agg(F.count(F.lit(1)).alias("__size"))
    before = Window.partitionBy("pad_to").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("pad_to", "__range", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy("pad_to", "__range").orderBy(key, "chunk", "n_tokens")
    ranked = dealt.rows.withColumn("__row", F.row_number().over(inside)).join(offsets, ["pad_to", "__range"])
    rank = F.col("__before") + F.col("__row") - 1
    capacity = F.greatest(F.lit(1), F.floor(F.lit(token_budget) / F.greatest(F.col("pad_to"), F.lit(1))))
    return ranked.select(
        key,
        "chunk",
        "start",
        "n_tokens",
        "pad_to",
        F.floor(rank / capacity).cast("long").alias("batch"),
        F.pmod(rank, capacity).cast("long").alias("slot"),
    )

"""Lookup joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_PER_TASK = 1_000_000


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str,
    spread: Sequence[str],
    rows_per_task: int = ROWS_PER_TASK,
    left_rows: int | None = None,
) -> DataFrame:
    """Join ``left`` to a ``right`` that has one row per key, splitting hot keys.

    Keys with more than ``rows_per_task`` left rows get one salt per that many
    rows; left rows pick a salt from a hash of ``spread`` (columns that differ
    between the rows of a key, so the choice survives a task retry) and right
    rows of hot keys are repeated per salt.  There are at most
    ``rows(left) / rows_per_task`` hot keys, so their table is small by
    construction.  Keys are compared as hashes when counting: a collision only
    salts one key too many.  A ``left`` known to hold no more than
    ``rows_per_task`` rows cannot have a hot key and is joined as it is.
    """
    if left_rows is not None and left_rows <= rows_per_task:
        return left.join(right, list(on), how)
    key = F.xxhash64(*on)
    hot = (
        left.groupBy(key.alias("_hot_key"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > rows_per_task)
        .select("_hot_key", F.ceil(F.col("_n") / rows_per_task).cast("int").alias("_salts"))
    )

    def tag(df: DataFrame) -> DataFrame:
        keyed = df.withColumn("_key", key)
        return keyed.join(F.broadcast(hot), F.col("_key") == F.col("_hot_key"), "left").drop(
            "_key", "_hot_key"
        )

    salt = F.when(F.col("_salts").isNull(), 0).otherwise(
        F.pmod(F.xxhash64(*spread), F.col("_salts")).cast("int")
    )
    repeats = F.when(F.col("_salts").isNull(), F.array(F.lit(0))).otherwise(
        F.sequence(F.lit(0), F.col("_salts") - 1)
    )
    salted_left = tag(left).withColumn("_salt", salt).drop("_salts")
    salted_right = tag(right).withColumn("_salt", F.explode(repeats)).drop("_salts")
    return salted_left.join(salted_right, [*on, "_salt"], how).drop("_salt")

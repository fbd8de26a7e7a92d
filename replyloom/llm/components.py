"""Connected components of a graph given as edges between 64-bit ids.

Rounds of large-star and small-star: each node tells its larger neighbours,
then its smaller ones, about the smallest node it knows.  Nothing is gathered
per node: a node's smallest neighbour is a minimum with partial sums in every
task, and goes back by an equi-join that Spark may split, so a hub with a third
of all edges costs no single task.  Rounds grow with the logarithm of the size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replyloom.llm.common import Stored, store


def _smallest(pairs: DataFrame) -> DataFrame:
    """Per node u its smallest neighbour or itself; ``pairs`` holds (u, v)."""
    return pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """(v, smallest of u) for every neighbour v above u."""
    both = _both(edges)
    return (
        both.join(_smallest(both), "u")
        .filter("v > u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .filter("u <> v")
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """(v, smallest of u) for u and every neighbour v below u; edges point down here."""
    smallest = _smallest(edges)
    moved = edges.join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = smallest.select("u", F.col("m").alias("v"))
    return moved.unionByName(own).filter("u <> v").distinct()


def _signature(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0)).alias("x")
    ).first()
    return int(row["n"]), int(row["x"])


def connected_components(edges: DataFrame, label: str = "components") -> Stored:
    """(node, root) for every node of an edge; root is the component's smallest id.

    ``edges`` has two long columns; loops, repeats and either direction are fine,
    rows with a null end are no edges.  No edges give no rows.  Each round is
    written to the shared folder and replaces the one before, so a lost executor
    repeats one round at most.  The caller drops the result when done.
    """
    left, right = edges.columns[:2]
    plain = edges.select(F.col(left).alias("u"), F.col(right).alias("v")).filter("u <> v")
    now = store(plain.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), label)
    signature = _signature(now.rows)
    while signature[0]:
        after = store(_small_star(_large_star(now.rows)), label)
        now.drop()
        now, before, signature = after, signature, _signature(after.rows)
        if signature == before:
            break
    members = now.rows.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = now.rows.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    out = store(members.unionByName(roots), label)
    now.drop()
    return out

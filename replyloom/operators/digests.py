"""A tree of digests over ranges of a key: where two tables differ, not only that they do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replyloom.functions.values import row_digest

WIDTH = 1_000
FANOUT = 64
LEVELS = 4
_PARTS = ("d0", "d1", "d2", "d3")


def _node(key: Column, width: int) -> Column:
    """The number of the range of ``width`` keys that holds ``key``; whole numbers, also below zero."""
    return ((key - F.pmod(key, F.lit(width))) / F.lit(width)).cast("long") if width > 1 else key


def text_key(column: str) -> Column:
    """A whole number for keys that are no numbers: 32 bits of their digest."""
    return F.conv(F.substring(F.md5(F.col(column).cast("string").cast("binary")), 1, 8), 16, 10).cast("long")


def digest_tree(
    df: DataFrame,
    key: str | Column,
    columns: list[str] | None = None,
    width: int = WIDTH,
    fanout: int = FANOUT,
    levels: int = LEVELS,
) -> DataFrame:
    """``(level, node, n, d0 .. d3)``: rows and added-up digests per range of the key.

    At level 0 a node is a range of ``width`` keys; a node above covers
    ``fanout`` below.  Digests are sums, so copies count, order does not, and
    trees of parts add up to the tree of the whole (see ``joined``).  Rows with a
    null key share one node.  Rows are added up per leaf in every task first; the
    levels above are made from the leaves.
    """
    place = F.col(key) if isinstance(key, str) else key
    hexes = df.select(_node(place.cast("long"), width).alias("node"), row_digest(df, columns).alias("h"))
    sums = [
        F.sum(F.conv(F.substring("h", 1 + 8 * i, 8), 16, 10).cast("decimal(20,0)")).cast("decimal(38,0)").alias(part)
        for i, part in enumerate(_PARTS)
    ]
    leaves = hexes.groupBy("node").agg(F.count(F.lit(1)).alias("n"), *sums)
    steps = F.explode(F.array(*[F.struct(F.lit(i).alias("level"), F.lit(fanout**i).cast("long").alias("size")) for i in range(levels)]))
    spread = leaves.select("*", steps.alias("s"))
    above = ((F.col("node") - F.pmod("node", F.col("s.size"))) / F.col("s.size")).cast("long")
    return _added(spread.select(F.col("s.level").alias("level"), above.alias("node"), "n", *_PARTS))


def _added(rows: DataFrame) -> DataFrame:
    sums = [F.sum(part).cast("decimal(38,0)").alias(part) for part in _PARTS]
    return rows.groupBy("level", "node").agg(F.sum("n").alias("n"), *sums)


def joined(tree: DataFrame, appended: DataFrame) -> DataFrame:
    """The tree of a table after a batch with the tree ``appended`` was added to it."""
    return _added(tree.unionByName(appended))


def _differing(before: DataFrame, after: DataFrame) -> DataFrame:
    """Nodes of one level whose rows or digests differ, as ``(node, rows_before, rows_after)``."""
    a, b = before.alias("a"), after.alias("b")
    same = F.lit(True)
    for column in ("n", *_PARTS):
        same = same & F.col(f"a.{column}").eqNullSafe(F.col(f"b.{column}"))
    return (
        a.join(b, F.col("a.node").eqNullSafe(F.col("b.node")), "full_outer")
        .filter(~same)
        .select(
            F.coalesce("a.node", "b.node").alias("node"),
            F.coalesce("a.n", F.lit(0)).alias("rows_before"),
            F.coalesce("b.n", F.lit(0)).alias("rows_after"),
        )
    )


def changed_ranges(
    before: DataFrame, after: DataFrame, width: int = WIDTH, fanout: int = FANOUT, levels: int = LEVELS
) -> DataFrame:
    """``(first_key, last_key, rows_before, rows_after)`` of the leaves that two trees do not share.

    From the top down, only the children of nodes that differ are compared, so
    the work below the top follows the number of changes.  A null key's range is
    null.  Equal tables give no rows.
    """
    suspects = None
    for level in reversed(range(levels)):
        sides = []
        for tree in (before, after):
            nodes = tree.filter(F.col("level") == level)
            if suspects is not None:
                parent = suspects.select(F.col("node").alias("_parent"))
                own = ((F.col("node") - F.pmod("node", F.lit(fanout))) / F.lit(fanout)).cast("long")
                nodes = nodes.join(parent, own.eqNullSafe(F.col("_parent")), "left_semi")
            sides.append(nodes)
        suspects = _differing(*sides)
    first = F.col("node") * width
    return suspects.select(
        first.alias("first_key"), (first + (width - 1)).alias("last_key"), "rows_before", "rows_after"
    )

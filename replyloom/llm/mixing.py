"""Mixing sources to target weights.

Each row gets a hash-random key.  Rows are put in key order within their source
by ranges: a range of keys of one source holds a bounded share of the rows, so
a hot source is many ranges.  Prefix sums of sizes are distributed: inside a
range by a window, over the ranges of a block of ranges, over the blocks of a
source.  A source's budget is whole epochs of all its rows and a rest, and the
rest is cut off exactly where the prefix sum reaches it.

Only DataFrame functions are used, and only narrow rows (source, key, id, size)
are shuffled.  Rows are never gathered by source.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from replyloom.llm.common import Stored, store
from replyloom.llm.packing import word_count

WEIGHTS = (5, 2, 1)
#: The mix takes this share of all sizes, as a fraction of integers.
SHARE = (3, 2)
MAX_EPOCHS = 2
SEED = 42
ROWS_PER_RANGE = 250_000
MIN_RANGES = 4_096
RANGES_PER_BLOCK = 64
_HEX = 8


def mixing_key(seed: int, key: str) -> Column:
    """A random but reproducible text, the same wherever and however often a row is read."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary"))


def _range(n_ranges: int) -> Column:
    """Which of ``n_ranges`` equal ranges the key of a row falls into."""
    head = F.conv(F.substring("order", 1, _HEX), 16, 10).cast("long")
    return F.shiftright(head * F.lit(n_ranges), 4 * _HEX)


def _before(part: Sequence[str], order: str) -> Column:
    window = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("tokens").over(window), F.lit(0))


def range_offsets(ranges: DataFrame) -> DataFrame:
    """``before`` per (source, range): the tokens of the source in all ranges before.

    Two levels: no window sees more than the ranges of a block, or the blocks of a source.
    """
    of_source = ["none", "name"]
    placed = ranges.withColumn("block", F.floor(F.col("range") / RANGES_PER_BLOCK))
    blocks = placed.groupBy(*of_source, "block").agg(F.sum("tokens").alias("tokens"))
    starts = blocks.select(*of_source, "block", _before(of_source, "block").alias("start"))
    inside = placed.withColumn("inside", _before([*of_source, "block"], "range"))
    return inside.join(starts, [*of_source, "block"]).select(
        *of_source, "range", (F.col("start") + F.col("inside")).alias("before")
    )


def ranked_sources(sources: DataFrame) -> DataFrame:
    """``sources`` with ``place``, from zero in code-point order, null last.

    Places are counted inside ranges of names plus the ranges before, so that a
    table with a source per web host is ranked by many tasks too.
    """
    ranges = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = store(sources.repartitionByRange(ranges, "none", "name").withColumn("part", F.spark_partition_id()), "mix-names")
    sizes = dealt.rows.groupBy("part").agg(F.count(F.lit(1)).alias("tokens"))
    # One row per range: as many as there are shuffle partitions.
    starts = sizes.select("part", _before([], "part").alias("start"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy("none", "name"))
    return dealt.rows.withColumn("row", inside).join(F.broadcast(starts), "part").select(
        *sources.columns, (F.col("start") + F.col("row") - 1).alias("place")
    )


def _whole(x: int) -> Column:
    return F.lit(Decimal(x)).cast("decimal(38,0)")


def source_targets(
    sources: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: tuple[int, int] = SHARE,
    max_epochs: int = MAX_EPOCHS,
) -> DataFrame:
    """``sources`` (none, name, source_size) with ``target`` (double) and ``budget`` (long).

    A source at place i weighs ``weights[i % len(weights)]``.  All share
    ``share`` of all sizes by weight, but a target stops at ``max_epochs`` times
    its source's size, and what it cannot take is shared by weight among those
    below their stop, until none is above.  Each round is one aggregate over the
    sources; the level of the open ones only rises, so rounds end, and sums are
    whole numbers, so they are exact.  The budget is the target without its
    fraction.
    """
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (F.pmod("place", F.lit(len(weights))) + 1).cast("int"))
    table = store(ranked_sources(sources).withColumn("weight", weight), "mix-sources").rows
    size, whole = F.col("source_size").cast("decimal(38,0)"), "decimal(38,0)"
    total = int(table.agg(F.sum(size)).first()[0] or 0)
    over, under = share
    if over > under * max_epochs:
        raise ValueError("The share asks for more epochs than are allowed.")
    # Targets are level * weight for open sources, level = spread / open_weight / under.
    spread, open_weight, n_closed = over * total, 0, -1
    closed = F.lit(False)
    while True:
        row = table.agg(
            F.count_if(closed).alias("n"),
            F.sum(F.when(closed, size)).alias("size"),
            F.sum(F.when(~closed, F.col("weight")).cast(whole)).alias("weight"),
        ).first()
        if row["n"] == n_closed:
            break
        n_closed = row["n"]
        spread = over * total - under * max_epochs * int(row["size"] or 0)
        open_weight = int(row["weight"] or 0)
        if not open_weight:
            break
        closed = size * _whole(max_epochs * under * open_weight) < _whole(spread) * F.col("weight")
    stop = (max_epochs * F.col("source_size")).cast("double")
    if open_weight:
        level = (_whole(spread) * F.col("weight")).cast("double") / F.lit(float(under * open_weight))
        target = F.when(closed, stop).otherwise(F.least(level, stop))
    else:
        target = stop
    return table.select(*sources.columns, target.alias("target"), F.floor(target).cast("long").alias("budget"))


def narrow_rows(documents: DataFrame, key: str, source: str, size: Column, seed: int, carry: Sequence[str] = ()) -> Stored:
    name = F.col(source).cast("string")
    return store(
        documents.select(
            F.col(key).alias("id"),
            name.isNull().alias("none"),
            F.coalesce(name, F.lit("")).alias("name"),
            size.cast("long").alias("size"),
            mixing_key(seed, key).alias("order"),
            F.struct(*carry).alias("carried") if carry else F.lit(None).cast("int").alias("carried"),
        ),
        "mix-rows",
    )


def mix_sources(
    documents: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    size: Column | None = None,
    weights: Sequence[int] = WEIGHTS,
    share: tuple[int, int] = SHARE,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row per document: key, source, size, source_size, target, taken, and ``carry``.

    ``size`` defaults to the words of ``text``, none for null.  ``taken`` counts
    what the mix takes of a document over all epochs: all of it in each whole
    epoch; of the rest, all of the documents that come first in the order of the
    keys, and of the one at the cut its first words.  So every source gives its
    target less a fraction of a word, and no document more than ``max_epochs``
    times its size.

    A null source is a source of its own, behind all others.  A null key is
    empty text for the order.  Rows with one key are ordered by size; repeated
    rows take their turns one by one.  Empty texts take nothing.  An empty table
    gives no rows.  The same rows give the same mix, however they are dealt out.
    ``carry`` names columns to keep, such as the text; their names may clash with
    none of the result's.
    """
    rows = narrow_rows(documents, key, source, word_count("text") if size is None else size, seed, carry)
    n_ranges = max(MIN_RANGES, -(-rows.rows.count() // ROWS_PER_RANGE))
    placed = rows.rows.withColumn("range", _range(n_ranges))
    of_source = ["none", "name"]
    ranges = store(placed.groupBy(*of_source, "range").agg(F.sum("size").alias("tokens")), "mix-ranges")
    sources = ranges.rows.groupBy(*of_source).agg(F.sum("tokens").alias("source_size"))
    targets = source_targets(sources, weights, share, max_epochs)
    # A source's rows in one range are few; this table has a row per range, not per document.
    cuts = store(range_offsets(ranges.rows).join(targets, of_source), "mix-cuts").rows
    ranges.drop()
    inside = Window.partitionBy(*of_source, "range").orderBy("order", "size").rowsBetween(Window.unboundedPreceding, -1)
    ordered = placed.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    known = F.greatest(F.col("source_size"), F.lit(1))
    epochs = F.floor(F.col("budget") / known).cast("long")
    rest = F.col("budget") - epochs * F.col("source_size") - F.col("before") - F.col("inside")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(rest, F.col("size")))
    return ordered.join(cuts, [*of_source, "range"]).select(
        F.col("id").alias(key),
        F.when(~F.col("none"), F.col("name")).alias("source"),
        "size",
        "source_size",
        "target",
        taken.cast("long").alias("taken"),
        *[F.col(f"carried.{c}").alias(c) for c in carry],
    )

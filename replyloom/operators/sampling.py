"""Keep-first, deterministic sampling and stratified splitting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from replyloom.functions.text import is_blank, is_empty_for_matching, is_reviewed, normalize_for_matching
from replyloom.operators.checks import require, require_columns
from replyloom.session import scratch, stored

# Hex digits of the rank by which one pass narrows the cut: 4,096 counters.
PREFIX_STEP = 3
# Ranks that the last pass may bring to the driver to find the cut among them.
LAST_RANKS = 5_000


def text_digest(column: str) -> Column:
    """A key of fixed size that stands for a text of any length."""
    return F.sha2(F.col(column), 256)


def dedupe_first(
    df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column | str]
) -> DataFrame:
    """First row per key in an explicit order; use ``text_digest`` for keys that are texts.

    ``row_number() = 1`` lets Spark drop all but one row per key and task before
    the shuffle (window group limit), so a key with many copies stays cheap.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def sample_rank(seed: int, *ids: str) -> Column:
    """Pseudo-random but reproducible rank text of a row."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(i).cast("string") for i in ids]))


def _cut(ranks: DataFrame, n: int) -> tuple[str, object] | None:
    """``(rank, id)`` of the n-th row in rank order; None if there are no more than n.

    Each pass counts the rows under the next hex digits of the rank and goes on
    inside the one group that holds the cut, so the driver sees a few thousand
    counters and, in the end, a few thousand ranks, whatever the size.
    """
    prefix, left = "", n
    while True:
        inside = ranks.filter(F.startswith("_rank", F.lit(prefix)))
        head = F.substring("_rank", 1, len(prefix) + PREFIX_STEP)
        sizes = sorted(
            (r["head"], r["n"])
            for r in inside.groupBy(head.alias("head")).agg(F.count(F.lit(1)).alias("n")).collect()
        )
        if not prefix and sum(size for _, size in sizes) <= n:
            return None
        for prefix, size in sizes:  # noqa: B007 - goes on with the group it stops at
            if size >= left:
                break
            left -= size
        if size <= LAST_RANKS or len(prefix) >= 32:
            last = ranks.filter(F.startswith("_rank", F.lit(prefix))).orderBy("_rank", "_id").limit(left)
            row = last.collect()[-1]
            return row["_rank"], row["_id"]


def sample_n(df: DataFrame, n: int | None, seed: int, id_col: str) -> DataFrame:
    """``n`` rows without replacement, the same ones on every run; ``None`` takes all.

    ``id_col`` must be unique.  Ranks and ids are written once; the exact cut is
    found on them, and the rows themselves pass a filter, not a sort or a join.
    """
    if n is None:
        return df
    if n < 1:
        return df.limit(0)
    rank = sample_rank(seed, id_col)
    with scratch(df.sparkSession):
        cut = _cut(stored(df.select(rank.alias("_rank"), F.col(id_col).alias("_id")), "ranks"), n)
    if cut is None:
        return df
    last_rank, last_id = cut
    return df.filter((rank < last_rank) | ((rank == last_rank) & (F.col(id_col) <= F.lit(last_id))))


def _numbered(ranked: DataFrame, order: Sequence[Column | str], name: str) -> DataFrame:
    """Number the rows from zero in the order of ``_rank``, then ``order``.

    Rows are numbered inside 65,536 groups of the rank's first digits, plus the
    size of the groups before, so no task sees the whole table.
    """
    grouped = ranked.withColumn("_group", F.substring("_rank", 1, 4))
    before = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        grouped.groupBy("_group")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_group", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy("_group").orderBy("_rank", *order)
    return (
        grouped.join(F.broadcast(offsets), "_group")
        .withColumn(name, F.col("_before") + F.row_number().over(inside) - 1)
        .drop("_rank", "_group", "_before")
    )


def number_rows(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Consecutive numbers for rows with unique ``keys``, in an order that depends on the keys alone."""
    return _numbered(df.withColumn("_rank", sample_rank(0, *keys)), keys, name)


def number_examples(sample: DataFrame, seed: int, id_col: str, prefix: str = "label-") -> DataFrame:
    """Number the rows ``label-0000``, ``label-0001`` … in sample order."""
    numbered = _numbered(sample.withColumn("_rank", sample_rank(seed, id_col)), [id_col], "_number")
    return numbered.withColumn("example_id", F.format_string(prefix + "%04d", "_number")).drop("_number")


def usable_labels(labels: DataFrame, order: str) -> DataFrame:
    """One row per normalised text, then one per thread."""
    with_text = labels.withColumn("_normalized", normalize_for_matching("text"))
    by_text = dedupe_first(with_text, [text_digest("_normalized")], [order])
    return dedupe_first(by_text, ["thread_id"], [order]).drop("_normalized")


def split_quotas(counts: DataFrame, golden_n: int, label: str = "intent") -> DataFrame:
    """Golden rows per label: proportional shares rounded by largest remainder.

    ``counts`` has one row per label (``label``, ``n``), so the windows here run
    over as many rows as there are labels.
    """
    everything = Window.partitionBy()
    share = F.col("n") * (F.col("total") - golden_n) / F.col("total")
    sized = (
        counts.withColumn("total", F.sum("n").over(everything))
        .withColumn("base", F.floor(share))
        .withColumn("remainder", F.round(share - F.floor(share), 12))
        .withColumn("missing", F.col("total") - golden_n - F.sum("base").over(everything))
    )
    extra = F.row_number().over(Window.orderBy(F.col("remainder").desc(), F.col(label)))
    train = F.col("base") + F.when(extra <= F.col("missing"), 1).otherwise(0)
    return sized.select(label, "n", (F.col("n") - train).cast("int").alias("golden_quota"))


def stratified_split(
    labels: DataFrame,
    golden_n: int,
    seed: int,
    order: str = "example_id",
    min_golden: int = 150,
    max_golden: int = 250,
    min_train: int = 100,
) -> tuple[DataFrame, DataFrame]:
    """Split reviewed labels into ``(train, golden)`` with disjoint threads.

    The golden set has exactly ``golden_n`` rows, spread over the labels in
    proportion.  Ranking inside a label is limited to ``golden_n`` rows per task
    before the shuffle, so a dominant label does not end up in one task.
    """
    fields = ["text", "intent", "decision", "thread_id"]
    require_columns(labels, [*fields, "reviewed", order], "Reviewed labels")
    if not min_golden <= golden_n <= max_golden:
        raise ValueError(f"A golden set has {min_golden} to {max_golden} rows.")
    reviewed = labels.filter(is_reviewed("reviewed"))
    require(
        reviewed,
        {
            **{f"blank {f}": is_blank(f) for f in fields},
            "decision outside auto_handle/escalate": ~F.col("decision").isin(
                "auto_handle", "escalate"
            ),
            "empty normalized text": is_empty_for_matching("text"),
        },
        "Reviewed labels",
    )
    usable = stored(usable_labels(reviewed, order), "usable-labels")
    counts = usable.groupBy("intent").agg(F.count(F.lit(1)).alias("n"))
    size, rare, n_labels = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") < 2), F.count(F.lit(1))
    ).first()
    if size < golden_n + min_train:
        raise ValueError(
            f"Need at least {golden_n + min_train} reviewed, unique-thread labels; found {size}."
        )
    if rare:
        raise ValueError("An intent with a single reviewed row cannot be split.")
    if n_labels > golden_n:
        raise ValueError("There are more intents than golden rows.")
    in_label = Window.partitionBy("intent").orderBy(sample_rank(seed, order), F.col(order))
    candidates = (
        usable.withColumn("_rn", F.row_number().over(in_label))
        .filter(F.col("_rn") <= golden_n)
        .join(F.broadcast(split_quotas(counts, golden_n)), "intent")
    )
    # At most golden_n rows in total.
    golden = candidates.filter(F.col("_rn") <= F.col("golden_quota")).select(*labels.columns)
    train = usable.join(F.broadcast(golden.select(order)), order, "left_anti")
    return train.select(*labels.columns), golden

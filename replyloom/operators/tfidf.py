"""TF-IDF over word and character n-grams."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from replyloom.functions.text import WORD
from replyloom.operators.terms import CHAR_NGRAMS, count_texts
from replyloom.session import stored

WORD_TOKEN = rf"[{WORD}]{{2,}}"
# Characters of text whose terms a task counts at once.
PIECE_CHARS = 1 << 18
# The same, if their counts are added up: the more text, the fewer rows.
SUM_CHARS = 1 << 20
SUM_FIELDS = [T.StructField("space", T.StringType()), T.StructField("term", T.StringType()), T.StructField("df", T.LongType()), T.StructField("tf", T.LongType())]
COUNT_FIELDS = [T.StructField("space", T.StringType()), T.StructField("term", T.StringType()), T.StructField("n", T.LongType())]
# Terms that the last pass may bring to the driver to find the cut among them.
LAST_TERMS = 5_000


@dataclass(frozen=True)
class SpaceSpec:
    """Document-frequency limits of one feature space; all terms unless ``max_features`` is set."""

    min_df: int = 1
    max_df: float = 1.0
    max_features: int | None = None


@dataclass(frozen=True)
class Vocabulary:
    """``terms(space, term, df, idf)`` of ``n_docs`` documents."""

    terms: DataFrame
    n_docs: int


def word_terms(normalized: Column) -> Column:
    """Words of two or more characters and their bigrams."""
    words = F.regexp_extract_all(normalized, F.lit(f"({WORD_TOKEN})"), 1)

    def with_bigrams(w: Column) -> Column:
        pairs = F.zip_with(
            F.slice(w, F.lit(1), F.greatest(F.size(w) - 1, F.lit(0))),
            F.slice(w, 2, F.size(w)),
            lambda a, b: F.concat_ws(" ", a, b),
        )
        return F.concat(w, pairs)

    return F.element_at(F.transform(F.array(words), with_bigrams), 1)


def char_terms(normalized: Column) -> Column:
    """Character 3- to 5-grams of every word padded with one space on each side.

    A padded word shorter than n adds nothing for that n.
    """
    low, high = CHAR_NGRAMS
    padded = F.transform(
        F.filter(F.split(normalized, " "), lambda w: w != ""),
        lambda w: F.concat(F.lit(" "), w, F.lit(" ")),
    )

    def grams(word: Column) -> Column:
        sizes = F.sequence(F.lit(low), F.least(F.lit(high), F.length(word)))
        return F.flatten(
            F.transform(
                sizes,
                lambda n: F.transform(
                    F.sequence(F.lit(1), F.length(word) - n + 1),
                    lambda start: F.substring(word, start, n),
                ),
            )
        )

    return F.flatten(F.transform(padded, grams))


def cut_texts(docs: DataFrame, normalized: str, *keep: str) -> DataFrame:
    """``keep``, the ``words`` and ``tokens`` of a text, and its ``chars``, for the counting in tasks."""
    text = F.col(normalized)
    return docs.select(
        *keep,
        F.filter(F.split(text, " "), lambda w: w != "").alias("words"),
        F.regexp_extract_all(text, F.lit(f"({WORD_TOKEN})"), 1).alias("tokens"),
        F.coalesce(F.length(text), F.lit(0)).alias("chars"),
    )


def term_counts(docs: DataFrame, id_col: str, normalized: str, summed: bool = False) -> DataFrame:
    """``(id_col, space, term, n)`` for every document.

    The only exchange is of the text, by document.  Terms are counted where they
    are made, some texts at a time, so no row is made per occurrence.  ``summed``
    adds up the documents of such a piece, ``(space, term, df, tf)``: what a
    vocabulary is fitted on, in far fewer rows.  A document is in one piece only.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    here = docs.select(id_col, normalized).repartition(partitions, id_col).sortWithinPartitions(id_col)
    if summed:
        rows, run = T.StructType(SUM_FIELDS), count_texts([id_col], SUM_CHARS, True)
    else:
        rows, run = T.StructType([docs.schema[id_col], *COUNT_FIELDS]), count_texts([id_col], PIECE_CHARS)
    return cut_texts(here, normalized, id_col).mapInArrow(run, rows)


def smooth_idf(df: Column, n_docs: int) -> Column:
    return F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + df)) + 1.0


def _count_cut(stats: DataFrame, m: int) -> tuple[int, int] | None:
    """``(count, left)``: the count of the m-th term, and how many with just that count belong; None takes all.

    Each pass counts terms in 4,096 equal steps of the range that still holds
    the cut, so the driver sees that many numbers at most.
    """
    low, high = 0, int(stats.agg(F.coalesce(F.max("tf"), F.lit(0))).first()[0]) + 1
    if stats.count() <= m:
        return None
    left = m
    while high - low > 1:
        step = -(-(high - low) // 4096)
        slot = F.floor((F.col("tf") - low) / step)
        rows = stats.filter((F.col("tf") >= low) & (F.col("tf") < high)).groupBy(slot.alias("slot"))
        for row in sorted(rows.agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True):
            if row["n"] >= left:
                break
            left -= row["n"]
        low, high = low + int(row["slot"]) * step, min(high, low + (int(row["slot"]) + 1) * step)
    return low, left


def _term_cut(terms: DataFrame, n: int) -> str:
    """The n-th of distinct terms in byte order, by counting under ever longer beginnings."""

    def head(digits: int) -> Column:
        # Bytes as hex digits order like the term; a shorter term is filled up below all others.
        return F.rpad(F.substring(F.hex(F.encode("term", "UTF-8")), 1, digits), digits, "0")

    prefix, left = "", n
    longest = 2 * int(terms.agg(F.max(F.octet_length("term"))).first()[0])
    while True:
        inside = terms.filter(head(len(prefix)) == prefix) if prefix else terms
        sizes = sorted(tuple(r) for r in inside.groupBy(head(len(prefix) + 3).alias("h")).agg(F.count(F.lit(1))).collect())
        for prefix, size in sizes:  # noqa: B007 - goes on with the group it stops at
            if size >= left:
                break
            left -= size
        if size <= LAST_TERMS or len(prefix) > longest:
            return inside.filter(head(len(prefix)) == prefix).orderBy("term").limit(left).collect()[-1]["term"]


def top_terms(stats: DataFrame, m: int) -> DataFrame:
    """The ``m`` rows of ``stats(space, term, df, tf)`` with the most occurrences, then in byte order.

    ``stats`` is of one space and stored: it is read a few times.  Rows pass a
    filter; they are never sorted, and never brought together in one task.
    """
    cut = _count_cut(stats, m)
    if cut is None:
        return stats
    count, left = cut
    tied = stats.filter(F.col("tf") == count)
    last = _term_cut(tied, left)
    return stats.filter((F.col("tf") > count) | ((F.col("tf") == count) & (F.col("term") <= F.lit(last))))


def fit_vocabulary(counts: DataFrame, n_docs: int, specs: dict[str, SpaceSpec]) -> Vocabulary:
    """The terms of each space within its document-frequency limits.

    A caller's ``max_features`` keeps the terms with the most occurrences, then
    alphabetical order.  ``counts`` are read once and need not be stored: what is
    written is a row per term, not per term and document.  They may be ``summed``.
    """
    df, tf = (F.sum("df"), F.sum("tf")) if "df" in counts.columns else (F.count(F.lit(1)), F.sum("n"))
    stats = counts.groupBy("space", "term").agg(df.alias("df"), tf.alias("tf"))
    return fit_stats(stored(stats, "term-stats"), n_docs, specs, at_rest=True)


def fit_stats(stats: DataFrame, n_docs: int, specs: dict[str, SpaceSpec], at_rest: bool = False) -> Vocabulary:
    """``fit_vocabulary`` from ``stats(space, term, df, tf, ...)``, a row per term; other columns are kept.

    ``at_rest`` says that ``stats`` are stored already.
    """
    chosen = None
    for space, spec in specs.items():
        found = stats.filter(F.col("space") == space).filter(
            (F.col("df") >= spec.min_df) & (F.col("df") <= spec.max_df * n_docs)
        )
        if spec.max_features is not None:
            found = top_terms(found if at_rest else stored(found, "term-stats"), spec.max_features)
        chosen = found if chosen is None else chosen.unionByName(found)
    return Vocabulary(chosen.withColumn("idf", smooth_idf(F.col("df"), n_docs)).drop("tf"), n_docs)


def raw_weights(counts: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Counts of known terms with ``raw``, sublinear tf x idf, and ``df``.

    The join is left to the engine: it broadcasts a small vocabulary and splits
    the partitions of terms that most documents hold.
    """
    return counts.join(vocabulary.terms, ["space", "term"]).withColumn(
        "raw", (F.log(F.col("n").cast("double")) + 1.0) * F.col("idf")
    )


def weigh(counts: DataFrame, vocabulary: Vocabulary, id_col: str) -> DataFrame:
    """``(id_col, space, term, df, weight)``: sublinear tf x idf, unit length per space.

    Terms outside the vocabulary are gone before the length is taken.
    """
    length = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(id_col, "space")))
    return raw_weights(counts, vocabulary).select(
        id_col, "space", "term", "df", (F.col("raw") / length).alias("weight")
    )

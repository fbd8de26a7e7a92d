"""Spelling variants grouped under their usual form.

Two words are near if one inserted, deleted or replaced code point makes one
the other.  Asymmetric q-chunks find such pairs without comparing all words:

* The longer word (either, if equal) contributes two disjoint chunks, its
  halves.  One edit lies in one half and leaves the other as it is.
* The other word contributes its positional grams: the substrings that a whole
  half can be found as.  A first half keeps its place; a last half is shifted
  by the difference in length, one at most.
* A half alone is shared by too many words of a large vocabulary.  The damaged
  half is cut in two again, by the same argument one of its pieces is whole, and
  so on until the damaged piece has three code points at most.  So a key is a
  chunk with the whole pieces of the other, and what meets under a key agrees in
  all but three neighbouring letters.
* Pairs that meet are verified by their edit distance.

Everything is a DataFrame expression; keys are 64-bit digests, so only words
and counts are shuffled.  No key is capped: the words under one differ in three
places of a small alphabet, so they are few however large the corpus is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replyloom.llm.common import store

RUN = r"[a-zÀ-ÿ]+"
MIN_LENGTH = 7
MIN_COUNT = 2
#: A word's form is this many times as frequent, at least.
RATIO = 10
#: The undamaged part of a word is all but this many code points at most.
PIECE = 3
#: One run in so many loses a letter.
SLIP_EVERY = 31
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def runs(text: Column) -> Column:
    """The letter runs of a text, A-Z lower-cased; none for null."""
    return F.regexp_extract_all(F.translate(text, _UPPER, _UPPER.lower()), F.lit(f"({RUN})"), 1)


def slipped(key: Column, run: Column, every: int = SLIP_EVERY) -> Column:
    """``run``, or ``run`` without one code point where the digest of key and run says so.

    A null key counts as empty text.
    """
    h = F.crc32(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    place = F.pmod(h, F.length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), place), F.substring(run, place + 2, F.length(run)))
    return F.when(F.pmod(h, F.lit(every)) == 0, cut).otherwise(run)


def corpus_words(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    slip_every: int | None = SLIP_EVERY,
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
) -> DataFrame:
    """(word, n): the runs of all whole texts with length and count enough.

    ``slip_every=None`` takes the runs as they are.  Counts are added up in
    every task before words are shuffled.  Repeated rows count each time.
    """
    found = documents.select(F.col(key).alias("k"), F.explode(runs(F.col(text))).alias("run"))
    word = F.col("run") if slip_every is None else slipped(F.col("k"), F.col("run"), slip_every)
    # A slip takes one letter at most: shorter runs need no digest.
    long_enough = found.filter(F.length("run") >= min_length).select(word.alias("word"))
    counted = long_enough.filter(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= min_count)


def _pieces(length: Column) -> Column:
    """How many pieces a word of this length has: halves cut in two until none is longer than ``PIECE``."""
    halvings = F.greatest(F.lit(2), F.ceil(F.log2(length / PIECE)).cast("int"))
    return F.pow(F.lit(2.0), halvings).cast("int")


def _keys(word: Column, partner: Column) -> Column:
    """Per damaged piece the digest of all else of a word, cut as a partner of that length is.

    What lies before the damaged piece keeps its place; what lies behind it is
    shifted by the difference in length.
    """
    shift, pieces = F.length(word) - partner, _pieces(partner)

    def key(i: Column) -> Column:
        begin = F.floor(partner * i / pieces).cast("int")
        end = F.floor(partner * (i + 1) / pieces).cast("int")
        behind = F.substring(word, end + shift + 1, partner)
        return F.xxhash64(i, partner, F.substring(word, F.lit(1), begin), behind)

    return F.transform(F.sequence(F.lit(0), pieces - 1), key)


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, n_a, b, n_b): every pair of near words once; ``words`` is (word, n), word unique.

    Words of one or two code points have pieces of no length; they are paired right all the same.
    """
    size = F.length("word")
    chunks = words.select(F.explode(_keys(F.col("word"), size)).alias("at"), F.col("word").alias("a"), F.col("n").alias("n_a"))
    # A partner is as long as the word, or longer by one.
    both = F.array_distinct(F.concat(_keys(F.col("word"), size), _keys(F.col("word"), size + 1)))
    grams = words.select(F.explode(both).alias("at"), F.col("word").alias("b"), F.col("n").alias("n_b"))
    longer = F.length("a") > F.length("b")
    met = chunks.join(grams, "at").filter(longer | ((F.length("a") == F.length("b")) & (F.col("a") < F.col("b"))))
    near = met.filter(F.levenshtein("a", "b", 1) == 1)
    # A pair may meet under two keys, as where one of two equal letters is gone.
    return near.select("a", "n_a", "b", "n_b").distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of each chain of forms, by pointer doubling.

    Counts rise along a chain by a factor, so chains are as short as the
    logarithm of the largest count, and end.
    """
    now = store(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        step = now.rows.select(F.col("word").alias("root"), F.col("root").alias("further"))
        after = store(
            now.rows.join(step, "root", "left").select(
                "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
            ),
            "spelling-roots",
        )
        now.drop()
        now = after
        if now.rows.filter("moved").isEmpty():
            return now.rows.select("word", "root")
        now = now._replace(rows=now.rows.drop("moved"))


def variant_groups(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """One row per word: word, n, n_near, form, form_n, root.

    ``form`` is the near word with the largest count (ties: the first in
    code-point order) if it occurs ``ratio`` times as often at least, else null;
    ``root`` ends the chain of forms, the word itself if it has none.  No words
    give no rows.
    """
    table = store(words.select("word", "n"), "spelling-words")
    pairs = store(near_pairs(table.rows), "spelling-pairs")
    ends = F.explode(
        F.array(
            F.struct(F.col("a").alias("word"), (-F.col("n_b")).alias("less"), F.col("b").alias("near")),
            F.struct(F.col("b").alias("word"), (-F.col("n_a")).alias("less"), F.col("a").alias("near")),
        )
    )
    best = (
        pairs.rows.select(ends.alias("e"))
        .select("e.*")
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct("less", "near")).alias("best"))
    )
    judged = table.rows.join(best, "word", "left")
    is_form = -F.col("best.less") >= ratio * F.col("n")
    found = store(
        judged.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, F.col("best.near")).alias("form"),
            F.when(is_form, -F.col("best.less")).alias("form_n"),
        ),
        "spelling-forms",
    )
    table.drop()
    pairs.drop()
    roots = _roots(found.rows.filter(F.col("form").isNotNull()).select("word", "form"))
    return found.rows.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``variant_groups`` of the words of whole texts.

    Null and empty texts hold no words; very long ones are read whole.  Repeated
    rows count each time; null keys are empty text for the slips.  Other columns
    are not carried, so their names do not matter.
    """
    return variant_groups(corpus_words(documents, key, text))

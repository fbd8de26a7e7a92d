"""Near duplicates by SimHash and covering locality-sensitive hashing.

A text's fingerprint has a bit set where most digests of its shingles have it.
For a radius r, every bit position gets a code of r + 1 bits, never zero; for
each non-zero vector v of r + 1 bits, a mask keeps the positions whose code has
odd overlap with v.  The codes of any r positions leave some v with even
overlap to all of them, so two fingerprints that differ in r positions at most
agree on that mask: every pair within the radius meets in some table.

Inside a table, a bucket of two is one comparison.  A larger bucket is never
paired off: each member is sent to itself and to every fingerprint one free bit
away, and all that arrive at the same place are within two bits of each other.
At most 65 fingerprints can arrive there, however hot the bucket was.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from replyloom.llm.common import LOWER, NOT_SPACE, Stored, Texts, chunks, split_words, store
from replyloom.llm.components import connected_components

SHINGLE_WORDS = 3
SEED = 42
RADIUS = 2
_BITS = 64


def _fingerprints(chunk: Texts, shingle: int) -> np.ndarray:
    data = LOWER[chunk.data]
    words = split_words(data, chunk.bounds, NOT_SPACE)
    n_words = np.diff(words.of_text)
    out = np.zeros(len(n_words), dtype=np.uint64)
    if not len(words.starts):
        return out
    # One space after each word, so that a shingle is one run of bytes.
    lengths = words.ends - words.starts
    begins = np.concatenate([[0], np.cumsum(lengths + 1)])
    source = np.repeat(words.starts - begins[:-1], lengths + 1) + np.arange(begins[-1])
    joined = np.concatenate([data, [0]])[source].astype(np.uint8)
    joined[begins[1:] - 1] = 0x20
    raw, ends = memoryview(joined.tobytes()), begins[1:] - 1
    n_shingles = np.where(n_words == 0, 0, np.maximum(n_words - shingle + 1, 1))
    of_shingle = np.concatenate([[0], np.cumsum(n_shingles)])
    text = np.repeat(np.arange(len(n_words)), n_shingles)
    first = words.of_text[text] + np.arange(of_shingle[-1]) - of_shingle[text]
    last = np.minimum(first + shingle, words.of_text[text + 1]) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(raw[b:e], SEED) for b, e in zip(begins[first].tolist(), ends[last].tolist())], dtype=np.uint64
    )
    filled = np.flatnonzero(n_shingles)
    for begin in range(0, len(filled), 256):  # bits take 64 bytes a shingle: not all at once
        some = filled[begin : begin + 256]
        low, high = of_shingle[some[0]], of_shingle[some[-1] + 1]
        bits = np.unpackbits(hashes[low:high].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts = np.add.reduceat(bits, of_shingle[some] - low, axis=0, dtype=np.int32)
        major = (2 * counts > n_shingles[some][:, None]).astype(np.uint8)
        out[some] = np.packbits(major, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def fingerprint(text: str | Column, shingle_words: int = SHINGLE_WORDS) -> Column:
    """SimHash of a text as a long.

    A-Z are lower-cased; a shingle is ``shingle_words`` consecutive words joined
    by spaces, repeats included, or the whole sequence of a shorter text.  A text
    without words, or null, has fingerprint zero.
    """

    @arrow_udf("long")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = [_fingerprints(chunk, shingle_words) for chunk in chunks(texts, 1 << 18)]
            yield pa.array(np.concatenate(parts).view(np.int64) if parts else [], pa.int64())

    # Never null, and the optimiser should know: a join on it would add a null check that runs it again.
    return F.coalesce(run(text), F.lit(0).cast("long"))


def covering_masks(radius: int = RADIUS, bits: int = _BITS) -> list[int]:
    """Masks such that any two words within ``radius`` bits agree on one of them."""
    n_codes = (1 << (radius + 1)) - 1
    codes = [1 + i % n_codes for i in range(bits)]
    return [sum(1 << i for i, code in enumerate(codes) if (code & v).bit_count() % 2) for v in range(1, n_codes + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def near_links(fingerprints: DataFrame) -> DataFrame:
    """Edges (u, v) that connect exactly what chains of links within two bits connect.

    ``fingerprints`` has one long column ``fp`` of distinct values.
    """
    masks = [_signed(m) for m in covering_masks()]
    tables = F.array(
        *[F.struct(F.lit(t).alias("t"), F.lit(m).alias("mask"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("slot")) for t, m in enumerate(masks)]
    )
    placed = fingerprints.select("fp", F.explode(tables).alias("x")).select("x.*", "fp")
    buckets = placed.groupBy("t", "slot").agg(
        F.count(F.lit(1)).alias("n"), F.min("fp").alias("u"), F.max("fp").alias("v")
    )
    couples = buckets.filter(F.col("n") == 2).filter(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= RADIUS)
    crowded = placed.join(buckets.filter("n > 2").select("t", "slot"), ["t", "slot"], "left_semi")
    flips = [(t, [0] + [_signed(1 << i) for i in range(_BITS) if not m & (1 << i)]) for t, m in enumerate(covering_masks())]
    free = F.element_at(F.array(*[F.array(*[F.lit(b).cast("long") for b in bits]) for _, bits in flips]), F.col("t") + 1)
    places = crowded.select("fp", F.explode(free).alias("bit")).select(
        F.col("fp").bitwiseXOR(F.col("bit")).alias("place"), "fp"
    )
    meetings = places.groupBy("place").agg(F.collect_set("fp").alias("all")).filter(F.size("all") > 1)
    stars = meetings.select(F.array_min("all").alias("u"), F.explode("all").alias("v")).filter("u <> v")
    return couples.select("u", "v").unionByName(stars)


def near_duplicates(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: the key, ``fingerprint`` (16 hex digits) and ``component_id``.

    ``component_id`` is the smallest key that chains of links reach; two texts
    link when their fingerprints differ in two bits at most.  Texts without words
    share fingerprint zero and so link to each other.  Repeated rows stay and link
    to themselves; a null key is never the smallest unless the component has no
    other, whose id is then null.  Other columns are not carried.  No row is
    paired with every copy of itself: copies meet in one fingerprint first.
    """
    marked = store(documents.select(F.col(key).alias("id"), fingerprint(F.col(text)).alias("fp")), "fingerprints").rows
    found = fingerprint_components(marked)
    return marked.join(found.rows, "fp").select(
        F.col("id").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def fingerprint_components(marked: DataFrame) -> Stored:
    """Per distinct ``fp`` of ``marked`` (id, fp) its root and the component's smallest id."""
    distinct = store(marked.groupBy("fp").agg(F.min("id").alias("least")), "distinct-fingerprints")
    edges = store(near_links(distinct.rows.select("fp")).distinct(), "near-links")
    roots = connected_components(edges.rows, "near-components")
    rooted = distinct.rows.join(roots.rows, distinct.rows["fp"] == roots.rows["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    out = store(rooted.select("fp", "root").join(smallest, "root"), "fingerprint-components")
    for table in (distinct, edges, roots):
        table.drop()
    return out


def one_of_each_group(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle_words: int = SHINGLE_WORDS,
) -> DataFrame:
    """``documents`` with one row of each near-duplicate component, columns unchanged.

    The row with the smallest key stays (null last); among rows that share it, the one with
    the smallest fingerprint, and of those any one, since they link to each other.  Null and
    empty texts share fingerprint zero and so are one group.  An empty table stays empty.
    """
    own = documents.columns
    name = F.coalesce(F.col(key).cast("string"), F.lit("")).alias("__near_id")
    marked = documents.select(
        "*", F.col(key).isNull().alias("__near_none"), name, fingerprint(F.col(text), shingle_words).alias("__near_fp")
    )
    narrow = store(marked.select(F.col(key).alias("id"), F.col("__near_fp").alias("fp")), "fingerprints")
    found = fingerprint_components(narrow.rows)
    winners = store(
        narrow.rows.join(found.rows.select("fp", "root"), "fp")
        .groupBy("root")
        .agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "fp")).alias("first"))
        .select(
            F.col("first.none").alias("__near_none"),
            F.coalesce(F.col("first.id").cast("string"), F.lit("")).alias("__near_id"),
            F.col("first.fp").alias("__near_fp"),
        ),
        "near-winners",
    )
    narrow.drop()
    found.drop()
    where = ["__near_none", "__near_id", "__near_fp"]
    return marked.join(winners.rows, where, "left_semi").dropDuplicates(where).select(*own)

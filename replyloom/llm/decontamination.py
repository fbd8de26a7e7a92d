"""Benchmark decontamination by Wu-Manber search over words.

Patterns are the windows of ten words of each benchmark item (the whole item if
it is shorter); patterns of one length form a group.  For every block of two
words that some pattern holds, a shift table has the distance from its last
place in a pattern to the pattern's end; a block in no pattern lets the search
skip all window ends that would cover it.  Where the shift is zero, the hash of
the last words selects a bucket of patterns, and a direct comparison of the
words decides.  Texts are cut into lanes that advance side by side.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from replyloom.llm.common import ALNUM, LOWER, Words, chunks, mix, split_words, word_digests

WINDOW_WORDS = 10
#: Benchmark text that one search broadcasts; more text is searched in as many passes as needed.
SHARD_BYTES = 2 << 20
_BLOCK = 2
_SUFFIX = 4
_LANE = 512


class Group(NamedTuple):
    """Patterns of one length, ordered by the digest of their last words."""

    length: int
    shift: np.ndarray
    suffixes: np.ndarray
    digests: np.ndarray
    patterns: list[bytes]
    items: list[list[str]]


def _joined(raw: bytes, words: Words, first: int, length: int) -> bytes:
    cut = zip(words.starts[first : first + length].tolist(), words.ends[first : first + length].tolist())
    return b" ".join([raw[b:e] for b, e in cut])


def _slots(blocks: np.ndarray, table: np.ndarray) -> np.ndarray:
    return (blocks & np.uint64(len(table) - 1)).astype(np.int64)


def pattern_groups(items: pa.Table, window: int = WINDOW_WORDS) -> list[Group]:
    """Search tables of benchmark items, given as a table (id string, text)."""
    found: dict[int, dict[bytes, dict[str, None]]] = {}
    for chunk in chunks(items.column(1).combine_chunks()):
        data = LOWER[chunk.data]
        words, raw = split_words(data, chunk.bounds, ALNUM), data.tobytes()
        for text, row in enumerate(range(chunk.first, chunk.last)):
            begin, end = int(words.of_text[text]), int(words.of_text[text + 1])
            length = min(window, end - begin)
            name = items.column(0)[row].as_py()
            for first in range(begin, end - length + 1) if length else ():
                owners = found.setdefault(length, {}).setdefault(_joined(raw, words, first, length), {})
                if name is not None:
                    owners[name] = None
    return [_group(length, patterns) for length, patterns in sorted(found.items())]


def _group(length: int, patterns: dict[bytes, dict[str, None]]) -> Group:
    texts = list(patterns)
    data = np.frombuffer(b" ".join(texts), dtype=np.uint8)
    digests = word_digests(data, split_words(data, np.array([0, len(data)]), ALNUM)).reshape(-1, length)
    block, suffix = min(_BLOCK, length), min(_SUFFIX, length)
    size = 1 << max(12, int(4 * len(texts) * length).bit_length())
    shift = np.full(size, length - block + 1, dtype=np.int32)
    for last in range(block - 1, length):
        blocks = window_digests_of(digests[:, last - block + 1 : last + 1])
        np.minimum.at(shift, _slots(blocks, shift), length - 1 - last)
    suffixes = window_digests_of(digests[:, length - suffix :])
    order = np.argsort(suffixes, kind="stable")
    return Group(
        length, shift, suffixes[order], digests[order], [texts[i] for i in order], [list(patterns[texts[i]]) for i in order]
    )


def window_digests_of(columns: np.ndarray) -> np.ndarray:
    """The digest of each row of word digests, as ``window_digests`` makes it."""
    out = columns[:, 0]
    for k in range(1, columns.shape[1]):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) ^ columns[:, k])
    return out


def _window_ends(digests: np.ndarray, of_text: np.ndarray, group: Group) -> np.ndarray:
    """Last words of windows that the shift table cannot rule out."""
    length, block = group.length, min(_BLOCK, group.length)
    low, high = of_text[:-1] + length - 1, of_text[1:]
    n_lanes = np.maximum(0, -(-(high - low) // _LANE))
    text = np.repeat(np.arange(len(low)), n_lanes)
    at = low[text] + _LANE * (np.arange(len(text)) - np.repeat(np.cumsum(n_lanes) - n_lanes, n_lanes))
    stop = np.minimum(at + _LANE, high[text])
    found = []
    while len(at):
        blocks = digests[at - block + 1]
        for k in range(block - 2, -1, -1):
            blocks = mix(blocks * np.uint64(0x9E3779B97F4A7C15) ^ digests[at - k])
        skip = group.shift[_slots(blocks, group.shift)]
        found.append(at[skip == 0])
        at = at + np.maximum(skip, 1)
        alive = at < stop
        at, stop = at[alive], stop[alive]
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def _occurrences(raw: bytes, words: Words, digests: np.ndarray, group: Group) -> Iterator[tuple[int, int]]:
    """(first word, pattern) of every occurrence of the group's patterns."""
    length, suffix = group.length, min(_SUFFIX, group.length)
    ends = _window_ends(digests, words.of_text, group)
    if not len(ends):
        return
    tails = window_digests_of(np.stack([digests[ends - k] for k in range(suffix - 1, -1, -1)], axis=1))
    low = np.searchsorted(group.suffixes, tails, "left")
    size = np.searchsorted(group.suffixes, tails, "right") - low
    rows = np.repeat(np.arange(len(ends)), size)
    pattern = low[rows] + np.arange(len(rows)) - np.repeat(np.cumsum(size) - size, size)
    first = ends[rows] - length + 1
    alike = np.ones(len(rows), dtype=bool)
    for k in range(length):
        alike &= digests[first + k] == group.digests[pattern, k]
    for f, p in zip(first[alike].tolist(), pattern[alike].tolist()):
        if _joined(raw, words, f, length) == group.patterns[p]:
            yield f, p


_SPAN = pa.struct([("begin", pa.int64()), ("end", pa.int64())])
_FOUND = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(_SPAN)), ("items", pa.list_(pa.string()))])
_FOUND_SQL = "n_words long, spans array<struct<begin: long, end: long>>, items array<string>"


def search_texts(texts: pa.Array, groups: list[Group]) -> pa.Array:
    """Per text its number of words, merged word spans that are hit, and the items found."""
    out = []
    for chunk in chunks(texts):
        data = LOWER[chunk.data]
        words, raw = split_words(data, chunk.bounds, ALNUM), data.tobytes()
        digests = word_digests(data, words)
        cover = np.zeros(len(digests) + 1, dtype=np.int64)
        items: dict[int, set[str]] = {}
        for group in groups:
            hits = list(_occurrences(raw, words, digests, group))
            if not hits:
                continue
            first = np.array([f for f, _ in hits])
            np.add.at(cover, first, 1)
            np.add.at(cover, first + group.length, -1)
            for (_, p), text in zip(hits, (np.searchsorted(words.of_text, first, "right") - 1).tolist()):
                items.setdefault(text, set()).update(group.items[p])
        # A window never leaves its text, so neither do runs of hit words once cut at the bounds.
        hit = np.cumsum(cover[:-1]) > 0
        runs = split_words(hit.astype(np.uint8), words.of_text, np.array([False, True] + [False] * 254))
        for text, n_words in enumerate(np.diff(words.of_text).tolist()):
            begin, of = int(words.of_text[text]), slice(runs.of_text[text], runs.of_text[text + 1])
            spans = [
                {"begin": b - begin, "end": e - begin}
                for b, e in zip(runs.starts[of].tolist(), runs.ends[of].tolist())
            ]
            out.append({"n_words": n_words, "spans": spans, "items": sorted(items.get(text, ()))})
    return pa.array(out, _FOUND)


def _shards(benchmark: DataFrame, item: str, text: str, shard_bytes: int) -> Iterator[pa.Table]:
    plain = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).cast("string").alias("text"))
    plain = plain.filter(F.col("text").isNotNull())
    total = plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-int(total) // shard_bytes))
    for i in range(n):
        yield plain.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == i).toArrow()


def benchmark_hits(
    text: str | Column,
    benchmark: DataFrame,
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW_WORDS,
    shard_bytes: int = SHARD_BYTES,
) -> Column:
    """struct(n_words, spans, items) per text.

    ``spans`` are ranges of words inside an occurrence of a window, ``items`` the
    ids of items with an occurring window, as sorted strings.  The benchmark is
    broadcast in shards of ``shard_bytes`` of text; with more than one, the texts
    pass each shard in the same task and the findings are united.
    """
    session = benchmark.sparkSession.sparkContext

    def search(shard: pa.Table) -> Column:
        tables = session.broadcast(pattern_groups(shard, window))

        @arrow_udf(_FOUND_SQL)
        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for texts in batches:
                yield search_texts(texts, tables.value)

        return run(text)

    parts = [search(shard) for shard in _shards(benchmark, item, item_text, shard_bytes)]
    if len(parts) == 1:
        return parts[0]
    return F.struct(
        parts[0]["n_words"].alias("n_words"),
        F.concat(*[p["spans"] for p in parts]).alias("spans"),
        F.array_sort(F.array_distinct(F.concat(*[p["items"] for p in parts]))).alias("items"),
    )


def n_hit(spans: Column) -> Column:
    """Words in the union of spans, which may overlap."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("reach"))
    step = lambda a, s: F.struct(
        (a["n"] + F.greatest(F.lit(0).cast("long"), s["end"] - F.greatest(a["reach"], s["begin"]))).alias("n"),
        F.greatest(a["reach"], s["end"]).alias("reach"),
    )
    return F.aggregate(F.array_sort(spans), start, step, lambda a: a["n"])


def contamination(
    documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **options
) -> DataFrame:
    """One row per document: key, n_words, n_hit, items (sorted ids as strings), spans.

    Null and empty texts have no words; an item without words, or with a null
    text, has no windows; an item with a null id marks words but is not listed.
    Repeated documents are judged row by row, repeated items count once.  An
    empty benchmark finds nothing.  Other columns are not carried.
    """
    found = documents.select(F.col(key), benchmark_hits(F.col(text), benchmark, **options).alias("found"))
    return found.select(
        key,
        F.col("found.n_words").alias("n_words"),
        n_hit(F.col("found.spans")).alias("n_hit"),
        F.col("found.items").alias("items"),
        F.col("found.spans").alias("spans"),
    )


def without_benchmark(documents: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """``documents`` without those that hold a window of an item; columns unchanged."""
    return documents.filter(F.size(benchmark_hits(F.col(text), benchmark, **options)["spans"]) == 0)

"""Document quality by gradient-boosted trees over document statistics.

Statistics are cut into quantile bins once; a tree grows level by level from
histograms of gradients per node, statistic and bin.  All trees end up in flat
arrays of one row per tree, and a batch of texts walks all trees at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from replyloom.llm.common import LOWER, NOT_SPACE, Texts, byte_table, chunks, mix, per_text, split_words, word_digests
from replyloom.llm.labelled import training_rows
from replyloom.llm.quality_rules import repeated_window_words

#: Labelled documents that the fit may see; see ``training_rows``.
SAMPLE = 20_000
BINS = 64
DEPTH = 4
TREES = 120
RATE = 0.1
LEAST_LEAF = 10
L2 = 1.0
THRESHOLD = 0.5
_COUNTED = {
    "symbols": byte_table(*b"#*$%&|<>"),
    "pipes": byte_table(*b"|"),
    "shouts": byte_table(*b"!?"),
    "stops": byte_table(*b".,;:"),
    "digits": byte_table(*range(0x30, 0x3A)),
    "capitals": byte_table(*range(0x41, 0x5B)),
    "beyond": byte_table(*range(0x80, 0x100)),
    "lines": byte_table(0x0A),
}


def _chunk_statistics(chunk: Texts) -> np.ndarray:
    """One row per text; every statistic is a ratio but for the sizes."""
    data, bounds = chunk.data, chunk.bounds
    words = split_words(data, bounds, NOT_SPACE)
    n = np.diff(words.of_text).astype(np.float64)
    some, size = np.maximum(n, 1), np.maximum(np.diff(bounds), 1)
    counts = {name: per_text(table[data], bounds) for name, table in _COUNTED.items()}
    lower = LOWER[data]
    digests = word_digests(lower, words)
    text = np.repeat(np.arange(len(n)), np.diff(words.of_text))
    keys = digests ^ mix(text.astype(np.uint64))
    _, firsts = np.unique(keys, return_index=True)
    distinct = np.bincount(text[firsts], minlength=len(n)) if len(text) else np.zeros(len(n))
    lengths = (words.ends - words.starts).astype(np.float64)
    short = per_text(lengths <= 3, words.of_text)
    long = per_text(lengths >= 12, words.of_text)
    repeated = per_text(repeated_window_words(digests, words.of_text), words.of_text)
    sums = np.concatenate([[0.0], np.cumsum(lengths)])
    lines = np.zeros(len(n))
    for i, (begin, end) in enumerate(zip(bounds[:-1], bounds[1:])):
        parts = [x for x in data[begin:end].tobytes().split(b"\n") if x]
        lines[i] = (len(parts) - len(set(parts))) / max(1, len(parts))
    columns = [
        n,
        np.log1p(n),
        (sums[words.of_text[1:]] - sums[words.of_text[:-1]]) / some,
        distinct / some,
        short / some,
        long / some,
        repeated / some,
        lines,
        n / (counts["lines"] + 1),
    ]
    columns += [counts[name] / (some if name in ("symbols", "pipes", "shouts", "stops", "lines") else size) for name in _COUNTED]
    return np.stack(columns, axis=1)


def _statistics(texts: pa.Array) -> np.ndarray:
    parts = [_chunk_statistics(chunk) for chunk in chunks(texts)]
    return np.concatenate(parts) if parts else np.zeros((0, 9 + len(_COUNTED)))


def document_statistics(text: str | Column) -> Column:
    @arrow_udf("array<double>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(list(_statistics(texts)), pa.list_(pa.float64()))

    return run(text)


class Forest(NamedTuple):
    """Full binary trees in level order: node k has children 2k + 1 and 2k + 2.

    An inner node goes right where the statistic is above its cut; a node that
    was not split has an infinite cut.  ``leaves`` are the values below.
    """

    prior: float
    feature: np.ndarray
    cut: np.ndarray
    leaves: np.ndarray


def walk(forest: Forest, x: np.ndarray) -> np.ndarray:
    """Log-odds of each row."""
    tree = np.arange(len(forest.feature))[None, :]
    rows = np.arange(len(x))[:, None]
    node = np.zeros((len(x), len(forest.feature)), dtype=np.int64)
    inner = forest.feature.shape[1]
    while inner:
        node = 2 * node + 1 + (x[rows, forest.feature[tree, node]] > forest.cut[tree, node])
        inner = (inner - 1) // 2
    return forest.prior + forest.leaves[tree, node - forest.feature.shape[1]].sum(axis=1)


def _grow(binned: np.ndarray, cuts: list[np.ndarray], g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    n, d = binned.shape
    inner = 2**DEPTH - 1
    feature, cut, node = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(n, np.int64)
    for level in range(DEPTH):
        first, width = 2**level - 1, 2**level
        slot = ((node - first)[:, None] * d + np.arange(d)) * BINS + binned
        total = lambda w: np.bincount(slot.ravel(), np.repeat(w, d), width * d * BINS).reshape(width, d, BINS)
        G, H, N = (np.cumsum(total(w), axis=2) for w in (g, h, np.ones(n)))
        allG, allH, allN = G[:, :, -1:], H[:, :, -1:], N[:, :, -1:]
        gain = G**2 / (H + L2) + (allG - G) ** 2 / (allH - H + L2) - allG**2 / (allH + L2)
        gain[(N < LEAST_LEAF) | (allN - N < LEAST_LEAF)] = 0
        for k in range(width):
            f, b = np.unravel_index(np.argmax(gain[k]), gain[k].shape)
            if gain[k, f, b] > 1e-9 and b < len(cuts[f]):
                feature[first + k], cut[first + k] = f, cuts[f][b]
        right = np.zeros(n, dtype=bool)
        for k in range(width):
            here = node == first + k
            if np.isfinite(cut[first + k]):
                f = feature[first + k]
                right[here] = binned[here, f] > np.searchsorted(cuts[f], cut[first + k])
        node = 2 * node + 1 + right
    leaf = node - inner
    G, H = np.bincount(leaf, g, 2**DEPTH), np.bincount(leaf, h, 2**DEPTH)
    value = -RATE * G / (H + L2)
    return feature, cut, value, value[leaf]


def fit(x: np.ndarray, y: np.ndarray) -> Forest | None:
    """Logistic boosting; None without both labels."""
    if not len(y) or y.min() == y.max():
        return None
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for f in range(x.shape[1])]
    # A bin holds values above the cut before and up to its own.
    binned = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], axis=1)
    prior = float(np.log(y.sum() / (len(y) - y.sum())))
    score, trees = np.full(len(y), prior), []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        feature, cut, value, step = _grow(binned, cuts, p - y, p * (1 - p))
        trees.append((feature, cut, value))
        score += step
    return Forest(prior, *(np.stack(part) for part in zip(*trees)))


def learn_quality(documents: DataFrame, labels: DataFrame, key: str = "doc_id", sample: int = SAMPLE) -> Forest | None:
    rows = training_rows(documents, labels, "quality", document_statistics("text"), sample, key)
    x = np.array(rows.column(1).to_pylist(), dtype=np.float64)
    return fit(x, np.asarray(rows.column(0).combine_chunks(), dtype=np.float64))


def quality(text: str | Column, forest: Forest | None, documents: DataFrame) -> Column:
    """Probability that a text is of good quality; null and empty texts have statistics of zero.

    Without a forest, which no labels or labels of one kind give, it is zero.
    """
    if forest is None:
        return F.lit(0.0)
    shared = documents.sparkSession.sparkContext.broadcast(forest)

    @arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            x, parts = _statistics(texts), [np.zeros(0)]
            for begin in range(0, len(x), 4096):
                parts.append(1 / (1 + np.exp(-walk(shared.value, x[begin : begin + 4096]))))
            yield pa.array(np.concatenate(parts), pa.float64())

    return run(text)


def score_quality(
    documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE
) -> DataFrame:
    """One row per document: key and score; see ``quality``.

    Repeated rows and null keys are scored like any other; other columns are not carried.
    """
    docs = documents.select(F.col(key), F.col(text).alias("text"))
    forest = learn_quality(docs, labels, key, sample)
    return docs.select(key, quality("text", forest, docs).alias("score"))

"""Toxicity by a factorization machine over hashed terms.

A text is the set of buckets its words hash to.  Besides a weight per bucket the
model has a short vector per bucket; the dot product of two vectors is what the
two words mean together, which a sum of weights cannot say.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from replyloom.llm.common import LETTER, LOWER, Texts, chunks, split_words, word_digests
from replyloom.llm.labelled import training_rows

#: Labelled documents that the fit may see; see ``training_rows``.
SAMPLE = 20_000
BUCKETS = 1 << 20
#: Buckets that tell the classes apart best; all others have no weight.
TERMS = 512
FACTORS = 6
#: Chi-squared that a bucket must reach to count as a term; rare words get there by chance below it.
LEAST_GAIN = 30.0
THRESHOLD = 0.7
_ROUNDS, _RATE, _L2_WEIGHT, _L2_FACTOR = 500, 0.05, 3e-6, 1e-4


class Machine(NamedTuple):
    """``place`` maps a bucket to its row in ``weights`` and ``factors``, or -1."""

    place: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray


def _buckets(chunk: Texts) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) per word."""
    data = LOWER[chunk.data]
    words = split_words(data, chunk.bounds, LETTER)
    text = np.repeat(np.arange(len(words.of_text) - 1), np.diff(words.of_text))
    return text, (word_digests(data, words) & np.uint64(BUCKETS - 1)).astype(np.int64)


def hashed_terms(text: str | Column) -> Column:
    """The distinct buckets of a text's words, rising."""

    @arrow_udf("array<int>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            rows = []
            for chunk in chunks(texts):
                of, bucket = _buckets(chunk)
                both = np.unique(of * BUCKETS + bucket)
                cuts = np.searchsorted(both, np.arange(1, len(chunk.bounds) - 1) * BUCKETS)
                rows += np.split((both % BUCKETS).astype(np.int32), cuts)
            yield pa.array(rows, pa.list_(pa.int32()))

    return run(text)


def _scores(machine: Machine, of: np.ndarray, term: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds per text and the sums of factors, from distinct (text, term) pairs."""
    v = machine.factors[term]
    sums = np.stack([np.bincount(of, v[:, f], n) for f in range(v.shape[1])], axis=1)
    squares = np.bincount(of, (v * v).sum(axis=1), n)
    pairs = 0.5 * ((sums * sums).sum(axis=1) - squares)
    return machine.bias + np.bincount(of, machine.weights[term], n) + pairs, sums


def fit(rows: pa.Table) -> Machine | None:
    """Logistic loss with L2 penalties, by full-batch Adam; None without both labels."""
    y = np.asarray(rows.column(0).combine_chunks(), dtype=np.float64)
    if not len(y) or y.min() == y.max():
        return None
    lists = rows.column(1).combine_chunks()
    sizes = np.asarray(lists.value_lengths(), dtype=np.int64)
    bucket, of = np.asarray(lists.flatten(), dtype=np.int64), np.repeat(np.arange(len(y)), sizes)
    n1 = y.sum()
    with_term, toxic = np.bincount(bucket, minlength=BUCKETS), np.bincount(bucket, y[of], BUCKETS)
    expected = with_term * n1 / len(y)
    spread = expected * (1 - n1 / len(y)) + 1e-9
    gain = (toxic - expected) ** 2 / spread
    chosen = np.sort(np.argsort(-gain, kind="stable")[:TERMS])
    chosen = chosen[gain[chosen] >= LEAST_GAIN]
    place = np.full(BUCKETS, -1, dtype=np.int16)
    place[chosen] = np.arange(len(chosen))
    term = place[bucket].astype(np.int64)
    of, term = of[term >= 0], term[term >= 0]
    random = np.random.default_rng(7)
    machine = Machine(
        place, float(np.log(n1 / (len(y) - n1))), np.zeros(len(chosen)), random.normal(0, 0.01, (len(chosen), FACTORS))
    )
    first, second = np.zeros((len(chosen) + 1, FACTORS + 1)), np.zeros((len(chosen) + 1, FACTORS + 1))
    for t in range(1, _ROUNDS + 1):
        score, sums = _scores(machine, of, term, len(y))
        error = (1 / (1 + np.exp(-np.clip(score, -30, 30))) - y) / len(y)
        step = np.zeros_like(first)
        step[0, 0] = error.sum()
        step[1:, 0] = np.bincount(term, error[of], len(chosen)) + _L2_WEIGHT * machine.weights
        total = np.bincount(term, error[of], len(chosen))
        for f in range(FACTORS):
            cross = np.bincount(term, error[of] * sums[of, f], len(chosen))
            step[1:, 1 + f] = cross - total * machine.factors[:, f] + _L2_FACTOR * machine.factors[:, f]
        first = 0.9 * first + 0.1 * step
        second = 0.999 * second + 0.001 * step**2
        move = _RATE * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
        machine = Machine(place, machine.bias - move[0, 0], machine.weights - move[1:, 0], machine.factors - move[1:, 1:])
    return machine


def learn_toxicity(documents: DataFrame, labels: DataFrame, key: str = "doc_id", sample: int = SAMPLE) -> Machine | None:
    rows = training_rows(documents, labels, "toxic", hashed_terms("text"), sample, key)
    return fit(rows)


def toxicity(text: str | Column, machine: Machine | None, documents: DataFrame) -> Column:
    """Probability that a text is toxic; that of no known word for null and empty texts.

    Without a machine, which no labels or labels of one kind give, it is zero.
    """
    if machine is None:
        return F.lit(0.0)
    shared = documents.sparkSession.sparkContext.broadcast(machine)

    @arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        for texts in batches:
            parts = [np.zeros(0)]
            for chunk in chunks(texts):
                n = len(chunk.bounds) - 1
                of, bucket = _buckets(chunk)
                term = model.place[bucket].astype(np.int64)
                both = np.unique(of[term >= 0] * (len(model.weights) + 1) + term[term >= 0])
                score, _ = _scores(model, both // (len(model.weights) + 1), both % (len(model.weights) + 1), n)
                parts.append(1 / (1 + np.exp(-np.clip(score, -30, 30))))
            yield pa.array(np.concatenate(parts), pa.float64())

    return run(text)


def score_toxicity(
    documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE
) -> DataFrame:
    """One row per document: key and score; see ``toxicity``.

    Repeated rows and null keys are scored like any other; other columns are not carried.
    """
    docs = documents.select(F.col(key), F.col(text).alias("text"))
    machine = learn_toxicity(docs, labels, key, sample)
    return docs.select(key, toxicity("text", machine, docs).alias("score"))


def without_toxic(
    documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """``documents`` without those that score ``threshold`` or more; columns unchanged."""
    machine = learn_toxicity(documents.select(F.col(key), F.col(text).alias("text")), labels, key)
    return documents.filter(toxicity(F.col(text), machine, documents) < threshold)

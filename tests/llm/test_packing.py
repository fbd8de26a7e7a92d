import itertools
import random

import pytest
from cases import TEXTS, documents, words
from pyspark.sql import functions as F

from replyloom.llm import packing as P


def padding(lengths, counts, bounds):
    return sum(c * (min(b for b in bounds if b >= n) - n) for n, c in zip(lengths, counts))


@pytest.mark.parametrize("seed", range(12))
def test_bounds_pad_least(seed):
    random.seed(seed)
    lengths = sorted(random.sample(range(60), random.randrange(1, 10)))
    counts = [random.randrange(1, 50) for _ in lengths]
    buckets = random.randrange(1, 6)
    plan = P.plan_buckets(lengths, counts, buckets)
    options = [
        (*some, lengths[-1])
        for n in range(min(buckets, len(lengths)))
        for some in itertools.combinations(lengths[:-1], n)
    ]
    assert plan.padding == min(padding(lengths, counts, o) for o in options) == padding(lengths, counts, plan.bounds)
    assert len(plan.bounds) <= buckets and plan.bounds[-1] == lengths[-1]


def test_no_lengths():
    assert P.plan_buckets([], []) == P.Plan((), 0)


def test_every_word_is_packed_once_and_ranks_are_exact(spark):
    docs = documents(spark)
    rows = P.pack(docs, max_length=500, buckets=4, token_budget=1_000).collect()
    lengths = {}
    for k, t in TEXTS:
        lengths.setdefault(k, []).append(len(words(t)))
    covered = {}
    for r in rows:
        assert r.start == 500 * r.chunk and r.n_tokens <= r.pad_to
        covered.setdefault(r.doc_id, []).append(r.n_tokens)
    for k, sizes in lengths.items():
        assert sum(covered[k]) == sum(sizes)
        assert len(covered[k]) == sum(max(1, -(-n // 500)) for n in sizes)
    bounds = sorted({r.pad_to for r in rows})
    assert len(bounds) <= 4
    for r in rows:
        assert r.pad_to == min(b for b in bounds if b >= r.n_tokens)
    for bound in bounds:
        inside = [r for r in rows if r.pad_to == bound]
        capacity = max(1, 1_000 // max(bound, 1))
        places = sorted((r.batch, r.slot) for r in inside)
        assert places == [(i // capacity, i % capacity) for i in range(len(inside))]
        ordered = sorted(inside, key=lambda r: (r.batch, r.slot))
        keys = [(r.doc_id is not None, r.doc_id or 0, r.chunk) for r in ordered]
        assert keys == sorted(keys)


def test_own_length_column(spark):
    rows = P.pack(documents(spark), length=F.lit(7)).collect()
    assert len(rows) == len(TEXTS) and {(r.n_tokens, r.pad_to) for r in rows} == {(7, 7)}


def test_empty_table(spark):
    assert P.pack(documents(spark, [])).collect() == []

"""Terms are counted where they are made, and postings are named without a join of their own."""

import inspect
from collections import Counter

import pytest
from pyspark.sql import functions as F

from replyloom.operators import heldout, retrieval, tfidf
from replyloom.plans import queries
from tests.test_retrieval_and_model import pairs
from tests.test_round3 import plan

ROWS = [(1, "the cat the cat"), (1, "the dog"), (2, "é x ab"), (None, "ab ab"), (None, "cat"), (3, None), (4, ""), (5, " a-b  日本 ")]


def plain_counts(rows):
    out = Counter()
    for i, text in rows:
        words = [w for w in (text or "").split(" ") if w]
        for padded in (f" {w} " for w in words):
            for n in range(3, min(5, len(padded)) + 1):
                out.update((i, "char", padded[at : at + n]) for at in range(len(padded) - n + 1))
        tokens = {"the", "cat", "dog", "ab", "日本"}
        said = [w for w in words if w in tokens]
        out.update((i, "word", w) for w in said)
        out.update((i, "word", f"{a} {b}") for a, b in zip(said, said[1:]))
    return dict(out)


@pytest.mark.parametrize("most", [1, 8, 1 << 18])
def test_terms_are_counted_in_tasks(spark, monkeypatch, most):
    """texts of one id, also of no id, are one text, wherever a piece of texts ends; no row per occurrence."""
    monkeypatch.setattr(tfidf, "PIECE_CHARS", most)
    df = spark.createDataFrame(ROWS, "i long, t string")
    counts = tfidf.term_counts(df, "i", "t")
    found = counts.collect()
    assert len(found) == len({(r["i"], r["space"], r["term"]) for r in found})
    assert {(r["i"], r["space"], r["term"]): r["n"] for r in found} == plain_counts(ROWS)
    assert "Generate" not in plan(counts) and "HashAggregate" not in plan(counts)


def test_a_text_in_many_pieces_is_counted_once(spark, monkeypatch):
    """what is carried from piece to piece stays apart by id."""
    monkeypatch.setattr(tfidf, "PIECE_CHARS", 12)
    rows = [(i, t) for i in (1, 2) for t in ("ab", "the cat", "ab the") * 5] + [(3, "dog")]
    df = spark.createDataFrame(rows, "i long, t string").coalesce(1)
    found = {(r["i"], r["space"], r["term"]): r["n"] for r in tfidf.term_counts(df, "i", "t").collect()}
    assert found == plain_counts(rows)


def test_postings_meet_no_join(spark):
    """terms and ids come to a block; weights pass no exchange once they are unpacked."""
    index = retrieval.build_retrieval_corpus(pairs(spark), block_chars=40)
    lines = plan(index.postings).split("\n")
    made = next(i for i, line in enumerate(lines) if "FlatMapCoGroupsInArrow" in line)
    assert not [line for line in lines[:made] if "Join" in line or "Exchange" in line]
    corpus = index.corpus.select("customer_tweet_id", "normalized")
    vocabulary = tfidf.Vocabulary(index.vocabulary.terms.drop("key"), index.vocabulary.n_docs)
    weights = tfidf.weigh(tfidf.term_counts(corpus, "customer_tweet_id", "normalized"), vocabulary, "customer_tweet_id")
    want = {(r["space"], r["term"], r["customer_tweet_id"]): r["weight"] for r in weights.collect()}
    got = {(r["space"], r["term"], r["customer_tweet_id"]): r["weight"] for r in index.postings.collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_held_out_ids_are_found_once(spark, monkeypatch):
    """one pass over the keys of the pairs drops and counts the held-out ones."""
    calls, find = [], heldout.held_out_ids

    def counted(*args):
        calls.append(1)
        return find(*args)

    for module in (heldout, retrieval):
        monkeypatch.setattr(module, "held_out_ids", counted)
    cases = pairs(spark)
    one = cases.limit(1).select("thread_id", F.col("customer_text").alias("text"))
    held = spark.createDataFrame(one.collect(), one.schema)
    index = retrieval.build_retrieval_corpus(cases, held_out=held)
    assert len(calls) == 1
    kept = heldout.exclude_held_out(cases, held)
    assert index.excluded_rows == cases.count() - kept.count() > 0
    assert not index.corpus.join(kept, "customer_tweet_id", "left_anti").count()


def test_pairs_are_built_once_for_weak_labels():
    """the queries that read the pairs twice store them."""
    for name in ("train_intent_model", "evaluate_all"):
        assert "stored(_direct_pairs(" in inspect.getsource(queries.QUERIES[name])

import random

import pytest
from cases import PASSAGE, TEXTS, by_key, contamination, documents, rows_of

from replyloom.llm import decontamination as D

ITEMS = [
    (1, PASSAGE),
    (1, PASSAGE),
    (2, "zwei"),
    (3, None),
    (4, " .,; "),
    (None, "plain words in a line"),
    (10, "a b c"),
    (11, "b c a"),
    (12, "w5x5 " + " ".join(f"w{i}x{i % 31}" for i in range(6, 14)) + " nowhere"),
]


def items(spark, rows=ITEMS):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "item_id long, text string, found string, n_words long")


@pytest.mark.parametrize("shard_bytes", [D.SHARD_BYTES, 40])
def test_equals_comparing_everywhere(spark, shard_bytes):
    found = D.contamination(documents(spark), items(spark), shard_bytes=shard_bytes)
    mine = rows_of(found.select("doc_id", "n_words", "n_hit", "items"))
    assert mine == by_key((k, *contamination(t, ITEMS)) for k, t in TEXTS)


def test_random_texts_over_a_tiny_vocabulary(spark):
    """Overlapping, repeated and adjacent windows of every length."""
    random.seed(5)
    text = lambda n: " ".join(random.choice(("ab", "c", "d" * 20)) for _ in range(n))
    bench = [(i, text(random.randrange(1, 16))) for i in range(25)]
    docs = [(i, text(random.choice((0, 3, 30, 900)))) for i in range(40)]
    found = D.contamination(documents(spark, docs), items(spark, bench))
    mine = rows_of(found.select("doc_id", "n_words", "n_hit", "items"))
    assert mine == by_key((k, *contamination(t, bench)) for k, t in docs)


def test_shift_table_skips(spark):
    """A text without benchmark blocks is looked at once per nine words, not once per word."""
    import numpy as np
    import pyarrow as pa

    from replyloom.llm.common import ALNUM, LOWER, chunks, split_words, word_digests

    group = D.pattern_groups(pa.table({"item": ["1"], "text": [PASSAGE]}))[0]
    looked = []
    watched = group._replace(shift=group.shift)
    chunk = next(chunks(pa.array([" ".join(f"z{i}" for i in range(5000))])))
    data = LOWER[chunk.data]
    words = split_words(data, chunk.bounds, ALNUM)
    slots = D._slots
    try:
        D._slots = lambda blocks, table: looked.append(len(blocks)) or slots(blocks, table)
        ends = D._window_ends(word_digests(data, words), words.of_text, watched)
    finally:
        D._slots = slots
    assert len(ends) == 0 and sum(looked) < 5000 / 8 and np.max(group.shift) == 9


def test_spans_are_word_ranges(spark):
    spans = {r.doc_id: r.spans for r in D.contamination(documents(spark), items(spark)).collect()}
    assert [(s.begin, s.end) for s in spans[6]] == [(1, 13)]


def test_filter_keeps_columns_and_clean_rows(spark):
    docs = documents(spark)
    kept = D.without_benchmark(docs, items(spark))
    assert kept.columns == docs.columns
    clean = [(k, t) for k, t in TEXTS if not contamination(t, ITEMS)[1]]
    assert rows_of(kept.select("doc_id", "text")) == by_key(clean)


def test_empty_tables(spark):
    assert D.contamination(documents(spark, []), items(spark)).collect() == []
    none = D.contamination(documents(spark), items(spark, []))
    assert all(r.n_hit == 0 and r["items"] == [] for r in none.collect())

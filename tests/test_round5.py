"""Messages meet blocks in waves that tasks keep; what is stored on the way is small."""

import random

import numpy as np
import pyarrow as pa
import pytest

from replyloom.operators import blocks, retrieval, terms, tfidf, upkeep
from tests.test_retrieval_and_model import messages, pairs
from tests.test_round4 import ROWS


def _chunk(number, names, weights):
    rows = [(m, k, v) for (m, k), v in weights.items() if m in names]
    table = pa.table({"message_id": [m for m, _, _ in rows], "key": [k for _, k, _ in rows], "word": [k % 2 for _, k, _ in rows], "raw": [v for _, _, v in rows]})
    return blocks.pack_messages((pa.scalar(number),), table).to_pylist()[0]


@pytest.mark.parametrize("dense", [0, 2, 10**9])
def test_a_wave_of_chunks_has_the_products_of_each_chunk(monkeypatch, dense):
    """the messages of several chunks are multiplied together, with the results of one at a time."""
    random.seed(2)
    monkeypatch.setattr(blocks, "DENSE", dense)
    monkeypatch.setattr(blocks, "AT_ONCE", 16)
    weights = {(s, k): random.random() for s in range(6) for k in range(30) if random.random() < 0.5}
    asked = {(m, k): random.random() for m in "abcdefg" for k in range(5, 40) if random.random() < 0.5}
    block = blocks.pack_cases(
        (pa.scalar(9),),
        pa.table({"slot": [s for s, _ in weights], "key": [k for _, k in weights], "word": [k % 2 for _, k in weights], "raw": list(weights.values())}),
        pa.table({"slot": list(range(6)), "thread_id": list("abcabc")}),
    ).to_pylist()[0]
    chunks = [_chunk(3, "abc", asked), _chunk(8, "defg", asked)]
    wave = blocks.Wave(chunks)
    assert len(wave) == 7 and wave.numbers([8, 3], [1, 2]).tolist() == [4, 2]
    assert [x.tolist() for x in wave.places(np.array([4, 2]))] == [[8, 3], [1, 2]]
    word, char = wave.cosines(block, np.arange(7))
    each = [blocks._cosines({**block, **c}, np.arange(len(c["message_ids"]))) for c in chunks]
    assert np.allclose(word, np.concatenate([w for w, _ in each])) and np.allclose(char, np.concatenate([c for _, c in each]))
    some = wave.cosines(block, np.array([5, 0]))
    assert np.allclose(some[0], word[[5, 0]]) and np.allclose(some[1], char[[5, 0]])
    bound = wave.bounds(block, 0.65)
    assert (bound[:, None] >= 0.65 * word + 0.35 * char - 1e-9).all()


def test_waves_follow_from_messages_alone(spark):
    """F2-F4: more cases make no more waves and no table of messages and blocks."""
    index = retrieval.build_retrieval_corpus(pairs(spark), block_chars=1)
    asked = retrieval._chunks(messages(spark), index, "text")
    assert len(retrieval._waves(asked)) == 1 and index.blocks.count() > 2
    every = retrieval.bounds(asked, index).count()
    assert 0 < retrieval.bounds(asked, index, rising=True).count() <= every


def test_numbered_grams_are_the_listed_ones():
    """F1, F7-F10: an n-gram as a number of one digit per character."""
    words = ["a", "bb", "a-b.c", "𝒳y", "日本語テキスト", "zażółć", "x" * 9, "😀", "ab"]
    plain, code, starts = terms._listed_grams(words)
    names, numbers, begins = terms._numbered_grams(words)
    assert starts.tolist() == begins.tolist()
    for a, b in zip(starts, starts[1:]):
        assert sorted(plain.take(pa.array(code[a:b])).to_pylist()) == sorted(names.take(pa.array(numbers[a:b])).to_pylist())
    assert len(set(names.to_pylist())) == len(names)
    assert terms._numbered_grams([]) is None and terms._numbered_grams(["a\0b"]) is None
    many = [chr(0x4E00 + i) for i in range(8_000)]
    assert terms._numbered_grams(many) is None  # too many characters for one number


def test_idfs_meet_keys_by_range(spark):
    """blocks hold each idf once, and a term that the vocabulary left out has no posting."""
    index = retrieval.build_retrieval_corpus(pairs(spark), block_chars=40)
    kept = retrieval.build_retrieval_corpus(pairs(spark), retrieval.TriageConfig(max_features=5), block_chars=40)
    for one in (index, kept):
        seen = one.postings.select("space", "term").distinct()
        assert seen.exceptAll(one.vocabulary.terms.select("space", "term")).isEmpty()
        assert seen.count() == one.vocabulary.terms.count()
    row = index.blocks.first()
    distinct = np.frombuffer(row["idfs"], "f8")
    assert len(set(distinct)) == len(distinct) < len(row["words"])
    assert kept.vocabulary.terms.count() == 10


@pytest.mark.parametrize("bits", [1, 7])
def test_cut_keys_come_back_in_order(bits):
    """what is said of the keys of a pack is in the order of its keys, whatever the ranges."""
    keys = [5, -1, 1 << 62, -(1 << 63), 77]
    batch = pa.record_batch({"block": pa.array([4], pa.int64()), "keys": pa.array([keys], pa.list_(pa.int64()))})
    cuts = pa.Table.from_batches(list(blocks.cut_keys(bits, "block")(iter([batch]))))
    terms_ = pa.table({"key": pa.array(keys[:4], pa.int64()), "idf": [1.0, 2.0, 3.0, 4.0]})
    told = blocks.idfs_of_keys("block")((), cuts, terms_).to_pylist()
    said = np.frombuffer(b"".join(r["idfs"] for r in sorted(told, key=lambda r: r["part"])), "f8")
    assert np.array_equal(said, [1.0, np.nan, 3.0, 4.0, 2.0], equal_nan=True)


@pytest.mark.parametrize("most", [1, 8, 1 << 18])
def test_summed_counts_fit_the_same_vocabulary(spark, monkeypatch, most):
    """F7, F8: documents are added up where they are counted; one of several rows, or of no id, is one document."""
    for name in ("PIECE_CHARS", "SUM_CHARS"):
        monkeypatch.setattr(tfidf, name, most)
    df = spark.createDataFrame(ROWS + [(9, "the cat " * 4), (9, "dog the")], "i long, t string").coalesce(1)
    specs = {"word": tfidf.SpaceSpec(max_features=4), "char": tfidf.SpaceSpec()}
    plain, summed = (tfidf.term_counts(df, "i", "t", summed=s) for s in (False, True))
    assert summed.columns == ["space", "term", "df", "tf"]
    assert summed.count() < plain.count() or most < 10
    want, got = (sorted(tuple(r) for r in tfidf.fit_vocabulary(c, 7, specs).terms.collect()) for c in (plain, summed))
    assert want == got and len(got) > 20


def test_a_vocabulary_is_stored_by_term(spark, monkeypatch):
    """F7, F8: no row per term and document is written."""
    seen = []
    whole = tfidf.stored
    monkeypatch.setattr(tfidf, "stored", lambda df, label, *a, **k: seen.append((label, df.columns)) or whole(df, label, *a, **k))
    df = spark.createDataFrame(ROWS, "i long, t string")
    tfidf.fit_vocabulary(tfidf.term_counts(df, "i", "t", summed=True), 7, {"word": tfidf.SpaceSpec(max_features=2)}).terms.collect()
    assert seen == [("term-stats", ["space", "term", "df", "tf"])]


def test_a_ledger_has_a_row_per_text(spark):
    """counts are kept, joined and brought to their block text by text, not term by term."""
    cases = pairs(spark)
    ledger = upkeep.open_ledger(cases)
    assert ledger.listed.count() == ledger.pairs.select("text_key").distinct().count()
    texts = ledger.pairs.select("text_key", "normalized").distinct()
    want = {tuple(r) for r in tfidf.term_counts(texts, "text_key", "normalized").collect()}
    assert {tuple(r) for r in ledger.counts.select("text_key", "space", "term", "n").collect()} == want

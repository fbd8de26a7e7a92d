"""What keeps the cost of retrieval, checks and samples in proportion to the input."""

import inspect

import pytest
from pyspark.sql import functions as F

from replyloom.functions import text
from replyloom.operators import blocks, checks, judging, labels, retrieval, review
from tests.test_retrieval_and_model import CASES, KEPT, ASKED, found, messages, pairs, plain_retrieve


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_blocks_are_not_dealt_out_for_messages(spark, monkeypatch):
    """F1-F4: bounds and scores have no exchange below them that carries blocks; waves give the same cases."""
    index = retrieval.build_retrieval_corpus(pairs(spark), block_chars=40)
    asked = retrieval._chunks(messages(spark), index, "text")
    reach = retrieval.bounds(asked, index)
    assert "Exchange hashpartitioning" not in plan(reach)
    wanted = spark.createDataFrame([(0, 0, 0, 0.0)], "chunk long, asked int, block long, floor double")
    seen = plan(retrieval.scored(wanted, asked, index, 2))
    assert "levels" in seen and not [x for x in seen.split("\n") if "SortMergeJoin" in x and "chunk" in x]
    assert index.blocks.columns == blocks._names(blocks.BLOCK_SCHEMA) and "weights" not in index.blocks.columns
    monkeypatch.setattr(retrieval, "CHUNK_MESSAGES", 1)
    monkeypatch.setattr(retrieval, "WAVE_BYTES", 1)
    many = retrieval._chunks(messages(spark), index, "text")
    assert len(retrieval._waves(many, 2)) == many.count() > 1
    clean = [(c[0], c[1], c[2].lower(), c[3]) for c in KEPT]
    want = {m: b for m, b in plain_retrieve(clean, [ASKED[0], ASKED[1], ASKED[3]], 2).items() if b}
    assert found(retrieval.hybrid_retrieve(messages(spark), index, 2)) == want


def test_one_block_at_a_time_is_copied_out_of_a_batch():
    """rows of a batch are taken one by one."""
    import pyarrow as pa

    batch = pa.record_batch({"a": [1, 2, 3], "b": [b"x", b"y", b"z"]})
    rows = blocks._rows(iter([batch]))
    assert inspect.isgenerator(rows) and next(rows) == {"a": 1, "b": b"x"} and len(list(rows)) == 2


def test_the_key_of_a_text_brings_no_filter_to_the_scan(spark, tmp_path):
    """the text is normalised in one place of the plan."""
    spark.createDataFrame([("A b",), ("@x",), (None,)], "text string").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    found = checks.overlap(df, df, checks.matching_key("text"), checks.matching_key("text"), "x")
    assert found.first()["violations"] == 2  # null and "@x" are both empty
    assert "isnotnull(sha2" not in plan(found).lower()


TEXTS = ["", " ", None, "a", "@x", "@x 123456", "12345", "1234", "<URL>", "<url> @y", "www.x", "wWw.x y1", "a@b.co", "ß", " ", " é ",
         "http://x", "é.", ". .", "x@y.zz,", "<EMAIL", "日本", "HTTPS://ab <HANDLE>", "ww.a", "1\n<number>\n"]


def test_empty_for_matching_is_what_normalising_says(spark):
    """F13, and the redaction that is left out for texts without marks."""
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    for row in df.select("t", (text.normalize_for_matching("t") == "").alias("a"), text.is_empty_for_matching("t").alias("b")).collect():
        assert row["a"] == row["b"], row
    steps = F.coalesce(F.col("t"), F.lit(""))
    for pattern, mark in ((text.EMAIL_PATTERN, "<EMAIL>"), (text.URL_PATTERN, "<URL>"), (text.HANDLE_PATTERN, "<HANDLE>"), (text.NUMBER_PATTERN, "<NUMBER>")):
        steps = F.regexp_replace(steps, pattern, mark)
    plain = text.collapse_space(steps)
    bare = text.casefold(text.collapse_space(F.regexp_replace(plain, text.PLACEHOLDER_PATTERN, " ")))
    for row in df.select("t", plain.alias("a"), text.normalize_text("t").alias("b"), bare.alias("c"), text.normalize_for_matching("t").alias("d")).collect():
        assert row["a"] == row["b"] and row["c"] == row["d"], row


@pytest.mark.parametrize("n", [None, 3, 0])
def test_weak_labels_carry_no_text_to_the_first_of_a_text(spark, n, monkeypatch):
    """what is sampled is narrow; repeated rows, ids and null ids come out as before."""
    rows = [(i, f"the {w}") for i, w in enumerate("aabbcde")] + [(3, "the z"), (3, "the z"), (None, "und q"), (7, "@x"), (8, None)]
    df = spark.createDataFrame(rows, "customer_tweet_id long, customer_text string")
    seen, whole = [], labels.sample_n
    monkeypatch.setattr(labels, "sample_n", lambda d, *a: seen.append(d.columns) or whole(d, *a))
    got = labels.create_weak_labels(df, n, 42, (("en", "the"),))
    kept = sorted((r["customer_tweet_id"] if r["customer_tweet_id"] is not None else -1, r["customer_text"]) for r in got.collect())
    everything = [(-1, "und q"), (0, "the a"), (2, "the b"), (3, "the z"), (4, "the c"), (5, "the d"), (6, "the e")]
    assert seen == [["_key", "_id"]]
    assert kept == everything if n is None else set(kept) <= set(everything) and len(kept) == n


@pytest.mark.parametrize("call", [judging.judge_table, review.prepare_worksheet])
def test_predictions_are_worked_out_once(call):
    """F8, F12: the systems run once, not for each check."""
    source = inspect.getsource(call)
    assert source.index("stored(predictions") < source.index("enforce(")


def test_the_tasks_of_a_judge_do_not_grow_without_end(spark, monkeypatch, tmp_path):
    """F8: every key is answered, by no more tasks than stated."""
    monkeypatch.setattr(judging, "ASK_TASKS", 3)
    content = spark.range(40).select(
        F.col("id").cast("string").alias("cache_key"), *[F.lit("x").alias(c) for c in ("customer_text", "draft_reply", "evidence_json")]
    )

    def score(batch):
        return batch[["cache_key"]].assign(rationale="r", **dict.fromkeys(judging.RUBRIC_FIELDS, 3))

    answers = judging.ask_and_log(content, score, str(tmp_path / "log"), together=1)
    assert answers.count() == 40 and len(list((tmp_path / "log").glob("*.parquet"))) <= 3

import importlib

import pytest
from pyspark.sql import functions as F

from replyloom.config import TriageConfig
from replyloom.functions.values import RUBRIC_FIELDS, fingerprint
from replyloom.operators import checks, evaluation, judging, model, retrieval, review
from replyloom.sources import artifacts, tables

QUEUE = (
    "example_id string, text string, thread_id string, intent string, decision string, reviewed string, "
    "escalation_reason string, required_reply_points string, forbidden_claims string, annotator string, label_source string"
)
INTENTS = ("a", "b", "c")


def queue(spark, rows):
    return spark.createDataFrame([(*r, "", "", "", "", "") for r in rows], QUEUE)


def test_annotation_progress_counts(spark):
    rows = [
        ("1", "one text", "t1", "a", "escalate", "yes"),
        ("2", "One  TEXT", "t2", "a", "escalate", "yes"),
        ("3", "two text", "t1", "a", "escalate", "yes"),
        ("4", "three text", "t4", "a", "auto_handle", " YES "),
        ("5", "four text", "t5", "b", "auto_handle", "yes"),
        ("6", "five text", "t6", "zzz", "auto_handle", "yes"),
        ("7", "six text", "t7", "a", "maybe", "yes"),
        ("8", "@x", "t8", "a", "escalate", "yes"),
        ("9", "seven text", " ", "a", "escalate", "yes"),
        ("10", "eight", "t10", "a", "escalate", "no"),
    ]
    row = review.annotation_progress(queue(spark, rows), INTENTS, 150).first()
    assert (row["queue_rows"], row["reviewed_rows"], row["invalid_reviewed_rows"]) == (10, 9, 4)
    assert row["usable_unique_thread_rows"] == 3 and row["intent_counts"] == {"a": 2, "b": 1}
    assert row["intents_with_fewer_than_two_rows"] == {"b": 1} and row["unrepresented_intents"] == ["c"]
    assert row["additional_usable_rows_needed"] == 247 and not row["split_precheck_passed"]
    with pytest.raises(ValueError):
        review.annotation_progress(queue(spark, rows), INTENTS, 149)


def record(spark, **changes):
    base = dict(
        example_id="1", expected_text="one text", intent="a", decision="escalate", escalation_reason="why",
        required_reply_points="none", forbidden_claims="none", annotator=" me ",
    )
    base.update(changes)
    return spark.createDataFrame([tuple(base.values())], ", ".join(f"{k} string" for k in base))


ROWS = [("1", "one text", "t1", "", "", "no"), ("2", "@x", "t2", "", "", "no"), ("3", "three", " ", "", "", "no")]


def test_apply_annotations(spark):
    updated, rejected = review.apply_annotations(queue(spark, ROWS), record(spark), INTENTS)
    row = updated.filter("example_id = '1'").first()
    assert (row["intent"], row["annotator"], row["reviewed"], row["label_source"]) == ("a", "me", "yes", "human")
    assert rejected.isEmpty() and review.pending_work(updated).count() == 2


@pytest.mark.parametrize(
    "changes, reason",
    [
        ({"intent": "zzz"}, "valid intent"),
        ({"decision": "maybe"}, "valid intent"),
        ({"annotator": " "}, "annotator"),
        ({"escalation_reason": ""}, "human review"),
        ({"forbidden_claims": ""}, "forbidden claims"),
        ({"expected_text": "old"}, "unknown or changed"),
        ({"example_id": "9"}, "unknown or changed"),
        ({"example_id": "2", "expected_text": "@x"}, "unusable"),
        ({"example_id": "3", "expected_text": "three"}, "unusable"),
    ],
)
def test_rejected_annotations(spark, changes, reason):
    before = queue(spark, ROWS)
    updated, rejected = review.apply_annotations(before, record(spark, **changes), INTENTS)
    assert reason in rejected.first()["reason"]
    assert sorted(updated.collect()) == sorted(before.collect())


def test_repeated_annotations_and_queue_ids(spark):
    twice = record(spark).union(record(spark))
    _, rejected = review.apply_annotations(queue(spark, ROWS), twice, INTENTS)
    assert rejected.count() == 2
    with pytest.raises(ValueError, match="duplicate example_id"):
        review.apply_annotations(queue(spark, ROWS + ROWS), record(spark), INTENTS)


def predictions(spark):
    rows = [(f"e{i}", s, f"draft {i} é\nline", "{}") for i in range(2) for s in ("main", "keyword")]
    return spark.createDataFrame(rows, "example_id string, system string, draft_reply string, prediction_json string")


def golden(spark):
    return spark.createDataFrame([(f"e{i}", f"text {i}") for i in range(3)], "example_id string, text string")


def sample(spark):
    keyed = judging.keyed_content(predictions(spark), golden(spark), "m")
    return keyed.select(
        "example_id", "system", F.lit("m").alias("model"), F.lit("support-draft-v2").alias("rubric_version"), "cache_key"
    )


def test_worksheet_is_blind_and_merges_identical_rows(spark):
    sheet = review.prepare_worksheet(sample(spark), predictions(spark), golden(spark))
    assert sheet.columns == list(review.WORKSHEET_COLUMNS) and sheet.count() == 4
    first = sheet.filter("example_id = 'e0' AND system = 'main'").first()
    record_row = spark.createDataFrame(
        [("e0", "main", first["cache_key"], 1, 2, 3, 4, 5, "me")],
        "example_id string, system string, cache_key string, " + ", ".join(f"{f} int" for f in RUBRIC_FIELDS) + ", annotator string",
    )
    scored, rejected = review.apply_scores(sheet, record_row)
    assert rejected.isEmpty() and scored.filter("reviewed = 'yes'").count() == 1
    again = review.prepare_worksheet(sample(spark), predictions(spark), golden(spark), scored)
    assert sorted(again.collect()) == sorted(scored.collect())
    stale = record_row.withColumn("cache_key", F.lit("x")).union(record_row.withColumn("tone", F.lit(6)))
    untouched, refused = review.apply_scores(sheet, stale)
    assert refused.count() == 2 and untouched.filter("reviewed = 'yes'").isEmpty()
    with pytest.raises(ValueError, match="removed row with annotations"):
        one = sample(spark).filter("example_id = 'e1'")
        review.prepare_worksheet(one, predictions(spark), golden(spark), scored)
    with pytest.raises(ValueError, match="changed content"):
        changed = scored.withColumn("draft_reply", F.lit("edited"))
        review.prepare_worksheet(sample(spark), predictions(spark), golden(spark), changed)
    with pytest.raises(ValueError, match="invalid tone"):
        review.merge_worksheet(sheet, scored.withColumn("tone", F.lit("9")))
    with pytest.raises(ValueError, match="unexpected columns"):
        review.merge_worksheet(sheet, scored.withColumn("more", F.lit(1)))


def test_broken_json_and_empty_tables_raise(spark):
    broken = predictions(spark).union(
        spark.createDataFrame([("e2", "main", "d", '{"a": 1, "a": 2}'), ("e2", "keyword", "d", "{}")], predictions(spark).schema)
    )
    with pytest.raises(ValueError, match="malformed prediction"):
        review.prepare_worksheet(sample(spark), broken, golden(spark))
    for name in ("empty sample", "no predictions"):
        tables = {"empty sample": (sample(spark).limit(0), predictions(spark)), "no predictions": (sample(spark), predictions(spark).limit(0))}
        with pytest.raises(ValueError, match=name):
            review.prepare_worksheet(*tables[name], golden(spark))
    sheet = review.prepare_worksheet(sample(spark), predictions(spark), golden(spark))
    with pytest.raises(ValueError, match="malformed evidence_json"):
        review.merge_worksheet(sheet, sheet.withColumn("evidence_json", F.lit("[1e999]")))


@pytest.mark.parametrize(
    "change, message",
    [
        (lambda s: s.filter("system = 'main'"), "incomplete sample"),
        (lambda s: s.withColumn("rubric_version", F.lit("old")), "rubric_version"),
        (lambda s: s.withColumn("cache_key", F.lit("0" * 64)), "stale cache_key"),
        (lambda s: s.union(s.limit(1)), "duplicate judged pair"),
        (lambda s: s.withColumn("system", F.lit("ghost")), "without prediction"),
    ],
)
def test_worksheet_guards(spark, change, message):
    with pytest.raises(ValueError, match=message):
        review.prepare_worksheet(change(sample(spark)), predictions(spark), golden(spark))


def errors(spark):
    rows = [
        ("005", "main", "a", "escalate", "a", "auto_handle"),
        ("030", "main", "a", "auto_handle", "b", "auto_handle"),
        ("020", "main", "a", "auto_handle", "a", "escalate"),
        ("040", "main", "a", "auto_handle", "a", "auto_handle"),
        ("010", "main", "a", "escalate", "b", "auto_handle"),
        ("010", "other", "a", "escalate", "b", "auto_handle"),
    ]
    return spark.createDataFrame(
        rows, "example_id string, system string, actual_intent string, actual_decision string, predicted_intent string, predicted_decision string"
    )


def test_failure_queue_order_and_guards(spark):
    truth = spark.createDataFrame([(i, f"text {i}") for i in ("005", "010", "020", "030", "040")], "example_id string, text string")
    rows = review.failure_queue(errors(spark), truth).collect()
    assert [r["example_id"] for r in rows] == ["005", "010", "020", "030"]
    assert rows[0]["reviewed"] == "no" and rows[0]["proposed_fix"] == ""
    with pytest.raises(ValueError, match="golden example without prediction"):
        review.failure_queue(errors(spark), truth.union(spark.createDataFrame([("9", "x")], truth.schema)))
    with pytest.raises(ValueError, match="stale golden"):
        review.failure_queue(
            errors(spark), truth, manifest={"golden": fingerprint(truth)}, current={"golden": fingerprint(truth.limit(4))}
        )


def test_readiness_lists_blockers(spark):
    row = review.readiness_status(queue(spark, ROWS), None, None, None, {"metrics": False, "predictions": True}, INTENTS).first()
    assert (row["training_rows"], row["golden_rows"], row["reviewed_human_score_rows"]) == (0, 0, 0)
    assert len(row["blockers"]) == 4 and row["final_submission_ready"] is False


def gold(spark, n=150):
    rows = [
        (f"{i:04d}", f"golden question {chr(97 + i % 26)}{chr(97 + i // 26)}", "en" if i % 2 else "fr",
         "escalate" if i % 5 == 0 else "auto_handle", f"g{i}", f"9{i:04d}", "yes")
        for i in range(n)
    ]
    return spark.createDataFrame(
        rows, "example_id string, text string, intent string, decision string, thread_id string, tweet_id string, reviewed string"
    )


def training(spark):
    return gold(spark, 120).select(
        F.concat(F.lit("t"), "example_id").alias("example_id"),
        F.concat(F.lit("training "), F.when(F.col("intent") == "en", "music ").otherwise("invoice "), "text").alias("text"),
        "intent", "decision", F.concat(F.lit("t"), "thread_id").alias("thread_id"), "reviewed", F.lit("human").alias("label_source"),
    )


CONFIG = TriageConfig(intents=("en", "fr"), reply_templates={"other_unclear": "More?"})


def report(df):
    return {r["check"]: r["violations"] for r in df.collect()}


def test_golden_and_training_checks(spark):
    assert set(report(checks.golden_checks(gold(spark), ("en", "fr"))).values()) == {0}
    for size in (149, 251):
        assert report(checks.golden_checks(gold(spark, size), ("en", "fr")))["size"] == 1
    bad = gold(spark).withColumn("example_id", F.lit(" ")).withColumn("decision", F.lit("x"))
    got = report(checks.golden_checks(bad, ("en",)))
    assert (got["blank example_id"], got["invalid decision"], got["unknown intent"]) == (150, 150, 75)
    assert got["duplicate example_id"] == 149
    assert set(report(checks.training_checks(training(spark), ("en", "fr"))).values()) == {0}


def test_leakage_checks(spark):
    train = gold(spark, 2).withColumnRenamed("tweet_id", "customer_tweet_id")
    got = report(checks.leakage_checks(train, gold(spark)))
    assert got == {
        "training text": 2, "training thread_id": 2, "training example_id": 2, "training customer_tweet_id": 2
    }


def cases(spark):
    rows = [(str(i), f"c{i}", f"customer question {chr(97 + i)}", "Please restart it.") for i in range(5)]
    return spark.createDataFrame(rows, "customer_tweet_id string, thread_id string, customer_text string, brand_reply string")


def test_evaluate_all_and_its_guards(spark, tmp_path):
    fitted = model.train_intent_model(training(spark), "example_id", max_iter=20)
    index = retrieval.build_retrieval_corpus(cases(spark), held_out=gold(spark))
    result = evaluation.evaluate_all(gold(spark), training(spark), fitted, index, CONFIG)
    assert result.predictions.count() == 450
    rows = {r["system"]: r for r in result.metrics.collect()}
    assert rows["trivial"]["must_escalate_recall"] == 1.0 and rows["trivial"]["auto_handle_count"] == 0
    path = str(tmp_path / "report")
    artifacts.write_report(result, path)
    stored = artifacts.read_manifest(spark, path)
    written = spark.read.parquet(f"{path}/predictions")
    failures = review.failure_queue(
        written, gold(spark), manifest={k: stored[k] for k in ("golden", "predictions")},
        current={"golden": fingerprint(gold(spark)), "predictions": fingerprint(written)},
    )
    assert failures.count() >= 1
    with pytest.raises(ValueError, match="training text"):
        evaluation.evaluate_all(gold(spark), gold(spark, 120), fitted, index, CONFIG)
    other = retrieval.build_retrieval_corpus(cases(spark))
    with pytest.raises(ValueError, match="did not exclude"):
        evaluation.evaluate_all(gold(spark), training(spark), fitted, other, CONFIG)


def test_tables_round_trip(spark, tmp_path):
    rows = [("007", 'say "hi"\nnow, please', " padded "), ("NA", "", "x")]
    df = spark.createDataFrame(rows, "id string, text string, note string")
    tables.write_table(df, str(tmp_path / "t"), form="csv")
    back = tables.read_table(spark, str(tmp_path / "t"), ["id", "text", "note"])
    assert sorted(map(tuple, back.collect())) == sorted(rows)
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        tables.write_table(df, str(tmp_path / "t"), form="csv")


@pytest.mark.parametrize("form", ["csv", "parquet"])
def test_write_if_empty(spark, tmp_path, form):
    df = spark.createDataFrame([("1",)], "id string")
    path = str(tmp_path / "q")
    tables.write_if_empty(df.limit(0), path, form)
    tables.write_if_empty(df, path, form)
    with pytest.raises(ValueError, match="already has rows"):
        tables.write_if_empty(df, path, form)


def test_read_messages(spark, tmp_path):
    path = str(tmp_path / "m.csv")
    (tmp_path / "m.csv").write_text(
        ",".join(tables.MESSAGES.fieldNames()) + '\n1,c,True,now,"two\nlines, ""quoted""",,\n2,desk,False,now,ok,3,1\n'
    )
    rows = tables.read_messages(spark, path).orderBy("tweet_id").collect()
    assert rows[0]["text"] == 'two\nlines, "quoted"' and rows[0]["inbound"] is True
    assert rows[1]["in_response_to_tweet_id"] == 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tables.read_messages(spark, str(tmp_path / "none.csv"))


def test_contract(spark):
    contract = importlib.import_module("__spark_entry__")
    runs, sql = contract.queries(), contract.oracle_sql()
    assert set(sql) <= set(runs)
    assert contract.entry(spark).count() > 0

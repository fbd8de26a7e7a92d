import math
import os
import sys
import time
from collections import Counter
from pathlib import Path

import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from replyloom.functions.values import RUBRIC_FIELDS, RUBRIC_VERSION
from replyloom.operators import judging, labels, metrics

# The workers do not see the test folder.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PRED = "example_id string, system string, actual_intent string, actual_decision string, predicted_intent string, predicted_decision string"


def predictions(spark, rows, system="main"):
    data = [(f"e{i}", system, *r) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, PRED)


FOUR = [
    ("a", "escalate", "a", "auto_handle"),
    ("a", "escalate", "a", "escalate"),
    ("b", "auto_handle", "b", "auto_handle"),
    ("b", "auto_handle", "a", "auto_handle"),
]


def test_system_metrics_arithmetic(spark):
    row = metrics.system_metrics(predictions(spark, FOUR)).first()
    assert row["accuracy"] == 0.75 and row["must_escalate_recall"] == 0.5
    assert row["escalation_precision"] == 1.0 and row["escalation_f1"] == pytest.approx(2 / 3)
    assert (row["false_auto_handle_count"], row["must_escalate_count"], row["auto_handle_count"]) == (1, 2, 3)
    assert row["false_auto_handle_rate"] == 0.5 and row["auto_handle_coverage"] == 0.75
    assert row["false_auto_handle_fraction_among_auto_handled"] == pytest.approx(1 / 3)
    assert row["macro_f1"] == pytest.approx((0.8 + 2 / 3) / 2)


def test_ratios_without_a_denominator_are_zero(spark):
    row = metrics.system_metrics(predictions(spark, [("a", "auto_handle", "b", "escalate")])).first()
    assert row["must_escalate_recall"] == 0.0 and row["false_auto_handle_rate"] == 0.0
    assert row["false_auto_handle_fraction_among_auto_handled"] == 0.0 and row["macro_f1"] == 0.0
    report = {r["label"]: r for r in metrics.per_label_report(predictions(spark, [("a", "x", "b", "x")])).collect()}
    assert report["a"]["support"] == 1 and report["b"]["support"] == 0
    assert all(report[l][m] == 0.0 for l in "ab" for m in ("precision", "recall", "f1"))


def test_confusion_is_zero_filled(spark):
    cells = {(r["actual_intent"], r["predicted_intent"]): r["n"] for r in metrics.confusion(predictions(spark, FOUR)).collect()}
    assert cells == {("a", "a"): 2, ("a", "b"): 0, ("b", "a"): 1, ("b", "b"): 1}
    wide = metrics.confusion_wide(predictions(spark, FOUR), ["a", "b"]).orderBy("actual_intent").collect()
    assert [(r["a"], r["b"]) for r in wide] == [(2, 0), (1, 1)]


def test_averages(spark):
    row = metrics.averages(metrics.per_label_report(predictions(spark, FOUR))).first()
    assert row["weighted_recall"] == pytest.approx(0.75) and row["support"] == 4
    assert row["macro_precision"] == pytest.approx((2 / 3 + 1) / 2)


def test_prediction_checks(spark):
    df = predictions(spark, FOUR).unionByName(predictions(spark, [("a", "escalate", "a", "maybe")]))
    with pytest.raises(ValueError, match="duplicate prediction: 1; .*invalid decision: 1"):
        metrics.validate_predictions(df)


def annotations(spark, rows):
    return spark.createDataFrame(rows, "example_id string, annotator string, intent string, decision string")


def test_kappa_uses_exactly_two_annotations(spark):
    rows = []
    pairs = [("x", "x"), ("x", "y"), ("y", "y"), ("y", "y"), ("x", "x")]
    for i, (a, b) in enumerate(pairs):
        rows += [(f"e{i}", "ann", a, "escalate"), (f"e{i}", "bob", b, "escalate")]
    rows += [("solo", "ann", "x", "escalate")]
    rows += [("trio", n, "x", "escalate") for n in ("a", "b", "c")]
    rows += [("null", "ann", "x", "escalate"), ("null", None, "y", "escalate")]
    row = metrics.annotation_agreement(annotations(spark, rows)).first()
    po, pe = 4 / 5, (3 * 2 + 2 * 3) / 25
    assert row["intent_cohen_kappa"] == pytest.approx((po - pe) / (1 - pe))
    assert math.isnan(row["decision_cohen_kappa"]) and row["double_annotated_examples"] == 5
    with pytest.raises(ValueError, match="two annotations"):
        metrics.annotation_agreement(annotations(spark, rows[-6:-2]))


def scores(spark, values, **extra):
    rows = [(f"e{i}", "main", *[str(v)] * 5) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "example_id string, system string, " + ", ".join(f"{f} string" for f in RUBRIC_FIELDS))
    for name, value in extra.items():
        df = df.withColumn(name, F.lit(value))
    return df


def test_agreement_numbers(spark):
    judge = scores(spark, [1, 3, 4, 5], cache_key="k")
    human = scores(spark, [1, 4, "2.0", 5], cache_key="k", reviewed=" Yes", annotator="me")
    rows = judging.judge_human_agreement(judge, human).collect()
    assert {r["criterion"] for r in rows} == set(RUBRIC_FIELDS)
    for r in rows:
        assert r["spearman"] == pytest.approx(0.8)
        assert (r["exact_agreement"], r["within_one_agreement"], r["examples"]) == (0.5, 0.75, 4)


@pytest.mark.parametrize("seed", range(3))
def test_spearman_with_ties_equals_pandas(spark, seed):
    frame = pd.DataFrame({"x": [(i * 7 + seed) % 5 + 1 for i in range(40)], "y": [(i * i + seed) % 4 + 1 for i in range(40)]})
    counts = Counter(zip(frame.x, frame.y))
    df = spark.createDataFrame([("c", int(x), int(y), n) for (x, y), n in counts.items()], "k string, x int, y int, n long")
    want = frame.x.rank().corr(frame.y.rank())
    assert metrics.spearman_from_counts(df, "k").first()["spearman"] == pytest.approx(want)


def test_constant_scores_have_no_correlation(spark):
    rows = judging.judge_human_agreement(scores(spark, [3, 3, 3]), scores(spark, [1, 2, 3])).collect()
    assert all(math.isnan(r["spearman"]) for r in rows)


@pytest.mark.parametrize(
    "human, message",
    [
        ({"values": [1, 2], "cache_key": "other", "reviewed": "yes", "annotator": "me"}, "cache_key"),
        ({"values": [1, 2], "cache_key": "k", "reviewed": "yes", "annotator": " "}, "annotator"),
        ({"values": [1, "2.5"], "cache_key": "k", "reviewed": "yes", "annotator": "me"}, "invalid human"),
        ({"values": [1, 2], "cache_key": "k", "reviewed": "no", "annotator": "me"}, "no pair in common"),
        ({"values": [1, 2], "reviewed": "yes"}, "missing columns"),
    ],
)
def test_agreement_guards(spark, human, message):
    values = human.pop("values")
    with pytest.raises(ValueError, match=message):
        judging.judge_human_agreement(scores(spark, [1, 2], cache_key="k"), scores(spark, values, **human))


def drafts(spark):
    rows = []
    for i in range(3):
        for s in ("main", "trivial"):
            draft = "same" if s == "trivial" else f"draft {i}"
            rows.append((f"e{i}", s, draft, '{"evidence": [{"b": 1, "a": "é"}]}' if s == "main" else "{}"))
    return spark.createDataFrame(rows, "example_id string, system string, draft_reply string, prediction_json string")


def golden(spark):
    return spark.createDataFrame([(f"e{i}", "same text" if i < 2 else "other") for i in range(4)], "example_id string, text string")


def scorer(batch):
    assert batch["cache_key"].is_unique
    out = batch[["cache_key"]].copy()
    for f in RUBRIC_FIELDS:
        out[f] = batch["draft_reply"].str.len() % 5 + 1
    return out.assign(rationale="fresh")


def failing(batch):
    raise RuntimeError("the scorer must not be called")


def test_judge_scores_each_content_once_and_then_reads_the_cache(spark):
    run, cache = judging.judge_table(drafts(spark), golden(spark), scorer, "m", 3)
    rows = run.collect()
    assert len(rows) == 6 and {r["rubric_version"] for r in rows} == {RUBRIC_VERSION}
    trivial = {r["example_id"]: r["cache_key"] for r in rows if r["system"] == "trivial"}
    assert trivial["e0"] == trivial["e1"] != trivial["e2"]
    stored = spark.createDataFrame(cache.collect(), cache.schema)
    again, kept = judging.judge_table(drafts(spark), golden(spark), failing, "m", 3, cache=stored)
    assert sorted(map(str, again.collect())) == sorted(map(str, rows)) and kept.count() == 6
    with pytest.raises(Exception, match="must not be called"):
        judging.judge_table(drafts(spark), golden(spark), failing, "other", 3, cache=stored)[0].collect()


def test_invalid_cache_rows_are_not_used_but_kept(spark):
    _, cache = judging.judge_table(drafts(spark), golden(spark), scorer, "m", 3)
    stored = spark.createDataFrame(cache.collect(), cache.schema).withColumn("tone", F.lit(9))
    run, kept = judging.judge_table(drafts(spark), golden(spark), scorer, "m", 3, cache=stored.withColumn("example_id", F.lit("old")))
    assert {r["tone"] for r in run.collect()} <= {1, 2, 3, 4, 5}
    assert kept.count() == 12


def test_bad_scores_from_the_scorer_raise(spark):
    with pytest.raises(Exception, match="for tone"):
        judging.judge_table(drafts(spark), golden(spark), lambda b: scorer(b).assign(tone=6), "m", 3)[0].collect()


@pytest.mark.parametrize(
    "change, message",
    [
        (lambda a: a.iloc[1:], "every asked key once"),
        (lambda a: pd.concat([a, a.iloc[:1]]), "every asked key once"),
        (lambda a: pd.concat([a, a.iloc[:1].assign(cache_key="other")]), "every asked key once"),
        (lambda a: a.assign(tone=True), "for tone"),
        (lambda a: a.assign(tone=3.0), "for tone"),
        (lambda a: a.assign(tone="4"), "for tone"),
        (lambda a: a.assign(tone=0), "for tone"),
        (lambda a: a.assign(rationale=None), "rationale"),
        (lambda a: a.drop(columns="tone"), "lacks"),
    ],
)
def test_answers_are_checked_before_they_are_converted(change, message):
    asked = pd.DataFrame({"cache_key": ["a", "b"], "customer_text": "t", "draft_reply": ["x", "y"], "evidence_json": "[]"})
    assert len(judging.check_answers(asked, scorer(asked))) == 2
    with pytest.raises(ValueError, match=message):
        judging.check_answers(asked, change(scorer(asked)))


def test_the_scorer_is_asked_once_per_content(spark, tmp_path):
    asked = str(tmp_path / "asked")

    def counting(batch):
        with open(asked, "a") as out:
            out.writelines(f"{key}\n" for key in batch["cache_key"])
        answer = batch[["cache_key"]].copy()
        for field in ("relevance", "actionability", "grounding", "tone", "safety"):
            answer[field] = 3
        return answer.assign(rationale="counted")

    run, cache = judging.judge_table(drafts(spark), golden(spark), counting, "m", None)
    keys = {r["cache_key"] for r in run.collect()}
    cache.collect()
    run.collect()
    with open(asked) as seen:
        assert sorted(seen.read().split()) == sorted(keys)


def test_a_failed_run_keeps_its_answers(spark, tmp_path, monkeypatch):
    """The judge breaks down half way; the next run asks only what is not in the log."""
    monkeypatch.setattr(judging.ask_and_log, "__defaults__", (1,))
    asked, broken, log = str(tmp_path / "asked"), str(tmp_path / "broken"), str(tmp_path / "log")
    Path(broken).touch()

    def breaking(batch):
        # The drafts of one example are slow and fail while the judge is broken.
        if os.path.exists(broken) and (batch["draft_reply"].str.len() == 9).any():
            time.sleep(6)
            raise RuntimeError("the judge is gone")
        with open(asked, "a") as out:
            out.writelines(f"{key}\n" for key in batch["cache_key"])
        return scorer(batch)

    rows = [
        (f"e{i}", system, "x" * (5 + i) + ("" if i == 4 else "y" * 9), '{"intent": "a", "evidence": []}')
        for i in range(10)
        for system in ("main", "trivial", "keyword")
    ]
    predictions = spark.createDataFrame(rows, "example_id string, system string, draft_reply string, prediction_json string")
    gold = spark.createDataFrame([(f"e{i}", f"text {i}") for i in range(10)], "example_id string, text string")
    with pytest.raises(Exception, match="the judge is gone"):
        judging.judge_table(predictions, gold, breaking, "m", None, log=log)
    first = open(asked).read().split()
    kept = {r["cache_key"] for r in judging.logged_answers(spark, log).collect()}
    assert kept and kept <= set(first)
    os.remove(broken)
    run, cache = judging.judge_table(predictions, gold, breaking, "m", None, log=log)
    assert run.count() == 30 and cache.count() == 30
    again = open(asked).read().split()[len(first) :]
    keys = {r["cache_key"] for r in run.collect()}
    assert set(again) == keys - kept and len(again) == len(set(again)) == len(keys) - len(kept)
    third, _ = judging.judge_table(predictions, gold, failing, "m", None, log=log)
    assert sorted(map(str, third.collect())) == sorted(map(str, run.collect()))


def test_no_predictions_are_an_error(spark):
    with pytest.raises(ValueError, match="no predictions"):
        judging.judge_table(drafts(spark).limit(0), golden(spark), scorer, "m", 3)


def test_paired_sample_keeps_all_systems(spark):
    rows = judging.paired_sample(drafts(spark), 2, 1).collect()
    assert sorted(Counter(r["example_id"] for r in rows).values()) == [2, 2]
    assert judging.paired_sample(drafts(spark), 99, 1).count() == 6
    with pytest.raises(ValueError):
        judging.paired_sample(drafts(spark), 0, 1)


@pytest.mark.parametrize(
    "change, message",
    [
        (lambda p, g: (p.filter("NOT (example_id = 'e1' AND system = 'main')"), g), "without every system"),
        (lambda p, g: (p.union(p.limit(1)), g), "duplicate pair"),
        (lambda p, g: (p, g.filter("example_id <> 'e0'")), "unknown example_id"),
        (lambda p, g: (p, g.union(g.limit(1))), "duplicate golden"),
        (lambda p, g: (p.withColumn("prediction_json", F.lit("[1]")), g), "malformed"),
        (lambda p, g: (p.withColumn("prediction_json", F.lit('{"a":1,"a":2}')), g), "malformed"),
        (lambda p, g: (p.drop("draft_reply"), g), "missing columns"),
    ],
)
def test_judging_guards(spark, change, message):
    p, g = change(drafts(spark), golden(spark))
    with pytest.raises(ValueError, match=message):
        judging.judge_table(p, g, scorer, "m", 3)


def test_majority_first_seen_wins_a_tie(spark):
    df = spark.createDataFrame([(3, "b"), (1, "a"), (2, "b"), (4, "a"), (5, "c")], "o int, intent string")
    assert labels.majority_label(df, "o").first()["intent"] == "a"


def test_baselines(spark):
    df = spark.createDataFrame([("1", "hacked"), ("2", "the app"), ("3", "hm")], "id string, text string")
    rows = {r["id"]: r for r in labels.keyword_baseline(df).collect()}
    assert [rows[i]["predicted_decision"] for i in "123"] == ["escalate", "auto_handle", "escalate"]
    assert rows["1"]["draft_reply"].startswith("Thanks for contacting support")
    assert rows["2"]["draft_reply"] == "Thanks for contacting us about playback app issue. Please try the relevant help-center steps."
    assert rows["3"]["draft_reply"].startswith("Thanks for contacting us about other unclear.")


def test_weak_labels_and_queue(spark):
    rows = [(1, "t", "App crash", "r"), (2, "t", "app  CRASH", "r"), (3, "t", "@x", "r"), (4, "t", "refund", "r"), (5, "t", "refund @you", "r")]
    df = spark.createDataFrame(rows, "customer_tweet_id int, thread_id string, customer_text string, brand_reply string")
    got = labels.create_weak_labels(df, 100, 1).orderBy("customer_tweet_id").collect()
    assert [(r["customer_tweet_id"], r["intent"], r["rule_match"]) for r in got] == [
        (1, "playback_app_issue", "App"), (4, "billing_subscription", "refund")
    ]
    assert labels.create_weak_labels(df, 1, 1).count() == 1
    queue = labels.make_label_queue(df, 3, 1).orderBy("example_id").collect()
    assert [r["example_id"] for r in queue] == ["label-0000", "label-0001", "label-0002"]
    assert {r["reviewed"] for r in queue} == {"no"} and {r["intent"] for r in queue} == {""}

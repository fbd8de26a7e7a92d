import hashlib
import json

from pyspark.sql import functions as F

from replyloom.config import Policy
from replyloom.functions import rules, values
from replyloom.operators.policy import decide


def column(spark, values_, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values_)], "i int, t string")
    return [r["o"] for r in df.select("i", expression.alias("o")).orderBy("i").collect()]


def test_rule_priority_and_matched_text(spark):
    texts = [
        "They HACKED me and charged my card",
        "please cancel the premium plan",
        "the app is down",
        "refunds?",
        "nothing here",
        "shutdown",
    ]
    found = column(spark, texts, rules.rule_label("t"))
    assert [(r["intent"], r["rule_match"]) for r in found] == [
        ("account_security", "HACKED"),
        ("plan_change_cancel", "cancel"),
        ("service_outage", "down"),
        ("billing_subscription", "refunds"),
        ("other_unclear", ""),
        ("other_unclear", ""),
    ]


def test_matched_terms_are_whole_words_in_config_order(spark):
    texts = ["Legal fraud", "legalized", "FRAUD! legal?", "éfraud", "c++ now"]
    found = column(spark, texts, rules.matched_terms("t", ["fraud", "legal", "c++"]))
    assert found == [["fraud", "legal"], [], ["fraud", "legal"], [], []]


def test_parse_score(spark):
    good = {"4": 4, " 5 ": 5, "1.0": 1, "1e0": 1, "0.5E1": 5, "+3": 3, "50e-1": 5, "002": 2, "0_4": 4, "4." + "0" * 40 + "e0": 4,
            "4" + "0" * 50 + "e-050": 4, "." + "0" * 60 + "3e+61": 3, "5.": 5}
    bad = ["", "True", "NaN", "Infinity", "1.5", "0", "6", "-1", "3.00000000000000001", "1e1", "x4", None, ".", "e1", "4." + "0" * 40 + "1", "4e99999999999", "40", "1 0", "--1"]
    assert column(spark, list(good), values.parse_score("t")) == list(good.values())
    assert column(spark, bad, values.parse_score("t")) == [None] * len(bad)


def test_parse_json_strict(spark):
    bad = ['{"a":1,"a":2}', '{"a":NaN}', '{"a":1e999}', "[-1e999]", "x", "", "1 2", "1]", "1}", '{"a":1},', "Infinity"]
    good = ['{"b":1,"a":[1,2]}', '"1e999 Infinity"', "12", "null", '{"a":"\\"1e999"}', "[]"]
    parsed = F.to_json(values.parse_json_strict("t"))
    assert column(spark, bad, parsed) == [None] * len(bad)
    assert [json.loads(o) for o in column(spark, good, parsed)] == [json.loads(g) for g in good]


def test_cache_key_depends_on_every_part(spark):
    df = spark.createDataFrame(
        [("m", "t", "d", "e"), ("n", "t", "d", "e"), ("m", "u", "d", "e"), ("m", "t", "é", "e"), ("m", "t", "d", "f")],
        "m string, t string, d string, e string",
    )
    keys = [r[0] for r in df.select(values.cache_key("m", "t", "d", "e")).collect()]
    assert len(set(keys)) == 5
    body = {
        "draft": "é",
        "evidence_sha256": hashlib.sha256(b"e").hexdigest(),
        "model": "m",
        "rubric_version": values.RUBRIC_VERSION,
        "text": "t",
    }
    text = json.dumps(body, sort_keys=True, ensure_ascii=False, separators=(",", ":"))
    assert keys[3] == hashlib.sha256(text.encode()).hexdigest()


def test_fingerprint_ignores_order_and_sees_copies(spark):
    df = spark.createDataFrame([(i, str(i)) for i in range(50)], "a int, b string")
    base = values.fingerprint(df).first()
    assert values.fingerprint(df.orderBy(F.desc("a")).repartition(3)).first() == base
    assert values.fingerprint(df.union(df.limit(1))).first() != base
    assert values.fingerprint(df.withColumn("b", F.lit(None).cast("string"))).first() != base
    assert values.fingerprint(df.limit(0)).first()["row_count"] == 0


def test_policy_gates_in_order(spark):
    policy = Policy(always_escalate=("billing",), auto_handle=("playback",), risk_terms=("legal",))
    cases = [
        ("legal claim", "playback", 0.9, 0.0, 0.9, "risk term requires human review"),
        ("hi", "billing", 0.1, 0.0, 0.0, "billing is configured for human review"),
        ("hi", "other", 0.9, 0.0, 0.9, "intent is not approved for automatic handling"),
        ("hi", "playback", 0.71, 0.0, 0.9, "intent confidence is below threshold"),
        ("hi", "playback", 0.76, 0.68, 0.9, "top intent predictions are too close"),
        ("hi", "playback", 0.9, 0.0, 0.34, "no sufficiently similar historical resolution"),
        ("legalized", "playback", 0.72, 0.5, 0.35, "low-risk case with confident intent and supporting evidence"),
    ]
    df = spark.createDataFrame(
        [(i, *c) for i, c in enumerate(cases)],
        "i int, text string, intent string, confidence double, second_confidence double, similarity double, want string",
    )
    rows = decide(df, policy).orderBy("i").collect()
    assert [r["reason"] for r in rows] == [c[-1] for c in cases]
    assert [r["action"] for r in rows] == ["escalate"] * 6 + ["auto_handle"]
    assert rows[0]["triggered_risks"] == ["legal"] and rows[1]["triggered_risks"] == []

import math
import random
import re
from collections import Counter
from datetime import datetime, timedelta
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from replyloom.config import Policy, TriageConfig
from replyloom.operators import blocks, model, responses, retrieval, tfidf
from replyloom.session import scratch, shared_folder
from replyloom.sources import artifacts
from replyloom.streaming import triage_stream as triage_module
from replyloom.streaming.triage_stream import triage_stream

CASES = [
    ("c1", "t1", "music stops when screen locks", "Please restart the device."),
    ("c2", "t1", "music stops when screen is off", "Try updating the app."),
    ("c3", "t2", "screen stays black after update", "We have refunded you."),
    ("c4", "t3", "cannot find the playlist from yesterday", "Check the library tab."),
    ("c5", "t4", "Music  stops when screen locks @you", "duplicate text"),
    ("c6", "t5", "a b", "Check this."),
    ("c7", "t6", "@only 123456", "Check that."),
    ("c8", "t7", "blank reply here", "  "),
]
ASKED = [("m1", "music stops, screen locks!"), ("m2", "playlst yesterday"), ("m3", "@x"), ("m4", "zzzz qqqq")]


def pairs(spark, rows=CASES):
    return spark.createDataFrame(
        rows, "customer_tweet_id string, thread_id string, customer_text string, brand_reply string"
    )


def messages(spark, rows=ASKED):
    return spark.createDataFrame(rows, "message_id string, text string")


def plain_terms(text):
    words = re.findall(r"\w\w+", text)
    word = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
    char = []
    for w in text.split():
        w = f" {w} "
        for n in (3, 4, 5):
            char += [w[i : i + n] for i in range(len(w) - n + 1)]
    return {"word": Counter(word), "char": Counter(char)}


def plain_index(texts, space, cap):
    counts = [plain_terms(t)[space] for t in texts]
    total, df = Counter(), Counter()
    for c in counts:
        total.update(c)
        df.update(c.keys())
    keep = sorted(total, key=lambda t: (-total[t], t))[:cap]
    idf = {t: math.log((1 + len(texts)) / (1 + df[t])) + 1 for t in keep}
    return idf, [plain_vector(c, idf) for c in counts]


def plain_vector(counts, idf):
    raw = {t: (1 + math.log(n)) * idf[t] for t, n in counts.items() if t in idf}
    norm = math.sqrt(sum(v * v for v in raw.values())) or 1.0
    return {t: v / norm for t, v in raw.items()}


def plain_retrieve(cases, asked, k, cap=40_000):
    texts = [c[2] for c in cases]
    spaces = {s: plain_index(texts, s, cap) for s in ("word", "char")}
    out = {}
    for mid, text in asked:
        score = []
        for i, case in enumerate(cases):
            part = {}
            for s, (idf, vectors) in spaces.items():
                q = plain_vector(plain_terms(text)[s], idf)
                part[s] = sum(v * vectors[i].get(t, 0) for t, v in q.items())
            score.append((0.65 * part["word"] + 0.35 * part["char"], case))
        best, seen = [], set()
        for s, case in sorted(score, key=lambda x: (-round(x[0], 9), x[1][0])):
            if s > 1e-12 and case[1] not in seen and len(best) < k:
                seen.add(case[1])
                best.append((case[0], round(s, 7)))
        out[mid] = best
    return out


def found(df):
    got = {}
    for r in df.orderBy("message_id", "rank").collect():
        got.setdefault(r["message_id"], []).append((r["customer_tweet_id"], round(r["similarity"], 7)))
    return got


KEPT = [c for c in CASES if c[0] in ("c1", "c2", "c3", "c4", "c6")]


def test_terms_match_the_plain_rules(spark):
    texts = ["a bc déf g_h 42", "x", "", "ab", "abc  abc", "😀 smile😀"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {(r["i"], r["space"], r["term"]): r["n"] for r in tfidf.term_counts(df, "i", "t").collect()}
    want = {
        (i, s, term): n
        for i, t in enumerate(texts)
        for s, counts in plain_terms(t).items()
        for term, n in counts.items()
    }
    assert got == want


@pytest.mark.parametrize("cap", [40_000, 12])
def test_retrieval_equals_brute_force(spark, cap):
    index = retrieval.build_retrieval_corpus(pairs(spark), TriageConfig(max_features=cap))
    assert {r["customer_tweet_id"] for r in index.corpus.collect()} == {c[0] for c in KEPT}
    clean = [(c[0], c[1], c[2].lower(), c[3]) for c in KEPT]
    asked = [("m1", "music stops, screen locks!"), ("m2", "playlst yesterday"), ("m4", "zzzz qqqq")]
    want = {m: b for m, b in plain_retrieve(clean, asked, 3, cap).items() if b}
    assert found(retrieval.hybrid_retrieve(messages(spark), index, 3)) == want


@pytest.mark.parametrize("block_chars", [1, 40, 10_000])
@pytest.mark.parametrize("dense", [0, 10**9])
def test_the_size_of_blocks_does_not_change_the_result(spark, monkeypatch, block_chars, dense):
    monkeypatch.setattr(blocks, "DENSE", dense)  # in-process here; workers keep the default
    index = retrieval.build_retrieval_corpus(pairs(spark), block_chars=block_chars)
    clean = [(c[0], c[1], c[2].lower(), c[3]) for c in KEPT]
    want = {m: b for m, b in plain_retrieve(clean, [ASKED[0], ASKED[1], ASKED[3]], 2).items() if b}
    assert found(retrieval.hybrid_retrieve(messages(spark), index, 2)) == want


def _usual(n):
    random.seed(4)
    rare = [f"{a}{b}ort" for a in "bcdfghjk" for b in "aeiou"]
    cases = [
        (f"k{i:03d}", f"t{i % 150}", "the usual words of every message " + " ".join(random.sample(rare, 4)), "reply")
        for i in range(n)
    ]
    return cases, [(f"q{i}", "the usual words " + " ".join(random.sample(rare, 4))) for i in range(12)]


@pytest.mark.parametrize("dense", [0, 3, 10**9])
def test_products_in_a_block_do_not_depend_on_how_they_are_formed(monkeypatch, dense):
    random.seed(1)
    weights = {(s, k): random.random() for s in range(7) for k in range(30) if random.random() < 0.5}
    asked = {(m, k): random.random() for m in range(5) for k in range(3, 40) if random.random() < 0.5}
    block = blocks.pack_cases(
        (pa.scalar(9),),
        pa.table({"slot": [s for s, _ in weights], "key": [k for _, k in weights], "word": [k % 2 for _, k in weights], "raw": list(weights.values())}),
        pa.table({"slot": list(range(7)), "thread_id": list("abcabca")}),
    ).to_pylist()[0]
    chunk = blocks.pack_messages(
        (pa.scalar(0),),
        pa.table({"message_id": [f"m{m}" for m, _ in asked], "key": [k for _, k in asked], "word": [k % 2 for _, k in asked], "raw": list(asked.values())}),
    ).to_pylist()[0]
    monkeypatch.setattr(blocks, "DENSE", dense)
    monkeypatch.setattr(blocks, "AT_ONCE", 16)
    names = chunk["message_ids"]
    wanted = [1, 3]
    word, char = blocks._cosines({**block, **chunk, "n_messages": len(names)}, np.array(wanted))
    for row, at in enumerate(wanted):
        m = int(names[at][1:])
        for space, got in ((1, word), (0, char)):
            long_q = math.sqrt(sum(v * v for (i, k), v in asked.items() if i == m and k % 2 == space))
            for s in range(7):
                long_c = math.sqrt(sum(v * v for (i, k), v in weights.items() if i == s and k % 2 == space))
                plain = sum(v * weights.get((s, k), 0) for (i, k), v in asked.items() if i == m and k % 2 == space)
                assert got[row, s] == pytest.approx(plain / long_q / long_c, abs=1e-12)


def test_a_term_in_every_case_and_blocks_left_out(spark, monkeypatch):
    """Words that all cases share are in every block; bounds are never exceeded and leave blocks out."""
    cases, asked = _usual(300)
    cases += [(f"x{i:03d}", f"u{i}", "ganz andere Wörter " + "äöüß"[i % 4] * 3 + f" zeile{i}", "reply") for i in range(200)]
    index = retrieval.build_retrieval_corpus(pairs(spark, cases), block_chars=1_000)
    n_blocks = index.blocks.count()
    held = index.corpus.groupBy("block").count().agg(F.max("count")).first()[0]
    assert n_blocks > 15 and held < 100  # the common words' lists are no longer than a block
    clean = [(c[0], c[1], c[2].lower(), c[3]) for c in cases]
    want = plain_retrieve(clean, asked, 3)
    scored, whole = [], retrieval.scored

    def counting(wanted, *rest):
        scored.append(wanted.count())
        return whole(wanted, *rest)

    monkeypatch.setattr(retrieval, "scored", counting)
    assert found(retrieval.hybrid_retrieve(messages(spark, asked), index, 3)) == want
    assert 12 <= sum(scored) < 12 * n_blocks
    reach = retrieval.bounds(retrieval._chunks(messages(spark, asked), index, "text"), index)
    wanted = reach.select("chunk", "asked", "block", F.lit(0.0).alias("floor"))
    every = whole(wanted, retrieval._chunks(messages(spark, asked), index, "text"), index, 1)
    assert reach.agg(F.max("bound")).first()[0] >= every.agg(F.max("similarity")).first()[0]


def test_nothing_but_the_result_is_left(spark):
    def tables():
        return {p.name for p in Path(shared_folder(spark).removeprefix("file:")).iterdir() if p.is_dir() and "-" in p.name}

    index = retrieval.build_retrieval_corpus(pairs(spark))
    before = tables()
    with scratch(spark):
        cases = retrieval.hybrid_retrieve(messages(spark), index, 3)
        assert cases.count() > 0
        left = {n.rsplit("-", 5)[0].rstrip("-0123456789abcdef") for n in tables() - before}
        assert len(tables() - before) == 1, left
    assert tables() == before


def test_one_case_per_thread_and_blended_score(spark):
    index = retrieval.build_retrieval_corpus(pairs(spark))
    rows = retrieval.hybrid_retrieve(messages(spark), index, 3).filter("message_id = 'm1'").collect()
    assert len({r["thread_id"] for r in rows}) == len(rows)
    for r in rows:
        blend = 0.65 * r["word_similarity"] + 0.35 * r["char_similarity"]
        assert r["similarity"] == pytest.approx(blend, abs=1e-8)
    assert retrieval.hybrid_retrieve(messages(spark), index, 0).count() == 0


def test_held_out_rows_leave_before_the_fit(spark):
    out = spark.createDataFrame(
        [("c4", "zz", "music stops when screen LOCKS")], "tweet_id string, thread_id string, text string"
    )
    index = retrieval.build_retrieval_corpus(pairs(spark), held_out=out)
    assert {r["customer_tweet_id"] for r in index.corpus.collect()} == {"c2", "c3", "c6"}
    assert index.excluded_rows == 3 and index.excluded_digest
    assert index.vocabulary.terms.filter("term = 'playlist'").isEmpty()


def test_index_errors_and_round_trip(spark, tmp_path):
    with pytest.raises(ValueError):
        retrieval.build_retrieval_corpus(pairs(spark), TriageConfig(max_corpus_size=0))
    with pytest.raises(ValueError, match="left no case"):
        retrieval.build_retrieval_corpus(pairs(spark, CASES[-2:]))
    index = retrieval.build_retrieval_corpus(pairs(spark))
    artifacts.save_index(index, str(tmp_path / "ix"))
    loaded = artifacts.load_index(spark, str(tmp_path / "ix"))
    assert found(retrieval.hybrid_retrieve(messages(spark), loaded, 3)) == found(
        retrieval.hybrid_retrieve(messages(spark), index, 3)
    )
    old = spark.read.parquet(str(tmp_path / "ix/meta")).withColumn("version", F.lit(1))
    old.write.parquet(str(tmp_path / "old/meta"))
    with pytest.raises(ValueError, match="Old retrieval index"):
        artifacts.load_index(spark, str(tmp_path / "old"))


def weak(spark, n=120):
    rows = []
    for i in range(n):
        topic = ("music player stops song", "playback", "cannot sign in password", "access", "invoice price money", "billing")
        k = i % 3
        rows.append((f"w{i:03d}", f"{topic[2 * k]} number{chr(97 + i % 26)}{chr(97 + i // 26)}", topic[2 * k + 1], "yes", "human"))
    return spark.createDataFrame(rows, "example_id string, text string, intent string, reviewed string, label_source string")


@pytest.fixture(scope="module")
def fitted(spark):
    return model.train_intent_model(weak(spark), "example_id", max_iter=50)


def test_model_predicts_its_topics(spark, fitted):
    asked = messages(spark, [("1", "my song stops"), ("2", "password wrong, cannot sign in"), ("3", "money back for invoice"), ("4", "§§")])
    rows = {r["message_id"]: r for r in model.predict_intent(fitted, asked).collect()}
    assert [rows[i]["intent"] for i in "123"] == ["playback", "access", "billing"]
    for r in rows.values():
        assert 0 <= r["second_confidence"] <= r["confidence"] <= 1
    assert fitted.label_source == "human_reviewed" and fitted.training_examples == 120


def test_model_round_trip(spark, fitted, tmp_path):
    artifacts.save_model(fitted, str(tmp_path / "m"))
    loaded = artifacts.load_model(spark, str(tmp_path / "m"))
    asked = messages(spark, [("1", "my song stops"), ("2", "invoice")])
    first = model.predict_intent(fitted, asked).orderBy("message_id").collect()
    assert model.predict_intent(loaded, asked).orderBy("message_id").collect() == first
    assert (loaded.label_source, loaded.training_digest) == (fitted.label_source, fitted.training_digest)


@pytest.mark.parametrize(
    "change, message",
    [
        (lambda d: d.limit(99), "fewer than 100"),
        (lambda d: d.withColumn("reviewed", F.lit("no")), "not reviewed"),
        (lambda d: d.drop("reviewed"), "not reviewed"),
        (lambda d: d.withColumn("label_source", F.lit("weak")), "label source"),
        (lambda d: d.withColumn("intent", F.lit("one")), "two intents"),
        (lambda d: d.withColumn("text", F.lit("same")), "duplicate"),
        (lambda d: d.withColumn("text", F.lit("@x")), "blank text"),
        (lambda d: d.withColumn("intent", F.lit(" ")), "blank intent"),
    ],
)
def test_training_guards(spark, change, message):
    with pytest.raises(ValueError, match=message):
        model.train_intent_model(change(weak(spark)), "example_id")


def test_top2_prefers_the_later_class_on_a_tie(spark):
    df = spark.createDataFrame([([0.4, 0.4, 0.2],), ([0.1, 0.2, 0.7],)], "p array<double>")
    rows = [r[0] for r in df.select(model.top2_probs(F.col("p"), ("a", "b", "c"))).collect()]
    assert [tuple(r) for r in rows] == [("b", 0.4, 0.4), ("c", 0.7, 0.2)]


def candidates(spark, choices):
    rows = [(str(i), ["x", "y"], c) for i, c in enumerate(choices)]
    return spark.createDataFrame(rows, "message_id string, candidates array<string>, choice string")


def test_select_evidence_modes(spark):
    choices = ["0", "1", "-1", "-2", "2", "true", "1.0", '"0"', None, "01", ""]
    df = candidates(spark, choices)
    out = responses.select_evidence(df.select("message_id", "candidates"), df.select("message_id", "choice"))
    got = {int(r["message_id"]): (r["selected"], r["rag_mode"]) for r in out.collect()}
    fallback = ("x", "extractive_fallback")
    assert [got[i] for i in range(len(choices))] == [
        ("x", "ollama_selected"), ("y", "ollama_selected"), (None, "ollama_abstained"), *[fallback] * 8
    ]
    none = responses.select_evidence(df.select("message_id", F.array().cast("array<string>").alias("candidates")))
    assert {(r["selected"], r["rag_mode"]) for r in none.collect()} == {(None, "no_safe_evidence")}
    plain = responses.select_evidence(df.select("message_id", "candidates"))
    assert {(r["selected"], r["rag_mode"]) for r in plain.collect()} == {("x", "extractive")}


POLICY = Policy(
    confidence_threshold=0.3, margin_threshold=0.0, similarity_threshold=0.1,
    always_escalate=("billing",), auto_handle=("playback", "access"), risk_terms=("fraud",),
)
CONFIG = TriageConfig(policy=POLICY, reply_templates={"playback": "About playback.", "other_unclear": "Say more."})


def respond_to(spark, rows, evidence_rows, selections=None):
    scored = spark.createDataFrame(
        rows, "message_id string, text string, intent string, confidence double, second_confidence double"
    )
    found_rows = spark.createDataFrame(
        evidence_rows,
        "message_id string, rank int, customer_tweet_id string, thread_id string, customer_text string, "
        "brand_reply string, safe_guidance string, similarity double, word_similarity double, char_similarity double",
    )
    out = responses.respond(scored, responses.collect_evidence(found_rows), CONFIG, selections)
    return {r["message_id"]: r for r in out.collect()}


def case(mid, rank, cid, reply, similarity, guidance=""):
    return (mid, rank, cid, f"t-{cid}", "text", reply, guidance, similarity, similarity, similarity)


def test_respond_rules(spark):
    rows = [
        ("auto", "song stops", "playback", 0.91234567, 0.05),
        ("stale", "song stops", "playback", 0.9, 0.05),
        ("risk", "fraud song", "playback", 0.9, 0.05),
        ("none", "song stops", "access", 0.9, 0.05),
        ("second", "song stops", "playback", 0.9, 0.05),
    ]
    evidence = [
        case("auto", 1, "c1", "Please restart the device.", 0.8),
        case("stale", 1, "c2", "We have refunded you.", 0.8, "Restart the device."),
        case("risk", 1, "c1", "Please restart the device.", 0.8),
        case("second", 2, "c5", "Check the cable.", 0.2),
        case("second", 1, "c4", "Thanks!", 0.9),
    ]
    got = respond_to(spark, rows, evidence)
    assert got["auto"]["decision"] == "auto_handle" and got["auto"]["confidence"] == 0.9123
    assert got["auto"]["draft_reply"] == (
        "About playback. A similar historical support case suggested: Please restart the device."
    )
    assert got["auto"]["evidence_tweet_ids"] == ["c1"] and got["auto"]["rag_mode"] == "extractive"
    assert got["stale"]["decision"] == "escalate"
    assert got["stale"]["reason"] == "no safe applicable historical guidance"
    assert got["stale"]["rag_mode"] == "no_safe_evidence"
    assert got["risk"]["triggered_risks"] == ["fraud"]
    assert got["risk"]["rag_mode"] == "not_used_for_escalation" and len(got["risk"]["evidence"]) == 1
    assert got["none"]["reason"] == "no sufficiently similar historical resolution"
    assert got["none"]["draft_reply"].startswith("Say more. Human review")
    assert got["second"]["evidence_tweet_ids"] == ["c5"]
    choice = spark.createDataFrame([("auto", "-1")], "message_id string, choice string")
    got = respond_to(spark, rows[:1], evidence[:1], choice)
    assert got["auto"]["reason"] == "local model abstained from evidence selection"
    assert got["auto"]["evidence_tweet_ids"] == []


def test_triage_batch_and_stream_agree(spark, fitted, tmp_path):
    index = retrieval.build_retrieval_corpus(pairs(spark))
    asked = messages(spark, [("1", "my music stops @you"), ("2", "@x 123456"), ("3", "fraud on my invoice"), ("4", "y" * 4001)])
    answers, rejected = responses.triage(asked, fitted, index, CONFIG)
    batch = {r["message_id"]: (r["decision"], r["reason"], r["draft_reply"]) for r in answers.collect()}
    assert set(batch) == {"1", "3"} and {r["message_id"] for r in rejected.collect()} == {"2", "4"}
    asked.write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(asked.schema).parquet(str(tmp_path / "in"))
    writer = triage_stream(source, fitted, index, str(tmp_path / "out"), str(tmp_path / "cp"), CONFIG)
    writer.trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out/responses")).collect()
    assert {r["message_id"]: (r["decision"], r["reason"], r["draft_reply"]) for r in rows} == batch
    assert spark.read.parquet(str(tmp_path / "out/rejected")).count() == 2


def _tables(spark):
    folder = Path(shared_folder(spark).removeprefix("file:"))
    return {p.name for p in folder.iterdir() if p.is_dir() and len(p.name.rsplit("-", 1)[-1]) == 32}


def test_a_repeated_message_is_answered_once_and_a_failed_batch_again(spark, fitted, tmp_path, monkeypatch):
    index = retrieval.build_retrieval_corpus(pairs(spark))
    schema = "message_id string, text string, at timestamp"
    noon = datetime(2024, 5, 1, 12)

    def arrive(name, rows):
        batch = spark.createDataFrame([(i, t, noon + timedelta(minutes=m)) for i, t, m in rows], schema)
        batch.coalesce(1).write.parquet(str(tmp_path / "in" / name))

    def run():
        source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
        writer = triage_stream(source, fitted, index, str(tmp_path / "out"), str(tmp_path / "cp"), CONFIG, "at", "10 minutes")
        writer.trigger(availableNow=True).start().awaitTermination()

    before, calls, whole = _tables(spark), [], triage_module.triage

    def breaking(*args):
        calls.append(1)
        answers = whole(*args)
        if len(calls) == 2:
            raise RuntimeError("lost in batch 1")
        return answers

    monkeypatch.setattr(triage_module, "triage", breaking)
    arrive("a", [("1", "my music stops", 0), ("1", "my music stops", 1), ("2", "fraud on my invoice", 2)])
    run()
    arrive("b", [("2", "fraud on my invoice", 3), ("3", "screen stays black", 4), ("4", "@x 123456", 4)])
    with pytest.raises(Exception, match="lost in batch 1"):
        run()
    assert _tables(spark) == before  # a failed batch leaves nothing either
    run()
    rows = spark.read.parquet(str(tmp_path / "out/responses")).collect()
    assert sorted(r["message_id"] for r in rows) == ["1", "2", "3"]
    refused = spark.read.parquet(str(tmp_path / "out/rejected")).collect()
    assert [r["message_id"] for r in refused] == ["4"]
    # Far behind the watermark's reach the same id is a new message.
    arrive("c", [("9", "sign in", 60)])
    run()
    arrive("d", [("1", "my music stops", 61)])
    run()
    rows = spark.read.parquet(str(tmp_path / "out/responses")).collect()
    assert sorted(r["message_id"] for r in rows) == ["1", "1", "2", "3", "9"]
    assert _tables(spark) == before


def test_repeated_messages_and_selections_raise(spark, fitted):
    index = retrieval.build_retrieval_corpus(pairs(spark))
    twice = messages(spark, [("1", "my song stops"), ("1", "again")])
    with pytest.raises(ValueError, match="repeated message_id"):
        responses.triage(twice, fitted, index, CONFIG)
    df = candidates(spark, ["0"])
    with pytest.raises(ValueError, match="repeated message_id"):
        responses.select_evidence(df.drop("choice"), df.select("message_id", "choice").union(df.select("message_id", "choice")))


def test_probabilities_equal_the_formula(spark, fitted):
    """Coefficients times unit-length weights, summed per class, through a softmax."""
    asked = messages(spark, [("1", "my song stops"), ("2", "password wrong sign in"), ("3", "§§")])
    got = {r["message_id"]: r for r in model.predict_intent(fitted, asked).collect()}
    table = {(r["space"], r["term"]): r for r in fitted.coefficients.collect()}
    for mid, text in (("1", "my song stops"), ("2", "password wrong sign in"), ("3", "§§")):
        margins = list(fitted.intercepts)
        for space, counts in plain_terms(text).items():
            raw = {t: (1 + math.log(n)) * table[space, t]["idf"] for t, n in counts.items() if (space, t) in table}
            length = math.sqrt(sum(w * w for w in raw.values()))
            for t, w in raw.items():
                margins = [m + w / length * c for m, c in zip(margins, table[space, t]["by_class"])]
        shares = [math.exp(m) / sum(map(math.exp, margins)) for m in margins]
        best = max(range(len(shares)), key=shares.__getitem__)
        assert got[mid]["intent"] == fitted.classes[best]
        assert got[mid]["confidence"] == pytest.approx(shares[best], abs=1e-9)


def test_training_is_at_its_optimum(spark, fitted):
    """With balanced weights, each class's weighted probabilities must sum to n / classes."""
    rows = weak(spark).select(F.col("example_id").alias("message_id"), "text", "intent")
    known = model.class_probabilities(fitted, rows).join(rows, "message_id").collect()
    sizes = {}
    for r in known:
        sizes[r["intent"]] = sizes.get(r["intent"], 0) + 1
    n, k = len(known), len(fitted.classes)
    for i in range(k):
        total = sum(n / (k * sizes[r["intent"]]) * r["probabilities"][i] for r in known)
        assert total == pytest.approx(n / k, rel=0.02)


def test_responses_name_their_model(spark, fitted):
    index = retrieval.build_retrieval_corpus(pairs(spark))
    answers, _ = responses.triage(messages(spark, [("1", "my song stops")]), fitted, index, CONFIG, selector="pick-1")
    row = answers.first()
    assert row["selector_model"] == "pick-1"
    assert tuple(row["model_metadata"]) == ("human_reviewed", 120, fitted.training_digest)

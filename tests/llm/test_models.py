import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from cases import TEXTS, documents, rows_of
from pyspark.sql import functions as F

from replyloom.llm import language as L
from replyloom.llm import quality_model as Q
from replyloom.llm import toxicity as X
from replyloom.llm.common import held_out

FOLDER = "/root/testdata/sf0.01"


def labels(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, quality int, toxic int, text string, score string")


def table(spark, name):
    return spark.read.parquet(f"{FOLDER}/{name}.parquet")


def hidden(key):
    return key is not None and zlib.crc32(str(key).encode()) % 3 == 1


def accuracy(scores, known, label, threshold):
    rows = scores.join(known.select("doc_id", label), "doc_id").filter(held_out("doc_id")).collect()
    right = [int(r.score >= threshold) == r[label] for r in rows]
    good = [r[label] for r in rows if r.score >= threshold]
    return sum(right) / len(right), sum(good) / max(1, len(good))


def test_the_fold_is_crc32_of_the_key(spark):
    rows = documents(spark).select("doc_id", held_out("doc_id")).collect()
    assert all(r[1] == hidden(r[0]) for r in rows)


# -- toxicity ----------------------------------------------------------------


def _insults(n, seed):
    """Toxic only where an insult meets a group; either alone is fine."""
    random.seed(seed)
    filler = [f"word{i}" for i in range(200)]
    rows = []
    for i in range(n):
        kind = i % 4
        extra = {0: ["vile", "folk"], 1: ["vile"], 2: ["folk"], 3: []}[kind]
        words = random.sample(filler, 30) + extra
        random.shuffle(words)
        rows.append((i, " ".join(words), int(kind == 0)))
    return rows


def test_pairs_of_words_are_learned(spark):
    rows = _insults(900, 1)
    docs = documents(spark, [(k, t) for k, t, _ in rows])
    scores = {r.doc_id: r.score for r in X.score_toxicity(docs, labels(spark, [(k, 1, y) for k, _, y in rows])).collect()}
    wrong = [k for k, _, y in rows if hidden(k) and (scores[k] >= X.THRESHOLD) != bool(y)]
    assert len(wrong) <= 3


def test_scores_equal_the_formula(spark):
    rows = _insults(300, 2)
    docs = documents(spark, [(k, t) for k, t, _ in rows] + TEXTS[:5])
    machine = X.learn_toxicity(docs, labels(spark, [(k, 1, y) for k, _, y in rows]))
    found = docs.select("text", X.toxicity("text", machine, docs).alias("score"), X.hashed_terms("text").alias("b")).collect()
    for r in found:
        terms = [machine.place[b] for b in r.b if machine.place[b] >= 0]
        score = machine.bias + sum(machine.weights[t] for t in terms)
        score += sum(machine.factors[a] @ machine.factors[b] for i, a in enumerate(terms) for b in terms[:i])
        assert r.score == pytest.approx(1 / (1 + np.exp(-score)), abs=1e-9)


def test_fit_separates_what_terms_separate():
    rows = pa.table({"y": [1, 0] * 50, "b": pa.array([[1, 2], [1, 3]] * 50, pa.list_(pa.int32()))})
    machine = X.fit(rows)
    assert machine.place[1] == -1  # in every text: tells nothing
    score, _ = X._scores(machine, np.array([0, 1]), machine.place[[2, 3]].astype(int), 2)
    assert score[0] > 2 > -2 > score[1]


def test_toxicity_held_out(spark):
    docs, known = table(spark, "documents"), table(spark, "labels")
    right, precise = accuracy(X.score_toxicity(docs, known), known, "toxic", X.THRESHOLD)
    assert right > 0.9 and precise > 0.95


def test_toxicity_learns_from_no_hidden_label(spark):
    rows = _insults(300, 3)
    docs = documents(spark, [(k, t) for k, t, _ in rows])
    one = labels(spark, [(k, 1, y) for k, _, y in rows])
    other = labels(spark, [(k, 1, 1 - y if hidden(k) else y) for k, _, y in rows])
    assert rows_of(X.score_toxicity(docs, one)) == rows_of(X.score_toxicity(docs, other))


def test_odd_texts_labels_and_empty_tables(spark):
    odd = [(k, 1, 1 if i % 2 else 0) for i, (k, _) in enumerate(TEXTS)] + [(1, None, None), (99, 7, 7)]
    for scores in (X.score_toxicity, Q.score_quality):
        found = scores(documents(spark), labels(spark, odd)).collect()
        assert len(found) == len(TEXTS) and all(0 <= r.score <= 1 for r in found)
        assert scores(documents(spark, []), labels(spark, odd)).collect() == []
        assert {r.score for r in scores(documents(spark), labels(spark, [])).collect()} == {0.0}


def test_filter_keeps_columns(spark):
    rows = _insults(600, 4)
    docs = documents(spark, [(k, t) for k, t, _ in rows] + TEXTS)
    known = labels(spark, [(k + 0, 1, y) for k, _, y in rows])
    kept = X.without_toxic(docs, known)
    scores = X.score_toxicity(docs, known).filter(F.col("score") < X.THRESHOLD)
    assert kept.columns == docs.columns
    assert rows_of(kept.select("doc_id")) == rows_of(scores.select("doc_id"))


def test_the_sample_is_bounded(spark):
    rows = _insults(400, 5)
    docs = documents(spark, [(k, t) for k, t, _ in rows])
    from replyloom.llm.labelled import training_rows

    taken = training_rows(docs, labels(spark, [(k, 1, y) for k, _, y in rows]), "toxic", X.hashed_terms("text"), 50)
    assert 20 < taken.num_rows <= 100


# -- quality -----------------------------------------------------------------


def test_forest_walk_equals_plain_trees():
    random = np.random.default_rng(0)
    x = random.normal(size=(400, 5))
    y = ((x[:, 0] > 0.2) ^ (x[:, 3] < -0.5)).astype(float)
    forest = Q.fit(x, y)
    for row, score in zip(x[:50], Q.walk(forest, x)[:50]):
        total = forest.prior
        for feature, cut, leaves in zip(forest.feature, forest.cut, forest.leaves):
            node = 0
            while node < len(feature):
                node = 2 * node + 1 + (row[feature[node]] > cut[node])
            total += leaves[node - len(feature)]
        assert score == pytest.approx(total)
    assert ((Q.walk(forest, x) > 0) == (y == 1)).mean() > 0.98


def test_first_split_is_the_best_one():
    random = np.random.default_rng(1)
    x = random.normal(size=(300, 3))
    y = (x[:, 1] > 0).astype(float)
    forest = Q.fit(x, y)
    assert forest.feature[0, 0] == 1 and abs(forest.cut[0, 0]) < 0.15


def test_quality_held_out(spark):
    docs, known = table(spark, "documents"), table(spark, "labels")
    right, precise = accuracy(Q.score_quality(docs, known), known, "quality", Q.THRESHOLD)
    assert right > 0.95 and precise > 0.95


# -- language ----------------------------------------------------------------


def test_viterbi_equals_all_paths():
    import itertools

    random = np.random.default_rng(3)
    sizes = [0, 1, 5, 7, 0, 3]
    of_text = np.concatenate([[0], np.cumsum(sizes)])
    scores = random.normal(size=(of_text[-1], 3)).astype(np.float32)
    path = L.viterbi(scores, of_text, 0.7)
    for b, e in zip(of_text[:-1], of_text[1:]):
        cost = lambda p: sum(scores[b + i, k] for i, k in enumerate(p)) - 0.7 * sum(x != y for x, y in zip(p, p[1:]))
        best = max((cost(p) for p in itertools.product(range(3), repeat=e - b)), default=0)
        assert cost(path[b:e].tolist()) == pytest.approx(best, abs=1e-4)


def test_language_held_out(spark):
    docs = table(spark, "documents")
    found = L.identify_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").filter(held_out("doc_id"))
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.98


def test_spans_of_mixed_text_scripts_and_odd_texts(spark):
    docs = table(spark, "documents")
    extra = [(50_000 + i, "Привет мир это русский текст слова", "ru") for i in range(30)]
    both = docs.select("doc_id", "text", "lang").unionByName(spark.createDataFrame(extra, "doc_id long, text string, lang string"))
    model = L.learn_languages(both)
    assert model.names == ["de", "en", "es", "fr", "ru"]
    parts = {r.lang: " ".join(r.text.split()[:40]) for r in docs.filter("length(text) > 400 and doc_id % 3 = 0").collect()}
    mixed = f"{parts['de']} {parts['en']} Это русский мир {parts['fr']}"
    texts = [(1, mixed), (2, None), (3, ""), (4, "123 -- ++ 😀"), (5, "漢字"), (6, "слова"), (7, "a" * 100_000)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    found = {r.doc_id: r.x for r in df.select("doc_id", L.language_of("text", model, df).alias("x")).collect()}
    assert [s.lang for s in found[1].spans] == ["de", "en", "ru", "fr"]
    assert found[1].spans[0].begin == 0 and all(a.end == b.begin for a, b in zip(found[1].spans, found[1].spans[1:]))
    assert all(found[i].lang == "und" and found[i].score == 0 for i in (2, 3, 4))
    assert found[5].lang in model.names and found[5].score == 0
    assert found[6].lang == "ru" and found[6].score == 1
    assert found[7].lang in model.names


def test_language_of_odd_and_empty_tables(spark):
    found = L.identify_languages(documents(spark)).collect()
    assert len(found) == len(TEXTS)
    assert {r.lang_pred for r in found if r.doc_id in (2, 3, 4, 12)} == {"und"}
    assert {r.lang_pred for r in found if r.doc_id in (1, 5, 6)} == {"en"}
    assert L.identify_languages(documents(spark, [])).collect() == []
    nameless = documents(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in L.identify_languages(nameless).collect()} == {"und"}


def test_language_learns_from_no_hidden_row(spark):
    docs = table(spark, "documents").select("doc_id", "text", "lang").filter("doc_id < 300")
    other = docs.withColumn("lang", F.when(held_out("doc_id"), "en").otherwise(F.col("lang")))
    score = lambda d: rows_of(L.identify_languages(d).select("doc_id", "lang_pred", "score"))
    assert score(docs) == score(other)

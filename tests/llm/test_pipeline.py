import corpus_pipeline
import pytest
from cases import contamination, documents, rows_of, simhash, words
from pyspark.sql import functions as F
from test_secret_scan import plain_spans

from replyloom.llm import oracle, queries, toxicity
from replyloom.llm.common import store

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet")
    tables = [rows]
    for name, stage in corpus_pipeline.STAGES:
        tables.append(store(stage(spark, tables[-1], FOLDER), name).rows)
    return tables


def test_stages_keep_the_columns(steps):
    assert all(t.columns == steps[0].columns for t in steps[:-1])
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "simhash_near_dedup", "benchmark_decontamination", "secret_scan", "packing",
    ]


def test_toxic_documents_go(spark, steps):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    scores = toxicity.score_toxicity(steps[0], labels).filter(F.col("score") < toxicity.THRESHOLD)
    assert rows_of(steps[1].select("doc_id")) == rows_of(scores.select("doc_id"))


def test_one_of_each_near_copy_stays(steps):
    rows = sorted((r.doc_id, simhash(r.text)) for r in steps[1].collect())
    groups = []
    for key, print_ in rows:
        joined = [g for g in groups if any((print_ ^ p).bit_count() <= 2 for _, p in g)]
        groups = [g for g in groups if g not in joined] + [[x for g in joined for x in g] + [(key, print_)]]
    assert sorted(r.doc_id for r in steps[2].collect()) == sorted(min(g)[0] for g in groups)
    assert steps[2].count() < steps[1].count()


def test_benchmark_documents_go(spark, steps):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    clean = sorted(r.doc_id for r in steps[2].collect() if not contamination(r.text, items)[1])
    assert sorted(r.doc_id for r in steps[3].collect()) == clean
    assert steps[3].count() < steps[2].count()


def test_secrets_are_replaced(steps):
    before = {r.doc_id: r.text for r in steps[3].collect()}
    after = {r.doc_id: r.text for r in steps[4].collect()}
    assert before.keys() == after.keys()
    assert sum(map(len, map(plain_spans, before.values()))) > 0  # else nothing is shown
    for key, text in before.items():
        assert after[key] == text if not plain_spans(text) else "[secret]" in after[key]
        assert not plain_spans(after[key])


def test_all_words_are_packed(steps):
    lengths = {r.doc_id: len(words(r.text)) for r in steps[4].collect()}
    packed = {r.doc_id: r.n for r in steps[5].groupBy("doc_id").agg(F.sum("n_tokens").alias("n")).collect()}
    assert packed == lengths


def test_run_is_all_stages(spark, steps):
    assert rows_of(corpus_pipeline.run(spark, FOLDER)) == rows_of(steps[-1])


def test_stages_take_odd_and_empty_documents(spark, tmp_path):
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 1), (None, None, None)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    items = spark.createDataFrame([(1, "plain words in a line"), (None, None)], "item_id long, text string")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    for given in (documents(spark), documents(spark, [])):
        rows = given
        for name, stage in corpus_pipeline.STAGES:
            rows = store(stage(spark, rows, str(tmp_path)), name).rows
        assert (rows.count() > 0) == (given.count() > 0)


def test_each_operator_has_one_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(oracle.ORACLE) < set(queries.QUERIES)

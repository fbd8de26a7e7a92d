import random

import pytest
from pyspark.sql import functions as F

from replyloom.operators import digests, tfidf
from replyloom.session import stored

SCHEMA = "k long, v string"


def tree(spark, rows, **kw):
    return digests.digest_tree(spark.createDataFrame(rows, SCHEMA), "k", **{"width": 10, "fanout": 4, **kw})


def changes(spark, before, after):
    got = digests.changed_ranges(tree(spark, before), tree(spark, after), 10, 4)
    return sorted((r.first_key is not None, r.first_key, r.last_key, r.rows_before, r.rows_after) for r in got.collect())


ROWS = [(k, f"v{k % 7}") for k in range(-55, 900, 3)] + [(None, "n"), (5, None), (5, None)]


def test_equal_tables_have_no_changed_ranges(spark):
    assert changes(spark, ROWS, list(reversed(ROWS))) == []
    assert changes(spark, [], []) == []


def test_changes_are_named_by_their_ranges(spark):
    after = [(k, "new" if k in (-55, 401) else v) for k, v in ROWS if k != 200] + [(5_000, "x")]
    size = lambda lo: sum(k is not None and lo <= k < lo + 10 for k, _ in ROWS)
    assert changes(spark, ROWS, after) == [
        (True, -60, -51, size(-60), size(-60)),
        (True, 200, 209, size(200), size(200) - 1),
        (True, 400, 409, size(400), size(400)),
        (True, 5_000, 5_009, 0, 1),
    ]


def test_copies_and_null_keys_count(spark):
    assert changes(spark, ROWS, ROWS[:-1])[0][1:3] == (0, 9)
    assert changes(spark, ROWS, [r for r in ROWS if r[0] is not None]) == [(False, None, None, 1, 0)]


def test_trees_of_parts_add_up(spark):
    whole = sorted(map(str, tree(spark, ROWS).collect()))
    assert sorted(map(str, digests.joined(tree(spark, ROWS[:100]), tree(spark, ROWS[100:])).collect())) == whole


def test_keys_that_are_texts(spark):
    rows = [(i, f"name {i}") for i in range(300)]
    frame = spark.createDataFrame(rows, SCHEMA)
    edited = frame.withColumn("k", F.when(F.col("v") == "name 7", -1).otherwise(F.col("k")))
    trees = [digests.digest_tree(d, digests.text_key("v"), width=1 << 20) for d in (frame, edited)]
    assert digests.changed_ranges(*trees, 1 << 20).count() == 1


def stats(spark, rows):
    return stored(spark.createDataFrame([("word", t, 1, n) for t, n in rows], "space string, term string, df long, tf long"), "stats")


@pytest.mark.parametrize("last", [5_000, 1])
@pytest.mark.parametrize("m", [1, 40, 119, 500])
def test_top_terms_equal_a_sort(spark, monkeypatch, m, last):
    monkeypatch.setattr(tfidf, "LAST_TERMS", last)
    random.seed(2)
    alphabet = ["a", "ab", "é", "ß", "z", "\u0000", "😀", "b"]
    terms = {"".join(random.choices(alphabet, k=random.randrange(1, 9))) for _ in range(400)}
    rows = [(t, random.choice([1, 1, 1, 2, 5, 9_000, 10**9])) for t in sorted(terms)[:120]]
    want = sorted(rows, key=lambda r: (-r[1], r[0].encode()))[:m]
    got = [(r.term, r.tf) for r in tfidf.top_terms(stats(spark, rows), m).collect()]
    assert sorted(got) == sorted(want)


def test_top_terms_are_a_filter(spark):
    table = stored(spark.range(200_000).select(F.lit("word").alias("space"), F.concat(F.lit("t"), "id").alias("term"), F.lit(1).cast("long").alias("df"), F.pmod("id", F.lit(9)).alias("tf")), "stats")
    top = tfidf.top_terms(table, 150_000)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan and "Limit" not in plan
    assert top.count() == 150_000

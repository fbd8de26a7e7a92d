from fractions import Fraction
from hashlib import md5

import pytest
from cases import CLASHING, TEXTS, documents, words
from pyspark.sql import functions as F

from replyloom.llm import mixing as M

SOURCES = ["beta", None, "Alpha", "beta", "beta", "gamma", "beta"]


def with_sources(spark, rows=TEXTS):
    full = [(k, t, "en", SOURCES[i % 7], 1, 5, "x", 0.5, 3, 4, "i", "s", 1, 9) for i, (k, t) in enumerate(rows)]
    schema = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"
    return spark.createDataFrame(full, schema).repartition(3)


def targets(sizes, weights=(5, 2, 1), share=Fraction(3, 2), epochs=2):
    """Targets by handing out the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total = share * sum(sizes.values())
    full = set()
    while True:
        free = [s for s in names if s not in full]
        left = total - sum(epochs * sizes[s] for s in full)
        level = left / Fraction(sum(weight[s] for s in free)) if free else Fraction(0)
        more = {s for s in free if level * weight[s] > epochs * sizes[s]}
        if not more:
            return {s: Fraction(epochs * sizes[s]) if s in full else level * weight[s] for s in names}
        full |= more


def mixed(rows):
    """(key, source, size, target, taken) by walking each source in key order; ``rows`` hold key, source, size."""
    sizes = {}
    for _, source, n in rows:
        sizes[source] = sizes.get(source, 0) + n
    wanted = targets(sizes)
    out = []
    for source in sizes:
        own = sorted(
            ((md5(f"42:{'' if k is None else k}".encode()).hexdigest(), n, k) for k, s, n in rows if s == source),
            key=lambda x: x[:2],
        )
        budget = int(wanted[source])
        epochs, rest = divmod(budget, sizes[source]) if sizes[source] else (0, 0)
        for _, n, k in own:
            now = min(rest, n)
            rest -= now
            out.append((k, source, n, sizes[source], round(float(wanted[source]), 6), epochs * n + now))
    return sorted(out, key=repr)


def rows(df):
    return sorted(
        ((r.doc_id, r.source, r["size"], r.source_size, round(r.target, 6), r.taken) for r in df.collect()), key=repr
    )


def test_awkward_texts(spark):
    plain = [(k, SOURCES[i % 7], len(words(t))) for i, (k, t) in enumerate(TEXTS)]
    got = rows(M.mix_sources(with_sources(spark)))
    assert got == mixed(plain)
    assert all(0 <= taken <= 2 * size for _, _, size, _, _, taken in got)


@pytest.mark.parametrize("seed", range(3))
def test_many_sources_and_a_hot_one(spark, seed):
    plain = [(i, "hot" if i % 3 == 0 else f"s{(i * 7919 + seed) % 97}", (i * 37 + seed) % 113) for i in range(3_000)]
    frame = spark.createDataFrame(plain, "doc_id long, source string, n long").repartition(5)
    got = rows(M.mix_sources(frame, size=F.col("n")))
    assert got == mixed(plain)
    by_source = {}
    for _, source, _, _, target, taken in got:
        by_source.setdefault(source, [target, 0])[1] += taken
    assert all(0 <= target - taken < 1 for target, taken in by_source.values())


def test_the_mix_does_not_depend_on_how_rows_are_dealt_out(spark):
    frame = with_sources(spark)
    once = rows(M.mix_sources(frame))
    assert rows(M.mix_sources(frame.repartition(7))) == once == rows(M.mix_sources(frame.coalesce(1)))


def test_ranges_of_a_source_hold_few_rows_and_offsets_add_up(spark):
    frame = spark.range(20_000).select(
        F.lit(False).alias("none"), F.lit("hot").alias("name"), F.pmod("id", F.lit(4096)).alias("range"), F.lit(1).cast("long").alias("tokens")
    )
    ranges = frame.groupBy("none", "name", "range").agg(F.sum("tokens").alias("tokens"))
    sizes = {r.range: r.tokens for r in ranges.collect()}
    before, expected = 0, {}
    for x in sorted(sizes):
        expected[x] = before
        before += sizes[x]
    assert {r.range: r.before for r in M.range_offsets(ranges).collect()} == expected


def test_carried_columns_and_no_sizes(spark):
    got = M.mix_sources(with_sources(spark), carry=("text", "n_chars")).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=repr) == sorted(TEXTS, key=repr)
    nothing = M.mix_sources(with_sources(spark), size=F.lit(0)).collect()
    assert len(nothing) == len(TEXTS) and {(r.taken, r.target) for r in nothing} == {(0, 0.0)}


def test_no_python_in_the_plan(spark):
    plan = M.mix_sources(documents(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "MapIn" not in plan


def test_empty_table(spark):
    assert M.mix_sources(documents(spark, [])).collect() == []

import random

import pytest
from cases import TEXTS, by_key, components, documents, rows_of, simhash
from pyspark.sql import functions as F

from replyloom.llm import near_dedup as N
from replyloom.llm.components import connected_components


def test_masks_cover_every_pair_of_positions():
    masks = N.covering_masks()
    assert len(masks) == 7
    for i in range(64):
        for j in range(i, 64):
            assert any(not (m >> i & 1 or m >> j & 1) for m in masks)


def test_fingerprints_equal_a_plain_count(spark):
    found = documents(spark).select("doc_id", N.fingerprint("text").alias("f"))
    mine = by_key((k, f % (1 << 64)) for k, f in rows_of(found))
    assert mine == by_key((k, simhash(t)) for k, t in TEXTS)


def test_components_equal_comparing_all(spark):
    base = " ".join(f"t{i}" for i in range(400)).split()
    random.seed(3)
    rows = list(TEXTS)
    for i in range(60):
        copy = list(base)
        for _ in range(i % 5):
            copy[random.randrange(len(copy))] = f"new{i}"
        rows.append((100 + i, " ".join(copy)))
    found = N.near_duplicates(documents(spark, rows))
    prints = {t: simhash(t) for _, t in rows}
    root = components(set(prints.values()), lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for k, t in rows:
        if k is not None:
            r = root[prints[t]]
            least[r] = min(k, least.get(r, k))
    want = by_key((k, f"{prints[t]:016x}", least.get(root[prints[t]])) for k, t in rows)
    assert rows_of(found) == want


def test_links_join_what_is_within_two_bits(spark):
    """Dense and sparse fingerprints; no bucket is paired off, no link is lost."""
    random.seed(11)
    centres = [random.getrandbits(64) for _ in range(20)]
    values = set(centres) | {0}
    for c in centres[:8]:
        for _ in range(60):
            x = c
            for _ in range(random.randrange(1, 4)):
                x ^= 1 << random.randrange(64)
            values.add(x)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    edges = N.near_links(spark.createDataFrame(signed, "fp long")).collect()
    assert all(((e.u ^ e.v) % (1 << 64)).bit_count() <= 2 for e in edges)
    mine = components({v for (v,) in signed}, lambda a, b: False)

    def find(x):
        while mine[x] != x:
            x = mine[x]
        return x

    for e in edges:
        a, b = find(e.u), find(e.v)
        mine[max(a, b)] = min(a, b)
    want = components({v for (v,) in signed}, lambda a, b: ((a ^ b) % (1 << 64)).bit_count() <= 2)
    assert {v: find(v) for v in mine} == want


def test_one_of_each_group(spark):
    docs = documents(spark)
    kept = N.one_of_each_group(docs)
    assert kept.columns == docs.columns
    found = {}
    for r in N.near_duplicates(docs).collect():
        found.setdefault(r.component_id, set()).add(r.doc_id)
    keys = [r.doc_id for r in kept.collect()]
    assert len(keys) == len(found)
    assert set(keys) == set(found)


def test_empty_table(spark):
    assert N.near_duplicates(documents(spark, [])).collect() == []
    assert N.one_of_each_group(documents(spark, [])).collect() == []


@pytest.mark.parametrize("kind", ["chain", "star", "random", "none"])
def test_connected_components(spark, kind):
    random.seed(2)
    edges = {
        "chain": [(i, i + 1) for i in range(200)] + [(7, 7), (300, 301), (301, 300)],
        "star": [(0, i) for i in range(1, 150)] + [(500, i) for i in range(501, 600)] + [(599, 149)],
        "random": [(random.randrange(300), random.randrange(300)) for _ in range(200)] + [(None, 3)],
        "none": [],
    }[kind]
    df = spark.createDataFrame(edges, "a long, b long").withColumn("a", F.col("a") - 50)
    found = {r.node: r.root for r in connected_components(df).rows.collect()}
    plain = [(a - 50, b) for a, b in edges if a is not None and a - 50 != b]
    nodes = {x for e in plain for x in e}
    near = set(plain) | {(b, a) for a, b in plain}
    assert found == components(nodes, lambda a, b: (a, b) in near)

import math

import numpy as np
import pytest

from replyloom.llm import whitening as W

NONE = "vec_id long, embedding array<float>, component string, n string, keys string, data string"


def frame(spark, rows):
    return spark.createDataFrame([(k, v, "c", "n", "k", "d") for k, v in rows], NONE).repartition(3)


def plain(rows):
    """Everything by the covariance's own eigenvectors; rows hold usable vectors of one length."""
    x = np.floor(64 * np.array([v for _, v in rows], dtype=np.float32).astype(float)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    centred = x - s / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)
    apart = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s)) for row in x]
    return n, values[order], vectors[:, order], centred, apart


def table(df):
    out = {}
    for r in df.collect():
        out.setdefault((r.vec_id, r.deviation), {})[r.component] = r
    return out


def random_rows(n, dim, seed=0, scale=None):
    random = np.random.default_rng(seed)
    x = random.standard_normal((n, dim)) * (np.linspace(3, 1, dim) if scale is None else scale)
    return [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(x)]


@pytest.mark.parametrize("n,dim", [(200, 12), (60, 40), (10, 24)])
def test_agrees_with_the_covariance(spark, n, dim):
    rows = random_rows(n, dim)
    count, values, vectors, centred, apart = plain(rows)
    got = table(W.whiten(frame(spark, rows)))
    assert len(got) == n
    expected = min(32, dim, n - 1)
    for (key, deviation), by_component in got.items():
        assert deviation == apart[key] and sorted(by_component) == list(range(1, expected + 1))
        for c, r in by_component.items():
            assert r.n == count and r.identity_error < 1e-9
            assert math.isclose(r.explained, values[c - 1] / values.sum(), rel_tol=1e-9)
            mine = centred[key] @ vectors[:, c - 1] / math.sqrt(values[c - 1])
            assert abs(abs(r.whitened) - abs(mine)) < 1e-7


def test_the_sign_is_the_same_for_all_rows(spark):
    rows = random_rows(80, 6, seed=3)
    _, values, vectors, centred, _ = plain(rows)
    signs = {}
    for (key, _), by_component in table(W.whiten(frame(spark, rows))).items():
        for c, r in by_component.items():
            mine = centred[key] @ vectors[:, c - 1] / math.sqrt(values[c - 1])
            if abs(mine) > 1e-3:
                signs.setdefault(c, set()).add(np.sign(mine) == np.sign(r.whitened))
    assert all(len(s) == 1 for s in signs.values()) and len(signs) == 6


def test_bidiagonal_matrix_and_orthogonality(spark):
    blocks = W.pack_rows(frame(spark, random_rows(150, 10, seed=1)))
    found = W.bidiagonalise(blocks, components=10)
    assert np.abs(found.components.T @ found.components - np.eye(10)).max() < 1e-12
    assert math.isclose(found.variances.sum(), blocks.trace, rel_tol=1e-12) and found.steps == 10


def test_equal_variances_are_all_found(spark):
    """Three directions of one variance: a walk from one start sees one of them, fresh starts the others."""
    rows = [(i, [2.0 * (i == k) - 2.0 * (i == k + 4) for k in range(4)]) for i in range(8)]
    got = table(W.whiten(frame(spark, rows)))
    assert all(sorted(c) == [1, 2, 3, 4] for c in got.values())
    assert all(math.isclose(r.explained, 0.25, rel_tol=1e-12) for c in got.values() for r in c.values())
    assert all(r.identity_error < 1e-12 for c in got.values() for r in c.values())


def test_awkward_vectors(spark):
    rows = random_rows(40, 5, seed=2)
    bad = [(100, None), (101, [1.0, None, 2.0, 3.0, 4.0]), (102, [1.0, float("nan"), 1.0, 1.0, 1.0]), (103, [float("inf")] * 5)]
    twice = [rows[0], (None, rows[1][1])]
    short = [(200, [1.5, -0.25]), (201, [])]
    filled = [(200, [1.5, -0.25, 0.0, 0.0, 0.0]), (201, [0.0] * 5)]
    got = W.whiten(frame(spark, rows + bad + twice + short)).collect()
    assert {r.vec_id for r in got} == {*range(40), None, 200, 201}
    assert len(got) == 44 * 5
    count, _, _, _, apart = plain([(0, v) for _, v in rows + twice + filled])
    assert sorted(r.deviation for r in got if r.component == 1) == sorted(apart)
    assert all(r.n == count for r in got)


def test_huge_entries_keep_exact_deviations_or_null(spark):
    rows = [(i, [float(2**20 * i), 1.0 * (i % 3)]) for i in range(6)]
    _, _, _, _, apart = plain(rows)
    assert {r.vec_id: r.deviation for r in W.whiten(frame(spark, rows)).collect()} == dict(enumerate(apart))
    beyond = [(i, [float(2.0**60 * i)]) for i in range(3)]
    assert {r.deviation for r in W.whiten(frame(spark, beyond)).collect()} == {None}


def test_nothing_to_find(spark):
    for rows in ([], [(1, [1.0, 2.0])], [(i, [0.5, 0.25]) for i in range(5)], [(1, []), (2, [])], [(1, None)]):
        assert W.whiten(frame(spark, rows)).collect() == []

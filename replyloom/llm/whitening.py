"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

X holds the centred rows.  Starting from a unit vector v, the method alternates
products: u = Xv less what earlier u's explain, then v = X'u less what earlier
v's explain, both scaled to unit length.  The lengths form an upper bidiagonal
matrix B with X V = U B; the singular value decomposition of the small B gives
the principal components (V times its right vectors) and their deviations.
Both sides are reorthogonalised in full against all that came before.

Rows stay where they are.  They are written once as blocks of small integers,
and every step is one job over the blocks: a task forms its part of the long
vector Xv, the products of that part with all earlier u's, and its contribution
to X'(Xv); sums over tasks are a few numbers per dimension.  A long vector u is
always X times a short vector p, kept on the driver, so none is ever stored or
moved.  What Xv lacks in orthogonality is a sum of earlier u's, whose X'u are
known, so one job serves both products of a step.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from replyloom.llm.common import Stored, store

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 32
#: Up to this dimension all steps are made, so that equal eigenvalues appear as often as they are.
EXHAUSTIVE = 512
#: Relative size under which a deviation, a residual or a coupling is rounding.
TINY = 1e-12
BLOCK_VALUES = 1 << 18
SEED = 42
#: Entries beyond this are set to it; x stays a long then.
MOST = float(1 << 53)
LONGEST = (1 << 63) - 1


class Blocks(NamedTuple):
    """The rows as stored blocks: their number, dimension, exact sums, squares and means."""

    table: Stored
    n: int
    dim: int
    sums: tuple[int, ...]
    trace: float
    base: np.ndarray
    shift: np.ndarray


class Whitening(NamedTuple):
    """Unit components as columns, in falling order of their variances, and the variances."""

    components: np.ndarray
    variances: np.ndarray
    trace: float
    steps: int


def usable(vector: str) -> Column:
    """True for a vector that is there and whose entries are all there and finite."""
    entry_ok = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    return F.col(vector).isNotNull() & F.forall(vector, lambda c: F.coalesce(entry_ok(c.cast("double")), F.lit(False)))


def _small(block: np.ndarray) -> np.ndarray:
    """The same integers in the narrowest type that holds them."""
    most = int(np.abs(block).max(initial=0))
    return block.astype("<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8")


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, vectors = batch.column(0), batch.column(1)
        lengths = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        ends = np.concatenate([[0], np.cumsum(lengths)])
        first = 0
        while first < len(keys):
            width = max(1, int(lengths[first:].max(initial=0)))
            last = min(len(keys), first + max(1, BLOCK_VALUES // width))
            size = lengths[first:last]
            rows = np.zeros((last - first, int(size.max(initial=0))), dtype=np.int64)
            values = np.clip(np.floor(flat[ends[first] : ends[last]] * SCALE), -MOST, MOST).astype(np.int64)
            inside = np.arange(rows.shape[1]) < size[:, None]
            rows[inside] = values
            # Small values add up in 64 bits; others in whole numbers of any size.
            safe = int(np.abs(rows).max(initial=0)) < 1 << 24
            exact = rows if safe else rows.astype(object)
            squares = int((exact * exact).sum())
            stored = _small(rows)
            yield pa.record_batch(
                {
                    "keys": pa.ListArray.from_arrays([0, last - first], keys.slice(first, last - first)),
                    "width": pa.array([rows.shape[1]], pa.int32()),
                    "bytes_each": pa.array([stored.itemsize], pa.int32()),
                    "data": pa.array([stored.tobytes()], pa.binary()),
                    "sums": pa.array([[str(x) for x in exact.sum(axis=0)]], pa.list_(pa.string())),
                    "squares": pa.array([str(squares)]),
                }
            )
            first = last


def pack_rows(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> Blocks:
    """Write the usable rows as blocks of integers floor(64 c) and add them up exactly."""
    kept = vectors.filter(usable(vector)).select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("v"))
    kind = kept.schema["key"].dataType.simpleString()
    schema = f"keys array<{kind}>, width int, bytes_each int, data binary, sums array<string>, squares string"
    table = store(kept.mapInArrow(_pack, schema), "whitening-blocks")
    total = table.rows.agg(
        F.coalesce(F.sum(F.size("keys")), F.lit(0)).alias("n"),
        F.coalesce(F.max("width"), F.lit(0)).alias("dim"),
        F.coalesce(F.sum(F.col("squares").cast("decimal(38,0)")), F.lit(0)).alias("squares"),
    ).first()
    n, dim = int(total["n"]), int(total["dim"])
    sums = [0] * dim
    by_place = table.rows.select(F.posexplode("sums").alias("i", "s")).groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    for row in by_place.collect():  # one row per dimension
        sums[row["i"]] = int(row["s"])
    trace = float(n * int(total["squares"]) - sum(s * s for s in sums)) / n / n if n else 0.0
    base = np.array([round(s / n) for s in sums], dtype=np.int64) if n else np.zeros(dim, np.int64)
    # How much each mean lies above its base, from whole numbers.
    shift = np.array([(s - n * int(b)) / n for s, b in zip(sums, base)]) if n else np.zeros(dim)
    return Blocks(table, n, dim, tuple(s + OFFSET * n for s in sums), trace, base, shift)


def _rows(row: Row | dict, dim: int) -> np.ndarray:
    """A block's integers, narrower rows filled up with zeros."""
    width = row["width"]
    each = {2: "<i2", 4: "<i4", 8: "<i8"}[row["bytes_each"]]
    found = np.frombuffer(row["data"], dtype=each).reshape(-1, width) if width else np.zeros((len(row["keys"]), 0))
    return found if width == dim else np.pad(found, ((0, 0), (0, dim - width)))


def _centred(row: dict, base: np.ndarray, shift: np.ndarray) -> np.ndarray:
    return (_rows(row, len(base)) - base).astype(np.float64) - shift


def _summed(blocks: Blocks, per_block: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all blocks of a short vector per block of centred rows."""
    base, shift = blocks.base, blocks.shift

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for row in batch.to_pylist():
                part = per_block(_centred(row, base, shift))
                total = part if total is None else total + part
        if total is not None:
            yield pa.record_batch({"i": pa.array(np.arange(len(total)), pa.int32()), "s": pa.array(total, pa.float64())})

    narrow = blocks.table.rows.select("width", "bytes_each", "data")
    sums = narrow.mapInArrow(run, "i int, s double").groupBy("i").agg(F.sum("s").alias("s")).collect()
    out = np.zeros(len(sums))
    for row in sums:  # as many rows as the short vector has places
        out[row["i"]] = row["s"]
    return out


def _unit_against(basis: np.ndarray, vector: np.ndarray) -> tuple[np.ndarray, float]:
    """``vector`` without what the columns of ``basis`` explain (twice is enough), and its length."""
    for _ in range(2):
        vector = vector - basis @ (basis.T @ vector)
    return vector, float(np.linalg.norm(vector))


def _fresh(basis: np.ndarray, random: np.random.Generator) -> np.ndarray:
    """A random unit vector that the columns of ``basis`` do not explain."""
    vector, length = _unit_against(basis, random.standard_normal(len(basis)))
    return vector / length


def bidiagonalise(blocks: Blocks, components: int = COMPONENTS) -> Whitening:
    """The leading components of the centred rows; fewer if there are fewer with any variance.

    A step costs one job.  All ``dim`` steps are made up to ``EXHAUSTIVE``
    dimensions.  Beyond, the steps end when the residuals of all wanted
    components are rounding; a variance that several components share exactly
    may then be found for some of them only.  Where X has no more to give
    (``alpha`` or ``beta`` is rounding), the walk begins anew, uncoupled.
    """
    dim, scale = blocks.dim, math.sqrt(blocks.trace * blocks.n)
    none = Whitening(np.zeros((dim, 0)), np.zeros(0), blocks.trace, 0)
    if not dim or scale == 0.0:
        return none
    random = np.random.default_rng(SEED)
    v = _fresh(np.zeros((dim, 0)), random)
    right = np.zeros((dim, 0))  # V
    left = np.zeros((dim, 0))  # P with U = X P
    image = np.zeros((dim, 0))  # X'U
    alphas: list[float] = []
    betas: list[float] = []
    beta = 0.0
    for step in range(1, dim + 1):
        p = v - beta * left[:, -1] if beta else v

        def products(x: np.ndarray, p: np.ndarray = p, left: np.ndarray = left) -> np.ndarray:
            y = x @ p  # Xv - beta u
            return np.concatenate([[y @ y], (x @ left).T @ y, x.T @ y])

        sums = _summed(blocks, products)
        overlap, image_of_y = sums[1:step], sums[step:]
        alpha = math.sqrt(max(0.0, sums[0] - float(overlap @ overlap)))
        right = np.column_stack([right, v])
        if alpha > TINY * scale:
            p = (p - left @ overlap) / alpha
            z = (image_of_y - image @ overlap) / alpha  # X'u
        else:
            alpha, p, z = 0.0, np.zeros(dim), np.zeros(dim)
        alphas.append(alpha)
        left, image = np.column_stack([left, p]), np.column_stack([image, z])
        v, beta = _unit_against(right, z)
        betas.append(beta)
        if step == dim:
            break
        if beta > TINY * scale:
            v = v / beta
        else:
            v, beta = _fresh(right, random), 0.0
            betas[-1] = 0.0
        if dim > EXHAUSTIVE and step >= 2 * components:
            _, deviations, _ = np.linalg.svd(np.diag(alphas) + np.diag(betas[:-1], 1))
            u = np.linalg.svd(np.diag(alphas) + np.diag(betas[:-1], 1))[0]
            if np.all(beta * np.abs(u[-1, :components]) <= TINY * deviations[0]):
                break
    _, deviations, turns = np.linalg.svd(np.diag(alphas) + np.diag(betas[: len(alphas) - 1], 1))
    kept = int(np.sum(deviations[:components] > math.sqrt(TINY) * deviations[0]))
    found = right @ turns[:kept].T
    # A component's sign is free: its largest entry is positive.
    largest = np.abs(found).argmax(axis=0)
    found = found * np.where(found[largest, np.arange(kept)] < 0, -1.0, 1.0)
    return Whitening(found, deviations[:kept] ** 2 / blocks.n, blocks.trace, len(alphas))


def identity_error(blocks: Blocks, found: Whitening) -> float:
    """The largest absolute entry of the whitened rows' covariance minus the identity."""
    k = len(found.variances)
    if not k:
        return 0.0
    turn = found.components / np.sqrt(found.variances)

    def moments(x: np.ndarray) -> np.ndarray:
        w = x @ turn
        return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])

    sums = _summed(blocks, moments) / blocks.n
    mean = sums[:k]
    return float(np.abs(sums[k:].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max())


def _distances(rows: np.ndarray, base: np.ndarray, n: int, rest: np.ndarray) -> list[int | None]:
    """Sums of (n x - S)^2 as whole numbers; null beyond a long."""
    offsets = rows.astype(np.int64) - base
    most = n * int(np.abs(offsets).max(initial=0)) + int(max((abs(int(r)) for r in rest), default=0))
    if len(base) * most * most <= LONGEST:
        apart = n * offsets - rest.astype(np.int64)
        return (apart * apart).sum(axis=1).tolist()
    apart = n * offsets.astype(object) - rest
    sums = (apart * apart).sum(axis=1)
    return [int(s) if s <= LONGEST else None for s in sums]


def apply_whitening(blocks: Blocks, found: Whitening, error: float, key: str = "vec_id") -> DataFrame:
    """One row per vector and component: key, component, n, deviation, whitened, explained, identity_error."""
    n, base, shift, k = blocks.n, blocks.base, blocks.shift, len(found.variances)
    rest = np.array([s - OFFSET * n - n * int(b) for s, b in zip(blocks.sums, base)], dtype=object)
    turn = found.components / np.sqrt(found.variances)
    share = found.variances / found.trace if k else np.zeros(0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, row in enumerate(batch.select(["width", "bytes_each", "data", "keys"]).to_pylist()):
                keys = batch.column("keys")[at].values
                m = len(keys)
                whitened = _centred(row, base, shift) @ turn
                distances = pa.array(_distances(_rows(row, len(base)), base, n, rest), pa.int64())
                each = np.repeat(np.arange(m), k)
                yield pa.record_batch(
                    {
                        key: keys.take(pa.array(each)),
                        "component": pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                        "n": pa.array(np.full(m * k, n), pa.int64()),
                        "deviation": distances.take(pa.array(each)),
                        "whitened": pa.array(whitened.ravel(), pa.float64()),
                        "explained": pa.array(np.tile(share, m), pa.float64()),
                        "identity_error": pa.array(np.full(m * k, error), pa.float64()),
                    }
                )

    kind = blocks.table.rows.schema["keys"].dataType.elementType.simpleString()
    return blocks.table.rows.mapInArrow(
        run,
        f"`{key}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double",
    )


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``apply_whitening`` of the components fitted on the same rows.

    Rows whose vector is null or holds a null or non-finite entry are dropped
    and take no part in any sum.  A shorter vector counts as filled up with
    zeros.  Entries beyond 2^53 / 64 count as that.  A deviation beyond a long is
    null.  Components without variance are not returned, so equal rows, a single
    row, empty vectors and an empty table give no rows.  Repeated rows and null
    keys are rows like any other.  Other columns are not carried, so their names
    do not matter.
    """
    blocks = pack_rows(vectors, key, vector)
    found = bidiagonalise(blocks, components)
    return apply_whitening(blocks, found, identity_error(blocks, found), key)

"""PCA whitening of embeddings from exact bit-sliced cross-products.

A component c of a vector becomes the integer x = floor(64 c) + 1,000,000. The covariance is fitted on each distinct
x-vector once. Within an Arrow batch every dimension is shifted by its least value, so that few bits remain, and its bit
planes are packed across rows into 64-bit words; the cross-product of two dimensions is the sum over pairs of planes
of 2^(p+q) times the population count of their AND. Shifts are undone with the sums, batches are added up in whole numbers,
and so are tasks (two decimals of 38 digits a number), so n, S and the products are exact. n * products - S S' is formed in whole numbers
too, and only its quotient by n^2 becomes a double, for ``eigh``. Rounding therefore starts behind all cancellation.

What reaches the driver is one number per pair of dimensions, and what is sent to the tasks is 16 vectors: both follow
the width of the embeddings, not their number. Copies are reduced before the exchange of the distinct step.

Defined cases: null vectors and vectors with null or non-finite entries are left out; so are empty ones and those whose
length is not the commonest (of equally common lengths the largest). Components beyond the range of a long are cut to
it. Rows without vec_id and repeated rows stay, each with its result. Components without variance cannot be scaled and
have no row, nor have those with less than ``FLOOR`` of the largest one's: of n equal vectors, or of one, nothing remains. An
empty table gives no rows. Equal eigenvalues leave their components' directions open, but they are the same for all rows. A deviation beyond
a long is null. Only the key and the vector are read, so further columns of any name change nothing.
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmark.llm.common import map_batches, record_batch, stage
from haulmark.session import ship_package

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
_LOW = (1 << 64) - 1
FLOOR = 1e-13  # share of the largest eigenvalue below which rounding of ``eigh`` hides an eigenvalue


def integers(embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """key and x of every row whose vector is whole and finite."""
    entries = F.col("c").cast("array<double>")
    whole = F.forall(entries, lambda c: c.isNotNull() & (F.abs(c) < F.lit(float("inf"))))  # NaN is above infinity
    inside = F.lit(float((1 << 63) - 1))
    grown = F.transform(entries, lambda c: F.floor(F.greatest(F.least(c * SCALE, inside), -inside)))
    return (embeddings.select(F.col(key).alias("key"), F.col(vector).alias("c")).filter("c IS NOT NULL AND size(c) > 0").filter(whole)
            .select("key", F.transform(grown, lambda v: F.least(v, F.lit((1 << 63) - 1 - OFFSET)) + OFFSET).alias("x")))


def _matrix(column: pa.ListArray) -> np.ndarray:
    """Rows of lists of one length as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def scatter(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums and cross-products of the columns of an integer matrix, exact, as whole numbers of any size.

    The planes of all dimensions lie below each other; the AND of one plane with all that follow is one operation.
    """
    n, dims = x.shape
    low = x.min(axis=0)
    shifted = x.astype(np.uint64) - low.astype(np.uint64)  # right also where the difference is above a long
    bits = [int(v).bit_length() for v in shifted.max(axis=0)]
    planes = [(d, p) for d in range(dims) for p in range(bits[d])]
    words = -(-n // 64)
    packed = np.zeros((len(planes), words), np.uint64)
    for k, (d, p) in enumerate(planes):
        row = np.packbits((shifted[:, d] >> np.uint64(p)).astype(np.uint8) & np.uint8(1))
        packed[k].view(np.uint8)[:len(row)] = row
    of = np.array([d for d, _ in planes], np.int64)
    place = np.array([p for _, p in planes], np.int64)
    firsts = np.searchsorted(of, np.arange(dims))
    sums, products = np.zeros(dims, object), np.zeros((dims, dims), object)
    for k, (d, p) in enumerate(planes):
        sums[d] += int(np.bitwise_count(packed[k]).sum(dtype=np.int64)) << p
        at = firsts[d]
        counts = np.bitwise_count(packed[at:] & packed[k]).sum(axis=1, dtype=np.int64)
        if max(bits) < 20 and n < 1 << 20:  # weight and count stay inside a long
            line = np.zeros(dims, np.int64)
            np.add.at(line, of[at:], counts << place[at:])
            products[d] += line.astype(object) << p
        else:
            for e, q, c in zip(of[at:].tolist(), place[at:].tolist(), counts.tolist()):
                products[d, e] += c << (p + q)
    products = np.triu(products) + np.triu(products, 1).T
    back = low.astype(object)
    whole = products + np.outer(sums, back) + np.outer(back, sums) + n * np.outer(back, back)
    return sums + n * back, whole


def _totals(distinct: DataFrame) -> tuple[int, list[int], np.ndarray]:
    """n, sums and cross-products over all rows of ``x``; each task hands on one number per pair of dimensions."""
    def run(batches):
        n, sums, products = 0, 0, 0
        for batch in batches:
            if batch.num_rows:
                s, p = scatter(_matrix(batch.column("x")))
                n, sums, products = n + batch.num_rows, sums + s, products + p
        if n:
            a, b = np.triu_indices(len(sums))
            yield record_batch(a=pa.array(np.r_[-1, np.full(len(sums), -1), a], pa.int32()),
                               b=pa.array(np.r_[-1, np.arange(len(sums)), b], pa.int32()),
                               high=pa.array([str(v >> 64) for v in (n, *sums, *products[a, b])]),
                               low=pa.array([str(v & _LOW) for v in (n, *sums, *products[a, b])]))
    found = (distinct.mapInArrow(run, "a int, b int, high string, low string").groupBy("a", "b")
             .agg(*(F.sum(F.col(c).cast("decimal(38,0)")).cast("string").alias(c) for c in ("high", "low"))).collect())
    dims = max((r["b"] for r in found), default=-1) + 1
    n, sums, products = 0, [0] * dims, np.zeros((dims, dims), object)
    for a, b, high, low in found:
        v = (int(high) << 64) + int(low)
        if a >= 0:
            products[a, b] = products[b, a] = v
        elif b >= 0:
            sums[b] = v
        else:
            n = v
    return n, sums, products


@dataclass
class Whitening:
    n: int
    sums: list[int]
    axes: np.ndarray        # dimensions by components, scaled by 1 / sqrt(eigenvalue)
    explained: list[float]

    def deviations(self, x: np.ndarray) -> tuple[np.ndarray, list]:
        """n x - S in whole numbers, and the sum of its squares per row (None beyond a long)."""
        size = max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0)))) * self.n + max(map(abs, self.sums), default=0)
        if size * size * max(1, len(self.sums)) < 1 << 63:
            centred = x * self.n - np.array(self.sums, np.int64)
            return centred, (centred * centred).sum(axis=1).tolist()
        centred = x.astype(object) * self.n - np.array(self.sums, object)
        wide = max(abs(int(centred.min(initial=0))), abs(int(centred.max(initial=0))))
        if wide * wide * max(1, len(self.sums)) < 1 << 63:
            centred = centred.astype(np.int64)
            return centred, (centred * centred).sum(axis=1).tolist()
        squares = (centred * centred).sum(axis=1)
        return centred, [int(v) if v < 1 << 63 else None for v in squares]

    def project(self, centred: np.ndarray) -> np.ndarray:
        return (centred / self.n).astype(np.float64) @ self.axes


def fit(n: int, sums: list[int], products: np.ndarray, components: int = COMPONENTS) -> Whitening:
    """Eigenvectors of (n * products - S S') / n^2; the numerator is a whole number, its quotient the nearest double."""
    s = np.array(sums, object)
    numerator = n * products - np.outer(s, s) if n else products
    dims = len(sums)
    total = float(Fraction(int(np.trace(numerator)), n * n)) if n else 0.0
    if not total:
        return Whitening(n, sums, np.zeros((dims, 0)), [])
    covariance = np.array([[float(Fraction(int(v), n * n)) for v in row] for row in numerator])
    values, vectors = np.linalg.eigh(covariance)
    kept = min(components, int((values > FLOOR * values[-1]).sum()))
    values, vectors = values[::-1][:kept], vectors[:, ::-1][:, :kept]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(kept)])
    return Whitening(n, sums, vectors * signs / np.sqrt(values), (values / total).tolist())


def _identity_error(distinct: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened fit list, from its rows, minus the identity."""
    k = len(model.explained)
    if not k:
        return 0.0

    def run(batches):
        sums, products = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            if batch.num_rows:
                white = model.project(model.deviations(_matrix(batch.column("x")))[0])
                sums, products = sums + white.sum(axis=0), products + white.T @ white
        yield record_batch(place=pa.array(np.arange(k + k * k), pa.int32()), v=pa.array(np.r_[sums, products.ravel()]))
    found = dict(distinct.mapInArrow(run, "place int, v double").groupBy("place").agg(F.sum("v").alias("v")).collect())
    flat = np.array([found[i] for i in range(k + k * k)]) / model.n
    mean, second = flat[:k], flat[k:].reshape(k, k)
    return float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max())


def whiten(embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """key, component, n, deviation, whitened, explained and identity_error of every whole vector and component."""
    rows = integers(embeddings, key, vector)
    lengths = rows.groupBy(F.size("x").alias("length")).count()
    commonest = lengths.agg(F.max(F.struct("count", "length"))["length"]).first()[0] or 0
    rows = rows.filter(F.size("x") == commonest)
    distinct = stage(rows.select("x").distinct(), "fit-list")
    ship_package(embeddings.sparkSession)
    model = fit(*_totals(distinct), components)
    error = _identity_error(distinct, model)
    explained = np.array(model.explained)

    def each(batch):
        k = len(explained)
        if not batch.num_rows or not k:
            return
        centred, squares = model.deviations(_matrix(batch.column("x")))
        n = batch.num_rows
        yield record_batch(key=batch.column("key").take(pa.array(np.repeat(np.arange(n), k))),
                           component=pa.array(np.tile(np.arange(1, k + 1), n), pa.int32()),
                           n=pa.array(np.full(n * k, model.n), pa.int64()),
                           deviation=pa.array(squares, pa.int64()).take(pa.array(np.repeat(np.arange(n), k))),
                           whitened=pa.array(model.project(centred).ravel()), explained=pa.array(np.tile(explained, n)),
                           identity_error=pa.array(np.full(n * k, error)))
    kind = rows.schema["key"].dataType.simpleString()
    return map_batches(rows, f"key {kind}, component int, n long, deviation long, whitened double, explained double, "
                             "identity_error double", each).withColumnRenamed("key", key)

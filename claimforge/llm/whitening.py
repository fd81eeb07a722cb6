"""Whitening of embeddings: leading eigenvectors of their covariance by matrix-free block Lanczos.

1. Components become integers, so that counts, sums and deviations from the mean are exact.
2. The covariance V is never built. A pass over the vectors gives V times a block of directions: each task adds
   the products of its centred rows, and Spark adds the tasks' sums by position.
3. Every new block is made orthogonal to all before it, twice. Directions that vanish (breakdown) restart from
   seeded random ones. Ritz pairs come from the whole basis; the passes end when the residuals of the wanted ones are
   small against the largest eigenvalue, or when the basis spans the space.
4. The trace of V is the mean squared deviation, so shares need no further eigenvalues.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from claimforge.llm.common import store

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Directions of a pass.
BLOCK = 16
#: Residuals over the largest eigenvalue at which pairs count as found.
TOLERANCE = 1e-13
#: Eigenvalues over the largest one, up to which rounding cannot be told from variance; such components are left out.
RANK = 1e-10
LONG = 2**63 - 1


def matrix(batch: pa.RecordBatch) -> np.ndarray:
    """The integer vectors of a batch, all of one length."""
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)


@dataclass
class Centre:
    """The number of vectors and their sums by dimension: exact integers of any size."""

    n: int
    sums: list[int]

    def scaled(self, x: np.ndarray) -> np.ndarray:
        """n times the deviations from the mean, exactly: longs where they suffice, else Python's integers."""
        most = max([abs(int(x.min(initial=0))), abs(int(x.max(initial=0)))])
        if self.n * most + max(map(abs, self.sums), default=0) <= LONG:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.scaled(x).astype(np.float64) / self.n

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """Sums of the squared scaled deviations of each row, exactly; beyond a long, the nearest long."""
        scaled = self.scaled(x)
        most = max(abs(int(scaled.min(initial=0))), abs(int(scaled.max(initial=0)))) if scaled.size else 0
        if most**2 * max(1, x.shape[1]) <= LONG:
            return (scaled.astype(np.int64) ** 2).sum(axis=1)
        return np.array([min(LONG, sum(int(v) ** 2 for v in row)) for row in scaled], np.int64)


def prepared(vectors: DataFrame, vec_id: str, embedding: str, scale: int, shift: int) -> DataFrame:
    """(vec_id, x, d): integer vectors of the rows whose components are all finite, with their length."""
    v = vectors.select(vectors[vec_id].alias("vec_id"), vectors[embedding].alias("v"))
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    x = F.transform("v", lambda c: F.floor(c.cast("double") * scale) + shift)
    return v.filter(F.col("v").isNotNull() & F.forall("v", finite)).select("vec_id", x.alias("x"), F.size("v").alias("d"))


def totals(rows: DataFrame, parts: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sums over all vectors of what ``parts`` makes of a block of them: one row a task, then added by position."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for batch in batches:
            if len(batch):
                made = np.asarray(parts(matrix(batch)), np.float64).ravel()
                own = made if own is None else own + made
        if own is not None:
            yield pa.RecordBatch.from_arrays([pa.array([own], pa.list_(pa.float64()))], names=["part"])

    each = rows.select("x").mapInArrow(run, StructType([StructField("part", ArrayType(DoubleType()))]))
    added = each.select(F.posexplode("part").alias("at", "value")).groupBy("at").agg(F.sum("value").alias("value"))
    return np.array([v for _, v in sorted((r["at"], r["value"]) for r in added.collect())])  # numbers of the block, not of rows


def centre(rows: DataFrame, d: int) -> Centre:
    """Count and sums, exactly: decimals hold the sums of longs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * d
        for batch in batches:
            x = matrix(batch)
            wide = len(x) * max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0)))) > LONG
            n, sums = n + len(x), [a + int(b) for a, b in zip(sums, x.sum(axis=0, dtype=object if wide else np.int64), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([list(map(Decimal, sums))], pa.list_(pa.decimal128(38, 0)))], names=["n", "sums"])

    each = rows.select("x").mapInArrow(run, "n long, sums array<decimal(38,0)>")
    added = each.select("n", F.posexplode("sums").alias("at", "s")).groupBy("at").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()  # a row for each dimension
    by = {r["at"]: r for r in added}
    return Centre(by[0]["n"] if by else 0, [int(by[i]["s"]) for i in range(d)] if by else [])


def orthogonal(block: np.ndarray, basis: np.ndarray, rng: np.random.Generator, floor: float) -> np.ndarray:
    """Orthonormal columns orthogonal to ``basis`` that span ``block``; random ones take the place of what vanishes."""
    basis, out = basis, []
    room = len(block) - basis.shape[1]
    for column in block.T[: max(0, room)]:
        least = floor
        while True:
            for _ in range(2):
                column = column - basis @ (basis.T @ column)
            size = np.linalg.norm(column)
            if size > least:
                break
            column, least = rng.standard_normal(len(block)), 1e-8  # breakdown: restart in a new direction
            column /= np.linalg.norm(column)
        q = column / size
        q -= basis @ (basis.T @ q)
        q /= np.linalg.norm(q)
        out.append(q)
        basis = np.column_stack([basis, q])
    return np.column_stack(out) if out else np.empty((len(block), 0))


def lanczos(times: Callable[[np.ndarray], np.ndarray], d: int, k: int, block: int = BLOCK, tolerance: float = TOLERANCE, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric operator, falling, and unit eigenvectors as columns.

    ``times`` gives the operator's product with a block. A block of more directions than ``k`` also finds equal ones.
    """
    rng = np.random.default_rng(seed)
    k = min(k, d)
    basis, image = np.empty((d, 0)), np.empty((d, 0))
    new = orthogonal(rng.standard_normal((d, min(d, max(block, k)))), basis, rng, 1e-8)
    while True:
        product = times(new)
        basis, image = np.column_stack([basis, new]), np.column_stack([image, product])
        inner = basis.T @ image
        values, small = np.linalg.eigh((inner + inner.T) / 2)
        values, small = values[::-1][:k], small[:, ::-1][:, :k]
        found = basis @ small
        residual = np.linalg.norm(image @ small - found * values, axis=0)
        top = max(abs(values[0]), np.finfo(np.float64).tiny) if k else 1.0
        if basis.shape[1] >= d or basis.shape[1] > new.shape[1] and residual.max(initial=0) <= tolerance * top:
            return values, found / np.linalg.norm(found, axis=0)
        new = orthogonal(product, basis, rng, 1e-13 * top)


@dataclass
class Whitening:
    """A fit: ``components`` are columns, ``values`` their variances, ``trace`` the whole variance."""

    centre: Centre
    values: np.ndarray
    components: np.ndarray
    trace: float

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centre.centred(x) @ self.components / np.sqrt(self.values)

    def transform(self, rows: DataFrame) -> DataFrame:
        """(vec_id, deviation, whitened): prepared rows with their deviations and whitened vectors."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = matrix(batch)
                made = pa.array(list(self.project(x)), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(self.centre.deviations(x), pa.int64()), made], names=["vec_id", "deviation", "whitened"])

        schema = StructType([StructField("vec_id", rows.schema["vec_id"].dataType), StructField("deviation", LongType()), StructField("whitened", ArrayType(DoubleType()))])
        return rows.select("vec_id", "x").mapInArrow(run, schema)

    def identity_error(self, rows: DataFrame) -> float:
        """The largest absolute entry of the covariance of the whitened vectors, less the identity."""
        mean = totals(rows, lambda x: self.project(x).sum(axis=0)) / self.centre.n

        def products(x: np.ndarray) -> np.ndarray:
            w = self.project(x) - mean
            return w.T @ w

        k = len(self.values)
        return float(np.abs(totals(rows, products).reshape(k, k) / self.centre.n - np.eye(k)).max(initial=0))


def fit(rows: DataFrame, d: int, components: int = COMPONENTS, block: int = BLOCK) -> Whitening:
    """Fit to all ``rows`` (``prepared``, all of length ``d``)."""
    c = centre(rows, d)
    trace = 0.0

    def times(q: np.ndarray) -> np.ndarray:
        nonlocal trace

        def parts(x: np.ndarray) -> np.ndarray:
            y = c.centred(x)
            return np.append(y.T @ (y @ q), (y * y).sum())

        *product, squares = totals(rows, parts) / c.n
        trace = squares
        return np.reshape(product, (d, -1))

    values, vectors = lanczos(times, d, components, block)
    held = values > RANK * max(values[:1].max(initial=0), 0)
    return Whitening(c, values[held], vectors[:, held], trace)


def whiten(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> list[tuple[Whitening, DataFrame]]:
    """The fits of ``vectors`` and the prepared rows of each, one for each length of vectors (there must be few).

    A component c becomes floor(scale * c) + shift. Rows whose vector is null or holds null or non-finite
    components take no part; zero vectors and rows without an id or that repeat one do. Components beyond the rank of
    the data are left out, so equal vectors, a single one, and empty ones have none. Other columns are not carried.
    """
    rows = store(prepared(vectors, vec_id, embedding, scale, shift), "vectors")
    lengths = sorted(r["d"] for r in rows.select("d").distinct().collect())
    found = [(d, rows.filter(F.col("d") == d)) for d in lengths if d]
    return [(fit(part, d, components), part) for d, part in found]


def op13_embedding_whitening(spark, sf_dir: str) -> DataFrame:
    """Whitened ``embeddings``, a row for each of 8 components, with deviations, explained shares and the identity's error."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    out = []
    for model, rows in whiten(vectors):
        shares = F.array(*(F.lit(float(v / model.trace)) for v in model.values)) if len(model.values) else F.array().cast("array<double>")
        made = model.transform(rows).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
        out.append(made.select(
            "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.centre.n).cast("long").alias("n"), "deviation", "whitened",
            F.element_at(shares, F.col("at") + 1).alias("explained"), F.lit(model.identity_error(rows)).alias("identity_error"),
        ))
    if not out:
        return spark.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    return reduce(DataFrame.unionByName, out)

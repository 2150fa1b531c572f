"""Embedding whitening (operator 13) by Golub-Kahan-Lanczos bidiagonalisation.

X holds the different integer vectors as rows, less their mean. Starting from a random direction, right vectors v and left
vectors u are made in turn from X v and Xᵀ u, each orthogonalised against all earlier ones, which leaves a small
bidiagonal matrix B with X V = U B. Its singular values and right singular vectors give the components. A left vector
has an entry per row of X, and is never stored: all lie in the span of X, so u = X g with a short vector g that the
driver keeps. One pass over the rows gives, for the next w = X g, its products with all u and with X.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.shared import staged

BLOCK_ROWS = 4096
ALL_STEPS = 128  # up to so many dimensions the bidiagonalisation is run to its end
TOLERANCE = 1e-13  # of the largest singular value: below it a direction is nothing but rounding
LARGEST = float(2**62)


def integers(column: pa.Array, scale: float) -> list[np.ndarray | None]:
    """Each vector as floor(scale * x), x as double; None if it or an entry is null, not finite or beyond LARGEST."""
    out: list[np.ndarray | None] = []
    for vector in column:
        values = vector.values
        if values is None or values.null_count:
            out.append(None)
            continue
        values = np.floor(scale * values.to_numpy(zero_copy_only=False).astype(np.float64))
        usable = np.isfinite(values).all() and (np.abs(values) < LARGEST).all()
        out.append((values + 0.0).astype("<i8") if usable else None)
    return out


def integer_vectors(vectors: DataFrame, scale: float, id_col: str, vector_col: str) -> DataFrame:
    """id and x, packed, of the usable rows."""
    kind = vectors.schema[id_col].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = integers(batch.column(1), scale)
            keep = [i for i, x in enumerate(found) if x is not None]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int64())), pa.array([found[i].tobytes() for i in keep], pa.binary())], names=["id", "x"])

    return vectors.select(id_col, vector_col).mapInArrow(scan, f"id {kind}, x binary")


def blocks_of(rows: DataFrame) -> DataFrame:
    """The different vectors, BLOCK_ROWS at most in a row: n, block."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.column(0)[at : at + BLOCK_ROWS].to_pylist()
                yield pa.RecordBatch.from_arrays([pa.array([len(part)]), pa.array([b"".join(part)], pa.binary())], names=["n", "block"])

    return rows.select("x").distinct().mapInArrow(pack, "n long, block binary")


class Rows(NamedTuple):
    """The fit list: blocks in the shared folder, and what centres them."""

    blocks: DataFrame
    width: int
    n: int
    total: np.ndarray  # exact sums of each dimension, as Python integers

    @classmethod
    def of(cls, blocks: DataFrame, width: int) -> Rows:
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for n, block in zip(batch.column(0).to_pylist(), batch.column(1)):
                    x = np.frombuffer(block.as_buffer(), "<i8").reshape(n, width)
                    low, high = (x & 0xFFFFFFFF).sum(0), (x >> 32).sum(0)  # each half adds up without overflow
                    yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(low), pa.array(high), pa.array(np.full(width, n))], names=["place", "low", "high", "n"])

        sums = blocks.mapInArrow(add, "place long, low long, high long, n long").groupBy("place")
        found = {r["place"]: r for r in sums.agg(*[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("low", "high", "n")]).collect()}
        n = int(found[0]["n"]) if found else 0
        return cls(blocks, width, n, np.array([int(found[i]["low"]) + (int(found[i]["high"]) << 32) for i in range(width)] if found else [], object))

    def centre(self) -> tuple[np.ndarray, np.ndarray]:
        """The mean in two parts: whole numbers, and the rest, which keeps its digits when vectors are far from zero."""
        whole = np.array([int(s) // self.n for s in self.total], np.int64)
        return whole, np.array([float(int(s) - int(w) * self.n) / self.n for s, w in zip(self.total, whole)])

    def summed(self, products) -> np.ndarray:
        """The sum over all blocks of what `products` makes of each block's centred rows, added up in Spark."""
        width, (whole, rest) = self.width, self.centre()

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                for n, block in zip(batch.column(0).to_pylist(), batch.column(1)):
                    x = (np.frombuffer(block.as_buffer(), "<i8").reshape(n, width) - whole).astype(np.float64) - rest
                    part = products(x)
                    total = part if total is None else total + part
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["place", "value"])

        found = self.blocks.mapInArrow(scan, "place long, value double").groupBy("place").agg(F.sum("value").alias("value")).toArrow()
        out = np.zeros(len(found))
        out[found.column("place").to_numpy()] = found.column("value").to_numpy()
        return out


class Components(NamedTuple):
    vectors: np.ndarray  # a column each
    values: np.ndarray  # eigenvalues of the covariance, falling
    trace: float


def bidiagonal(rows: Rows, components: int, *, seed: int = 7, all_steps: int = ALL_STEPS) -> Components:
    """The components of the largest eigenvalues; fewer if the rows span fewer dimensions.

    V's vectors are made orthogonal twice. A left vector is as well if the first time took much of it. If a new direction is nothing but
    rounding, another random one is taken, so that equal eigenvalues are all found. Beyond all_steps dimensions it ends when the
    wanted components stand, and another random direction and as many steps have not brought a larger one.
    """
    d, rng = rows.width, np.random.default_rng(seed)
    trace = float(rows.summed(lambda x: np.array([(x * x).sum()]))[0]) / rows.n
    floor = TOLERANCE * np.sqrt(trace * rows.n)
    V, G, Z = np.zeros((d, 0)), np.zeros((d, 0)), np.zeros((d, 0))  # v; g with u = X g; Xᵀ u
    B = np.zeros((0, 0))
    wanted, checked, before, beta = min(components, d), 0, None, 0.0

    def orthogonal(v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            v = v - V @ (V.T @ v)
        return v

    def fresh() -> np.ndarray:
        v = orthogonal(rng.standard_normal(d))
        return v / np.linalg.norm(v)

    def times(g: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
        """For w = X g: Uᵀ w, wᵀ w and Xᵀ w."""
        k = G.shape[1]
        both = np.column_stack([G, g])

        def products(x: np.ndarray) -> np.ndarray:
            u = x @ both
            w = u[:, -1]
            return np.concatenate([u.T @ w, x.T @ w])

        found = rows.summed(products)
        return found[:k], float(found[k]), found[k + 1 :]

    v = fresh()
    while True:
        k = V.shape[1]
        V = np.column_stack([V, v])
        g, upper = v.copy(), np.zeros(k)  # upper: the column of B above its diagonal
        if beta > 0:
            g, upper[-1] = g - beta * G[:, -1], beta
        while True:
            along, square, z = times(g)
            upper = upper + along
            # The parts along earlier u are taken off by the short vectors, and so off Xᵀ w.
            g, z = g - G @ along, z - Z @ along
            rest = square - along @ along
            if rest >= 0.25 * square or square <= floor * floor:
                break
        alpha = np.sqrt(max(rest, 0.0))
        grown = np.zeros((k + 1, k + 1))
        grown[:k, :k], grown[:k, k], grown[k, k] = B, upper, alpha if alpha > floor else 0.0
        B = grown
        if alpha > floor:
            G, Z = np.column_stack([G, g / alpha]), np.column_stack([Z, z / alpha])
            v = orthogonal(z / alpha)
        else:  # X v lies in the span of the earlier u: this u is nothing
            G, Z = np.column_stack([G, np.zeros(d)]), np.column_stack([Z, np.zeros(d)])
            v = np.zeros(d)
        if k + 1 == d:
            break
        beta = float(np.linalg.norm(v))
        if d > all_steps and k + 1 >= wanted:
            left, singular, _ = np.linalg.svd(B)
            stands = beta * np.abs(left[-1, :wanted]).max() <= 1e-12 * max(singular[0], floor)
            if stands and before is None:
                before, checked = singular[:wanted], k + 1
                beta = 0.0
            elif stands and k + 1 >= checked + max(8, checked // 2):
                if np.allclose(before, singular[:wanted], rtol=1e-12, atol=floor):
                    break
                before, checked, beta = singular[:wanted], k + 1, 0.0
        beta = beta if beta > floor else 0.0
        v = v / beta if beta > 0 else fresh()
    _, singular, right = np.linalg.svd(B)
    singular, right = singular[:wanted], right[:wanted]
    there = singular > 1e-7 * np.sqrt(trace * rows.n)
    vectors = V @ right[there].T
    return Components(vectors / np.linalg.norm(vectors, axis=0), singular[there] ** 2 / rows.n, trace)


def off_identity(rows: Rows, found: Components) -> float:
    """The largest entry of the whitened rows' covariance minus the identity."""
    k = len(found.values)
    into = found.vectors / np.sqrt(found.values)

    def products(x: np.ndarray) -> np.ndarray:
        y = x @ into
        return np.concatenate([(y.T @ y).ravel(), y.sum(0)])

    total = rows.summed(products) / rows.n
    mean = total[k * k :]
    return float(np.abs(total[: k * k].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max())


def whitened(vectors: DataFrame, *, components: int = 4, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Whitened coordinates: id_col, component (from 1), n, deviation, whitened, explained, identity_error.

    A vector's entries become x = floor(scale * entry). Components are those of the covariance of the different x, by falling
    eigenvalue; n is how many there are. deviation is the sum over dimensions of (n x - S)^2, S the dimension's sum,
    exact, and null beyond 64 bits. Rows whose vector is null, or has an entry that is null, not finite or beyond 2**62, have no
    result, nor have those of another length than most different vectors have (the shorter one, if two lengths tie). Each row
    of vectors has its rows, also with a null or repeated id. A component without variance has none, so an empty table or
    equal vectors give an empty result. Other columns are left out. The driver keeps matrices of dimension by step.
    """
    kind = vectors.schema[id_col].dataType.simpleString()
    spark = vectors.sparkSession
    usable = integer_vectors(vectors, scale, id_col, vector_col)
    different = staged(usable.where(F.octet_length("x") > 0).select("x").distinct(), "different-vectors")
    lengths = different.groupBy(F.octet_length("x").alias("bytes")).count()
    common = lengths.orderBy(F.desc("count"), "bytes").first()
    schema = f"`{id_col}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if common is None:
        return spark.createDataFrame([], schema)
    width = common["bytes"] // 8
    own = different.where(F.octet_length("x") == common["bytes"])
    rows = Rows.of(staged(blocks_of(own), "vector-blocks"), width)
    found = bidiagonal(rows, components)
    k = len(found.values)
    if not k:
        return spark.createDataFrame([], schema)
    error, n, (whole, rest) = off_identity(rows, found), rows.n, rows.centre()
    into, share = found.vectors / np.sqrt(found.values), found.values / found.trace
    total = [int(s) for s in rows.total]

    def deviations(x: np.ndarray) -> pa.Array:
        most = n * (int(np.abs(x).max(initial=0)) + 1) + max(map(abs, total))
        if most * most * width < 2**63:
            return pa.array(((n * x - np.array(total, np.int64)) ** 2).sum(1))
        exact = [sum((n * int(a) - s) ** 2 for a, s in zip(row, total)) for row in x]
        return pa.array([e if e < 2**63 else None for e in exact], pa.int64())

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<i8").reshape(-1, width)
            y = ((x - whole).astype(np.float64) - rest) @ into
            row = np.repeat(np.arange(len(x)), k)
            numbers = [np.tile(np.arange(1, k + 1, dtype=np.int32), len(x)), np.full(len(row), n), None, y.ravel(), np.tile(share, len(x)), np.full(len(row), error)]
            columns = [pa.array(c) if c is not None else deviations(x).take(pa.array(row)) for c in numbers]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), *columns], names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return usable.where(F.octet_length("x") == common["bytes"]).mapInArrow(scan, schema)

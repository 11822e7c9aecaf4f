"""Whitening of embeddings by a bidiagonal qd solver.

Entries become whole numbers first (``floor(scale * c) + offset``), so sums and deviations from the
mean are exact whatever the partitions. Every task folds its rows, centred, block by block into
one upper triangular factor (Householder QR); factors of tasks are folded further, ``FANIN``
to a task, until few are left. The last one has the singular values and right singular vectors
of all centred rows: ``bidiagonal.right_vectors`` finds them on the driver, on a matrix as wide
as the vectors. No covariance is ever formed, so small eigenvalues keep their accuracy.

Rows whose vector is null or holds null or non-finite entries are dropped. Shorter vectors count
as filled up with zeros to the longest. Scaled entries are held within 2^62. Repeated rows count
each time; ids may be null or repeat. A direction in which the rows do not spread (below rounding) is given as
zeros with a share of zero; with fewer dimensions than components there are fewer components; an
empty table gives an empty table. A deviation beyond 38 digits is null. Other columns stay; those named like
an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from driverlens.llm.bidiagonal import right_vectors
from driverlens.llm.common import unused
from driverlens.llm.vectors import finite, matrix
from driverlens.session import materialize

SCALE, OFFSET = 1024, 100_000
LIMIT = 1 << 62
BLOCK = 2048  # rows in one step of the factorisation
FANIN = 16  # tables of tasks folded by one task
FLAT = 1e-12  # singular value, relative to the largest, below which rows do not spread


@dataclass(frozen=True)
class Whitening:
    n: int
    sums: list[int]  # per dimension, of the whole numbers
    most: int  # largest magnitude of a whole number
    values: np.ndarray  # singular values of all centred rows
    directions: np.ndarray  # dimensions x components
    scale: int
    offset: int

    def shares(self) -> list[float]:
        squares = self.values**2
        return [float(x / squares.sum()) if squares.sum() else 0.0 for x in squares[: self.directions.shape[1]]]

    def factors(self) -> np.ndarray:
        """What a centred row is multiplied with."""
        k = self.directions.shape[1]
        spread = np.where(self.values[:k] > FLAT * self.values[:1].max(initial=0.0), self.values[:k], np.inf)
        return self.directions * (np.sqrt(self.n) / spread)


def fixed_point(vector, scale: int = SCALE, offset: int = OFFSET):
    """Whole numbers of a vector's entries."""
    held = lambda c: F.greatest(F.least(F.floor(c * scale), F.lit(LIMIT)), F.lit(-LIMIT))
    return F.transform(vector.cast("array<double>"), lambda c: held(c) + F.lit(offset))


def _deviations(x: np.ndarray, n: int, sums: list[int], most: int) -> np.ndarray:
    """n * x - sums, exactly."""
    if n * most < 1 << 61:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _squares(deviations: np.ndarray, n: int, most: int) -> pa.Array:
    kind = pa.decimal128(38, 0)
    if deviations.shape[1] * (2 * n * most) ** 2 < 1 << 63:
        return pa.array((deviations**2).sum(axis=1)).cast(kind)
    if not deviations.size:
        return pa.array([0] * len(deviations), kind)
    low, high = int(deviations.min()), int(deviations.max())
    if deviations.shape[1] * max(low**2, high**2) < 1 << 63:
        return pa.array((deviations.astype(np.int64) ** 2).sum(axis=1)).cast(kind)
    exact = [sum(int(d) ** 2 for d in row) for row in deviations]
    return pa.array([d if d < 10**38 else None for d in exact], kind)


def fit(vectors: DataFrame, vector: str = "embedding", components: int = 8, scale: int = SCALE, offset: int = OFFSET) -> Whitening:
    """The whitening of all rows. The driver receives one row per dimension and the last factors."""
    x = vectors.where(finite(F.col(vector))).select(fixed_point(F.col(vector), scale, offset).alias("x"))
    totals = (
        x.mapInArrow(_sums, "place INT, total DECIMAL(38,0), n BIGINT, low BIGINT, high BIGINT")
        .groupBy("place")
        .agg(F.sum("total").alias("total"), F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
        .collect()
    )
    by_place = {r.place: r for r in totals}
    n, width = (by_place[-1].n if by_place else 0), len(by_place) - bool(by_place)
    sums = [int(by_place[k].total) + offset * (n - by_place[k].n) for k in range(width)]
    most = max([abs(offset)] + [max(abs(r.low), abs(r.high)) for r in totals if r.place >= 0])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            deviations = _deviations(matrix(batch.column("x"), width, offset), n, sums, most)
            for start in range(0, len(deviations), BLOCK):
                yield (deviations[start : start + BLOCK] / n).astype(np.float64)

    def factor(blocks: Iterator[np.ndarray]) -> np.ndarray | None:
        r = None
        for block in blocks:
            r = np.linalg.qr(block if r is None else np.vstack([r, block]), mode="r")
        return r

    parts = _folded(x, rows, factor, lambda raw: np.frombuffer(raw).reshape(-1, width)) if width else []
    r = factor(iter(parts))
    whole = np.zeros((width, width))
    if r is not None:
        whole[: len(r)] = r
    values, directions = right_vectors(whole, components)
    return Whitening(n, sums, most, values, directions, scale, offset)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per place of a vector, of one task: exact sum, count, least and greatest."""
    width, n = 0, 0
    total, counts, low, high = [], np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        column = batch.column("x")
        flat, sizes = column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())
        longest = int(sizes.max(initial=0))
        if longest > width:
            more, width = longest - width, longest
            total += [0] * more
            counts = np.concatenate([counts, np.zeros(more, np.int64)])
            low, high = np.concatenate([low, np.full(more, LIMIT)]), np.concatenate([high, np.full(more, -LIMIT)])
        n += batch.num_rows
        inside = np.arange(width) < sizes[:, None]
        x = np.zeros(inside.shape, np.int64)
        x[inside] = flat
        upper, lower = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)  # each sum fits for 2^31 rows
        total = [t + (int(u) << 32) + int(v) for t, u, v in zip(total, upper, lower)]
        counts = counts + inside.sum(axis=0)
        low = np.minimum(low, np.where(inside, x, LIMIT).min(axis=0, initial=LIMIT))
        high = np.maximum(high, np.where(inside, x, -LIMIT).max(axis=0, initial=-LIMIT))
    if n:
        columns = [[-1, *range(width)], [0, *total], [n, *counts.tolist()], [0, *low.tolist()], [0, *high.tolist()]]
        types = [pa.int32(), pa.decimal128(38, 0), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["place", "total", "n", "low", "high"])


def _folded(df: DataFrame, items: Callable, fold: Callable, unpack: Callable) -> list[np.ndarray]:
    """What ``fold`` makes of a task's items, folded again ``FANIN`` at a time until one task's worth is left."""

    def run(read):
        def task(batches):
            made = fold(read(batches))
            if made is not None:
                yield pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(made, np.float64).tobytes()], pa.binary())], ["part"])

        return task

    def again(batches):
        for batch in batches:
            for raw in batch.column("part"):
                yield unpack(raw.as_py())

    parts = materialize(df.mapInArrow(run(items), "part BINARY"), "parts")
    while (count := parts.count()) > FANIN:
        parts = materialize(parts.repartition(-(-count // FANIN)).mapInArrow(run(again), "part BINARY"), "parts")
    return [unpack(bytes(r.part)) for r in parts.collect()]


def transform(vectors: DataFrame, model: Whitening, vector: str = "embedding", out: str = "whitened", deviation: str = "deviation") -> DataFrame:
    """Usable rows with their whitened vector and the exact sum of squares of ``n * x - sums``."""
    x = unused(vectors, "whitening_x")
    usable = vectors.where(finite(F.col(vector))).withColumn(x, fixed_point(F.col(vector), model.scale, model.offset))
    fresh = T._parse_datatype_string(f"`{out}` ARRAY<DOUBLE>, `{deviation}` DECIMAL(38,0)")
    kept = [f for f in vectors.schema if f.name not in (out, deviation)]
    names, width, factors = [f.name for f in kept], len(model.sums), model.factors()
    kinds = to_arrow_schema(fresh)

    def run(batches):
        for batch in batches:
            deviations = _deviations(matrix(batch.column(x), width, model.offset), model.n, model.sums, model.most)
            made = (deviations / model.n).astype(np.float64) @ factors
            ends = np.arange(len(made) + 1, dtype=np.int32) * factors.shape[1]
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(made.ravel())).cast(kinds.field(0).type)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), lists, _squares(deviations, model.n, model.most)], [*names, out, deviation])

    return usable.select(*names, x).mapInArrow(run, T.StructType([*kept, *fresh]))


def identity_error(whitened: DataFrame, model: Whitening, column: str = "whitened") -> float:
    """Largest entry of the whitened rows' covariance less the identity, over directions with spread."""
    k = model.directions.shape[1]
    if not k or not model.n:
        return 0.0

    def blocks(batches):
        for batch in batches:
            values = matrix(batch.column(column), k)
            mean = values.mean(axis=0)
            yield np.vstack([np.full(k, len(values)), mean, (values - mean).T @ (values - mean)])

    def merge(parts):
        """Counts, means and centred products of two sets of rows make those of both."""
        held = None
        for part in parts:
            if held is None:
                held = part
                continue
            (m, n), step = (held[0, 0], part[0, 0]), part[1] - held[1]
            products = held[2:] + part[2:] + np.outer(step, step) * (m * n / (m + n))
            held = np.vstack([np.full(k, m + n), held[1] + step * (n / (m + n)), products])
        return held

    parts = _folded(whitened.select(column), blocks, merge, lambda raw: np.frombuffer(raw).reshape(-1, k))
    whole = merge(parts)
    spread = model.values[:k] > FLAT * model.values.max(initial=0.0)
    return float(np.abs(whole[2:] / whole[0, 0] - np.diag(spread.astype(float))).max())

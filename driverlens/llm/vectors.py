"""What the operators on embeddings share: usable rows, matrices of Arrow batches, bounded samples."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driverlens.session import materialize


def finite(vector: Column) -> Column:
    """Whether a vector is there and all of its entries are finite numbers."""
    number = vector.cast("array<double>")
    return F.coalesce(F.forall(number, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def matrix(column: pa.Array, width: int, fill=0) -> np.ndarray:
    """One row per vector; shorter vectors are filled up to the width."""
    flat, sizes = column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    full = np.full((len(sizes), width), fill, flat.dtype)
    full[np.arange(width) < sizes[:, None]] = flat
    return full


def width_of(rows: DataFrame, vector: str) -> int:
    return rows.agg(F.max(F.size(vector))).first()[0] or 0


def hashed_sample(rows: DataFrame, by: str, limit: int, total: int) -> DataFrame:
    """At most ``limit`` of ``total`` rows, those whose ids have the smallest hashes.

    A threshold on the hash thins the rows where they are read, so no task gets more than a few times the sample.
    """
    share = min(1.0, 2 * limit / max(total, 1))
    place = F.xxhash64(by).bitwiseAND(F.lit((1 << 62) - 1))
    return rows.where(place <= F.lit(int(share * ((1 << 62) - 1)))).orderBy(place, by).limit(limit)


class Best:
    """The ``k`` best rows of every query so far: highest score first, ties to the smaller id."""

    def __init__(self, queries: int, k: int, kind=np.float64):
        self.k, self.none = k, np.array(-np.inf if kind == np.float64 else -(2**63 - 1), kind)
        self.scores, self.ids = np.full((queries, k), self.none), np.full((queries, k), np.iinfo(np.int64).max)

    def add(self, at: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Rows with the number of their query; those that are not among its best are forgotten."""
        if not len(at):
            return
        touched, where = np.unique(at, return_inverse=True)
        groups = np.concatenate([where, np.repeat(np.arange(len(touched)), self.k)])
        scores = np.concatenate([scores, self.scores[touched].ravel()])
        ids = np.concatenate([ids, self.ids[touched].ravel()])
        order = np.lexsort((ids, -scores, groups))
        groups = groups[order]
        place = np.arange(len(order)) - np.searchsorted(groups, np.arange(len(touched)))[groups]
        order = order[place < self.k]
        self.scores[touched], self.ids[touched] = scores[order].reshape(-1, self.k), ids[order].reshape(-1, self.k)

    def last(self) -> np.ndarray:
        """Score of every query's ``k``-th row, the lowest number while there are fewer."""
        return self.scores[:, -1]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at, place = np.nonzero(self.scores > self.none)
        return at, self.scores[at, place], self.ids[at, place]


def chunks(queries: DataFrame, by: str, size: int) -> Iterator[pa.Table]:
    """The queries, about ``size`` at a time: what of them is sent to all tasks does not grow with the table."""
    stored = materialize(queries, "queries")
    count = -(-stored.count() // size)
    for number in range(count):
        yield stored.where(F.pmod(F.xxhash64(by), F.lit(count)) == number).toArrow()


def first_per_query(found: list[DataFrame], query: list[str], k: int, schema: str, spark) -> DataFrame:
    """Rows that tasks found (``score``, ``id``), cut down to the best ``k`` of each query, with their ``rank``."""
    rows = found[0] if found else spark.createDataFrame([], schema)
    for more in found[1:]:
        rows = rows.unionByName(more)
    place = F.row_number().over(Window.partitionBy(*query).orderBy(F.desc("score"), "id"))
    return rows.withColumn("rank", place).where(F.col("rank") <= k)

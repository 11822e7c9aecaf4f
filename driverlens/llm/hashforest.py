"""Approximate nearest neighbours by largest inner product, over a forest of hash prefixes.

Vectors are lifted onto a sphere (one more entry makes up the longest length), so the angle to a
query, which gets a zero there, orders rows as the inner product does. A tree hashes a row to a
long string of bits, the sides of random hyperplanes; the forest of a block of rows is one
sorted array of strings per tree. A query descends to the longest prefixes that it shares with a row in any tree and
ascends in all trees at once, taking in the rows under ever shorter prefixes, until a row as
near as its ``k``-th best would be missed by every tree with a chance of ``miss`` at most:
``(1 - p**level)**trees <= miss``, where ``p`` follows from the angle. So nothing caps the
candidates: far neighbours make a query ascend further, to the whole block if need be. Candidates
are scored on the original vectors.

Blocks are as rows come to a task; every block is searched, and a task carries a query's best
from block to block. Queries are sent to all tasks ``CHUNK`` at a time. How far the first blocks ascend follows from a hashed sample
of rows: its ``2 k``-th score, so that ``k`` rows are found even where some are missed.

Rows whose id or vector is null, whose vector is zero or holds null or non-finite entries take no
part. Shorter vectors count as filled up with zeros. A row is known by its id: repeated rows are
candidates each, a repeated query is asked once (with its smallest vector), and no row of a
query's id answers it. Equal scores go to the smaller id. An empty table gives an empty table;
other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driverlens.llm.vectors import Best, chunks, finite, first_per_query, hashed_sample, matrix, width_of
from driverlens.session import materialize

TREES, BITS = 64, 24
MISS = 0.08
STEP = 3  # levels taken at once on the way up
CHUNK = 8192  # queries sent to all tasks at once
BLOCK = 8192  # rows in a forest
GROUP = 128  # queries searched at once
SAMPLE = 2048
SEED = 13
SCHEMA = "query_id BIGINT, id BIGINT, score DOUBLE"


def planes(width: int, trees: int, bits: int) -> np.ndarray:
    """Normals of random hyperplanes, by tree, for vectors with one entry more than ``width``."""
    return np.random.default_rng(SEED).normal(size=(trees, width + 1, bits))


def strings(lifted: np.ndarray, normals: np.ndarray) -> np.ndarray:
    """Hash strings (trees x rows), first bit highest."""
    weights = 2 ** np.arange(normals.shape[2] - 1, -1, -1, dtype=np.int64)
    return np.stack([((lifted @ n) > 0) @ weights for n in normals])


def level_for(cosine: np.ndarray, trees: int, bits: int, miss: float) -> np.ndarray:
    """The longest prefix at which a row of that angle is missed by all trees with a chance of ``miss`` at most."""
    p = np.clip(1 - np.arccos(np.clip(cosine, -1, 1)) / np.pi, 1e-12, 1 - 1e-12)
    return np.clip(np.floor(np.log1p(-(miss ** (1 / trees))) / np.log(p)), 0, bits).astype(np.int64)


class Forest:
    """Sorted hash strings of a block of rows, one array per tree."""

    def __init__(self, hashed: np.ndarray, bits: int):
        self.bits, self.rows = bits, hashed.shape[1]
        self.order = np.argsort(hashed, axis=1, kind="stable")
        self.sorted = np.take_along_axis(hashed, self.order, axis=1)

    def deepest(self, asked: np.ndarray) -> np.ndarray:
        """Length of the longest prefix that each query (trees x queries) shares with any row in any tree."""
        best = np.zeros(asked.shape[1], np.int64)
        for strings_, mine in zip(self.sorted, asked):
            at = np.searchsorted(strings_, mine)
            for neighbour in (np.maximum(at - 1, 0), np.minimum(at, self.rows - 1)):
                apart = strings_[neighbour] ^ mine
                best = np.maximum(best, self.bits - np.ceil(np.log2(apart + 1)).astype(np.int64))
        return best

    def under(self, asked: np.ndarray, level: np.ndarray, active: np.ndarray, mask: np.ndarray) -> None:
        """Mark the rows that share a prefix of ``level`` bits with an active query in any tree."""
        free = (1 << (self.bits - level)) - 1
        for strings_, order, mine in zip(self.sorted, self.order, asked):
            low = np.searchsorted(strings_, mine & ~free)
            high = np.searchsorted(strings_, mine | free, side="right")
            for q in active[low[active] < high[active]]:
                mask[q, order[low[q] : high[q]]] = True


def _lift(vectors: np.ndarray, longest: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(longest**2 - (vectors**2).sum(axis=1), 0.0))
    return np.hstack([vectors, rest[:, None]])


def _blocks(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.Table]:
    held = []
    for batch in batches:
        held.append(batch.select(names))
        if sum(b.num_rows for b in held) >= BLOCK:
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
    if held and sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held).combine_chunks()


def search_block(ids: np.ndarray, vectors: np.ndarray, forest: Forest, q: dict, best: Best, setting: dict) -> None:
    """Take the rows of one block into the best of every query."""
    trees, bits, miss = setting["trees"], setting["bits"], setting["miss"]
    for start in range(0, len(q["ids"]), GROUP):
        part = slice(start, start + GROUP)
        asked, mine, scale, own = q["strings"][:, part], q["vectors"][part], q["scale"][part], q["ids"][part]
        scores = mine @ vectors.T
        slack = 1e-12 * scale
        mask, taken = np.zeros(scores.shape, bool), np.zeros(scores.shape, bool)

        def need():
            reached = np.maximum(q["start"][part], best.last()[part])
            return reached, np.where(np.isfinite(reached), level_for(reached / scale, trees, bits, miss), 0)

        reached, wanted = need()
        level = np.minimum(forest.deepest(asked), wanted + STEP)
        active = np.arange(len(mine))
        while len(active):
            forest.under(asked, level, active, mask)
            # Products of matrices differ in the last digit from place to place: they only choose
            # what is scored again row by row.
            at, row = np.nonzero(mask & ~taken & (scores >= (reached - slack)[:, None]) & (ids != own[:, None]))
            best.add(at + start, (vectors[row] * mine[at]).sum(axis=1), ids[row])
            taken |= mask
            reached, wanted = need()
            active = active[level[active] > wanted[active]]
            level = np.where(level > wanted, np.maximum(wanted, level - STEP), level)


def nearest(
    rows: DataFrame, queries: Column, id: str = "vec_id", vector: str = "embedding", k: int = 20,
    trees: int = TREES, bits: int = BITS, miss: float = MISS, chunk: int = CHUNK,
) -> DataFrame:
    """``query_id, rank, id, score`` of the ``k`` nearest rows found for every row that meets ``queries``."""
    spark = rows.sparkSession
    usable = rows.where(F.col(id).isNotNull() & finite(F.col(vector))).select(
        F.col(id).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v"), queries.alias("asked")
    )
    usable = usable.where(F.exists("v", lambda x: x != 0))
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda total, x: total + x * x))
    total, longest = usable.agg(F.count("*"), F.max(length)).first()
    width = width_of(usable, "v")
    normals = planes(width, trees, bits)
    setting = {"trees": trees, "bits": bits, "miss": miss}
    sample = hashed_sample(usable.select("id", "v"), "id", SAMPLE, total).toArrow().combine_chunks()  # at most SAMPLE rows
    known = spark.sparkContext.broadcast((sample.column("id").to_numpy(), _rows_of(sample.column("v"), width)))
    asked = usable.where("asked").groupBy("id").agg(F.min("v").alias("v"))

    def start(batches):
        ids, vectors = known.value
        for batch in batches:
            mine, own = matrix(batch.column("v"), width), batch.column("id").to_numpy()
            low = np.full(len(mine), -np.inf)
            for at in range(0, len(mine), GROUP):
                scores = np.where(ids == own[at : at + GROUP, None], -np.inf, mine[at : at + GROUP] @ vectors.T)
                if scores.shape[1] >= 2 * k:
                    low[at : at + GROUP] = np.partition(scores, -2 * k, axis=1)[:, -2 * k]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(low)], [*batch.schema.names, "start"])

    found = []
    for part in chunks(asked.mapInArrow(start, "id BIGINT, v ARRAY<DOUBLE>, start DOUBLE"), "id", chunk):
        part = part.combine_chunks()
        own, mine = part.column("id").to_numpy(), _rows_of(part.column("v"), width)
        scale = np.sqrt((mine**2).sum(axis=1)) * longest
        lifted = np.hstack([mine, np.zeros((len(mine), 1))])
        sent = spark.sparkContext.broadcast(
            {"ids": own, "vectors": mine, "scale": scale, "start": part.column("start").to_numpy(), "strings": strings(lifted, normals)}
        )

        def run(batches, sent=sent):
            q = sent.value
            best = Best(len(q["ids"]), k)
            for block in _blocks(batches, ["id", "v"]):
                ids, vectors = block.column("id").to_numpy(), _rows_of(block.column("v"), width)
                forest = Forest(strings(_lift(vectors, longest), normals), bits)
                search_block(ids, vectors, forest, q, best, setting)
            at, scores, ids = best.rows()
            yield pa.RecordBatch.from_arrays([pa.array(q["ids"][at]), pa.array(ids), pa.array(scores)], ["query_id", "id", "score"])

        found.append(materialize(usable.select("id", "v").mapInArrow(run, SCHEMA), "found"))
        sent.unpersist()
    return first_per_query(found, ["query_id"], k, SCHEMA, spark).select("query_id", "rank", "id", "score")


def _rows_of(column: pa.ChunkedArray, width: int) -> np.ndarray:
    if not len(column):
        return np.zeros((0, width))
    return matrix(column.combine_chunks(), width).astype(np.float64)

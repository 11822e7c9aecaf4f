"""Hard negatives by exact search in a multiway tree of hyperplanes with stored distance ranges.

A row's score for an anchor is the inner product of whole-number vectors. Vectors are lifted onto
a sphere (one more entry makes up the longest length), so a range of scores is a range of distances from
the anchor, which gets a zero there. A node of the tree has up to ``FANOUT`` split points, far apart
from each other, and gives a row to the nearest one: siblings are parted by the hyperplanes
between split points. For every split point and every sibling it stores the least and greatest distance from
the point to the sibling's rows. A search looks for distances within a ring around the anchor, from
its window of scores and the ``k``-th best score so far; by the triangle inequality a sibling whose
stored range meets no point of that ring, seen from any split point, has nothing to give. The
rows of leaves that are left are compared one by one, so results are exact.

The tree is cut from a hashed sample of rows (``SAMPLE``); every row is then put into its leaf, and
ranges are those of all rows. Rows are range-partitioned by leaf and a hash, so a leaf of any size is
spread over tasks. Queries are sent to all tasks ``CHUNK`` at a time; a task carries a
query's best from leaf to leaf. ``k``-th scores start from those of the sample.

Rows whose id, label or vector is null, or whose vector holds a null or non-finite entry, take no
part. Shorter vectors count as filled up with zeros. Entries are held within the bound beyond which a score would not
fit 64 bits. A row is known by its id: repeated rows are candidates each, a repeated anchor is
asked once (with its smallest label and vector), and no row of an anchor's id answers it. Ties go to the smaller id. A
negative first score leaves no window. An empty table gives an empty table; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driverlens.llm.vectors import Best, chunks, finite, first_per_query, hashed_sample, matrix, width_of
from driverlens.session import materialize

FANOUT = 16
LEAF = 256  # rows of a leaf, while the sample allows
SAMPLE = 8192
FEWEST = 8  # sampled rows below which a node isn't cut
CHUNK = 8192  # queries sent to all tasks at once
GROUP = 512  # queries compared at once
SLACK = 1e-9  # of a squared distance: room for rounding
INDEX = "id BIGINT, label BIGINT, v ARRAY<BIGINT>"
FOUND = "query BIGINT, id BIGINT, score BIGINT"


@dataclass
class Node:
    """Split points and what lies below each: a node's or a leaf's number."""

    points: np.ndarray
    below: list  # Node or leaf number
    low: np.ndarray = field(default=None)  # [point, sibling]: least distance
    high: np.ndarray = field(default=None)
    number: int = 0


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squares = (a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1) - 2 * (a @ b.T)
    return np.sqrt(np.maximum(squares, 0.0))


def lift(vectors: np.ndarray, longest: float) -> np.ndarray:
    vectors = vectors.astype(np.float64)
    return np.hstack([vectors, np.sqrt(np.maximum(longest - (vectors**2).sum(axis=1), 0.0))[:, None]])


class Tree:
    """Cut from sampled rows; ``longest`` is the greatest squared length of any row."""

    def __init__(self, sample: np.ndarray, longest: float, rows_per_sample: float, fanout: int = FANOUT, leaf: int = LEAF):
        self.longest, self.nodes, self.paths = longest, [], []
        self.fanout, self.most = fanout, max(FEWEST, leaf / max(rows_per_sample, 1.0))
        self.root = self._cut(lift(sample, longest), [])

    def _cut(self, points: np.ndarray, path: list):
        chosen = [0] if len(points) > self.most else []
        near = _distances(points, points[:1])[:, 0] if chosen else None
        while chosen and len(chosen) < self.fanout and near.max() > SLACK * np.sqrt(self.longest):
            chosen.append(int(near.argmax()))
            near = np.minimum(near, _distances(points, points[chosen[-1:]])[:, 0])
        if len(chosen) < 2:
            self.paths.append(path)
            return len(self.paths) - 1
        node = Node(points[chosen], [], number=len(self.nodes))
        self.nodes.append(node)
        mine = _distances(points, node.points).argmin(axis=1)
        node.below = [self._cut(points[mine == j], [*path, (node.number, j)]) for j in range(len(chosen))]
        return node

    def place(self, lifted: np.ndarray, seen=None) -> np.ndarray:
        """Leaf of every row; ``seen(node, sibling, distances)`` gets the distances to a node's split points."""
        leaves = np.zeros(len(lifted), np.int64)

        def descend(here, rows):
            if isinstance(here, int):
                leaves[rows] = here
                return
            apart = _distances(lifted[rows], here.points)
            mine = apart.argmin(axis=1)
            for j in np.unique(mine):
                if seen:
                    seen(here, int(j), apart[mine == j])
                descend(here.below[j], rows[mine == j])

        descend(self.root, np.arange(len(lifted)))
        return leaves


class _Search:
    """One task's search: queries, their best rows, and what has been found out about nodes."""

    def __init__(self, tree: Tree, q: dict, k: int, same: bool, whole: bool):
        self.tree, self.q, self.same, self.whole = tree, q, same, whole
        self.best = Best(len(q["query"]), k, np.int64)
        vectors = q["v"].astype(np.float64)
        self.lengths = (vectors**2).sum(axis=1)
        self.lifted = np.hstack([vectors, np.zeros((len(vectors), 1))])
        self.apart = {}

    def floor(self) -> np.ndarray:
        return np.maximum(np.maximum(self.q["low"], self.q["start"]), self.best.last())

    def alive(self, leaf: int) -> np.ndarray:
        """Queries whose ring meets the stored ranges on the way down to the leaf."""
        room = SLACK * (self.lengths + self.tree.longest)
        around = self.lengths + self.tree.longest
        outer = np.sqrt(np.maximum(around - 2 * self.floor().astype(np.float64) + room, 0.0))
        inner = np.sqrt(np.maximum(around - 2 * self.q["high"].astype(np.float64) - room, 0.0))
        left = np.arange(len(self.lifted))
        for number, j in self.tree.paths[leaf]:
            node = self.tree.nodes[number]
            if number not in self.apart:
                self.apart[number] = _distances(self.lifted, node.points)
            apart, low, high = self.apart[number][left], node.low[:, j], node.high[:, j]
            r, near = outer[left, None] * (1 + SLACK), inner[left, None] * (1 - SLACK)
            out = (high < apart - r) | (low > apart + r) | (high + apart < near)
            left = left[~out.any(axis=1)]
        return left

    def compare(self, leaf: int, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        alive, floor = self.alive(leaf), self.floor()
        for start in range(0, len(alive), GROUP):
            mine = alive[start : start + GROUP]
            scores = inner_products(self.q["v"][mine], vectors, self.whole)
            hit = (scores >= floor[mine, None]) & (scores <= self.q["high"][mine, None]) & (ids != self.q["own"][mine, None])
            hit &= (labels == self.q["label"][mine, None]) == self.same
            at, row = np.nonzero(hit)
            self.best.add(mine[at], scores[at, row], ids[row])


def inner_products(a: np.ndarray, b: np.ndarray, whole: bool) -> np.ndarray:
    """Exact; ``whole``: all sums are below 2^53, so double precision holds them."""
    return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64) if whole else a @ b.T


def _rows(table: pa.Table | pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    table = table.combine_chunks() if isinstance(table, pa.Table) else table
    column = table.column("v")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    vectors = matrix(column, width).astype(np.int64) if len(column) else np.zeros((0, width), np.int64)
    return table.column("id").to_numpy(), table.column("label").to_numpy(), vectors


class Index:
    """Rows (id, label, whole-number vector) in the leaves of a tree with ranges over all of them."""

    def __init__(self, rows: DataFrame, id: str, label: str, vector: str, sample: int = SAMPLE, fanout: int = FANOUT, leaf: int = LEAF):
        self.spark = spark = rows.sparkSession
        usable = rows.where(F.col(id).isNotNull() & F.col(label).isNotNull() & finite(F.col(vector))).select(
            F.col(id).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"), F.col(vector).cast("array<bigint>").alias("v")
        )
        self.width = width = width_of(usable, "v")
        bound = int(np.sqrt(float(2**63 - 1) / max(width, 1))) - 1
        usable = usable.withColumn("v", F.transform("v", lambda x: F.greatest(F.least(x, F.lit(bound)), F.lit(-bound))))
        length = F.aggregate("v", F.lit(0.0), lambda total, x: total + x.cast("double") * x)
        self.total, longest = usable.agg(F.count("*"), F.max(length)).first()
        self.whole = (longest or 0.0) < 2.0**52
        drawn = hashed_sample(usable, "id", sample, self.total).toArrow()  # at most ``sample`` rows
        self.sample = _rows(drawn, width)
        tree = Tree(self.sample[2], longest or 0.0, self.total / max(len(drawn), 1), fanout, leaf)
        placed = self._placed(usable, tree)
        spread = F.xxhash64("id", F.monotonically_increasing_id())
        self.rows = materialize(placed.repartitionByRange("leaf", spread).sortWithinPartitions("leaf"), "leaves")
        self.tree = self._ranged(tree)
        self.sent = spark.sparkContext.broadcast(self.sample)

    def _placed(self, usable: DataFrame, tree: Tree) -> DataFrame:
        width = self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                leaves = tree.place(lift(_rows(batch, width)[2], tree.longest))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaves)], [*batch.schema.names, "leaf"])

        return usable.mapInArrow(run, INDEX + ", leaf BIGINT")

    def _ranged(self, tree: Tree) -> Tree:
        """Fill in each node's ranges: least and greatest distance of all rows, at most fanout^2 a node."""
        width = self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            low, high = {}, {}

            def seen(node, j, apart):
                key = (node.number, j)
                low[key] = np.minimum(low.get(key, np.inf), apart.min(axis=0))
                high[key] = np.maximum(high.get(key, -np.inf), apart.max(axis=0))

            for batch in batches:
                tree.place(lift(_rows(batch, width)[2], tree.longest), seen)
            rows = [(n, j, i, low[n, j][i], high[n, j][i]) for n, j in low for i in range(len(low[n, j]))]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["node", "sibling", "point", "low", "high"])

        schema = "node BIGINT, sibling BIGINT, point BIGINT, low DOUBLE, high DOUBLE"
        ranges = self.rows.select("id", "label", "v").mapInArrow(run, schema).groupBy("node", "sibling", "point").agg(F.min("low").alias("low"), F.max("high").alias("high"))
        for node in tree.nodes:
            shape = (len(node.points), len(node.points))
            node.low, node.high = np.full(shape, np.inf), np.full(shape, -np.inf)
        for r in ranges.collect():
            tree.nodes[r.node].low[r.point, r.sibling], tree.nodes[r.node].high[r.point, r.sibling] = r.low, r.high
        return tree

    def search(self, queries: DataFrame, k: int, same: bool, chunk: int = CHUNK) -> DataFrame:
        """``query, rank, id, score`` of the first ``k`` rows of the same label (or of other labels).

        ``queries``: query (unique), own (the anchor's id), label, v, low, high (scores allowed).
        """
        spark, width, whole, tree, drawn = self.spark, self.width, self.whole, self.tree, self.sent
        names = ["query", "own", "label", "low", "high"]

        def start(batches):
            ids, labels, vectors = drawn.value
            for batch in batches:
                own, label, low, high = (batch.column(n).to_numpy()[:, None] for n in ("own", "label", "low", "high"))
                mine, found = matrix(batch.column("v"), width).astype(np.int64), np.full(batch.num_rows, -(2**63 - 1))
                for at in range(0, len(mine), GROUP):
                    part = slice(at, at + GROUP)
                    scores = inner_products(mine[part], vectors, whole)
                    fits = ((labels == label[part]) == same) & (ids != own[part]) & (scores >= low[part]) & (scores <= high[part])
                    if len(ids) >= k:
                        found[part] = np.partition(np.where(fits, scores, -(2**63 - 1)), -k, axis=1)[:, -k]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], [*batch.schema.names, "start"])

        asked = queries.select(*names, "v").mapInArrow(start, "query BIGINT, own BIGINT, label BIGINT, low BIGINT, high BIGINT, v ARRAY<BIGINT>, start BIGINT")
        found = []
        for part in chunks(asked, "query", chunk):
            part = part.combine_chunks()
            q = {n: part.column(n).to_numpy() for n in [*names, "start"]}
            q["v"] = matrix(part.column("v").combine_chunks(), width).astype(np.int64) if len(part) else np.zeros((0, width), np.int64)
            sent = spark.sparkContext.broadcast(q)

            def run(batches, sent=sent):
                search = _Search(tree, sent.value, k, same, whole)
                for batch in batches:
                    ids, labels, vectors = _rows(batch, width)
                    leaves = batch.column("leaf").to_numpy()
                    edges = [0, *(np.flatnonzero(np.diff(leaves)) + 1), len(leaves)]
                    for a, b in zip(edges, edges[1:]):
                        if b > a:
                            search.compare(int(leaves[a]), ids[a:b], labels[a:b], vectors[a:b])
                at, scores, ids = search.best.rows()
                yield pa.RecordBatch.from_arrays([pa.array(search.q["query"][at]), pa.array(ids), pa.array(scores)], ["query", "id", "score"])

            found.append(materialize(self.rows.mapInArrow(run, FOUND), "found"))
            sent.unpersist()
        return first_per_query(found, ["query"], k, FOUND, spark).select("query", "rank", "id", "score")


def mine(
    rows: DataFrame, anchors: Column, id: str = "vec_id", label: str = "label", vector: str = "v",
    positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, index: Index | None = None,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the rows that meet ``anchors``.

    ``vector`` holds whole numbers. A positive's window is ``low`` to ``high`` per cent of its score.
    """
    index = index or Index(rows, id, label, vector)
    named = rows.where(anchors & F.col(id).isNotNull() & F.col(label).isNotNull() & finite(F.col(vector)))
    asked = named.select(F.col(id).cast("bigint").alias("own"), F.struct(F.col(label).cast("bigint").alias("label"), F.col(vector).cast("array<bigint>").alias("v")).alias("row"))
    asked = materialize(asked.groupBy("own").agg(F.min("row").alias("row")).select("own", "row.*"), "anchors")
    lowest, highest = F.lit(-(2**63 - 1)), F.lit(2**63 - 1)
    first = index.search(asked.select(F.col("own").alias("query"), "own", "label", lowest.alias("low"), highest.alias("high"), "v"), positives, True)
    pairs = first.select(F.col("query").alias("own"), "rank", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    score = F.col("positive_score").cast("decimal(20,0)")
    pairs = pairs.where("positive_score >= 0").withColumns(
        {
            "low": F.ceil(score * low / 100).cast("bigint"),
            "high": F.floor(score * high / 100).cast("bigint"),
            "query": F.col("own") * positives + F.col("rank") - 1,
        }
    )
    pairs = materialize(pairs, "positives")
    found = index.search(pairs.join(asked, "own").select("query", "own", "label", "low", "high", "v"), negatives, False)
    return found.join(pairs.select("query", "own", "positive_id", "positive_score"), "query").select(
        F.col("own").alias("anchor_id"), "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )

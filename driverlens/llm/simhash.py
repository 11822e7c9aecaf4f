"""SimHash near-duplicates over a Gray-order hierarchical index.

A text's 64-bit fingerprint has a bit set where more than half of its shingle hashes have it. Two
texts are linked if their fingerprints differ in at most ``distance`` bits; a component is what
links join.

Equal fingerprints are one entry, so copies cost nothing beyond the first. The distinct entries
are range-partitioned by Gray rank, where neighbours differ in few bits, and cut into leaves of
``LEAF`` consecutive entries. A node keeps the bits that all of its entries share (mask and
pattern); ``FANOUT`` consecutive nodes make a node of the next level, up to a root level of at
most ``ROOTS`` nodes. Pairs of nodes are followed downwards, and a pair is dropped with all that
is below it as soon as the bits that the two patterns fix differ too often. Surviving pairs of
leaves are compared block by block in the same way, and each comparison returns a spanning forest of its
links instead of all pairs. Forests are joined into components by table operations that cut
their lineage in the shared folder.

Null and empty texts have no words and the fingerprint zero, which links like any other. Fewer
words than a shingle make one shingle. Repeated rows stay, one result row each; an empty table
gives an empty table. Input columns named like an output column are replaced.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driverlens.llm.common import unused, with_columns
from driverlens.llm.components import components
from driverlens.session import materialize

LEAF = 1024  # entries in a leaf
BLOCK = 32  # entries in a leaf's block
FANOUT = 16
ROOTS = 64
SEED = 42
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
HASHED = 1 << 14  # shingles turned into bits at a time
ENTRY = np.dtype("<u8")


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The 64-bit fingerprint, as a signed number."""
    words = (text or "").encode("utf-8").translate(LOWER).split()  # splits at ASCII white space only
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return struct.unpack("<q", struct.pack("<Q", digest(b" ".join(words), SEED)))[0]
    total = len(words) - shingle + 1
    votes = np.zeros(64, np.int64)
    for start in range(0, total, HASHED):
        part = words[start : start + HASHED + shingle - 1]
        grams = zip(*(part[k : len(part) - shingle + 1 + k] for k in range(shingle)))
        hashes = np.array([digest(gram, SEED) for gram in map(b" ".join, grams)], "<u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(votes * 2 > total, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", out: str = "bits", shingle: int = 3, drop: tuple[str, ...] = ()) -> DataFrame:
    """Add each text's fingerprint as a signed 64-bit number."""
    return with_columns(docs, [text], f"`{out}` BIGINT", lambda: lambda value: (fingerprint(value, shingle),), drop)


def gray_rank(bits):
    """Place of a 64-bit word in Gray order: every bit xor all bits above it."""
    rank = bits
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    return rank


def _leaves(entries: DataFrame) -> DataFrame:
    """Cut range-partitioned entries into leaves: partition, place in it, common bits, packed entries."""
    unsigned = gray_rank(F.col("bits")).bitwiseXOR(F.lit(-(1 << 63)))  # unsigned order as signed order
    placed = entries.withColumn("rank", unsigned).repartitionByRange("rank").sortWithinPartitions("rank").select("bits")

    def cut(batches):
        from pyspark import TaskContext

        part, seq, held = TaskContext.get().partitionId(), 0, np.empty(0, ENTRY)

        def leaf(bits):
            varying = np.bitwise_or.reduce(bits) & ~np.bitwise_and.reduce(bits)
            mask = ~varying
            return [part, seq, int(mask.view("<i8")), int((bits[0] & mask).view("<i8")), bits.tobytes()]

        names = ["part", "seq", "mask", "pattern", "entries"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array([r], t) for r, t in zip(rows, types)], names)

        for got in batches:
            held = np.concatenate([held, got.column("bits").to_numpy(zero_copy_only=False).view(ENTRY)])
            while len(held) >= LEAF:
                yield batch(leaf(held[:LEAF]))
                held, seq = held[LEAF:], seq + 1
        if len(held):
            yield batch(leaf(held))

    return placed.mapInArrow(cut, "part BIGINT, seq BIGINT, mask BIGINT, pattern BIGINT, entries BINARY")


def _numbered(leaves: DataFrame) -> DataFrame:
    """Number the leaves in Gray order: place in the partition plus all leaves of earlier partitions."""
    counts = leaves.groupBy("part").agg(F.count("*").alias("n")).collect()  # one row per partition
    before, start = {}, 0
    for part, n in sorted(counts):
        before[part] = start
        start += n
    offsets = leaves.sparkSession.createDataFrame(list(before.items()), "part BIGINT, start BIGINT")
    return leaves.join(offsets, "part").select((F.col("start") + F.col("seq")).alias("node"), "mask", "pattern", "entries")


def _apart(a: str, b: str):
    """Bits in which the entries of two nodes must differ."""
    both = F.col(f"{a}.mask").bitwiseAND(F.col(f"{b}.mask"))
    return F.bit_count(F.col(f"{a}.pattern").bitwiseXOR(F.col(f"{b}.pattern")).bitwiseAND(both))


def _leaf_pairs(leaves: DataFrame, count: int, distance: int) -> DataFrame:
    """Pairs of leaves (a <= b) whose entries may link, found from the root level down."""
    levels = [leaves.select("node", "mask", "pattern")]
    while count > ROOTS:
        count = -(-count // FANOUT)
        every = F.expr("bit_and(pattern)"), F.expr("bit_or(pattern)"), F.expr("bit_and(mask)")
        shared = every[2].bitwiseAND(F.bitwise_not(every[0].bitwiseXOR(every[1])))
        upper = levels[-1].groupBy(F.floor(F.col("node") / FANOUT).alias("node")).agg(shared.alias("mask"), every[0].alias("low"))
        levels.append(materialize(upper.select("node", "mask", F.col("low").bitwiseAND(F.col("mask")).alias("pattern")), "nodes"))
    roots = levels.pop()
    here = F.broadcast(roots)  # at most ROOTS nodes
    pairs = roots.alias("l").join(here.alias("r"), (F.col("l.node") <= F.col("r.node")) & (_apart("l", "r") <= distance))
    pairs = pairs.select(F.col("l.node").alias("a"), F.col("r.node").alias("b"))
    while levels:
        below = levels.pop()
        left = below.select(F.floor(F.col("node") / FANOUT).alias("a"), F.struct("node", "mask", "pattern").alias("l"))
        right = below.select(F.floor(F.col("node") / FANOUT).alias("b"), F.struct("node", "mask", "pattern").alias("r"))
        held = (F.col("l.node") <= F.col("r.node")) & (_apart("l", "r") <= distance)
        pairs = materialize(pairs.join(left, "a").join(right, "b").where(held).select(F.col("l.node").alias("a"), F.col("r.node").alias("b")), "pairs")
    return pairs


def _linked(left: np.ndarray, right: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of two sorted leaves within the distance; blocks that can't link are skipped."""

    def blocks(bits):
        starts = np.arange(0, len(bits), BLOCK)
        low, high = np.bitwise_and.reduceat(bits, starts), np.bitwise_or.reduceat(bits, starts)
        mask = ~(low ^ high)
        return starts, mask, low & mask

    (at_a, mask_a, pattern_a), (at_b, mask_b, pattern_b) = blocks(left), blocks(right)
    apart = np.bitwise_count((pattern_a[:, None] ^ pattern_b) & mask_a[:, None] & mask_b)
    rows, cols = [], []
    for i, j in zip(*np.nonzero(apart <= distance)):
        a, b = at_a[i], at_b[j]
        r, c = np.nonzero(np.bitwise_count(left[a : a + BLOCK, None] ^ right[b : b + BLOCK]) <= distance)
        rows.append(r + a)
        cols.append(c + b)
    empty = [np.empty(0, np.int64)]
    return np.concatenate(rows or empty), np.concatenate(cols or empty)


def _forest(bits: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links as stars around the smallest entry of each connected part."""
    label = bits.copy()
    while True:
        low = np.minimum(label[x], label[y])
        fresh = label.copy()
        np.minimum.at(fresh, x, low)
        np.minimum.at(fresh, y, low)
        if (fresh == label).all():
            break
        label = fresh
    moved = label != bits
    return bits[moved], label[moved]


def links(entries: DataFrame, distance: int = 2) -> DataFrame:
    """Links (u, v) that join all ``entries`` (bits, unique) within the distance."""
    leaves = materialize(_leaves(entries), "leaves")
    numbered = _numbered(leaves)
    pairs = _leaf_pairs(numbered, leaves.count(), distance)
    right = pairs.join(numbered.select(F.col("node").alias("b"), F.col("entries").alias("right")), "b")
    both = right.join(numbered.select(F.col("node").alias("a"), F.col("entries").alias("left")), "a").select("a", "b", "left", "right")

    def compare(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                a, b = batch.column("a")[row].as_py(), batch.column("b")[row].as_py()
                left = np.frombuffer(batch.column("left")[row].as_py(), ENTRY)
                right = np.frombuffer(batch.column("right")[row].as_py(), ENTRY)
                x, y = _linked(left, right, distance)
                if a == b:
                    u, v = _forest(left, x, y)
                else:
                    u, v = _forest(np.concatenate([left, right]), x, y + len(left))
                yield pa.RecordBatch.from_arrays([pa.array(u.view("<i8")), pa.array(v.view("<i8"))], ["u", "v"])

    return both.mapInArrow(compare, "u BIGINT, v BIGINT")


def _grouped(found: DataFrame, distance: int) -> DataFrame:
    """(bits, component): each distinct fingerprint and the one that stands for its component."""
    entries = materialize(found.groupBy("bits").agg(F.count("*").alias("n")), "entries")
    joined = components(links(entries.select("bits"), distance))
    return entries.join(joined, entries["bits"] == joined["node"], "left").select("bits", F.coalesce("component", "bits").alias("component"))


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", distance: int = 2, shingle: int = 3) -> DataFrame:
    """One row per document: ``id``, ``fingerprint`` (16 hex digits), ``component_id``.

    The component id is the smallest id reachable over links. A row whose id is null takes part
    like any other; a component without any id has a null component id.
    """
    found = materialize(fingerprints(docs.select(F.col(id).alias("id"), F.col(text).alias("text")), drop=("text",), shingle=shingle), "fingerprints")
    lowest_here = found.groupBy("bits").agg(F.min("id").alias("id"))
    placed = materialize(_grouped(found, distance).join(lowest_here, "bits"), "components")
    lowest = placed.groupBy("component").agg(F.min("id").alias("component_id"))
    named = placed.join(lowest, "component").select("bits", "component_id")
    hex16 = F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint")
    return found.join(named, "bits", "left").select(F.col("id").alias(id), hex16, "component_id")


def deduplicate(docs: DataFrame, id: str = "doc_id", text: str = "text", distance: int = 2, shingle: int = 3) -> DataFrame:
    """One row of each component, that of the smallest id (null last), with all its columns.

    Rows of equal ids are told apart by their place in the scan, which is written down once.
    """
    row, bits = unused(docs, "simhash_row"), unused(docs, "simhash_bits")
    found = materialize(fingerprints(docs.withColumn(row, F.monotonically_increasing_id()), text, bits, shingle), "fingerprints")
    first = F.min(F.struct(F.col(id).isNull().alias("none"), F.col(id).alias("id"), F.col(row).alias("row"))).alias("first")
    by_bits = found.groupBy(F.col(bits).alias("bits")).agg(first)
    placed = _grouped(found.select(F.col(bits).alias("bits")), distance).join(by_bits, "bits")
    kept = placed.groupBy("component").agg(F.min("first").alias("first")).select(F.col("first.row").alias(row))
    return found.join(kept, row, "left_semi").select(*docs.columns)

"""Benchmark decontamination by whole word windows, in table operations only.

Texts are lower-cased (A-Z) and cut into words of ``[0-9a-z]`` and non-ASCII characters. A benchmark
item gives one window per ``window`` consecutive words, or a single one if it has fewer words. A
document word is hit if it lies inside an occurrence of any window.

The windows of the benchmark are a hash set, broadcast while they are at most ``BROADCAST_BYTES``
of text and joined by shuffle beyond. A window is found in two steps. Any ``n`` consecutive words hold a
whole run of ``(n + 1) / 2`` words that begins at a multiple of that length, so only those runs of a document are
looked up, by an eight-byte hash, among all such runs of the windows. Around the runs that are found, every window is looked
up by its whole text, so a hit is exact. Texts are cut into blocks of words, and blocks into runs, by regular expressions; a
run is looked at with the blocks before and after its own. In the shuffled form hashes move alone and tell which documents
are looked at again.

Null and empty texts have no words, no hits and are not contaminated; an item without words has
no window. Rows are told apart by id and text: repeated rows give equal results each, a null id
is an id like any other, listed as ``null`` for an item. An empty benchmark hits nothing. Extra columns are left alone, also where their
names clash with result columns, as results are made from the id and the text only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driverlens.llm.common import SEPARATORS, ascii_lower, words
from driverlens.session import materialize

WINDOW = 10
BLOCK = 120  # words of a block, about
BROADCAST_BYTES = 64 << 20

def benchmark_windows(items: DataFrame, id: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Distinct (item_id, window, len): an item's windows as space-joined words."""
    cut = items.select(F.col(id).alias("item_id"), words(F.col(text)).alias("words")).where(F.size("words") > 0)
    last = F.greatest(F.size("words") - window, F.lit(0))
    every = F.transform(F.sequence(F.lit(0), last), lambda i: F.array_join(F.slice("words", i + 1, window), " "))
    return cut.select("item_id", F.least(F.size("words"), F.lit(window)).alias("len"), F.explode(every).alias("window")).distinct()


def _run(len: int) -> int:
    """Length of the runs looked up for windows of a length: one lies in every window at a multiple of it."""
    return (len + 1) // 2


def _window_runs(wanted: DataFrame) -> DataFrame:
    """Distinct (len, run): hashes of all runs of the windows."""
    size = F.floor((F.col("len") + 1) / 2).cast("int")
    cut = F.split("window", " ")
    runs = F.transform(F.sequence(F.lit(0), F.col("len") - size), lambda i: F.xxhash64(F.array_join(F.slice(cut, i + 1, size), " ")))
    return wanted.select("len", F.explode_outer(runs).alias("run")).distinct()


def _cut(text: Column, least: int, most: int) -> Column:
    """Consecutive pieces of so many words of a text whose words have one blank between them."""
    return F.regexp_extract_all(text, F.lit(f"[^ ]+(?: [^ ]+){{{least - 1},{most - 1}}}"), F.lit(0))


def _block_words(lens: list[int]) -> int:
    """Words of a block: a multiple of every run's length, and no less than a window."""
    step = math.lcm(*(_run(n) for n in lens))
    return step * -(-max(BLOCK, *lens) // step)


def _spots(whole: DataFrame, lens: list[int]) -> DataFrame:
    """(key, block, at): the runs of all documents, beside the block of words they lie in and its neighbours."""
    size = _block_words(lens)
    even = F.trim(F.regexp_replace(ascii_lower(F.coalesce(F.col("text"), F.lit(""))), SEPARATORS, " "))
    cut = whole.select(row_key("id", "text").alias("key"), _cut(even, 1, size).alias("blocks"))
    beside = lambda b, i: F.struct((i * size).alias("first"), F.get("blocks", i - 1).alias("before"), b.alias("text"), F.get("blocks", i + 1).alias("after"))
    # Outer: a plain explode would have its arrays made twice, once for a filter on their size.
    block = cut.select("key", F.explode_outer(F.transform("blocks", beside)).alias("block"))

    def runs(len: int) -> Column:
        def spot(run: Column, i: Column) -> Column:
            return F.struct((F.col("block.first") + i * _run(len)).alias("pos"), F.lit(len).alias("len"), F.xxhash64(run).alias("run"))

        return F.transform(_cut(F.col("block.text"), _run(len), _run(len)), spot)

    return block.select("key", "block", F.explode_outer(F.concat(*map(runs, lens))).alias("at"))


def _windows_around(lens: list[int]) -> Column:
    """Structs (pos, window): all windows of the spot's length that hold its run."""
    run = F.element_at(F.create_map(*[F.lit(x) for n in lens for x in (n, _run(n))]), F.col("at.len"))
    near = F.split(F.concat_ws(" ", "block.before", "block.text", "block.after"), " ")
    begin = F.col("block.first") - F.when(F.col("block.before").isNull(), F.lit(0)).otherwise(F.lit(_block_words(lens)))
    place = F.col("at.pos") - begin
    low = F.greatest(F.lit(0), place - (F.col("at.len") - run))
    high = F.least(place, F.size(near) - F.col("at.len"))
    every = F.transform(
        F.sequence(low, F.greatest(low, high)),
        lambda i: F.struct((begin + i).alias("pos"), F.array_join(F.slice(near, i + 1, F.col("at.len")), " ").alias("window")),
    )
    return F.when(high >= low, every).otherwise(F.array().cast("array<struct<pos:int,window:string>>"))


def hits(docs: DataFrame, windows: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Distinct occurrences (key, pos, len, window); the key is a struct of id and text hash."""
    wanted = windows.select("window", "len").distinct()
    lens = sorted(row[0] for row in wanted.select("len").distinct().collect())  # at most ``window`` numbers
    if not lens:
        lens = [WINDOW]
    size = wanted.agg(F.sum(F.octet_length("window"))).first()[0] or 0
    small = size <= BROADCAST_BYTES
    sent = F.broadcast if small else lambda rows: rows
    known = _window_runs(wanted)
    whole = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    if not small:
        found = materialize(_spots(whole, lens).select("key", "at.len", "at.run").join(known, ["len", "run"]).select("key").distinct(), "found")
        whole = whole.join(found, row_key("id", "text") == found["key"], "left_semi")
    spots = _spots(whole, lens)
    met = spots.join(sent(known), (spots["at.len"] == known["len"]) & (spots["at.run"] == known["run"]), "left_semi")
    placed = met.select("key", "at.len", F.explode_outer(_windows_around(lens)).alias("around")).select("key", "len", "around.pos", "around.window")
    return placed.join(sent(wanted), ["window", "len"]).select("key", "pos", "len", "window").distinct()


def row_key(id: str, text: str) -> Column:
    """Tells rows apart by id and text; equal for repeated rows, never null."""
    return F.struct(F.col(id).alias("id"), F.xxhash64(text).alias("text_hash"))


def report(docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per document: id, n_words, n_hit, items (sorted text ids of items with occurring windows)."""
    windows = materialize(benchmark_windows(items, window=window), "windows")
    found = materialize(hits(docs, windows, id, text), "hits")
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("n"))
    covered = F.aggregate(
        F.sort_array(F.collect_set(F.struct("pos", "len"))),
        start,
        lambda seen, at: F.struct(
            F.greatest(seen["end"], at["pos"] + at["len"]).alias("end"),
            (seen["n"] + F.greatest(F.lit(0), at["pos"] + at["len"] - F.greatest(seen["end"], at["pos"]))).alias("n"),
        ),
        lambda seen: seen["n"],
    )
    counted = found.groupBy("key").agg(covered.alias("n_hit"))
    by_item = found.select("key", "window").distinct().join(windows.select("window", "item_id").distinct(), "window").select("key", "item_id").distinct()
    listed = by_item.groupBy("key").agg(F.sort_array(F.collect_set(F.coalesce(F.col("item_id").cast("string"), F.lit("null")))).alias("items"))
    n_words = F.size(words(F.col(text))).cast("bigint").alias("n_words")
    rows = docs.select(F.col(id).alias("id"), row_key(id, text).alias("key"), n_words)
    joined = rows.join(counted, "key", "left").join(listed, "key", "left")
    nothing = F.array().cast("array<string>")
    return joined.select(F.col("id").alias(id), "n_words", F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"), F.coalesce("items", nothing).alias("items"))


def drop_contaminated(docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """The documents without any hit, with all their columns."""
    windows = materialize(benchmark_windows(items, window=window), "windows")
    found = materialize(hits(docs, windows, id, text).select("key").distinct(), "hits")
    return docs.join(found, row_key(id, text) == found["key"], "left_anti")


REPORT_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
  FROM documents),
b AS (
  SELECT item_id,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
  FROM benchmark),
starts AS (SELECT item_id, words, least(len(words), 10) AS n, unnest(range(greatest(len(words) - 10, 0) + 1)) AS i FROM b WHERE len(words) > 0),
w AS (SELECT DISTINCT item_id, n, words[i + 1 : i + n] AS win FROM starts),
lens AS (SELECT DISTINCT n FROM w),
placed AS (SELECT rid, n, words, unnest(range(len(words) - n + 1)) AS i FROM d, lens WHERE len(words) >= n),
hit AS (SELECT DISTINCT rid, i, a.n, item_id FROM placed a JOIN w ON w.n = a.n AND w.win = a.words[i + 1 : i + a.n]),
hit_words AS (SELECT rid, count(*) AS n_hit FROM (SELECT DISTINCT rid, unnest(range(i, i + n)) AS p FROM hit) GROUP BY rid),
hit_items AS (SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT rid, coalesce(CAST(item_id AS VARCHAR), 'null') AS item_id FROM hit) GROUP BY rid)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (rid) LEFT JOIN hit_items USING (rid)
"""

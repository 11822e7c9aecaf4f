"""Log entries: a header line plus the lines up to the next header.

Three ways in, one result ``cluster_id?, path, entry_no, text``:

* ``entries_from_text``: whole files as text rows, split by one JVM regex;
* ``sources.logs.scan_entries``: whole files as bytes (gzip or plain, damaged or not);
* ``entries_from_lines``: line rows of splittable files of any size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from driverlens.session import materialize

# Fixed values of the log format.
HEADER = r"[0-9]{2}/[0-9]{2}/[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2} "
HEADER_LENGTH = 18
PROGRESS_MARKER = "Streaming query made progress:"
LINE_SCHEMA = "value STRING, path STRING, block_start BIGINT"


def is_header(line: Column) -> Column:
    return line.rlike("^" + HEADER)


def header_lines(lines: DataFrame) -> DataFrame:
    return lines.filter(is_header(F.col("value")))


def entries_from_text(files: DataFrame) -> DataFrame:
    """``path, text`` rows to entries; lines before the first header are entry 0."""
    text = F.regexp_replace(F.regexp_replace("text", "\r\n?", "\n"), "\n$", "")
    keep = [c for c in files.columns if c != "text"]
    return files.filter(F.length("text") > 0).select(
        *keep, F.posexplode(F.split(text, "\n(?=" + HEADER + ")")).alias("entry_no", "text")
    )


def is_preamble(text: Column) -> Column:
    return ~is_header(text)


def progress_entries(entries: DataFrame) -> DataFrame:
    """Entries carrying the exact marker; a plain substring test ahead of any JSON work."""
    return entries.filter(F.contains("text", F.lit(PROGRESS_MARKER)))


class EntrySplitter:
    """Cuts a stream of text chunks at header lines; holds one unfinished entry."""

    def __init__(self):
        self._cut = re.compile("\n(?=" + HEADER + ")")
        self._held: list[str] = []

    def push(self, chunk: str) -> list[str]:
        # A header may straddle two chunks, so the end of the held text is searched again.
        tail = self._held.pop() if self._held else ""
        text = tail + chunk
        pieces = self._cut.split(text)
        if len(pieces) > 1:
            pieces[0] = "".join(self._held) + pieces[0]
            self._held = []
        last = pieces.pop()
        edge = max(0, len(last) - HEADER_LENGTH - 1)
        self._held += [last[:edge], last[edge:]]
        return pieces

    def finish(self) -> str:
        text, self._held = "".join(self._held), []
        return text


def _line_segments(progress_only: bool):
    """Per input split, in order: entry texts, numbered; number 0 is what precedes a header."""
    header = re.compile(HEADER)

    def segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, splitter, number = None, None, 0
        out: list[tuple] = []

        def emit(text: str, last: bool) -> None:
            nonlocal number
            edge = last or number == 0
            if edge or not progress_only or PROGRESS_MARKER in text:
                out.append((*block, number, last, text))
            number += 1

        def close() -> None:
            emit(splitter.finish().removesuffix("\n"), True)

        for batch in batches:
            values, paths, starts = (batch[n].to_pylist() for n in ("value", "path", "block_start"))
            begin = 0
            while begin < len(values):
                here = (paths[begin], starts[begin])
                end = begin + 1
                while end < len(values) and paths[end] == here[0] and starts[end] == here[1]:
                    end += 1
                if here != block:
                    if block is not None:
                        close()
                    block, splitter = here, EntrySplitter()
                    number = 1 if header.match(values[begin]) else 0
                for text in splitter.push("\n".join(values[begin:end]) + "\n"):
                    emit(text, False)
                begin = end
            if len(out) > 0:
                yield _segment_batch(out)
                out = []
        if block is not None:
            close()
            yield _segment_batch(out)

    return segment


def _segment_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string())
    names = ["path", "block_start", "number", "is_last", "text"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def read_lines(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """Line rows with the file and split they come from."""
    return spark.read.option("recursiveFileLookup", recursive).text(path).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block_start")
    )


def entries_from_lines(lines: DataFrame, progress_only: bool = False) -> DataFrame:
    """Line rows (as ``read_lines`` gives them) to entries, without shuffling the lines.

    A read task sees the lines of its split in order, so it cuts entries by itself. Only an
    entry that runs over the end of a split has to be put together: at most two pieces per
    split travel, however large the file. ``progress_only`` keeps just the entries with the
    marker, before anything is written or shuffled.
    """
    schema = "path STRING, block_start BIGINT, number BIGINT, is_last BOOLEAN, text STRING"
    pieces = materialize(lines.mapInArrow(_line_segments(progress_only), schema), "entries")
    # A split that does not start a file may start inside an entry of the split before.
    continues = (F.col("number") == 0) & (F.col("block_start") > 0)
    edge = continues | F.col("is_last")
    # Bytes before the split plus the entry's place in it: unique and in file order.
    entry_no = (F.col("block_start") + F.col("number")).alias("entry_no")
    inner = pieces.filter(~edge).select("path", entry_no, "text")
    in_file = W.partitionBy("path").orderBy("block_start", "number")
    piece = ["path", "block_start", "number"]
    chain = pieces.filter(edge).select(
        *piece,
        F.contains("text", F.lit(PROGRESS_MARKER)).alias("has_marker"),
        F.sum(F.when(continues, 0).otherwise(1)).over(in_file).alias("whole"),
    )
    if progress_only:
        # A marker lies within one line, so within one piece: put together only what has one.
        marked = chain.groupBy("path", "whole").agg(F.bool_or("has_marker").alias("wanted")).filter("wanted")
        chain = chain.join(marked.select("path", "whole"), ["path", "whole"], "left_semi")
    joined = (
        pieces.filter(edge).join(chain.select(*piece, "whole"), piece)
        .groupBy("path", "whole")
        .agg(
            F.min(F.col("block_start") + F.col("number")).alias("entry_no"),
            F.array_sort(F.collect_list(F.struct("block_start", "number", "text"))).alias("p"),
        )
        .select("path", "entry_no", F.array_join("p.text", "\n").alias("text"))
    )
    entries = inner.unionByName(joined)
    return progress_entries(entries) if progress_only else entries

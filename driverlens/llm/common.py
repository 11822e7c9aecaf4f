"""What the operators on text share: row functions over Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

ROWS = 128  # rows turned into Python objects at a time


def with_columns(
    df: DataFrame, need: list[str], added: str, make: Callable[[], Callable[..., tuple]], drop: tuple[str, ...] = ()
) -> DataFrame:
    """Append the columns that a row function returns, in the order of the DDL text ``added``.

    ``make`` is called once per task and returns the row function; it gets the values of
    ``need``. Input columns named in ``added`` are replaced, those in ``drop`` left out.
    """
    fresh = T._parse_datatype_string(added)
    names = {f.name for f in fresh} | set(drop)
    kept = [f for f in df.schema if f.name not in names]
    schema = T.StructType(kept + list(fresh))
    arrow = to_arrow_schema(T.StructType(list(fresh)))
    kept_names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = make()
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                found = [row(*v) for v in zip(*(part.column(n).to_pylist() for n in need))]
                made = [pa.array([r[i] for r in found], f.type) for i, f in enumerate(arrow)]
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in kept_names), *made], [*kept_names, *arrow.names])

    wanted = list(dict.fromkeys([*kept_names, *need]))
    return df.select(*wanted).mapInArrow(run, schema)


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """The name, with as many underscores after it as keep it apart from the table's columns."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def ascii_lower(text):
    """A-Z to a-z and nothing else."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text):
    """Lower-cased words of ``[0-9a-z]`` and non-ASCII characters; null has none."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def pieces(text: str, size: int) -> Iterator[str]:
    """The text in pieces of about ``size`` characters that end before white space, so that no word is cut."""
    start = 0
    while start < len(text):
        end = min(len(text), start + size)
        while end < len(text) and not text[end].isspace():
            end += 1
        yield text[start:end]
        start = end


SLOTS = 32


def sample_ids(ids: DataFrame, by: str, rows: int) -> DataFrame:
    """At most ``rows`` rows (``id`` unique), about as many of each value of ``by``.

    Ids fall into slots by a hash. Of every value and slot the rows of the smallest other hash
    are taken, a slot's share at most, so no value meets in one task however common it is.
    """
    slot, order = F.pmod(F.xxhash64(F.lit(by), "id"), F.lit(SLOTS)), (F.xxhash64("id"), F.col("id"))
    place = F.row_number().over(Window.partitionBy(by, "slot").orderBy(*order))
    ranked = ids.withColumn("slot", slot).withColumn("place", place).where(F.col("place") <= -(-rows // SLOTS))
    return ranked.orderBy("place", *order).limit(rows).select(*ids.columns)


def one_text(docs: DataFrame, id: str, text: str, *more: str) -> DataFrame:
    """(id, hash, more): of each id's rows the one with the smallest text hash, so that it doesn't matter in
    which order rows come; texts stay where they are."""
    first = F.min(F.struct(F.xxhash64(text).alias("hash"), *more)).alias("first")
    return docs.groupBy(F.col(id).alias("id")).agg(first).select("id", "first.*")

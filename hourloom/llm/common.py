"""Helpers the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.session import stored

Query = Callable[[SparkSession, str], DataFrame]
DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SPACE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Rows of an Arrow batch that a task works on at once; what it returns is as short.
SLICE_ROWS = 1000

#: Most rows of a table that is sent to every executor; above it the join shuffles.
BROADCAST_ROWS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(spark: SparkSession) -> int:
    """Number of partitions for an explicit exchange: what the session uses."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A stored frame with a broadcast hint, if it was counted to have at most ``rows`` rows.

    Only for narrow rows of fixed width, so the count bounds the size.
    """
    return F.broadcast(df) if df.count() <= rows else df


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def wide_hash(*cols: Column) -> list[Column]:
    """Two 64-bit hashes of the same values, 128 bits together."""
    return [F.xxhash64(F.lit(1), *cols).alias("h1"), F.xxhash64(F.lit(2), *cols).alias("h2")]


def in_slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """All rows of the batches, at most ``rows`` at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def ids_and_texts(batches, *others: str) -> Iterator[tuple[list, ...]]:
    """doc_id, the text's UTF-8 bytes, and other columns of each slice of the batches, as lists."""
    for batch in in_slices(batches):
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        yield batch.column("doc_id").to_pylist(), texts, *[batch.column(c).to_pylist() for c in others]


__all__ = [
    "BROADCAST_ROWS",
    "DOCUMENT",
    "DOCUMENT_COLUMNS",
    "SPACE",
    "UPPER",
    "Query",
    "ids_and_texts",
    "in_slices",
    "ascii_lower",
    "small",
    "spread",
    "stored",
    "table",
    "wide_hash",
]

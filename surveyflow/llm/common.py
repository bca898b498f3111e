"""What the operators share: tables, words, folds, Arrow rows, and general helpers of the library."""

from __future__ import annotations

from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyflow.operators.ranges import running_totals
from surveyflow.sources.scratch import discard, materialize

WORD = r"[^\x20\x09-\x0D]+"

__all__ = [
    "WORD", "buffered", "discard", "document_key", "fold", "lower_ascii", "materialize", "narrow", "one_each", "running_totals",
    "table", "text_rows", "whole",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: str | Column) -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII takes the fast built-in, which does the same there."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, ascii_uppercase, ascii_lowercase))


def fold(key: str, parts: int) -> Column:
    """crc32 of the key as text, modulo ``parts``; a null key counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % parts


def narrow(df: DataFrame, **columns: str) -> DataFrame:
    """Only the wanted columns, under the operator's own names: whatever else the input carries can't clash."""
    return df.select(*(F.col(f"`{source}`").alias(name) for name, source in columns.items()))


def document_key(id_col: str, digest: Column) -> Column:
    """Sixteen bytes that stand for an id, null or not, together with the digest (text) of a text."""
    named = F.coalesce(F.concat(F.lit("="), F.col(id_col).cast("string")), F.lit("none"))
    return F.unhex(F.md5(F.concat(digest, named)))


def one_each(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Of the rows of each ``__key`` the one with the smallest hash of ``columns``, which are returned."""
    every = [F.col(f"`{c}`") for c in columns]
    chosen = rows.groupBy("__key").agg(F.min_by(F.struct(*every), F.xxhash64(*every)).alias("__row"))
    return chosen.select("__row.*")


def text_rows(batches: Iterator[pa.RecordBatch], text: str | int = "text", size: int = 8_000_000) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Arrow batches of at most some megabytes of text with the texts as Python strings; null counts as empty."""
    for batch in batches:
        step = max(1, batch.num_rows // max(1, batch.get_total_buffer_size() // size))
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            yield part, [value or "" for value in part.column(text).to_pylist()]


def buffered(rows: Iterator[tuple], schema: pa.Schema, most: int = 4096, weight=None, limit: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """Tuples as Arrow batches of bounded length and, if ``weight`` measures a row, bounded size."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += weight(row) if weight else 0
        if len(held) >= most or size >= limit:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)

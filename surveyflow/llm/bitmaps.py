"""Bitmaps of fixed size that tell which keys may be in a set: what they let through by chance ends in a join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: 16 MB. A set of more keys than bits lets all through, which costs time and disk but no correctness.
BITS = 1 << 27
_BUCKET = 1 << 15  # bits that the built-in aggregate holds in one value


def bitmap_of(keys: DataFrame, column: str) -> np.ndarray:
    """The bits of a column of longs. At most BITS / 8 bytes reach the driver, whatever the number of keys."""
    bit = f"pmod(`{column}`, {BITS}L)"
    rows = keys.select(F.expr(f"{bit} div {_BUCKET}").alias("bucket"), F.expr(f"{bit} % {_BUCKET}").alias("position"))
    held = rows.groupBy("bucket").agg(F.bitmap_construct_agg("position").alias("bits")).collect()
    out = np.zeros((BITS // _BUCKET, _BUCKET // 8), dtype=np.uint8)
    for r in held:
        out[r["bucket"]] = np.frombuffer(r["bits"], dtype=np.uint8)
    return out.ravel()


def marked(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the bit of each 64-bit key is set."""
    bit = keys.view(np.uint64) & np.uint64(8 * len(bitmap) - 1)
    return (bitmap[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def matching(rows: DataFrame, bitmap: np.ndarray, column: str) -> DataFrame:
    """The rows whose key has its bit set."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(marked(bitmap, batch.column(column).to_numpy())))

    return rows.mapInArrow(work, rows.schema)

"""Fixed-size summaries of a whole corpus: counts by hash cell, and sets as bits.

Both have a size set by a parameter, whatever the corpus, and are summed up by
slices in Spark; the driver only gets the finished summary.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICES = 64
SCHEMA = "slice int, payload binary"


def sliced(cells: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The non-empty slices of a task's own summary."""
    numbers, payloads = [], []
    for i, own in enumerate(np.split(cells, SLICES)):
        if own.any():
            numbers.append(i)
            payloads.append(zlib.compress(own.tobytes(), 1))
    yield pa.RecordBatch.from_arrays(
        [pa.array(numbers, pa.int32()), pa.array(payloads, pa.binary())], names=["slice", "payload"]
    )


def _summed(kind: str, join):
    def run(table: pa.Table) -> pa.Table:
        total = None
        for payload in table.column("payload"):
            own = np.frombuffer(zlib.decompress(payload.as_py()), kind)
            total = own.copy() if total is None else join(total, own, out=total)
        return pa.table(
            {"slice": table.column("slice")[:1], "payload": [zlib.compress(total.tobytes(), 1)]},
            schema=pa.schema([("slice", pa.int32()), ("payload", pa.binary())]),
        )

    return run


def collected(rows: DataFrame, size: int, kind: str, join) -> np.ndarray:
    """The whole summary of rows made by ``sliced``."""
    out = np.zeros(size, kind)
    width = size // SLICES
    for r in rows.groupBy("slice").applyInArrow(_summed(kind, join), SCHEMA).toLocalIterator():
        out[r["slice"] * width : (r["slice"] + 1) * width] = np.frombuffer(
            zlib.decompress(bytes(r["payload"])), kind
        )
    return out


def bit_filter(rows: DataFrame, column: str, bits: int) -> np.ndarray:
    """A set of 64-bit numbers as ``2 ** bits`` bits: members always show, others sometimes."""

    def fill(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << bits, bool)
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            cells[keys >> np.uint64(64 - bits)] = True
        yield from sliced(np.packbits(cells))

    return collected(rows.select(column).mapInArrow(fill, SCHEMA), (1 << bits) // 8, "u1", np.bitwise_or)


def in_filter(filled: np.ndarray, keys: np.ndarray) -> np.ndarray:
    bits = (len(filled) * 8).bit_length() - 1
    cell = keys.astype(np.uint64) >> np.uint64(64 - bits)
    return (filled[cell >> np.uint64(3)] >> (np.uint64(7) - (cell & np.uint64(7))).astype(np.uint8)) & 1 == 1


def shows(rows: DataFrame, filled: np.ndarray, key: Column) -> Column:
    """Whether a number shows in a set made by ``bit_filter``; only the numbers go to Python."""
    sent = rows.sparkSession.sparkContext.broadcast(filled)

    def look(keys):
        return pd.Series(in_filter(sent.value, keys.to_numpy(np.int64).view(np.uint64)))

    return F.pandas_udf(look, "boolean", F.PandasUDFType.SCALAR)(key)

"""Vectors as short codes: one entry number per part, by exact integer arithmetic.

Components become integers, vectors are cut into equal parts, and each part
position has a codebook that is refined in rounds: every part goes to its nearest
entry, every entry becomes the floored mean of its parts.  Nothing is rounded on
the way, so codes do not depend on how rows are dealt out or on the BLAS in use:
dot products come from float64 matrix products of limbs so narrow that every sum
stays below 2 ** 53, and limbs are recombined in 64-bit integers.

Each round is one pass over the rows.  Tasks keep sums and counts per entry, a table
whose size depends on the codebook alone; Spark adds them up, and the driver gets the
finished table of ``parts * entries`` rows.

Odd rows.  A null vector, and one with a null or non-finite component, is dropped.
Vectors shorter than the longest, and lengths that can't be cut evenly, are taken as
ending in zeros.  Components beyond what 64-bit distances allow (2 ** 27 after
scaling for 64 components) count as that bound.  First entries are ordered by id, null
ids last, equal ids by vector; with fewer rows than entries there are fewer entries.
Repeated rows count each time and each return a row.  An empty table gives no rows.
Columns other than id, vector and label are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.storage import written

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
# Numbers that one block of rows may hold; a longer single vector is a block of its own.
_BLOCK = 1 << 19
# Labels with more than this share of all rows, at most as many, are looked up from a broadcast table.
HOT_LABELS = 10_000
_LONGEST = (1 << 63) - 1


@dataclass(frozen=True)
class Codebook:
    """``entries[part, entry, position]``, and the vector length that they were made for."""

    entries: np.ndarray

    @property
    def bound(self) -> int:
        return bound(self.entries.shape[0] * self.entries.shape[2])

    def digest(self) -> str:
        """SHA-256 of all components in decimal, by part, entry and position, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def bound(width: int) -> int:
    """The greatest component for which every squared distance of ``width`` components fits 63 bits."""
    return 1 << ((61 - (width - 1).bit_length()) // 2)


def limbs(numbers: np.ndarray, bits: int) -> list[np.ndarray]:
    """Integers as float64 limbs, lowest first: all but the last in ``[0, 2 ** bits)``."""
    out, rest = [], numbers
    while rest.size and (rest.max() > 1 << bits or rest.min() < -(1 << bits)):
        out.append((rest & ((1 << bits) - 1)).astype(np.float64))
        rest = rest >> bits
    return [*out, rest.astype(np.float64)]


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b`` of 64-bit integers, exact wherever the result fits 64 bits.

    A product of two limbs summed over the inner dimension stays within 2 ** 53, so
    the float64 product is exact in any order of adding.
    """
    bits = (53 - max(0, a.shape[1] - 1).bit_length()) // 2
    total = np.zeros((a.shape[0], b.shape[1]), np.int64)
    right = limbs(b, bits)
    for i, x in enumerate(limbs(a, bits)):
        for j, y in enumerate(right):
            total += (x @ y).astype(np.int64) << np.int64(bits * (i + j))
    return total


def nearest(rows: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry of every part, squared distances summed over parts) of ``rows[row, part, position]``."""
    codes = np.zeros(rows.shape[:2], np.int64)
    error = np.zeros(len(rows), np.int64)
    for part in range(rows.shape[1]):
        x, c = np.ascontiguousarray(rows[:, part]), book[part]
        # The part's own square is the same for all entries and is added after the choice.
        gaps = (c * c).sum(axis=1)[None, :] - 2 * exact_products(x, c.T)
        codes[:, part] = gaps.argmin(axis=1)
        error += (x * x).sum(axis=1) + gaps[np.arange(len(x)), codes[:, part]]
    return codes, error


def integers(vectors: pa.Array, parts: int, width: int, scale: int) -> np.ndarray:
    """``floor(scale * x)`` of float64 lists as ``[row, part, position]``, ending in zeros."""
    offsets = vectors.offsets.to_numpy()
    lengths = np.diff(offsets)
    flat = vectors.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
    out = np.zeros((len(vectors), parts * width), np.int64)
    rows = np.repeat(np.arange(len(vectors)), lengths)
    top = bound(parts * width)
    with np.errstate(over="ignore"):
        scaled = np.clip(np.floor(flat * scale), -top, top)
    out[rows, np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], lengths)] = scaled
    return out.reshape(len(vectors), parts, width)


def _blocks(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    size = max(1, _BLOCK // width)
    for batch in batches:
        for start in range(0, batch.num_rows, size):
            yield batch.slice(start, size)


def usable(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows whose vector holds only finite numbers, with the vector as doubles."""
    numbers = F.col(vector).cast("array<double>")
    finite = F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.col(vector).isNotNull() & finite).withColumn(vector, numbers)


def _width(kept: DataFrame, vector: str, parts: int) -> int:
    """Components of one part, so that the longest vector fits."""
    longest = kept.agg(F.max(F.size(vector))).first()[0] or 0
    return max(1, -(-longest // parts))


def fit(
    rows: DataFrame,
    *,
    id: str = "vec_id",
    vector: str = "embedding",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> Codebook:
    """The codebook of ``rows``: first entries from the smallest ids, then ``rounds`` means over all rows."""
    kept = usable(rows, vector).select(F.col(id).alias("id"), F.col(vector).alias("vector"))
    width = _width(kept, "vector", parts)
    first = kept.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).collect()
    start = pa.array([r["vector"] for r in first], pa.list_(pa.float64()))
    book = integers(start, parts, width, scale).transpose(1, 0, 2)
    for _ in range(rounds if first else 0):
        book = _means(kept, book, scale)
    return Codebook(np.ascontiguousarray(book))


def _means(kept: DataFrame, book: np.ndarray, scale: int) -> np.ndarray:
    parts, entries, width = book.shape

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts * entries, width + 1), np.int64)
        for batch in _blocks(batches, parts * width):
            x = integers(batch.column(0), parts, width, scale)
            cells = nearest(x, book)[0] + np.arange(parts) * entries
            for position in range(width):
                # Whole numbers of a block add up to less than 2 ** 53.
                added = np.bincount(cells.ravel(), x[:, :, position].ravel(), parts * entries)
                total[:, position] += added.astype(np.int64)
            total[:, width] += np.bincount(cells.ravel(), minlength=parts * entries)
        used = np.flatnonzero(np.repeat(total[:, width] > 0, width + 1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int64()), pa.array(total.ravel()[used], pa.int64())], names=["cell", "total"]
        )

    added = kept.select("vector").mapInArrow(sums, "cell long, total long")
    out = [list(map(int, row)) for row in book.reshape(parts * entries, width)]
    found: dict[int, dict[int, int]] = {}
    for r in added.groupBy("cell").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect():
        found.setdefault(r["cell"] // (width + 1), {})[r["cell"] % (width + 1)] = int(r["total"])
    for entry, totals in found.items():
        out[entry] = [totals[position] // totals[width] for position in range(width)]
    return np.array(out, np.int64).reshape(book.shape)


def encode(
    rows: DataFrame,
    codebook: Codebook,
    *,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    scale: int = SCALE,
) -> DataFrame:
    """(id, label, codes, error) of every usable row; ``codes`` has one number per part."""
    book = codebook.entries
    parts, _, width = book.shape

    def coded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches, parts * width):
            codes, error = nearest(integers(batch.column(2), parts, width, scale), book)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(codes) + 1) * parts, pa.int32()), pa.array(codes.ravel(), pa.int32())
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), lists, pa.array(error)], names=[id, label, "codes", "error"]
            )

    kept = usable(rows.select(id, label, vector), vector)
    kinds = ", ".join(f"`{c}` {kept.schema[c].dataType.simpleString()}" for c in (id, label))
    return kept.mapInArrow(coded, f"{kinds}, codes array<int>, error long")


def with_label_error(coded: DataFrame, *, label: str = "label", hot_labels: int = HOT_LABELS) -> DataFrame:
    """``coded`` with the error summed over its label, nulls together, as ``label_error``.

    Labels that hold more than ``1 / hot_labels`` of all rows, at most ``hot_labels``
    of them, are looked up from a broadcast table; any other label is small enough
    for one task and is joined by a shuffle.  ``coded`` should be a stored table.
    """
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(_LONGEST).cast("decimal(38,0)"))
    sums = written(
        coded.groupBy(F.col(label).alias("_label")).agg(
            total.cast("long").alias("label_error"), F.count("*").alias("_rows")
        ),
        "label-sums",
    )
    least = (sums.agg(F.sum("_rows")).first()[0] or 0) // hot_labels
    same = F.col(label).eqNullSafe(F.col("_label"))
    hot = F.broadcast(sums.filter(F.col("_rows") > least).drop("_rows"))
    cold = sums.filter(F.col("_rows") <= least).drop("_rows")
    others = coded.join(hot, same, "left_anti").join(cold, same)
    return coded.join(hot, same).unionByName(others).drop("_label")


def spelled(codes):
    """Codes as two lower-case hex digits each."""
    return F.lower(F.array_join(F.transform(codes, lambda c: F.lpad(F.hex(c), 2, "0")), ""))


def compressed(rows: DataFrame, **options) -> tuple[DataFrame, Codebook]:
    """(id, label, codes, error, label_error) of every usable row, and the codebook that codes refer to."""
    codebook = fit(rows, **options)
    encoding = {k: v for k, v in options.items() if k in ("id", "vector", "scale")}
    if not codebook.entries.shape[1]:
        none = encode(rows, codebook, **encoding).limit(0)
        return none.withColumn("label_error", F.lit(0).cast("long")), codebook
    coded = written(encode(rows, codebook, **encoding), "vector-codes")
    return with_label_error(coded), codebook

"""Packing documents into sequences: shortest pack first over the length histogram.

Documents are tokenised and cut into pieces of at most ``size`` ids.  The
histogram of piece lengths, which has at most ``size`` rows whatever the input,
is packed on the driver: lengths longest first, each into the packs that are
least full so far and still have room, which changes only the counts of packing
patterns.  Patterns are then joined back to the pieces by their rank within
their length.

Defined results: a null or empty text is the end id alone; null and repeated
``doc_id`` keep all their rows, each a document of its own; an empty table gives
an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesmill.llm.tokens import END_ID, encoded
from seriesmill.llm.storage import written

SEQUENCE_TOKENS = 4096
RANKS_PER_ROW = 4096
PIECE_SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part int, rank_in_part long"
)


def cuts(tokens: int, size: int) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of a document: full ones, then the rest."""
    for start in range(0, tokens, size):
        yield start, min(size, tokens - start)


def pieces(
    docs: DataFrame,
    tokenizer: str,
    size: int = SEQUENCE_TOKENS,
    end_id: int | None = END_ID,
    text: str = "text",
    key: str = "doc_id",
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece; ``rank_in_part`` counts pieces of its length in its task."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), Counter()
        for block, every, ends in encoded(batches, "text", tokenizer, end_id):
            out = []
            for doc_id, first, last in zip(block.column("doc_id").to_pylist(), ends.tolist(), ends[1:].tolist()):
                ids = every[first:last]
                for start, length in cuts(len(ids), size):
                    piece = ids[start : start + length]
                    row = [doc_id, start, length, zlib.crc32(piece.astype("<u4")), len(ids), part, seen[length]]
                    out.append(row + [piece] * with_ids)
                    seen[length] += 1
            kinds = [*[pa.int64()] * 5, pa.int32(), pa.int64(), *[pa.list_(pa.int32())] * with_ids]
            columns = zip(*out) if out else [[] for _ in kinds]
            names = [*(c.split()[0] for c in PIECE_SCHEMA.split(", ")), *["ids"] * with_ids]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names
            )

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        cut, PIECE_SCHEMA + ", ids array<int>" * with_ids
    )


def patterns(histogram: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a pack, number of such packs), longest lengths placed first.

    ``room`` holds, by free space, the patterns with their counts.  A length goes
    into the pattern with the most free space that still takes it; where none
    does, a new pack is opened, which then is the one with the most free space
    until no further piece of this length fits.
    """
    room: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        free = max((f for f, packs in room.items() if packs), default=0)
        while left and free >= length:
            if not room[free]:
                free -= 1
                continue
            pack, count = room[free].pop()
            used = min(left, count)
            if count > used:
                room[free].append((pack, count - used))
            room[free - length].append((pack + (length,), used))
            left -= used
        each = size // length
        for times, count in ((each, left // each), (left % each, 1)):
            if times and count:
                room[size - times * length].append(((length,) * times, count))
    return [pack for free in sorted(room) for pack in room[free]]


def slots(packed: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, last rank, first sequence, pieces a sequence, offset) of each place in a pattern.

    A pattern that holds a length several times takes so many ranks a sequence;
    equal lengths of a pattern lie side by side.
    """
    taken: Counter = Counter()
    out, sequence = [], 0
    for lengths, count in packed:
        offset = 0
        for length, times in Counter(lengths).items():
            first = taken[length]
            taken[length] += times * count
            out.append((length, first, taken[length] - 1, sequence, times, offset))
            offset += times * length
        sequence += count
    return out


def pack(rows: DataFrame, size: int = SEQUENCE_TOKENS) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; every other column is kept.

    ``rows`` needs ``length``, ``part`` and ``rank_in_part`` and must be stored
    (see ``session.written``), since it is read more than once.
    """
    spark = rows.sparkSession
    counts = rows.groupBy("part", "length").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = written(
        counts.withColumn("first", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "pack-counts"
    )
    histogram = {
        r["length"]: r["n"] for r in firsts.groupBy("length").agg(F.sum("n").alias("n")).collect()
    }
    places = spark.createDataFrame(
        slots(patterns(histogram, size)),
        "length long, from_rank long, to_rank long, from_sequence long, times long, from_offset long",
    )
    step = F.lit(RANKS_PER_ROW)
    places = places.withColumn(
        "stretch",
        F.explode(F.sequence(F.floor(F.col("from_rank") / step), F.floor(F.col("to_rank") / step))),
    )
    ranked = rows.join(firsts.select("part", "length", "first"), ["part", "length"]).withColumn(
        "rank", F.col("first") + F.col("rank_in_part")
    )
    ranked = ranked.withColumn("stretch", F.floor(F.col("rank") / step))
    placed = ranked.join(places, ["length", "stretch"]).filter(
        F.col("rank").between(F.col("from_rank"), F.col("to_rank"))
    )
    within = F.col("rank") - F.col("from_rank")
    kept = [c for c in rows.columns if c not in ("part", "rank_in_part")]
    return placed.select(
        *kept,
        (F.col("from_sequence") + F.floor(within / F.col("times"))).alias("sequence_id"),
        (F.col("from_offset") + (within % F.col("times")) * F.col("length")).alias("offset"),
    )


def pack_documents(docs: DataFrame, tokenizer: str, size: int = SEQUENCE_TOKENS) -> DataFrame:
    """Every document's pieces with their places in the sequences."""
    return pack(written(pieces(docs, tokenizer, size), "pieces"), size)

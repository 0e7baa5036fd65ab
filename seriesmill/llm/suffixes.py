"""Repeats of a fixed length by merged Burrows-Wheeler transforms.

Every 400-byte string of a text belongs to one anchor: the smallest hash of its
32-byte strings, the last of equal ones.  Equal strings have equal anchors at
equal places, so texts are cut into stretches of starts with one anchor, and
stretches whose anchor is unique in the corpus hold no repeat.  Equal stretches
are counted as one string.  Different strings of an anchor meet in a bucket,
where the repeated intervals are found:

* a bucket's strings are dealt to shards, and each shard gets its own
  Burrows-Wheeler transforms, over symbols of 16 bytes: the symbols before its
  suffixes in suffix order, for suffixes a whole number of symbols behind a start;
* the transforms are merged by refining their interleave: pass k deals the
  merged order out by the preceding symbol, which orders all suffixes by k + 1
  symbols, and marks where neighbours begin to differ.  No suffix is compared or
  sorted again; after 25 passes unmarked neighbours share a prefix of 400 bytes.

A string of the corpus is repeated if the strings of its interval occur more
than once.  Anchors with more strings than ``hot`` don't go to one bucket: their
400-byte strings are counted by 128-bit digest in Spark.

Defined results: a null text is empty; texts under 400 bytes keep all; rows
with equal ``doc_id`` and text repeat each other and lose what a copy loses; an
empty table stays empty; other columns are kept, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.llm import sketches
from seriesmill.llm.text import blocks, mixed, powers, text_bytes
from seriesmill.llm.storage import written
from seriesmill.session import work_path

LENGTH = 400
ANCHOR_BYTES = 32
SYMBOL_BYTES = 16
SHARD_BYTES = 16 << 10
BUCKET_BYTES = 64 << 10
FILTER_BITS = 25
HOT_STRINGS = 20_000
PIECE_BYTES = 4 << 20

#: The low bits of a ranked hash, which hold its place.
_PLACES = np.uint64((1 << 24) - 1)


def anchored(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(anchor hash, anchor place, first start, last start, row) of every stretch of starts.

    Long texts are taken in pieces that share ``length - 1`` bytes; a stretch at
    their border comes in two parts, each with all bytes of its starts.
    """
    parts = []
    for low in range(0, max(1, len(data)), PIECE_BYTES):
        high = min(len(data), low + PIECE_BYTES + length - 1)
        own = np.clip(offsets, low, high) - low
        anchor, *places, row = _anchored(data[low:high], own, length, gram)
        parts.append((anchor, *(p + low for p in places), row))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _anchored(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    none = np.zeros(0, np.int64)
    counts = np.maximum(np.diff(offsets) - length + 1, 0)
    if not counts.any():
        return none.astype(np.uint64), none, none, none, none
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data)), out=total[1:])
    grams = len(data) - gram + 1
    back = powers(len(data) + 1, pow(0x9E3779B97F4A7C15, -1, 1 << 64))
    hashes = mixed((total[gram:] - total[:grams]) * back[:grams])
    del total, back
    width = length - gram + 1
    # Least of every window: suffix minima and prefix minima of blocks as wide as a window.
    padded = np.full(-(-grams // width) * width, np.uint64((1 << 64) - 1))
    ranked = padded[:grams]
    # The place counts down in the low bits, so that of equal hashes the last is the smallest.
    np.bitwise_and(hashes, ~_PLACES, out=ranked)
    ranked |= np.arange(int(_PLACES), int(_PLACES) - grams, -1, dtype=np.uint64)
    grid = padded.reshape(-1, width)
    prefix = np.minimum.accumulate(grid, axis=1).ravel()
    suffix = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(data) - length + 1
    least = np.minimum(suffix[:n], prefix[width - 1 : width - 1 + n])
    # A stretch begins where the anchor changes, and with its text; starts near a text's end have no window.
    held = np.flatnonzero(counts)
    low, high = offsets[held], offsets[held] + counts[held]
    new = np.ones(n, bool)
    new[1:] = least[1:] != least[:-1]
    new[low] = True
    edges = np.zeros(n + 1, np.int8)
    edges[low] += 1
    edges[high] -= 1
    first = np.flatnonzero(new & (np.cumsum(edges[:-1], dtype=np.int8) > 0))
    of = np.searchsorted(low, first, "right") - 1
    last = np.minimum(np.append(first[1:], n), high[of]) - 1
    at = (_PLACES - (least[first] & _PLACES)).astype(np.int64)
    return hashes[at], at, first, last, held[of]


def anchors(given: DataFrame, length: int, gram: int) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            every, n = np.unique(
                anchored(*text_bytes(block.column("text")), length, gram)[0], return_counts=True
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array(every.view(np.int64)), pa.array(np.minimum(n, 2).astype(np.int8))], names=["anchor", "n"]
            )

    return given.select("text").mapInArrow(run, "anchor long, n byte")


STRETCHES = "doc_id long, tkey long, start long, starts int, anchor long, digest binary"
CONTENTS = "anchor long, digest binary, content binary"


def _found(block: pa.RecordBatch, repeated: np.ndarray, length: int, gram: int):
    """(bytes, first, last, row, anchor, first in the document) of a block's stretches in the filter."""
    data, offsets = text_bytes(block.column("text"))
    anchor, _, first, last, row = anchored(data, offsets, length, gram)
    own = sketches.in_filter(repeated, anchor)
    anchor, first, last, row = (x[own] for x in (anchor, first, last, row))
    return data.tobytes(), first, last, row, anchor, first - offsets[row]


def _digest(content: bytes) -> bytes:
    return hashlib.blake2b(content, digest_size=16).digest()


def stretches(given: DataFrame, repeated: np.ndarray, length: int, gram: int) -> DataFrame:
    """Stretches whose anchor is in the filter: their starts and a digest of their bytes."""
    sent = given.sparkSession.sparkContext.broadcast(repeated)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            whole, first, last, row, anchor, start = _found(block, sent.value, length, gram)
            digests = [_digest(whole[a:b]) for a, b in zip(first.tolist(), (last + length).tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("doc_id").take(pa.array(row)),
                    block.column("tkey").take(pa.array(row)),
                    pa.array(start),
                    pa.array((last - first + 1).astype(np.int32)),
                    pa.array(anchor.view(np.int64)),
                    pa.array(digests, pa.binary()),
                ],
                names=[f.split()[0] for f in STRETCHES.split(", ")],
            )

    return given.mapInArrow(run, STRETCHES)


def place_key(doc_id: Column, tkey: Column, start: Column) -> Column:
    """A number for a place, for filters."""
    return tkey.bitwiseXOR(F.shiftleft(start, 40)).bitwiseXOR(F.shiftleft(F.coalesce(doc_id, F.lit(0)), 20))


def contents(given: DataFrame, repeated: np.ndarray, places: np.ndarray, length: int, gram: int) -> DataFrame:
    """(anchor, digest, content) of the stretches at the places in a filter of ``place_key``."""
    sent = given.sparkSession.sparkContext.broadcast((repeated, places))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            whole, first, last, row, anchor, start = _found(block, sent.value[0], length, gram)
            ids = pc.fill_null(block.column("doc_id"), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            tkey = block.column("tkey").to_numpy(zero_copy_only=False).astype(np.int64)
            key = tkey[row] ^ (start << 40) ^ (ids[row] << 20)
            own = sketches.in_filter(sent.value[1], key.view(np.uint64))
            texts = [whole[a:b] for a, b in zip(first[own].tolist(), (last[own] + length).tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(anchor[own].view(np.int64)),
                    pa.array(list(map(_digest, texts)), pa.binary()),
                    pa.array(texts, pa.binary()),
                ],
                names=["anchor", "digest", "content"],
            )

    return given.mapInArrow(run, CONTENTS)


def _radix(keys: np.ndarray, top: int) -> np.ndarray:
    """Stable order of non-negative keys below ``top``."""
    if top <= 1 << 16:
        return np.argsort(keys.astype(np.uint16), kind="stable")
    low = np.argsort((keys & 0xFFFF).astype(np.uint16), kind="stable")
    return low[np.argsort((keys[low] >> 16).astype(np.uint16), kind="stable")]


class Shard:
    """The transforms of some strings.

    Of each string the suffixes matter that lie a whole number of symbols behind
    one of its starts.  ``before[k]`` holds the symbols before those that are k
    symbols short of ``length``, in the order of their first k symbols;
    ``order`` holds the starts in their final order.
    """

    def __init__(self, starts: np.ndarray, rank: np.ndarray, top: int, length: int):
        self.before = []
        suffixes = starts + length
        for _ in range(length // SYMBOL_BYTES):
            suffixes = suffixes - SYMBOL_BYTES
            symbols = rank[suffixes]
            self.before.append(symbols)
            suffixes = suffixes[_radix(symbols, top)]
        self.order = suffixes


def symbol_ranks(data: np.ndarray) -> tuple[np.ndarray, int]:
    """(rank of the 16 bytes at every place, number of ranks)."""
    half = SYMBOL_BYTES // 2
    padded = np.concatenate([data, np.zeros(SYMBOL_BYTES, np.uint8)])
    number = np.zeros(len(data) + half, np.uint64)
    for i in range(half):
        number = (number << np.uint64(8)) | padded[i : len(number) + i]
    own = np.unique(number, return_inverse=True)[1].astype(np.int64)
    every, rank = np.unique(own[: len(data)] * np.int64(len(number)) + own[half:], return_inverse=True)
    return rank, len(every)


def repeated_starts(strings: list[bytes], times: list[int], length: int, shard_bytes: int) -> list[np.ndarray]:
    """For every string, which of its starts begin a string of ``length`` bytes that occurs again.

    ``times`` says how often each string itself occurs.
    """
    if length % SYMBOL_BYTES:
        raise ValueError(f"length must be a multiple of {SYMBOL_BYTES}")
    if not strings:
        return []
    sizes = np.array([len(s) for s in strings], np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    rank, top = symbol_ranks(np.frombuffer(b"".join(strings), np.uint8))
    counts = sizes - length + 1
    firsts = np.concatenate([[0], np.cumsum(counts)])
    starts = np.arange(firsts[-1]) + np.repeat(offsets[:-1] - firsts[:-1], counts)
    owner = offsets[:-1] // shard_bytes
    cuts = firsts[np.concatenate([[0], np.flatnonzero(np.diff(owner)) + 1, [len(strings)]])]
    shards = [Shard(starts[a:b], rank, top, length) for a, b in zip(cuts[:-1], cuts[1:])]

    kind = np.uint8 if len(shards) <= 256 else np.uint16 if len(shards) <= 1 << 16 else np.int64
    source = np.repeat(np.arange(len(shards)).astype(kind), np.diff(cuts))
    interval = np.zeros(len(starts), np.int64)
    flat = np.arange(len(starts))
    for k in range(length // SYMBOL_BYTES):
        # The i-th suffix of a shard in the interleave is the i-th of the shard's own order.
        symbols = np.concatenate([s.before[k] for s in shards])[flat]
        moved = _radix(symbols, top)
        source, rest, first = source[moved], interval[moved], symbols[moved]
        # Neighbours part where their first symbols differ or what follows had parted before.
        parts = np.zeros(len(starts), bool)
        parts[1:] = (first[1:] != first[:-1]) | (rest[1:] != rest[:-1])
        interval = np.cumsum(parts)
        flat = np.empty(len(starts), np.int64)
        flat[np.argsort(source, kind="stable")] = np.arange(len(starts))
    order = np.concatenate([s.order for s in shards])[flat]
    string = np.searchsorted(offsets, order, "right") - 1
    total = np.bincount(interval, np.array(times, np.int64)[string])
    flags = np.zeros(len(starts), bool)
    flags[order - offsets[string] + firsts[string]] = total[interval] > 1
    return np.split(flags, firsts[1:-1])


FATES = "anchor long, digest binary, flags binary"


def _bucket(length: int, shard_bytes: int):
    """A bucket's rows are strings with their number, and contents; both meet here."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.select(["anchor", "digest", "n", "content"]).to_pylist()
        own = {(r["anchor"], r["digest"]): r["content"] for r in rows if r["content"] is not None}
        known = [r for r in rows if r["n"] is not None]
        strings = [own[r["anchor"], r["digest"]] for r in known]
        flags = repeated_starts(strings, [r["n"] for r in known], length, shard_bytes)
        return pa.table(
            [
                pa.array([r["anchor"] for r in known], pa.int64()),
                pa.array([r["digest"] for r in known], pa.binary()),
                pa.array([np.packbits(f).tobytes() for f in flags], pa.binary()),
            ],
            names=["anchor", "digest", "flags"],
        )

    return run


def _windows(strings: DataFrame, length: int) -> DataFrame:
    """Fates of strings whose anchor is hot: their windows are counted by digest."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for anchor, digest, content, n in zip(
                *(batch.column(c).to_pylist() for c in ("anchor", "digest", "content", "n"))
            ):
                count = len(content) - length + 1
                keys = [_digest(content[i : i + length]) for i in range(count)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([anchor] * count, pa.int64()), pa.array([digest] * count, pa.binary()),
                        pa.array(range(count), pa.int32()), pa.array(keys, pa.binary()), pa.array([n] * count, pa.int64()),
                    ],
                    names=["anchor", "digest", "i", "window", "n"],
                )

    each = strings.mapInArrow(run, "anchor long, digest binary, i int, window binary, n long")
    again = each.groupBy("window").agg(F.sum("n").alias("total")).filter("total > 1")
    found = each.join(again, "window", "left").groupBy("anchor", "digest").agg(
        F.array_sort(F.collect_list(F.struct("i", F.col("total").isNotNull().alias("again")))).alias("all")
    )

    def packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flags = [np.array([x["again"] for x in row], bool) for row in batch.column("all").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("anchor"), batch.column("digest"),
                    pa.array([np.packbits(f).tobytes() for f in flags], pa.binary()),
                ],
                names=["anchor", "digest", "flags"],
            )

    return found.mapInArrow(packed, FATES)


def repeated_stretches(
    given: DataFrame,
    length: int = LENGTH,
    gram: int = ANCHOR_BYTES,
    shard_bytes: int = SHARD_BYTES,
    bucket_bytes: int = BUCKET_BYTES,
    hot: int = HOT_STRINGS,
) -> DataFrame:
    """(doc_id, tkey, start, starts, flags): stretches with the starts of repeated strings as bits.

    Null flags mean all starts.
    """
    spark = given.sparkSession
    twice = anchors(given, length, gram).groupBy("anchor").agg(F.sum("n").alias("n")).filter("n > 1")
    repeated = sketches.bit_filter(twice, "anchor", FILTER_BITS)
    found = written(stretches(given, repeated, length, gram), "stretches")
    place = F.struct("doc_id", "tkey", "start")
    strings = found.groupBy("anchor", "digest").agg(
        F.count("*").alias("n"), F.first("starts").alias("starts"), F.min(place).alias("place")
    )
    strings = written(strings, "strings")
    by_anchor = strings.groupBy("anchor").agg(
        F.sum("n").alias("total"), F.count("*").alias("different"),
        F.sum(F.col("starts") + (length - 1)).alias("bytes"),
    ).filter("total > 1")
    by_anchor = written(by_anchor, "string-anchors")
    # One string that occurs again: each of its starts does.
    alone = strings.join(by_anchor.filter("different = 1").select("anchor"), "anchor").select(
        "anchor", "digest", F.lit(None).cast("binary").alias("flags")
    )
    many = strings.select("anchor", "digest", "n", "place").join(
        by_anchor.filter("different > 1").select("anchor", "different"), "anchor"
    )
    # The bytes of each different string come from one of its places.
    keys = many.select(place_key(*(F.col(f"place.{c}") for c in ("doc_id", "tkey", "start"))).alias("key"))
    places = sketches.bit_filter(keys, "key", FILTER_BITS)
    spelled = written(contents(given, repeated, places, length, gram), "string-bytes")
    groups = max(1, int((by_anchor.filter("different > 1").agg(F.sum("bytes")).first()[0] or 0) // bucket_bytes))
    bucket = F.pmod(F.xxhash64("anchor"), F.lit(groups)).alias("bucket")
    cool = by_anchor.filter(f"different between 2 and {hot}").select("anchor")
    merged = (
        many.filter(f"different <= {hot}").select(bucket, "anchor", "digest", "n", F.lit(None).cast("binary").alias("content"))
        .unionByName(
            spelled.join(cool, "anchor", "left_semi").select(
                bucket, "anchor", "digest", F.lit(None).cast("long").alias("n"), "content"
            )
        )
        .groupBy("bucket")
        .applyInArrow(_bucket(length, shard_bytes), FATES)
    )
    hottest = many.filter(f"different > {hot}").select("anchor", "digest", "n").join(
        spelled.dropDuplicates(["anchor", "digest"]), ["anchor", "digest"]
    )
    fates = alone.unionByName(merged).unionByName(_windows(hottest, length))
    path = work_path(spark, "string-fates")
    fates.write.parquet(path)
    fates = spark.read.schema(FATES).parquet(path)
    return found.join(fates, ["anchor", "digest"]).select("doc_id", "tkey", "start", "starts", "flags")


def _covered(size: int, marks: list[dict], length: int) -> np.ndarray:
    """Bytes of a text that some repeated string covers."""
    if not marks:
        return np.zeros(size, bool)
    edges = np.zeros(size + 1, np.int32)
    for m in marks:
        start, starts = m["start"], m["starts"]
        if m["flags"] is None:
            edges[start] += 1
            edges[start + starts - 1 + length] -= 1
            continue
        # The starts of a mark are all different, so plain indexing counts each.
        flags = np.unpackbits(np.frombuffer(m["flags"], np.uint8), count=starts)
        at = start + np.flatnonzero(flags)
        edges[at] += 1
        edges[at + length] -= 1
    return np.cumsum(edges[:-1], dtype=np.int32) > 0


def without_repeats(
    docs: DataFrame,
    derive,
    schema: str,
    columns: list[str] | None = None,
    text: str = "text",
    key: str = "doc_id",
    length: int = LENGTH,
    **options,
) -> DataFrame:
    """``row`` (the input's columns) and what ``derive(bytes, covered)`` makes of each text.

    ``covered`` flags the bytes that a repeated string of ``length`` bytes covers.
    """
    given = docs.select(
        F.col(key).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("tkey"), F.col(text).alias("text")
    )
    marks = repeated_stretches(given, length, **options)
    marks = marks.distinct().groupBy(
        F.coalesce("doc_id", F.lit(0)).alias("k"), F.col("doc_id").isNull().alias("none"), "tkey"
    ).agg(F.collect_list(F.struct("start", "starts", "flags")).alias("marks"))
    rows = docs.select(
        F.struct(*(columns or docs.columns)).alias("row"),
        F.coalesce(F.col(key).cast("long"), F.lit(0)).alias("k"),
        F.col(key).isNull().alias("none"),
        F.xxhash64(F.col(text)).alias("tkey"),
        F.col(text).alias("text"),
    ).join(marks, ["k", "none", "tkey"], "left").select("row", "text", "marks")
    kind = rows.schema["row"].dataType.simpleString()
    fields = [f.split() for f in schema.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            made = []
            for own, here in zip(block.column("text").to_pylist(), block.column("marks").to_pylist()):
                own = (own or "").encode()
                made.append(derive(own, _covered(len(own), here or [], length)))
            yield pa.RecordBatch.from_arrays(
                [block.column("row"), *(pa.array(list(c), kinds[k]) for c, (_, k) in zip(zip(*made), fields))],
                names=["row", *(name for name, _ in fields)],
            )

    return rows.mapInArrow(run, f"row {kind}, {schema}")


def kept_bytes(own: bytes, covered: np.ndarray) -> bytes:
    return np.frombuffer(own, np.uint8)[~covered].tobytes()


def dedup_passages(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents with their texts cut; letters of which bytes are missing go as well."""
    cut = without_repeats(
        docs,
        lambda own, covered: (kept_bytes(own, covered).decode(errors="ignore"),),
        "kept string",
        text=text,
        **options,
    )
    return cut.select(*(F.col("kept").alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns))

"""Byte-level BPE over a corpus, each distinct word encoded once.

Texts are split into pre-tokens block by block.  A block (a few MB of text)
keeps, for every document, the numbers of its words by position, and its
distinct words.  The words of all blocks meet in one shuffle by word, where each
distinct word is encoded once; the ids go back to the blocks, which put every
document together by position.  A word that is frequent everywhere costs one
row for each block, so no word is hot.

Decoding joins the token-byte table, whose size is that of the vocabulary.

Defined results: a null text is empty and has no ids; null and repeated keys
keep all their rows; an empty table gives an empty result; only ``key`` and
``text`` of the input are read, so other columns may have any name.
"""

from __future__ import annotations

import base64
import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmill.llm.text import blocks
from seriesmill.llm.tokens import PLAIN, Memo, space_chunks

BLOCK_BYTES = 4 << 20
#: Words are dealt to so many groups for each shuffle partition.
GROUPS = 4

# One row for a document (``part`` null: its key and word numbers) or for the words of a block
# that belong to one group of words.
EXPLODED = "block long, part int, row int, doc_id long, payload binary"
ANSWERED = "block long, part int, payload binary"


def read_ranks(lines: bytes) -> dict[bytes, int]:
    """Token bytes to id, from the text of a rank file."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines.splitlines() if line)}


@lru_cache(maxsize=2)
def word_encoder(lines: bytes, pattern: str):
    """The encoder of a rank file, one for each worker."""
    import tiktoken

    return tiktoken.Encoding(
        "ranks", pat_str=pattern, mergeable_ranks=read_ranks(lines), special_tokens={}
    )


@lru_cache(maxsize=2)
def token_bytes(lines: bytes) -> list[bytes]:
    """Token bytes by id; ids without a token have none."""
    ranks = read_ranks(lines)
    out = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, i in ranks.items():
        out[i] = token
    return out


def _squeezed(numbers: np.ndarray) -> bytes:
    """Numbers as their low, then their high bytes, compressed."""
    width = 2 if not len(numbers) or int(numbers.max()) < 1 << 16 else 4
    planes = numbers.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def _numbers(payload: bytes) -> np.ndarray:
    width = payload[0]
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(payload[1:]), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(f"<u{width}").ravel().astype(np.int64)


def _pack_words(words: list[bytes]) -> bytes:
    lengths = np.array([len(w) for w in words], "<u4")
    whole = np.array([len(words)], "<u4").tobytes() + lengths.tobytes() + b"".join(words)
    return zstandard.ZstdCompressor(level=3).compress(whole)


def _unpack_words(payload: bytes) -> list[bytes]:
    payload = zstandard.ZstdDecompressor().decompress(payload)
    n = int(np.frombuffer(payload, "<u4", 1)[0])
    ends = np.cumsum(np.frombuffer(payload, "<u4", n, 4)) + 4 + 4 * n
    return [payload[a:b] for a, b in zip([4 + 4 * n, *ends[:-1].tolist()], ends.tolist())]


def _pack_ids(ids: list[bytes]) -> bytes:
    """Ids of several words: how many each has, and all of them."""
    lengths = _squeezed(np.array([len(x) // 4 for x in ids], np.int64))
    return len(lengths).to_bytes(4, "little") + lengths + _squeezed(np.frombuffer(b"".join(ids), "<u4"))


def _unpack_ids(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    end = 4 + int.from_bytes(payload[:4], "little")
    return _numbers(payload[4:end]), _numbers(payload[end:])


def pretokens(chunk: str, split: regex.Pattern) -> list[str]:
    """The pre-tokens of a piece between safe cuts; words of plain letters need no pattern."""
    body = chunk[1:] if chunk[:1] == " " else chunk
    if body and (body.isascii() or PLAIN.match(body)):
        if body.isalpha():
            return [chunk]
        if body[-1] in ".," and body[:-1].isalpha():
            return [chunk[:-1], body[-1]]
    return split.findall(chunk)


def _explode(groups: int, pattern: str, positions: bool):
    """Documents to word numbers by position, or else words by group.

    Both number the words of a block alike.  For the words each distinct piece is looked at once.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = regex.compile(pattern)
        number = TaskContext.get().partitionId() << 32
        for block in blocks(batches, "text", BLOCK_BYTES):
            words: dict[str, int] = {}

            def numbers(chunk: str) -> bytes:
                return array("I", [words.setdefault(w, len(words)) for w in pretokens(chunk, split)]).tobytes()

            memo = Memo(numbers)
            texts = block.column("text").to_pylist()
            if positions:
                streams = [
                    np.frombuffer(b"".join(map(memo.__getitem__, space_chunks(t))) if t else b"", np.uint32)
                    for t in texts
                ]
            else:
                pieces: dict[str, None] = {}
                for t in texts:
                    pieces.update(dict.fromkeys(space_chunks(t) if t else ()))
                for chunk in pieces:
                    for w in pretokens(chunk, split):
                        words.setdefault(w, len(words))
            spelled = [w.encode() for w in words]
            part = np.array([zlib.crc32(w) for w in spelled], np.int64) % groups
            order = np.argsort(part, kind="stable")
            if positions:
                # Number the words by group, so that the groups' answers line up end to end.
                place = np.empty(len(order), np.uint32)
                place[order] = np.arange(len(order), dtype=np.uint32)
                rows = [
                    (number, None, i, key, _squeezed(place[s]))
                    for i, (key, s) in enumerate(zip(block.column("doc_id").to_pylist(), streams))
                ]
            else:
                cuts = np.searchsorted(part[order], np.arange(groups + 1))
                rows = [
                    (number, p, None, None, _pack_words([spelled[i] for i in order[cuts[p] : cuts[p + 1]]]))
                    for p in np.flatnonzero(np.diff(cuts)).tolist()
                ]
            yield _batch(rows, EXPLODED)
            number += 1

    return run


_KINDS = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32())}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    columns = zip(*rows) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), _KINDS[kind]) for c, (_, kind) in zip(columns, fields)],
        names=[name for name, _ in fields],
    )


def _encode_words(lines: bytes, pattern: str):
    """All blocks' words of one group: each distinct one is encoded once."""

    def run(table: pa.Table) -> pa.Table:
        encoding = word_encoder(lines, pattern)
        ids: dict[bytes, bytes] = {}
        rows = []
        for block, part, payload in zip(
            *(table.column(c).to_pylist() for c in ("block", "part", "payload"))
        ):
            found = []
            for word in _unpack_words(payload):
                own = ids.get(word)
                if own is None:
                    own = np.array(encoding.encode_ordinary(word.decode()), "<u4").tobytes()
                    ids[word] = own
                found.append(own)
            rows.append((block, part, _pack_ids(found)))
        return pa.Table.from_batches([_batch(rows, ANSWERED)])

    return run


def _assemble(table: pa.Table) -> pa.Table:
    """One block: the words' ids in order of their numbers, then every document by position."""
    rows = table.select(["part", "row", "doc_id", "payload"]).to_pylist()
    answers = sorted((r for r in rows if r["part"] is not None), key=lambda r: r["part"])
    found = [_unpack_ids(r["payload"]) for r in answers] or [(np.zeros(0, np.int64),) * 2]
    lengths, flat = (np.concatenate(x) for x in zip(*found))
    flat = flat.astype(np.int32)
    firsts = np.cumsum(lengths) - lengths
    keys, ids = [], []
    for r in sorted((r for r in rows if r["part"] is None), key=lambda r: r["row"]):
        numbers = _numbers(r["payload"])
        if len(numbers) and int(numbers.max()) >= len(lengths):
            raise ValueError("a block lacks words: its texts changed between two reads")
        own = lengths[numbers]
        ends = np.cumsum(own)
        at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(firsts[numbers] - (ends - own), own)
        keys.append(r["doc_id"])
        ids.append(flat[at])
    ends = np.cumsum([0, *map(len, ids)])
    every = np.concatenate(ids) if ids else np.zeros(0, np.int32)
    return pa.table(
        {
            "doc_id": pa.array(keys, pa.int64()),
            "ids": pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(every)),
        }
    )


def encode(
    docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """(doc_id, ids) of every row.

    ``docs`` is read twice, once for the words and once for the positions, and
    must give the same rows in the same partitions each time, as a table of
    files does; a block whose words don't fit its positions ends the job.
    """
    spark = docs.sparkSession
    with open(ranks_path, "rb") as file:
        lines = file.read()
    groups = GROUPS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    given = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    words = given.mapInArrow(_explode(groups, pattern, False), EXPLODED).select("block", "part", "payload")
    answers = words.groupBy("part").applyInArrow(_encode_words(lines, pattern), ANSWERED)
    rows = given.mapInArrow(_explode(groups, pattern, True), EXPLODED)
    both = rows.unionByName(answers, allowMissingColumns=True)
    return both.groupBy("block").applyInArrow(_assemble, "doc_id long, ids array<int>")


def token_table(spark: SparkSession, ranks_path: str) -> DataFrame:
    """(id, bytes) of every token of a rank file."""
    with open(ranks_path, "rb") as file:
        rows = [(i, bytearray(token)) for token, i in read_ranks(file.read()).items()]
    return spark.createDataFrame(rows, "id int, bytes binary")


def with_decoded(rows: DataFrame, ranks_path: str, derive, schema: str) -> DataFrame:
    """Rows of (doc_id, ids) with what ``derive(ids, bytes)`` makes of the ids and their decoded bytes.

    The token-byte table goes to every task: it has one row for each token of
    the vocabulary, whatever the corpus.
    """
    with open(ranks_path, "rb") as file:
        lines = file.read()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_bytes(lines)
        for batch in batches:
            made = []
            values = batch.column("ids").values.to_numpy(zero_copy_only=False)
            ends = batch.column("ids").offsets.to_numpy()
            for key, a, b in zip(batch.column("doc_id").to_pylist(), ends[:-1], ends[1:]):
                ids = values[a:b].tolist()
                made.append((key, *derive(ids, b"".join(map(table.__getitem__, ids)))))
            columns = list(zip(*made)) or [()] * len(schema.split(", "))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(c), pa.string() if f.endswith("string") else pa.binary() if f.endswith("binary") else pa.int64())
                    for c, f in zip(columns, schema.split(", "))
                ],
                names=[f.split()[0] for f in schema.split(", ")],
            )

    return rows.mapInArrow(run, schema)


def decode(rows: DataFrame, ranks_path: str) -> DataFrame:
    """(doc_id, bytes) of rows of (doc_id, ids)."""
    return with_decoded(rows, ranks_path, lambda ids, text: (text,), "doc_id long, bytes binary")

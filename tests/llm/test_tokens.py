"""Byte-level BPE, token files and packing against the tokenizer libraries."""

import base64
import types
import zlib
from collections import Counter, defaultdict

import fixtures
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from seriesmill.llm import bpe, packing, queries, token_files, tokens
from seriesmill.llm.tokens import TextEncoder

ODD = [
    "", "  a  b\n\n c", "\n x", "a\xa0b", "it's  don't\t\tx ", "ÀÉ İstanbul ΣΑΣ 日本語 テ", "a\x1cb c", "é x", "ﬁ ½ ² ª º",
    "<|endoftext|> <|startoftext|>x", "a \n b", " lead", "tr  ", "１２ 12", "\x85x y", " x　y", "\0 a\0b c",
    "word, Word. WORD word.", "., ,. a, b.", "l'été œuvre",
]


def library(name):
    out = Tokenizer.from_file(public_tokenizers.path(name))
    out.encode_special_tokens = True
    return out


@pytest.fixture(scope="module")
def ranks():
    with open(queries.BYTE_RANKS, "rb") as file:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_memo_encoder_equals_the_library(spark, name):
    own, whole = TextEncoder(public_tokenizers.path(name)), library(name)
    for text in ODD + [t for _, t in fixtures.texts(spark)] + [fixtures.LONG]:
        assert own.encode(text).tolist() == whole.encode(text, add_special_tokens=False).ids, text[:80]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_rows_are_encoded_as_each_alone(spark, name):
    own, whole = TextEncoder(public_tokenizers.path(name)), library(name)
    odd = ["a \x85b", "a \u2003b c", "a  \u3000 b", "x ", " y", "x \n", " ", None, "", "a \x1cb", " É", "日 本 "]
    texts = ODD + odd + [t for _, t in fixtures.texts(spark)][:300] + odd[::-1]
    column = pa.array(["before", *texts], pa.string())[1:]
    ids, ends = own.encode_rows(column)
    assert len(ends) == len(texts) + 1 and ends[0] == 0 and ends[-1] == len(ids)
    for text, a, b in zip(texts, ends, ends[1:]):
        assert ids[a:b].tolist() == whole.encode(text or "", add_special_tokens=False).ids, text
    ids, ends = own.encode_rows(pa.array([], pa.string()))
    assert len(ids) == 0 and ends.tolist() == [0]


def test_a_block_looks_up_each_piece_once(monkeypatch):
    class Counted(dict):
        asked = 0

        def __missing__(self, key):
            Counted.asked += 1
            return np.array([len(key)], np.uint32).tobytes()

    own = TextEncoder(queries.BYTE_JSON)
    own.ids = Counted()
    block = pa.record_batch([pa.array(["one two", "one two two", None, "one"])], names=["text"])
    monkeypatch.setattr(tokens, "encoder", lambda path: own)
    ((_, ids, ends),) = tokens.encoded([block], "text", queries.BYTE_JSON)
    assert Counted.asked == 2
    assert ids.tolist() == [3, 4, 2, 3, 4, 4, 2, 2, 3, 2] and ends.tolist() == [0, 3, 7, 8, 10]


def test_memo_keeps_its_bound(monkeypatch):
    from seriesmill.llm import tokens

    monkeypatch.setattr(tokens, "MEMO_WORDS", 10)
    own, whole = TextEncoder(queries.BYTE_JSON), library("byte_bpe_50k.json")
    assert own.encode(fixtures.LONG).tolist() == whole.encode(fixtures.LONG, add_special_tokens=False).ids
    assert len(own.ids) <= 11 and len(own.ids.old) <= 11


def test_op1_equals_the_library(spark, ranks):
    found = {r["doc_id"]: r for r in queries.op1_byte_bpe(spark, fixtures.SF).collect()}
    for key, text in fixtures.texts(spark):
        ids = ranks.encode_ordinary(text)
        row = found.pop(key)
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == fixtures.sha(" ".join(map(str, ids)).encode())
        assert row["decoded_sha256"] == fixtures.sha(text.encode())
    assert not found


def test_bpe_edges(spark, ranks, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_BYTES", 500)
    docs = fixtures.edges(spark, clashing=True).repartition(3)
    docs = spark.createDataFrame(docs.collect(), docs.schema)
    ids = bpe.encode(docs, queries.BYTE_RANKS, public_tokenizers.PATTERN)
    found = Counter((r["doc_id"], tuple(r["ids"])) for r in ids.collect())
    assert found == Counter((key, tuple(ranks.encode_ordinary(text or ""))) for key, text, *_ in fixtures.EDGES)
    decoded = Counter((r["doc_id"], bytes(r["bytes"])) for r in bpe.decode(ids, queries.BYTE_RANKS).collect())
    assert decoded == Counter((key, (text or "").encode()) for key, text, *_ in fixtures.EDGES)
    assert bpe.encode(fixtures.empty(spark), queries.BYTE_RANKS, public_tokenizers.PATTERN).count() == 0


def test_words_and_positions_are_made_apart(monkeypatch):
    texts = ["the cat, the mat", None, "the cat\n sat on  the cat", ""]
    block = pa.RecordBatch.from_pydict({"doc_id": pa.array([1, 2, 3, 4]), "text": pa.array(texts, pa.string())})
    monkeypatch.setattr(bpe.TaskContext, "get", lambda: types.SimpleNamespace(partitionId=lambda: 0))
    made = {
        positions: [r for b in bpe._explode(3, public_tokenizers.PATTERN, positions)([block]) for r in b.to_pylist()]
        for positions in (True, False)
    }
    assert [r["part"] for r in made[True]] == [None] * 4 and all(r["part"] is not None for r in made[False])
    words = [w for r in sorted(made[False], key=lambda r: r["part"]) for w in bpe._unpack_words(r["payload"])]
    spelled = [b"".join(words[i] for i in bpe._numbers(r["payload"])).decode() for r in made[True]]
    assert spelled == [t or "" for t in texts] and len(set(words)) == len(words)


def test_token_table_is_the_vocabulary(spark):
    assert bpe.token_table(spark, queries.BYTE_RANKS).count() == 50_256


def test_op5_starts_follow_doc_id(spark):
    whole, start = library("byte_bpe_50k.json"), 0
    found = {r["doc_id"]: r for r in queries.op5_token_files(spark, fixtures.SF).collect()}
    for key, text in fixtures.texts(spark):
        ids = np.array(whole.encode(text, add_special_tokens=False).ids + [2], "<u4")
        row = found.pop(key)
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (start, len(ids), zlib.crc32(ids))
        start += len(ids)
    assert not found


def test_token_files_edges_and_selective_reads(spark, tmp_path):
    import pyarrow.parquet as pq

    docs = fixtures.edges(spark, clashing=True)
    path = str(tmp_path / "files")
    token_files.write_tokens(docs, path, queries.BYTE_JSON, page_bytes=1024)
    rows = token_files.read_tokens(spark, path).collect()
    whole = library("byte_bpe_50k.json")
    wanted = Counter((k, tuple(whole.encode(t or "", add_special_tokens=False).ids + [2])) for k, t, *_ in fixtures.EDGES)
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in rows) == wanted
    ordered = sorted(rows, key=lambda r: r["start"])
    assert [r["doc_id"] for r in ordered] == sorted((k for k, *_ in fixtures.EDGES), key=lambda k: -1 if k is None else k)
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(ordered, ordered[1:]))
    one = token_files.read_tokens(spark, path, condition="doc_id = 8", columns=["doc_id", "start"])
    assert [r["start"] for r in one.collect()] == [r["start"] for r in ordered if r["doc_id"] == 8]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "ids:array" not in plan and "EqualTo(doc_id,8)" in plan
    file = next(f for f in (tmp_path / "files").glob("*.parquet") if pq.ParquetFile(f).metadata.num_rows)
    group = pq.ParquetFile(file).metadata.row_group(0)
    columns = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
    assert any("RLE_DICTIONARY" in c.encodings for c in columns.values())
    assert all(c.has_column_index for n, c in columns.items() if n in ("doc_id", "n_tokens"))
    token_files.write_tokens(fixtures.empty(spark), str(tmp_path / "none"), queries.BYTE_JSON)
    assert token_files.read_tokens(spark, str(tmp_path / "none")).count() == 0


def check_packed(rows, texts, size, whole):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"], r["doc_tokens"]].append(r)
        sequences[r["sequence_id"]].append(r)
    for own in sequences.values():
        end = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == end
            end += r["length"]
        assert end <= size
    seen = Counter()
    for key, text in texts:
        ids = np.array(whole.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        seen[key, len(ids)] += 1
        own = [r for r in pieces[key, len(ids)]]
        cuts = [(s, min(size, len(ids) - s)) for s in range(0, len(ids), size)]
        crcs = Counter((r["start"], r["length"], r["ids_crc32"]) for r in own)
        assert all(crcs[s, n, zlib.crc32(ids[s : s + n])] for s, n in cuts)
    for (key, tokens), times in seen.items():
        assert sum(r["length"] for r in pieces[key, tokens]) == tokens * times
    return len(sequences)


def test_op4_places_every_id_once(spark):
    rows = queries.op4_packing(spark, fixtures.SF).collect()
    whole = library("word_bpe_49k.json")
    sequences = check_packed(rows, fixtures.texts(spark), 4096, whole)
    assert sum(r["length"] for r in rows) > 0.9 * 4096 * (sequences - 1)


def test_packing_edges(spark):
    whole = library("word_bpe_49k.json")
    texts = [(k, t) for k, t, *_ in fixtures.EDGES]
    docs = fixtures.edges(spark, clashing=True)
    check_packed(packing.pack_documents(docs, queries.WORD_JSON, size=64).collect(), texts, 64, whole)
    assert packing.pack_documents(fixtures.empty(spark), queries.WORD_JSON).count() == 0


def test_patterns_place_the_histogram():
    draw = np.random.default_rng(3)
    for size in (8, 50, 4096):
        histogram = Counter(draw.integers(1, size + 1, 400).tolist())
        packed = packing.patterns(histogram, size)
        placed = Counter()
        for lengths, count in packed:
            assert count > 0 and sum(lengths) <= size
            for n in lengths:
                placed[n] += count
        assert placed == histogram
        slots = packing.slots(packed)
        assert sum(b - a + 1 for _, a, b, *_ in slots) == sum(histogram.values())
    assert packing.patterns({}, 8) == []


def test_packing_ranks_across_tasks(spark):
    docs = spark.range(900).selectExpr("id doc_id", "repeat('word ', cast(id % 3 as int)) text").repartition(7)
    docs = spark.createDataFrame(docs.collect(), docs.schema)
    rows = packing.pack_documents(docs, queries.WORD_JSON, size=4).collect()
    check_packed(rows, [(r["doc_id"], r["text"]) for r in docs.collect()], 4, library("word_bpe_49k.json"))
    assert len({r["sequence_id"] for r in rows}) == 450

"""Token ids by the public tokenizer files, each distinct word encoded once per worker."""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex

from seriesmill.llm.text import blocks, text_bytes, trim

# How the two tokenizer files split a text (see their ``pre_tokenizer``).
BYTE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"""

END_ID = 2
#: Words in each of two generations of a byte-level memo of this module; other memos hold half as many.
MEMO_WORDS = 300_000
#: Bytes of text whose distinct pieces are looked up together.
BLOCK_BYTES = 2 << 20

# Characters on which every library agrees about letters, case and white space.
PLAIN = re.compile(r"[\n\r\t\x20-\x7e\xa1-įı-ɏ]*\Z")
_WIDE = re.compile(r" (?=\s|\Z)")
_BEFORE_WORD = re.compile(r"(?= \S)")
_SEPARATORS = re.compile(r"[\x1c-\x1f]")
# Bytes that surely start no white space: ASCII white space, and first bytes of other white space, are out.
_STARTS_WORD = np.ones(256, bool)
_STARTS_WORD[[*range(9, 14), *range(28, 33), 0xC2, 0xE1, 0xE2, 0xE3]] = False
_ASCII = np.arange(256)
_ENDS_WORD = (_ASCII > 32) & (_ASCII < 127)
_LETTER = np.array([chr(i).isalpha() and i < 128 for i in range(256)])
_MARK = _ENDS_WORD & np.array([not chr(i).isalnum() for i in range(256)])


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return [chr(b if b in own else 256 + rest.index(b)) for b in range(256)]


def space_chunks(text: str) -> list[str]:
    """The text cut before every single space that a word follows.

    No pre-token of the byte-level patterns crosses such a cut, and a piece
    splits alone as it does in its text.
    """
    if "\0" not in text and not _WIDE.search(text):
        return text.replace(" ", "\0 ").split("\0")
    return _BEFORE_WORD.split(text)


def piece_cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pieces of all rows begin, and the end.

    Cuts are safe as those of ``space_chunks``: before a space that a word follows, before
    a punctuation mark after a letter, and around a line break between two words.
    """
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    blanks, breaks = (x[~edge[x + 1]] for x in (np.flatnonzero(data == 32), np.flatnonzero(data == 10)))
    blanks = blanks[_STARTS_WORD[data[blanks + 1]]]
    breaks = breaks[_STARTS_WORD[data[breaks + 1]] & _ENDS_WORD[data[breaks - 1]] & (breaks > 0)]
    edge[1:-1] |= _LETTER[data[:-1]] & _MARK[data[1:]]
    for at in (blanks, breaks, breaks + 1):
        edge[at] = True
    return np.flatnonzero(edge)


class Memo(dict):
    """A bounded cache in two generations: when the young one is full the old one goes."""

    def __init__(self, make, words: int = MEMO_WORDS // 2):
        super().__init__()
        self.make, self.words, self.old = make, words, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.words:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class TextEncoder:
    """Ids of whole texts, as ``encode(text, add_special_tokens=False)`` gives them.

    Strings of special tokens count as ordinary text.  Pieces of a text between
    safe cuts are looked up in a bounded memo; new ones go through the
    library's model, and through the whole library where they hold characters
    outside the plain Latin ranges.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        self.model = self.whole.model
        self.by_word = self.model.end_of_word_suffix == "</w>"
        self.pattern = regex.compile(WORD_PATTERN if self.by_word else BYTE_PATTERN)
        self.letters = byte_letters()
        self.ids = Memo(self._ids, MEMO_WORDS // 2 if self.by_word else MEMO_WORDS)

    # Ids are kept as bytes of 32-bit numbers: small, and cheap to join.
    def _model_ids(self, word: str) -> bytes:
        if word.isascii():
            letters = word.replace(" ", "\u0120")
        else:
            letters = "".join(map(self.letters.__getitem__, word.encode()))
        return array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()

    def _ids(self, piece: str) -> bytes:
        """Ids of a piece between safe cuts, or of a pre-token, which is a piece as well."""
        own = piece.lower() if self.by_word else piece
        body = own[1:] if own[0] == " " else own
        if not (piece.isascii() or PLAIN.match(piece)):
            return array("I", self.whole.encode(piece, add_special_tokens=False).ids).tobytes()
        if body.isalpha():
            return self._model_ids(own) if own == piece else self.ids[own]
        if body[-1:] in ".," and body[:-1].isalpha():
            return self.ids[own[:-1]] + self.ids[own[-1]]
        if not PLAIN.match(piece):
            return array("I", self.whole.encode(piece, add_special_tokens=False).ids).tobytes()
        words = self.pattern.findall(own)
        if len(words) == 1 and words[0] == piece and (piece.isprintable() or not piece.isascii()):
            return self._model_ids(piece)
        if len(words) == 1:
            return array("I", self.whole.encode(piece, add_special_tokens=False).ids).tobytes()
        return b"".join([self.ids[w] for w in words])

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.uint32)
        if not self.by_word:
            chunks = filter(None, space_chunks(text))
        elif _SEPARATORS.search(text):
            chunks = [text]
        else:
            chunks = text.split()
        return np.frombuffer(b"".join(map(self.ids.__getitem__, chunks)), np.uint32)

    def encode_rows(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, n + 1 offsets of the rows in them); a null row is empty.

        Each distinct piece of the rows is looked up once.
        """
        if self.by_word:
            rows = [self.encode(t or "") for t in column.to_pylist()]
            ends = np.cumsum([0, *map(len, rows)])
            return np.concatenate([np.zeros(0, np.uint32), *rows]), ends
        data, offsets = text_bytes(column)
        cuts = piece_cuts(data, offsets)
        pieces = pa.Array.from_buffers(
            pa.large_string(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(data)]
        ).dictionary_encode()
        own = list(map(self.ids.__getitem__, pieces.dictionary.to_numpy(zero_copy_only=False)))
        each = np.frombuffer(b"".join(own), np.uint32)
        lengths = np.fromiter(map(len, own), np.int64, len(own)) // 4
        at = pieces.indices.to_numpy()
        here = lengths[at]
        ends = np.concatenate([[0], np.cumsum(here)])
        shift = (np.cumsum(lengths) - lengths)[at] - ends[:-1]
        return each[np.arange(ends[-1]) + np.repeat(shift, here)], ends[np.searchsorted(cuts, offsets)]


@lru_cache(maxsize=2)
def encoder(path: str) -> TextEncoder:
    """One encoder per Python worker and file."""
    return TextEncoder(path)


def forget() -> None:
    """Drop the encoders that an earlier step has left in this worker; a step without one needs the room."""
    if encoder.cache_info().currsize:
        encoder.cache_clear()
        trim()


def encoded(
    batches: Iterable[pa.RecordBatch], column: str, path: str, end_id: int | None = END_ID
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Blocks of rows with the ids of all their rows and the n + 1 offsets of the rows in them; a null text is empty."""
    own = encoder(path)
    for block in blocks(batches, column, BLOCK_BYTES):
        ids, ends = own.encode_rows(block.column(column))
        if end_id is not None:
            ids = np.insert(ids, ends[1:], end_id)
            ends = ends + np.arange(len(ends))
        yield block, ids, ends

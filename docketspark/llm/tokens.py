"""Token ids of whole texts by a public word tokenizer, each distinct word encoded once.

The tokenizer drops white space and never looks across it, so a text's ids are those of
its blank-separated chunks in order. A chunk of letters with signs behind it is taken as
these two pieces, any other chunk as one. Texts are taken apart as arrays of bytes, a batch
at a time; Python sees each distinct piece of a batch once, and a task remembers the ids of
pieces it has met. Letters are encoded by the tokenizer's own model, other pieces by the
whole tokenizer. A text that holds the string of an added token goes through the tokenizer
as a whole, which finds it as such.
"""

from __future__ import annotations

import codecs
import os
import re
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from docketspark.llm.common import utf8_column

# Entries of one generation of remembered pieces; two generations are kept.
REMEMBERED = 200_000
# Bytes of text that are taken apart at a time; the arrays for it take some 30 bytes a byte.
SLICE_BYTES = 1 << 21
# Texts of one batch at most.
SLICE_ROWS = 4096

_BLANK, _LETTER, _SIGN, _OTHER = range(4)
_KINDS = np.full(256, _OTHER, np.uint8)
_KINDS[[9, 10, 11, 12, 13, 32]] = _BLANK
_KINDS[list(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")] = _SIGN
_KINDS[[*range(65, 91), *range(97, 123)]] = _LETTER
# The UTF-8 of the letters of Latin-1 is this byte and one that is not of these signs.
_LEAD, _NO_LETTERS = 0xC3, (0x97, 0xB7)
_LETTERS = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
# The letters by which byte-level models name bytes: a printable byte is its own sign, the
# others are numbered from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_OTHERS = [b for b in range(256) if b not in _PRINTABLE]
_NUMBERS = {b: 256 + i for i, b in enumerate(_OTHERS)}
_BYTE_LETTERS = "".join(chr(_NUMBERS.get(b, b)) for b in range(256))


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def as_bytes(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit."""
    packed = array("I", ids)
    if sys.byteorder != "little":
        packed.byteswap()
    return packed.tobytes()


class Remembered(dict):
    """A mapping that computes missing values and forgets those not used for long."""

    def __init__(self, compute, size: int = REMEMBERED):
        super().__init__()
        self.compute, self.size, self.older = compute, size, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


def _slices(data: np.ndarray, offsets: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of about ``size`` bytes that end where a text does or before a blank."""
    first = 0
    while first < len(data):
        last = min(first + size, len(data))
        stop = int(offsets[np.searchsorted(offsets, last)])
        while last < stop:
            blanks = np.flatnonzero(_KINDS[data[last : min(last + size, stop)]] == _BLANK)
            if len(blanks):
                stop = last + int(blanks[0])
            last = min(last + size, stop)
        yield first, last
        first = last


def _pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The pieces of a batch's texts in order, and how many there are before each offset."""
    kind = _KINDS[data]
    leads = np.flatnonzero(data == _LEAD)
    if len(leads):
        kind[leads] = _LETTER
        kind[leads + 1] = np.where(np.isin(data[leads + 1], _NO_LETTERS), _OTHER, _LETTER)
    # Runs of bytes of one kind in one text.
    begins = np.ones(len(data), bool)
    np.not_equal(kind[1:], kind[:-1], out=begins[1:])
    texts = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[texts] = True
    runs = np.flatnonzero(begins)
    kinds, lengths = kind[runs], np.diff(runs, append=len(data))
    opens = np.ones(len(runs), bool)
    opens[1:] = kinds[:-1] == _BLANK
    opens[np.searchsorted(runs, texts)] = True
    inside = kinds != _BLANK
    runs, kinds, lengths, opens = runs[inside], kinds[inside], lengths[inside], opens[inside]
    # Those that open a piece: each chunk's first, and signs that end a chunk of letters.
    chunks = np.flatnonzero(opens)
    pairs = chunks[np.diff(chunks, append=len(runs)) == 2]
    opens[pairs[(kinds[pairs] == _LETTER) & (kinds[pairs + 1] == _SIGN)] + 1] = True
    ends = np.zeros(len(runs) + 1, np.int32)
    np.cumsum(lengths, out=ends[1:])
    bounds = np.append(ends[:-1][opens], ends[-1])
    buffers = [None, pa.py_buffer(bounds), pa.py_buffer(data[kind != _BLANK])]
    found = pa.Array.from_buffers(pa.binary(), len(bounds) - 1, buffers)
    return found.dictionary_encode(), np.searchsorted(runs[opens], offsets)


class WordEncoder:
    """Ids of texts, those of ``encode(text, add_special_tokens=False)``, as little-endian
    unsigned 32-bit bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [token.content for token in added]
        # One that is looked for after normalisation may be written otherwise in a text.
        self.normalizer = self.tokenizer.normalizer if any(t.normalized for t in added) else None
        self.model = self.tokenizer.model
        self.pieces = Remembered(self._piece)

    def _whole(self, text: str) -> bytes:
        return as_bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _piece(self, piece: bytes) -> bytes:
        if piece.isalpha():  # of ASCII letters alone
            word = piece.lower().decode()
        elif _LETTERS.fullmatch(piece):
            lower = piece.decode().lower().encode()
            word = codecs.charmap_decode(lower, "strict", _BYTE_LETTERS)[0]
        else:
            return self._whole(piece.decode())
        return as_bytes([token.id for token in self.model.tokenize(word)])

    def _holds_added(self, text: str) -> bool:
        if self.normalizer is not None and any(t in self.normalizer.normalize_str(text) for t in self.added):
            return True
        return any(t in text for t in self.added)

    def _ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a batch's texts, and how many there are before each offset."""
        pieces, before = _pieces(data, offsets)
        distinct = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = list(map(self.pieces.__getitem__, distinct))
        flat = np.frombuffer(b"".join(known), "<u4")
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        codes = pieces.indices.to_numpy()
        counts = sizes[codes]
        ends = np.zeros(len(codes) + 1, np.int64)
        np.cumsum(counts, out=ends[1:])
        places = np.repeat((np.cumsum(sizes) - sizes)[codes] - ends[:-1], counts)
        places += np.arange(len(places))
        return flat[places], ends[before]

    def encode_column(self, column: pa.Array, end_id: int | None = None) -> list[bytes]:
        """Ids of each text of a column (null: empty), and then ``end_id`` if one is given."""
        data, offsets = utf8_column(column)
        parts, counts = [np.zeros(0, "<u4")], np.zeros(len(column), np.int64)
        for first, last in _slices(data, offsets, SLICE_BYTES):
            ids, before = self._ids(data[first:last], np.clip(offsets, first, last) - first)
            parts.append(ids)
            counts += np.diff(before)
        ids, ends = np.concatenate(parts), np.cumsum(counts)
        end = np.array([] if end_id is None else [end_id], "<u4")
        if len(end):
            ids, ends = np.insert(ids, ends, end_id), ends + np.arange(1, len(ends) + 1)
        raw, bounds = ids.tobytes(), [0, *(4 * ends).tolist()]
        found = [raw[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        for i in self._with_added(column, data):
            found[i] = self._whole(column[i].as_py()) + end.tobytes()
        return found

    def _with_added(self, column: pa.Array, data: np.ndarray) -> list[int]:
        """Places of the texts that hold the string of an added token."""
        raw = data.tobytes()
        if self.normalizer is None and not any(t.encode() in raw for t in self.added):
            return []
        return [i for i, text in enumerate(column.to_pylist()) if text and self._holds_added(text)]

    def encode(self, text: str) -> bytes:
        return self.encode_column(pa.array([text], pa.string()))[0]


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder per Python worker and file."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]

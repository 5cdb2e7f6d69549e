"""Byte-level BPE: each distinct word of the corpus is encoded once."""

from __future__ import annotations

import base64
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import cache
from itertools import count
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketspark.llm.common import batches, small_batches, shuffle_parts, sliced, text_of
from docketspark.llm.tokens import tokenizer_path
from docketspark.session import scratch_dir

# Code points of the documents whose words are counted together before the shuffle.
BLOCK_CHARS = 16_000_000
# Documents that are decoded at a time.
DECODED_ROWS = 256
# Distinct words of blocks that meet in one task.
BUCKET_WORDS = 2_000_000
# Marks cuts; a text that has this sign goes through the pattern as a whole.
_CUT = "\x1f"
# White space before a blank.
_SPACED = [f"{c} " for c in map(chr, range(0x3001)) if c.isspace()]
_SPACED_ASCII = [s for s in _SPACED if s.isascii()]


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


class Words:
    """Numbers of the pieces of a block's texts, and of the pre-tokens of its pieces.

    With ``cuts`` a text is cut before every blank that has no white space on either side;
    the pattern must never join a sign and a blank behind it. The pre-tokens of each
    different piece are then looked for only once. Of a text with white space before a blank
    each pre-token is a piece, and so of all texts without ``cuts``.
    """

    def __init__(self, pattern: str, cuts: bool = True):
        import regex

        self.find, self.cuts = regex.compile(pattern).findall, cuts
        self.pieces: defaultdict[str, int] = defaultdict(count().__next__)

    def __call__(self, text: str) -> list[int]:
        if not text:
            return []
        spaced = _SPACED_ASCII if text.isascii() else _SPACED
        if not self.cuts or text[-1] == " " or _CUT in text or any(s in text for s in spaced):
            pieces = self.find(text)
        else:
            pieces = text.replace(" ", f"{_CUT} ").split(_CUT)
            if not pieces[0]:
                del pieces[0]  # the text starts with a blank
        return list(map(self.pieces.__getitem__, pieces))

    def table(self) -> tuple[np.ndarray, list[bytes], list[list[int]]]:
        """The block's different pre-tokens by ascending hash: their hashes, themselves, and
        those of each piece by their number in that order."""
        numbers: defaultdict[str, int] = defaultdict(count().__next__)
        number = numbers.__getitem__
        of_pieces = [list(map(number, self.find(piece))) for piece in self.pieces]
        words = [word.encode() for word in numbers]
        hashes = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
        order = np.argsort(hashes, kind="stable")
        new = np.empty(len(order), np.int64)
        new[order] = np.arange(len(order))
        new = new.tolist()
        return hashes[order], [words[i] for i in order.tolist()], [[new[n] for n in p] for p in of_pieces]


@cache
def _compressor():
    import zstandard

    return zstandard.ZstdCompressor(level=3)


@cache
def _decompressor():
    import zstandard

    return zstandard.ZstdDecompressor()


def _squeezed(numbers: np.ndarray) -> bytes:
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return _compressor().compress(planes.tobytes())


def _unsqueezed(data: bytes) -> np.ndarray:
    planes = np.frombuffer(_decompressor().decompress(data), np.uint8)
    return planes.reshape(4, -1).T.copy().view("<u4").ravel()


def _packed(parts: list[bytes]) -> bytes:
    sizes = np.array([len(parts), *map(len, parts)], "<u4").tobytes()
    return _compressor().compress(sizes + b"".join(parts))


def _unpacked(data: bytes) -> list[bytes]:
    data = _decompressor().decompress(data)
    (n,) = np.frombuffer(data, "<u4", 1).tolist()
    at = 4 * (n + 1)
    ends = (at + np.cumsum(np.frombuffer(data, "<u4", n, 4), dtype=np.int64)).tolist()
    return [data[a:b] for a, b in zip([at, *ends[:-1]], ends, strict=True)] if n else []


_BLOCK = "hashes binary, words binary, n_words bigint, doc_ids binary, known binary, pieces binary, places binary"
_BLOCK_NAMES = [column.split()[0] for column in _BLOCK.split(", ")]


def exploded(docs: DataFrame, pattern: str, cuts: bool, block_chars: int) -> DataFrame:
    """A row per block of documents read one after another: its pre-tokens by ascending
    hash, each once, and its documents as numbers of pieces, pieces as numbers of words."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chars, words = 0, Words(pattern, cuts)
        doc_ids: list = []
        places: list[bytes] = []

        def closed() -> pa.RecordBatch:
            hashes, found, of_pieces = words.table()
            sizes = [len(p) for p in of_pieces]
            flat = [n for p in of_pieces for n in p]
            row = (
                _squeezed(hashes), _packed(found), len(found),
                np.array([i or 0 for i in doc_ids], "<i8").tobytes(),
                np.array([i is not None for i in doc_ids], bool).tobytes(),
                _squeezed(np.array([len(sizes), *sizes, *flat], np.uint32)),
                b"".join(len(p).to_bytes(8, "little") + p for p in places),
            )
            types = [pa.int64() if name == "n_words" else pa.binary() for name in _BLOCK_NAMES]
            arrays = [pa.array([value], kind) for value, kind in zip(row, types, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=_BLOCK_NAMES)

        for batch in sliced(frames, "text"):
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                doc_ids.append(doc_id)
                places.append(_squeezed(np.array(words(text), np.uint32)))
                chars += len(text) + 1
                if chars > block_chars:
                    yield closed()
                    chars, words, doc_ids, places = 0, Words(pattern, cuts), [], []
        if chars:
            yield closed()

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(run, _BLOCK)


def _stored_blocks(blocks: DataFrame) -> DataFrame:
    """Blocks in the shared folder, each a row group of its own, with the place of each:
    ``file``, and ``at``, the number of its row group."""
    path = scratch_dir(blocks.sparkSession, "bpe-blocks")
    one_row = {"parquet.block.size": 1, "parquet.block.size.row.check.min": 1, "parquet.block.size.row.check.max": 1}
    blocks.write.options(**one_row).parquet(path)
    found = blocks.sparkSession.read.schema(_BLOCK).parquet(path)
    return found.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))


def _block_at(file, at: int) -> dict:
    """The documents of a block; the file is open."""
    group, rows = 0, at
    while rows >= file.metadata.row_group(group).num_rows:
        rows -= file.metadata.row_group(group).num_rows
        group += 1
    names = ["doc_ids", "known", "pieces", "places"]
    return file.read_row_group(group, columns=names).slice(rows, 1).to_pylist()[0]


def _documents(block: dict, by_number: list[bytes], kind: str) -> pa.RecordBatch:
    """The block's documents, put together by place from the ids of its words."""
    table = _unsqueezed(block["pieces"])
    size = int(table[0])
    ends = np.cumsum(table[1 : 1 + size]).tolist()
    flat = list(map(by_number.__getitem__, table[1 + size :].tolist()))
    pieces = [b"".join(flat[a:b]) for a, b in zip([0, *ends[:-1]], ends, strict=True)]
    out, at, places = [], 0, block["places"]
    while at < len(places):
        length = int.from_bytes(places[at : at + 8], "little")
        own = _unsqueezed(places[at + 8 : at + 8 + length]).tolist()
        ids = b"".join(map(pieces.__getitem__, own))
        out.append(np.frombuffer(ids, kind).astype("<u4").tobytes())
        at += 8 + length
    unknown = ~np.frombuffer(block["known"], bool)
    doc_ids = pa.array(np.frombuffer(block["doc_ids"], "<i8"), pa.int64(), mask=unknown)
    return pa.RecordBatch.from_arrays([doc_ids, pa.array(out, pa.binary())], names=["doc_id", "ids"])


def encode(
    docs: DataFrame,
    path: str | None = None,
    pattern: str | None = None,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``doc_id, ids`` (little-endian unsigned 32-bit) of every row of ``docs`` (doc_id, text).

    One pass explodes the texts into pre-tokens with their places, pre-aggregated per block
    of documents, and stores the blocks. Each sends its words once, in buckets by the word's
    hash. Equal words meet in their bucket, where each distinct one is encoded once by the
    given ranks; its ids go back to the blocks that have it, and the task that gets a block's
    ids opens the block where it is stored and puts its documents together by place. Blocks
    are never moved, and rows may come in any order: a block is read as it was written.

    A frequent word is sent once per block. A block and its words fit a task, as do a
    bucket's distinct words (buckets grow with the words that were counted) and a single
    document of any length, which is a block of its own.

    Null texts count as empty (no ids); null ids and repeated rows stay; an empty table
    gives no rows; other columns are ignored.
    """
    import public_tokenizers

    path = path or tokenizer_path("byte_bpe_multi_50k.tiktoken")
    pattern = pattern or public_tokenizers.PATTERN
    # Of other patterns it is not known whether they join a sign and a blank behind it.
    blocks = _stored_blocks(exploded(docs, pattern, pattern == public_tokenizers.PATTERN, block_chars))
    n_words = blocks.agg(F.sum("n_words")).first()[0] or 0
    buckets = max(shuffle_parts(docs), -(-n_words // BUCKET_WORDS))

    def dealt(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = np.array([(i << 32) // buckets for i in range(1, buckets)], np.uint64)
        for batch in batches(frames):
            for file, at, hashes, words in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                cuts = np.searchsorted(_unsqueezed(hashes).astype(np.uint64), edges).tolist()
                words = _unpacked(words)
                parts = list(zip([0, *cuts], [*cuts, len(words)], strict=True))
                some = [(i, a, b) for i, (a, b) in enumerate(parts) if a < b]
                if not some:
                    some = [(0, 0, 0)]  # the block's documents are all empty
                columns = [
                    pa.array([i for i, _, _ in some], pa.int32()), pa.array([file] * len(some)),
                    pa.array([at] * len(some), pa.int64()), pa.array([a for _, a, _ in some], pa.int64()),
                    pa.array([_packed(words[a:b]) for _, a, b in some], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["bucket", "file", "at", "first", "words"])

    def encoded(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Ids of words sorted by bucket; of a bucket, each word is encoded once."""
        import tiktoken

        ranks = load_ranks(path)
        kind = "<u2" if max(ranks.values()) < 1 << 16 else "<u4"
        coder = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

        def encode_word(word: bytes) -> bytes:
            return np.array(coder.encode_ordinary(word.decode()), kind).tobytes()

        bucket, known = None, {}
        for batch in batches(frames):
            out = []
            for at, data in zip(batch.column("bucket").to_pylist(), batch.column("words").to_pylist(), strict=True):
                if at != bucket:
                    bucket, known = at, {}
                words = _unpacked(data)
                for word in words:
                    if word not in known:
                        known[word] = encode_word(word)
                out.append(_packed([known[word] for word in words]))
            columns = [*(batch.column(c) for c in ("file", "at", "first")), pa.array(out, pa.binary())]
            columns.append(pa.array([kind] * len(out)))
            yield pa.RecordBatch.from_arrays(columns, names=["file", "at", "first", "ids", "kind"])

    def together(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents of blocks whose rows come one after another, in order of ``first``."""
        import pyarrow.parquet as pq

        from docketspark.sources.files import open_input

        key, ids, kind, opened, file = None, [], "<u4", None, None
        for batch in batches(frames):
            for row in batch.to_pylist():
                if key != (row["file"], row["at"]):
                    if key is not None:
                        yield _documents(_block_at(file, key[1]), ids, kind)
                    key, ids, kind = (row["file"], row["at"]), [], row["kind"]
                    if opened != row["file"]:
                        opened, file = row["file"], pq.ParquetFile(open_input(unquote(row["file"])))
                ids += _unpacked(row["ids"])
        if key is not None:
            yield _documents(_block_at(file, key[1]), ids, kind)

    sent = blocks.select("file", "at", "hashes", "words")
    words = sent.mapInArrow(dealt, "bucket int, file string, at bigint, first bigint, words binary")
    met = words.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    known = met.mapInArrow(encoded, "file string, at bigint, first bigint, ids binary, kind string")
    back = known.repartition(buckets, "file", "at").sortWithinPartitions("file", "at", "first")
    return back.mapInArrow(together, "doc_id bigint, ids binary")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, data``: the bytes that each row's ``ids`` stand for.

    The token-byte table is joined by look-up in the task. It goes to every task whole:
    its size is the vocabulary's (about 50,000 short rows), whatever the corpus. An id that
    it does not have stops the job. Null ids of a row give null.
    """
    path = path or tokenizer_path("byte_bpe_multi_50k.tiktoken")

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = load_ranks(path)
        table: list = [None] * (max(ranks.values()) + 1)
        for data, rank in ranks.items():
            table[rank] = data
        for batch in small_batches(frames, DECODED_ROWS):
            out = [
                None if ids is None else b"".join(map(table.__getitem__, np.frombuffer(ids, "<u4").tolist()))
                for ids in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=[*batch.schema.names, "data"])

    rows = encoded.select("doc_id", "ids")
    return rows.mapInArrow(run, "doc_id bigint, ids binary, data binary")

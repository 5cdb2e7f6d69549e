"""Cost-balanced packing of tokenised documents into training sequences."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketspark.llm.common import sliced, small_batches, text_of
from docketspark.llm.tokens import SLICE_BYTES, SLICE_ROWS, encoder, tokenizer_path

CAPACITY = 2048
# Tokens that a task packs together. The number of sequences a piece can choose
# from is this over the capacity, at any input size.
WINDOW_TOKENS = 1 << 21

SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint,"
    " sequence_id bigint, offset bigint, sequence_tokens bigint, sequence_cost double"
)


def attention_cost(tokens, linear: float = 1.0, quadratic: float = 1.0 / CAPACITY):
    """Cost of attending within one document piece: a linear and a quadratic part."""
    return linear * tokens + quadratic * tokens * tokens


def sequence_sizes(tokens: int, capacity: int) -> list[int]:
    """Sizes that sum up to ``tokens``: full sequences, then distinct powers of two, which
    need no padding either."""
    rest = tokens % capacity
    tail = [1 << bit for bit in reversed(range(rest.bit_length())) if rest >> bit & 1]
    return [capacity] * (tokens // capacity) + tail


def balance(lengths: list[int], capacity: int, cost=attention_cost):
    """Assign pieces, longest first, to the cheapest sequence with room for them.

    Returns (piece, start in the piece, length, sequence, offset) rows and the sequences'
    sizes and costs. A piece that no sequence has room for is cut over those with the most
    room, after all others. Every sequence is filled exactly. Ties go to the earlier piece
    and the earlier sequence.
    """
    sizes = np.array(sequence_sizes(int(sum(lengths)), capacity), np.int64)
    room = sizes.copy()
    costs = np.zeros(len(sizes))
    rows, left = [], []

    def put(piece: int, start: int, length: int, sequence: int) -> None:
        rows.append((piece, start, length, sequence, int(sizes[sequence] - room[sequence])))
        room[sequence] -= length
        costs[sequence] += cost(length)

    for piece in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        fits = np.where(room >= lengths[piece], costs, np.inf)
        sequence = int(fits.argmin()) if len(fits) else 0
        if lengths[piece] and np.isfinite(fits[sequence]):
            put(piece, 0, lengths[piece], sequence)
        elif lengths[piece]:
            left.append(piece)
    for piece in left:
        start = 0
        while start < lengths[piece]:
            sequence = int(room.argmax())
            length = min(lengths[piece] - start, int(room[sequence]))
            put(piece, start, length, sequence)
            start += length
    return rows, sizes, costs


def _packed(window, capacity: int, first: int) -> tuple[list[tuple], int]:
    """Rows of one window of (doc_id, ids) and the number of its sequences."""
    rows, sequences, pieces = [], 0, []
    for doc, (doc_id, ids) in enumerate(window):
        tokens = len(ids) // 4
        whole = tokens // capacity * capacity
        for start in range(0, whole, capacity):
            cut = ids[4 * start : 4 * (start + capacity)]
            sequence = first + sequences
            full = float(attention_cost(capacity))
            rows.append((doc_id, start, capacity, cut, tokens, sequence, 0, capacity, full))
            sequences += 1
        if whole < tokens:
            pieces.append((doc, whole, tokens - whole))
    placed, sizes, costs = balance([p[2] for p in pieces], capacity)
    for piece, start, length, sequence, offset in placed:
        doc, begin, _ = pieces[piece]
        doc_id, ids = window[doc]
        begin += start
        cut = ids[4 * begin : 4 * (begin + length)]
        at = first + sequences + sequence
        size, total = int(sizes[sequence]), float(costs[sequence])
        rows.append((doc_id, begin, length, cut, len(ids) // 4, at, offset, size, total))
    return rows, sequences + len(sizes)


def pack(
    docs: DataFrame,
    path: str | None = None,
    end_id: int = 1,
    capacity: int = CAPACITY,
    window_tokens: int = WINDOW_TOKENS,
) -> DataFrame:
    """Pack all ``docs`` (doc_id, text) into sequences of at most ``capacity`` tokens.

    A document is its text's ids and then ``end_id``. Runs of ``capacity`` ids of a long
    document are sequences of their own. The rests of each window of ``window_tokens``
    tokens are dealt out, in descending order, to the cheapest sequence with room; what
    fits nowhere is cut, so that no sequence needs padding: all hold ``capacity`` tokens but
    for a window's last few, whose sizes are powers of two.

    Packing happens where a document is read, so nothing is shuffled, no task holds more
    than a window and a hot source is as good as any. A repeated attempt of a task reads
    the same rows in the same order and makes the same sequences; ``sequence_id`` is the
    task's number (upper bits) and the sequence's number in the task.

    Null texts count as empty (one piece that holds ``end_id``); a null ``doc_id`` stays
    null; repeated rows are packed each for itself; an empty table gives no rows; other
    columns are ignored. Rows: ``doc_id, start, length, ids`` (little-endian unsigned
    32-bit), ``doc_tokens, sequence_id, offset, sequence_tokens, sequence_cost``.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    path = path or tokenizer_path()

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = encoder(path).encode_column
        sequence = TaskContext.get().partitionId() << 40
        window, tokens = [], 0

        def packed() -> pa.RecordBatch:
            nonlocal sequence
            rows, made = _packed(window, capacity, sequence)
            sequence += made
            columns = list(zip(*rows, strict=True))
            types = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 4 + [pa.float64()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=_names())

        for batch in sliced(small_batches(frames, SLICE_ROWS), "text", SLICE_BYTES):
            known = encode(batch.column("text"), end_id)
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), known, strict=True):
                window.append((doc_id, ids))
                tokens += len(ids) // 4
                if tokens >= window_tokens:
                    yield packed()
                    window, tokens = [], 0
        if window:
            yield packed()

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(run, SCHEMA)


def _names() -> list[str]:
    return [field.split()[0] for field in SCHEMA.split(",")]

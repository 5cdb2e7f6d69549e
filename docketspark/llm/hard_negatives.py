"""Hard negatives of anchors by a secondary sort of packed score keys.

Anchors and rows are dealt over a grid by one shuffle, without a join. A task holds the
anchors of its cell and lets blocks of rows pass by them in matrix products; it keeps only
what can be asked of its cell, so that an anchor never gets a row per vector nor one per
block. What is kept becomes keys
(anchor, descending score, kind, id) whose bytes sort as the numbers do; keys are dealt by
anchor and sorted within partitions by the shuffle, and an iterator reads each anchor's
keys once, opens a window at each positive and gives out negatives as they pass by.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from itertools import groupby
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketspark.llm.common import arrow_bytes, batches, give_back, shuffle_parts, stored

# Most rows of a block, and most anchors of one.
ROWS, ANCHORS = 4096, 512
# Bytes of anchors and of what is kept for them in a task, bytes of rows that are dealt to it
# at most, and the cells of a core.
CELL_BYTES, PART_BYTES, CELLS = 96 << 20, 256 << 20, 4
# Bytes of an Arrow batch while blocks are compared.
BATCH_BYTES = 8 << 20
# Rows that a tile of anchors meets at a time, at first and later; a label with fewer anchors
# than LABEL shares its tile; a product of which a share of 1 / FLOOD fits is ranked as a whole.
FIRST, COLUMNS, LABEL, FLOOD = 128, 2048, 32, 16
# Candidates of a tile that wait to be ranked.
WAITING = 4096

_KEY = np.dtype(
    [("anchor", ">u8"), ("score", ">u8"), ("kind", "u1"), ("id", ">u8"), ("row", ">u8")]
)
_FLIP = np.uint64(1 << 63)
_POSITIVE, _NEGATIVE = 0, 1
_EXACT = 1 << 53  # doubles are exact whole numbers below this
_EXACT_SINGLE = 1 << 24  # and singles below this
_LEAST, _MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max
_PARTS = ("ids", "labels", "rows", "vectors", "windows")
_BLOCK = "n int, width int, kind string, " + ", ".join(f"{name} binary" for name in _PARTS)


def usable(vectors: DataFrame, vec_id: str, label: Column, vector: str) -> DataFrame:
    """``vec_id, label, vector`` of the rows that take part."""
    rows = vectors.select(
        F.col(vec_id).cast("bigint").alias("vec_id"),
        label.cast("bigint").alias("label"),
        F.col(vector).cast("array<double>").alias("vector"),
    )
    odd = F.exists("vector", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return rows.where("vec_id is not null and label is not null and vector is not null").where(~odd)


def _matrix(column: pa.Array, scale: float) -> np.ndarray:
    """``floor(scale * x)`` of a list column; shorter vectors end with zeros."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    flat = column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
    sizes = np.diff(offsets)
    out = np.zeros((len(column), int(sizes.max(initial=0))))
    out[np.arange(out.shape[1]) < sizes[:, None]] = np.floor(scale * flat)
    return out


def _kind(matrix: np.ndarray) -> str:
    """The smallest type that holds the whole numbers of a matrix."""
    most = float(np.abs(matrix).max(initial=0))
    return next((k for k, bits in (("<i2", 15), ("<i4", 31)) if most < 1 << bits), "<f8")


def _blocks(rows: DataFrame, size: int, scale: float) -> DataFrame:
    """Rows of one partition in blocks of at most ``size``, each by ascending label, then id."""
    with_windows = "windows" in rows.columns

    def block(held: list[tuple[np.ndarray, np.ndarray, np.ndarray, list]]) -> pa.RecordBatch:
        width = max(m.shape[1] for _, _, m, _ in held)
        ids, labels = (np.concatenate([h[i] for h in held]) for i in (0, 1))
        matrix = np.concatenate([np.pad(m, ((0, 0), (0, width - m.shape[1]))) for _, _, m, _ in held])
        windows = [w for h in held for w in h[3]]
        contents = [label.tobytes() + row.tobytes() for label, row in zip(labels, matrix)]
        hashes = [blake2b(c.rstrip(b"\0"), digest_size=8).digest() for c in contents]
        rows = np.frombuffer(b"".join(hashes), np.uint64)
        order = np.lexsort((rows, ids, labels))
        kind = _kind(matrix)
        most = max((len(w) for w in windows), default=0)
        spans = np.tile(np.array([1, 0], np.int64), (len(ids), most, 1))  # 1 to 0 holds nothing
        for i, own in enumerate(windows):
            for j, w in enumerate(own):
                spans[i, j] = w["least"], w["most"]
        values = {
            "n": len(ids), "width": width, "kind": kind, "ids": ids[order].tobytes(),
            "labels": labels[order].tobytes(), "rows": rows[order].tobytes(), "vectors": matrix[order].astype(kind).tobytes(),
            "windows": spans[order].tobytes(),
        }
        return pa.RecordBatch.from_pylist([values], schema=_schema)

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches(frames):
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, size - n)
                at, n = at + part.num_rows, n + part.num_rows
                windows = part.column("windows").to_pylist() if with_windows else []
                ids, labels = (part.column(c).to_numpy() for c in ("vec_id", "label"))
                held.append((ids, labels, _matrix(part.column("vector"), scale), windows))
                if n == size:
                    yield block(held)
                    held, n = [], 0
        if held:
            yield block(held)

    return rows.mapInArrow(run, _BLOCK)


_schema = pa.schema(
    [("n", pa.int32()), ("width", pa.int32()), ("kind", pa.string())]
    + [(name, pa.binary()) for name in _PARTS]
)


class Block:
    def __init__(self, row: dict):
        self.n, self.width = row["n"], row["width"]
        self.ids, self.labels = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels"))
        self.rows = np.frombuffer(row["rows"], np.uint64)
        self.matrix = np.frombuffer(row["vectors"], row["kind"]).reshape(self.n, self.width)
        self.windows = np.frombuffer(row["windows"], np.int64).reshape(self.n, -1, 2)


def products(a: Block, b: Block) -> np.ndarray:
    """Inner products of whole numbers, exact; beyond 64 bits the nearest 64-bit number."""
    width = min(a.width, b.width)  # the rest meets zeros
    x, y = a.matrix[:, :width], b.matrix[:, :width]
    most = [float(np.abs(m.astype(np.float64)).max(initial=0)) for m in (x, y)]
    if most[0] * most[1] * width < _EXACT:
        return (x.astype(np.float64) @ y.astype(np.float64).T).astype(np.int64)
    whole = [np.array([[int(v) for v in row] for row in m.tolist()], object).reshape(m.shape) for m in (x, y)]
    out = np.zeros((a.n, b.n), np.int64)
    for i, row in enumerate(whole[0]):
        for j, other in enumerate(whole[1]):
            out[i, j] = min(max(sum(row * other), _LEAST), -_LEAST - 1)
    return out


def first_of(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """For each line the places of the first ``k`` allowed columns by descending score, then
    by place: line and column numbers."""
    n = scores.shape[1]
    if not n or not len(scores):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if np.abs(scores.astype(np.float64)).max() < 1 << 49:
        packed = np.where(allowed, scores * n + np.arange(n - 1, -1, -1), _LEAST)
        best = np.argpartition(packed, n - k, axis=1)[:, n - k :] if k < n else np.tile(np.arange(n), (len(scores), 1))
        lines, at = np.nonzero(np.take_along_axis(packed, best, 1) != _LEAST)
        return lines, best[lines, at]
    found = [
        (i, j)
        for i in range(len(scores))
        for j in sorted(np.flatnonzero(allowed[i]).tolist(), key=lambda j: (-int(scores[i, j]), j))[:k]
    ]
    lines, at = zip(*found, strict=True) if found else ((), ())
    return np.array(lines, np.int64), np.array(at, np.int64)


def once(block: Block) -> np.ndarray:
    """False for rows that repeat the one before: same id, label and vector."""
    out = np.ones(block.n, bool)
    out[1:] = (block.ids[1:] != block.ids[:-1]) | (block.rows[1:] != block.rows[:-1])
    return out


def packed_keys(
    anchors: np.ndarray, scores: np.ndarray, kind: int, ids: np.ndarray, rows: np.ndarray | int
) -> pa.Array:
    keys = np.empty(len(ids), _KEY)
    keys["anchor"] = anchors.view(np.uint64) ^ _FLIP
    keys["score"] = ~(scores.view(np.uint64) ^ _FLIP)
    keys["kind"], keys["id"], keys["row"] = kind, ids.view(np.uint64) ^ _FLIP, rows
    buffer = pa.py_buffer(keys.tobytes())
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(_KEY.itemsize), len(keys), [None, buffer]).cast(pa.binary())


def unpacked(keys: pa.Array) -> Iterator[tuple[int, int, int, int, int]]:
    """``anchor, score, kind, id, row`` of each key."""
    found = np.frombuffer(b"".join(keys.to_pylist()), _KEY)
    anchor, ids = ((found[c].astype(np.uint64) ^ _FLIP).view(np.int64) for c in ("anchor", "id"))
    score = (~found["score"].astype(np.uint64) ^ _FLIP).view(np.int64)
    columns = (anchor, score, found["kind"], ids, found["row"])
    return zip(*(c.tolist() for c in columns), strict=True)


class _Tile:
    """Some anchors of a cell, and the first rows of each of their windows so far.

    ``windows`` are lowest and highest scores, ``anchors x windows x 2``; a window that holds
    nothing goes from 1 to 0. A window takes ``k`` rows by descending score, then by id.
    """

    def __init__(self, ids, labels, matrix, windows, k: int, same_label: bool):
        self.ids, self.labels, self.matrix, self.k, self.same_label = ids, labels, matrix, k, same_label
        self.single = labels[0] == labels[-1]
        holds = windows[:, :, 0] <= windows[:, :, 1]
        self.least, self.most = np.where(holds, windows[:, :, 0], _MOST), np.where(holds, windows[:, :, 1], _LEAST)
        self.highest = self.most.max(1, initial=_LEAST)
        # The score and id of the last row of a window that is full: what comes later is of no use.
        self.last, self.last_id = self.least.copy(), np.full(self.least.shape, _MOST)
        self.held = _nothing()
        self.waiting, self.met = [], False

    def meet(self, block: _Rows) -> None:
        labels = block.labels
        if self.single or self.same_label:
            first = int(np.searchsorted(labels, self.labels[0], "left"))
            end = int(np.searchsorted(labels, self.labels[-1], "right"))
            spans = [(first, end)] if self.same_label else [(0, first), (end, block.n)]
        else:
            spans = [(0, block.n)]
        for at, end in spans:
            while at < end:
                stop = min(end, at + (COLUMNS if self.met else FIRST))
                self._meet(block, at, stop)
                if not self.met or sum(len(w[0]) for w in self.waiting) > WAITING:
                    self.settle()
                at, self.met = stop, True

    def _meet(self, block: _Rows, at: int, stop: int) -> None:
        ids, once = block.ids[at:stop], block.once[at:stop]
        kind = self.matrix.kind(block.matrix)
        if kind is None:
            scores = products(self.matrix.block, block.matrix.part(at, stop))
        else:
            width = min(self.matrix.width, block.matrix.width)  # the rest meets zeros
            scores = self.matrix.of(kind)[:, :width] @ block.matrix.of(kind)[at:stop, :width].T
        # Of rows with the score of a window's last one only a lower id is of use.
        tied = (self.last_id < ids.min()) & (self.last < _MOST)
        needed = self.last + tied
        fits = scores >= needed.min(1, initial=_MOST)[:, None].astype(scores.dtype)
        fits &= scores <= self.highest[:, None].astype(scores.dtype)
        if not self.single:
            fits &= (self.labels[:, None] == block.labels[at:stop]) == self.same_label
        n = np.count_nonzero(fits)
        if n > max(fits.size // FLOOD, len(fits) * self.k):
            self._rank(scores, fits, needed, block, at, stop)
        elif n:
            i, j = np.divmod(np.flatnonzero(fits), fits.shape[1])
            found = scores[i, j].astype(np.int64)
            keep = ((found[:, None] >= needed[i]) & (found[:, None] <= self.most[i])).any(1) & once[j]
            if self.same_label:
                keep &= self.ids[i] != ids[j]
            i, j, found = i[keep], j[keep], found[keep]
            self.waiting.append((i, found, ids[j], block.rows[at:stop][j]))

    def _rank(self, scores, fits, needed, block: _Rows, at: int, stop: int) -> None:
        """The first rows of each window among many that fit."""
        order = np.lexsort((block.rows[at:stop], block.ids[at:stop]))
        ids, rows, once = (x[at:stop][order] for x in (block.ids, block.rows, block.once))
        scores, fits = scores[:, order].astype(np.int64), fits[:, order] & once
        if self.same_label:
            fits &= self.ids[:, None] != ids
        for w in range(self.least.shape[1]):
            inside = fits & (scores >= needed[:, w, None]) & (scores <= self.most[:, w, None])
            i, j = first_of(scores, inside, self.k)
            self.waiting.append((i, scores[i, j], ids[j], rows[j]))

    def settle(self) -> None:
        """Keep of what was held and what waits the first rows of each window."""
        line, score, ids, rows = (np.concatenate(x) for x in zip(self.held, *self.waiting, strict=True))
        self.waiting = []
        order = np.lexsort((rows, ids, ~score, line))
        line, score, ids, rows = (x[order] for x in (line, score, ids, rows))
        new = np.ones(len(line), bool)
        new[1:] = False
        for x in (line, score, ids, rows):  # a row that is repeated as a whole counts once
            new[1:] |= x[1:] != x[:-1]
        line, score, ids, rows = (x[new] for x in (line, score, ids, rows))
        kept = np.zeros(len(line), bool)
        for w in range(self.least.shape[1]):
            at = np.flatnonzero((score >= self.least[line, w]) & (score <= self.most[line, w]))
            rank = np.arange(len(at)) - np.searchsorted(line[at], line[at], "left")
            kept[at[rank < self.k]] = True
            full = at[rank == self.k - 1]
            self.last[line[full], w], self.last_id[line[full], w] = score[full], ids[full]
        self.held = tuple(x[kept] for x in (line, score, ids, rows))


def _nothing() -> tuple[np.ndarray, ...]:
    return (*(np.zeros(0, np.int64) for _ in range(3)), np.zeros(0, np.uint64))


class _Matrix:
    """Whole numbers, as the floats in which their products are exact."""

    def __init__(self, matrix: np.ndarray):
        self.whole, self.width, self._made = matrix, matrix.shape[1], {}
        squares = np.einsum("ij,ij->i", x := matrix.astype(np.float64), x)
        self.norm = float(np.sqrt(squares.max(initial=0))) * (1 + 1e-9)

    @property
    def block(self) -> SimpleNamespace:
        return self.part(0, len(self.whole))

    def part(self, at: int, stop: int) -> SimpleNamespace:
        return SimpleNamespace(n=stop - at, width=self.width, matrix=self.whole[at:stop])

    def kind(self, other: _Matrix) -> type | None:
        """No sum on the way to a product is larger than the norms' product."""
        most = self.norm * other.norm
        return np.float32 if most < _EXACT_SINGLE else np.float64 if most < _EXACT else None

    def of(self, kind: type) -> np.ndarray:
        if kind not in self._made:
            self._made[kind] = self.whole.astype(kind)
        return self._made[kind]


class _Rows:
    """A block of rows that passes by the anchors of a cell."""

    def __init__(self, block: Block):
        self.n, self.ids, self.labels, self.rows = block.n, block.ids, block.labels, block.rows
        self.once, self.matrix = once(block), _Matrix(block.matrix)


def _tiles(blocks: list[Block], k: int, same_label: bool) -> list[_Tile]:
    """The anchors of a cell by label, at most ``ANCHORS`` a tile. Without windows, an anchor
    has one that holds all scores."""
    width = max(b.width for b in blocks)
    most = max(1, *(b.windows.shape[1] for b in blocks))
    everything = np.array([[[_LEAST, _MOST]]], np.int64)
    ids, labels = (np.concatenate([getattr(b, x) for b in blocks]) for x in ("ids", "labels"))
    matrix = np.concatenate([np.pad(b.matrix, ((0, 0), (0, width - b.width))) for b in blocks])
    windows = np.tile(np.array([1, 0], np.int64), (len(ids), most, 1))
    at = 0
    for b in blocks:
        own = b.windows if b.windows.shape[1] else everything
        windows[at : at + b.n, : own.shape[1]] = own
        at += b.n
    order = np.lexsort((ids, labels))
    cuts = [0]
    for _, group in groupby(range(len(order)), lambda i: labels[order[i]]):
        group = list(group)
        if len(group) >= LABEL:
            cuts += [group[0], *range(group[0], group[-1] + 1, ANCHORS), group[-1] + 1]
        elif group[-1] + 1 - cuts[-1] > ANCHORS:
            cuts.append(group[0])
    cuts = sorted({*cuts, len(order)})
    parts = [order[a:b] for a, b in zip(cuts, cuts[1:])]
    return [_Tile(ids[p], labels[p], _Matrix(matrix[p]), windows[p], k, same_label) for p in parts]


def _grid(anchor_blocks: DataFrame, row_blocks: DataFrame, k: int) -> tuple[int, int]:
    """Groups of anchors and parts of rows. A group fits a task; there are cells enough for all
    cores, in the shape that shuffles the least."""

    def measured(blocks: DataFrame) -> tuple[int, int]:
        size = F.col("n").cast("bigint")
        n, width = blocks.agg(F.sum(size), F.max("width")).first()
        return n or 0, width or 0

    (anchors, width), (rows, row_width) = measured(anchor_blocks), measured(row_blocks)
    kept = k * (_KEY.itemsize + 8)
    least = max(1, -(-anchors * (8 * width + kept) // CELL_BYTES))
    cells = CELLS * row_blocks.sparkSession.sparkContext.defaultParallelism
    row_bytes, anchor_bytes = rows * 2 * row_width, anchors * (2 * width + kept)

    def parts(groups: int) -> int:
        return max(-(-cells // groups), -(-row_bytes // PART_BYTES))

    def moved(groups: int) -> int:
        return row_bytes * groups + anchor_bytes * parts(groups)

    groups = min(range(least, max(least, cells) + 1), key=moved)
    return groups, parts(groups)


def _compared(
    anchor_blocks: DataFrame, row_blocks: DataFrame, kind: int, k: int, most_kept: int, same_label: bool
) -> DataFrame:
    """``anchor_id, key`` of the first ``k`` rows of each window of each anchor, of its label or
    of others, from every cell of a grid of anchors and rows; ``most_kept`` rows an anchor.

    Both kinds of block go through one shuffle, as often as the grid has cells for them, and
    no side of a join: nothing is sent to the driver, however large the copies are.
    """
    groups, parts = _grid(anchor_blocks, row_blocks, most_kept)
    dealt = F.xxhash64("ids", "vectors")
    group, part = F.pmod(dealt, F.lit(groups)).cast("int"), F.pmod(dealt, F.lit(parts)).cast("int")
    every_part = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    every_group = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    columns = ["n", "width", "kind", *_PARTS]
    left = anchor_blocks.withColumn("group", group).withColumn("part", every_part).withColumn("passing", F.lit(False))
    right = row_blocks.withColumn("part", part).withColumn("group", every_group).withColumn("passing", F.lit(True))
    cell = (F.col("group") * parts + F.col("part")).alias("cell")
    both = left.select(cell, "passing", *columns).unionByName(right.select(cell, "passing", *columns))
    cells = both.repartitionById(groups * parts, "cell").sortWithinPartitions("passing")

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tiles = [], None
        for batch in batches(frames):
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if not row["passing"]:
                    held.append(Block(row))
                elif held or tiles:
                    if tiles is None:
                        tiles, held = _tiles(held, k, same_label), []
                    rows = _Rows(Block(row))
                    for tile in tiles:
                        tile.meet(rows)
        for tile in tiles or []:
            tile.settle()
            line, scores, ids, rows = tile.held
            if len(line):
                keys = packed_keys(tile.ids[line], scores, kind, ids, rows)
                yield pa.RecordBatch.from_arrays([pa.array(tile.ids[line]), keys], names=["anchor_id", "key"])
        give_back()

    return cells.mapInArrow(run, "anchor_id bigint, key binary")


def _secondary_sort(keys: DataFrame) -> DataFrame:
    """All keys of an anchor in one partition, partitions sorted by key while they are
    shuffled: what ``repartitionAndSortWithinPartitions`` does, with the sort in the JVM."""
    return keys.repartition(shuffle_parts(keys), "anchor_id").sortWithinPartitions("key").select("key")


def positives(anchors: DataFrame, rows: DataFrame, n_positives: int) -> DataFrame:
    """``anchor_id, positive_id, positive_score``: each anchor's first rows of its label, by
    descending score, then by id."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, n = None, 0
        for batch in batches(frames):
            out = []
            for key in unpacked(batch.column("key")):
                if last is None or key[0] != last[0]:
                    n = 0
                if key != last and n < n_positives:
                    out.append((key[0], key[3], key[1]))
                    n += 1
                last = key
            yield pa.RecordBatch.from_pylist(
                [dict(zip(found.names, row, strict=True)) for row in out], schema=found
            )

    found = pa.schema([(c, pa.int64()) for c in ("anchor_id", "positive_id", "positive_score")])
    keys = _secondary_sort(_compared(anchors, rows, _POSITIVE, n_positives, n_positives, True))
    return keys.mapInArrow(run, "anchor_id bigint, positive_id bigint, positive_score bigint")


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    vec_id: str = "vec_id",
    label: Column | str = "label",
    vector: str = "embedding",
    scale: float = 256.0,
    n_positives: int = 5,
    n_negatives: int = 3,
    least_percent: int = 50,
    most_percent: int = 95,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    A row's score is the inner product of ``floor(scale * x)`` with the anchor's. Anchors are
    the rows where ``is_anchor`` (a condition on the id, ``F.col("vec_id")``) holds; positives
    are an anchor's first ``n_positives`` other rows of its label by descending score, then by
    id, and each gets the first ``n_negatives`` rows of other labels whose score lies between
    ``least_percent`` and ``most_percent`` of its own (0 to 100).

    Rows with a null id, label or vector, or with a null or non-finite component, take no
    part. A row that is repeated as a whole counts once; rows that share an id but differ are
    rows of their own, never partners of an anchor with that id; of anchors with one id the
    least (label, vector) is taken. Shorter vectors end with zeros. Scores beyond 64 bits
    count as the nearest 64-bit number. An empty table, an anchor without positives and a
    positive without negatives give no rows. Other columns are not looked at.

    A cell of the grid gives at most ``n_positives`` rows an anchor to the first sort, and
    ``n_positives * n_negatives`` to the second: no window can take more from one cell.
    """
    if not 0 <= least_percent <= most_percent <= 100:
        raise ValueError("percentages must satisfy 0 <= least <= most <= 100")
    label = F.col(label) if isinstance(label, str) else label
    rows = usable(vectors, vec_id, label, vector)
    score = F.col("positive_score").cast("decimal(20,0)")
    spans = F.struct(
        F.ceil(score * least_percent / 100).cast("bigint").alias("least"),
        F.floor(score * most_percent / 100).cast("bigint").alias("most"),
    )
    with arrow_bytes(vectors.sparkSession, BATCH_BYTES):  # blocks are large, as rows go
        row_blocks = stored(_blocks(rows, ROWS, scale).drop("windows"), "row-blocks")
        row_blocks = row_blocks.withColumn("windows", F.lit(b""))
        alone = rows.where(is_anchor).groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("least"))
        anchors = stored(alone.select("vec_id", "least.*"), "anchors")
        anchor_blocks = stored(_blocks(anchors, ANCHORS, scale).drop("windows"), "anchor-blocks")
        anchor_blocks = anchor_blocks.withColumn("windows", F.lit(b""))
        found = stored(positives(anchor_blocks, row_blocks, n_positives), "positives")
        asked = found.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_set(spans).alias("windows"))
        # Merged: the sizes of files say little of the rows in them, and neither side is to be broadcast.
        asked = anchors.join(asked.hint("merge"), "vec_id")
        asked_blocks = stored(_blocks(asked, ANCHORS, scale), "asked-blocks")
        most = n_positives * n_negatives
        negatives = _compared(asked_blocks, row_blocks, _NEGATIVE, n_negatives, most, False)
        negatives = stored(negatives, "negatives")

    def opened(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, windows = None, []
        for batch in batches(frames):
            out = []
            for key in unpacked(batch.column("key")):
                anchor, score, kind, other, _ = key
                if last is None or anchor != last[0]:
                    windows = []
                if kind == _POSITIVE:
                    least, most = -(-score * least_percent // 100), score * most_percent // 100
                    windows.append([least, most, other, score, 0])
                elif key != last:
                    for w in windows:
                        if w[4] < n_negatives and w[0] <= score <= w[1]:
                            w[4] += 1
                            out.append((anchor, w[2], w[4], other, w[3], score))
                last = key
            yield pa.RecordBatch.from_pylist([dict(zip(result.names, r, strict=True)) for r in out], schema=result)

    result = pa.schema(
        [("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("rank", pa.int32()),
         ("negative_id", pa.int64()), ("positive_score", pa.int64()), ("negative_score", pa.int64())]
    )
    return _secondary_sort(negatives.unionByName(_as_keys(found))).mapInArrow(
        opened,
        "anchor_id bigint, positive_id bigint, rank int, negative_id bigint,"
        " positive_score bigint, negative_score bigint",
    )


def _as_keys(found: DataFrame) -> DataFrame:
    """The keys of positives."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(frames):
            anchors, ids, scores = (
                batch.column(c).to_numpy() for c in ("anchor_id", "positive_id", "positive_score")
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchors), packed_keys(anchors, scores, _POSITIVE, ids, 0)], names=["anchor_id", "key"]
            )

    return found.mapInArrow(run, "anchor_id bigint, key binary")

"""Token ids in files of directly addressable codes: any token is read without decoding others.

An id is split into chunks of ``bits`` bits, lowest first. Level 0 holds the first chunk of
every id, level 1 the second chunk of those that have one, and so on. Each level has a bitmap
that marks the ids which go on in the next level, and a rank directory with the number of
marks before every block of 512 bits, so the place of an id in the next level is found by one
look-up and the count of at most eight words.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docketspark.llm.common import shuffle_parts, sliced, small_batches, text_of
from docketspark.llm.tokens import SLICE_BYTES, SLICE_ROWS, encoder, tokenizer_path
from docketspark.session import scratch_dir
from docketspark.sources.files import open_input

MAGIC = b"DACIDS01"
BLOCK = 512
# Ids of one segment file; a longer document has a file of its own.
SEGMENT_IDS = 1 << 22
# Segments that Python works on at a time.
SEGMENT_ROWS = 4
# Ids of the blocks by which positions find their segment.
_STEP = 1 << 20

_POPCOUNT = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def encode_levels(ids: np.ndarray, bits: int = 8) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(chunks, bitmap bytes, rank directory) of each level."""
    rest, levels = ids.astype(np.uint32), []
    kind = np.uint8 if bits <= 8 else np.uint16
    while len(rest) or not levels:
        more = (rest >> np.uint32(bits)) > 0
        bitmap = np.packbits(more, bitorder="little")
        padded = np.zeros(-(-len(bitmap) // (BLOCK // 8)) * (BLOCK // 8), np.uint8)
        padded[: len(bitmap)] = bitmap
        counts = _POPCOUNT[padded].reshape(-1, BLOCK // 8).sum(axis=1, dtype=np.uint64)
        ranks = np.zeros(len(counts) + 1, np.uint64)
        np.cumsum(counts, out=ranks[1:])
        chunk = (rest & np.uint32((1 << bits) - 1)).astype(kind)
        levels.append((chunk, padded, ranks))
        rest = rest[more] >> np.uint32(bits)
    return levels


class Segment:
    """A segment file's content: documents in order, and their ids in levels."""

    def __init__(self, content: bytes):
        if content[:8] != MAGIC:
            raise ValueError("not a token file")
        self.bits, n_levels, self.n_docs, self.n_ids = struct.unpack_from("<IIQQ", content, 8)
        at = 32
        tables = []
        for kind, n in ((np.int64, self.n_docs), (np.uint8, self.n_docs), (np.uint64, self.n_docs + 1)):
            tables.append(np.frombuffer(content, np.dtype(kind).newbyteorder("<"), n, at))
            at += tables[-1].nbytes
        self.doc_ids, self.known, self.starts = tables
        kind = np.dtype(np.uint8 if self.bits <= 8 else "<u2")
        self.levels = []
        for _ in range(n_levels):
            n, n_bitmap, n_ranks = struct.unpack_from("<QQQ", content, at)
            at += 24
            level = []
            for kind_of, count in ((kind, n), (np.dtype(np.uint8), n_bitmap), (np.dtype("<u8"), n_ranks)):
                level.append(np.frombuffer(content, kind_of, count, at))
                at += level[-1].nbytes
            self.levels.append(level)
        if at != len(content):
            raise ValueError("token file of wrong length")

    def at(self, places: np.ndarray) -> np.ndarray:
        """Ids at the given places, each found by itself."""
        places = np.asarray(places, np.int64)
        if len(places) and (places.min() < 0 or places.max() >= self.n_ids):
            raise IndexError("no such token")
        ids = np.zeros(len(places), np.uint32)
        which = np.arange(len(places))
        for level, (chunks, bitmap, ranks) in enumerate(self.levels):
            ids[which] |= chunks[places].astype(np.uint32) << np.uint32(level * self.bits)
            more = (bitmap[places >> 3] >> (places & 7).astype(np.uint8)) & 1 == 1
            which, places = which[more], places[more]
            if not len(which):
                break
            places = self._rank(bitmap, ranks, places)
        return ids

    @staticmethod
    def _rank(bitmap: np.ndarray, ranks: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Marks before each place: the directory's count and those within the block."""
        block = places // BLOCK
        inside = bitmap.reshape(-1, BLOCK // 8)
        found = np.empty(len(places), np.int64)
        for part in range(0, len(places), 1 << 16):  # 64 bytes are looked at for each place
            cut = slice(part, part + (1 << 16))
            byte = (places[cut] % BLOCK) >> 3
            words = _POPCOUNT[inside[block[cut]]]
            words[np.arange(BLOCK // 8) >= byte[:, None]] = 0
            last = bitmap[places[cut] >> 3] & ((1 << (places[cut] & 7)) - 1).astype(np.uint8)
            found[cut] = words.sum(axis=1, dtype=np.int64) + _POPCOUNT[last]
        return found + ranks[block].astype(np.int64)

    def checked(self) -> np.ndarray:
        """All ids in order, held against the directories: each of them has to count its
        bitmap, and every document's first and last id, looked up by them, has to be the one
        that stands there. Any difference is an error."""
        for _, bitmap, ranks in self.levels:
            counts = _POPCOUNT[bitmap].reshape(-1, BLOCK // 8).sum(axis=1, dtype=np.uint64)
            if ranks[0] or not np.array_equal(np.cumsum(counts), ranks[1:]):
                raise ValueError("token file with a damaged rank directory")
        ids, starts = self.all(), self.starts.astype(np.int64)
        filled = starts[:-1] < starts[1:]
        ends = np.concatenate([starts[:-1][filled], starts[1:][filled] - 1])
        if not np.array_equal(self.at(ends), ids[ends]):
            raise ValueError("token file whose directories do not lead to its ids")
        return ids

    def all(self) -> np.ndarray:
        """All ids in order: a level's marked places are those of the next level."""
        if not self.n_ids:
            return np.zeros(0, np.uint32)
        higher = None
        for level in reversed(range(len(self.levels))):
            chunks, bitmap, _ = self.levels[level]
            ids = chunks.astype(np.uint32)
            if higher is not None:
                more = np.unpackbits(bitmap, count=len(ids), bitorder="little").view(bool)
                ids[more] |= higher << np.uint32(self.bits)
            higher = ids
        return higher


class SegmentFile:
    """Single ids of a segment file where it lies: of each level a chunk, one block of the
    bitmap and one entry of the directory are read, whatever the file's size."""

    def __init__(self, file: pa.NativeFile):
        self.file = file
        if self._read(8, 0) != MAGIC:
            raise ValueError("not a token file")
        self.bits, n_levels, n_docs, self.n_ids = struct.unpack("<IIQQ", self._read(24, 8))
        self.width = 1 if self.bits <= 8 else 2
        at, self.levels = 32 + 9 * n_docs + 8 * (n_docs + 1), []
        for _ in range(n_levels):
            n, n_bitmap, n_ranks = struct.unpack("<QQQ", self._read(24, at))
            chunks, bitmap = at + 24, at + 24 + self.width * n
            self.levels.append((chunks, bitmap, bitmap + n_bitmap))
            at = bitmap + n_bitmap + 8 * n_ranks

    def _read(self, n: int, at: int) -> bytes:
        data = self.file.read_at(n, at)
        if len(data) != n:
            raise ValueError("token file of wrong length")
        return data

    def at(self, place: int) -> int:
        if not 0 <= place < self.n_ids:
            raise IndexError("no such token")
        found = 0
        for level, (chunks, bitmap, ranks) in enumerate(self.levels):
            chunk = self._read(self.width, chunks + self.width * place)
            found |= int.from_bytes(chunk, "little") << (level * self.bits)
            block, inside = divmod(place, BLOCK)
            marks = int.from_bytes(self._read(BLOCK // 8, bitmap + block * (BLOCK // 8)), "little")
            if not marks >> inside & 1:
                break
            before = (marks & ((1 << inside) - 1)).bit_count()
            place = int.from_bytes(self._read(8, ranks + 8 * block), "little") + before
        return found


def segment_bytes(doc_ids: list[int | None], ids: list[bytes], bits: int = 8) -> bytes:
    """A segment file of documents given as little-endian unsigned 32-bit ids."""
    starts = np.zeros(len(ids) + 1, np.uint64)
    np.cumsum([len(x) // 4 for x in ids], out=starts[1:])
    levels = encode_levels(np.frombuffer(b"".join(ids), "<u4"), bits)
    known = np.array([x is not None for x in doc_ids], np.uint8)
    numbers = np.array([x or 0 for x in doc_ids], "<i8")
    out = [MAGIC, struct.pack("<IIQQ", bits, len(levels), len(ids), int(starts[-1]))]
    out += [numbers.tobytes(), known.tobytes(), starts.astype("<u8").tobytes()]
    for chunks, bitmap, ranks in levels:
        out.append(struct.pack("<QQQ", len(chunks), len(bitmap), len(ranks)))
        out.append(chunks.astype(chunks.dtype.newbyteorder("<")).tobytes())
        out += [bitmap.tobytes(), ranks.astype("<u8").tobytes()]
    return b"".join(out)


def write_file(folder: str, name: str, content: bytes) -> None:
    """Write a file of a shared folder under a passing name, then move it in place, so that
    readers never see part of a file and a repeated task replaces it by the same content."""
    import uuid

    from pyarrow import fs

    system, root = fs.FileSystem.from_uri(folder)
    system.create_dir(root, recursive=True)
    passing = f"{root}/_{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(passing) as out:
        out.write(content)
    system.move(passing, f"{root}/{name}")


def write_tokens(
    docs: DataFrame,
    folder: str | None = None,
    path: str | None = None,
    end_id: int = 2,
    bits: int = 8,
    segment_ids: int = SEGMENT_IDS,
) -> str:
    """Encode ``docs`` (doc_id, text) and write their ids in ascending ``doc_id`` order.

    Documents are range-partitioned by id and sorted, then encoded and written by the task
    that holds them; a task holds one segment's ids at a time. ``folder`` (below the shared
    scratch folder if not given) gets the segments in ``ids/`` and, as a Parquet table in
    ``segments/``, each segment's first position: an exclusive sum over one row per
    partition, then over a partition's own segments.

    Null texts count as empty, null ids come first, repeated ids in order of text; an empty
    table gives an empty list of segments. Returns the folder.
    """
    spark = docs.sparkSession
    folder = folder or scratch_dir(spark, "tokens")
    path = path or tokenizer_path()
    schema = "part int, segment int, name string, n_docs bigint, n_ids bigint"

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = encoder(path).encode_column
        part, made, held, doc_ids, ids = TaskContext.get().partitionId(), 0, 0, [], []

        def written() -> pa.RecordBatch:
            nonlocal made
            name = f"part-{part:06d}-{made:06d}.dac"
            write_file(f"{folder}/ids", name, segment_bytes(doc_ids, ids, bits))
            row = {"part": part, "segment": made, "name": name, "n_docs": len(ids), "n_ids": held}
            made += 1
            types = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
            arrays = [pa.array([v], t) for v, t in zip(row.values(), types, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=list(row))

        for batch in sliced(small_batches(frames, SLICE_ROWS), "text", SLICE_BYTES):
            known = encode(batch.column("text"), end_id)
            for doc_id, new in zip(batch.column("doc_id").to_pylist(), known, strict=True):
                if ids and held + len(new) // 4 > segment_ids:
                    yield written()
                    held, doc_ids, ids = 0, [], []
                doc_ids.append(doc_id)
                ids.append(new)
                held += len(new) // 4
        if ids:
            yield written()

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    parts = shuffle_parts(docs)
    ordered = rows.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(run, schema).write.parquet(f"{folder}/written")
    made = spark.read.schema(schema).parquet(f"{folder}/written")
    sums = made.groupBy("part").agg(F.sum("n_ids").alias("_ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("part", F.coalesce(F.sum("_ids").over(before), F.lit(0)).alias("_base"))
    inner = (
        Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    )
    first = F.col("_base") + F.coalesce(F.sum("n_ids").over(inner), F.lit(0))
    placed = made.join(bases, "part").withColumn("first", first).drop("_base")
    placed.write.parquet(f"{folder}/segments")
    return folder


def segments(spark: SparkSession, folder: str) -> DataFrame:
    """``name, n_docs, n_ids, first`` of each segment."""
    return spark.read.parquet(f"{folder}/segments").select("name", "n_docs", "n_ids", "first")


def _files(spark: SparkSession, folder: str) -> DataFrame | None:
    """``name, path`` and, where it is asked for, ``content`` of the files."""
    from pyarrow import fs

    system, root = fs.FileSystem.from_uri(folder)
    if system.get_file_info(f"{root}/ids").type == fs.FileType.NotFound:
        return None  # no document was written
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.dac").load(f"{folder}/ids")
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "path", "content")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of the files: ``doc_id, start`` (ids of all before it), ``n_tokens, ids``
    (little-endian unsigned 32-bit). A file whose directories do not lead to its ids is
    refused."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(frames, SEGMENT_ROWS):
            for first, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                segment = Segment(content)
                ids = segment.checked().astype("<u4").tobytes()
                ends = segment.starts.astype(np.int64)
                cuts = [ids[4 * a : 4 * b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(segment.doc_ids, pa.int64(), mask=segment.known == 0),
                        pa.array(first + ends[:-1]),
                        pa.array(np.diff(ends)),
                        pa.array(cuts, pa.binary()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    schema = "doc_id bigint, start bigint, n_tokens bigint, ids binary"
    files = _files(spark, folder)
    if files is None:
        return spark.createDataFrame([], schema)
    placed = segments(spark, folder).select("name", "first")
    joined = files.join(placed, "name").select("first", "content")
    return joined.mapInArrow(run, schema)


def tokens_at(spark: SparkSession, folder: str, positions: DataFrame) -> DataFrame:
    """``position, id`` of each distinct ``position`` (counted over all documents).

    Positions meet the segments that overlap their block of 2**20 ids, are collected per
    segment as far as one segment reaches, and of its file only their bytes are read. Positions
    beyond the last id, and nulls, give no row.
    """
    schema = "position bigint, id bigint"
    files = _files(spark, folder)
    if files is None:
        return spark.createDataFrame([], schema)
    blocks = F.sequence(F.expr(f"first div {_STEP}"), F.expr(f"(first + n_ids - 1) div {_STEP}"))
    known = segments(spark, folder).where("n_ids > 0").withColumn("_block", F.explode(blocks))
    asked = positions.select(F.col("position").cast("bigint").alias("position")).distinct()
    asked = asked.withColumn("_block", F.expr(f"position div {_STEP}"))
    found = asked.join(known, "_block").where("position >= first and position < first + n_ids")
    wanted = found.groupBy("name").agg(
        F.min("first").alias("first"), F.collect_list(F.col("position")).alias("positions")
    )

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(frames):
            for first, places, path in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with open_input(unquote(path)) as file:
                    segment = SegmentFile(file)
                    ids = [segment.at(place - first) for place in places]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(places, pa.int64()), pa.array(ids, pa.int64())], names=["position", "id"]
                )

    joined = wanted.join(files.select("name", "path"), "name").select("first", "positions", "path")
    return joined.mapInArrow(run, schema)

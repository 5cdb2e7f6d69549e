"""ZIP archives: listed once, then read in parallel by ranges of members.

Only names and offsets travel between tasks. A directory is read as a stream of its
entries. Each task opens the archive where it lies (a path all executors can reach) and
streams its own range of members, so one very large archive is spread over the cluster
and no archive or member list has to fit in memory. The length and checksum that the
directory gives for a member are held against its data.
"""

from __future__ import annotations

import struct
import sys
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketspark.sources.files import open_input, record_batches

# The functions below travel to the tasks themselves, so this package need not be
# installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Members whose data lies in the same stretch of an archive share a task.
RANGE_BYTES = 8 << 20
# Longer members come as several rows, numbered by ``part``.
PART_BYTES = 256 << 20
# The longest member that is taken whole, as one value: Spark holds none of 2 GB.
WHOLE_BYTES = 1_900 << 20
_LOCAL_HEADER = 30

MEMBER_SCHEMA = (
    "archive string, member string, position bigint, offset bigint, method int, "
    "compressed_length bigint, length bigint, crc bigint"
)
CONTENT_SCHEMA = (
    "archive string, member string, position bigint, part int, content binary, error string"
)


def list_archives(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The archives as they are: ``archive, length, modified``; content is not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    files = reader.option("pathGlobFilter", "*.zip").load(path)
    return files.select(
        F.col("path").alias("archive"), "length", F.col("modificationTime").alias("modified")
    )


_MEMBER_ARROW = pa.schema(
    [
        ("archive", pa.string()),
        ("member", pa.string()),
        ("position", pa.int64()),
        ("offset", pa.int64()),
        ("method", pa.int32()),
        ("compressed_length", pa.int64()),
        ("length", pa.int64()),
        ("crc", pa.int64()),
    ]
)
_CONTENT_ARROW = pa.schema(
    [
        ("archive", pa.string()),
        ("member", pa.string()),
        ("position", pa.int64()),
        ("part", pa.int32()),
        ("content", pa.binary()),
        ("error", pa.string()),
    ]
)


# Fixed values of the file format: marks of its records, and their sizes without names.
_END, _END64, _LOCATOR64, _ENTRY, _LOCAL = (
    b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
)
_END_SIZE, _LOCATOR64_SIZE, _END64_SIZE, _ENTRY_SIZE = 22, 20, 56, 46
_LONGEST_COMMENT = 65_535
_IN_EXTRA, _UTF8_NAME = 0xFFFFFFFF, 0x800


def _read(handle, length: int, what: str) -> bytes:
    """Exactly ``length`` bytes; less is an error."""
    data = handle.read(length)
    if len(data) != length:
        raise ValueError(f"{what} is cut short")
    return bytes(data)


def _directory(name: str, handle) -> tuple[int, int, int]:
    """Where an archive's directory starts, its entries, and what stands before the archive."""
    size = handle.size() if hasattr(handle, "size") else handle.seek(0, 2)
    tail = min(size, _END_SIZE + _LONGEST_COMMENT)
    handle.seek(size - tail)
    data = _read(handle, tail, name)
    at = data.rfind(_END)
    if at < 0 or len(data) - at < _END_SIZE:
        raise ValueError(f"{name} is no ZIP archive")
    count, length, start = struct.unpack_from("<HLL", data, at + 10)
    end = size - tail + at
    if 0xFFFF == count or _IN_EXTRA in (length, start):
        handle.seek(end - _LOCATOR64_SIZE)
        locator = _read(handle, _LOCATOR64_SIZE, name)
        if locator[:4] == _LOCATOR64:
            end = end - _LOCATOR64_SIZE - _END64_SIZE
            handle.seek(end)
            record = _read(handle, _END64_SIZE, name)
            if record[:4] != _END64:
                raise ValueError(f"{name} has no directory where it should be")
            count, length, start = struct.unpack_from("<QQQ", record, 32)
    return end - length, count, end - length - start


def _wide(extra: bytes, values: list[int]) -> list[int]:
    """Sizes and offset of an entry; those that do not fit its fields are in its extra data."""
    at = 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            numbers = iter(struct.unpack_from(f"<{length // 8}Q", extra, at + 4))
            return [next(numbers, v) if v == _IN_EXTRA else v for v in values]
        at += 4 + length
    return values


def _entries(name: str, handle) -> Iterator[tuple]:
    """The files of a directory, read one entry after another."""
    start, count, before = _directory(name, handle)
    handle.seek(start)
    for position in range(count):
        entry = _read(handle, _ENTRY_SIZE, f"{name}: the directory")
        if entry[:4] != _ENTRY:
            raise ValueError(f"{name} has a damaged directory")
        flags, method, _, _, crc, packed, length, *lengths = struct.unpack_from("<HHHHLLLHHH", entry, 8)
        (offset,) = struct.unpack_from("<L", entry, 42)
        title, extra, _ = (_read(handle, n, f"{name}: the directory") for n in lengths)
        length, packed, offset = _wide(extra, [length, packed, offset])
        member = title.decode("utf-8" if flags & _UTF8_NAME else "cp437")
        if not member.endswith("/"):
            yield (name, member, position, offset + before, method, packed, length, crc)


def _list_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for batch in batches:
            for name in batch.column("archive").to_pylist():
                with open_input(name) as handle:
                    yield from _entries(name, handle)

    yield from record_batches(rows(), _MEMBER_ARROW, lambda row: 128 + len(row[1]))


def archive_members(archives: DataFrame) -> DataFrame:
    """One row per file in each archive, from the archives' own directories."""
    return archives.select("archive").mapInArrow(_list_members, MEMBER_SCHEMA)


def _inflate(handle, entry: dict, part_bytes: int) -> Iterator[bytes]:
    """The member's data in pieces of at most ``part_bytes``; a member that is not what its
    directory entry says is an error."""
    what = f"{entry['archive']}: {entry['member']}"
    handle.seek(entry["offset"])
    header = _read(handle, _LOCAL_HEADER, what)
    if header[:4] != _LOCAL:
        raise ValueError(f"{what} is not where the directory says")
    if int.from_bytes(header[6:8], "little") & 1:
        raise ValueError(f"{what} is encrypted")
    name_length = int.from_bytes(header[26:28], "little")
    extra_length = int.from_bytes(header[28:30], "little")
    handle.seek(entry["offset"] + _LOCAL_HEADER + name_length + extra_length)
    length, crc, held = 0, 0, None
    for piece in _pieces(handle, entry, part_bytes, what):
        if held is not None:
            yield held
        length, crc, held = length + len(piece), zlib.crc32(piece, crc), piece
    if length != entry["length"]:
        raise ValueError(f"{what} has {length} bytes, not {entry['length']}")
    if crc != entry["crc"]:
        raise ValueError(f"{what} has a wrong checksum")
    if held is not None:
        yield held  # the last piece, so a member of one piece, is sound when it is given


def _pieces(handle, entry: dict, part_bytes: int, what: str) -> Iterator[bytes]:
    left = entry["compressed_length"]
    if entry["method"] == zipfile.ZIP_STORED:
        while left > 0:
            data = _read(handle, min(part_bytes, left), what)
            left -= len(data)
            yield data
        return
    if entry["method"] != zipfile.ZIP_DEFLATED:
        raise ValueError(f"{what} uses an unsupported method")
    inflater = zlib.decompressobj(-zlib.MAX_WBITS)
    piece, pending = bytearray(), b""
    try:
        while (left > 0 or pending) and not inflater.eof:
            if not pending:
                pending = _read(handle, min(1 << 20, left), what)
                left -= len(pending)
            piece += inflater.decompress(pending, part_bytes - len(piece))
            pending = inflater.unconsumed_tail
            if len(piece) >= part_bytes:
                yield bytes(piece)
                piece = bytearray()
        piece += inflater.flush()
    except zlib.error as error:
        raise ValueError(f"{what} is damaged: {error}") from error
    if piece:
        yield bytes(piece)


def _read_members(part_bytes: int, rejects: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            name, handle = None, None
            for batch in batches:
                for entry in batch.to_pylist():
                    if entry["archive"] != name:
                        if handle is not None:
                            handle.close()
                        name, handle = entry["archive"], open_input(entry["archive"])
                    key = (name, entry["member"], entry["position"])
                    part = 0
                    try:
                        for part, content in enumerate(_inflate(handle, entry, part_bytes)):
                            yield (*key, part, content, None)
                        if not entry["length"]:
                            yield (*key, 0, b"", None)
                    except ValueError as error:
                        if not rejects:
                            raise
                        yield (*key, part, None, str(error))
            if handle is not None:
                handle.close()

        yield from record_batches(rows(), _CONTENT_ARROW, lambda row: 128 + len(row[4] or b""))

    return read


def archive_contents(
    members: DataFrame,
    part_bytes: int = PART_BYTES,
    rejects: bool = False,
    tasks: int | None = None,
) -> DataFrame:
    """The data of the listed members; filter ``members`` first to read only some.

    A member that is cut, damaged, encrypted or packed in an unknown way stops the job, or,
    with ``rejects``, has a row with null content and the reason in ``error``. ``tasks`` is
    the number of partitions (that of shuffles if not given): by the size of the member
    list, which is small, adaptive execution would merge them into a few tasks that read
    everything.
    """
    tasks = tasks or int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stretch = F.expr(f"offset div {RANGE_BYTES}")
    dealt = members.repartition(tasks, "archive", stretch)
    ranges = dealt.sortWithinPartitions("archive", "offset")
    return ranges.mapInArrow(_read_members(part_bytes, rejects), CONTENT_SCHEMA)


def whole_members(members: DataFrame, whole_bytes: int | None = None) -> DataFrame:
    """Members that can come as one row, read with ``whole_bytes`` for ``part_bytes``; only
    those that no value of Spark holds are rejects of jobs that need them whole."""
    return members.where(F.col("length") <= (whole_bytes or WHOLE_BYTES))


def whole_contents(members: DataFrame, **options) -> DataFrame:
    """The data of the members that can be whole, a row each. A row is as long as its
    member: memory is needed only for members that are there."""
    return archive_contents(whole_members(members), part_bytes=WHOLE_BYTES, **options)


def member_text(contents: DataFrame) -> DataFrame:
    """Members as text, ``archive, member, v``; unreadable ones, and those that are not
    UTF-8, are left out."""
    text = F.try_validate_utf8(F.col("content").cast("string")).alias("v")
    return contents.select("archive", "member", text).where("v is not null")


def member_rejects(members: DataFrame, contents: DataFrame) -> DataFrame:
    """``archive, member, reason`` of members that ``member_text`` does not give: too long
    for one row, unreadable, or not UTF-8."""
    long = members.where(F.col("length") > WHOLE_BYTES)
    long = long.select("archive", "member", F.lit("too long for one row").alias("reason"))
    sound = F.try_validate_utf8(F.col("content").cast("string")).isNotNull()
    reason = F.coalesce("error", F.when(~sound, "not UTF-8")).alias("reason")
    unreadable = contents.select("archive", "member", reason).where("reason is not null")
    return long.unionByName(unreadable)

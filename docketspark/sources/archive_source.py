"""ZIP archives as a data source: ``spark.read.format("zip_members").load(folder)``.

A partition is a byte range of one archive and gives the members that begin in it, so one
very large archive is read by many tasks. As a stream, arriving archives are taken in the
order in which they are noticed: names and sizes are written to a log first, and an offset
is the number of a log entry. A trigger that runs again, also after a restart, reads the
same archives, and times of change or names need not be in order.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    InputPartition,
)

from docketspark.sources import archives as zips
from docketspark.sources.files import locate, open_input, record_batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "zip_members"
# Every range reads its archive's directory, so ranges are not small.
RANGE_BYTES = 128 << 20


class Range(InputPartition):
    def __init__(self, archive: str, start: int, end: int):
        self.archive, self.start, self.end = archive, start, end


def listed(path: str) -> list[tuple[str, int]]:
    """``(archive, length)`` of the archives below a folder, or of the one at the path."""
    system, name = locate(path)
    prefix = path[: -len(name)] if path.endswith(name) else ""
    if not prefix and isinstance(system, fs.LocalFileSystem):
        prefix = "file:"  # as Spark names local files
    info = system.get_file_info(name)
    if info.type == fs.FileType.File:
        return [(f"{prefix}{info.path}", info.size)]
    found = system.get_file_info(fs.FileSelector(name, recursive=True, allow_not_found=True))
    return sorted((f"{prefix}{i.path}", i.size) for i in found if i.is_file and i.path.endswith(".zip"))


def ranges(found: list[tuple[str, int]], range_bytes: int) -> list[Range]:
    return [
        Range(name, start, start + range_bytes)
        for name, size in found
        for start in range(0, max(size, 1), range_bytes)
    ]


def _read(part: Range | None, part_bytes: int, rejects: bool) -> Iterator[pa.RecordBatch]:
    """Members that begin in a range, in the order in which they lie there; none without a
    range, which is what Spark reads where there are no archives."""
    if part is None:
        return

    def entries() -> Iterator[tuple]:
        with open_input(part.archive) as handle:
            own = [e for e in zips._entries(part.archive, handle) if part.start <= e[3] < part.end]
        yield from sorted(own, key=lambda entry: entry[3])

    found = record_batches(entries(), zips._MEMBER_ARROW, lambda row: 128 + len(row[1]))
    yield from zips._read_members(part_bytes, rejects)(found)


class _Options:
    def __init__(self, options):
        self.path = options.get("path")
        if not self.path:
            raise ValueError(f"{FORMAT}: give a path")
        self.range_bytes = int(options.get("rangeBytes", RANGE_BYTES))
        self.part_bytes = int(options.get("partBytes", zips.PART_BYTES))
        self.rejects = str(options.get("rejects", "false")).lower() == "true"
        self.log = options.get("log")
        self.per_trigger = int(options.get("archivesPerTrigger", 1 << 30))
        if min(self.range_bytes, self.part_bytes, self.per_trigger) < 1:
            raise ValueError(f"{FORMAT}: sizes and counts are at least 1")


class ArchiveReader(DataSourceReader):
    def __init__(self, options: _Options):
        self.options = options

    def partitions(self) -> list[Range]:
        return ranges(listed(self.options.path), self.options.range_bytes)

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return _read(partition, self.options.part_bytes, self.options.rejects)


class ArchiveStream(DataSourceStreamReader):
    """Archives by number of the log entry that names them; entries count from 1."""

    def __init__(self, options: _Options):
        if not options.log:
            raise ValueError(f"{FORMAT}: a stream needs the option log, a folder of its own")
        self.options = options
        self.system, self.folder = locate(options.log)
        self.known: set[str] = set()
        self.entries = 0

    def _entry(self, number: int) -> list[list]:
        with self.system.open_input_stream(f"{self.folder}/{number:012d}.json") as file:
            return json.loads(file.read())

    def _catch_up(self) -> None:
        """Take over entries that this reader has not seen, such as those before a restart."""
        found = self.system.get_file_info(fs.FileSelector(self.folder, allow_not_found=True))
        last = max((int(i.base_name[:-5]) for i in found if i.base_name.endswith(".json")), default=0)
        for number in range(self.entries + 1, last + 1):
            self.known |= {name for name, _ in self._entry(number)}
        self.entries = last

    def initialOffset(self) -> dict:
        return {"entry": 0}

    def latestOffset(self) -> dict:
        """Log archives that are new, if there are any; complete archives are expected to be
        moved into the folder. The entry appears under its name as a whole or not at all."""
        self._catch_up()
        new = [a for a in listed(self.options.path) if a[0] not in self.known]
        if new:
            taken = new[: self.options.per_trigger]
            self.system.create_dir(self.folder, recursive=True)
            draft = f"{self.folder}/{uuid.uuid4().hex}.draft"
            with self.system.open_output_stream(draft) as file:
                file.write(json.dumps(taken).encode())
            self.system.move(draft, f"{self.folder}/{self.entries + 1:012d}.json")
            self.entries += 1
            self.known |= {name for name, _ in taken}
        return {"entry": self.entries}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        found = [
            (name, size) for number in range(start["entry"] + 1, end["entry"] + 1) for name, size in self._entry(number)
        ]
        return ranges(found, self.options.range_bytes)

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return _read(partition, self.options.part_bytes, self.options.rejects)

    def __getstate__(self) -> dict:
        return {"options": self.options}  # what a task needs

    def __setstate__(self, state: dict) -> None:
        self.options = state["options"]


class ArchiveSource(DataSource):
    """Options: ``rangeBytes``, ``partBytes`` (longer members come as several rows),
    ``rejects`` (unreadable members as rows with the reason); for streams ``log``, a folder
    beside the checkpoint that is kept with it, and ``archivesPerTrigger``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return zips.CONTENT_SCHEMA

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(_Options(self.options))

    def streamReader(self, schema) -> ArchiveStream:
        return ArchiveStream(_Options(self.options))


def register(spark: SparkSession) -> None:
    """Make the format known to a session."""
    spark.dataSource.register(ArchiveSource)

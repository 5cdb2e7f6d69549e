"""Files as tasks see them, and the listing of stored files."""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The functions below travel to the tasks themselves, so this package need not be
# installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_BATCH_BYTES = 32 << 20

MANIFEST_SCHEMA = "file_path string, length bigint, modified timestamp"


def locate(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path in it."""
    if "://" in path and not path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), re.sub("^file:(//)?", "", path)


def open_input(path: str) -> pa.NativeFile:
    system, name = locate(path)
    return system.open_input_file(name)


def record_batches(
    rows: Iterator[tuple], schema: pa.Schema, size_of: Callable[[tuple], int]
) -> Iterator[pa.RecordBatch]:
    """Rows in record batches bounded by bytes."""
    pending, size = [], 0
    for row in rows:
        pending.append(row)
        size += size_of(row)
        if size >= _BATCH_BYTES:
            yield _record_batch(pending, schema)
            pending, size = [], 0
    if pending:
        yield _record_batch(pending, schema)


def _record_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(values, kind) for values, kind in zip(zip(*rows), schema.types)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def list_stored_files(spark: SparkSession, root: str) -> DataFrame:
    """Manifest ``file_path, length, modified`` of all files below ``root/filings``.

    Only names are listed; the content column is pruned and no file is opened.
    Spark keeps such a listing on the driver: for a very large tree use
    ``stored_files_of``, which lists in the tasks.
    """
    folder = f"{root.rstrip('/')}/filings/"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.select(
        F.substring_index("path", "/filings/", -1).alias("file_path"),
        "length",
        F.col("modificationTime").alias("modified"),
    )


_MANIFEST_ARROW = pa.schema(
    [
        ("file_path", pa.string()),
        ("length", pa.int64()),
        ("modified", pa.timestamp("us", tz="UTC")),
    ]
)


def stored_files_of(index: DataFrame, root: str) -> DataFrame:
    """Manifest of the files in the folders an index names.

    One folder holds the files of one filing. The folders are spread over the
    tasks, each of which lists its own, so a company with many filings is no
    larger piece of work than many companies with few.
    """
    base = f"{root.rstrip('/')}/filings"

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, start = locate(base)

        def rows() -> Iterator[tuple]:
            for batch in batches:
                for folder in batch.column("folder").to_pylist():
                    wanted = fs.FileSelector(f"{start}/{folder}", allow_not_found=True)
                    for info in system.get_file_info(wanted):
                        if info.is_file:
                            yield f"{folder}/{info.base_name}", info.size, info.mtime

        yield from record_batches(rows(), _MANIFEST_ARROW, lambda row: 64 + len(row[0]))

    folders = index.select(F.regexp_extract("file_path", "^(.*)/[^/]*$", 1).alias("folder"))
    return folders.distinct().mapInArrow(listed, MANIFEST_SCHEMA)

"""Document fingerprints by winnowing."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docketspark.llm.common import (
    small_batches,
    mix64,
    range_hashes,
    shuffle_parts,
    stored,
    text_of,
)

# Code points of a gram, and grams of a window: every passage of GRAM + WINDOW - 1 code
# points that two texts share gives them a common fingerprint, none shorter than GRAM does.
GRAM = 16
WINDOW = 8


def _rightmost_minimum(hashes: np.ndarray, window: int) -> np.ndarray:
    """Index of the least hash of every run of ``window``; of equal ones the rightmost.

    Runs are doubled until they cover a window, which two overlapping runs then do.
    """
    places = np.arange(len(hashes))
    values, width = hashes, 1
    while width < window:
        step = min(width, window - width)
        left, right = values[:-step], values[step:]
        places = np.where(right <= left, places[step:], places[:-step])
        values = np.minimum(left, right)
        width += step
    return places


def winnow(texts: list[str], gram: int = GRAM, window: int = WINDOW):
    """Fingerprints of several texts: (ends, hashes, positions), text i's between
    ``ends[i]`` and ``ends[i + 1]``.

    Hashes are of ``gram`` code points, kept to 32 bits, with the position of the gram's
    first code point. A text shorter than a gram is one gram; one with fewer grams than a
    window is one window; an empty text has no fingerprint.
    """
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    lengths = np.array([len(t) for t in texts], np.int64)
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    grams = np.where(lengths > 0, np.maximum(lengths - gram + 1, 1), 0)
    windows = np.where(grams > 0, np.maximum(grams - window + 1, 1), 0)
    total = len(codes)
    starts = np.arange(total)
    # The hash at every place; those of grams that would reach into the next text are not used.
    hashes = range_hashes(
        mix64(codes.astype(np.uint64) + np.uint64(1)), starts, np.minimum(starts + gram, total)
    ) if total else np.zeros(0, np.uint64)
    short = np.flatnonzero((lengths > 0) & (lengths < gram))
    if len(short):
        hashes[offsets[short]] = range_hashes(
            mix64(codes.astype(np.uint64) + np.uint64(1)), offsets[short], offsets[short + 1]
        )
    chosen = []
    few = np.flatnonzero((grams > 0) & (grams < window))
    for text in few:  # one window that is shorter than the others
        run = hashes[offsets[text] : offsets[text] + grams[text]]
        chosen.append(np.array([offsets[text] + len(run) - 1 - run[::-1].argmin()]))
    if total >= window:
        least = _rightmost_minimum(hashes, window)
        inside = np.zeros(len(least) + 1, np.int32)
        full = np.flatnonzero(grams >= window)
        np.add.at(inside, offsets[full], 1)
        np.add.at(inside, offsets[full] + windows[full], -1)
        chosen.append(least[np.cumsum(inside[:-1]) > 0])
    places = np.unique(np.concatenate(chosen)) if chosen else np.zeros(0, np.int64)
    ends = np.searchsorted(places, offsets)
    owner = np.searchsorted(offsets, places, side="right") - 1
    return ends, (hashes[places] >> np.uint64(32)).astype(np.uint32), places - offsets[owner]


def as_string(hashes: np.ndarray, positions: np.ndarray) -> str:
    """16 hex digits per fingerprint: hash and position, both big-endian 32-bit."""
    pairs = np.empty((len(hashes), 2), ">u4")
    pairs[:, 0], pairs[:, 1] = hashes, positions
    return pairs.tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted sets of hashes; two empty sets are alike."""
    if not len(a) and not len(b):
        return 1.0
    both = np.concatenate([a, b])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return common / (len(a) + len(b) - common)


def fingerprints(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """``doc_id, hashes, positions`` of each row of ``docs`` (doc_id, text), in one pass.

    Equal texts have equal fingerprints. Null texts count as empty and have none; null ids
    and repeated rows stay as they are; an empty table gives no rows; other columns are
    ignored.
    """

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(frames):
            ends, hashes, positions = winnow(batch.column(1).to_pylist(), gram, window)
            cuts = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.ListArray.from_arrays(cuts, pa.array(hashes.astype(np.int64))),
                    pa.ListArray.from_arrays(cuts, pa.array(positions.astype(np.int64))),
                ],
                names=["doc_id", "hashes", "positions"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    schema = "doc_id bigint, hashes array<bigint>, positions array<bigint>"
    return rows.mapInArrow(run, schema)


def with_neighbours(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """``docs`` (doc_id, text) cut into ``parts`` runs of descending ``doc_id``.

    Columns ``_part, _own, doc_id, text``, partitioned by ``_part`` and sorted within. Each
    run ends with a copy (``_own`` false) of the first row of the next run that has rows;
    after the last run comes the first one's. The limits are quantiles of the ids, so runs
    are even and there are no more limits than runs. Of rows with the same id, that with the
    lesser text comes first; null ids come last.
    """
    parts = parts or shuffle_parts(docs)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    shares = [i / parts for i in range(1, parts)]
    found = rows.approxQuantile("doc_id", shares, 0.1 / parts) if shares else []
    limits = np.array(sorted({int(x) for x in found}), np.int64)

    @F.pandas_udf("int")
    def run_of(ids: pd.Series) -> pd.Series:
        """Run 0 holds the highest ids; null ids are in the last run."""
        return pd.Series(len(limits) - np.searchsorted(limits, ids.to_numpy(), side="right"))

    # Whole numbers with nulls reach pandas as floats, so null is replaced before.
    key = F.coalesce("doc_id", F.lit(-(1 << 63)).cast("bigint"))
    placed = rows.withColumn("_part", run_of(key))
    heads = placed.groupBy("_part").agg(F.max("doc_id").alias("_top"))  # a row per run
    ranked = heads.withColumn("_rank", F.row_number().over(Window.orderBy("_part")))
    every = Window.orderBy("_part").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    counted = ranked.withColumn("_count", F.count(F.lit(1)).over(every))
    target = counted.select(
        F.col("_part").alias("_run"), "_top", F.expr("pmod(_rank - 2, _count) + 1").alias("_rank")
    )
    before = target.join(ranked.select("_rank", F.col("_part").alias("_to")), "_rank").drop("_rank")
    before = F.broadcast(stored(before, "run-heads"))  # no more rows than runs
    is_head = F.col("doc_id").eqNullSafe(F.col("_top"))
    joined = placed.join(before, placed["_part"] == before["_run"])
    own = F.struct("_part", F.lit(True).alias("_own"))
    head = F.struct(F.col("_to").alias("_part"), F.lit(False).alias("_own"))
    places = F.when(is_head, F.array(own, head)).otherwise(F.array(own))
    copies = joined.select(F.explode(places).alias("_p"), "doc_id", "text")
    flat = copies.select("_p._part", "_p._own", "doc_id", "text")
    return flat.repartition(parts, "_part").sortWithinPartitions(
        "_part", F.col("_own").desc(), F.col("doc_id").desc_nulls_last(), "text"
    )


def edited(text: str, following: str) -> str:
    """The last half of a text replaced by as many code points of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare_with_edits(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Fingerprints of each text and of its edited text, and how alike they are.

    The next document is that of the next lower ``doc_id``; the first comes after the last.
    Rows: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``. A single document is its own next one.

    Null texts count as empty; null ids come last, repeated ids in order of text, and every
    row has a result; an empty table gives no rows; other columns are ignored.
    """
    schema = (
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string,"
        " edited_fingerprint string, near_edited double, near_next double"
    )
    names = [field.split()[0] for field in schema.split(",")]

    def compared(doc_ids: list, texts: list[str]) -> pa.RecordBatch:
        """Of all texts but the last, which is only the one before's next."""
        n = len(texts) - 1
        edits = [edited(texts[i], texts[i + 1]) for i in range(n)]
        ends, hashes, positions = winnow(texts + edits, gram, window)
        cut = [slice(a, b) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        sets = [np.unique(hashes[c]) for c in cut]
        strings = [as_string(hashes[c], positions[c]) for c in cut]
        digests = [hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest() for e in edits]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(doc_ids[:n], pa.int64()),
                pa.array([len(t) for t in texts[:n]], pa.int64()),
                pa.array(digests, pa.string()),
                pa.array(strings[:n], pa.string()),
                pa.array(strings[n + 1 :], pa.string()),
                pa.array([likeness(sets[i], sets[n + 1 + i]) for i in range(n)], pa.float64()),
                pa.array([likeness(sets[i], sets[i + 1]) for i in range(n)], pa.float64()),
            ],
            names=names,
        )

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, doc_ids, texts = None, [], []
        for batch in small_batches(frames):
            for at, own, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at != part:
                    part, doc_ids, texts, closed = at, [], [], False
                if closed:
                    continue  # another row with the id of the next run's head
                doc_ids.append(doc_id)
                texts.append(text)
                closed = not own
                if closed or len(texts) > 64:
                    yield compared(doc_ids, texts)
                    doc_ids, texts = doc_ids[-1:], texts[-1:]

    return with_neighbours(docs).mapInArrow(run, schema)

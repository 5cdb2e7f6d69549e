"""Quality classifier by compression with dictionaries of good and of bad text."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketspark.llm.common import small_batches, text_of
from docketspark.llm.quality_rules import sample_of_labels

# Labelled documents of each label that are looked at, at most; the even ones (in order of
# their hash) build the dictionaries and the others the calibration.
SAMPLE_ROWS = 3_000
# Pieces of one labelled document, spread evenly over its whole text, at most.
SAMPLE_PIECES = 32
# Bytes that are compressed by themselves, so that a dictionary matters throughout a text.
PIECE = 512
DICTIONARY_BYTES = 112_640
LEVEL = 3
THRESHOLD = 0.3


def held_out(doc_id: int | None) -> bool:
    """Rows that nothing is learnt from: crc32 of the id as text, modulo 5, is 0."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


def pieces(text: bytes) -> list[bytes]:
    return [text[i : i + PIECE] for i in range(0, len(text), PIECE)]


@dataclass
class Model:
    """Dictionaries and the calibration's weights; small enough to go to every task."""

    good: bytes
    bad: bytes
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def compressors(self):
        import zstandard

        made = []
        for content in (self.good, self.bad):
            kind = zstandard.DICT_TYPE_AUTO if content else zstandard.DICT_TYPE_RAWCONTENT
            known = zstandard.ZstdCompressionDict(content or b"\n" * 8, dict_type=kind)
            known.precompute_compress(level=LEVEL)
            made.append(
                zstandard.ZstdCompressor(
                    level=LEVEL, dict_data=known, write_content_size=False,
                    write_checksum=False, write_dict_id=False,
                )
            )
        return made

    def score(self, measured: np.ndarray) -> np.ndarray:
        x = (_terms(measured) - self.mean) / self.scale
        margin = np.column_stack([np.ones(len(x)), x]) @ self.weights
        return 1.0 / (1.0 + np.exp(-np.clip(margin, -30, 30)))


def measure(parts: list[bytes], good, bad) -> tuple[float, float, float]:
    """Normalised size difference (above 0: the good dictionary fits better), size under
    the better one per byte, and the share of pieces that the bad one fits better."""
    if not parts:
        return 0.0, 0.0, 0.5
    with_good = [len(good.compress(p)) for p in parts]
    with_bad = [len(bad.compress(p)) for p in parts]
    g, b, size = sum(with_good), sum(with_bad), sum(map(len, parts))
    worse = sum((x < y) + 0.5 * (x == y) for x, y in zip(with_bad, with_good, strict=True))
    return (b - g) / (b + g), min(g, b) / size, worse / len(parts)


def _terms(measured: np.ndarray) -> np.ndarray:
    """The difference, bent so that its outliers do not rule, and what qualifies it."""
    difference, size, worse = measured.T
    bent = np.tanh(8 * difference)
    return np.column_stack([bent, size, worse, bent * size, bent * bent, size * size, bent * worse])


def _calibrated(measured: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50):
    """Logistic weights by Newton's method; classes count alike only as they come."""
    terms = _terms(measured)
    mean, scale = terms.mean(axis=0), np.maximum(terms.std(axis=0), 1e-9)
    x = np.column_stack([np.ones(len(y)), (terms - mean) / scale])
    weights = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (p - y) + ridge * weights
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(hessian, gradient)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    return mean, scale, weights


def _dictionary(samples: list[bytes]) -> bytes:
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # too little text to train on
        return b""


def learn(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """Build both dictionaries and the calibration from labelled documents.

    Only rows that are not held out are used, at most ``rows`` of each label and at most
    ``SAMPLE_PIECES`` pieces of each, so the sample that comes to the driver has a bound.
    The score's inputs are sizes alone. Without labels of both kinds the score says nothing
    and is the good ones' share (0.5 without any label).
    """
    free = labels.where(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) != 0)
    sample = sample_of_labels(free, rows)
    wanted = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    labelled = wanted.join(F.broadcast(sample), "doc_id").select("doc_id", "label", "text")

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(frames):
            cut = [pieces(t.encode()) for t in batch.column(2).to_pylist()]
            few = [
                [p[i * len(p) // SAMPLE_PIECES] for i in range(SAMPLE_PIECES)]
                if len(p) > SAMPLE_PIECES else p
                for p in cut
            ]
            found = pa.array(few, pa.list_(pa.binary()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), found], names=["doc_id", "label", "pieces"])

    schema = "doc_id bigint, label int, pieces array<binary>"
    found = labelled.mapInArrow(run, schema).collect()
    found = sorted(((r.label, zlib.crc32(str(r.doc_id).encode()), r.doc_id, [bytes(p) for p in r.pieces]) for r in found))
    y = np.array([r[0] for r in found], float)
    if not len(y) or y.min() == y.max():
        zeros = np.zeros(7)
        share = 0.0 if not len(y) else (4.0 if y[0] else -4.0)
        return Model(b"", b"", zeros, zeros + 1, np.array([share, *zeros]))
    build = [i for i in range(len(found)) if i % 2 == 0]
    rest = [i for i in range(len(found)) if i % 2]
    parts = {k: [p for i in build if found[i][0] == k for p in found[i][3]] for k in (0, 1)}
    model = Model(_dictionary(parts[1]), _dictionary(parts[0]), np.zeros(7), np.ones(7), np.zeros(8))
    good, bad = model.compressors()
    measured = np.array([measure(found[i][3], good, bad) for i in rest]).reshape(-1, 3)
    if rest and 0 < y[rest].mean() < 1:
        model.mean, model.scale, model.weights = _calibrated(measured, y[rest])
    return model


def _scoring(model: Model, text: int, whole: bool, threshold: float):
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        good, bad = model.compressors()
        for batch in small_batches(frames):
            texts = [(t or "").encode() for t in batch.column(text).to_pylist()]
            score = model.score(np.array([measure(pieces(t), good, bad) for t in texts]))
            if whole:
                yield batch.filter(pa.array(score >= threshold))
                continue
            out = [pa.array([held_out(i) for i in batch.column(0).to_pylist()])]
            predicted = pa.array((score >= threshold).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *out, pa.array(score), predicted],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    return run


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs`` (doc_id, text).

    The whole text is compressed, piece by piece. Null and empty texts are scored as no
    pieces; null ids (never held out) and repeated rows stay; an empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    schema = "doc_id bigint, held_out boolean, score double, predicted int"
    return rows.mapInArrow(_scoring(model, 1, False, threshold), schema)


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are predicted good, with all their columns, in one pass."""
    run = _scoring(model, docs.columns.index("text"), True, threshold)
    return docs.mapInArrow(run, docs.schema)

"""Quality rules: statistics of a document, and boosted trees that judge them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketspark.llm.common import (
    small_batches,
    mix64,
    range_hashes,
    text_of,
    utf8_column,
    word_hashes,
    word_ranges,
    word_windows,
)

# Labelled documents that the trees are fitted on, at most.
SAMPLE_ROWS = 6_000
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
# Documents that the trees find less likely to be good than this are rejected.
KEEP_FROM = 0.5

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
# What the trees see, and how the chance of being good may change as it grows:
# -1 never up, 1 never down, 0 freely.
FEATURES = {
    "log_words": 0,
    "chars_per_word": 0,
    "symbols_per_char": -1,
    "dup_lines_share": -1,
    "repeat_words_share": -1,
    "same_word_share": -1,
    "distinct_share": 1,
    "upper_share": -1,
    "digit_share": 0,
    "sign_share": -1,
    "signed_words_share": -1,
    "words_per_line": 0,
    "longest_word": -1,
}

_SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_UPPER = (np.arange(256) >= 65) & (np.arange(256) <= 90)
_DIGIT = (np.arange(256) >= 48) & (np.arange(256) <= 57)
_SIGN = np.array(
    [32 < b < 127 and not chr(b).isalnum() and chr(b) not in ".,;:'\"()-" for b in range(256)]
)
_WORD_SIGN = np.array([b < 128 and not chr(b).isalnum() and chr(b) not in ".,;:'\"()-" for b in range(256)])


def _repeated(docs: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of items with a document and a hash: is it found twice in its document, and is it
    an occurrence after the first."""
    key = hashes ^ mix64(docs.astype(np.uint64))
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    same = np.zeros(len(key) + 1, bool)
    same[1:-1] = ordered[1:] == ordered[:-1]
    later, twice = np.zeros(len(key), bool), np.zeros(len(key), bool)
    later[order] = same[:-1]
    twice[order] = same[:-1] | same[1:]
    return twice, later


def statistics(column: pa.Array) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Counts of each text of a batch (named as in ``COUNTS``), and its features."""
    data, offsets = utf8_column(column)
    n = len(column)
    docs, starts, ends = word_ranges(data, offsets)

    def per_doc(owners: np.ndarray, weights=None) -> np.ndarray:
        return np.bincount(owners, weights, n)[:n].astype(np.int64)

    def sums(marks: np.ndarray) -> np.ndarray:
        total = np.zeros(len(data) + 1, np.int64)
        np.cumsum(marks, out=total[1:])
        return total

    points = sums((data & 0xC0) != 0x80)
    word_points = points[ends] - points[starts]
    words = per_doc(docs)
    word_chars = per_doc(docs, word_points)
    within = lambda table: (lambda t: t[offsets[1:]] - t[offsets[:-1]])(sums(table[data]))
    symbols = within(_SYMBOLS)

    hashes = word_hashes(data, starts, ends)
    windows, first = word_windows(docs, hashes, 3)
    twice, _ = _repeated(docs[first], windows)
    covered = np.zeros(len(hashes) + 2, bool)
    for i in range(3):
        covered[first[twice] + i] = True
    repeat_words = per_doc(docs[covered[: len(docs)]])
    _, known = _repeated(docs, hashes)
    distinct = words - per_doc(docs[known])
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (docs[1:] == docs[:-1])

    at_end = np.zeros(len(data) + 1, bool)
    at_end[offsets[1:]] = True
    after = np.flatnonzero(data == 0x0A) + 1
    opened = offsets[:-1][offsets[:-1] < offsets[1:]]
    line_starts = np.sort(np.concatenate([opened, after[~at_end[after]]]))
    line_docs = np.searchsorted(offsets, line_starts, side="right") - 1
    line_ends = offsets[1:][line_docs]
    goes_on = line_docs[1:] == line_docs[:-1]
    line_ends[:-1][goes_on] = line_starts[1:][goes_on]
    line_ends = line_ends - (data[line_ends - 1] == 0x0A)  # without the break itself
    line_of = np.searchsorted(line_starts, starts, side="right") - 1
    lines = np.unique(line_of)
    line_hashes = range_hashes(mix64(data.astype(np.uint64) + np.uint64(1)), line_starts[lines], line_ends[lines])
    owners = line_docs[lines]
    _, dup = _repeated(owners, line_hashes)
    dup_lines, worded_lines = per_doc(owners[dup]), per_doc(owners)

    marked = sums(_WORD_SIGN[data])
    signed = per_doc(docs[marked[ends] > marked[starts]])
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, docs, word_points)

    counts = dict(zip(COUNTS, (words, word_chars, symbols, dup_lines, repeat_words), strict=True))
    some, chars, rows = np.maximum(words, 1), np.maximum(word_chars, 1), np.maximum(worded_lines, 1)
    features = [
        np.log1p(words), word_chars / some, symbols / chars, dup_lines / rows,
        repeat_words / some, per_doc(docs[same]) / some, distinct / some,
        within(_UPPER) / chars, within(_DIGIT) / chars, within(_SIGN) / chars,
        signed / some, words / rows, longest.astype(float),
    ]
    return counts, np.column_stack(features).astype(np.float64)


@dataclass
class Trees:
    """Boosted trees as flat node arrays. A leaf has itself as both children."""

    base: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """Chance of being good for each row of features."""
        rows = np.arange(len(x))
        total = np.full(len(x), self.base)
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                low = x[rows, self.feature[node]] <= self.threshold[node]
                node = np.where(low, self.left[node], self.right[node])
            total += self.value[node]
        return 1.0 / (1.0 + np.exp(-total))


@dataclass
class _Growing:
    feature: list = field(default_factory=list)
    threshold: list = field(default_factory=list)
    left: list = field(default_factory=list)
    right: list = field(default_factory=list)
    value: list = field(default_factory=list)

    def leaf(self, value: float) -> int:
        at = len(self.value)
        for column, entry in ((self.feature, 0), (self.threshold, 0.0), (self.left, at), (self.right, at), (self.value, value)):
            column.append(entry)
        return at


def fit_trees(
    x: np.ndarray,
    y: np.ndarray,
    directions: list[int],
    n_trees: int = 40,
    depth: int = 3,
    rate: float = 0.3,
    bins: int = 64,
    least_rows: int = 10,
    penalty: float = 1.0,
) -> Trees:
    """Gradient-boosted trees for the chance of ``y == 1`` with monotonic features.

    Splits are searched over quantile bins. Where a feature may only go one way, a split
    whose leaf values go the other is not taken, and the middle of the two values bounds
    all leaves below it on either side, so the whole model is monotonic. With labels of
    one kind only, or none, there are no trees.
    """
    grown, roots = _Growing(), []
    if not len(y) or y.min() == y.max():
        base = 0.0 if not len(y) else (4.0 if y[0] else -4.0)
    else:
        base = float(np.log(y.mean() / (1 - y.mean())))
        edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins)[1:-1], method="lower")) for c in x.T]
        binned = np.column_stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)])
        margin = np.full(len(y), base)

        def weight(g: float, h: float, low: float, high: float) -> float:
            return float(np.clip(-g / (h + penalty), low, high))

        def gain(g, h, w):
            return -(g * w + 0.5 * (h + penalty) * w * w)

        def grow(rows: np.ndarray, level: int, low: float, high: float) -> int:
            g, h = grad[rows], hess[rows]
            value = weight(g.sum(), h.sum(), low, high)
            best = (gain(g.sum(), h.sum(), value) + 1e-6, None)
            if level < depth and len(rows) >= 2 * least_rows:
                for f, edge in enumerate(edges):
                    if not len(edge):
                        continue
                    b = binned[rows, f]
                    gs, hs = (np.bincount(b, w, len(edge) + 1).cumsum() for w in (g, h))
                    ns = np.bincount(b, minlength=len(edge) + 1).cumsum()
                    wl = np.clip(-gs / (hs + penalty), low, high)
                    wr = np.clip(-(gs[-1] - gs) / (hs[-1] - hs + penalty), low, high)
                    total = gain(gs, hs, wl) + gain(gs[-1] - gs, hs[-1] - hs, wr)
                    wrong = (ns < least_rows) | (ns[-1] - ns < least_rows) | (directions[f] * (wr - wl) < 0)
                    total = np.where(wrong, -np.inf, total)[:-1]
                    cut = int(total.argmax()) if len(total) else 0
                    if len(total) and total[cut] > best[0]:
                        best = (total[cut], (f, cut, float(wl[cut]), float(wr[cut])))
            at = grown.leaf(rate * value)
            if best[1] is None:
                margin[rows] += rate * value
                return at
            f, cut, wl, wr = best[1]
            middle, goes_left = (wl + wr) / 2, binned[rows, f] <= cut
            bounds = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}[directions[f]]
            grown.feature[at], grown.threshold[at] = f, float(edges[f][cut])
            grown.left[at] = grow(rows[goes_left], level + 1, *bounds[0])
            grown.right[at] = grow(rows[~goes_left], level + 1, *bounds[1])
            return at

        for _ in range(n_trees):
            p = 1 / (1 + np.exp(-margin))
            grad, hess = p - y, p * (1 - p)
            roots.append(grow(np.arange(len(y)), 0, -8.0, 8.0))
    return Trees(
        base,
        np.array(roots, np.int64),
        np.array(grown.feature, np.int64),
        np.array(grown.threshold, np.float64),
        np.array(grown.left, np.int64),
        np.array(grown.right, np.int64),
        np.array(grown.value, np.float64),
        depth,
    )


def sample_of_labels(labels: DataFrame, rows: int, label: str = "quality") -> DataFrame:
    """At most ``rows`` labelled ids of each label, those with the least hashes."""
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.where("doc_id is not null and label in (0, 1)").distinct()
    chosen = [known.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows) for k in (0, 1)]
    return chosen[0].unionByName(chosen[1])


def learn(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Trees:
    """Fit the trees on statistics of at most ``rows`` labelled documents, half of each label.

    The statistics are computed by tasks; only those of the sample, a few numbers per
    document, come to the driver. Labels that differ for one document count both.
    """
    sample = sample_of_labels(labels, rows // 2)
    wanted = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    labelled = wanted.join(F.broadcast(sample), "doc_id").select("label", "text")
    names = list(FEATURES)

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(frames):
            _, features = statistics(batch.column(1))
            columns = [batch.column(0), *[pa.array(c) for c in features.T]]
            yield pa.RecordBatch.from_arrays(columns, names=["label", *names])

    schema = "label int, " + ", ".join(f"{n} double" for n in names)
    table = labelled.mapInArrow(run, schema).toPandas()
    table = table.sort_values(["label", *names])  # the same trees whatever the order of tasks
    return fit_trees(table[names].to_numpy(float).reshape(-1, len(names)), table["label"].to_numpy(float), list(FEATURES.values()))


def judge(
    docs: DataFrame,
    trees: Trees,
    min_words: int = MIN_WORDS,
    max_repeated_percent: int = MAX_REPEATED_PERCENT,
    keep_from: float = KEEP_FROM,
) -> DataFrame:
    """All columns of ``docs``' rows that matter (doc_id, text), judged, one row per row.

    Rows: ``doc_id``, the counts, ``base_failed`` (fewer than ``min_words`` words, or more
    than ``max_repeated_percent`` of them in three-word runs found twice), ``score`` (the
    trees') and ``kept``. Null and empty texts have no words and fail; null ids and
    repeated rows stay as they are; an empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    schema = "doc_id bigint, " + ", ".join(f"{c} bigint" for c in COUNTS)
    schema += ", base_failed boolean, score double, kept boolean"
    run = _judging(trees, min_words, max_repeated_percent, keep_from, whole=False)
    return rows.mapInArrow(run, schema)


def keep_good(docs: DataFrame, trees: Trees, **rules) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns, in one pass."""
    rules = {"min_words": MIN_WORDS, "max_repeated_percent": MAX_REPEATED_PERCENT, "keep_from": KEEP_FROM} | rules
    run = _judging(trees, *rules.values(), whole=True, text=docs.columns.index("text"))
    return docs.mapInArrow(run, docs.schema)


def _judging(trees: Trees, min_words, max_repeated_percent, keep_from, whole: bool, text: int = 1):
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(frames):
            counts, features = statistics(batch.column(text))
            words, repeated = counts["n_words"], counts["n_repeat_words"]
            failed = (words < min_words) | (100 * repeated > max_repeated_percent * words)
            score = trees.score(features)
            kept = ~failed & (score >= keep_from)
            if whole:
                yield batch.filter(pa.array(kept))
                continue
            columns = [batch.column(0), *[pa.array(c) for c in counts.values()]]
            columns += [pa.array(failed), pa.array(score), pa.array(kept)]
            names = ["doc_id", *COUNTS, "base_failed", "score", "kept"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run

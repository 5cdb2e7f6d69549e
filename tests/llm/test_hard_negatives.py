import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from docketspark.llm import hard_negatives as hn

_WORD = (1 << 64) - 1
SCHEMA = "vec_id bigint, embedding array<float>, label int, rank int, part string"


def slow(rows, is_anchor, n_positives=5, n_negatives=3, least=50, most=95, scale=256):
    """Brute force over rows (id, vector, label); a row is told by (id, label, whole vector)."""
    known = set()
    for i, x, label in rows:
        if i is None or label is None or x is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        whole = [math.floor(scale * float(np.float32(v))) for v in x]
        while whole and whole[-1] == 0:
            whole.pop()
        known.add((i, label, tuple(whole)))
    out, done = [], set()
    for a in sorted(known, key=lambda r: (r[0], r[1])):
        if not is_anchor(a[0]) or a[0] in done:
            continue
        done.add(a[0])
        scored = [(sum(p * q for p, q in zip(a[2], r[2])), r) for r in known if r[0] != a[0]]
        scored.sort(key=lambda s: (-s[0], s[1][0]))
        for ps, p in [s for s in scored if s[1][1] == a[1]][:n_positives]:
            fit = [(ns, r[0]) for ns, r in scored if r[1] != a[1] and least * ps <= 100 * ns <= most * ps]
            out += [(a[0], p[0], k, j, ps, ns) for k, (ns, j) in enumerate(fit[:n_negatives], 1)]
    return sorted(out)


def run(spark, rows, is_anchor, partitions=3, **options):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(partitions)
    return sorted(tuple(r) for r in hn.hard_negatives(df, is_anchor, **options).collect())


def vectors(seed, n=300, dim=6, labels=3):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(labels)]
    rows = []
    for i in range(n):
        label = rng.randrange(labels)
        x = [0.5 + c + rng.gauss(0, 0.7) for c in centres[label]]
        rows.append((i, x, label))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_rows_are_those_of_all_pairs(spark, seed, monkeypatch):
    monkeypatch.setattr(hn, "ROWS", 32)
    monkeypatch.setattr(hn, "ANCHORS", 4)
    rows = vectors(seed)
    expected = slow(rows, lambda i: i % 10 == 0)
    assert len(expected) > 50
    assert run(spark, rows, F.col("vec_id") % 10 == 0) == expected
    options = {"n_positives": 2, "n_negatives": 4, "least_percent": 0, "most_percent": 100}
    expected = slow(rows, lambda i: i % 10 == 0, 2, 4, 0, 100)
    assert run(spark, rows, F.col("vec_id") % 10 == 0, **options) == expected


def test_nulls_ties_repeats_and_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(hn, "ROWS", 8)
    rng = random.Random(3)
    rows = [(i, [float(rng.randrange(3)), float(rng.randrange(2)), 0.5], rng.randrange(2)) for i in range(60)]
    rows += rows[:30] + rows[:10]  # repeated as wholes
    rows += [(i, [1.0, 1.0, 0.5], i % 2) for i in range(60, 90)]  # all alike
    rows += [
        (None, [1.0, 1.0, 1.0], 0), (100, None, 1), (101, [1.0, None, 1.0], 1), (102, [1.0, 2.0, 1.0], None),
        (103, [float("nan"), 1.0, 1.0], 1), (104, [float("inf"), 1.0, 1.0], 0), (105, [], 0), (110, [], 1),
        (106, [1.0], 1), (107, [1.0, 1.0, 0.5, 0.0], 0), (108, [1.0, 1.0, 0.5, 3.0], 1), (109, [-1.0, -2.0, 0.0], 0),
        (7, [2.0, 2.0, 0.5], 0), (7, [2.0, 2.0, 0.5], 1),
    ]
    expected = slow(rows, lambda i: i % 5 == 0)
    assert expected
    assert run(spark, rows, F.col("vec_id") % 5 == 0) == expected


def test_negative_and_zero_scores(spark):
    rows = [(0, [1.0], 0), (1, [-1.0], 0), (2, [0.0], 0), (3, [0.0], 1), (4, [-0.6], 1), (5, [0.6], 1)]
    assert run(spark, rows, F.col("vec_id") == 0) == slow(rows, lambda i: i == 0)


def test_very_large_components(spark):
    rows = [(0, [1e30, 1.0], 0), (1, [1e30, 2.0], 0), (2, [3e29, 1.0], 1), (3, [2.0, 1e9], 1), (4, [1e9, 1.0], 0)]
    found = run(spark, rows, F.col("vec_id") == 0)
    assert {r[1] for r in found} <= {1, 4} and all(abs(r[4]) < 1 << 63 for r in found)
    exact = [(0, [3e6, 1.0], 0), (1, [2e6, 5.0], 0), (2, [1.5e6, 7.0], 1), (3, [1.2e6, 1.0], 1)]
    assert run(spark, exact, F.col("vec_id") == 0) == slow(exact, lambda i: i == 0)


def test_products_beyond_doubles_are_exact():
    def block(values, kind):
        m = np.array(values, kind)
        ids = np.arange(len(m))
        row = {"n": len(m), "width": m.shape[1], "kind": kind, "ids": ids.tobytes(), "labels": ids.tobytes()}
        return hn.Block(row | {"rows": ids.tobytes(), "vectors": m.tobytes(), "windows": b""})

    a, b = block([[2.0**40 + 1, 3.0]], "<f8"), block([[2**20 + 1, 5], [-(2**22), 1]], "<i4")
    assert hn.products(a, b).tolist() == [[(2**40 + 1) * (2**20 + 1) + 15, -(2**62) - 2**22 + 3]]
    scores = hn.products(a, b)
    assert [c.tolist() for c in hn.first_of(scores, np.ones((1, 2), bool), 1)] == [[0], [0]]


def test_empty_table_and_no_anchor(spark):
    assert run(spark, [], F.col("vec_id") % 10 == 0) == []
    assert run(spark, vectors(1, 20), F.col("vec_id") < 0) == []


def test_bad_percentages(spark):
    with pytest.raises(ValueError, match="percentages"):
        run(spark, vectors(1, 5), F.col("vec_id") == 0, least_percent=60, most_percent=50)


def test_a_hot_vector_gives_a_bounded_number_of_keys(spark, monkeypatch):
    """A third of all rows is one vector of another label: a block sends few keys of them."""
    monkeypatch.setattr(hn, "ROWS", 64)
    rows = vectors(5, 120) + [(1000 + i, [0.6] * 6, 7) for i in range(640)]
    counted = []
    original = hn._secondary_sort
    monkeypatch.setattr(hn, "_secondary_sort", lambda keys: (counted.append(keys.count()), original(keys))[1])
    assert run(spark, rows, F.col("vec_id") % 10 == 0, 2) == slow(rows, lambda i: i % 10 == 0)
    anchors = sum(i % 10 == 0 for i, _, _ in rows)
    assert all(n <= anchors * 16 * 20 for n in counted)


def test_nothing_is_broadcast_and_keys_grow_with_cells_not_blocks(spark, monkeypatch):
    """Every row is a block of its own: an anchor still gets its keys once a cell."""
    monkeypatch.setattr(hn, "ROWS", 1)
    rows = vectors(6, 200)
    seen = []
    original = hn._secondary_sort

    def watched(keys):
        seen.append((keys.count(), keys._jdf.queryExecution().toString()))
        return original(keys)

    monkeypatch.setattr(hn, "_secondary_sort", watched)
    assert run(spark, rows, F.col("vec_id") % 10 == 0, 2) == slow(rows, lambda i: i % 10 == 0)
    anchors, cells = 20, hn.CELLS * spark.sparkContext.defaultParallelism
    assert len(seen) == 2 and all("Broadcast" not in plan and "Join" not in plan for _, plan in seen)
    assert seen[0][0] <= anchors * 5 * cells and seen[1][0] <= anchors * (15 * cells + 5)


def test_more_anchors_than_a_task_holds(spark, monkeypatch):
    monkeypatch.setattr(hn, "ROWS", 16)
    monkeypatch.setattr(hn, "ANCHORS", 4)
    monkeypatch.setattr(hn, "CELL_BYTES", 2000)
    monkeypatch.setattr(hn, "PART_BYTES", 1000)
    rows = vectors(7, 200)
    assert run(spark, rows, F.col("vec_id") % 5 == 0) == slow(rows, lambda i: i % 5 == 0)


@pytest.mark.parametrize("n_labels", [1, 3, 40])
@pytest.mark.parametrize("largest", [2, 3000, 1 << 15, 1 << 31, 1 << 40])
def test_tiles_keep_the_first_rows_of_every_window(monkeypatch, n_labels, largest):
    """Ties, hot rows, repeated rows, ids with several rows; single, double and exact products."""
    for name, value in {"ANCHORS": 8, "FIRST": 3, "COLUMNS": 11, "LABEL": 4, "FLOOD": 4, "WAITING": 10}.items():
        monkeypatch.setattr(hn, name, value)
    rng = np.random.default_rng(n_labels + largest % 97)
    n, kind = 120, "<f8" if largest > 1 << 31 else "<i4" if largest >= 1 << 15 else "<i2"
    ids, labels = rng.integers(0, 100, n), rng.integers(0, n_labels, n)
    matrix = rng.integers(-largest, largest, (n, 3), dtype=np.int64).clip(1 - largest, largest - 1)
    matrix[rng.random(n) < 0.4] = matrix[0]
    whole = np.array([hash((int(i), int(b), *m.tolist())) & _WORD for i, b, m in zip(ids, labels, matrix)], np.uint64)

    def block(at, windows=None):
        at = at[np.lexsort((whole[at], ids[at], labels[at]))]
        row = {"n": len(at), "width": 3, "kind": kind, "ids": ids[at].tobytes(), "labels": labels[at].tobytes(),
               "rows": whole[at].tobytes(), "vectors": matrix[at].astype(kind).tobytes(),
               "windows": b"" if windows is None else windows[at].tobytes()}
        return hn.Block(row)

    first = np.unique(ids, return_index=True)[1][:40]
    spread = 3 * largest * largest
    limits = np.sort(np.array([[[rng.integers(-spread, spread) if spread < 1 << 62 else int(rng.integers(-(1 << 62), 1 << 62)) for _ in range(2)] for _ in range(3)] for _ in range(n)], np.int64), axis=2)
    limits[rng.random((n, 3)) < 0.2] = [1, 0]
    limits[::4, 0] = -(1 << 63), (1 << 63) - 1
    for same_label, windows, k in ((True, None, 3), (False, limits, 2)):
        tiles = hn._tiles([block(first[:25], windows), block(first[25:], windows)], k, same_label)
        at = np.concatenate([rng.permutation(n), rng.permutation(n)[:30]])
        for part in np.array_split(at, 9):
            for tile in tiles:
                tile.meet(hn._Rows(block(part)))
        found = set()
        for tile in tiles:
            tile.settle()
            line, scores, other, rows = tile.held
            found |= set(zip(tile.ids[line].tolist(), scores.tolist(), other.tolist(), rows.tolist(), strict=True))
        expected = set()
        for a in first.tolist():
            scored = []
            for b in range(n):
                if (labels[a] == labels[b]) == same_label and not (same_label and ids[a] == ids[b]):
                    score = sum(int(p) * int(q) for p, q in zip(matrix[a], matrix[b]))
                    score = min(max(score, -(1 << 63)), (1 << 63) - 1)
                    scored.append((-score, int(ids[b]), int(whole[b])))
            scored = sorted(set(scored))
            for least, most in [(-(1 << 63), 1 << 63)] if windows is None else windows[a].tolist():
                fit = [s for s in scored if least <= -s[0] <= most][:k]
                expected |= {(int(ids[a]), -s, i, r) for s, i, r in fit}
        assert found == expected and (expected or n_labels == 1)

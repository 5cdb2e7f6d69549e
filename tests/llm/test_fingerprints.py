import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docketspark.llm import fingerprints as fp


def slow(text, gram, window):
    """Winnowing by its definition, on the same hashes."""
    if not text:
        return []
    grams = [text[i : i + gram] for i in range(max(1, len(text) - gram + 1))]
    hashes = [fp.range_hashes(fp.mix64(np.array([ord(c) + 1 for c in g], np.uint64)), np.array([0]), np.array([len(g)]))[0] for g in grams]
    chosen = set()
    for i in range(max(1, len(hashes) - window + 1)):
        run = hashes[i : i + window]
        chosen.add(i + max(j for j, h in enumerate(run) if h == min(run)))
    return [(int(hashes[i]) >> 32, i) for i in sorted(chosen)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="abé😀 ", max_size=40), max_size=6), st.integers(1, 5), st.integers(1, 7))
def test_winnow_is_the_definition(texts, gram, window):
    ends, hashes, positions = fp.winnow(texts, gram, window)
    for i, text in enumerate(texts):
        cut = slice(ends[i], ends[i + 1])
        assert list(zip(hashes[cut].tolist(), positions[cut].tolist(), strict=True)) == slow(text, gram, window)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abcdef", max_size=50), st.text(alphabet="ghij", max_size=50), st.text(alphabet="klmn", max_size=50), st.text(min_size=11, max_size=30))
def test_shared_passages_share_a_fingerprint(a, b, c, passage):
    gram, window = 5, 7  # passages of 11 code points and more
    _, hashes, _ = fp.winnow([a + passage + b], gram, window)
    _, others, _ = fp.winnow([c + passage + a], gram, window)
    assert set(hashes.tolist()) & set(others.tolist())


def neighbours(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    return [(r, order[(i + 1) % len(order)]) for i, r in enumerate(order)]


@pytest.mark.parametrize("parts", [1, 4])
@pytest.mark.parametrize(
    "rows",
    [
        [(i * 3 - 20, f"text number {i} " * (i % 7), "x") for i in range(60)],
        [(5, "only one", "x")],
        [(None, "no id", "x"), (3, None, "x"), (3, "same id", "x"), (3, "same id", "x"), (9, "", "x"), (-4, "z" * 3000, "x")],
    ],
)
def test_edited_texts_and_neighbours(spark, rows, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        docs = spark.createDataFrame(rows, "doc_id bigint, text string, _part string").repartition(3)
        found = sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in fp.compare_with_edits(docs).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = []
    for (doc_id, text, _), (_, after, _) in neighbours(rows):
        text, after = text or "", after or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        want.append((str(doc_id), len(text), hashlib.sha256(edited.encode()).hexdigest()))
    assert found == sorted(want)


def test_likeness_and_equal_texts(spark):
    text = " ".join(f"word{i * i}" for i in range(100))
    docs = spark.createDataFrame([(2, text, 0), (1, text, 0), (0, "", 0)], "doc_id bigint, text string, hashes int")
    rows = {r.doc_id: r for r in fp.compare_with_edits(docs).collect()}
    assert rows[2].near_next == 1.0 and rows[2].fingerprint == rows[1].fingerprint != ""
    assert 0 < rows[2].near_edited < 1 and rows[1].near_next == 0.0
    assert rows[0].near_edited == 1.0 and rows[0].fingerprint == ""
    plain = {r.doc_id: (r.hashes, r.positions) for r in fp.fingerprints(docs).collect()}
    assert plain[2] == plain[1] and plain[0] == ([], [])


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert fp.compare_with_edits(docs).collect() == [] and fp.fingerprints(docs).collect() == []


@pytest.mark.parametrize("length", [60, 79, 120, 159, 300])
def test_short_texts_keep_several_fingerprints(length):
    """Half of each text is shared, and the registered sizes show it at every length."""
    rng = np.random.default_rng(length)
    texts = ["".join(rng.choice(list("abcdefghijklmnop "), length)) for _ in range(40)]
    edits = [fp.edited(t, texts[i - 1]) for i, t in enumerate(texts)]

    def sets(some, **sizes):
        ends, hashes, _ = fp.winnow(some, **sizes)
        return [np.unique(hashes[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]

    got = np.array([fp.likeness(a, b) for a, b in zip(sets(texts), sets(edits), strict=True)])
    true = np.array([fp.likeness(a, b) for a, b in zip(sets(texts, window=1), sets(edits, window=1), strict=True)])
    assert min(map(len, sets(texts))) >= 4 and (got > 0).mean() > 0.9
    assert abs(got.mean() - true.mean()) < 0.05

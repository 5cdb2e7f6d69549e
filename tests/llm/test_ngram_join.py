import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docketspark.llm import ngram_join
from docketspark.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text, k=5):
    words = WORD.findall((text or "").translate(LOWER))
    if 0 < len(words) < k:
        return {tuple(words)}
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def slow_groups(rows, percent=75):
    sets = [(doc_id, shingles(text)) for doc_id, text in rows]
    parent = {doc_id: doc_id for doc_id, _ in sets if doc_id is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    known = [(d, s) for d, s in sets if d is not None]
    for i, (a, sa) in enumerate(known):
        for b, sb in known[:i]:
            if sa and sb and 100 * len(sa & sb) >= percent * len(sa | sb):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    out = []
    for doc_id, found in sets:
        same = [find(d) for d, s in known if s == found and found]
        component = find(doc_id) if doc_id is not None else (min(same) if same else None)
        out.append((str(doc_id), len(found), component))
    return sorted(out, key=str)


def run(spark, rows, extra="component_id"):
    docs = spark.createDataFrame([(*r, "x") for r in rows], f"doc_id bigint, text string, {extra} string")
    found = ngram_join.similar_groups(docs.repartition(3)).collect()
    return sorted(((str(r.doc_id), r.n_shingles, r.component_id) for r in found), key=str)


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = rng.choices(words, k=60)
    rows, doc_id = [], 0
    for _ in range(25):
        base = rng.choices(words, k=rng.choice([3, 6, 30, 80]))
        if rng.random() < 0.5:
            base = base + passage
        for _ in range(rng.choice([1, 1, 2, 6])):
            text = list(base)
            for _ in range(rng.choice([0, 1, 2, 3])):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((doc_id, " ".join(text)))
            doc_id += 1
    base = rng.choices(words, k=120)  # a chain whose ends are not alike
    for i in range(20):
        rows.append((1000 - i, " ".join(base[3 * i : 3 * i + 60])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_are_those_of_all_pairs(spark, seed):
    rows = corpus(seed)
    assert run(spark, rows) == slow_groups(rows)


def test_edge_cases(spark):
    rows = [
        (1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, "ONE  two"), (6, "two one"),
        (7, "a b c d e"), (8, "A\tB\nC d e"), (9, "É b c d e"), (10, "é b c d e"),
        (None, "a b c d e"), (None, "nobody has this text at all"), (7, "a b c d e"),
        (11, "long text " * 20_000), (12, "Long text " * 20_001),
    ]
    assert run(spark, rows, "rep") == slow_groups(rows)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as stays", "2 as copy")
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [1, 2, 3, 4, 6, 7, 9, 10, 11, None, None]))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert ngram_join.similar_groups(docs).collect() == []
    assert ngram_join.one_of_each(docs).collect() == []


def test_repeated_ids_are_one_document(spark):
    a, b = "alpha beta gamma delta epsilon zeta", "one two three four five six"
    rows = [(1, a), (2, a), (2, b), (3, b), (4, "something else that is alone here")]
    found = {i: c for i, _, c in run(spark, rows)}
    assert found == {"1": 1, "2": 1, "3": 1, "4": 4}


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 40), min_size=1, max_size=25), st.sets(st.integers(0, 40), max_size=25), st.integers(0, 2))
def test_similar_sets_share_a_prefix_token_in_every_order(a, b, order):
    hashes = ngram_join.mix64(np.arange(41, dtype=np.uint64))
    classes = (np.arange(1 << ngram_join.SKETCH_BITS) % 5).astype(np.uint8)
    if not b or 100 * len(a & b) < 75 * len(a | b):
        b = set(list(a)[: max(1, -(-3 * len(a) // 4))])
    prefixes = [
        set(ngram_join.in_order(hashes[sorted(s)], order, classes)[: ngram_join.prefix_length(len(s))].tolist())
        for s in (a, b)
    ]
    assert prefixes[0] & prefixes[1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aB é\n\x0b", max_size=30), min_size=1, max_size=5))
def test_sets_have_the_right_sizes(texts):
    found = ngram_join.shingle_sets(pa.array(texts))
    assert [len(s) for s in found] == [len(shingles(t)) for t in texts]
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            assert (found[i].tolist() == found[j].tolist()) == (shingles(a) == shingles(b))


def test_frequency_classes_put_frequent_cells_last():
    counts = np.full(1000, 100.0)
    counts[3], counts[4] = 5000, 600
    classes = ngram_join.frequency_classes(counts)
    assert classes[0] == 0 and classes[3] > classes[4] > 0


def test_components_of_paths_stars_and_loops(spark):
    rng = random.Random(5)
    names = list(range(300))
    rng.shuffle(names)
    links = [(names[i], names[i + 1]) for i in range(99)]  # a long path
    links += [(names[100], names[i]) for i in range(101, 200)]  # a star
    links += [(names[250], names[250]), (names[251], names[252]), (names[252], names[251]), (None, 3), (4, None)]
    found = components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    got = {r.node: r.component for r in found}
    assert len(got) == len(found)
    want = {n: min(names[:100]) for n in names[:100]} | {n: min(names[100:200]) for n in names[100:200]}
    want |= {n: min(names[251:253]) for n in names[251:253]}
    assert got == want
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_pairs_beyond_the_broadcast_limit_are_joined(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BROADCAST_IDS", 0)
    monkeypatch.setattr(ngram_join, "WINDOW_TOKENS", 200)
    rows = corpus(7)
    assert run(spark, rows) == slow_groups(rows)


def test_rows_exchanged_grow_in_proportion(spark, monkeypatch):
    """Eight times as many windows: a token still travels once for each window that has it."""
    rows, seen, shared = corpus(3), [], ngram_join.shared_tokens

    def watched(prefixes, placed):
        n_tokens = prefixes.selectExpr("sum(length(tokens) / 6)").first()[0]
        seen.append((prefixes.select("window").distinct().count(), n_tokens))
        return shared(prefixes, placed)

    monkeypatch.setattr(ngram_join, "shared_tokens", watched)
    for tokens in (800, 100):
        monkeypatch.setattr(ngram_join, "WINDOW_TOKENS", tokens)
        assert run(spark, rows) == slow_groups(rows)
    (few, n), (many, again) = seen
    assert n == again and many >= 4 * few


def test_no_text_meets_another_before_all_orders_agree(spark, monkeypatch):
    """Pairs that share a token under the first order only are gone before texts are joined."""
    rows, met, agreed = corpus(11), [], []
    original, verified = ngram_join.sharing_all_prefixes, ngram_join.verified

    def watched(docs, pairs, classes, words, percent):
        found = original(docs, pairs, classes, words, percent)
        met.append(pairs.count())
        agreed.append(found.count())
        similar = verified(docs, pairs, classes, words, percent)
        assert similar.exceptAll(verified(docs, found, classes, words, percent)).isEmpty()
        return found

    monkeypatch.setattr(ngram_join, "sharing_all_prefixes", watched)
    assert run(spark, rows) == slow_groups(rows)
    assert agreed[0] <= met[0]


def test_parities_bound_the_difference_of_sets():
    rng = np.random.default_rng(5)
    for n, changed in ((40, 0), (40, 3), (900, 100), (3000, 2500)):
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[changed:], rng.integers(0, 1 << 63, changed).astype(np.uint64)]))
        x, y = ngram_join.parities(a), ngram_join.parities(b)
        turned = int(np.unpackbits((x ^ y).view(np.uint8)).sum())
        assert turned <= len(np.setxor1d(a, b))
        assert (turned == 0) == (changed == 0)


def test_documents_meet_once_however_many_tokens_they_share(spark):
    """Two documents of 400 shingles of which nearly all prefix tokens are common."""
    tokens = np.arange(1, 101, dtype="<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()
    names = "window bigint, doc_id bigint, n bigint, tokens binary" + ngram_join._PARITY_TYPES
    bits = [int(b) for b in ngram_join.parities(np.arange(400, dtype=np.uint64))]
    prefixes = spark.createDataFrame([(0, d, 400, bytearray(tokens), *bits) for d in (1, 2)], names)
    groups = spark.createDataFrame([(1, 1), (2, 2)], "rep bigint, comp bigint")
    met = ngram_join.meetings(prefixes, groups, 1, 75)
    assert [tuple(r) for r in met.collect()] == [(1, 2)]


def traced_peak(work) -> int:
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_memory_for_shingles_does_not_grow_with_the_texts_of_a_batch(monkeypatch):
    rng = np.random.default_rng(5)
    texts = [" ".join(map(str, rng.integers(0, 10**9, 6000))) for _ in range(64)] + ["", None, "one"]
    column = pa.array(texts, pa.string())
    # Sets of 8 bytes for each word of 10 and the arrays of one run, not of all 4 MB.
    assert traced_peak(lambda: ngram_join.shingle_sets(column)) < 50_000_000
    runs = ngram_join.shingle_sets(column.slice(1))
    monkeypatch.setattr(ngram_join, "SHINGLED_BYTES", 1 << 30)
    whole = ngram_join.shingle_sets(column.slice(1))
    assert [s.tolist() for s in runs] == [s.tolist() for s in whole]


def test_memory_for_a_window_of_prefixes_is_bounded():
    each = 75
    rows = ngram_join.WINDOW_TOKENS // each
    blob = np.random.default_rng(6).integers(0, 256, (rows, 6 * each), np.uint8)
    prefixes = pa.table({"doc_id": np.arange(rows), "tokens": pa.array([b.tobytes() for b in blob], pa.binary())})
    groups = pa.table({"rep": np.arange(rows), "comp": np.arange(rows)})
    assert traced_peak(lambda: ngram_join._entries(prefixes, groups)) < 25_000_000

import hashlib
import math
import random
import re
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from docketspark.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, source string, text string, weight double, taken string, part int"


def slow_targets(sizes, weights=(5, 2, 1), share=1.0, most=3):
    """Water filling, one source at a time."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = round(share * sum(sizes.values())), set()
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(most * sizes[s] for s in capped)
        wide = sum(weight[s] for s in free)
        above = {s for s in free if most * sizes[s] < Fraction(weight[s] * left, wide)}
        if not above:
            return {s: most * sizes[s] if s in capped else Fraction(weight[s] * left, wide) for s in order}
        capped |= above


def slow(rows, **options):
    """``(doc_id, source, text, weight, taken)``; rows of a source share a key only as repeats."""
    sizes, by_source = defaultdict(int), defaultdict(list)
    for row in rows:
        n = len(WORD.findall(row[2] or ""))
        u = (int(hashlib.md5(f"{mixing.SEED}:{'' if row[0] is None else row[0]}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        rate = 1.0 if row[3] is None else row[3]
        sizes[row[1]] += n
        by_source[row[1]].append((-math.log(u) / rate if rate > 0 else math.inf, n, row))
    targets, out = slow_targets(sizes, **options), []
    for source, own in by_source.items():
        budget = math.floor(targets[source] + Fraction(1, 2))
        epochs, rest = divmod(budget, sizes[source]) if sizes[source] else (0, 0)
        before = 0
        for key in sorted({k for k, _, _ in own}):
            same = [(n, row) for k, n, row in own if k == key]
            total = sum(n for n, _ in same)
            for n, row in same:
                part = n * min(max(rest - before, 0), total) // total if total else 0
                out.append((*row, epochs * n + part, n, sizes[source], float(targets[source])))
            before += total
    return sorted(out, key=repr)


def run(spark, rows, partitions=3, **options):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(partitions)
    keyed = docs.withColumns(
        {"size": mixing.n_words(F.col("text")), "key": mixing.sampling_key(F.col("doc_id"), F.col("weight"))}
    )
    found = mixing.plan_mix(keyed, **options)
    columns = ("doc_id", "source", "text", "weight", "taken", "size", "source_size", "target")
    return sorted((tuple(r) for r in found.select(*columns).collect()), key=repr)


def documents(seed, n=300, sources=7):
    rng = random.Random(seed)
    return [
        (
            i,
            rng.choice(["hot"] * sources + [f"s{k}" for k in range(sources)]),
            " ".join("w" * rng.randrange(1, 9) for _ in range(rng.choice([0, 1, 5, 40, 300]))),
            rng.choice([None, 0.25, 1.0, 4.0]),
        )
        for i in range(n)
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_plan_is_that_of_the_slow_version(spark, seed, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_ROWS", 20)  # the hot source spans many ranges
    rows = documents(seed)
    expected = slow(rows)
    assert run(spark, rows) == expected
    assert run(spark, rows, partitions=1) == expected
    taken, targets = defaultdict(int), {}
    for r in expected:
        taken[r[1]] += r[4]
        targets[r[1]] = r[7]
        assert r[4] <= 3 * r[5]
    assert all(abs(taken[s] - targets[s]) <= 0.5 for s in targets)


def test_other_weights_and_shares(spark):
    rows = documents(3)
    for options in ({"share": 0.5}, {"weights": (1,)}, {"share": 2.5, "weights": (9, 1)}, {"most": 2}):
        given = {{"most": "most_epochs"}.get(k, k): v for k, v in options.items()}
        assert run(spark, rows, **given) == slow(rows, **options)


def test_more_is_asked_for_than_there_is(spark):
    rows = [(1, "a", "x y z", None), (2, "b", "x", None)]
    found = run(spark, rows, share=5.0)
    assert [(r[0], r[4]) for r in found] == [(1, 9), (2, 3)]


def test_nulls_empty_texts_repeats_and_weights_that_are_none(spark):
    rows = [
        (1, None, "a b c", None), (2, None, None, 1.0), (3, "", " \n\t ", 1.0), (4, "", "a\x0bb", 0.0),
        (None, "x", "a b c d", None), (None, "x", "a b", None), (5, "x", "a " * 20_000, -1.0),
        (6, "é", "é è", float("inf")), (7, "z", None, None), (8, "é", "a b c d e f", 2.0),
    ] + [(9, "x", "same words here", 1.0)] * 5
    assert run(spark, rows) == slow(rows)


def test_a_group_of_equal_keys_shares_what_is_left(spark):
    rows = [(9, "a", "one two three", None)] * 40 + [(i, "b", "w " * 30, None) for i in range(10, 13)]
    found = run(spark, rows, weights=(1, 9))
    assert found == slow(rows, weights=(1, 9))
    assert len({r[4] for r in found if r[1] == "a"}) == 1


def test_empty_table(spark):
    assert run(spark, []) == []
    docs = spark.createDataFrame([], SCHEMA)
    assert mixing.mixed_texts(docs).collect() == []


def test_mixed_texts_hold_the_words_of_the_plan(spark):
    rows = documents(4, 120, 3) + [(None, "hot", " a\tb\n c ", None), (500, None, "x", 1.0)]
    planned = {repr(r[:4]): r for r in run(spark, rows)}
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    found = mixing.mixed_texts(docs.withColumn("epoch", F.lit("old")))
    assert found.columns == ["doc_id", "source", "text", "weight", "part", "epoch"]
    texts = {r[:2]: r for r in rows}
    words, passes = defaultdict(int), defaultdict(set)
    for r in found.collect():
        whole = texts[r.doc_id, r.source][2]
        assert whole.startswith(r.text)
        words[r.doc_id, r.source] += len(WORD.findall(r.text))
        passes[r.source].add((r.epoch, r.text == whole))
    assert dict(words) == {(r[0], r[1]): r[4] for r in planned.values() if r[4]}
    for found_passes in passes.values():  # texts are cut in the last pass only
        assert {e for e, is_whole in found_passes if not is_whole} <= {max(e for e, _ in found_passes)}


def test_reruns_agree_and_weights_matter(spark):
    rows = [(i, "a" if i % 2 else "b", "w " * 10, 8.0 if i % 4 < 2 else 0.125) for i in range(400)]
    first = run(spark, rows, weights=(1, 3))
    assert first == run(spark, rows[::-1], partitions=5, weights=(1, 3))
    heavy = sum(r[4] for r in first if r[1] == "b" and r[3] == 8.0)
    light = sum(r[4] for r in first if r[1] == "b" and r[3] == 0.125)
    assert heavy > light

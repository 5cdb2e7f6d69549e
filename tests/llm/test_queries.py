"""The registered queries over the smallest tables, against brute-force versions."""

import base64
import hashlib
import os
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from docketspark.llm import compression, quality_rules
from docketspark.llm.tokens import tokenizer_path
from test_lines_chat_warc import slow_lines

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def table(name):
    return pd.read_parquet(f"{SF_DIR}/{name}.parquet")


@pytest.fixture(scope="module")
def texts():
    docs = table("documents")
    return dict(zip(docs.doc_id.tolist(), docs.text.fillna(""), strict=True))


@pytest.fixture(scope="module")
def result(spark):
    return lambda name: queries()[name](spark, SF_DIR).toPandas()


def whole_ids(texts, end):
    coder = Tokenizer.from_file(tokenizer_path())
    found = coder.encode_batch(list(texts.values()), add_special_tokens=False)
    return {i: np.array([*e.ids, end], "<u4") for i, e in zip(texts, found, strict=True)}


def packed_whole(rows, ids):
    for doc_id, own in rows.groupby("doc_id"):
        at = 0
        for r in own.sort_values("start").itertuples():
            assert r.start == at and r.doc_tokens == len(ids[doc_id])
            assert r.ids_crc32 == zlib.crc32(ids[doc_id][at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids[doc_id])
    assert set(rows.doc_id) == set(ids)
    for _, own in rows.groupby("sequence_id"):
        at = 0
        for r in own.sort_values("offset").itertuples():
            assert r.offset == at
            at += r.length
        assert at <= 2048 and (at == 2048 or at & (at - 1) == 0)


def test_op1(result, texts):
    packed_whole(result("op1_packing"), whole_ids(texts, 1))


def test_op2(result, texts):
    rows = result("op2_fingerprints").set_index("doc_id")
    order = sorted(texts, reverse=True)
    assert sorted(rows.index) == sorted(texts)
    for i, doc_id in enumerate(order):
        text, after = texts[doc_id], texts[order[(i + 1) % len(order)]]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert rows.loc[doc_id].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert rows.loc[doc_id].n_chars == len(text)
    assert rows.near_edited.between(0, 1).all() and rows.near_edited.mean() > rows.near_next.mean()


def counts(text):
    words, seen, dup, covered = WORD.findall(text), set(), 0, set()
    runs = Counter(zip(words, words[1:], words[2:], strict=False))
    for i, run in enumerate(zip(words, words[1:], words[2:], strict=False)):
        if runs[run] > 1:
            covered |= {i, i + 1, i + 2}
    for line in filter(WORD.search, text.split("\n")):
        dup += line in seen
        seen.add(line)
    n = len(words)
    failed = n < 50 or 100 * len(covered) > 50 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed


def test_op3(result, texts):
    rows = result("op3_quality_rules")
    got = {r.doc_id: tuple(r)[2:8] for r in rows.itertuples()}
    assert got == {i: counts(t) for i, t in texts.items()}
    assert not rows[rows.base_failed].kept.any()
    labelled = rows.merge(table("labels"), on="doc_id")
    fine = labelled[~labelled.base_failed]
    assert (fine.kept == (fine.quality == 1)).mean() > 0.95


def groups_of(texts):
    lower = {c: c + 32 for c in range(65, 91)}
    sets = {}
    for i, text in texts.items():
        w = WORD.findall(text.translate(lower))
        sets[i] = {tuple(w)} if 0 < len(w) < 5 else {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    known = sorted(sets)
    for n, a in enumerate(known):
        for b in known[:n]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_op4(result, texts):
    rows = result("op4_ngram_join")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows.itertuples()} == groups_of(texts)


def test_op6(result):
    turns = table("conversations")
    said = "</s>[INST] ok [/INST]"
    extra = pd.DataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], columns=["conv_id", "turn", "role", "text"])
    turns = pd.concat([turns, extra])
    rows = result("op6_chat_formatting").set_index("conv_id")
    assert sorted(rows.index) == sorted(turns.conv_id.unique())
    for conv_id, own in turns.sort_values("turn").groupby("conv_id"):
        text = own.text.fillna("")
        loss = "".join(text[own.role == "assistant"])
        read = "".join(f"{r}\n{t}\n" for r, t in zip(own.role, text, strict=True))
        r = rows.loc[conv_id]
        assert (r.n_turns, r.loss_chars) == (len(own), len(loss))
        assert r.turns_sha256 == hashlib.sha256(read.encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def test_op7(result, texts):
    rows = result("op7_token_files").set_index("doc_id")
    ids, at = whole_ids(texts, 2), 0
    for doc_id in sorted(ids):
        r = rows.loc[doc_id]
        assert (r.start, r.n_tokens) == (at, len(ids[doc_id]))
        assert r.ids_crc32 == zlib.crc32(ids[doc_id].tobytes())
        at += len(ids[doc_id])


def test_op8(result, texts):
    rows = result("op8_compression_classifier")
    assert set(rows.doc_id) == set(texts)
    assert (rows.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in rows.doc_id]).all()
    assert (rows.predicted == (rows.score >= 0.3)).all() and rows.score.between(0, 1).all()
    held = rows[rows.held_out].merge(table("labels"), on="doc_id")
    assert (held.predicted == held.quality).mean() > 0.85


def test_op9(result, texts):
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = result("op9_byte_bpe").set_index("doc_id")
    for doc_id, text in texts.items():
        ids = np.array(coder.encode_ordinary(text), "<u4")
        r = rows.loc[doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_sql_is_given_where_it_can_say_it():
    assert {"op5_line_dedup", "op10_warc"} <= set(oracle_sql())
    assert "pipeline" in queries()


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.stored(stage(spark, docs, SF_DIR), "test-stage")
        kept[name] = docs.toPandas()
        rows = before.toPandas()
        if name != "packing":
            assert docs.columns == columns
        if name == "quality_rules":
            good = quality_rules.judge(before, quality_rules.learn(before, labels)).where("kept")
            assert set(kept[name].doc_id) == {r.doc_id for r in good.collect()}
        elif name == "quality_classifier":
            model = compression.learn(before, labels)
            good = compression.score(before, model).where("predicted = 1")
            assert set(kept[name].doc_id) == {r.doc_id for r in good.collect()}
        elif name == "line_dedup":
            triples = list(zip(rows.doc_id, rows.source, rows.text, strict=True))
            left = {r[0]: r[2] for r in slow_lines(triples)}
            assert left != {i: t for i, _, t in triples}  # the rule drops lines on the smallest tables
            assert dict(zip(kept[name].doc_id, kept[name].text, strict=True)) == left
            assert (kept[name].n_chars == kept[name].text.str.len()).all()
        elif name == "ngram_join":
            groups = groups_of(dict(zip(rows.doc_id, rows.text, strict=True)))
            assert set(kept[name].doc_id) == {c for _, c in groups.values()}
        else:
            ids = whole_ids(dict(zip(rows.doc_id, rows.text, strict=True)), 1)
            kept[name]["ids_crc32"] = [zlib.crc32(bytes(x)) for x in kept[name].ids]
            packed_whole(kept[name], ids)
    run = corpus_pipeline.run(spark, SF_DIR)
    assert run.select(F.sum("length")).first()[0] == kept["packing"].length.sum()


def test_pipeline_drops_planted_passages(spark):
    passage = " ".join(f"passage{i}" for i in range(51))
    short = " ".join(f"short{i}" for i in range(50))
    rows = [(i, f"own {i}\n  {passage} \n{short}" if i % 40 == 0 else f"own {i}", f"s{i % 19}") for i in range(400)]
    docs = spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    found = {r.doc_id: r for r in corpus_pipeline.line_dedup_stage(spark, docs.repartition(3), SF_DIR).collect()}
    assert len(found) == len(rows)
    planted = [found[i].text for i in range(0, 400, 40)]
    assert [passage in t for t in planted] == [True] + [False] * 9 and all(short in t for t in planted)
    for i, text, _ in rows:
        assert found[i].text == (text if i % 40 or not i else f"own {i}\n{short}")
        assert found[i].n_chars == len(found[i].text)


def test_queries_leave_the_session_as_it_is(spark):
    before = {k: v for k, v in spark.conf.getAll.items() if k.startswith("spark.sql")}
    for name, run in queries().items():
        if name.startswith("op"):
            run(spark, SF_DIR).limit(1).collect()
            assert {k: v for k, v in spark.conf.getAll.items() if k.startswith("spark.sql")} == before, name

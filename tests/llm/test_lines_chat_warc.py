import base64
import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docketspark.llm import boilerplate, chat, warc


def slow_lines(rows, share=boilerplate.MAX_SHARE, passage_docs=boilerplate.PASSAGE_DOCS):
    """Rows (id, host, text) without their sites' lines and without others' passages."""
    pages, totals, on, least = {}, {}, {}, {}
    for i, host, text in rows:
        lines = {x.strip(" ") for x in (text or "").split("\n")} - {""}
        if host is not None:
            totals[host] = totals.get(host, 0) + 1
            for line in lines:
                pages[host, line] = pages.get((host, line), 0) + 1
        for line in lines:
            if len(re.findall(r"[^\x20\x09-\x0D]+", line)) > boilerplate.LONG_WORDS:
                on[line] = on.get(line, 0) + 1
                if i is not None:
                    least[line] = min(i, least.get(line, i))
    gone = {k for k, n in pages.items() if n - boilerplate.CHANCE_PAGES > share * totals[k[0]]}
    passages = {line for line, n in on.items() if n >= passage_docs}
    out = []
    for i, host, text in rows:
        lines = text.split("\n") if text is not None else []

        def goes(x, i=i, host=host):
            x = x.strip(" ")
            return (host, x) in gone or (x in passages and x in least and i != least[x])

        kept = [x for x in lines if not goes(x)]
        out.append((i, host, None if text is None else "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def freed(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id bigint, host string, text string").repartition(3)
    found = boilerplate.drop_boilerplate(docs, F.col("host"), **options).collect()
    return sorted(((r.doc_id, r.host, r.text, r.n_lines, r.n_dropped) for r in found), key=str)


PASSAGE = " ".join(f"passage{i}" for i in range(51))


def line_rows():
    rows = []
    for i in range(60):
        host = f"h{i % 2}"
        rows.append((host, f"menu\n  footer \nbody {i}\n\nrare\n" if i % 10 == 0 else f"menu\nbody {i}\nfooter\nfooter"))
    rows += [("h0", None), ("h0", ""), ("h0", "menu"), (None, "menu\nbody"), ("h2", "menu\nonly page"), ("h1", "menu\n" + "x" * 100_000)]
    rows += [("h1", "copy\nof a page")] * 12
    rows += [(f"p{i % 13}", f"own {i}\n {PASSAGE}  \nend") for i in range(12)] + [(None, f"\n{PASSAGE}\n{PASSAGE}")] * 2
    return [(i if i % 9 else None, *row) for i, row in enumerate(rows)]


def test_boilerplate_by_host(spark):
    rows = line_rows()
    clashing = "doc_id bigint, host string, text string, line string, n_lines string, lines_gone string, site string, page string"
    docs = spark.createDataFrame([(*r, "a", "b", "c", "d", "e") for r in rows], clashing)
    found = boilerplate.drop_boilerplate(docs, F.col("host"), max_share=0.2)
    assert found.columns == ["doc_id", "host", "text", "line", "lines_gone", "site", "page", "n_lines", "n_dropped"]
    got = sorted(((r.doc_id, r.host, r.text, r.n_lines, r.n_dropped) for r in found.collect()), key=str)
    assert got == slow_lines(rows, 0.2)
    assert any(r[4] for r in got)
    assert boilerplate.drop_boilerplate(docs.where("false"), F.col("host")).collect() == []


@pytest.mark.parametrize("pages", [5, 50, 500, 50_000])
def test_one_rule_at_every_size(spark, pages):
    """A line goes on two pages more than 2 % of the site, whatever its size."""
    limit = pages // 50 + boilerplate.CHANCE_PAGES
    lines = {"two": 2, "at the limit": limit, "above": limit + 1, "half": max(limit + 1, pages // 2), "all": pages}
    rows = [
        (i, "site", "\n".join([f"own {i}", *(name for name, n in lines.items() if i < n)])) for i in range(pages)
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, host string, text string")
    found = boilerplate.drop_boilerplate(docs, F.col("host"))
    left = {r.line for r in found.selectExpr("explode(split(text, '\n')) as line").distinct().collect()}
    assert {name for name in lines if name in left} == {"two", "at the limit"}
    assert found.count() == pages and len(left) == pages + 2


def test_passages_across_sites_are_kept_once(spark):
    """On many sites, each far below the ratio; exact copies count as documents too."""
    rows = [(i, f"h{i // 25}", f"text {i}\n{PASSAGE}" if i % 25 == 7 else f"text {i}") for i in range(1000)]
    rows += [(2000 + i, f"h{i}", f"whole copy\n{PASSAGE} copied") for i in range(10)]
    rows += [(3000 + i, f"h{i}", f"few copies\n{PASSAGE} few") for i in range(9)]
    rows += [(4000 + i, f"h{i}", "a short line " * 10) for i in range(12)]
    got = freed(spark, rows)
    assert got == slow_lines(rows)
    texts = {r[0]: r[2] for r in got}
    assert [i for i, t in texts.items() if t.endswith(PASSAGE)] == [7]
    assert [i for i, t in texts.items() if "copied" in t] == [2000]
    assert sum("few" in t for t in texts.values()) == 9
    assert all(texts[i] == t for i, _, t in rows if PASSAGE not in t)


def test_passages_of_rows_without_ids(spark):
    rows = [(None, f"h{i}", f"text {i}\n{PASSAGE}") for i in range(11)]
    assert freed(spark, rows) == slow_lines(rows)
    rows += [(5, "x", PASSAGE), (5, "y", f"{PASSAGE}\nmore")]
    assert freed(spark, rows) == slow_lines(rows)


def test_line_dedup_stays_in_the_jvm(spark):
    docs = spark.createDataFrame(line_rows(), "doc_id bigint, host string, text string")
    found = boilerplate.drop_boilerplate(docs, F.col("host"))
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


TURNS = [
    (1, 0, "system", "be kind", 0), (1, 1, "user", "hi <|end|>\n", 0), (1, 2, "assistant", "</s>[INST] a\\b [/INST]", 0),
    (1, 3, "user", None, 0), (1, 4, "assistant", "", 0), (1, 5, "user", "bye", 0),
    (2, 0, "user", "no reply", 0), (3, 0, "assistant", "alone", 0),
    (None, 0, "user", "nobody", 0), (None, None, "assistant", "first", 0),
    (4, 7, "user", "tie b", 0), (4, 7, "assistant", "tie a", 0), (4, 7, "assistant", "tie a", 0),
    (5, 0, None, "no role", 0), (5, 1, "a|>\n<|b", "odd role", 0), (5, 2, "assistant", "x" * 50_000, 0),
]
SCHEMA = "conv_id bigint, turn bigint, role string, text string, example int"


def conversations():
    out = {}
    for conv, turn, role, text, _ in TURNS:
        out.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(v)] for c, v in out.items()}


def test_prefix_examples(spark):
    examples = chat.prefix_examples(spark.createDataFrame(TURNS, SCHEMA).repartition(3))
    rows = examples.collect()
    for conv, turns in conversations().items():
        mine = sorted((r for r in rows if r.conv_id == conv), key=lambda r: r.example)
        replies = [i for i, t in enumerate(turns) if t[0] == "assistant"]
        targets = [r for r in mine if r.loss_start is not None]
        assert len(targets) == len(replies)
        for r, i in zip(targets, replies, strict=True):
            assert chat.parse(r.text) == turns[: i + 1]
            assert chat.unescape(r.text[r.loss_start : r.loss_end]) == turns[i][1]
        assert [r.last for r in mine] == [False] * (len(mine) - 1) + [True]
        assert chat.parse(mine[-1].text) == turns and mine[-1].n_turns == len(turns)
        assert len(mine) == len(replies) + (not replies or replies[-1] + 1 < len(turns))


def test_read_back(spark):
    examples = chat.prefix_examples(spark.createDataFrame(TURNS, SCHEMA))
    rows = {r.conv_id: r for r in chat.read_back(examples).collect()}
    assert len(rows) == len(conversations())
    for conv, turns in conversations().items():
        said = "".join(f"{r}\n{t}\n" for r, t in turns)
        loss = "".join(t for r, t in turns if r == "assistant")
        assert rows[conv].n_turns == len(turns)
        assert rows[conv].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert (rows[conv].loss_chars, rows[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    none = spark.createDataFrame([], SCHEMA)
    assert chat.read_back(chat.prefix_examples(none)).collect() == []


def escaped(values, texts):
    return values(chat.escape, texts)


def test_escape_is_reversible_and_hides_control_strings(spark, values):
    parts = [*chat.CONTROL, "\\", "<", "|", ">", "[", "/", "s", "\n", "x"]
    texts = [a + b + c for a in parts for b in parts for c in ("", "<|", "\\", ">")]
    for text, out in zip(texts, escaped(values, texts), strict=True):
        assert chat.unescape(out) == text
        assert not any(c in out for c in chat.CONTROL)


@settings(max_examples=100, deadline=None)
@given(st.text())
def test_unescape_ends(text):
    assert chat.unescape(text.replace("\\", "\\\\")) == text


PAGES = [
    (3, "http://a/1", "<p>same</p>", 0), (1, "http://a/2", "<p>same</p>", 0), (7, "http://a/3\r\nX: y", "<p>other é</p>", 0),
    (9, None, None, 0), (8, "", "", 0), (None, "http://n", "<p>same</p>", 0), (4, "http://l", "y" * 200_000, 0),
    (5, "http://d", "<p>twice</p>\r\n\r\nWARC-Type: x", 0), (5, "http://d", "<p>twice</p>\r\n\r\nWARC-Type: x", 0),
]
PAGE_SCHEMA = "page_id bigint, url string, html string, payload int"


@pytest.mark.parametrize("least", [0, 12])
def test_archive_round_trip(spark, least):
    pages = spark.createDataFrame(PAGES, PAGE_SCHEMA).repartition(3)
    folder = warc.write_archive(pages, min_payload_bytes=least)
    rows = warc.with_references(warc.parse_records(warc.restore(spark, folder))).collect()
    assert len(rows) == len(PAGES) and all(r.sound for r in rows)
    payloads = [(p[2] or "").encode() for p in PAGES]
    assert spark.read.parquet(f"{folder}/payloads").count() == len(set(payloads))
    want = []
    for (page_id, url, _, _), payload in zip(PAGES, payloads, strict=True):
        first = min((p[0] for p, q in zip(PAGES, payloads, strict=True) if q == payload and p[0] is not None), default=None)
        revisit = len(payload) >= least and page_id != first
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        safe = (url or "").replace("\r", "%0D").replace("\n", "%0A") or None
        want.append((page_id, safe, len(payload), digest, "revisit" if revisit else "response", first if revisit else None))
    got = [(r.page_id, r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_records_are_whole(spark):
    folder = warc.write_archive(spark.createDataFrame(PAGES, PAGE_SCHEMA))
    for r in warc.restore(spark, folder).collect():
        head, _, block = bytes(r.record).partition(b"\r\n\r\n")
        length = int(dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])["Content-Length"])
        assert block[length:] == b"\r\n\r\n" and bytes(r.record).startswith(bytes(r.headers))
        if b"WARC-Type: response" in head:
            assert block[:length].endswith(bytes(r.payload))


def test_damaged_payloads_stop_the_job(spark):
    folder = warc.write_archive(spark.createDataFrame(PAGES[:3], PAGE_SCHEMA))
    payloads = spark.read.parquet(f"{folder}/payloads")
    damaged = payloads.withColumn("payload", F.concat(F.substring("payload", 1, 3), F.lit("!!").cast("binary")))
    damaged.write.parquet(f"{folder}-damaged/payloads")
    spark.read.parquet(f"{folder}/records").write.parquet(f"{folder}-damaged/records")
    with pytest.raises(Exception, match="damaged payload"):
        warc.restore(spark, f"{folder}-damaged").collect()


def test_empty_archive(spark):
    folder = warc.write_archive(spark.createDataFrame([], PAGE_SCHEMA))
    assert warc.with_references(warc.parse_records(warc.restore(spark, folder))).collect() == []

import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from docketspark.llm import byte_bpe, packing, token_files, tokens
from docketspark.llm.tokens import Remembered, WordEncoder, tokenizer_path

WORD = WordEncoder(tokenizer_path())
WHOLE = Tokenizer.from_file(tokenizer_path())
TEXTS = [
    "Plain words, and MORE words.",
    "it's I'll we'd don't 'tis '",
    "tab\tand\r\nbreak\x0b\x0c\x1c\x85 thin blank hard  two   three ",
    "Éléphant ñandú ÖL straße ﬁ ＡＢＣ é ́x",
    "<|endoftext|> <|startoftext|>x 123 4.5 #*$%&|<>",
    "日本語のテキスト и кириллица ΣΑΣ İstanbul",
    "",
    "   ",
    "\n\n",
    "a\x00b",
    "x" * 5000,
]
DOCS = [(i, t, "extra") for i, t in enumerate(TEXTS)] + [(0, TEXTS[0], "again"), (None, "no id", None), (99, None, "no text")]
SCHEMA = "doc_id bigint, text string, ids string"


def whole_ids(text, end=None):
    ids = WHOLE.encode(text or "", add_special_tokens=False).ids
    return ids if end is None else [*ids, end]


@pytest.mark.parametrize("text", TEXTS)
def test_word_encoder_gives_the_tokenizers_ids(text):
    assert np.frombuffer(WORD.encode(text), "<u4").tolist() == whole_ids(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n\t'.,aBéÑ<|>")), max_size=60))
def test_word_encoder_on_any_text(text):
    assert np.frombuffer(WORD.encode(text), "<u4").tolist() == whole_ids(text)


COLUMN = [*TEXTS, None, "a×b ×, é, ÷ Ñ!? É\u0301 J\u030c x\u0301.", "<|endoftext|>x", "word, " * 40, "日本" * 300, "é" * 700]


@pytest.mark.parametrize("size", [1, 7, 64, 1 << 21])
@pytest.mark.parametrize("end", [None, 2])
def test_a_column_gives_the_tokenizers_ids(monkeypatch, size, end):
    monkeypatch.setattr(tokens, "SLICE_BYTES", size)
    for column in (pa.array(COLUMN), pa.array(["cut off", *COLUMN, "too"]).slice(1, len(COLUMN)), pa.array([], pa.string())):
        found = WordEncoder(tokenizer_path()).encode_column(column, end)
        assert [np.frombuffer(x, "<u4").tolist() for x in found] == [whole_ids(t, end) for t in column.to_pylist()]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n\x0b\x0c\x1c\x85'.,aBéÑ×÷<|>")), max_size=20), max_size=6))
def test_a_column_of_any_texts(texts):
    found = WORD.encode_column(pa.array(texts, pa.string()), 1)
    assert [np.frombuffer(x, "<u4").tolist() for x in found] == [whole_ids(t, 1) for t in texts]


def test_a_batch_asks_for_each_distinct_piece_once(monkeypatch):
    asked = []
    coder = WordEncoder(tokenizer_path())
    monkeypatch.setattr(coder, "pieces", type("P", (), {"__getitem__": lambda self, p: asked.append(p) or coder._piece(p)})())
    column = pa.array(["the same words, again and again, it's"] * 500)
    assert len(set(coder.encode_column(column))) == 1
    assert sorted(asked) == sorted([b"the", b"same", b"words", b",", b"again", b"and", b"it's"])


def test_remembered_forgets_and_computes_again():
    calls = []
    known = Remembered(lambda k: calls.append(k) or k * 2, 3)
    assert [known[k] for k in (1, 2, 3, 1, 4, 5, 6, 1)] == [2, 4, 6, 2, 8, 10, 12, 2]
    assert len(known) <= 3


def test_sequence_sizes_need_no_padding():
    for tokens in (0, 1, 7, 2047, 2048, 2049, 10_000):
        sizes = packing.sequence_sizes(tokens, 2048)
        assert sum(sizes) == tokens and all(s & (s - 1) == 0 and s <= 2048 for s in sizes)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=40))
def test_balance_places_every_token_once(lengths):
    rows, sizes, costs = packing.balance(lengths, 32)
    pieces = {}
    filled = {}
    for piece, start, length, sequence, offset in rows:
        assert length > 0
        pieces.setdefault(piece, []).append((start, length))
        filled.setdefault(sequence, []).append((offset, length))
    for piece, length in enumerate(lengths):
        assert sum(n for _, n in pieces.get(piece, [])) == length
        at = 0
        for start, n in sorted(pieces.get(piece, [])):
            assert start == at
            at += n
    for sequence, size in enumerate(sizes):
        at = 0
        for offset, n in sorted(filled[sequence]):
            assert offset == at
            at += n
        assert at == size
    assert sum(costs) == pytest.approx(sum(packing.attention_cost(r[2]) for r in rows))


def test_balance_takes_the_cheapest_sequence_with_room():
    rows, _, costs = packing.balance([16, 16, 8, 8, 8, 8], 32)
    assert {r[0]: r[3] for r in rows} == {0: 0, 1: 1, 2: 0, 3: 1, 4: 0, 5: 1}
    assert costs[0] == costs[1]


def test_pack_covers_every_row(spark):
    docs = spark.createDataFrame(DOCS, SCHEMA)
    rows = packing.pack(docs, capacity=64, window_tokens=500).collect()
    sequences = {}
    for r in rows:
        assert len(r.ids) == 4 * r.length
        sequences.setdefault(r.sequence_id, []).append(r)
    for held in sequences.values():
        at = 0
        for r in sorted(held, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == held[0].sequence_tokens <= 64
    for doc_id, text, _ in DOCS[1:]:
        if doc_id == 0:
            continue
        mine = sorted((r for r in rows if r.doc_id == doc_id), key=lambda r: r.start)
        found = b"".join(bytes(r.ids) for r in mine)
        assert np.frombuffer(found, "<u4").tolist() == whole_ids(text, 1)
    assert sum(r.length for r in rows if r.doc_id == 0) == 2 * len(whole_ids(TEXTS[0], 1))


@pytest.mark.parametrize("run", ["pack", "write_tokens"])
def test_documents_are_encoded_a_batch_at_a_time(spark, tmp_path, monkeypatch, run):
    class Columns:
        """Ids of columns alone; no text by itself."""

        def __init__(self, coder):
            self.encode_column = coder.encode_column

    monkeypatch.setattr(packing if run == "pack" else token_files, "encoder", lambda path: Columns(WordEncoder(path)))
    docs = spark.createDataFrame(DOCS, SCHEMA)
    if run == "pack":
        found = packing.pack(docs).agg(F.sum("length")).first()[0]
    else:
        folder = token_files.write_tokens(docs, f"file://{tmp_path}/store", path=tokenizer_path())
        found = token_files.segments(spark, folder).agg(F.sum("n_ids")).first()[0]
    assert found == sum(len(whole_ids(t, 1)) for _, t, _ in DOCS)


def test_pack_empty_and_bad_capacity(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert packing.pack(docs).collect() == []
    with pytest.raises(ValueError):
        packing.pack(docs, capacity=100)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=1500), st.sampled_from([4, 8, 16]))
def test_levels_round_trip(ids, bits):
    data = np.array(ids, "<u4").tobytes()
    segment = token_files.Segment(token_files.segment_bytes([5, None], [data[: 4 * (len(ids) // 2)], data[4 * (len(ids) // 2) :]], bits))
    assert segment.all().tolist() == ids
    assert segment.at(np.arange(len(ids))[::-1]).tolist() == ids[::-1]


def test_damaged_files_are_refused():
    good = token_files.segment_bytes([1], [np.array([1, 2, 70000], "<u4").tobytes()])
    with pytest.raises(ValueError):
        token_files.Segment(b"x" + good[1:])
    with pytest.raises(ValueError):
        token_files.Segment(good + b"\0")
    with pytest.raises(IndexError):
        token_files.Segment(good).at(np.array([3]))


def test_token_files_round_trip(spark, tmp_path):
    docs = spark.createDataFrame(DOCS, SCHEMA).repartition(5)
    folder = token_files.write_tokens(docs, f"file://{tmp_path}/store", segment_ids=40)
    rows = sorted(token_files.read_tokens(spark, folder).collect(), key=lambda r: r.start)
    order = sorted(DOCS, key=lambda d: (d[0] is not None, d[0] or 0, d[1] or ""))
    assert [r.doc_id for r in rows] == [d[0] for d in order]
    stream = []
    for row, (_, text, _) in zip(rows, order, strict=True):
        assert row.start == len(stream)
        assert np.frombuffer(row.ids, "<u4").tolist() == whole_ids(text, 2)
        stream += whole_ids(text, 2)
    asked = [0, 5, 77, len(stream) - 1, len(stream), -1, None, 5]
    positions = spark.createDataFrame([(p,) for p in asked], "position bigint")
    found = {r.position: r.id for r in token_files.tokens_at(spark, folder, positions).collect()}
    assert found == {p: stream[p] for p in (0, 5, 77, len(stream) - 1)}


def test_token_files_of_an_empty_table(spark, tmp_path):
    folder = token_files.write_tokens(spark.createDataFrame([], SCHEMA), str(tmp_path / "none"))
    assert token_files.read_tokens(spark, folder).collect() == []
    positions = spark.createDataFrame([(0,)], "position bigint")
    assert token_files.tokens_at(spark, folder, positions).collect() == []


SPACES = " \n\t\r\x0b\x1c\x85\xa0 　"


@settings(max_examples=1500, deadline=None)
@given(
    st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(f"{SPACES}'.,aB1é\x1f")), max_size=60),
    st.booleans(),
)
def test_words_are_the_patterns_matches(text, cuts):
    words = byte_bpe.Words(public_tokenizers.PATTERN, cuts)
    places = words(text)
    hashes, known, of_pieces = words.table()
    assert len(known) == len(set(known)) and hashes.tolist() == sorted(map(zlib.crc32, known))
    assert byte_bpe._unpacked(byte_bpe._packed(known)) == known
    assert [known[n].decode() for p in places for n in of_pieces[p]] == regex.findall(public_tokenizers.PATTERN, text)
    assert byte_bpe._unsqueezed(byte_bpe._squeezed(np.array(places, np.uint32))).tolist() == places


@pytest.mark.parametrize("text", ["a\n \nfoo", "a\t \tb", "x\xa0 y", " a", "a ", "a  b", "　 　z", ""])
def test_white_space_before_a_blank_is_not_cut(text):
    words = byte_bpe.Words(public_tokenizers.PATTERN)
    places = words(text)
    _, known, of_pieces = words.table()
    assert [known[n].decode() for p in places for n in of_pieces[p]] == regex.findall(public_tokenizers.PATTERN, text)


@pytest.mark.parametrize("pattern", [public_tokenizers.PATTERN, r"[a-z]+ [a-z]+|\s+|."])
def test_byte_bpe_with_another_vocabulary(spark, tmp_path, pattern):
    """Tokens of white space, and a pattern that joins words over a blank."""
    ranks = {bytes([b]): b for b in range(256)} | {b"\n ": 256, b" \n": 257, b"\t ": 258, b"a ": 259, b"a b": 260}
    path = tmp_path / "own.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % r for t, r in ranks.items()))
    coder = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    texts = ["a\n \nfoo", "a\t \tb", "a b a b", "a  b", "é a\xa0 b", " \n \n a b "]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = byte_bpe.decode(byte_bpe.encode(docs, str(path), pattern), str(path)).collect()
    assert {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in rows} == dict(enumerate(map(coder.encode_ordinary, texts)))
    assert {r.doc_id: bytes(r.data).decode() for r in rows} == dict(enumerate(texts))


def test_byte_bpe_of_documents_from_a_shuffle(spark):
    """Blocks are read as they were written, whatever order rows come in."""
    texts = spark.range(400).selectExpr("id as doc_id", "concat('word', id % 37, ' of the doc ', id) as text")
    docs = texts.repartition(7, "text").join(texts.selectExpr("doc_id as other").repartition(5), F.expr("doc_id = other"))
    rows = byte_bpe.decode(byte_bpe.encode(docs, block_chars=300)).collect()
    expected = {r.doc_id: r.text.encode() for r in texts.collect()}
    assert {r.doc_id: bytes(r.data) for r in rows} == expected and len(rows) == 400


def test_buckets_grow_with_the_words(spark, monkeypatch):
    monkeypatch.setattr(byte_bpe, "BUCKET_WORDS", 5)
    docs = spark.createDataFrame(DOCS, SCHEMA)
    encoded = byte_bpe.encode(docs, block_chars=50)
    assert encoded.rdd.getNumPartitions() > 4
    assert sorted(bytes(r.data) for r in byte_bpe.decode(encoded).collect()) == sorted((t or "").encode() for _, t, _ in DOCS)


@pytest.mark.parametrize("block_chars", [10, 10_000])
def test_byte_bpe_encodes_and_decodes(spark, block_chars):
    path = tokenizer_path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = spark.createDataFrame(DOCS, SCHEMA).repartition(3)
    rows = byte_bpe.decode(byte_bpe.encode(docs, block_chars=block_chars)).collect()
    want = sorted((str(d), np.array(coder.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for d, t, _ in DOCS)
    assert sorted((str(r.doc_id), bytes(r.ids), bytes(r.data)) for r in rows) == want


def test_byte_bpe_of_an_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert byte_bpe.decode(byte_bpe.encode(docs)).collect() == []


def test_digests_of_the_query_columns(spark):
    ids = np.array([1, 2, 300], "<u4").tobytes()
    row = spark.createDataFrame([(bytearray(ids),)], "ids binary").selectExpr("crc32(ids) c", "sha2(ids, 256) s").first()
    assert (row.c, row.s) == (zlib.crc32(ids), hashlib.sha256(ids).hexdigest())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "a", " ", "\n", "É", "<|", "endoftext", "|>", "x1"]), max_size=8))
def test_added_tokens_are_those_of_the_plain_call(parts):
    text = "".join(parts)
    assert np.frombuffer(WORD.encode(text), "<u4").tolist() == whole_ids(text)


def test_an_added_token_in_a_text():
    assert np.frombuffer(WORD.encode("a <|endoftext|> b"), "<u4").tolist() == [320, 49407, 321]


def segment_of(seed, n=3000):
    rng = np.random.default_rng(seed)
    ids = [rng.choice([5, 300, 70_000, 20_000_000], rng.integers(0, 40)).astype("<u4") for _ in range(n // 20)]
    return token_files.segment_bytes(list(range(len(ids))), [x.tobytes() for x in ids]), np.concatenate(ids)


def test_a_damaged_directory_is_refused(spark, tmp_path):
    content, ids = segment_of(1)
    segment = token_files.Segment(content)
    assert (segment.checked() == ids).all()
    for level, (_, _, ranks) in enumerate(segment.levels):
        at = content.index(ranks.tobytes(), 32) if len(ranks) > 1 else None
        for entry in range(len(ranks)):
            broken = bytearray(content)
            broken[at + 8 * entry] ^= 1
            with pytest.raises(ValueError, match="director"):
                token_files.Segment(bytes(broken)).checked()
    folder = token_files.write_tokens(spark.createDataFrame(DOCS, SCHEMA), str(tmp_path / "ids"))
    [path, *_] = sorted((tmp_path / "ids").rglob("*.dac"))
    whole = path.read_bytes()
    ranks = token_files.Segment(whole).levels[0][2].tobytes()
    path.write_bytes(whole.replace(ranks, bytes(len(ranks))))
    for crc in path.parent.glob(".*.crc"):
        crc.unlink()
    with pytest.raises(Exception, match="damaged rank directory"):
        token_files.read_tokens(spark, folder).collect()


def test_single_ids_are_read_by_offset():
    content, ids = segment_of(2)

    read = []

    class File:
        def read_at(self, n, at):
            read.append(n)
            return content[at : at + n]

    segment = token_files.SegmentFile(File())
    opened = sum(read)
    places = [0, 1, 511, 512, 513, len(ids) // 2, len(ids) - 1]
    assert [segment.at(p) for p in places] == ids[places].tolist()
    assert sum(read) - opened <= len(places) * 4 * (1 + 64 + 8) < len(content)
    for place in (-1, len(ids)):
        with pytest.raises(IndexError):
            segment.at(place)
    with pytest.raises(ValueError, match="not a token file"):
        token_files.SegmentFile(type("F", (), {"read_at": lambda self, n, at: b"x" * n})())

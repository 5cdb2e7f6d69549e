"""Similarity join of documents on word shingles, filtered under several token orders."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docketspark.llm.common import (
    fresh,
    give_back,
    lower_ascii,
    mix64,
    small_batches,
    shuffle_parts,
    stored,
    text_of,
    utf8_column,
    word_hashes,
    word_ranges,
    word_windows,
)
from docketspark.llm.components import components

WORDS = 5
PERCENT = 75
# Token orders under which a pair has to share a prefix token.
ORDERS = 3
# Keys under which a document looks for a leader before the join.
ANCHORS = 4
# Shingles are counted in so many cells (a power of two); their frequency classes are sent
# to every task, in this many bytes at any size of the corpus.
SKETCH_BITS = 22
SLICES = 64
# Prefix tokens that one task holds together; its arrays for them take some 130 bytes a token.
WINDOW_TOKENS = 250_000
# Bytes of texts that are cut into shingles together; the arrays for it take some 80 bytes a byte.
SHINGLED_BYTES = 1 << 18
# Documents, or pairs of prefixes, that are worked on at a time.
_SHINGLED = 256
# Identifiers that are broadcast when texts are looked up; more are joined by a shuffle.
BROADCAST_IDS = 2_000_000

_SEEDS = mix64(np.arange(1, 1 + ORDERS + ANCHORS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_LOW48 = np.uint64((1 << 48) - 1)
# Bits of a set's parities, 64 in a column.
PARITY_BITS = 512
_PARITIES = [f"s{i}" for i in range(PARITY_BITS // 64)]
_PARITY_TYPES = "".join(f", {s} bigint" for s in _PARITIES)
# Tokens before a token that go with it.
_BEFORE = ["p1", "p2", "p3"]


def parities(found: np.ndarray) -> np.ndarray:
    """A set's shingles dealt to ``PARITY_BITS`` cells, and whether each cell's number is odd.

    A shingle that only one of two sets has turns one bit, so two sets differ in at least as
    many shingles as their parities differ in bits.
    """
    cells = mix64(found ^ np.uint64(0xD6E8FEB86659FD93)) % np.uint64(PARITY_BITS)
    odd = np.bincount(cells.astype(np.int64), minlength=PARITY_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view("<i8")


def shingle_sets(column: pa.Array, words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingles of each text, as 64-bit hashes.

    Texts are taken in runs of about ``SHINGLED_BYTES``, one text at least, so that what a
    worker holds does not grow with the texts of a batch.
    """
    ends, at, sets = utf8_column(column)[1][1:], 0, []
    while at < len(column):
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + SHINGLED_BYTES, side="right")))
        sets += _shingle_sets(column.slice(at, stop - at), words)
        at = stop
    return sets


def _shingle_sets(column: pa.Array, words: int) -> list[np.ndarray]:
    data, offsets = utf8_column(column)
    data = lower_ascii(data)
    docs, starts, ends = word_ranges(data, offsets)
    hashes = word_hashes(data, starts, ends)
    shingles, first = word_windows(docs, hashes, words)
    cuts = np.searchsorted(docs[first], np.arange(len(column) + 1))
    counts = np.searchsorted(docs, np.arange(len(column) + 1))
    sets = []
    for i in range(len(column)):
        found = shingles[cuts[i] : cuts[i + 1]]
        n = int(counts[i + 1] - counts[i])
        if not len(found) and n:  # fewer words than a shingle has: the whole sequence is one
            factors = np.array([pow(0xA24BAED4963EE407, j + 1, 1 << 64) for j in range(n)], np.uint64)
            found = mix64(np.array([(hashes[counts[i] : counts[i + 1]] * factors).sum() + np.uint64(n)], np.uint64))
        found = np.sort(found)
        if len(found) > 1:
            found = found[np.concatenate([[True], found[1:] != found[:-1]])]
        sets.append(found)
    return sets


def prefix_length(n: int, percent: int = PERCENT) -> int:
    """Tokens of a set of ``n`` of which a similar set must share one, in any order."""
    return n - -(-n * percent // 100) + 1 if n else 0


def _cells(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def in_order(shingles: np.ndarray, order: int, classes: np.ndarray) -> np.ndarray:
    """Shingles as 64-bit keys of one of the global orders, least first: those of rare
    classes come first, and each order breaks ties within a class by a hash of its own."""
    key = mix64(shingles ^ _SEEDS[order]) >> np.uint64(8)
    key |= classes[_cells(shingles)].astype(np.uint64) << np.uint64(56)
    return np.sort(key)


def frequency_classes(counts: np.ndarray) -> np.ndarray:
    """Class of each cell: 0 where the count is what chance alone gives a cell, else one
    more for each doubling beyond it."""
    mean = max(float(counts.mean()), 1.0)
    excess = (counts - mean) / (4 * np.sqrt(mean))
    return np.where(excess > 1, np.log2(np.maximum(excess, 1)) + 1, 0).astype(np.uint8)


def _summaries(docs: DataFrame, words: int) -> tuple[DataFrame, DataFrame]:
    """Of one pass over the texts: a row per document, and the shingle counts of each task."""
    import zstandard

    anchors = [f"a{i}" for i in range(ANCHORS)]
    names = ["doc_id", "n", "d1", "d2", *anchors, "slice", "counts"]

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.uint32)
        for batch in small_batches(frames):
            sets = shingle_sets(batch.column(1), words)
            rows = np.zeros((len(sets), 3 + ANCHORS), np.uint64)
            for i, found in enumerate(sets):
                if len(found):
                    rows[i, 0] = len(found)
                    rows[i, 1] = found.sum()
                    rows[i, 2] = mix64(found ^ np.uint64(0x5851F42D4C957F2D)).sum()
                    for j in range(ANCHORS):
                        rows[i, 3 + j] = mix64(found ^ _SEEDS[ORDERS + j]).min()
                    np.add.at(counts, _cells(found), np.uint32(1))
            signed = rows.view(np.int64)
            columns = [batch.column(0), *[pa.array(signed[:, j]) for j in range(3 + ANCHORS)]]
            none = [pa.nulls(len(sets), pa.int32()), pa.nulls(len(sets), pa.binary())]
            yield pa.RecordBatch.from_arrays([*columns, *none], names=names)
        if counts.any():
            squeeze = zstandard.ZstdCompressor(level=1).compress
            blobs = [squeeze(part.astype("<u4").tobytes()) for part in np.split(counts, SLICES)]
            empty = [pa.nulls(SLICES, pa.int64()) for _ in range(4 + ANCHORS)]
            yield pa.RecordBatch.from_arrays(
                [*empty, pa.array(np.arange(SLICES, dtype=np.int32)), pa.array(blobs, pa.binary())],
                names=names,
            )

    schema = "doc_id bigint, n bigint, d1 bigint, d2 bigint, "
    schema += ", ".join(f"{a} bigint" for a in anchors) + ", slice int, counts binary"
    made = stored(docs.mapInArrow(run, schema), "shingle-summaries")
    return (
        made.where("slice is null").drop("slice", "counts"),
        made.where("slice is not null").select("slice", "counts"),
    )


def _classes(counts: DataFrame) -> np.ndarray:
    """Sum the tasks' counts by slice and turn them into frequency classes.

    The result has one byte per cell whatever the corpus, so it may go to every task.
    """

    def add(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        size = (1 << SKETCH_BITS) // SLICES
        sums: dict[int, np.ndarray] = {}
        for batch in small_batches(frames):
            for at, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                part = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), "<u4")
                if at not in sums:
                    sums[at] = np.zeros(size, np.uint64)
                sums[at] += part
        for at, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([at], pa.int32()), pa.array([total.astype("<u8").tobytes()], pa.binary())],
                names=["slice", "counts"],
            )

    # First within parts of the tasks' rows, then the parts' sums: no task sees all rows.
    salted = counts.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(32)))
    once = salted.repartition(shuffle_parts(counts), "slice", "_salt").select("slice", "counts")
    schema = "slice int, counts binary"

    def add_u8(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in small_batches(frames):
            for at, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                part = np.frombuffer(blob, "<u8")
                sums[at] = sums[at] + part if at in sums else part.copy()
        for at, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([at], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                names=["slice", "counts"],
            )

    summed = once.mapInArrow(add, schema)
    summed = summed.repartition(min(SLICES, shuffle_parts(counts)), "slice").mapInArrow(add_u8, schema)
    whole = np.zeros(1 << SKETCH_BITS, np.uint64)
    size = len(whole) // SLICES
    for row in summed.collect():  # one row per slice
        whole[row.slice * size : (row.slice + 1) * size] = np.frombuffer(row.counts, "<u8")
    return frequency_classes(whole.astype(np.float64))


def _compatible(a: str, b: str, percent: int) -> str:
    """Sizes that the required similarity allows."""
    return f"100 * least({a}, {b}) >= {percent} * greatest({a}, {b})"


def _texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Documents of the listed ids; the list is broadcast while it is short, else shuffled."""
    if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        return docs.join(F.broadcast(ids), "doc_id", "left_semi")
    return docs.join(ids, "doc_id", "left_semi")


def verified(docs: DataFrame, pairs: DataFrame, classes, words: int, percent: int) -> DataFrame:
    """The ``pairs`` (a, b) whose documents are similar.

    A pair has to share a prefix token under every order; only then are its sets compared.
    """

    def similar(a: np.ndarray, b: np.ndarray, prefixes) -> bool:
        if not len(a) or not len(b):
            return False
        for of_a, of_b in prefixes:
            both = np.concatenate([of_a, of_b])
            both.sort()
            if not (both[1:] == both[:-1]).any():
                return False
        both = np.concatenate([a, b])
        both.sort()
        common = int((both[1:] == both[:-1]).sum())
        return 100 * common >= percent * (len(a) + len(b) - common)

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = classes.value
        last: dict[int, tuple] = {}

        def looked_up(known: dict, doc: int, found: np.ndarray):
            if doc not in known:
                size = prefix_length(len(found), percent)
                known[doc] = (found, [in_order(found, o, table)[:size] for o in range(ORDERS)])
            return known[doc]

        for batch in small_batches(frames):
            ids_a, ids_b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            sets_a = shingle_sets(batch.column(2), words)
            # Rows are sorted by b, so most of them repeat the text of the one before.
            firsts = [i for i, b in enumerate(ids_b) if not i or ids_b[i - 1] != b or batch.column(3)[i] != batch.column(3)[i - 1]]
            sets_b = shingle_sets(batch.column(3).take(pa.array(firsts, pa.int64())), words)
            at, out = -1, []
            for i, (a, b) in enumerate(zip(ids_a, ids_b, strict=True)):
                if at + 1 < len(firsts) and firsts[at + 1] == i:
                    at, last = at + 1, {}
                set_a, prefixes_a = looked_up({}, a, sets_a[i])
                set_b, prefixes_b = looked_up(last, b, sets_b[at])
                out.append(similar(set_a, set_b, list(zip(prefixes_a, prefixes_b, strict=True))))
            kept = batch.select([0, 1]).filter(pa.array(out, pa.bool_()))
            yield kept

    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    texts = _texts_of(docs, stored(ids, "pair-ids"))
    left = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    joined = left.join(right, "b").select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(run, "a bigint, b bigint").distinct()


def _leader_pairs(sets: DataFrame, percent: int) -> DataFrame:
    """Each document with the least one that has the same least shingle under a hash.

    At most ``ANCHORS`` pairs per document, so a group of copies of any size is tied
    together without its pairs being listed.
    """
    keys = [F.struct(F.lit(i).alias("i"), F.col(f"a{i}").alias("key")) for i in range(ANCHORS)]
    anchored = sets.select("rep", "n", F.explode(F.array(*keys)).alias("k"))
    anchored = anchored.select("rep", "n", "k.i", "k.key")
    leaders = anchored.groupBy("i", "key").agg(
        F.min(F.struct(F.col("rep").alias("lead"), F.col("n").alias("lead_n"))).alias("l")
    )
    joined = anchored.join(stored(leaders, "leaders"), ["i", "key"])
    pairs = joined.select(F.col("rep").alias("a"), F.col("l.lead").alias("b"), "n", F.col("l.lead_n").alias("lead_n"))
    pairs = pairs.where("a <> b").where(_compatible("n", "lead_n", percent))
    return pairs.select("a", "b").distinct()


def _prefixes(docs: DataFrame, classes, words: int, percent: int, windows: int) -> DataFrame:
    """``window, doc_id, n, tokens``, parities: each document's prefix under the first order."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = classes.value
        for batch in small_batches(frames):
            sets = shingle_sets(batch.column(2), words)
            tokens = [
                (in_order(s, 0, table)[: prefix_length(len(s), percent)] & _LOW48)
                .astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()
                for s in sets
            ]
            sizes = pa.array([len(s) for s in sets], pa.int64())
            bits = np.array([parities(s) for s in sets], np.int64).reshape(-1, len(_PARITIES))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), sizes, pa.array(tokens, pa.binary()), *map(pa.array, bits.T.copy())],
                names=["window", "doc_id", "n", "tokens", *_PARITIES],
            )

    window = F.pmod(F.xxhash64("doc_id"), F.lit(windows)).alias("window")
    rows = docs.where("doc_id is not null").select(window, "doc_id", "text")
    return rows.mapInArrow(run, "window bigint, doc_id bigint, n bigint, tokens binary" + _PARITY_TYPES).where("n > 0")


def _tokens(column) -> np.ndarray:
    raw = np.frombuffer(b"".join(column), np.uint8).reshape(-1, 6)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, :6] = raw
    return wide.view("<u8").ravel()


def _entries(prefixes: pa.Table, groups: pa.Table):
    """Prefix tokens of a window's class representatives: documents, tokens, the row and the
    place in the prefix of each."""
    reps, comps = (groups.column(c).to_numpy() for c in ("rep", "comp"))
    order = np.argsort(reps)
    reps, comps = reps[order], comps[order]
    docs = prefixes.column("doc_id").to_numpy()
    at = np.minimum(np.searchsorted(reps, docs), max(len(reps) - 1, 0))
    kept = np.flatnonzero(reps[at] == docs) if len(reps) else np.zeros(0, np.int64)
    blobs = prefixes.column("tokens").take(pa.array(kept)).to_pylist()
    sizes = np.array([len(t) // 6 for t in blobs], np.int64)
    rows = np.repeat(np.arange(len(kept)), sizes)
    places = np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    found = {"doc_id": docs[kept], "comp": comps[at[kept]] if len(kept) else comps[:0]}
    found |= {c: prefixes.column(c).to_numpy()[kept] for c in prefixes.column_names if c in ("n", *_PARITIES)}
    return found, _tokens(blobs), rows.astype(np.int64), places


# Rows that Python passes on at a time.
_CHUNK = 1 << 16


def _chunked(table: pa.Table) -> pa.Table:
    return pa.Table.from_batches(table.to_batches(max_chunksize=_CHUNK), table.schema)


def shared_tokens(prefixes: DataFrame, placed: DataFrame) -> DataFrame:
    """``window, token`` of the prefix tokens that documents of several components have.

    Every window gives each of its tokens once, with the least and the greatest component
    that has it, so a large group of copies costs a row per window and token. Tokens meet
    by an exchange whose rows grow with the tokens alone; a token's rows, one a window, are
    sorted by Spark, which spills them.
    """

    def of_windows(key, left: pa.Table, right: pa.Table) -> pa.Table:
        give_back()  # what the window before this one took
        found, tokens, rows, _ = _entries(left, right)
        comps = found["comp"][rows]
        order = np.lexsort((comps, tokens))
        tokens, comps = tokens[order], comps[order]
        opens = np.ones(len(tokens), bool)
        opens[1:] = tokens[1:] != tokens[:-1]
        starts = np.flatnonzero(opens)
        ends = np.append(starts[1:], len(tokens)) - 1 if len(starts) else starts
        window = np.full(len(starts), key[0].as_py() if len(starts) else 0, np.int32)
        columns = [window, tokens[starts].astype(np.int64), comps[starts], comps[ends]]
        return _chunked(pa.table([pa.array(c) for c in columns], names=["window", "token", "low", "high"]))

    prefixes = prefixes.drop(*_PARITIES)
    sent = prefixes.groupBy("window").cogroup(placed.groupBy("window")).applyInArrow(
        of_windows, "window int, token bigint, low bigint, high bigint"
    )
    of_token = Window.partitionBy("token")
    met = sent.select(
        "window", "token", F.min("low").over(of_token).alias("low"), F.max("high").over(of_token).alias("high")
    )
    return met.where("low < high").select(F.col("window").cast("bigint").alias("window"), "token")


def candidate_pairs(prefixes: DataFrame, groups: DataFrame, windows: int, percent: int) -> DataFrame:
    """Pairs of documents of different components that share a prefix token."""
    return meetings(prefixes, groups, windows, percent).distinct()


def meetings(prefixes: DataFrame, groups: DataFrame, windows: int, percent: int) -> DataFrame:
    """``candidate_pairs``, of which some come several times.

    Tokens that only one component has, nearly all, end with ``shared_tokens``. The others
    are reported to the windows that have them, whose documents then meet by token, as far as
    the places of the token in both prefixes, and the parities of both sets, allow the sets
    to be similar. Two documents do not meet at a token where one of the tokens just before it
    is common to them as well: they meet there, or still earlier.
    """

    def live_entries(key, left: pa.Table, right: pa.Table) -> pa.Table:
        give_back()
        live = np.sort(right.column("token").drop_null().to_numpy())
        groups_of = right.filter(pc.is_valid(right.column("rep")))
        names = ["token", "doc_id", "comp", "n", *_PARITIES, "left", *_BEFORE]
        if not len(live) or not len(left):
            return pa.table([pa.array([], pa.int64())] * len(names), names=names)
        found, tokens, rows, places = _entries(left, groups_of)
        tokens = tokens.astype(np.int64)
        hit = live[np.minimum(np.searchsorted(live, tokens), len(live) - 1)] == tokens
        columns = [pa.array(tokens[hit])]
        columns += [pa.array(found[c][rows[hit]]) for c in ("doc_id", "comp", "n", *_PARITIES)]
        columns.append(pa.array(found["n"][rows[hit]] - places[hit]))
        tokens, rows = tokens[hit], rows[hit]
        for back in range(1, len(_BEFORE) + 1):
            before = np.full(len(tokens), -1, np.int64)
            before[back:] = np.where(rows[back:] == rows[:-back], tokens[:-back], -1)
            columns.append(pa.array(before))
        return _chunked(pa.table(columns, names=names))

    window = F.pmod(F.xxhash64("rep"), F.lit(windows)).alias("window")
    placed = groups.select(window, "rep", "comp")
    live = stored(shared_tokens(prefixes, placed), "live-tokens")
    nothing = F.lit(None).cast("bigint")
    told = placed.withColumn("token", nothing).unionByName(
        live.select("window", nothing.alias("rep"), nothing.alias("comp"), "token")
    )
    entries = prefixes.groupBy("window").cogroup(told.groupBy("window")).applyInArrow(
        live_entries, f"token bigint, doc_id bigint, comp bigint, n bigint{_PARITY_TYPES}, left bigint, p1 bigint, p2 bigint, p3 bigint"
    )
    entries = stored(entries, "live-entries")
    x, y = entries.alias("x"), entries.alias("y")
    same = (F.col("x.token") == F.col("y.token")) & (F.col("x.comp") < F.col("y.comp"))
    # Sets of which this is the first common token have at most the tokens from it on in
    # common. Where that is too few, it is too few for any later common token as well.
    enough = f"{100 + percent} * least(x.left, y.left) >= {percent} * (x.n + y.n)"
    # Similar sets differ in so few shingles, and in no more parities.
    turned = " + ".join(f"bit_count(x.{s} ^ y.{s})" for s in _PARITIES)
    near = f"{100 + percent} * ({turned}) <= {100 - percent} * (x.n + y.n)"
    # A token before this one that both have lies earlier in both prefixes, where more is left.
    first = " and ".join(f"(x.{p} < 0 or x.{p} not in ({', '.join(f'y.{q}' for q in _BEFORE)}))" for p in _BEFORE)
    met = x.join(y, same & F.expr(_compatible("x.n", "y.n", percent)) & F.expr(enough) & F.expr(near) & F.expr(first))
    return met.select(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b"))


def sharing_all_prefixes(docs: DataFrame, pairs: DataFrame, classes, words: int, percent: int) -> DataFrame:
    """The ``pairs`` (a, b) that share a prefix token under each of the other orders too.

    Only prefixes are moved for it, 4 bytes a token: no text meets another one before all
    orders agree. Tokens that are equal in 32 bits by chance let a pair pass. Documents that
    repeat an id have several prefixes, and any two of them may agree.
    """

    def prefixes(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = classes.value
        for batch in small_batches(frames, _SHINGLED):
            sets = shingle_sets(batch.column(1), words)
            columns = [batch.column(0)]
            for order in range(1, ORDERS):
                found = [in_order(s, order, table)[: prefix_length(len(s), percent)] for s in sets]
                columns.append(pa.array([f.astype(np.uint32).tobytes() for f in found], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *names])

    def intersect(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(frames, _SHINGLED):
            stays = np.ones(batch.num_rows, bool)
            for name in names:
                both = zip(batch.column(f"{name}_a").to_pylist(), batch.column(f"{name}_b").to_pylist(), strict=True)
                for i, (a, b) in enumerate(both):
                    if stays[i]:
                        x = np.sort(np.frombuffer(a + b, np.uint32))
                        stays[i] = len(x) > 1 and bool((x[1:] == x[:-1]).any())
            yield batch.select([0, 1]).filter(pa.array(stays))

    names = [f"order{order}" for order in range(1, ORDERS)]
    ids = stored(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "pair-ids")
    schema = "doc_id bigint, " + ", ".join(f"{name} binary" for name in names)
    known = stored(_texts_of(docs, ids).select("doc_id", "text").mapInArrow(prefixes, schema), "other-prefixes")
    sides = [
        known.select(F.col("doc_id").alias(side), *[F.col(n).alias(f"{n}_{side}") for n in names]) for side in "ab"
    ]
    joined = pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", *[f"{n}_{s}" for n in names for s in "ab"])
    return joined.mapInArrow(intersect, "a bigint, b bigint").distinct()


def similar_groups(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of each row of ``docs`` (doc_id, text).

    Two documents are linked when their sets of distinct ``words``-word shingles have a
    Jaccard similarity of ``percent`` or more; a component is what links connect, named by
    its least ``doc_id``. Shingles are of the words ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower
    case; a text of fewer words is one shingle; one without words (or null) has none and is
    linked with nothing.

    1. One pass makes a digest of each set, so that equal sets become one representative
       however many they are, and counts all shingles into a sketch of fixed size. Its
       frequency classes, rare first, and a hash for each order make the global orders.
    2. Each representative is compared with a few leaders, which ties groups of copies
       together without listing their pairs.
    3. Representatives in different components that share a prefix token under the first
       order are found by shuffles of prefix tokens; prefixes under the other orders then meet
       by pair, and the texts of those that share a token under all are compared. Every pair of similar sets in different components is
       among them, so with the components of step 2 no link is lost.

    Rows with a null ``doc_id`` get their size, and the component of documents with an equal
    set if there are any, else null. Rows that repeat a ``doc_id`` are the same document: what
    links to one of them links to all. An empty table gives no rows; other columns are
    ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    each, counts = _summaries(rows, words)
    table = _classes(counts)
    classes = spark.sparkContext.broadcast(table)
    anchors = [F.first(f"a{i}").alias(f"a{i}") for i in range(ANCHORS)]
    sets = each.where("n > 0").groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("rep"), *anchors)
    sets = stored(sets, "shingle-sets")
    known = sets.where("rep is not null")
    first = stored(verified(rows, stored(_leader_pairs(known, percent), "leader-pairs"), classes, words, percent), "leader-links")
    # Documents that repeat an id with other texts have several sets and one component.
    start = stored(components(first), "first-components")
    reps = known.select("rep").distinct()
    groups = reps.join(start, F.col("rep") == F.col("node"), "left").select(
        "rep", F.coalesce("component", "rep").alias("comp")
    )
    groups = stored(groups, "groups")
    total = known.agg(F.sum(F.expr(f"n - ceil(n * {percent} / 100) + 1"))).first()[0] or 0
    windows = int(total) // WINDOW_TOKENS + 1
    prefixes = stored(_prefixes(rows, classes, words, percent, windows), "prefixes")
    pairs = stored(candidate_pairs(prefixes, groups, windows, percent), "candidates")
    pairs = stored(sharing_all_prefixes(rows, pairs, classes, words, percent), "agreed")
    second = verified(rows, pairs, classes, words, percent)
    by_group = groups.select(F.col("rep").alias("node"), "comp")
    contracted = (
        second.join(by_group, F.col("a") == F.col("node")).select("b", F.col("comp").alias("ca"))
        .join(by_group, F.col("b") == F.col("node")).select(F.col("ca").alias("a"), F.col("comp").alias("b"))
    )
    merged = stored(components(contracted), "second-components")
    final = groups.join(merged, F.col("comp") == F.col("node"), "left").select(
        "rep", F.coalesce("component", "comp").alias("component_id")
    )
    named = known.select("n", "d1", "d2", "rep").join(stored(final, "final"), "rep")
    named = stored(named.select("n", "d1", "d2", "component_id"), "named-sets")
    found = each.join(named, ["n", "d1", "d2"], "left")
    alone = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), alone.alias("component_id"))


def one_of_each(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` whose ``doc_id`` names their component, with all columns: one
    document of each group. Of rows that repeat that id the one with the least text stays;
    rows with a null id stay."""
    groups = similar_groups(docs, words, percent)
    stays, copy = fresh(docs, "stays", "copy")
    stay = groups.where("doc_id = component_id").select(F.col("doc_id").alias(stays)).distinct()
    stay = stored(stay, "stays")
    kept = docs.join(stay, F.col("doc_id").cast("bigint") == F.col(stays)).drop(stays)
    order = Window.partitionBy("doc_id").orderBy("text")
    kept = kept.withColumn(copy, F.row_number().over(order)).where(F.col(copy) == 1).drop(copy)
    return kept.unionByName(docs.where("doc_id is null"))

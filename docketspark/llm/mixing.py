"""Mixing sources to target weights by exponential sampling keys.

Every document gets the key ``-ln(u) / weight`` with ``u`` from a hash of its id: taking
documents by ascending key is weighted sampling without replacement. A source takes all
its documents as often as its budget allows, then documents by ascending key up to the
words that are left. Sorting and running sums are spread over ranges of (source, key), so
no source, however large, is one task's work.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketspark.llm.common import fresh, shuffle_parts, stored

SOURCE_WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
SEED = "mix-1"
# A range of sorted rows holds about so many.
RANGE_ROWS = 1_000_000
_ROW_BITS = 33  # of monotonically_increasing_id: the row's place in its partition
_PLAN = ("size", "source_size", "target", "epochs", "part_words", "taken")


def n_words(text: Column) -> Column:
    """Runs of signs other than blanks and line ends; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def sampling_key(doc_id: Column, weight: Column | None = None, seed: str = SEED) -> Column:
    """An exponential variable with the rate ``weight``, the same on every run.

    A null weight counts as 1. Documents without a positive weight come after all others.
    Rows of one id share their ``u``; null ids are one id.
    """
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    bits = F.conv(F.substring(F.md5(named), 1, 13), 16, 10).cast("double")
    u = (bits + 0.5) / F.lit(float(1 << 52))
    rate = F.coalesce(weight.cast("double"), F.lit(1.0)) if weight is not None else F.lit(1.0)
    return F.when(rate > 0, -F.log(u) / rate).otherwise(F.lit(float("inf")))


def _sorted(rows: DataFrame, n: int, *order: Column) -> DataFrame:
    """Rows in ranges of ``order`` with ``part``, the number of their range, and ``place`` in it."""
    ranged = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    found = stored(ranged.withColumn("_at", F.monotonically_increasing_id()), "mix-sorted")
    place = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return found.withColumns({"part": F.shiftright("_at", _ROW_BITS), "place": place}).drop("_at")


def source_targets(
    sizes: DataFrame,
    weights: tuple[int, ...] = SOURCE_WEIGHTS,
    share: float = 1.0,
    most_epochs: int = MOST_EPOCHS,
) -> DataFrame:
    """``source, source_size, n_docs, weight, target, budget, epochs, rest`` of each source.

    ``sizes`` has the columns ``source`` and ``size``. Sources by code point, null last, take
    the weights in turn and share ``share`` of all sizes. A target stops at ``most_epochs``
    times its source's size, and what is over goes to the others by weight until none is
    above. ``budget`` is the target in whole words: ``epochs`` times all documents, and
    ``rest`` words more. Each round is one sum over the sources, and two numbers are all that
    comes to the driver.
    """
    totals = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs")
    )
    ordered = _sorted(totals, shuffle_parts(sizes), F.col("source").asc_nulls_last())
    counts = ordered.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # a row per range
    before = counts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    turn = (F.col("before") + F.col("place")) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("bigint")
    known = ordered.join(before, "part").withColumn("weight", weight)
    known = stored(known.drop("part", "place", "n", "before"), "mix-sources")

    def whole(column: Column) -> Column:
        return column.cast("decimal(38,0)")

    cap = F.col("source_size") * most_epochs
    sums = known.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    total = round(Fraction(share) * (sums.size or 0))
    left, free = total, sums.weight or 0
    while free:
        above = whole(cap) * F.lit(free) < whole(F.col("weight")) * F.lit(left)
        found = known.agg(
            F.sum(F.when(above, cap).otherwise(0)).alias("capped"),
            F.sum(F.when(above, 0).otherwise(F.col("weight"))).alias("free"),
        ).first()
        if (total - found.capped, found.free) == (left, free):
            break
        left, free = total - found.capped, found.free
    shared = F.col("weight") * F.lit(float(left)) / F.lit(float(free or 1))
    above = whole(cap) * F.lit(free) < whole(F.col("weight")) * F.lit(left)
    target = F.when(above | F.lit(not free), cap.cast("double")).otherwise(shared)
    budget = F.least(F.round(target).cast("bigint"), cap)
    epochs = F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(F.lit(0))
    found = known.withColumn("target", target).withColumn("budget", budget)
    found = found.withColumn("epochs", epochs.cast("bigint"))
    return found.withColumn("rest", F.col("budget") - F.col("epochs") * F.col("source_size"))


def _cuts(keyed: DataFrame, sources: DataFrame) -> DataFrame:
    """``source, cut_key, cut_rest, cut_size``: the key at which a source's rest is reached,
    the words left there, and the words of all rows with that key."""
    parted = sources.where("rest > 0")
    n_rows = parted.agg(F.sum("n_docs")).first()[0] or 0
    n = max(shuffle_parts(keyed), -(-n_rows // RANGE_ROWS))
    rows = keyed.where("size > 0").alias("k").join(
        parted.select(F.col("source").alias("own"), "rest"), F.col("k.source").eqNullSafe(F.col("own"))
    )
    ranged = _sorted(rows.select("source", "key", "size", "rest"), n, F.col("source"), F.col("key"))
    sums = ranged.groupBy("source", "part", "rest").agg(F.sum("size").alias("n"))
    running = F.sum("n").over(Window.partitionBy("source").orderBy("part"))  # a row per range
    reached = sums.withColumn("before", running - F.col("n")).where("before < rest and rest <= before + n")
    reached = reached.select(F.col("source").alias("own"), F.col("part").alias("own_part"), "before")
    same = F.col("r.source").eqNullSafe(F.col("own")) & (F.col("r.part") == F.col("own_part"))
    there = ranged.alias("r").join(reached, same)
    by_key = there.groupBy("source", "rest", "before", "key").agg(F.sum("size").alias("cut_size"))
    running = F.sum("cut_size").over(Window.partitionBy("source").orderBy("key"))
    at = by_key.withColumn("before", F.col("before") + running - F.col("cut_size"))
    at = at.where("before < rest and rest <= before + cut_size")
    return at.select("source", F.col("key").alias("cut_key"), (F.col("rest") - F.col("before")).alias("cut_rest"), "cut_size")


def plan_mix(
    keyed: DataFrame,
    weights: tuple[int, ...] = SOURCE_WEIGHTS,
    share: float = 1.0,
    most_epochs: int = MOST_EPOCHS,
) -> DataFrame:
    """``keyed`` (``source, size, key`` and more) with what the mix takes of each row.

    Adds ``source_size, target, epochs`` (whole passes), ``part_words`` (words of the row, from
    its start, in the pass after them) and ``taken``, the words in all. The one document where
    the budget ends is cut, so a source's words are its target to the word. Rows whose keys are
    equal there, such as repeated rows, share what is left in proportion to their sizes.

    Null sources are a source; a source without words takes none; an empty table gives no
    rows. Columns of ``keyed`` with the names that are added are replaced.
    """
    keyed = keyed.select(*[c for c in keyed.columns if c.lower() not in _PLAN[1:]])
    sources = stored(source_targets(keyed.select("source", "size"), weights, share, most_epochs), "mix-targets")
    cuts = _cuts(keyed.select("source", "size", "key"), sources)
    own, cut = (fresh(keyed, f"{side}_source")[0] for side in ("own", "cut"))
    cuts = cuts.withColumnRenamed("source", cut)
    table = sources.join(cuts, F.col("source").eqNullSafe(F.col(cut)), "left")
    table = table.select(
        F.col("source").alias(own), "source_size", "target", "epochs", "cut_key", "cut_rest", "cut_size"
    )
    table = stored(table, "mix-cuts")
    joined = keyed.alias("k").join(table.alias("t"), F.col("k.source").eqNullSafe(F.col(f"t.{own}")))
    size, key = F.col("k.size"), F.col("k.key")
    shared = F.expr("cast(cast(k.size as decimal(19,0)) * cast(t.cut_rest as decimal(19,0)) div t.cut_size as bigint)")
    part = F.when(key < F.col("t.cut_key"), size).when(key == F.col("t.cut_key"), shared)
    part = F.coalesce(part, F.lit(0).cast("bigint"))
    return joined.select(
        "k.*", "t.source_size", "t.target", "t.epochs", part.alias("part_words"),
        (F.col("t.epochs") * size + part).alias("taken"),
    )


def keyed_documents(
    docs: DataFrame, weight: DataFrame | None = None, source: str = "source", text: str = "text"
) -> DataFrame:
    """``doc_id, source, size, key``: what the plan needs of documents, without their texts.

    ``weight`` (``doc_id, weight``, one row an id) scales the keys; ids without one count as 1.
    """
    rows = docs.select("doc_id", F.col(source).alias("source"), n_words(F.col(text)).alias("size"))
    if weight is None:
        return rows.withColumn("key", sampling_key(F.col("doc_id")))
    found = rows.join(weight.select("doc_id", "weight"), "doc_id", "left")
    return found.withColumn("key", sampling_key(F.col("doc_id"), F.col("weight"))).drop("weight")


def mixed_texts(docs: DataFrame, text: str = "text", **plan) -> DataFrame:
    """The mix itself: rows of ``docs`` with ``epoch`` (from 0), once for each pass that takes
    them, all complete passes of a source before its fractional one; there the text ends
    with the last word taken. ``docs`` needs ``doc_id`` and ``source``; a column ``weight``,
    where there is one, scales the keys. Documents without words are in no pass.
    """
    names = [c for c in docs.columns if c.lower() not in (*_PLAN, "key", "epoch")]
    weight = F.col("weight") if "weight" in names else None
    keyed = docs.select(*names).withColumns(
        {"size": n_words(F.col(text)), "key": sampling_key(F.col("doc_id"), weight)}
    )
    planned = plan_mix(keyed, **plan)
    passes = F.col("epochs").cast("int") + F.when(F.col("part_words") > 0, 1).otherwise(0)
    planned = planned.where((F.col("size") > 0) & (passes > 0))
    planned = planned.withColumn("epoch", F.explode(F.sequence(F.lit(0), passes - 1)))
    words = F.regexp_extract_all(F.col(text), F.lit(r"[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++"), F.lit(0))
    head = F.array_join(F.slice(words, F.lit(1), F.col("part_words").cast("int")), "")
    cut = (F.col("epoch") == F.col("epochs")) & (F.col("part_words") < F.col("size"))
    return planned.withColumn(text, F.when(cut, head).otherwise(F.col(text))).select(*names, "epoch")

"""Lines that many pages of one site share, and passages repeated across the corpus, by
DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketspark.llm.common import fresh, stored

# A line goes when the pages of its site that hold it, less those that may share it by
# chance, are more than this share of the site: one formula for sites of any size.
MAX_SHARE = 0.02
CHANCE_PAGES = 2
# A line of more than this many words does not repeat by chance: on this many documents of
# the corpus, of whatever sites, it is a passage, and one document keeps it.
LONG_WORDS = 50
PASSAGE_DOCS = 10


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _key(line: Column) -> Column:
    """128 bits that stand for a line without the blanks around it."""
    bare = F.trim(line)
    return F.struct(F.xxhash64(bare).alias("a"), F.xxhash64(F.lit("line"), bare).alias("b"))


def _is_long(line: Column) -> Column:
    over = F.regexp_count(line, F.lit(r"[^\x20\x09-\x0D]+")) > LONG_WORDS
    return (F.length(line) > 2 * LONG_WORDS) & over  # the length spares most lines the count


def site_line_counts(docs: DataFrame, host: Column, text: str = "text") -> DataFrame:
    """``host, line`` (its key) and the pages of the host that contain it, each page once."""
    bare = F.filter(_lines(F.col(text)), lambda x: F.trim(x) != "")
    keys = F.array_distinct(F.transform(bare, _key))
    rows = docs.select(host.alias("host"), F.explode(keys).alias("line")).where("host is not null")
    return rows.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n_pages"))


def boilerplate(
    docs: DataFrame, host: Column, text: str = "text", max_share: float = MAX_SHARE
) -> DataFrame:
    """``host, lines``: the keys of each site's lines that go.

    Counts are pre-aggregated before the shuffle, so neither a hot site nor a hot line
    gathers in a task. A site's list has at most its mean number of lines per page over
    ``max_share`` entries, however many pages it has.
    """
    counts = site_line_counts(docs, host, text).where(F.col("n_pages") > CHANCE_PAGES)
    totals = docs.groupBy(host.alias("host")).agg(F.count(F.lit(1)).alias("total"))
    shared = counts.join(totals.where(F.col("total") > CHANCE_PAGES), "host")
    frequent = shared.where(F.col("n_pages") - CHANCE_PAGES > F.lit(max_share) * F.col("total"))
    return frequent.groupBy("host").agg(F.sort_array(F.collect_list("line")).alias("lines"))


def passage_hits(docs: DataFrame, doc_id: str, text: str, passage_docs: int) -> DataFrame:
    """``id, page, passages``: the keys of the passages that each document loses.

    Long lines alone are moved. A passage is kept by the document of the least id (rows
    without an id keep none, unless all are without). Equal rows lose the same lines.
    """
    keys = F.array_distinct(F.transform(F.filter(_lines(F.col(text)), _is_long), _key))
    rows = docs.select(
        F.col(doc_id).alias("id"), F.xxhash64(text).alias("page"), F.explode(keys).alias("line")
    )
    lines = rows.groupBy("line").agg(F.count(F.lit(1)).alias("n_docs"), F.min("id").alias("keeper"))
    passages = stored(lines.where(F.col("n_docs") >= passage_docs).drop("n_docs"), "passages")
    met = rows.join(passages, "line").where("keeper is not null and not (id <=> keeper)")
    return met.groupBy("id", "page").agg(F.collect_set("line").alias("passages"))


def drop_boilerplate(
    docs: DataFrame,
    host: Column,
    text: str = "text",
    doc_id: str = "doc_id",
    max_share: float = MAX_SHARE,
    passage_docs: int = PASSAGE_DOCS,
) -> DataFrame:
    """``docs`` with ``text`` freed of its site's boilerplate and of passages that stand
    elsewhere, plus ``n_lines, n_dropped``.

    Lines are compared without the blanks around them and kept as they are; lines of
    blanks only are never dropped. A line goes from a site when ``n_pages - CHANCE_PAGES``
    is more than ``max_share`` of its pages. A line of over ``LONG_WORDS`` words on
    ``passage_docs`` documents of the corpus or more goes from all but that of the least id.

    The list of each site, and the passages that documents lose, are written to the shared
    folder first, so the joins know their sizes: small ones are broadcast by Spark, else hot
    sites are split by the adaptive skew join.

    A null text stays null, without lines; rows with a null host lose passages only; every
    row counts as a page and as a document, repeated ones too; an empty table gives no rows.
    Columns of ``docs`` named ``n_lines`` or ``n_dropped`` are replaced.
    """
    names = [n for n in docs.columns if n.lower() not in ("n_lines", "n_dropped")]
    site, own_site, gone, kept, own_id, own_page, lost = fresh(
        docs, "site", "site_of_lines", "lines_gone", "lines_kept", "id_of_page", "page", "passages_lost"
    )
    listed = stored(boilerplate(docs, host, text, max_share), "boilerplate")
    listed = listed.select(F.col("host").alias(own_site), F.col("lines").alias(gone))
    hits = stored(passage_hits(docs, doc_id, text, passage_docs), "passages-lost")
    hits = hits.select(
        F.col("id").alias(own_id), F.col("page").alias(own_page), F.col("passages").alias(lost)
    )
    joined = docs.withColumn(site, host).join(listed, F.col(site) == F.col(own_site), "left")
    here = (F.xxhash64(text) == F.col(own_page)) & F.col(doc_id).eqNullSafe(F.col(own_id))
    joined = joined.join(hits, here, "left")
    lines = _lines(F.col(text))

    def goes(line: Column) -> Column:
        listed_here = F.coalesce(F.array_contains(gone, _key(line)), F.lit(False))
        lost_here = F.coalesce(F.array_contains(lost, _key(line)), F.lit(False))
        return (F.trim(line) != "") & (listed_here | lost_here)

    left = F.filter(lines, lambda x: ~goes(x))
    left = F.when(F.col(gone).isNull() & F.col(lost).isNull(), lines).otherwise(left)
    n_lines = F.when(F.col(text).isNull(), 0).otherwise(F.size(lines)).cast("bigint")
    n_left = F.when(F.col(text).isNull(), 0).otherwise(F.size(kept)).cast("bigint")
    found = joined.withColumn(kept, left).withColumns(
        {"n_lines": n_lines, "n_dropped": n_lines - n_left}
    )
    text_left = F.when(F.col("n_dropped") == 0, F.col(text)).otherwise(F.array_join(kept, "\n"))
    return found.withColumn(text, text_left).select(*names, "n_lines", "n_dropped")

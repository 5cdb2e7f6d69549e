"""Filings outside a company's recent block: older blocks in documents of their own.

A company's main document names its older blocks (``filings.files``). A block holds the
same parallel arrays, and neither its company nor anything else. Companies are put together
from both, and what does not fit together is reported.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketspark.functions.identifiers import file_name
from docketspark.schemas import RECENT_FIELDS, SUBMISSION
from docketspark.sources.submissions import explode_submissions, with_company_key

BLOCK = SUBMISSION["filings"].dataType["recent"].dataType
NAMED_BLOCK = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("filingCount", T.LongType()),
        T.StructField("filingFrom", T.StringType()),
        T.StructField("filingTo", T.StringType()),
    ]
)
_FILINGS = T.StructType(
    [T.StructField("recent", BLOCK), T.StructField("files", T.ArrayType(NAMED_BLOCK))]
)
MAIN = T.StructType([T.StructField("cik", T.StringType()), T.StructField("filings", _FILINGS)])


def parse_main(docs: DataFrame, text: str = "v", name: str | None = None) -> DataFrame:
    """Main documents as ``cik, filings, name``, with the blocks they name."""
    source = F.col(name) if name else F.lit(None).cast("string")
    parsed = docs.select(F.from_json(F.col(text), MAIN).alias("d"), source.alias("_name"))
    return with_company_key(parsed.select("d.*", "_name"), F.col("_name"))


def parse_blocks(docs: DataFrame, name: str, text: str = "v") -> DataFrame:
    """Block documents as ``block`` (the last part of their name) and ``filings``; text that
    is no block has null ``filings``."""
    return docs.select(file_name(name).alias("block"), F.from_json(F.col(text), BLOCK).alias("filings"))


def named_blocks(main: DataFrame) -> DataFrame:
    """``cik, block, n_filings`` of the older blocks that main documents name."""
    # The outer form, so that no test for emptiness is pushed below the parsing.
    rows = main.select("cik", F.explode_outer("filings.files").alias("f")).where("f.name is not null")
    return rows.select("cik", file_name("f.name").alias("block"), F.col("f.filingCount").alias("n_filings")).distinct()


def _sound() -> Column:
    arrays = [F.col(f"filings.{name}") for name in RECENT_FIELDS]
    same = [F.size(arrays[0]) == F.size(other) for other in arrays[1:]]
    return F.coalesce(reduce(lambda a, b: a & b, same), F.lit(False))


def older_filings(main: DataFrame, blocks: DataFrame) -> DataFrame:
    """The filings of the named blocks, as ``explode_submissions`` gives those of the recent
    one; places (``pos``) count within a block. A block is moved whole, by its name."""
    named = named_blocks(main).select("cik", "block")
    docs = named.join(blocks.where(_sound()), "block")
    as_recent = docs.select("cik", F.struct(F.col("filings").alias("recent")).alias("filings"))
    return explode_submissions(as_recent)


def all_filings(main: DataFrame, blocks: DataFrame) -> DataFrame:
    """A company's whole catalog, each filing once: while filings move from the recent block
    to older ones, one that is in both is taken from the recent one."""
    recent = explode_submissions(main).withColumn("older", F.lit(False))
    rows = recent.unionByName(older_filings(main, blocks).withColumn("older", F.lit(True)))
    columns = [c for c in recent.columns if c not in ("cik", "accession_number", "main_file_name")]
    first = F.min(F.struct("older", "pos", *[c for c in columns if c not in ("older", "pos")])).alias("f")
    once = rows.groupBy("cik", "accession_number", "main_file_name").agg(first)
    return once.select("cik", "accession_number", "main_file_name", "f.*").select(*recent.columns)


def block_report(main: DataFrame, blocks: DataFrame) -> DataFrame:
    """``cik, block, reason`` of blocks that are named and missing, present and not named, no
    well-formed block, or of another length than the main document says."""
    present = blocks.select("block", F.when(_sound(), F.size("filings.form")).alias("_size"), F.lit(True).alias("_here"))
    met = named_blocks(main).withColumn("_named", F.lit(True)).join(present, "block", "full")
    reason = (
        F.when(F.col("_here").isNull(), "named and missing")
        .when(F.col("_named").isNull(), "present and not named")
        .when(F.col("_size").isNull(), "no well-formed block")
        .when(F.col("_size") != F.col("n_filings"), "another number of filings than named")
    )
    return met.select("cik", "block", reason.alias("reason")).where("reason is not null")

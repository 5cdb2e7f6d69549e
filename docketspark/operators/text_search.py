"""Text search over the positional index; no text is read."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PLAIN = re.compile(r"[^\W_]+")


def parsed(query: str) -> list[list[str]]:
    """The phrases of a query: quoted ones, and words, each a list of words in lower case.

    A word with signs inside, such as ``10-K``, is a phrase of its parts, as in the texts.
    """
    parts = [phrase or word for phrase, word in re.findall(r'"([^"]*)"|([^\s"]+)', query)]
    phrases = [_PLAIN.findall(part.lower()) for part in parts]
    unique = dict.fromkeys(tuple(p) for p in phrases if p)
    return [list(p) for p in unique]


def _starts(phrase: list[str]) -> Column:
    """Where a phrase begins: the places of its words, each moved back by its number, that
    all of them share."""

    def moved(number: int, word: str) -> Column:
        return F.transform(F.col("_places")[word], lambda place: place - number)

    return reduce(F.array_intersect, [moved(i, word) for i, word in enumerate(phrase)])


def search(postings: DataFrame, query: str) -> DataFrame:
    """``doc_id, n_matches`` of the documents that hold all words and phrases of a query.

    ``n_matches`` counts the places where its words and phrases begin. Only the postings of
    the query's words are read, and a document gathers one row a word, so a frequent word
    is no larger piece of work than a rare one. A query without words finds nothing.
    """
    phrases = parsed(query)
    terms = sorted({word for phrase in phrases for word in phrase})
    if not terms:
        return postings.sparkSession.createDataFrame([], "doc_id bigint, n_matches bigint")
    found = postings.where(F.col("term").isin(terms))
    entry = F.struct("term", "places")
    held = found.groupBy("doc_id").agg(F.collect_list(entry).alias("_entries"))
    held = held.where(F.size("_entries") == len(terms))
    held = held.select("doc_id", F.map_from_entries("_entries").alias("_places"))
    starts = [_starts(phrase).alias(f"_{i}") for i, phrase in enumerate(phrases)]
    counted = held.select("doc_id", *starts)
    sizes = [F.size(f"_{i}") for i in range(len(phrases))]
    everywhere = reduce(lambda a, b: a & b, [size > 0 for size in sizes])
    total = reduce(lambda a, b: a + b, sizes).cast("bigint")
    return counted.where(everywhere).select("doc_id", total.alias("n_matches"))

"""Substring search by an index of trigrams, kept beside the history.

The index holds for each trigram and bucket of 32,768 documents a bitmap of those whose folded text has it. A query's bitmaps are
intersected, and only documents that are left are read and tested for the text itself, so the result is that of a scan. An index of new
documents is merged into an old one by the union of bitmaps; documents whose text changed are then found by old and new trigrams, and the test decides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.functions.text import bound, fold
from tamiz.operators.archive import search_text

#: Characters of a piece of text that is indexed.
SIZE = 3


def trigrams(text: Column) -> Column:
    """The different runs of three characters."""
    return bound(F.split(text, ""), lambda c: F.array_distinct(F.transform(F.slice(c, F.lit(1), F.greatest(F.size(c) - (SIZE - 1), F.lit(0))), lambda x, i: F.concat(x, F.get(c, i + 1), F.get(c, i + 2)))))


def build(df: DataFrame, number: str) -> DataFrame:
    """(gram, bucket, bits) of publications with a dense ``number`` from 1."""
    rows = df.select(F.bitmap_bucket_number(F.col(number).cast("long")).alias("bucket"), F.bitmap_bit_position(F.col(number).cast("long")).alias("bit"), F.explode(trigrams(search_text(df))).alias("gram"))
    return rows.groupBy("gram", "bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))


def merge(index: DataFrame, more: DataFrame) -> DataFrame:
    """The index of both sets of documents."""
    return index.unionByName(more).groupBy("gram", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def candidates(df: DataFrame, index: DataFrame, number: str, query: str) -> DataFrame:
    """The publications that have all trigrams of the query; all of them for a query of fewer than three characters."""
    folded = df.sparkSession.range(1).select(fold(F.lit(query)).alias("q")).first().q
    wanted = sorted({folded[i : i + SIZE] for i in range(len(folded) - SIZE + 1)})
    if not wanted:
        return df
    met = index.filter(F.col("gram").isin(wanted)).groupBy("bucket").agg(F.count("*").alias("n"), F.bitmap_and_agg("bits").alias("bits")).filter(F.col("n") == len(wanted))
    bit = F.bitmap_bit_position(F.col(number).cast("long"))
    byte = F.conv(F.hex(F.substring(F.col("__bits"), (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    found = df.join(met.select(F.col("bucket").alias("__bucket"), F.col("bits").alias("__bits")), F.bitmap_bucket_number(F.col(number).cast("long")) == F.col("__bucket"))
    return found.filter((F.floor(byte / F.pow(F.lit(2), bit % 8)) % 2 == 1)).select(df.columns)


def search(df: DataFrame, index: DataFrame, number: str, query: str) -> DataFrame:
    """The publications whose folded text contains the folded query."""
    return candidates(df, index, number, query).filter(F.contains(search_text(df), fold(F.lit(query))))

"""Bounded filters of keys: a table of bits that is broadcast, so that most rows without a partner stay out of a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a bit table, at most: 16 MB at any number of keys.
FILTER_WORDS = 1 << 20


def bit_table(rows: DataFrame, key: str) -> DataFrame:
    """(word, bits): a filter of the keys, with one of 64 * FILTER_WORDS bits set for each."""
    place = F.pmod(F.xxhash64(key), F.lit(64 * FILTER_WORDS))
    return rows.select(F.shiftrightunsigned(place, 6).alias("word"), _bit(place).alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))


def thinned(rows: DataFrame, filter_: DataFrame, key: str, there: bool = True) -> DataFrame:
    """The rows whose key may be in a bit table, or those whose key is not. The table is broadcast: it is bounded."""
    place = F.pmod(F.xxhash64(key), F.lit(64 * FILTER_WORDS))
    named = F.broadcast(filter_.select(F.col("word").alias("_word"), F.col("bits").alias("_bits")))
    joined = rows.join(named, F.shiftrightunsigned(place, 6) == F.col("_word"), "inner" if there else "left")
    hit = F.coalesce(F.col("_bits").bitwiseAND(_bit(place)) != 0, F.lit(False))
    return joined.filter(hit if there else ~hit).drop("_word", "_bits")


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(place, F.lit(64)).cast("int"))

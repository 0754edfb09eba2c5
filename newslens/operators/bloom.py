"""Bloom filter in Spark expressions: two hashes into one array of 64-bit words.

A scalar subquery brings the array to every task, so a filter stays in the scan's stage: rows that it
drops are never shuffled. Its size is bounded.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslens.functions import text

BITS_EACH = 16  # for each key
LEAST_BITS, MOST_BITS = 1 << 10, 1 << 26


class Filter:
    """What surely is not among ``entries`` keys. It never grows beyond ``MOST_BITS``; fuller, it only lets more through."""

    def __init__(self, keys: DataFrame, entries: int):
        """Over the column ``key`` (xxhash64) of ``keys``."""
        self.bits = min(MOST_BITS, max(LEAST_BITS, 1 << max(0, BITS_EACH * entries - 1).bit_length()))
        places = keys.select(F.explode(F.array(*self._places(F.col("key")))).alias("place"))
        marked = places.select(F.expr("place div 64").alias("at"), F.expr("shiftleft(1L, cast(place % 64 as int))").alias("word"))
        empty = keys.sparkSession.range(self.bits // 64).select(F.col("id").alias("at"), F.lit(0).cast("bigint").alias("word"))
        words = marked.unionByName(empty).groupBy("at").agg(F.bit_or("word").alias("word"))
        self.words = words.agg(F.sort_array(F.collect_list(F.struct("at", "word")))["word"].alias("words"))

    def _places(self, key: Column) -> list[Column]:
        return [F.pmod(key, F.lit(self.bits)), F.pmod(F.shiftrightunsigned(key, 32), F.lit(self.bits))]

    def may_hold(self, words: Column, key: Column) -> Column:
        def bit(place: Column) -> Column:
            word = F.get(words, F.floor(place / 64).cast("int"))
            return F.getbit(word, F.pmod(place, F.lit(64)).cast("int")) == 1

        # the key once, as it may be dear: a filter does not share parts of its condition
        return text.held(key, lambda k: reduce(and_, map(bit, self._places(k))))

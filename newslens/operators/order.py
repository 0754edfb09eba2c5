"""Ranks and shares over a whole table of any length, without a window over all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newslens.sources.workspace import written

_PER_PART = 33  # bits that ``monotonically_increasing_id`` leaves to the place within a partition


def global_rank(df: DataFrame, *order: Column | str, name: str = "rank", partitions: int | None = None) -> DataFrame:
    """``df`` with ``name``: the place of each row in the order, from 1, as ``row_number`` over all rows.

    Rows are dealt by ranges and sorted within them, and written with their place; a row's rank is its
    place plus the sizes of the ranges before, of which there is a small table. The order should be total:
    rows that it leaves equal lie in one range, so one value of the whole order should not hold most rows.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    # a table of its own: ranges are drawn from a sample, so a second run could cut otherwise
    placed = written(dealt.withColumn("_place", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("_place", _PER_PART)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    ranked = placed.withColumn("_part", part).join(F.broadcast(starts), "_part")
    at = F.col("_place").bitwiseAND(F.lit((1 << _PER_PART) - 1))
    return ranked.withColumn(name, F.col("_start") + at + 1).select(*df.columns, name)


def with_share(df: DataFrame, value: str, name: str = "share", by: Sequence[str] = ()) -> DataFrame:
    """``df`` with each row's part of the sum of ``value``, null where that sum is zero.

    ``df`` is written and read twice, so that it is not computed again for the sum.
    """
    stored = written(df, "shared")
    if by:
        total = stored.groupBy(*by).agg(F.sum(value).alias("_total"))
        found = stored.join(total, list(by))
    else:
        found = stored.withColumn("_total", stored.agg(F.sum(value).alias("_total")).scalar())
    return found.withColumn(name, F.try_divide(F.col(value), F.col("_total"))).drop("_total")

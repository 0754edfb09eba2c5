"""Joins in which one key may hold any share of the rows, planned for from the start.

Spark's own skew splitting needs a sort-merge join whose partitions it may split; this needs neither. Frequent
keys are found in one pass with a bounded sketch. Their rows are dealt over ``deals`` salts; the other side's rows of
these keys are copied to each salt. Rows of other keys are joined as always.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hot_keys(df: DataFrame, on: Sequence[str], share: float = 0.01) -> list[int]:
    """Hashes of all keys with over ``share`` of the rows, and perhaps some others; at most ``1 / share`` a task merge."""
    found = df.select(F.xxhash64(*on).alias("key")).freqItems(["key"], share).first()
    return sorted(found[0] or []) if found else []


def salted_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner", share: float = 0.01, deals: int = 32
) -> DataFrame:
    """``left.join(right, on, how)`` for ``inner``, ``left``, ``left_semi`` and ``left_anti``; ``left`` may be skewed.

    ``right`` should have few rows for each key, as they are copied ``deals`` times for frequent ones.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a copied right side does not allow a {how} join")
    on = list(on)
    hot = hot_keys(left, on, share)
    if not hot:
        return left.join(right, on, how)
    is_hot = F.xxhash64(*on).isin(hot)
    rest = [c for c in left.columns if c not in on]
    # by the rest of the row, so that a rerun deals alike; equal rows stay together only within a task's number
    salt = F.pmod(F.xxhash64(F.monotonically_increasing_id(), *rest), F.lit(deals)).cast("int")
    dealt = left.withColumn("_salt", F.when(is_hot, salt).otherwise(0))
    every = F.sequence(F.lit(0), F.lit(deals - 1))
    copied = right.withColumn("_salt", F.explode(F.when(is_hot, every).otherwise(F.array(F.lit(0)))))
    return dealt.join(copied, [*on, "_salt"], how).drop("_salt")

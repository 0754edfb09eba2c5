"""A query set against all rows in blocks, and checks of vectors that two operators share."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TASKS = 20_000  # of one stage at most; a task then takes several pairs


def whole_vector(vector: str | Column) -> Column:
    """True if the vector is there and each component is a finite number."""
    column = F.col(f"`{vector}`") if isinstance(vector, str) else vector
    # NaN is above all numbers
    finite = F.forall(column, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    return F.coalesce(finite, F.lit(False))


def block_of(n: int, *columns: str) -> Column:
    """One of ``n`` blocks by a hash of the columns: even, as rows that agree in all of them come once."""
    return F.pmod(F.xxhash64(*columns), F.lit(n)).cast("int")


def block_count(rows: int, size: int) -> int:
    return max(1, -(-rows // size))


def each_with_each(
    left: DataFrame, left_blocks: int, right: DataFrame, right_blocks: int,
    step: Callable, schema: str, left_key: Sequence[str], right_key: Sequence[str],
) -> DataFrame:
    """``step(left block, right block)`` on Arrow tables, once for each pair of blocks.

    A left row is sent once for each right block and the other way round, so memory is two blocks a task
    and what is shuffled falls with the block sizes. Pairs of rows exist only within ``step``.
    """
    left = left.withColumn("_l", block_of(left_blocks, *left_key)).withColumn(
        "_r", F.explode(F.sequence(F.lit(0), F.lit(right_blocks - 1)))
    )
    right = right.withColumn("_r", block_of(right_blocks, *right_key)).withColumn(
        "_l", F.explode(F.sequence(F.lit(0), F.lit(left_blocks - 1)))
    )
    # few bytes, much work: one task for each pair, not as many as fill a partition
    tasks = min(left_blocks * right_blocks, TASKS)
    left, right = (side.repartition(tasks, "_l", "_r").groupBy("_l", "_r") for side in (left, right))
    return left.cogroup(right).applyInArrow(step, schema)

"""The confidence index at every day, from counts that texts are read for once.

A cube holds how many sentences with each label named each entity at each time: rows (entity, label, day, at, n),
and for each day a row without an entity whose ``at`` is the newest time of any dated article. Cubes of
disjoint articles merge by adding up, so new articles are counted alone and merged with what is stored.

The index of a day stands at its newest article: the windows reach 30 and 60 days back from that
time, to the second. Whole days are summed by window frames over days; the two days that an edge of the windows cuts are
split by time in an equi-join of the cells with the days. So each cell is read three times, whatever
the number of days, and no text is read again.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newslens.functions.sentiment import NEUTRAL, Lexicon, Model
from newslens.operators import clean, mentions
from newslens.plans.confidence import WEIGHTS, scores
from newslens.rules import EntityPattern

CUBE = "entity string, label string, day date, at timestamp_ntz, n bigint"


def cube(articles: DataFrame, patterns: Sequence[EntityPattern] | DataFrame, scorer: Lexicon | Model) -> DataFrame:
    """(entity, label, day, at, n) of the articles."""
    dated = clean.dated(articles)
    rows = mentions.naming_sentences(dated, patterns, F.col("published_date").alias("at"))
    rows = rows.withColumn("label", scorer.score(F.col("sentence"))["label"])
    cells = mentions.per_entity(rows, "label", F.to_date("at").alias("day"), "at", F.lit(1).cast("bigint").alias("n"))
    newest = dated.select(F.to_date("published_date").alias("day"), F.col("published_date").alias("at"))
    newest = newest.groupBy("day").agg(F.max("at").alias("at"))
    none = F.lit(None).cast("string")
    newest = newest.select(none.alias("entity"), none.alias("label"), "day", "at", F.lit(0).cast("bigint").alias("n"))
    return _added(cells).unionByName(newest)


def merge(*cubes: DataFrame) -> DataFrame:
    """The cube of all their articles."""
    return _added(reduce(DataFrame.unionByName, cubes))


def _added(cells: DataFrame) -> DataFrame:
    return cells.groupBy("entity", "label", "day", "at").agg(F.sum("n").alias("n"))


def counts_by_day(cells: DataFrame, entities: Sequence[str] = (), days: int = 30) -> DataFrame:
    """(date, entity, label, n, recent, previous): for each day with a dated article, the counts up to it and in its windows.

    ``entities`` adds names that may not be in the cube.
    """
    anchors = cells.filter("entity IS NULL").groupBy("day").agg(F.max("at").alias("anchor"))
    cells = cells.filter("entity IS NOT NULL")

    # the two days that the windows' edges cut, told apart by time
    def cut(back: int) -> DataFrame:
        shifted = anchors.select(F.col("day").alias("date"), F.date_sub("day", back).alias("day"), (F.col("anchor") - F.expr(f"INTERVAL {back} DAYS")).alias("edge"))
        return cells.join(shifted, "day").withColumn("inside", F.col("at") >= F.col("edge"))

    zero = F.lit(0).cast("bigint")
    near, far = cut(days), cut(2 * days)
    edges = [
        near.select("entity", "label", "date", zero.alias("n"), F.when(F.col("inside"), F.col("n")).otherwise(0).alias("recent"),
                    F.when(F.col("inside"), 0).otherwise(F.col("n")).alias("previous")),
        far.filter("inside").select("entity", "label", "date", zero.alias("n"), zero.alias("recent"), F.col("n").alias("previous")),
    ]
    # every entity and label at every day, from the list of days as one value
    listed = anchors.agg(F.sort_array(F.collect_list("day")).alias("days")).scalar()
    pairs = cells.select("entity", "label").distinct()
    if entities:
        known = cells.sparkSession.range(0, 1, numPartitions=1).select(
            F.explode(F.array(*map(F.lit, entities))).alias("entity"), F.lit(NEUTRAL).alias("label")
        )
        pairs = pairs.unionByName(known).distinct()
    grid = pairs.withColumn("days", listed).select(
        "entity", "label", F.explode("days").alias("date"), zero.alias("n"), zero.alias("recent"), zero.alias("previous")
    )
    whole = cells.select("entity", "label", F.col("day").alias("date"), "n", zero.alias("recent"), zero.alias("previous"))
    by_day = reduce(DataFrame.unionByName, [whole, grid, *edges]).groupBy("entity", "label", "date").agg(
        *[F.sum(c).alias(c) for c in ("n", "recent", "previous")]
    )
    order = Window.partitionBy("entity", "label").orderBy(F.unix_date("date"))

    def within(first: int, last: int):
        return F.coalesce(F.sum("n").over(order.rangeBetween(first, last)), zero)

    return by_day.select(
        "date", "entity", "label",
        F.sum("n").over(order.rangeBetween(Window.unboundedPreceding, 0)).alias("n"),
        (within(1 - days, 0) + F.col("recent")).alias("recent"),
        (within(1 - 2 * days, -1 - days) + F.col("previous")).alias("previous"),
    )


def index_by_day(
    cells: DataFrame, weights: tuple[float, float, float] = WEIGHTS, entities: Sequence[str] = (), days: int = 30
) -> DataFrame:
    """The confidence index of every day: (date, entity, scores...), shares among the entities of the cube and ``entities``."""
    return scores(counts_by_day(cells, entities, days), weights, by=("date",))

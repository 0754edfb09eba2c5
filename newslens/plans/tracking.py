"""Mention counts per article and in total."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslens.functions import text
from newslens.operators import clean, mentions, terms
from newslens.rules import COUNT_RULES, CountRule


def track_mentions(
    articles: DataFrame, rules: Sequence[CountRule] | DataFrame = COUNT_RULES
) -> DataFrame:
    """Articles with their full text and mention counts, as a map and as columns.

    A projection: no shuffle, whatever the input's layout. Rules may be a table (entity, pattern, context): the
    map then holds the entities that are mentioned, and there are no columns (``expand_counts`` makes them).
    """
    if isinstance(rules, DataFrame):
        base = clean.no_null_text(articles).withColumn("full_text", text.full_text())
        found = terms.with_candidates(base, "full_text", rules, "_rules")
        counted = terms.counts(F.col("full_text"), F.col("_rules"))
        return found.select(*base.columns, counted.alias("entity_counts"))
    names = mentions.entities_of(rules)
    base = clean.no_null_text(articles).withColumn("full_text", text.full_text())
    counted = base.select(
        "*", *[c.alias(e) for e, c in mentions.count_columns(F.col("full_text"), rules).items()]
    )
    pairs = [part for e in names for part in (F.lit(e), F.col(e))]
    return counted.select(*base.columns, F.create_map(*pairs).alias("entity_counts"), *names)


def expand_counts(
    tracked: DataFrame, entities: Sequence[str], counts: str = "entity_counts"
) -> DataFrame:
    """One column per entity from the map; 0 where the map has no such key."""
    return tracked.select(
        *[c for c in tracked.columns if c not in entities],
        *[F.coalesce(F.col(counts)[e], F.lit(0)).alias(e) for e in entities],
    )


def mentioned_totals(tracked: DataFrame, counts: str = "entity_counts") -> DataFrame:
    """(entity, mentions) of all entities in the maps, of any number."""
    pairs = tracked.select(F.explode(counts).alias("entity", "n"))
    return pairs.groupBy("entity").agg(F.sum(F.col("n").cast("bigint")).alias("mentions"))


def mention_totals(tracked: DataFrame, entities: Sequence[str]) -> DataFrame:
    """(entity, mentions) over all articles."""
    sums = tracked.agg(
        *[F.coalesce(F.sum(F.col(e).cast("bigint")), F.lit(0)).alias(e) for e in entities]
    )
    return sums.unpivot([], list(entities), "entity", "mentions")

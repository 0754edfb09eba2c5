"""What-if weights, ranking, trend, daily counts and coverage ratios."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newslens.operators import clean, mentions
from newslens.rules import LEADER_VARIANTS, PARTY_LEADERS, PARTY_VARIANTS, Variants

RISING, DECLINING, STABLE = "Rising", "Declining", "Stable"
GAUGE_RANGE = (-0.5, 0.5)  # fixed values: the axis; scores may lie outside


def scenario(
    results: DataFrame,
    sentiment_weight: float = 0.4,
    volume_weight: float = 0.3,
    momentum_weight: float = 0.3,
    name: str = "entity",
) -> DataFrame:
    """Adds ``name`` and ``scenario_score`` under weights scaled to sum to one."""
    total = sentiment_weight + volume_weight + momentum_weight
    if total == 0:
        raise ValueError("the weights sum to zero")
    parts = {
        "sentiment_score": sentiment_weight / total,
        "volume_score": volume_weight / total,
        "momentum": momentum_weight / total,
    }
    s, v, m = (F.lit(weight) * F.col(column) for column, weight in parts.items())
    return clean.rounded(
        results.withColumns({"name": F.col(name), "scenario_score": s + v + m})
    )


def ranking(scenarios: DataFrame) -> DataFrame:
    """Best first, equal scores by name; ``rank`` carries the order.

    The table holds one row per entity, so ordering it as a whole is a small step.
    """
    order = (F.desc("scenario_score"), F.asc("name"))
    rank = F.row_number().over(Window.partitionBy().orderBy(*order))
    return scenarios.withColumn("rank", rank).orderBy("rank")


def trend(momentum: Column | str = "momentum") -> Column:
    m = F.col(momentum) if isinstance(momentum, str) else momentum
    return F.when(m > 0, RISING).when(m < 0, DECLINING).otherwise(STABLE)


def momentum_trend(scenarios: DataFrame) -> DataFrame:
    return scenarios.select("name", "momentum", trend().alias("trend"))


def gauges(scenarios: DataFrame) -> DataFrame:
    low, high = GAUGE_RANGE
    return scenarios.select(
        "name",
        F.col("scenario_score").alias("value"),
        F.lit(low).alias("axis_min"),
        F.lit(high).alias("axis_max"),
    )


def daily_mentions(
    articles: DataFrame,
    variants: Sequence[Variants],
    last_days: int | None = None,
    results: DataFrame | Sequence[str] | None = None,
) -> DataFrame:
    """(entity, date, mentions): articles per entity and day, days without any left out.

    All days by default; ``last_days`` keeps those up to that many before the newest.
    ``results`` (a result table, which has a row per entity, or names) narrows the entities to
    those it holds; a name without variants is an error, for a table when the job runs.
    """
    table = results if isinstance(results, DataFrame) else None
    if results is not None and table is None:
        variants = chosen(variants, results)
        if not variants:
            return articles.sparkSession.createDataFrame([], "entity string, date date, mentions long")
    dated = clean.with_day(clean.dated(articles))
    if last_days is not None:
        newest = dated.agg(F.max("date")).scalar()
        dated = dated.filter(F.col("date") >= F.date_sub(newest, last_days))
    names = mentions.entities_of(variants)
    per_day = (
        mentions.variant_flags(dated, variants, "date")
        .groupBy("date")
        .agg(*[F.count_if(F.col(n)).alias(n) for n in names])
    )
    rows = per_day.unpivot(["date"], names, "entity", "mentions").filter("mentions > 0")
    if table is not None:
        # nothing runs while the plan is built: an unknown name fails the job
        known = F.col("entity").isin(names) | F.col("entity").isNull()
        unknown = F.raise_error(F.concat(F.lit("no variants for "), "entity"))
        wanted = table.select(F.when(known, F.col("entity")).otherwise(unknown).alias("entity"))
        rows = rows.join(wanted.distinct(), "entity", "left_semi")
    return rows.select("entity", "date", "mentions").orderBy("entity", "date")


def chosen(variants: Sequence[Variants], names: Sequence[str]) -> list[Variants]:
    """The variant lists of ``names``; unknown names are an error."""
    by_name = {v.entity: v for v in variants}
    unknown = [n for n in names if n not in by_name]
    if unknown:
        raise KeyError(f"no variants for {', '.join(unknown)}")
    return [by_name[n] for n in names]


def coverage_ratio(
    articles: DataFrame,
    party_leaders: Mapping[str, Sequence[str]] = PARTY_LEADERS,
    parties: Sequence[Variants] = PARTY_VARIANTS,
    leaders: Sequence[Variants] = LEADER_VARIANTS,
) -> DataFrame:
    """(party, leader, leader_to_party_ratio): leader articles / (party articles + 1).

    One scan counts every entity into a single row, from which the pairs are read off.
    """
    wanted_parties = chosen(parties, list(party_leaders))
    pairs = [(p, leader) for p, names in party_leaders.items() for leader in names]
    wanted_leaders = chosen(leaders, list(dict.fromkeys(ld for _, ld in pairs)))
    # a party and a leader may share a name, so the columns carry their kind
    tagged = [Variants(f"p_{v.entity}", v.variants) for v in wanted_parties]
    tagged += [Variants(f"l_{v.entity}", v.variants) for v in wanted_leaders]
    counts = mentions.variant_flags(clean.dated(articles), tagged).agg(
        *[F.count_if(F.col(v.entity)).alias(v.entity) for v in tagged]
    )
    rows = [
        F.struct(
            F.lit(p).alias("party"),
            F.lit(leader).alias("leader"),
            F.round(F.col(f"l_{leader}") / (F.col(f"p_{p}") + 1), 3).alias("leader_to_party_ratio"),
        )
        for p, leader in pairs
    ]
    return counts.select(F.inline(F.array(*rows)))

"""The confidence index: sentiment, share of voice and momentum per entity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newslens.functions import text
from newslens.functions.dates import days as n_days
from newslens.functions.sentiment import NEGATIVE, NEUTRAL, POSITIVE, Lexicon, Model
from newslens.operators import clean, mentions
from newslens.rules import EntityPattern
from newslens.sources.labels import LabelStore, text_key
from newslens.sources.workspace import written

WEIGHTS = (0.4, 0.3, 0.3)  # fixed values: sentiment, volume, momentum
_COUNTS = ("n", "recent", "previous")


def with_periods(dated: DataFrame, days: int = 30) -> DataFrame:
    """Adds ``recent`` and ``previous``: the two windows of ``days`` before the newest date.

    The newest date is a scalar subquery over one column.
    """
    newest = F.max("published_date")
    edges = dated.agg(
        F.struct(
            (newest - n_days(days)).alias("recent"), (newest - n_days(2 * days)).alias("previous")
        )
    ).scalar()
    date, edge, far = F.col("published_date"), edges["recent"], edges["previous"]
    return dated.withColumns({"recent": date >= edge, "previous": (date < edge) & (date >= far)})


def sentence_mentions(
    articles: DataFrame,
    patterns: Sequence[EntityPattern],
    scorer: Lexicon | Model,
    max_chars: int | None = None,
) -> DataFrame:
    """(entity, link, published_date, pos, sentence, label): one row per sentence and entity.

    Each sentence is scored before it is multiplied by the entities it names.
    """
    seen = text.clipped(F.col("sentence"), max_chars)
    rows = mentions.naming_sentences(
        clean.dated(articles), patterns, "link", "published_date"
    ).withColumn("label", scorer.score(seen)["label"])
    return mentions.per_entity(rows, "link", "published_date", "pos", "sentence", "label")


def labelled_rows(
    articles: DataFrame,
    patterns: Sequence[EntityPattern],
    scorer: Lexicon | Model,
    days: int = 30,
    max_chars: int | None = None,
    score_partitions: int | None = None,
) -> DataFrame:
    """(entity, label, n, recent, previous): what every score is a sum of.

    A native scorer runs in the scan's stage, one row per mention. For a model, what it sees
    of equal sentences is first counted together, so that each distinct text is scored once and no
    text is joined back. That step runs in ``score_partitions`` tasks, by default
    ``spark.sql.shuffle.partitions``: bytes say little about a model's time.
    """
    seen = text.clipped(F.col("sentence"), max_chars).alias("seen")
    rows = mentions.naming_sentences(
        with_periods(clean.dated(articles), days), patterns, "recent", "previous"
    ).select(
        seen,
        "entities",
        F.lit(1).cast("bigint").alias("n"),
        F.col("recent").cast("bigint").alias("recent"),
        F.col("previous").cast("bigint").alias("previous"),
    )
    if scorer.native:
        rows = rows.withColumn("label", scorer.score(F.col("seen"))["label"])
        return mentions.per_entity(rows, "label", *_COUNTS)
    n = score_partitions or int(articles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # sentences that differ only beyond the scorer's limit may name different entities
    texts = (
        rows.groupBy("seen", "entities")
        .agg(*[F.sum(c).alias(c) for c in _COUNTS])
        .repartition(n, "seen")  # before the grouping, which keeps this number of tasks
        .groupBy("seen")
        .agg(F.collect_list(F.struct("entities", *_COUNTS)).alias("named"))
    )
    scored = texts.withColumn("label", scorer.score(F.col("seen"))["label"])
    return mentions.per_entity(scored.select("label", F.inline("named")), "label", *_COUNTS)


def labelled_counts(articles: DataFrame, patterns: Sequence[EntityPattern], **options) -> DataFrame:
    """(entity, label, n, recent, previous) with one row per entity and label."""
    rows = labelled_rows(articles, patterns, **options)
    return rows.groupBy("entity", "label").agg(*[F.sum(c).alias(c) for c in _COUNTS])


def confidence_index(
    articles: DataFrame,
    patterns: Sequence[EntityPattern],
    scorer: Lexicon | Model,
    weights: tuple[float, float, float] = WEIGHTS,
    days: int = 30,
    keep_unmentioned: bool = True,
    max_chars: int | None = None,
    score_partitions: int | None = None,
) -> DataFrame:
    """Scores per entity, rounded to three digits.

    One pass over the articles; what is shuffled is one row per entity and task.
    ``keep_unmentioned`` gives entities without a mention a row of zeros.
    """
    rows = labelled_rows(articles, patterns, scorer, days, max_chars, score_partitions)
    if keep_unmentioned:
        entities = F.array(*map(F.lit, mentions.entities_of(patterns)))
        rows = rows.unionByName(
            articles.sparkSession.range(0, 1, numPartitions=1).select(
                F.explode(entities).alias("entity"),
                F.lit(NEUTRAL).alias("label"),
                *[F.lit(0).cast("bigint").alias(c) for c in _COUNTS],
            )
        )
    return scores(rows, weights)


def confidence_indexes(
    articles: DataFrame,
    pattern_sets: Mapping[str, Sequence[EntityPattern]],
    scorer: Model,
    store: LabelStore,
    weights: tuple[float, float, float] = WEIGHTS,
    days: int = 30,
    max_chars: int | None = None,
    score_partitions: int | None = None,
) -> DataFrame:
    """(set, entity, scores...) of several pattern sets from one pass over the articles.

    A sentence that several sets name is scored once, and only if ``store`` has no label of it: what is
    new is added to the store. Entities without a mention have zeros. Shares are of the set's total.
    """
    tagged = [
        replace(p, entity=f"{i}:{p.entity}")
        for i, patterns in enumerate(pattern_sets.values())
        for p in patterns
    ]
    seen = text.clipped(F.col("sentence"), max_chars)
    rows = mentions.naming_sentences(
        with_periods(clean.dated(articles), days), tagged, "recent", "previous"
    )
    counted = rows.groupBy(seen.alias("seen"), "entities").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.col(c).cast("bigint")).alias(c) for c in ("recent", "previous")],
    )
    counted = written(counted.withColumn("text_key", text_key(F.col("seen"))), "sentences")
    store.add(counted, scorer, "seen", score_partitions)
    labelled = store.labelled(counted.select("text_key", "entities", *_COUNTS))
    zeros = articles.sparkSession.range(0, 1, numPartitions=1).select(
        F.explode(F.array(*map(F.lit, mentions.entities_of(tagged)))).alias("entity"),
        F.lit(NEUTRAL).alias("label"),
        *[F.lit(0).cast("bigint").alias(c) for c in _COUNTS],
    )
    every = mentions.per_entity(labelled, "label", *_COUNTS).unionByName(zeros)
    names = F.array(*map(F.lit, pattern_sets))
    place = F.substring_index("entity", ":", 1).cast("int")
    every = every.withColumns(
        {"set": F.get(names, place), "entity": F.expr("substring(entity, instr(entity, ':') + 1)")}
    )
    return scores(every, weights, by=("set",))


def scores(
    rows: DataFrame, weights: tuple[float, float, float] = WEIGHTS, by: Sequence[str] = ()
) -> DataFrame:
    """From (entity, label, n, recent, previous), in any number of rows, to the results.

    With ``by``, one table of results for each value of these columns; shares are of its total.
    """

    def balance(count: str) -> Column:
        sign = F.when(F.col("label") == POSITIVE, 1).when(F.col("label") == NEGATIVE, -1)
        signed = F.sum(sign.otherwise(0) * F.col(count))
        return F.coalesce(F.try_divide(signed, F.sum(count)), F.lit(0.0))

    per_entity = rows.groupBy(*by, "entity").agg(
        F.sum("n").alias("total_mentions"),
        balance("n").alias("s"),
        (balance("recent") - balance("previous")).alias("m"),
    )
    everything = F.sum("total_mentions").over(Window.partitionBy(*by))  # a row per entity
    share = F.coalesce(F.try_divide("total_mentions", everything), F.lit(0.0))
    ws, wv, wm = (F.lit(float(w)) for w in weights)
    return per_entity.withColumn("v", share).select(
        *by,
        "entity",
        F.round("s", 3).alias("sentiment_score"),
        F.round("v", 3).alias("volume_score"),
        F.round("m", 3).alias("momentum"),
        F.round(ws * F.col("s") + wv * F.col("v") + wm * F.col("m"), 3).alias("mci_v2"),
        "total_mentions",
    )

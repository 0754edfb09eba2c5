"""Which entities a text names, and how often.

Rules are literals, so matching is a set of expressions over each row, not a join, and the
aggregates are one count per entity with map-side combining: a shuffle carries one short row
per task, whatever the size or skew of the articles.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslens.functions import text
from newslens.operators import clean, terms
from newslens.rules import CountRule, EntityPattern, Variants


def entities_of(rules: Sequence[CountRule | EntityPattern | Variants]) -> list[str]:
    """Entity names in rule order."""
    return list(dict.fromkeys(r.entity for r in rules))


def count_columns(full_text: Column, rules: Sequence[CountRule]) -> dict[str, Column]:
    """Per entity the sum of all its rules' hits; overlapping hits add up."""
    return {
        entity: reduce(
            add,
            [
                text.count_matches(full_text, r.pattern, r.needs, r.context)
                for r in rules
                if r.entity == entity
            ],
        )
        for entity in entities_of(rules)
    }


def names_any(sentence: Column, patterns: Sequence[EntityPattern]) -> Column:
    """True when any of the patterns is found."""
    return reduce(or_, [text.matches(sentence, p.pattern, p.needs) for p in patterns])


def named(sentence: Column, patterns: Sequence[EntityPattern]) -> Column:
    """One array place per entity: its name where one of its patterns is found, else null.

    Explode it and drop the nulls; compacting the array first would leave generated code.
    """
    return F.array(
        *[
            F.when(names_any(sentence, [p for p in patterns if p.entity == entity]), entity)
            for entity in entities_of(patterns)
        ]
    )


def per_entity(rows: DataFrame, *keep: Column | str) -> DataFrame:
    """One row per entity in ``entities``, as column ``entity`` before ``keep``."""
    return rows.select(F.explode("entities").alias("entity"), *keep).filter("entity IS NOT NULL")


def sentence_rows(articles: DataFrame, *keep: Column | str) -> DataFrame:
    """One row per sentence of title + content, numbered within its article."""
    split = F.posexplode(text.sentences(F.col("_t"))).alias("pos", "sentence")
    return articles.select(*keep, text.full_text().alias("_t")).select("*", split).drop("_t")


def naming_sentences(
    articles: DataFrame, patterns: Sequence[EntityPattern] | DataFrame, *keep: Column | str
) -> DataFrame:
    """Sentences that name an entity, with the array of all entities they name.

    Patterns may be a table (entity, pattern).
    """
    sentence = F.col("sentence")
    if isinstance(patterns, DataFrame):
        rows = terms.with_candidates(sentence_rows(articles, *keep), "sentence", patterns.select("entity", "pattern"), "_rules")
        rows = rows.withColumn("entities", terms.matching(sentence, F.col("_rules"))).drop("_rules")
        return rows.filter(F.size("entities") > 0)
    return (
        sentence_rows(articles, *keep)
        .filter(names_any(sentence, patterns))
        .withColumn("entities", named(sentence, patterns))
    )


def variant_columns(variants: Sequence[Variants]) -> dict[str, Column]:
    """Per entity: does the title or the content hold one of its spellings?"""
    title, content = F.col("_title"), F.col("_content")
    return {
        v.entity: text.spelled(title, v.variants) | text.spelled(content, v.variants)
        for v in variants
    }


def variant_flags(
    articles: DataFrame, variants: Sequence[Variants], *keep: Column | str
) -> DataFrame:
    """One boolean column per entity, beside ``keep``."""
    lowered = clean.no_null_text(articles).select(
        *keep, F.lower("title").alias("_title"), F.lower("content").alias("_content")
    )
    flags = variant_columns(variants)
    return lowered.select(
        *[c for c in lowered.columns if not c.startswith("_")],
        *[flag.alias(entity) for entity, flag in flags.items()],
    )


def article_counts(articles: DataFrame, variants: Sequence[Variants]) -> DataFrame:
    """(entity, articles): articles that name each entity, zero included."""
    names = entities_of(variants)
    counts = variant_flags(articles, variants).agg(*[F.count_if(F.col(n)).alias(n) for n in names])
    return counts.unpivot([], names, "entity", "articles")

"""Sentiment of whole articles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslens.functions import text
from newslens.functions.sentiment import Lexicon, Model

MAX_CHARS = 512  # fixed value: what the original scorer reads of a text


def label_articles(
    articles: DataFrame, scorer: Lexicon | Model, max_chars: int | None = None
) -> DataFrame:
    """Adds ``sentiment`` and ``confidence`` of the content; the title is not read.

    The scorer reads the whole content unless ``max_chars`` says otherwise. A text the scorer fails on is labelled ``error`` with confidence 0.
    """
    seen = text.clipped(text.or_empty("content"), max_chars)
    return articles.withColumn("_r", scorer.score(seen, on_error="label")).select(
        *articles.columns,
        F.col("_r.label").alias("sentiment"),
        F.col("_r.score").alias("confidence"),
    )

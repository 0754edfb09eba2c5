"""Labels that a model has given, kept by text, so that no text is scored twice.

The store is a folder; below it one folder per model key holds deltas (text_key, label, score)
with the SHA-256 of the text. A run scores what no delta holds and publishes one delta, whole or not at
all. Runs at the same time may score a text twice; it still counts once.
"""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newslens.functions.sentiment import Lexicon, Model
from newslens.sources.deltas import Deltas

STORED = "text_key string, label string, score double"


def text_key(text: Column) -> Column:
    return F.sha2(text, 256)


class LabelStore:
    """Labels of one model, whose results ``model_key`` names; another model or version takes another key."""

    def __init__(self, spark: SparkSession, path: str, model_key: str):
        self.spark = spark
        self.deltas = Deltas(spark, f"{path.rstrip('/')}/model={quote(model_key, safe='')}", STORED)

    def read(self) -> DataFrame:
        """(text_key, label, score), each text once."""
        kept = self.deltas.read().groupBy("text_key").agg(F.min(F.struct("label", "score")).alias("r"))
        return kept.select("text_key", "r.label", "r.score")

    def add(self, texts: DataFrame, scorer: Lexicon | Model, text: str = "text", partitions: int | None = None, on_error: str = "raise") -> int:
        """Score the distinct texts that are not in the store and publish them; how many there were.

        The model runs in ``partitions`` tasks (``spark.sql.shuffle.partitions`` unless given). Null is empty. A text that the
        model fails on (``on_error="label"``) is kept as ``error`` only in this result, not in the store,
        so the next run tries it again.
        """
        n = partitions or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        seen = F.coalesce(F.col(text), F.lit(""))
        distinct = texts.select(seen.alias("text")).distinct().withColumn("text_key", text_key(F.col("text")))
        unseen = distinct.join(self.read().select("text_key"), "text_key", "left_anti").repartition(n, "text_key")
        scored = unseen.withColumn("r", scorer.score(F.col("text"), on_error=on_error))
        rows = scored.select("text_key", "r.label", "r.score")
        return self.deltas.add(rows.filter("label <> 'error'") if on_error == "label" else rows)

    def labelled(self, rows: DataFrame, key: str = "text_key") -> DataFrame:
        """``rows`` with the label and score of the text that ``key`` stands for; ``error`` and 0 where there is none."""
        found = rows.join(self.read().withColumnRenamed("text_key", key), key, "left")
        return found.withColumns({"label": F.coalesce("label", F.lit("error")), "score": F.coalesce("score", F.lit(0.0))})

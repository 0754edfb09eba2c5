"""The corpus pipeline: each stage takes the documents its predecessor kept.

Language ID drops what it rejects, line dedup cuts repeated lines, the Jaccard join keeps one document of each
class, the mix picks documents by source weights (again for each further epoch), and packing
deals them into padded batches. All stages but the last return the columns of ``documents``.

Defined results: null text and text without a letter are rejected by the first stage. Repeated rows are
one class of the third. An empty table passes every stage empty. Extra columns pass through to the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslens.llm import jaccard, language, lines, mixing, packing
from newslens.llm.common import or_empty, word_count, written
from newslens.llm.queries import MIX_LEVELS, MIX_WEIGHTS


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; a missing label is filled with the prediction."""
    whole = docs.select(F.struct("*").alias("doc"))  # so that no column name can clash
    rows = language.identify(whole, language.learn(docs), F.col("doc.text"))
    rows = rows.filter(F.col("accepted") & (F.col("lang_pred") != "und"))
    lang = F.coalesce("doc.lang", "lang_pred").alias("lang")
    return rows.select(*[lang if c == "lang" else F.col(f"doc.`{c}`") for c in docs.columns])


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that were seen before."""
    return lines.line_dedup(docs).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return jaccard.one_of_each(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, once per epoch."""
    counted = docs.select(
        F.struct("*").alias("doc"), "doc_id", "lang", "source",
        F.xxhash64("text").alias("text"), word_count(or_empty("text")).alias("words"),
    )
    chosen = mixing.mix(written(counted, "counted"), MIX_LEVELS, MIX_WEIGHTS, tokens=F.col("words"))
    return chosen.select("doc.*")


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every chosen document in its bucket, batch and slot."""
    return packing.pack(docs)


STAGES = [
    ("language ID", language_stage),
    ("line dedup", line_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("mixing to target weights", mix_stage),
    ("packing", pack_stage),
]

#: Language models, near duplicates and optimal buckets are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each but the last returns is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *before, (_, last) = STAGES
    for name, stage in before:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return last(spark, docs, sf_dir)

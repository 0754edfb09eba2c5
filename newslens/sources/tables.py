"""Scans and sinks.

Parquet is the main form. CSV is for exchange: a file with line breaks inside quotes cannot
be split, so one CSV file is one task. CSV does not tell empty text from none: both come
back as null.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslens import schemas
from newslens.functions import dates
from newslens.operators import clean
from newslens.sources.workspace import written

# Doubled quotes, line breaks kept, spaces kept.
_CSV = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}

# The column titles of a result file, after the leading "Leader" or "Party".
RESULT_TITLES = {
    "sentiment_score": "Sentiment_Score",
    "volume_score": "Volume_Score",
    "momentum": "Momentum",
    "mci_v2": "MCI_v2",
    "total_mentions": "Total_Mentions",
}
VIEWS = ("Leader", "Party")


def _read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Columns by the names in the header; others are left out, a missing one is an error.

    All files of the path must have the header of the first. Values that do not fit are null.
    """
    names = spark.read.options(**_CSV, multiLine=True).csv(path).columns
    missing = [f.name for f in schema if f.name not in names]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    texts = T.StructType([T.StructField(n, T.StringType()) for n in names])
    rows = spark.read.schema(texts).options(**_CSV, multiLine=True, enforceSchema=False).csv(path)
    return rows.select(
        *[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema]
    )


def _write_csv(df: DataFrame, path: str, mode: str) -> None:
    df.write.mode(mode).options(**_CSV).csv(path)


def _text_dates(schema: T.StructType) -> T.StructType:
    """CSV holds dates as the text the site printed."""
    return T.StructType(
        [
            T.StructField(f.name, T.StringType() if f.name == "published_date" else f.dataType)
            for f in schema
        ]
    )


def _read(spark: SparkSession, path: str, schema: T.StructType, form: str) -> DataFrame:
    if form == "parquet":
        return spark.read.schema(schema).parquet(path)
    if form == "csv":
        columns = T.StructType([f for f in _text_dates(schema) if f.name != "date_text"])
        rows = _read_csv(spark, path, columns)
        if "date_text" in schema.names:
            rows = rows.withColumn("date_text", F.col("published_date"))
        return clean.with_dates(rows)
    raise ValueError(f"unknown form {form!r}")


def _write(df: DataFrame, path: str, form: str, mode: str) -> None:
    if form == "parquet":
        df.write.mode(mode).parquet(path)
    elif form == "csv":
        date = dates.wall_time(F.col("published_date"))
        if "date_text" in df.columns:
            date = F.coalesce("date_text", date)
        _write_csv(df.withColumn("published_date", date).drop("date_text"), path, mode)
    else:
        raise ValueError(f"unknown form {form!r}")


def read_landed_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed article pages that were fetched successfully."""
    return fetched(spark.read.schema(schemas.LANDED_PAGE).parquet(path))


def fetched(pages: DataFrame) -> DataFrame:
    return pages.filter("status = 200")


def read_articles(spark: SparkSession, path: str, form: str = "parquet") -> DataFrame:
    """Articles with ``date_text``, the printed date, where the file has it."""
    return _read(spark, path, schemas.STORED_ARTICLE, form)


def write_articles(df: DataFrame, path: str, form: str = "parquet", mode: str = "error") -> None:
    """Articles; as CSV with the printed date where ``date_text`` holds it."""
    _write(df, path, form, mode)


def _with_day(df: DataFrame) -> DataFrame:
    return df.withColumn("day", F.to_date("published_date"))


def write_by_day(df: DataFrame, path: str) -> None:
    """Rows with a ``published_date`` in one folder per day; the days they have are replaced, others stay.

    A rerun of the same rows leaves the same table. A large day is dealt over several files, small ones share tasks.
    """
    rows = _with_day(df).hint("rebalance", "day")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def add_by_day(df: DataFrame, path: str, keys: Sequence[str] = ("source", "link")) -> None:
    """As ``write_by_day``, but rows of these days that ``df`` has no key of stay.

    Only the days of ``df`` are read. The merged days are written aside first, as a table cannot be
    read while it is replaced.
    """
    spark = df.sparkSession
    new = written(_with_day(df), "new-days")
    days = [r.day for r in new.select("day").distinct().collect()]  # a row per day
    old = stored_by_day(spark, path, new.drop("day").schema)
    if old is not None:
        day = F.col("day")
        old = old.filter(day.isin([d for d in days if d]) | (day.isNull() if None in days else F.lit(False)))
        new = written(new.unionByName(old.join(new.select(*keys), list(keys), "left_anti")), "merged-days")
    write_by_day(new.drop("day"), path)


def stored_by_day(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """What ``write_by_day`` left, with ``day``; None if there is nothing yet."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return None
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("day", T.DateType())])).parquet(path)


def read_recent(spark: SparkSession, path: str, as_of, days: int = 60, schema: T.StructType = schemas.ARTICLE) -> DataFrame:
    """``clean.recent`` of a table by day: folders of days before the edge are not opened."""
    edge = F.to_date(dates.moment(as_of) - dates.days(days))
    rows = stored_by_day(spark, path, schema)
    if rows is None:
        return spark.createDataFrame([], schema)
    return clean.recent(rows.filter(F.col("day").isNull() | (F.col("day") >= edge)), as_of, days).drop("day")


def read_labelled(spark: SparkSession, path: str, form: str = "parquet") -> DataFrame:
    return _read(spark, path, schemas.LABELLED, form)


def write_labelled(df: DataFrame, path: str, form: str = "parquet", mode: str = "error") -> None:
    _write(df, path, form, mode)


def read_tracked(
    spark: SparkSession, path: str, entities: Sequence[str], form: str = "parquet"
) -> DataFrame:
    """Tracked articles; in CSV the count map is JSON."""
    schema = schemas.tracked(list(entities))
    if form == "parquet":
        return _read(spark, path, schema, form)
    flat = T.StructType(
        [T.StructField(f.name, T.StringType()) if f.name == "entity_counts" else f for f in schema]
    )
    counts = schema["entity_counts"].dataType
    return _read(spark, path, flat, form).withColumn(
        "entity_counts", F.from_json("entity_counts", counts)
    )


def write_tracked(df: DataFrame, path: str, form: str = "parquet", mode: str = "error") -> None:
    if form == "csv":
        df = df.withColumn("entity_counts", F.to_json("entity_counts"))
    _write(df, path, form, mode)


def _result_titles(view: str) -> dict[str, str]:
    if view not in VIEWS:
        raise ValueError(f"unknown view {view!r}")
    return {"entity": view, **RESULT_TITLES}


def read_results(spark: SparkSession, path: str, view: str) -> DataFrame:
    """A result file; whole mention counts may be printed as fractions (``407.0``)."""
    titles = _result_titles(view)
    printed = T.StructType(
        [
            T.StructField(titles[f.name], T.DoubleType() if f.dataType == T.LongType() else f.dataType)
            for f in schemas.RESULT
        ]
    )
    return _read_csv(spark, path, printed).select(
        *[F.col(titles[f.name]).cast(f.dataType).alias(f.name) for f in schemas.RESULT]
    )


def write_results(results: DataFrame, path: str, view: str, mode: str = "error") -> None:
    """A result table has one row per entity and goes to one file."""
    titles = _result_titles(view)
    _write_csv(
        results.select(*[F.col(c).alias(t) for c, t in titles.items()]).repartition(1), path, mode
    )


def union_sources(*tables: DataFrame) -> DataFrame:
    """All rows of all sites; the same article from two sites stays twice."""
    return reduce(DataFrame.unionByName, tables)


def run_summary(df: DataFrame) -> DataFrame:
    """One row: non-null values per column and ``total_rows``."""
    return df.agg(*[F.count(c).alias(c) for c in df.columns], F.count("*").alias("total_rows"))

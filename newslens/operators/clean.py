"""Row-wise cleaning: nulls, dates, recency. No operator here shuffles."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslens.functions import dates, text
from newslens.operators import terms


def no_null_text(df: DataFrame, *columns: str) -> DataFrame:
    """Null becomes the empty string; title and content unless named."""
    names = columns or ("title", "content")
    return df.withColumns({c: text.or_empty(c) for c in names})


def with_dates(df: DataFrame) -> DataFrame:
    """``published_date`` as a wall-clock time; text that reads as no date becomes null."""
    kind = df.schema["published_date"].dataType
    date = F.col("published_date")
    if isinstance(kind, T.StringType):
        return df.withColumn("published_date", dates.lenient(date))
    if isinstance(kind, T.TimestampNTZType):
        return df
    return df.withColumn("published_date", date.cast("timestamp_ntz"))


def dated(df: DataFrame) -> DataFrame:
    """Only rows with a readable date."""
    return with_dates(df).filter(F.col("published_date").isNotNull())


def with_day(df: DataFrame) -> DataFrame:
    return df.withColumn("date", F.to_date("published_date"))


def recent(
    df: DataFrame,
    as_of: dt.datetime | str | Column | None = None,
    days: int = 60,
    keep_null: bool = True,
) -> DataFrame:
    """Rows published within ``days`` before ``as_of``."""
    date = F.col("published_date")
    young = date >= dates.moment(as_of) - dates.days(days)
    return df.filter(date.isNull() | young if keep_null else young)


def with_keywords(
    df: DataFrame, keywords: Iterable[str] | DataFrame, unless: Column | None = None
) -> DataFrame:
    """Rows whose content or title contains a keyword as a substring.

    Rows for which ``unless`` holds are kept untested. Keywords may be a table with a column ``keyword``.
    """
    if isinstance(keywords, DataFrame):
        found = terms.any_keyword(df, text.search_text(), keywords)
    else:
        found = text.any_keyword(text.search_text(), keywords)
    return df.filter(found if unless is None else unless | found)


def rounded(df: DataFrame, digits: int = 3) -> DataFrame:
    """Every fractional column rounded, half away from zero."""
    fractional = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(
        *[F.round(c, digits).alias(c) if c in fractional else F.col(c) for c in df.columns]
    )

"""Walking order of listing pages, as table operators.

``(page_no, pos)`` is the order in which links are visited. Nothing here sorts or gathers a
source or an address: each rule is an aggregate with map-side combining, so one address or
one source may hold any share of the rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslens.functions import dates
from newslens.operators.salted import salted_join

ORDER = ("source", "page_no", "pos")


def _require(df: DataFrame, *columns: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"the walking order needs the columns {', '.join(missing)}")


def _place() -> Column:
    """(page_no, pos) as one number, so that its minimum is a hash aggregate."""
    return F.shiftleft(F.col("page_no").cast("bigint"), 32) + F.col("pos").cast("bigint")


def capped(listing: DataFrame, pages: int) -> DataFrame:
    """At most the first ``pages`` pages."""
    _require(listing, "page_no")
    return listing.filter(F.col("page_no") <= pages)


def first_seen(listing: DataFrame) -> DataFrame:
    """Each address once per source, at its first place."""
    _require(listing, *ORDER, "url")
    return (
        listing.groupBy("source", "url")
        .agg(F.min(_place()).alias("place"))
        .select(
            "source",
            F.shiftright("place", 32).cast("int").alias("page_no"),
            F.col("place").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("pos"),
            "url",
        )
    )


def not_on_earlier_page(listing: DataFrame, salted: bool = False) -> DataFrame:
    """Drop addresses seen on an earlier page; repeats within a page stay.

    Only addresses that are on several pages are joined. With ``salted``, frequent addresses are looked for first
    and their rows dealt out; without, a hot address is left to Spark's own skew splitting.
    """
    _require(listing, *ORDER, "url")
    pages = listing.groupBy("source", "url").agg(
        F.min("page_no").alias("_first"), F.max("page_no").alias("_last")
    )
    repeated = pages.filter("_first < _last").drop("_last")
    join = salted_join if salted else DataFrame.join
    return (
        join(listing, repeated, ["source", "url"], "left")
        .filter(F.col("_first").isNull() | (F.col("page_no") == F.col("_first")))
        .select("source", "page_no", "pos", "url")
    )


def until_exhausted(
    links: DataFrame,
    sources: Sequence[str] | None = None,
    listing: DataFrame | None = None,
    first_page: int = 1,
) -> DataFrame:
    """Walk from ``first_page`` and stop before the first page without a new address.

    A missing page has none, so a source without ``first_page`` is not walked at all. ``listing``
    is the whole listing to read the stops from, where ``links`` is already reduced.
    """
    _require(links, *ORDER, "url")
    walked = (links if listing is None else listing).filter(F.col("page_no") >= first_page)
    links = links.filter(F.col("page_no") >= first_page)
    fresh = walked.groupBy("source", "url").agg(F.min("page_no").alias("page_no"))
    here = F.col("page_no")
    marks = fresh.select(
        "source",
        F.inline(
            F.array(
                F.struct(here.alias("page_no"), F.lit(True).alias("has_new")),
                F.struct((here + 1).alias("page_no"), F.lit(False).alias("has_new")),
            )
        ),
    )
    opened = fresh.select("source", F.lit(first_page).alias("page_no"), F.lit(False).alias("has_new"))
    ends = (
        marks.unionByName(opened.distinct())
        .groupBy("source", "page_no")
        .agg(F.bool_or("has_new").alias("has_new"))
    )
    return _before(links, ends.filter("NOT has_new"), here, sources)


def cutoff(
    df: DataFrame,
    mode: str,
    as_of: dt.datetime | str | Column | None = None,
    days: int = 60,
    sources: Sequence[str] | None = None,
) -> DataFrame:
    """Stop each source at its first article older than ``days``.

    ``immediate`` drops everything from that article on, ``page_end`` finishes its page
    without the old ones. An article without a date is never old.
    """
    _require(df, *ORDER, "published_date")
    date, edge = F.col("published_date"), dates.moment(as_of) - dates.days(days)
    old = df.filter(date < edge)
    if mode == "immediate":
        return _before(df, old, _place(), sources)
    if mode == "page_end":
        young = df.filter(date.isNull() | (date >= edge))
        return _before(young, old, F.col("page_no"), sources, inclusive=True)
    raise ValueError(f"unknown cutoff mode {mode!r}")


def _before(
    df: DataFrame,
    ends: DataFrame,
    at: Column,
    sources: Sequence[str] | None,
    inclusive: bool = False,
) -> DataFrame:
    """Rows of ``df`` before the least ``at`` of ``ends`` within their source; all without one.

    For known sources the stops are one row, a scalar subquery: no join and no shuffle of
    ``df``. Otherwise they are one row per source; Spark broadcasts them if their bytes are few, else
    joins by a shuffle, where skew splitting takes care of a large source.
    """

    def kept(stop: Column) -> Column:
        return F.coalesce(at <= stop if inclusive else at < stop, F.lit(True))

    if sources is None:
        stops = ends.groupBy("source").agg(F.min(at).alias("_stop"))
        return df.join(stops, "source", "left").filter(kept(F.col("_stop"))).drop("_stop")
    names = list(sources)
    mine = df.filter(F.col("source").isin(names))
    if not names:
        return mine
    least = [F.min(F.when(F.col("source") == s, at)).alias(f"s{i}") for i, s in enumerate(names)]
    stops = ends.filter(F.col("source").isin(names)).agg(F.struct(*least).alias("s")).scalar()
    cases = [F.when(F.col("source") == s, stops[f"s{i}"]) for i, s in enumerate(names)]
    return mine.filter(kept(F.coalesce(*cases)))

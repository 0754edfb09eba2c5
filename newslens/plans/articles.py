"""From landed pages to the article table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslens.operators import bloom, clean, extract, listing
from newslens.rules import SITE_RULES, SiteRule
from newslens.sources.tables import union_sources
from newslens.sources.workspace import written


def visits(links: DataFrame, rules: Sequence[SiteRule] = SITE_RULES) -> DataFrame:
    """The links each site's walk would open: page cap, repeats, exhausted listing."""
    walks = []
    for how in sorted({(r.dedupe, r.page_cap or 0) for r in rules}):
        dedupe, cap = how
        names = [r.source for r in rules if (r.dedupe, r.page_cap or 0) == how]
        mine = links.filter(F.col("source").isin(names))
        if cap:
            mine = listing.capped(mine, cap)
        if dedupe == "first":
            walks.append(listing.first_seen(mine))
        elif dedupe == "earlier_page":
            fresh = listing.not_on_earlier_page(mine)
            walks.append(listing.until_exhausted(fresh, names, mine))
        else:
            raise ValueError(f"unknown dedupe {dedupe!r}")
    return union_sources(*walks)


def of_status(pages: DataFrame, rules: Sequence[SiteRule] = SITE_RULES) -> DataFrame:
    """Landed pages with the status that their site's rule asks for."""
    any_status = [r.source for r in rules if r.status is None]
    keep = F.col("source").isin(any_status)
    for status in sorted({r.status for r in rules if r.status is not None}):
        names = [r.source for r in rules if r.status == status]
        keep |= F.col("source").isin(names) & (F.col("status") == status)
    return pages.filter(keep)


def pages_of(pages: DataFrame, opened: DataFrame) -> DataFrame:
    """The pages whose address is opened.

    A Bloom filter of the addresses drops nearly all others in the scan's stage, so that the join, if Spark does not
    broadcast the addresses, shuffles the HTML of opened pages only.
    """
    address = F.xxhash64("source", "url")
    # of a written table: the count is read off its file footers
    held = bloom.Filter(opened.select(address.alias("key")), opened.count())
    few = pages.withColumn("_words", held.words.scalar()).filter(held.may_hold(F.col("_words"), address)).drop("_words")
    return few.join(opened.select("source", "url"), ["source", "url"], "left_semi")


def build_articles(
    pages: DataFrame,
    links: DataFrame,
    rules: Sequence[SiteRule] = SITE_RULES,
    as_of: dt.datetime | str | Column | None = None,
    days: int = 60,
) -> DataFrame:
    """Landed pages (source, url, status, html; one per address) and listing links to articles.

    The links are written once, by source, so that reading them (which may mean parsing the
    listing) is not repeated by the walks, and so are the addresses the walks open. Only landed pages
    with such an address are parsed. The articles are written too: the cut-off reads their dates
    before their texts, and the parse should neither run twice nor be lost with an executor.

    The order of the steps is part of the result: unreadable articles go first, then the
    age cut-off, then the keywords, so an old article without keywords still ends a walk.
    """
    names = [r.source for r in rules]
    known = links.filter(F.col("source").isin(names)).select(*listing.ORDER, "url")
    opened = written(visits(written(known, "links", partition_by=["source"]), rules), "visits")
    linked = pages_of(of_status(pages, rules), opened)
    found = extract.articles(linked, rules).withColumnRenamed("link", "url")
    opened = opened.join(found, ["source", "url"])
    rows = written(opened, "articles", partition_by=["source"])

    kept = []
    for rule_mode in sorted({r.cutoff for r in rules}):
        names = [r.source for r in rules if r.cutoff == rule_mode]
        kept.append(listing.cutoff(rows, rule_mode, as_of, days, names))
    young = union_sources(*kept)

    for keywords in sorted({r.keywords for r in rules if r.keywords}):
        names = [r.source for r in rules if r.keywords == keywords]
        other = ~F.col("source").isin(names)
        young = clean.with_keywords(young, keywords, unless=other)
    return young.select(
        "source", "title", F.col("url").alias("link"), "content", "published_date", "date_text"
    )

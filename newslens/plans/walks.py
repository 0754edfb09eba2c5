"""Walks that go on where the last one stopped.

The store keeps, by source, every address seen and the page the walk goes on from. A run gets the listing pages up to ``upto``
that have landed since, opens what no earlier run or page has seen, and publishes one delta. What several runs
open is what one run over the whole listing opens. Known addresses are dropped by an anti-join, which only links that
a Bloom filter of them may hold take part in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslens.operators import listing
from newslens.operators.bloom import Filter
from newslens.rules import SITE_RULES, SiteRule
from newslens.sources.deltas import Deltas
from newslens.sources.tables import union_sources
from newslens.sources.workspace import written

#: Seen addresses; rows without an address tell where the walk of a source goes on and whether it has ended.
STORED = "source string, url string, next_page int, ended boolean"


class WalkStore:
    def __init__(self, spark: SparkSession, path: str):
        self.deltas = Deltas(spark, path, STORED)

    def seen(self) -> DataFrame:
        return self.deltas.read().filter("url IS NOT NULL").select("source", "url")

    def progress(self) -> DataFrame:
        """(source, next_page, ended): one row per source walked so far."""
        rows = self.deltas.read().filter("url IS NULL").groupBy("source")
        return rows.agg(F.max("next_page").alias("next_page"), F.bool_or("ended").alias("ended"))


def unseen(links: DataFrame, seen: DataFrame) -> DataFrame:
    """Links whose address is not in ``seen``."""
    known = seen.count()
    if not known:
        return links
    address = F.xxhash64("source", "url")
    held = Filter(seen.select(address.alias("key")), known)
    marked = links.withColumn("_words", held.words.scalar())
    marked = marked.withColumn("_may", held.may_hold(F.col("_words"), address)).drop("_words")
    sure = marked.filter("NOT _may").drop("_may")
    return sure.unionByName(marked.filter("_may").drop("_may").join(seen, ["source", "url"], "left_anti"))


def go_on(links: DataFrame, store: WalkStore, upto: int, rules: Sequence[SiteRule] = SITE_RULES) -> DataFrame:
    """(source, page_no, pos, url) to open of the listing pages up to ``upto``; adds them to the store.

    Pages below a source's ``next_page`` and those of ended walks are not read again. A walk that stops
    at the first page without a new address has ended if that page is not beyond ``upto``.
    """
    names = [r.source for r in rules]
    mine = links.filter(F.col("source").isin(names)).select(*listing.ORDER, "url")
    done = store.progress()
    mine = mine.join(done, "source", "left").withColumn("next_page", F.coalesce("next_page", F.lit(1)))
    mine = mine.filter((F.col("page_no") >= F.col("next_page")) & (F.col("page_no") <= upto) & ~F.coalesce("ended", F.lit(False)))
    fresh = written(unseen(mine.drop("ended"), store.seen()), "fresh")

    opened = []
    for how in sorted({(r.dedupe, r.page_cap or 0) for r in rules}):
        dedupe, cap = how
        sources = [r.source for r in rules if (r.dedupe, r.page_cap or 0) == how]
        part = fresh.filter(F.col("source").isin(sources))
        part = listing.capped(part, cap) if cap else part
        if dedupe == "first":
            opened.append(listing.first_seen(part))
            continue
        # counted from where each walk goes on
        moved = part.withColumn("page_no", F.col("page_no") - F.col("next_page") + 1)
        starts = part.select("source", "next_page").distinct()
        walked = listing.until_exhausted(listing.not_on_earlier_page(moved), sources, moved)
        walked = walked.join(starts, "source")
        opened.append(walked.select("source", (F.col("page_no") + F.col("next_page") - 1).alias("page_no"), "pos", "url"))
    opened = written(union_sources(*opened), "opened")

    stopping = [r.source for r in rules if r.dedupe != "first"]
    stops = opened.groupBy("source").agg((F.max("page_no") + 1).alias("at"))
    every = links.sparkSession.createDataFrame([(n,) for n in names], "source string").join(done, "source", "left")
    reached = every.join(stops, "source", "left").select(
        "source", F.lit(None).cast("string").alias("url"),
        F.when(F.col("source").isin(stopping), F.coalesce("at", "next_page", F.lit(1))).otherwise(upto + 1).alias("next_page"),
        F.coalesce("ended", F.lit(False)).alias("ended"),
    )
    reached = reached.withColumn("ended", F.col("ended") | (F.col("next_page") <= upto))
    addresses = fresh.select("source", "url").distinct()
    rows = addresses.select("source", "url", F.lit(None).cast("int").alias("next_page"), F.lit(None).cast("boolean").alias("ended"))
    store.deltas.add(rows.unionByName(reached))
    return opened

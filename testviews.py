"""Tables that Spark derives from the test data, for queries, bench and tests.

The test text names no entities and has no dates, so both are added by row number; every
row and the whole text take part. ``oracles.py`` holds the same definitions as SQL.
"""

from __future__ import annotations

import re
import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslens import Lexicon, Model
from newslens.operators import phrases

#: The words that the views below append.
TONE = Lexicon(positive=("good",), negative=("bad",))
AS_OF = "2025-04-01 00:00:00"
PORTALS = ("Kathmandu Post", "Setopati", "OnlineKhabar")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table; dealt to ``newslens.parts`` partitions if the session asks for it.

    The test files have one row group, so one split each: the bench asks for its cores.
    """
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    parts = spark.conf.get("newslens.parts", None)
    return rows.repartition(int(parts)) if parts else rows


def _every(n: int, suffix: str):
    return F.when(F.col("doc_id") % n == 0, F.lit(suffix)).otherwise(F.lit(""))


def _day(days):
    return F.date_add(F.lit("2025-01-01").cast("date"), days.cast("int")).cast("timestamp_ntz")


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles: the documents with entity names, tone words and dates added."""
    doc = F.col("doc_id")
    tone = F.when(doc % 7 == 0, " good win").when(doc % 11 == 0, " bad loss").otherwise("")
    return (
        table(spark, sf_dir, "documents")
        .select("doc_id", "source", F.col("text").alias("t"))
        .select(
            "source",
            F.substring("t", 1, 40).alias("title"),
            F.col("doc_id").cast("string").alias("_id"),
            F.concat(
                "t",
                _every(3, ". K.P. Sharma Oli of the UML met CPN-UML"),
                _every(4, ". Balen Shah the mayor"),
                _every(5, ". Gagan Kumar Thapa, Nepali Congress"),
                _every(6, ". RSP and NC announced"),
                tone,
            ).alias("content"),
            _day(doc * 37 % 90).alias("published_date"),
        )
        .select(
            "source",
            "title",
            F.concat(F.lit("doc/"), "_id").alias("link"),
            "content",
            "published_date",
        )
    )


def printed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The news dates as text, in the forms the sites print, some unreadable."""
    kind = F.substring_index("link", "/", -1).cast("bigint") % 7
    at = F.col("published_date")
    forms = [
        F.date_format(at, "yyyy-MM-dd HH:mm:ss"),
        F.date_format(at, "yyyy-MM-dd HH:mm"),
        F.date_format(at, "yyyy-MM-dd"),
        F.date_format(at, "MMMM d, yyyy"),
        F.concat(F.lit("Friday, "), F.date_format(at, "MMM d, yyyy")),
        F.concat(F.date_format(at, "yyyy-MM-dd"), F.lit("T10:05:00")),
    ]
    text = F.lit("soon")
    for i, form in enumerate(forms):
        text = F.when(kind == i, form).otherwise(text)
    return news(spark, sf_dir).select("link", "source", text.alias("published_date"))


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of three portals, twenty to a page; each again on the same or a later page."""
    pages = table(spark, sf_dir, "pages").select(
        F.element_at(F.array(*map(F.lit, PORTALS)), (F.col("page_id") % 3 + 1).cast("int")).alias(
            "source"
        ),
        F.expr("cast(page_id div 20 + 1 as int)").alias("page_no"),
        (F.col("page_id") % 20).cast("int").alias("pos"),
        "url",
        "page_id",
    )
    again = pages.withColumns(
        {
            "page_no": F.col("page_no") + (F.col("page_id") % 4).cast("int"),
            "pos": F.col("pos") + 20,
        }
    )
    return pages.unionByName(again).drop("page_id")


def hot_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listing with one more link after each link, to the same address everywhere."""
    rows = listing(spark, sf_dir)
    hot = rows.withColumns({"pos": F.col("pos") + 100, "url": F.lit("https://hot.example.org/")})
    return rows.unionByName(hot)


def fetched_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages as bytes in six ways: charset by declaration, mark, header, other declaration, and twice by none."""
    kind, html = F.col("page_id") % 6, F.col("html")
    latin = F.encode(html, "ISO-8859-1")
    bare, other = (F.regexp_replace(html, '<meta charset="utf-8">', m) for m in ("", '<meta http-equiv="x" content="text/html; charset=windows-1252">'))
    ways = [
        F.encode(html, "UTF-8"), F.encode(html, "UTF-16"), latin,
        F.encode(other, "ISO-8859-1"), F.encode(bare, "UTF-8"), F.encode(bare, "ISO-8859-1"),
    ]
    page = ways[0]
    for i, way in enumerate(ways[1:], 1):
        page = F.when(kind == i, way).otherwise(page)
    header = F.when(kind == 2, "text/html; charset=ISO-8859-1").when(kind == 4, "text/html")
    return table(spark, sf_dir, "pages").select("page_id", "url", page.alias("html"), header.alias("content_type"))


def late_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listing where one portal lacks its first page and another its third."""
    source, page = F.col("source"), F.col("page_no")
    gone = (source == PORTALS[1]) & (page == 1) | (source == PORTALS[2]) & (page == 3)
    return listing(spark, sf_dir).filter(~gone)


def walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dated pages in walking order: the further down, the older, with some scatter."""
    pages = table(spark, sf_dir, "pages")
    last = pages.agg(F.max("page_id")).scalar()
    back = F.floor(F.col("page_id") * 90 / (last + 1)) - F.col("page_id") % 7
    return pages.select(
        F.element_at(F.array(*map(F.lit, PORTALS)), (F.col("page_id") % 3 + 1).cast("int")).alias(
            "source"
        ),
        F.expr("cast(page_id div 20 + 1 as int)").alias("page_no"),
        (F.col("page_id") % 20).cast("int").alias("pos"),
        "url",
        F.when(F.col("page_id") % 13 != 5, _day(F.lit(90) - back)).alias("published_date"),
    )


def _escaped(text):
    for plain, mark in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(plain), F.lit(mark))
    return text


def _portal_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents spread over the portals, newest first in walking order."""
    docs = table(spark, sf_dir, "documents")
    last = docs.agg(F.max("doc_id")).scalar()
    doc = F.col("doc_id")
    back = F.floor(doc * 90 / (last + 1)) - doc % 7
    kind = doc % 3
    return docs.select(
        "doc_id",
        F.element_at(F.array(*map(F.lit, PORTALS)), (kind + 1).cast("int")).alias("source"),
        F.when(kind == 0, F.concat(F.lit("https://kathmandupost.com/politics/"), "doc_id"))
        .when(kind == 1, F.concat(F.lit("https://en.setopati.com/political/"), "doc_id"))
        .otherwise(F.concat(F.lit("https://english.onlinekhabar.com/"), "doc_id", F.lit(".html")))
        .alias("url"),
        F.expr("cast(doc_id div 60 + 1 as int)").alias("page_no"),
        F.expr("cast((doc_id % 60) div 3 as int)").alias("pos"),
        _day(F.lit(90) - back).alias("day"),
        F.when(doc % 17 == 3, 404).otherwise(200).alias("status"),
        F.col("text").alias("t"),
    )


def portal_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing of the portal rows; every link comes again, some only two pages later."""
    rows = _portal_rows(spark, sf_dir).select("doc_id", "source", "page_no", "pos", "url")
    later = F.when(F.col("doc_id") % 5 == 1, 2).otherwise(0)
    again = rows.withColumns({"page_no": F.col("page_no") + later, "pos": F.col("pos") + 20})
    return rows.unionByName(again).drop("doc_id")


def portal_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed pages in the layout of each portal: a paragraph per line of the document."""
    dated = F.col("doc_id") % 19 != 4
    title = _escaped(F.substring("t", 1, 40))
    lines = F.transform(
        F.split(_escaped(F.col("t")), "\n"), lambda line: F.concat(F.lit("<p>"), line, F.lit("</p>"))
    )
    body = F.array_join(lines, "\n")
    printed = F.when(dated, F.date_format("day", "MMMM d, yyyy")).otherwise("soon")
    minute = F.when(dated, F.date_format("day", "yyyy-MM-dd HH:mm")).otherwise("soon")
    iso = F.when(dated, F.date_format("day", "yyyy-MM-dd'T'HH:mm:ss")).otherwise("soon")
    kathmandu = F.concat(
        F.lit('<div class="row"><div class="col-sm-8"><h1>'), title,
        F.lit('</h1></div></div><div class="updated-time">Published at : '), printed,
        F.lit('</div><section class="story-section">'), body, F.lit("</section>"),
    )
    setopati = F.concat(
        F.lit('<span class="news-big-title">'), title,
        F.lit('</span><span class="pub-date">Published: '), minute,
        F.lit('</span><div class="editor-box">'), body, F.lit("</div>"),
    )
    khabar = F.concat(
        F.lit('<meta property="article:published_time" content="'), iso,
        F.lit('+05:45"><h1 class="ok-single-post-title">'), title,
        F.lit('</h1><div class="ok-single-post-content">'), body, F.lit("</div>"),
    )
    kind = F.col("doc_id") % 3
    layout = F.when(kind == 0, kathmandu).when(kind == 1, setopati).otherwise(khabar)
    page = F.concat(
        F.lit("<!DOCTYPE html><html><body><p>menu</p>"), layout, F.lit("<p>end</p></body></html>")
    )
    return _portal_rows(spark, sf_dir).select("source", "url", "status", page.alias("html"))


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The real pages inside each portal's listing frame, with article links around them."""
    number = F.col("page_id").cast("string")
    k = F.concat(
        F.lit('<div id="news-list">'), "html",
        F.lit('<article class="article-image"><a href="/politics/'), number,
        F.lit('"><h3>x</h3></a></article><article class="article-image">'
              '<a href="https://kathmandupost.com/money/'), number,
        F.lit('"><h3>y</h3></a><a href="/none"><h4>z</h4></a></article></div>'),
    )
    s = F.concat(
        F.lit('<div class="extra"><a href="/political/1"></a></div>'
              '<div class="row bishesh news-cat-list"><div class="items">'), "html",
        F.lit('<a href="https://en.setopati.com/political/'), number,
        F.lit('/">a</a><a href="https://en.setopati.com/political/page">b</a></div></div>'),
    )
    o = F.concat(
        F.lit('<div class="ok-news-post ltr-post">'), "html",
        F.lit('<a class="ok-post-image" href=" https://english.onlinekhabar.com/'), number,
        F.lit('.html "></a><a class="ok-post-image" href="https://english.onlinekhabar.com/z">'
              '</a></div><div class="ok-news-post ltr-post">'
              '<a class="ok-post-image" href="https://elsewhere.example.org/"></a></div>'),
    )
    kind = F.col("page_id") % 3
    return table(spark, sf_dir, "pages").select(
        F.element_at(F.array(*map(F.lit, PORTALS)), (kind + 1).cast("int")).alias("source"),
        F.expr("cast(page_id div 3 + 1 as int)").alias("page_no"),
        F.when(kind == 0, k).when(kind == 1, s).otherwise(o).alias("html"),
    )


def rule_table(spark: SparkSession, rules) -> DataFrame:
    """Rules as rows (entity, pattern, context)."""
    rows = [(r.entity, r.pattern, list(getattr(r, "context", ()))) for r in rules]
    return spark.createDataFrame(rows, "entity string, pattern string, context array<string>")


def variant_table(spark: SparkSession, variants) -> DataFrame:
    return spark.createDataFrame(phrases.table_of(variants), "entity string, variant string")


def title_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(term): the distinct stretches of eight or more letters in all titles; they grow with the articles."""
    found = F.regexp_extract_all(F.lower("title"), F.lit("[a-z]{8,}"), F.lit(0))
    return news(spark, sf_dir).select(F.explode(found).alias("term")).distinct()


def listed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed pages, half of them at addresses that the listing pages name, half at others."""
    page = F.col("page_id")
    kind = page % 3
    day = _day(F.lit(60) + page % 31)
    url = (
        F.when(kind == 0, F.concat(F.lit("https://kathmandupost.com/politics/"), "page_id"))
        .when(kind == 1, F.concat(F.lit("https://en.setopati.com/political/"), "page_id", F.lit("/")))
        .otherwise(F.concat(F.lit("https://english.onlinekhabar.com/"), "page_id", F.lit(".html")))
    )
    title = F.concat(F.lit("Election "), "page_id")
    k = F.concat(
        F.lit('<div class="col-sm-8"><h1>'), title, F.lit('</h1></div><p class="updated-time">Published at : '),
        F.date_format(day, "MMMM d, yyyy"), F.lit('</p><section class="story-section"><p>'), "url", F.lit("</p></section>"),
    )
    s = F.concat(
        F.lit('<span class="news-big-title">'), title, F.lit('</span><span class="pub-date">P: '),
        F.date_format(day, "yyyy-MM-dd HH:mm"), F.lit('</span><div class="editor-box"><p>'), "url", F.lit("</p></div>"),
    )
    o = F.concat(
        F.lit("<h1>"), title, F.lit("</h1><time>"), F.date_format(day, "yyyy-MM-dd HH:mm:ss"),
        F.lit('</time><div class="ok-single-post-content"><p>'), "url", F.lit("</p></div>"),
    )
    unlisted = F.when(page % 2 == 0, "").otherwise("?unlisted")
    return table(spark, sf_dir, "pages").select(
        F.element_at(F.array(*map(F.lit, PORTALS)), (kind + 1).cast("int")).alias("source"),
        F.concat(url, unlisted).alias("url"),
        F.lit(200).alias("status"),
        F.when(kind == 0, k).when(kind == 1, s).otherwise(o).alias("html"),
    )


def date_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the sites print as dates, by portal, without the HTML around it."""
    number = F.substring_index("link", "/", -1).cast("bigint")
    at = F.col("published_date")
    minute, second = F.date_format(at, "yyyy-MM-dd HH:mm"), F.date_format(at, "yyyy-MM-dd HH:mm:ss")
    printed = F.date_format(at, "MMMM d, yyyy")
    junk = number % 5 == 4
    return news(spark, sf_dir).select(
        "link",
        F.element_at(F.array(*map(F.lit, PORTALS)), (number % 3 + 1).cast("int")).alias("source"),
        F.when(junk, F.array(F.lit("soon")))
        .when(number % 3 == 1, F.array(F.concat(F.lit("Published : "), F.when(number % 2 == 0, minute).otherwise(second))))
        .when(number % 2 == 0, F.array(F.lit("2025-13-45"), F.concat(F.replace(second, F.lit(" "), F.lit("T")), F.lit("+05:45"))))
        .otherwise(F.array(F.lit("today"), F.concat(F.date_format(at, "yyyy-MM-dd"), F.lit("T10:00+05:45"))))
        .alias("stamps"),
        F.when(junk & (number % 2 == 0), F.array(F.lit("later")))
        .when(number % 3 == 0, F.array(F.concat(F.lit("Updated. Published at : "), printed)))
        .otherwise(F.array(F.lit("x"), F.concat(F.lit("Tuesday, "), F.date_format(at, "MMM d, yyyy"))))
        .alias("long_dates"),
    )


def word_model() -> Model:
    """The same words as an external model."""

    def load():
        good, bad = re.compile(r"\bgood\b"), re.compile(r"\bbad\b")

        def predict(texts):
            return [
                ("positive", 1.0) if good.search(t.lower())
                else ("negative", 1.0) if bad.search(t.lower())
                else ("neutral", 0.0)
                for t in texts
            ]

        return predict

    return Model(load, key="test words")


def failing_model() -> Model:
    """A model that fails on the word bad."""

    def load():
        def predict(texts):
            if any(re.search(r"\bbad\b", t.lower()) for t in texts):
                raise RuntimeError("bad")
            return [("neutral", 0.5) for _ in texts]

        return predict

    return Model(load, key="failing test model")


cloudpickle.register_pickle_by_value(sys.modules[__name__])

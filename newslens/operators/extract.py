"""Landed HTML to listing links and articles.

One pass over the pages for all sites: the Python step picks the site's rule by the row's
source and returns the raw pieces; fallbacks, dates, joining and filtering are expressions.

The Python steps are declared nondeterministic. They are not, but otherwise a filter on their
result is pushed below them with a second copy of the step, and every page is parsed twice. They turn an
Arrow batch into Python strings by pieces of ``PIECE_BYTES`` of HTML, and return each piece's result before the next is read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from operator import or_
from urllib.parse import urljoin

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslens.functions import charset, dates
from newslens.functions.html import Found, Page, wanted
from newslens.rules import SITE_RULES, SiteRule

_PIECES = "title string, stamps array<string>, long_dates array<string>, paragraphs array<string>"
_LISTS = ("stamps", "long_dates", "paragraphs")
_P_TYPE = pa.struct([("title", pa.string()), *[(name, pa.list_(pa.string())) for name in _LISTS]])
#: HTML that a Python worker has as strings at once; a longer page is alone.
PIECE_BYTES = 1 << 20


def _article_reader(rule: SiteRule) -> Callable[[str], dict]:
    groups = [*rule.metadata, *((s,) for s in rule.stamps)]
    parts = wanted(*rule.title, rule.body, *rule.long_dates, *(s for g in groups for s in g))

    def value(element, attributes: tuple[str, ...]) -> str:
        given = (element.attrs.get(a, "").strip() for a in attributes)
        return next(filter(None, given), None) or element.text(rule.rendered)

    def read(html: str) -> dict:
        page = Page(html, parts, rule.rendered)
        heading = page.first(*rule.title)
        meta = [(page.first(*g), ("content", "datetime")) for g in rule.metadata]
        marked = [(page.first(s), ("datetime",)) for s in rule.stamps]
        long_dates = [page.first(s) for s in rule.long_dates]
        return {
            "title": heading.text(rule.rendered) if heading else None,
            "stamps": [value(element, names) for element, names in meta + marked if element],
            "long_dates": [d.text(rule.rendered) for d in long_dates if d],
            "paragraphs": [p.text(rule.rendered) for p in page.found[rule.body]],
        }

    return read


def _link_reader(rule: SiteRule) -> Callable[[str], list[str]]:
    parts = wanted(rule.links, *([rule.links_per] if rule.links_per else []))

    def read(html: str) -> list[str]:
        page = Page(html, parts)
        found = page.found[rule.links]
        if rule.links_per:
            first: dict[int, Found] = {}
            for link in found:
                for box in link.around():
                    first.setdefault(id(box), link)
            found = [first.get(id(box)) for box in page.found[rule.links_per]]
        elements = [f.parent if rule.link_from_parent else f.attrs for f in found if f]
        hrefs = [attrs.get("href", "") for attrs in elements]
        return [urljoin(rule.link_base, h) if h and rule.link_base else h for h in hrefs]

    return read


def _each(reader: Callable, rules: Sequence[SiteRule]) -> Callable:
    """Read with the rule of each row's source; None for pages that cannot be read."""
    by_source = {rule.source: reader(rule) for rule in rules}

    def one(source: str, html: str | bytes, header: str | None):
        try:
            return by_source[source](charset.decoded(html, header) if isinstance(html, bytes) else html)
        except AssertionError:  # the parser's way to reject broken declarations
            return None

    return one


def _some(html: pa.Array) -> Iterator[tuple[int, int]]:
    """(start, rows) of stretches of at most ``PIECE_BYTES``, or of one page."""
    start, size = 0, 0
    for at, n in enumerate(pc.binary_length(html).to_pylist()):
        if at > start and size + (n or 0) > PIECE_BYTES:
            yield start, at - start
            start, size = at, 0
        size += n or 0
    if len(html) > start:
        yield start, len(html) - start


def _read(one: Callable, batches: Iterator[tuple[pa.Array, ...]], kind: pa.DataType, none) -> Iterator[pa.Array]:
    """What ``one`` reads off each (source, html, header) of the batches, ``none`` for pages that cannot be read."""
    for batch in batches:
        for start, rows in _some(batch[1]):
            some = zip(*(column.slice(start, rows).to_pylist() for column in batch))
            yield pa.array([none if (found := one(*page)) is None else found for page in some], kind)


def _of_rules(df: DataFrame, rules: Sequence[SiteRule]) -> DataFrame:
    return df.filter(F.col("source").isin([r.source for r in rules]) & F.col("html").isNotNull())


def by_rule(rules: Sequence[SiteRule], value: Callable[[SiteRule], Column]) -> Column:
    """``value`` of the rule whose source the row has."""
    cases = [F.when(F.col("source") == r.source, value(r)) for r in rules]
    return F.coalesce(*cases)


def _header(pages: DataFrame) -> Column:
    """The page's ``content_type``, if the table has it."""
    return F.col("content_type") if "content_type" in pages.columns else F.lit(None).cast("string")


def pieces(pages: DataFrame, rules: Sequence[SiteRule] = SITE_RULES) -> DataFrame:
    """Adds the raw parts of each article page and drops its HTML.

    ``html`` is text, or the bytes that were fetched, with the HTTP header in ``content_type`` if there is one.
    """
    one = _each(_article_reader, rules)

    @F.arrow_udf(_PIECES)
    def read(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        return _read(one, batches, _P_TYPE, {})

    read = read.asNondeterministic()
    return (
        _of_rules(pages, rules)
        .withColumn("_p", read("source", "html", _header(pages)))
        .filter("_p.paragraphs IS NOT NULL")
        .select(*[c for c in pages.columns if c != "html"], "_p.*")
    )


def links(listing_pages: DataFrame, rules: Sequence[SiteRule] = SITE_RULES) -> DataFrame:
    """Listing pages (source, page_no, html) to their article links in page order."""
    one = _each(_link_reader, rules)

    @F.arrow_udf("array<string>")
    def read(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        return _read(one, batches, pa.list_(pa.string()), [])

    read = read.asNondeterministic()
    found = (
        _of_rules(listing_pages, rules)
        .withColumn("_links", read("source", "html", _header(listing_pages)))
        .select("source", "page_no", F.posexplode("_links").alias("pos", "url"))
    )
    return article_links(found, rules)


def article_links(found: DataFrame, rules: Sequence[SiteRule] = SITE_RULES) -> DataFrame:
    """Keep the links that lead to articles, by each site's address rules."""

    def url(rule: SiteRule) -> Column:
        return F.trim("url") if rule.link_prefix else F.col("url")

    def kept(rule: SiteRule) -> Column:
        keep = (F.col("source") == rule.source) & (F.col("url") != "")
        if rule.link_contains:
            keep &= F.col("url").contains(rule.link_contains)
        if rule.link_digits_after:
            tail = F.substring_index(F.rtrim("url", F.lit("/")), rule.link_digits_after, -1)
            keep &= tail.rlike("^[0-9]+$")
        if rule.link_prefix:
            keep &= F.trim("url").startswith(rule.link_prefix)
        return keep

    return found.filter(reduce(or_, [kept(r) for r in rules])).select(
        "source",
        F.col("page_no").cast("int").alias("page_no"),
        F.col("pos").cast("int").alias("pos"),
        by_rule(rules, url).alias("url"),
    )


def body(paragraphs: Column | str = "paragraphs") -> Column:
    """Trimmed, non-empty paragraphs, one per line."""
    # a bare F.trim would be handed the position as the characters to trim
    trimmed = F.transform(paragraphs, lambda p: F.trim(p))
    return F.array_join(F.filter(trimmed, lambda p: p != ""), "\n")


def parsed_date(rule: SiteRule) -> Column:
    """The first candidate of the page that reads as a date."""
    if rule.date_style == "label":
        return dates.full_month_date(dates.after_label(F.get("long_dates", F.lit(0))))
    if rule.date_style == "colon":
        return dates.stamp(dates.after_colon(F.get("stamps", F.lit(0))), need_time=True)
    return first_date("stamps", "long_dates")


def first_date(stamps: str, long_dates: str) -> Column:
    """Machine-written candidates in order, cut to seconds, then printed dates in order."""

    def machine(raw: Column) -> Column:
        return dates.stamp(F.translate(F.substring(raw, 1, 19), "T", " "))

    read = F.concat(F.transform(stamps, machine), F.transform(long_dates, dates.long_date))
    return F.get(F.array_compact(read), F.lit(0))


def date_text(rule: SiteRule) -> Column:
    """The date as text: what the site printed where that is kept, else the parsed time."""
    if rule.date_style == "colon":
        return F.coalesce(dates.after_colon(F.get("stamps", F.lit(0))), F.lit(""))
    return F.coalesce(dates.wall_time(F.col("published_date")), F.lit(""))


def articles(pages: DataFrame, rules: Sequence[SiteRule] = SITE_RULES) -> DataFrame:
    """Article pages (source, url, html) to articles, one row per readable page.

    A site without a default title drops pages that have no title or no readable date;
    the others keep them.
    """
    strict = [r.source for r in rules if r.title_default is None]
    return (
        pieces(pages, rules)
        .select(
            "source",
            F.coalesce("title", by_rule(rules, lambda r: F.lit(r.title_default))).alias("title"),
            F.col("url").alias("link"),
            body().alias("content"),
            by_rule(rules, parsed_date).alias("published_date"),
            "stamps",
        )
        .withColumn("date_text", by_rule(rules, date_text))
        .filter(
            ~F.col("source").isin(strict)
            | (F.col("title").isNotNull() & F.col("published_date").isNotNull())
        )
        .drop("stamps")
    )

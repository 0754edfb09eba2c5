
from __future__ import annotations

import functools
import importlib.util
import os
import re
import sys
import tempfile
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

import newslens as nl  # noqa: E402
import oracles  # noqa: E402
import testviews as tv  # noqa: E402
from newslens.functions import dates, text  # noqa: E402
from newslens.plans.confidence import labelled_counts  # noqa: E402
from newslens.plans.tracking import mentioned_totals  # noqa: E402
from newslens.sources import tables, workspace  # noqa: E402

# Queries over training data; the subpackage may be absent, or an empty folder.
_found = [importlib.util.find_spec(name) for name in ("newslens.llm", "corpus_pipeline")]
if all(spec and spec.origin for spec in _found):
    import corpus_pipeline  # noqa: E402
    from newslens.llm import queries as training_data  # noqa: E402
else:
    corpus_pipeline = training_data = None

COUNTED = nl.mentions.entities_of(nl.COUNT_RULES)

WEB = nl.SiteRule(
    source="web",
    title=("article h1", "h1"),
    title_default="No Title",
    body="article p",
    rendered=True,
)


def _shown(df: DataFrame) -> DataFrame:
    """Dates and times as text, so that every engine returns the same values."""
    forms = {T.TimestampNTZType: dates.wall_time, T.DateType: lambda c: c.cast("string")}
    return df.select(
        *[
            forms.get(type(f.dataType), lambda c: c)(F.col(f.name)).alias(f.name)
            for f in df.schema
        ]
    )


# --- cleaning and predicates --------------------------------------------------------


def clean_articles(spark, sf):
    """Null texts, both text orders, the day; every tenth title is missing."""
    news = tv.news(spark, sf).withColumn(
        "title", F.when(~F.col("link").endswith("0"), F.col("title"))
    )
    rows = nl.clean.with_day(nl.clean.no_null_text(news))
    return _shown(
        rows.select(
            "link", "title", "date",
            text.full_text().alias("full_text"), text.search_text().alias("search_text"),
        )
    )


def lenient_dates(spark, sf):
    return _shown(nl.clean.with_dates(tv.printed_dates(spark, sf)).select("link", "published_date"))


def dated_articles(spark, sf):
    return _shown(nl.clean.dated(tv.printed_dates(spark, sf)).select("link", "published_date"))


def recent_articles(spark, sf):
    rows = nl.clean.recent(nl.clean.with_dates(tv.printed_dates(spark, sf)), tv.AS_OF)
    return _shown(rows.select("link", "published_date"))


def keyword_filter(spark, sf):
    return nl.clean.with_keywords(tv.news(spark, sf), nl.KEYWORDS).select("link", "title")


def context_gate(spark, sf):
    full = tv.news(spark, sf).select("link", text.full_text().alias("t"))
    gated = {r.pattern.strip("\\b"): r for r in nl.COUNT_RULES if r.context}
    return full.select(
        "link",
        *[
            text.count_matches(F.col("t"), r.pattern, r.needs, r.context).alias(word)
            for word, r in gated.items()
        ],
    )


# --- mentions -----------------------------------------------------------------------


def mention_counts(spark, sf):
    tracked = nl.track_mentions(tv.news(spark, sf))
    return nl.expand_counts(tracked, COUNTED).select("link", *COUNTED)


def mention_totals(spark, sf):
    return nl.mention_totals(nl.track_mentions(tv.news(spark, sf)), COUNTED)


def articles_naming(spark, sf):
    variants = nl.LEADER_VARIANTS + nl.PARTY_VARIANTS
    return nl.mentions.article_counts(tv.news(spark, sf), variants)


def daily_mentions(spark, sf):
    return _shown(nl.daily_mentions(tv.news(spark, sf), nl.LEADER_VARIANTS))


def daily_mentions_parties(spark, sf):
    return _shown(nl.daily_mentions(tv.news(spark, sf), nl.PARTY_VARIANTS, last_days=60))


def daily_mentions_of_results(spark, sf):
    """The days of the parties in a result table: one is left out, one is never mentioned."""
    unmentioned = oracles.UNMENTIONED
    patterns = [p for p in nl.PARTY_PATTERNS if p.entity != "RSP"] + [unmentioned]
    variants = [*nl.PARTY_VARIANTS, nl.Variants(unmentioned.entity, unmentioned.needs)]
    news = tv.news(spark, sf)
    results = nl.confidence_index(news, patterns, tv.TONE)
    return _shown(nl.daily_mentions(news, variants, results=results))


def coverage_ratio(spark, sf):
    return nl.coverage_ratio(tv.news(spark, sf))


# --- the same with rules as tables of any number ------------------------------------


def keyword_filter_table(spark, sf):
    keywords = spark.createDataFrame([(k,) for k in nl.KEYWORDS], "keyword string")
    return nl.clean.with_keywords(tv.news(spark, sf), keywords).select("link", "title")


def mention_counts_table(spark, sf):
    tracked = nl.track_mentions(tv.news(spark, sf), tv.rule_table(spark, nl.COUNT_RULES))
    return nl.expand_counts(tracked, COUNTED).select("link", *COUNTED)


def sentence_mentions_table(spark, sf):
    patterns = tv.rule_table(spark, nl.LEADER_PATTERNS)
    return _shown(nl.sentence_mentions(tv.news(spark, sf), patterns, tv.TONE))


def term_mentions(spark, sf):
    """Hits of each of the many terms that titles hold, each a rule of its own."""
    pattern = F.concat(F.lit(r"\b"), "term", F.lit(r"\b")).alias("pattern")
    rules = tv.title_terms(spark, sf).select(F.col("term").alias("entity"), pattern)
    return mentioned_totals(nl.track_mentions(tv.news(spark, sf), rules))


def articles_naming_table(spark, sf):
    variants = tv.variant_table(spark, nl.LEADER_VARIANTS + nl.PARTY_VARIANTS)
    return nl.phrases.article_counts(tv.news(spark, sf), variants)


def daily_mentions_table(spark, sf):
    variants = tv.variant_table(spark, nl.LEADER_VARIANTS)
    return _shown(nl.phrases.daily_mentions(tv.news(spark, sf), variants))


def coverage_ratio_table(spark, sf):
    pairs = [(p, leader) for p, leaders in nl.PARTY_LEADERS.items() for leader in leaders]
    pairs = spark.createDataFrame(pairs, "party string, leader string")
    parties, leaders = (tv.variant_table(spark, v) for v in (nl.PARTY_VARIANTS, nl.LEADER_VARIANTS))
    return nl.phrases.coverage_ratio(tv.news(spark, sf), pairs, parties, leaders)


def term_articles(spark, sf):
    """Articles that hold each of the many terms that titles hold, joined by word."""
    variants = tv.title_terms(spark, sf).select(F.col("term").alias("entity"), F.col("term").alias("variant"))
    return nl.phrases.article_counts(tv.news(spark, sf), variants)


# --- sentiment and the index --------------------------------------------------------


def sentence_split(spark, sf):
    return nl.mentions.sentence_rows(tv.news(spark, sf), "link")


def sentence_mentions(spark, sf):
    return _shown(nl.sentence_mentions(tv.news(spark, sf), nl.LEADER_PATTERNS, tv.TONE))


def sentence_mentions_model(spark, sf):
    rows = nl.sentence_mentions(tv.news(spark, sf), nl.PARTY_PATTERNS, tv.word_model())
    return _shown(rows)


def article_sentiment(spark, sf):
    rows = nl.label_articles(tv.news(spark, sf), tv.TONE)
    return rows.select("link", "sentiment", "confidence")


def article_sentiment_512(spark, sf):
    """The original scorer's limit of 512 characters."""
    rows = nl.label_articles(tv.news(spark, sf), tv.TONE, nl.plans.labels.MAX_CHARS)
    return rows.select("link", "sentiment", "confidence")


def article_sentiment_errors(spark, sf):
    rows = nl.label_articles(tv.news(spark, sf), tv.failing_model())
    return rows.select("link", "sentiment", "confidence")


def article_sentiment_model(spark, sf):
    rows = nl.label_articles(tv.news(spark, sf), tv.word_model())
    return rows.select("link", "sentiment", "confidence")


def label_windows(spark, sf):
    return labelled_counts(tv.news(spark, sf), nl.LEADER_PATTERNS, scorer=tv.TONE)


def confidence_leaders(spark, sf):
    return nl.confidence_index(tv.news(spark, sf), nl.LEADER_PATTERNS, tv.TONE)


def confidence_parties(spark, sf):
    news = tv.news(spark, sf)
    return nl.confidence_index(news, nl.PARTY_PATTERNS, tv.TONE, keep_unmentioned=False)


def confidence_with_unmentioned(spark, sf):
    patterns = (*nl.PARTY_PATTERNS, oracles.UNMENTIONED)
    return nl.confidence_index(tv.news(spark, sf), patterns, tv.TONE)


def confidence_model(spark, sf):
    return nl.confidence_index(tv.news(spark, sf), nl.LEADER_PATTERNS, tv.word_model())


def confidence_both(spark, sf):
    """Leaders and parties in one pass, twice over one label store; what the second run scored is a column."""
    scorer, sets = tv.word_model(), {"leaders": nl.LEADER_PATTERNS, "parties": nl.PARTY_PATTERNS}
    store = nl.LabelStore(spark, workspace.new_path(spark, "labels"), scorer.key)
    nl.confidence_indexes(tv.news(spark, sf), sets, scorer, store)
    before = len(store.deltas.paths())
    again = nl.confidence_indexes(tv.news(spark, sf), sets, scorer, store)
    return again.withColumn("new_deltas", F.lit(len(store.deltas.paths()) - before))


def confidence_by_day(spark, sf):
    """The index at each day, from the cubes of older and newer articles, merged."""
    news = tv.news(spark, sf)
    split = F.col("published_date") < F.lit("2025-02-14").cast("timestamp_ntz")
    halves = [
        workspace.written(nl.cube.cube(news.filter(part), nl.LEADER_PATTERNS, tv.TONE), "cube")
        for part in (split, ~split)
    ]
    entities = nl.mentions.entities_of(nl.LEADER_PATTERNS)
    return _shown(nl.cube.index_by_day(nl.cube.merge(*halves), entities=entities))


def _scenario(spark, sf, patterns=nl.LEADER_PATTERNS):
    return nl.scenario(nl.confidence_index(tv.news(spark, sf), patterns, tv.TONE), 0.5, 0.2, 0.6)


def scenario_ranking(spark, sf):
    return nl.ranking(_scenario(spark, sf)).drop("entity")


def momentum_trend(spark, sf):
    return nl.momentum_trend(_scenario(spark, sf, nl.PARTY_PATTERNS))


def gauges(spark, sf):
    return nl.gauges(_scenario(spark, sf))


# --- pages and listings -------------------------------------------------------------


def listing_links(spark, sf):
    return nl.extract.links(tv.listing_pages(spark, sf))


def _web_articles(spark, sf):
    pages = tv.table(spark, sf, "pages").withColumn("source", F.lit(WEB.source))
    return nl.extract.articles(pages, [WEB])


def page_titles(spark, sf):
    return _web_articles(spark, sf).select("link", "title")


def page_bodies(spark, sf):
    return _web_articles(spark, sf).select("link", "content")


def titles_of_bytes(spark, sf):
    pages = tv.fetched_bytes(spark, sf).withColumn("source", F.lit(WEB.source))
    return nl.extract.articles(pages, [WEB]).select("link", "title")


def parse_dates(spark, sf):
    rules = nl.SITE_RULES
    rows = tv.date_candidates(spark, sf).withColumn(
        "published_date", nl.extract.by_rule(rules, nl.extract.parsed_date)
    )
    return _shown(
        rows.select(
            "link", "published_date",
            nl.extract.by_rule(rules, nl.extract.date_text).alias("date_text"),
        )
    )


def url_first_seen(spark, sf):
    return nl.listing.first_seen(tv.listing(spark, sf))


def url_new_on_page(spark, sf):
    return nl.listing.not_on_earlier_page(tv.listing(spark, sf))


def url_new_on_page_salted(spark, sf):
    return nl.listing.not_on_earlier_page(tv.hot_listing(spark, sf), salted=True)


def resumed_walk(spark, sf):
    """The listing walked in two runs, the second going on from the first."""
    links = workspace.written(tv.listing(spark, sf), "listing")
    store = nl.walks.WalkStore(spark, workspace.new_path(spark, "walked"))
    last = links.agg(F.max("page_no")).first()[0] or 0
    runs = [nl.walks.go_on(links, store, upto) for upto in (last // 2, last)]
    return runs[0].unionByName(runs[1])


def stop_when_exhausted(spark, sf):
    return nl.listing.until_exhausted(tv.listing(spark, sf))


def stop_without_first_page(spark, sf):
    return nl.listing.until_exhausted(tv.late_listing(spark, sf), tv.PORTALS)


def page_cap(spark, sf):
    return nl.listing.capped(tv.listing(spark, sf), nl.rules.KATHMANDU_PAGES)


def cutoff_immediate(spark, sf):
    return _shown(nl.listing.cutoff(tv.walk(spark, sf), "immediate", tv.AS_OF))


def cutoff_page_end(spark, sf):
    rows = nl.listing.cutoff(tv.walk(spark, sf), "page_end", tv.AS_OF, sources=tv.PORTALS)
    return _shown(rows)


def build_articles(spark, sf):
    rows = nl.build_articles(
        tv.portal_pages(spark, sf), tv.portal_links(spark, sf), as_of=tv.AS_OF
    )
    return _shown(rows)


def articles_from_listings(spark, sf):
    links = nl.extract.links(tv.listing_pages(spark, sf))
    return _shown(nl.build_articles(tv.listed_pages(spark, sf), links, as_of=tv.AS_OF))


# --- sources and sinks --------------------------------------------------------------


def union_sources(spark, sf):
    walk = tv.walk(spark, sf)
    return _shown(tables.union_sources(*[walk.filter(F.col("source") == s) for s in tv.PORTALS]))


def run_summary(spark, sf):
    return tables.run_summary(nl.clean.with_dates(tv.printed_dates(spark, sf)))


def csv_articles(spark, sf):
    path = workspace.new_path(spark, "articles-csv")
    tables.write_articles(tv.news(spark, sf), path, form="csv")
    return _shown(tables.read_articles(spark, path, form="csv"))


def csv_by_header(spark, sf):
    """Columns in another order and more of them, as other tools write them."""
    path = workspace.new_path(spark, "reordered-csv")
    news = tv.news(spark, sf).withColumn("extra", F.lit("x"))
    tables.write_articles(news.select(*sorted(news.columns)), path, form="csv")
    return _shown(tables.read_articles(spark, path, form="csv"))


def csv_tracked(spark, sf):
    path = workspace.new_path(spark, "tracked-csv")
    tables.write_tracked(nl.track_mentions(tv.news(spark, sf)), path, form="csv")
    rows = tables.read_tracked(spark, path, COUNTED, form="csv")
    return nl.expand_counts(rows.drop(*COUNTED), COUNTED).select("link", "full_text", *COUNTED)


def csv_labelled(spark, sf):
    path = workspace.new_path(spark, "labelled-csv")
    tables.write_labelled(nl.label_articles(tv.news(spark, sf), tv.TONE), path, form="csv")
    rows = tables.read_labelled(spark, path, form="csv")
    return rows.select("link", "sentiment", "confidence")


def csv_results(spark, sf):
    path = workspace.new_path(spark, "results-csv")
    tables.write_results(confidence_leaders(spark, sf), path, "Leader")
    return tables.read_results(spark, path, "Leader")


def articles_by_day(spark, sf):
    """Recent articles from a store by day, into which older and newer halves went, and all once more."""
    path = workspace.new_path(spark, "by-day")
    news = tv.news(spark, sf)
    even = F.substring_index("link", "/", -1).cast("bigint") % 2 == 0
    tables.write_by_day(news.filter(even), path)
    tables.add_by_day(news.filter(~even), path)
    tables.add_by_day(news, path)
    return _shown(tables.read_recent(spark, path, tv.AS_OF))


def article_rank(spark, sf):
    """Every article's place by the length of its content, over the whole table."""
    rows = tv.news(spark, sf).select("link", F.length("content").cast("bigint").alias("chars"))
    return nl.order.global_rank(rows, F.desc("chars"), F.asc("link"))


def article_share(spark, sf):
    """Every article's share of its source's characters."""
    rows = tv.news(spark, sf).select("link", "source", F.length("content").cast("bigint").alias("chars"))
    shares = nl.order.with_share(rows, "chars", by=["source"])
    return shares.select("link", F.round("share", 6).alias("share"))


def landed_pages(spark, sf):
    path = workspace.new_path(spark, "landed")
    tv.portal_pages(spark, sf).write.parquet(path)
    return tables.read_landed_pages(spark, path).drop("html")


_QUERIES = (
    clean_articles, lenient_dates, dated_articles, recent_articles, keyword_filter, context_gate,
    mention_counts, mention_totals, articles_naming, daily_mentions, daily_mentions_parties,
    daily_mentions_of_results, confidence_with_unmentioned, article_sentiment_512,
    article_sentiment_errors, stop_without_first_page, articles_from_listings, csv_by_header,
    coverage_ratio, sentence_split, sentence_mentions, sentence_mentions_model,
    article_sentiment, article_sentiment_model, label_windows, confidence_leaders,
    confidence_parties, confidence_model, scenario_ranking, momentum_trend, gauges,
    listing_links, page_titles, page_bodies, parse_dates, url_first_seen, url_new_on_page,
    stop_when_exhausted, page_cap, cutoff_immediate, cutoff_page_end, build_articles,
    union_sources, run_summary, csv_articles, csv_tracked, csv_labelled, csv_results,
    landed_pages, keyword_filter_table, mention_counts_table, sentence_mentions_table, term_mentions,
    articles_naming_table, daily_mentions_table, coverage_ratio_table, term_articles,
    confidence_both, confidence_by_day, titles_of_bytes, url_new_on_page_salted, resumed_walk,
    articles_by_day, article_rank, article_share,
)


def entry(spark: SparkSession) -> DataFrame:
    """The confidence index of the leaders."""
    return queries()["confidence_leaders"](spark, "/root/testdata/sf0.001")


def _with_folder(query: Callable) -> Callable:
    """A local session without ``spark.checkpoint.dir`` gets a folder; a cluster must name one."""

    @functools.wraps(query)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        context = spark.sparkContext
        unset = not (spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir())
        if unset and re.match(r"local(\[|$)", context.master):
            context.setCheckpointDir(tempfile.mkdtemp(prefix="newslens-"))
        return query(spark, sf)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every query by name."""
    own = {q.__name__: q for q in _QUERIES}
    if training_data:
        own |= training_data.queries() | {"pipeline": corpus_pipeline.run}
    return {name: _with_folder(query) for name, query in own.items()}


def oracle_sql() -> dict[str, str]:
    """The same queries in SQL, where it can express them."""
    own = oracles.all_queries()
    if training_data:
        own |= training_data.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            own["pipeline"] = corpus_pipeline.ORACLE_SQL
    return own

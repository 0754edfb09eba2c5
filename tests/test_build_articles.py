"""The whole walk against opening the pages one after the other in plain Python."""

import datetime as dt
import random

import pytest

import newslens as nl

AS_OF = dt.datetime(2025, 4, 1)
EDGE = AS_OF - dt.timedelta(days=60)
K, S, O = "Kathmandu Post", "Setopati", "OnlineKhabar"  # noqa: E741
LAYOUT = {
    K: '<div class="col-sm-8">{h1}</div><i class="updated-time">Published at : {date}</i>'
       '<section class="story-section"><p>{text}</p></section>',
    S: '<span class="news-big-title">{title}</span><span class="pub-date">P: {date}</span>'
       '<div class="editor-box"><p>{text}</p></div>',
    O: '<h1>{title}</h1><time>{date}</time><div class="ok-single-post-content"><p>{text}</p></div>',
}
FORMAT = {K: "%B %d, %Y", S: "%Y-%m-%d %H:%M", O: "%Y-%m-%d"}


def world(seed):
    """Pages by (source, url) and links by (source, page, place)."""
    rng = random.Random(seed)
    pages, links = {}, []
    for source in (K, S, O):
        for page in range(1, 15):
            if rng.random() < (0.2 if page == 1 and seed else 0.03):
                continue
            for place in range(rng.randint(1, 5)):
                url = f"{source[0]}{page * 10 + rng.randint(-12, 4)}"
                links.append((source, page, place, url))
        for url in {u for s, _, _, u in links if s == source}:
            age = int(url[1:]) // 3 + rng.randint(0, 20)
            pages[source, url] = {
                "date": None if rng.random() < 0.1 else AS_OF - dt.timedelta(days=age),
                "status": 404 if rng.random() < 0.1 else 200,
                "title": rng.choice(["t", None]) if rng.random() < 0.2 else "t",
                "text": rng.choice(["the election", "the weather"]),
            }
    return pages, links


def html(source, page):
    date = page["date"].strftime(FORMAT[source]) if page["date"] else "soon"
    h1 = f"<h1>{page['title']}</h1>" if page["title"] else ""
    return LAYOUT[source].format(title=page["title"] or "", h1=h1, date=date, text=page["text"])


def walk(source, pages, links):
    """What a reader following the site's rules keeps."""
    mine = sorted(x for x in links if x[0] == source)
    kept, seen = [], set()

    def old(page):
        return page["date"] is not None and page["date"] < EDGE

    if source == K:
        for _, number, _, url in mine:
            page = pages[source, url]
            if url in seen:
                continue
            seen.add(url)
            if page["date"] is None or not page["title"]:
                continue
            if old(page):
                return kept
            if "election" in page["text"]:
                kept.append(url)
        return kept
    number = 1
    while fresh := [x[3] for x in mine if x[1] == number and x[3] not in seen]:
        ended = False
        for url in fresh:
            seen.add(url)
            page = pages[source, url]
            if page["status"] != 200:
                continue
            if old(page):
                ended = True
                if source == O:
                    return kept
                continue
            kept.append(url)
        if ended:
            return kept
        number += 1
    return kept


@pytest.mark.parametrize("seed", range(5))
def test_against_plain_walk(spark, seed):
    pages, links = world(seed)
    landed = spark.createDataFrame(
        [(s, u, p["status"], html(s, p)) for (s, u), p in pages.items()], nl.schemas.LANDED_PAGE
    )
    listing = spark.createDataFrame(links, nl.schemas.LISTING)
    got = nl.build_articles(landed, listing, as_of=AS_OF)
    assert got.columns == [*nl.schemas.ARTICLE.names, "date_text"]
    rows = got.collect()
    want = sorted((s, u) for s in (K, S, O) for u in walk(s, pages, links))
    assert sorted((r.source, r.link) for r in rows) == want
    for r in rows:
        page = pages[r.source, r.link]
        assert r.content == page["text"]
        assert r.published_date == page["date"]


def test_page_cap_and_status_are_rules(spark):
    import dataclasses

    page = {"date": dt.datetime(2025, 3, 5), "status": 200, "title": "Vote", "text": "x"}
    landed = [(K, f"u{n}", 404 if n == 2 else 200, html(K, page)) for n in range(1, 14)]
    links = [(K, n, 0, f"u{n}") for n in range(1, 14)]
    landed, links = (
        spark.createDataFrame(landed, nl.schemas.LANDED_PAGE), spark.createDataFrame(links, nl.schemas.LISTING)
    )
    got = lambda rule: nl.build_articles(landed, links, [rule], AS_OF).count()
    rule = nl.rules.KATHMANDU_POST
    assert got(rule) == 13
    assert got(dataclasses.replace(rule, page_cap=nl.rules.KATHMANDU_PAGES)) == 11
    assert got(dataclasses.replace(rule, status=200)) == 12


def test_pages_are_parsed_once_and_only_if_linked(spark, monkeypatch):
    from newslens.operators import extract

    counts = {"links": spark.sparkContext.accumulator(0), "pages": spark.sparkContext.accumulator(0)}

    def counted(reader, count):
        def make(rule):
            one = reader(rule)

            def run(text):
                count.add(1)
                return one(text)

            return run

        return make

    monkeypatch.setattr(extract, "_link_reader", counted(extract._link_reader, counts["links"]))
    monkeypatch.setattr(extract, "_article_reader", counted(extract._article_reader, counts["pages"]))
    card = '<a class="ok-post-image" href="https://english.onlinekhabar.com/{0}.html"></a>'
    listing = [(O, n, f'<div class="ok-news-post ltr-post">{card.format(n)}</div>') for n in range(1, 41)]
    listing += [(S, n, "<p>nothing</p>") for n in range(1, 11)]
    page = {"date": dt.datetime(2025, 3, 5), "status": 200, "title": "Vote", "text": "x"}
    url = "https://english.onlinekhabar.com/{0}.html"
    landed = [(O, url.format(n), 200, html(O, page)) for n in range(1, 121)]
    links = nl.extract.links(spark.createDataFrame(listing, nl.schemas.LISTING_PAGE))
    built = nl.build_articles(spark.createDataFrame(landed, nl.schemas.LANDED_PAGE), links, as_of=AS_OF)
    assert built.count() == 40
    assert (counts["links"].value, counts["pages"].value) == (50, 40)


def test_listing_to_articles(spark):
    """Listing pages and article pages together."""
    card = '<article class="article-image"><a href="/politics/{0}"><h3>x</h3></a></article>'
    listing = [(K, 1, '<div id="news-list">' + card.format(1) + card.format(2) + "</div>")]
    page = {"date": dt.datetime(2025, 3, 5), "status": 200, "title": "Vote", "text": "x"}
    landed = [(K, f"https://kathmandupost.com/politics/{i}", 200, html(K, page)) for i in (1, 2, 3)]
    links = nl.extract.links(spark.createDataFrame(listing, nl.schemas.LISTING_PAGE))
    rows = nl.build_articles(
        spark.createDataFrame(landed, nl.schemas.LANDED_PAGE), links, as_of=AS_OF
    ).collect()
    assert sorted(r.link[-1] for r in rows) == ["1", "2"]
    assert {(r.title, r.date_text) for r in rows} == {("Vote", "2025-03-05 00:00:00")}

"""Reading pages: one golden page per site, and the differences between their rules."""

import datetime as dt

import pytest

import newslens as nl
from newslens.functions.html import Page, wanted
from newslens.sources.tables import fetched

K, S, O = "Kathmandu Post", "Setopati", "OnlineKhabar"  # noqa: E741


def read(spark, *pages):
    df = spark.createDataFrame([(s, f"u{i}", 200, h) for i, (s, h) in enumerate(pages)],
                               "source string, url string, status int, html string")
    return {r.link: r for r in nl.extract.articles(fetched(df)).collect()}


def kathmandu(title="<h1>Poll <b>KP</b>  Oli</h1>", date="Published at : December 5, 2025"):
    return f"""<html><body><h1>site</h1><div class="row col-sm-8"><div>{title}</div></div>
      <div class="x updated-time">Updated at : now Published at : x {date}</div>
      <section class="story-section"><p> One <i>t</i>wo<br>three <p>open<p> </p><div><p>Deep</p></div>
      </section><p>outside</p></body></html>"""


def test_kathmandu(spark):
    got = read(spark, (K, kathmandu()), (K, kathmandu(title="")), (K, kathmandu(date="soon")))
    assert list(got) == ["u0"]  # no title, no date: dropped
    row = got["u0"]
    assert row.title == "Poll KP Oli"
    assert row.content == "One two\nthree\nopen\nDeep"
    assert row.published_date == dt.datetime(2025, 12, 5)
    assert row.date_text == "2025-12-05 00:00:00"


def setopati(date):
    return f"""<span class="news-big-title big"> <b>KP</b> Oli </span><span class="pub-date">{date}</span>
      <div class="editor-box"><p>a &amp; <b> b </b></p><p>  </p><p>open<p>nested</p></div>"""


def test_setopati(spark):
    got = read(
        spark,
        (S, setopati("Published: 2025-12-22 14:05")),
        (S, setopati("2025-12-22")),
        (S, setopati("a: b: c")),
        (S, "<p>nothing</p>"),
    )
    assert got["u0"].title == "KPOli"
    # an unclosed paragraph holds the following one
    assert got["u0"].content == "a &b\nopennested\nnested"
    assert got["u0"].published_date == dt.datetime(2025, 12, 22, 14, 5)
    assert got["u0"].date_text == "2025-12-22 14:05"
    # a date without a time holds no colon to cut at and is not a form of this site
    assert (got["u1"].published_date, got["u1"].date_text) == (None, "2025-12-22")
    assert (got["u2"].published_date, got["u2"].date_text) == (None, "b: c")
    assert (got["u3"].title, got["u3"].content, got["u3"].date_text) == ("No Title", "", "")


@pytest.mark.parametrize(
    "head, expected",
    [
        ('<meta property="article:published_time" content="2025-12-23T10:00:30+05:45">', (23, 10, 30)),
        ('<meta name="datePublished" content="2025-12-23">', (23, 0, 0)),
        ('<b itemprop="datePublished" datetime="2025-12-23 10:00"></b>', (23, 10, 0)),
        ('<b itemprop="datePublished">2025-12-23 10:00</b>', (23, 10, 0)),
        ('<meta property="datePublished" content="bad"><time>2025-12-24</time>', (24, 0, 0)),
        # an offset behind minutes reaches into the cut and fails the machine forms
        ('<meta name="datePublished" content="2025-12-23T10:00+05:45"><time>2025-12-24</time>', (24, 0, 0)),
        ('<time>x</time><time datetime="2025-12-21">y</time>', (21, 0, 0)),
        ('<time>2025-12-20</time><time datetime="2025-12-21">y</time>', (21, 0, 0)),
        ('<span class="ok-post-date">Tuesday, December 23, 2025</span>', (23, 0, 0)),
        ('<div class="ok-single-post-meta"><i><span>Dec 23, 2025</span></i></div>', (23, 0, 0)),
        ('<div class="post-infos"><span>December 23, 2025</span></div>', (23, 0, 0)),
        ('<span class="date">December 23, 2025</span>', None),
        ("", None),
    ],
)
def test_khabar_dates(spark, head, expected):
    row = read(spark, (O, head + '<h1>T</h1><div class="ok-single-post-content"><p>x</p></div>'))["u0"]
    assert (row.title, row.content) == ("T", "x")
    if expected is None:
        assert (row.published_date, row.date_text) == (None, "")
    else:
        day, hour, second = expected
        minute = 0
        assert row.published_date == dt.datetime(2025, 12, day, hour, minute, second)
        assert row.date_text == f"2025-12-{day:02} {hour:02}:00:{second:02}"


def test_failed_fetches_and_unknown_sources_are_left_out(spark):
    rows = [(S, "a", 404, "<p>x</p>"), ("Else", "b", 200, "<p>x</p>"), (S, "c", 200, None)]
    df = spark.createDataFrame(rows, "source string, url string, status int, html string")
    assert nl.extract.articles(fetched(df)).count() == 0


def links(spark, source, html):
    df = spark.createDataFrame([(source, 3, html)], "source string, page_no int, html string")
    return [(r.page_no, r.url) for r in nl.extract.links(df).orderBy("pos").collect()]


def test_listing_links(spark):
    grid = '<div class="row bishesh news-cat-list"><div class="items">{}</div></div>'
    inside = "".join(
        f'<a href="{h}">x</a>'
        for h in ("https://a/political/12/", "/political/7//", "/political/x1", "/sport/3", "")
    )
    html = '<div class="items"><a href="/political/1"></a></div>' + grid.format(inside + "<a>no</a>")
    assert links(spark, S, html) == [(3, "https://a/political/12/"), (3, "/political/7//")]

    post = '<div class="a ok-news-post ltr-post">{}</div>'
    base = "https://english.onlinekhabar.com/"
    html = (
        post.format(f'<p><a class="ok-post-image" href=" {base}one "></a><a class="ok-post-image" href="{base}two"></a>')
        + post.format(f'<a href="{base}three"></a>')
        + post.format('<a class="ok-post-image" href="http://english.onlinekhabar.com/four"></a>')
    )
    assert links(spark, O, html) == [(3, base + "one")]

    card = '<article class="article-image">{}</article>'
    html = '<div id="news-list">' + "".join(
        card.format(c)
        for c in ('<a href="/politics/1"><h3>t</h3></a>', '<a><h3>t</h3></a>',
                  '<a href="https://x.example/2"><span><h3>t</h3></span></a>',
                  '<a href="https://x.example/3"><h3>t</h3></a>')
    ) + "</div>" + card.format('<a href="/politics/9"><h3>t</h3></a>')
    assert links(spark, K, html) == [
        (3, "https://kathmandupost.com/politics/1"), (3, "https://x.example/3")
    ]


def test_page_reader_edges():
    page = Page("<p>a<script>b</script>c<!-- d -->e &lt;f&gt; &eacute;<br/>g", wanted("p"), True)
    assert [f.text(True) for f in page.found["p"]] == ["ace <f> é\ng"]
    page = Page("</p></div><p>a</b>b</p>tail", wanted("p", "i"))
    assert [f.text(False) for f in page.found["p"]] == ["ab"]
    assert page.first("i", "p").text(False) == "ab" and page.first("i") is None
    assert Page("", wanted("p")).found == {"p": []}


def test_a_batch_is_read_in_pieces():
    """A worker has few pages as strings at once, however many a batch holds; long and null pages come through."""
    import pyarrow as pa
    from newslens.operators import extract

    pages = ["x" * 20_000] * 200 + [None, "", "y" * (3 * extract.PIECE_BYTES), "z"]
    batch = tuple(pa.array(c, pa.string()) for c in (["s"] * len(pages), pages, [None] * len(pages)))
    assert [rows for _, rows in extract._some(batch[1])] == [52, 52, 52, 46, 1, 1]
    read = []

    def one(source, html, header):
        read.append(html)
        return None if html is None else [html[:1], str(len(html))]

    parts = extract._read(one, iter([batch, tuple(c.slice(0, 0) for c in batch)]), pa.list_(pa.string()), [])
    first = next(parts)
    assert len(first) == len(read) == 52  # the others are not yet read
    rows = first.to_pylist() + [r for part in parts for r in part.to_pylist()]
    assert rows == [[] if p is None else [p[:1], str(len(p))] for p in pages]

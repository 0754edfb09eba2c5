"""The steps one after the other, as from a shell."""

import pytest
from test_build_articles import AS_OF, K, html

import newslens as nl
from newslens.__main__ import main
from newslens.sources import tables


@pytest.mark.parametrize("form", ["csv", "parquet"])
def test_from_pages_to_ranking(spark, tmp_path, form):
    import datetime as dt

    page = {"date": dt.datetime(2025, 3, 5), "status": 200, "title": "Vote, Balen",
            "text": "Balen Shah is good. UML bad; oli"}
    url = "https://kathmandupost.com/politics/1"
    card = '<div id="news-list"><article class="article-image"><a href="/politics/1"><h3/></a></article></div>'
    at = lambda name: str(tmp_path / name)
    spark.createDataFrame([(K, url, 200, html(K, page))], nl.schemas.LANDED_PAGE).write.parquet(at("p"))
    spark.createDataFrame([(K, 1, card)], nl.schemas.LISTING_PAGE).write.parquet(at("l"))
    news, out = at(f"news.{form}"), f".{form}"
    main(["articles", "--pages", at("p"), "--listing-pages", at("l"), "--out", news, "--as-of", str(AS_OF)])
    assert tables.read_articles(spark, news, form).collect()[0].link == url
    main(["track", "--articles", news, "--out", at("tracked" + out), "--totals", at("totals")])
    totals = {r.entity: r.mentions for r in spark.read.parquet(at("totals")).collect()}
    assert set(totals) == set(nl.mentions.entities_of(nl.COUNT_RULES)) and totals["Balen_Shah"] > 0
    words = ["--positive", "good", "--negative", "bad"]
    main(["label", "--articles", news, "--out", at("labelled" + out), *words])
    assert tables.read_labelled(spark, at("labelled" + out), form).collect()[0].sentiment == "positive"
    for view, best in (("Leader", "Balen_Shah"), ("Party", "CPN_UML")):
        main(["confidence", "--articles", news, "--view", view, "--out", at(view), *words])
        ranked = at(f"{view}-ranking")
        main(["ranking", "--results", at(view), "--view", view, "--weights", "1", "0", "0", "--out", ranked])
        assert {r.name: r["rank"] for r in spark.read.parquet(f"{ranked}/ranking").collect()}[best] == 1
        for table in ("momentum_trend", "gauges"):
            assert best in {r.name for r in spark.read.parquet(f"{ranked}/{table}").collect()}
    main(["daily", "--articles", news, "--out", at("days"), "--last-days", "5", "--results", at("Leader")])
    assert [r.entity for r in spark.read.parquet(at("days")).collect()] == ["Balen_Shah"]
    main(["ratio", "--articles", news, "--out", at("ratio")])
    assert spark.read.parquet(at("ratio")).count() == 3
    with pytest.raises(Exception):
        main(["daily", "--articles", news, "--out", at("days")])

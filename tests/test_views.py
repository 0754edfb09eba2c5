"""Scenario, ranking, trend, daily counts and ratios."""

import datetime as dt

import pytest
from test_confidence import LEADERS, PARTIES

import newslens as nl


def results(spark, rows):
    return spark.createDataFrame(rows, nl.schemas.RESULT)


def test_scenario_of_published_results(spark):
    got = {r.name: r.scenario_score for r in nl.scenario(results(spark, LEADERS)).collect()}
    assert got == {"KP_Oli": 0.023, "Balen_Shah": 0.098, "Gagan_Thapa": 0.115}
    volume = nl.scenario(results(spark, PARTIES), 0, 1, 0).collect()
    assert all(r.scenario_score == r.volume_score for r in volume)


def test_weights(spark):
    df = results(spark, LEADERS)
    one = nl.scenario(df, 0.2, 0.4, 0.1).collect()
    assert one == nl.scenario(df, 0.8, 1.6, 0.4).collect()
    with pytest.raises(ValueError):
        nl.scenario(df, 0, 0, 0)


def test_scenario_by_title(spark):
    df = results(spark, PARTIES).withColumnRenamed("entity", "Party")
    assert [r.name for r in nl.scenario(df, name="Party").collect()] == [r[0] for r in PARTIES]


def test_ranking_and_ties(spark):
    df = results(spark, [*LEADERS, ("Another", -0.062, 0.371, 0.038, 0.098, 565)])
    got = [(r["rank"], r.name) for r in nl.ranking(nl.scenario(df)).collect()]
    assert got == [(1, "Gagan_Thapa"), (2, "Another"), (3, "Balen_Shah"), (4, "KP_Oli")]


def test_trend_and_gauges(spark):
    df = nl.scenario(results(spark, [*LEADERS, ("Flat", 0.0, 0.0, 0.0004, 0.9, 1)]))
    got = {r.name: r.trend for r in nl.momentum_trend(df).collect()}
    assert got == {"KP_Oli": "Declining", "Balen_Shah": "Rising", "Gagan_Thapa": "Rising",
                   "Flat": "Stable"}
    gauge = nl.gauges(df).collect()[0]
    assert (gauge.name, gauge.value, gauge.axis_min, gauge.axis_max) == ("KP_Oli", 0.023, -0.5, 0.5)


def test_daily_mentions_of_results(spark, articles):
    df = articles(("balen", "", "2025-03-01"), ("gagan", "oli kp", "2025-03-01"))
    days = lambda results: [r.entity for r in nl.daily_mentions(df, nl.LEADER_VARIANTS, results=results).collect()]
    assert days(["Gagan_Thapa"]) == ["Gagan_Thapa"]
    assert days(results(spark, LEADERS[:2])) == ["Balen_Shah", "KP_Oli"]
    assert days([]) == []
    with pytest.raises(KeyError, match="Nobody"):
        days(["Nobody"])
    with pytest.raises(Exception, match="no variants for Nobody"):
        days(results(spark, [("Nobody", 0.0, 0.0, 0.0, 0.0, 1)]))


def test_daily_mentions(articles):
    df = articles(
        ("Balen", "balen shah mayor", "2025-03-01 08:00"),
        ("", "The MAYOR", "2025-03-01 20:00"),
        ("uml", "shahs mayors", "2025-03-02"),
        ("shah", "", "2024-12-01"),
        ("shah", "", None),
        (None, "kp", "2025-03-02"),
    )
    got = [tuple(r) for r in nl.daily_mentions(df, nl.LEADER_VARIANTS).collect()]
    assert got == [
        ("Balen_Shah", dt.date(2024, 12, 1), 1),
        ("Balen_Shah", dt.date(2025, 3, 1), 2),
        ("KP_Oli", dt.date(2025, 3, 2), 1),
    ]
    late = nl.daily_mentions(df, nl.LEADER_VARIANTS, last_days=60).collect()
    assert [r.entity for r in late] == ["Balen_Shah", "KP_Oli"]


def test_article_counts_and_ratio(articles):
    df = articles(
        ("uml", "uml uml kp", "2025-03-01"),
        ("", "kp sharma", "2025-03-01"),
        ("", "gagan", "2025-03-01"),
        ("", "kp", None),
    )
    counts = {r.entity: r.articles for r in nl.mentions.article_counts(df, nl.LEADER_VARIANTS).collect()}
    assert counts == {"KP_Oli": 3, "Balen_Shah": 0, "Gagan_Thapa": 1}
    got = {(r.party, r.leader): r.leader_to_party_ratio for r in nl.coverage_ratio(df).collect()}
    assert got == {
        ("CPN_UML", "KP_Oli"): 1.0,
        ("RSP", "Balen_Shah"): 0.0,
        ("Nepali_Congress", "Gagan_Thapa"): 1.0,
    }
    two = {"CPN_UML": ("KP_Oli", "Gagan_Thapa")}
    assert nl.coverage_ratio(df, two).count() == 2
    with pytest.raises(KeyError, match="Nobody"):
        nl.coverage_ratio(df, {"CPN_UML": ("Nobody",)})

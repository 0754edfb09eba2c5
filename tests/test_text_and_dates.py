"""Cleaning, counting and date reading on hand-written rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import newslens as nl
from newslens.functions import dates, text

COUNTED = nl.mentions.entities_of(nl.COUNT_RULES)


def counts(articles, sample):
    row = nl.track_mentions(articles(("", sample, None))).collect()[0]
    assert row.entity_counts == {e: row[e] for e in COUNTED}
    return {e: row[e] for e in COUNTED if row[e]}


@pytest.mark.parametrize(
    "sample, expected",
    [
        ("kp sharma oli", {"KP_Oli": 3}),
        ("kp sharma oli of uml", {"KP_Oli": 4, "CPN_UML": 1}),
        ("K.P. Sharma Oli", {"KP_Oli": 1}),
        ("thapa announced", {"Gagan_Thapa": 1}),
        ("thapa", {}),
        ("mayor of pokhara", {}),
        ("mayor of kathmandu, mayor", {"Balen_Shah": 2}),
        ("balen shah", {"Balen_Shah": 2}),
        ("cpn-uml", {"CPN_UML": 2}),
        ("nepalicongress and nc", {"Nepali_Congress": 2}),
        ("rastriya swatantra party rsp rspx", {"RSP": 2}),
        ("étranger éoli éshah oli uml", {"KP_Oli": 1, "CPN_UML": 1}),
        ("cpn uml", {"CPN_UML": 2}),
    ],
)
def test_mention_counts(articles, sample, expected):
    assert counts(articles, sample) == expected


def test_totals_and_expansion(articles):
    tracked = nl.track_mentions(articles(("Oli", "uml", None), (None, None, None)))
    totals = {r.entity: r.mentions for r in nl.mention_totals(tracked, COUNTED).collect()}
    assert totals["KP_Oli"] == 1 and totals["CPN_UML"] == 1 and totals["RSP"] == 0
    wide = nl.expand_counts(tracked, [*COUNTED, "Nobody"]).collect()
    assert [r.Nobody for r in wide] == [0, 0]
    assert [r.full_text for r in wide] == ["oli uml", " "]


def test_totals_of_nothing(articles):
    tracked = nl.track_mentions(articles(("a", "b", None))).filter("false")
    assert {r.mentions for r in nl.mention_totals(tracked, COUNTED).collect()} == {0}


def test_text_orders(articles):
    row = articles(("Title", None, None)).select(text.full_text(), text.search_text()).collect()[0]
    assert tuple(row) == ("title ", " title")


def test_sentences_split_everywhere(articles):
    df = nl.mentions.sentence_rows(articles(("K.P. Sharma Oli won", "yes! no?\nwell", None)), "link")
    got = [(r.pos, r.sentence) for r in df.orderBy("pos").collect()]
    assert got == [(0, "k"), (1, "p"), (2, " sharma oli won yes"), (3, " no"), (4, "\nwell")]


def test_keywords_are_substrings(articles):
    df = articles(("", "ANNOUNCED", None), ("Poll", "", None), ("", "weather", None))
    assert [r.link for r in nl.clean.with_keywords(df, nl.KEYWORDS).collect()] == ["u0", "u1"]


READ = {
    "2025-12-23 10:00:00": dt.datetime(2025, 12, 23, 10),
    "2025-12-22 14:05": dt.datetime(2025, 12, 22, 14, 5),
    "2025-12-20": dt.datetime(2025, 12, 20),
    "2025-1-5": dt.datetime(2025, 1, 5),
    "December 5, 2025": dt.datetime(2025, 12, 5),
    "december  5,  2025": dt.datetime(2025, 12, 5),
    "Dec 5, 2025": dt.datetime(2025, 12, 5),
    "Friday, December 23, 2025": dt.datetime(2025, 12, 23),
    "Tuesday, Dec 23, 2025": dt.datetime(2025, 12, 23),
    "2025-02-30": None,
    "2025": None,
    "25-12-2025": None,
    "junk": None,
    "": None,
    None: None,
}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kathmandu"])
def test_lenient_dates(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(k,) for k in READ], "raw string")
        got = {r.raw: r.d for r in df.select("raw", dates.lenient(F.col("raw")).alias("d")).collect()}
        gap = spark.createDataFrame([("2025-03-09 02:30:00",)], "raw string")
        read = dates.lenient(F.col("raw"))
        row = gap.select(read.alias("d"), dates.wall_time(read).alias("text")).collect()[0]
        assert row.d.hour == 2 and row.text == "2025-03-09 02:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == READ


def test_null_and_old_dates(articles):
    df = articles(("a", "", "2025-03-01"), ("b", "", "2025-01-01"), ("c", "", None))
    keep = lambda **k: [r.title for r in nl.clean.recent(df, "2025-04-01", **k).collect()]
    assert keep() == ["a", "c"]
    assert keep(keep_null=False) == ["a"]
    assert keep(days=365) == ["a", "b", "c"]
    assert nl.clean.recent(df).count() == 1  # long ago, seen from today
    assert nl.clean.dated(df).count() == 2
    assert str(nl.clean.with_day(df).collect()[0].date) == "2025-03-01"


def test_rounding_is_half_up(spark):
    df = spark.createDataFrame([("x", 0.1235, 0.0025, -0.0005, 7)], "n string, a double, b double, c double, k int")
    assert tuple(nl.clean.rounded(df).collect()[0]) == ("x", 0.124, 0.003, -0.001, 7)

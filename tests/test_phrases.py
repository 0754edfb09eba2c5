import random

import pytest

import newslens as nl
from newslens.operators import phrases
from newslens.operators.bloom import Filter

VARIANT = "entity string, variant string"


def test_equals_the_rules(spark, articles):
    random.seed(4)
    words = "kp oli sharma balen shah mayor balendra gagan kumar thapa cpn uml nepali congress nc rastriya swatantra party rsp X é".split()
    gaps = [" ", " ", " ", "  ", "-", ". ", "\n"]
    text = lambda n: "".join(random.choice(words) + random.choice(gaps) for _ in range(n))
    rows = [(text(3), text(random.randrange(0, 30)), "2025-01-05") for _ in range(80)]
    rows += [(None, None, None), ("", " ", "2025-01-05"), ("KP", "xkp kpx", "2025-01-06"), ("a", "kp oli", None)]
    news = articles(*rows)
    rules = (*nl.LEADER_VARIANTS, *nl.PARTY_VARIANTS)
    table = spark.createDataFrame(phrases.table_of(rules) + [("Balen_Shah", "shah"), ("None", None), ("None", "")], VARIANT)
    want = {r.entity: r.articles for r in nl.mentions.article_counts(news, rules).collect()} | {"None": 0}
    assert {r.entity: r.articles for r in phrases.article_counts(news, table).collect()} == want
    days = sorted(map(tuple, nl.daily_mentions(news, rules).collect()))
    assert sorted(map(tuple, phrases.daily_mentions(news, table).collect())) == days
    parties = spark.createDataFrame(phrases.table_of(nl.PARTY_VARIANTS), VARIANT)
    leaders = spark.createDataFrame(phrases.table_of(nl.LEADER_VARIANTS), VARIANT)
    pairs = spark.createDataFrame([(p, ld) for p, lds in nl.PARTY_LEADERS.items() for ld in lds], "party string, leader string")
    ratio = phrases.coverage_ratio(news, pairs, parties, leaders)
    assert sorted(map(tuple, ratio.collect())) == sorted(map(tuple, nl.coverage_ratio(news).collect()))
    plan = ratio._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "CartesianProduct", "NestedLoop"))
    strange = spark.createDataFrame([("Nobody", "KP_Oli")], "party string, leader string")
    with pytest.raises(Exception, match="no variants for Nobody"):
        phrases.coverage_ratio(news, strange, parties, leaders).collect()


def test_spellings_with_marks(spark, articles):
    news = articles(("t", "a c++x, jhapa-5; at&t", "2025-01-01"), ("t", "c++ jhapa 5 jhapa-55", "2025-01-01"), ("t", "é5 naïve", "2025-01-01"))
    rules = [nl.Variants("c", ("c++",)), nl.Variants("j", ("jhapa-5",)), nl.Variants("at", ("at&t",)), nl.Variants("n", ("na", "naïve")), nl.Variants("5", ("5",))]
    table = spark.createDataFrame(phrases.table_of(rules), VARIANT)
    got = {r.entity: r.articles for r in phrases.article_counts(news, table).collect()}
    assert got == {r.entity: r.articles for r in nl.mentions.article_counts(news, rules).collect()}
    assert got == {"c": 1, "j": 1, "at": 1, "n": 1, "5": 2}


def test_empty_tables(spark, articles):
    news = articles(("kp", "oli", "2025-01-01"))
    none = spark.createDataFrame([], VARIANT)
    assert phrases.article_counts(news, none).collect() == []
    table = spark.createDataFrame([("a", "kp")], VARIANT)
    assert [tuple(r) for r in phrases.article_counts(news.limit(0), table).collect()] == [("a", 0)]


def test_the_filter_holds_all_and_little_else(spark):
    from pyspark.sql import functions as F

    keys = spark.range(3000).select(F.xxhash64("id").alias("key"))
    bloom = Filter(keys, 3000)
    asked = spark.range(0, 23_000).withColumn("w", bloom.words.scalar())
    asked = asked.select("id", bloom.may_hold(F.col("w"), F.xxhash64("id")).alias("held"))
    assert asked.filter("id < 3000 AND held").count() == 3000
    assert asked.filter("id >= 3000 AND held").count() < 600

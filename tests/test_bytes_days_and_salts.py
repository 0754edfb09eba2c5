import pytest
from pyspark.sql import functions as F

import newslens as nl
from newslens.functions.charset import decoded
from newslens.operators.salted import hot_keys, salted_join
from newslens.sources import tables


@pytest.mark.parametrize(
    ("page", "header", "text"),
    [
        ("é".encode(), None, "é"),
        (b"\xef\xbb\xbf" + "é".encode(), "text/html; charset=latin-1", "é"),
        ("é".encode("utf-16"), None, "é"),
        (b"\xfe\xff" + "नेपाल".encode("utf-16-be"), None, "नेपाल"),
        (b"\xe9", "text/html; charset=ISO-8859-1", "é"),
        (b"\x93x\x94", "text/html;charset='latin1'", "“x”"),
        (b"\xe9", None, "é"),
        (b"\xe9", "text/html; charset=nonsense", "é"),
        ('<meta charset="shift_jis">日本'.encode("shift_jis"), "text/html", '<meta charset="shift_jis">日本'),
        (b'<META content="text/html; charset=koi8-r" >\xc1', None, '<META content="text/html; charset=koi8-r" >а'),
        ('<meta charset="utf-16">é'.encode(), None, '<meta charset="utf-16">é'),
        (b"<meta charset=base64>\xe9", None, "<meta charset=base64>é"),
        (b"\xff\xff", "text/html; charset=utf-8", "��"),
        (b"", None, ""),
    ],
)
def test_decoding(page, header, text):
    assert decoded(page, header) == text


def test_listing_pages_as_bytes(spark):
    html = '<div id="news-list"><article class="article-image"><a href="/politics/é"><h3>x</h3></a></article></div>'
    rows = [("Kathmandu Post", 1, html.encode("latin-1"), "text/html; charset=latin-1"), ("Kathmandu Post", 2, None, None)]
    pages = spark.createDataFrame(rows, "source string, page_no int, html binary, content_type string")
    assert [r.url for r in nl.extract.links(pages).collect()] == ["https://kathmandupost.com/politics/é"]
    text = spark.createDataFrame([(s, n, html) for s, n, _, _ in rows[:1]], "source string, page_no int, html string")
    assert nl.extract.links(text).collect() == nl.extract.links(pages).collect()


def test_days_are_replaced_alone(spark, articles, tmp_path):
    path = str(tmp_path / "days")
    rows = articles(("a", "1", "2025-03-01 10:00"), ("b", "2", "2025-03-02"), ("c", "3", None), ("d", "4", "2024-01-01"))
    assert tables.read_recent(spark, path, "2025-03-10").collect() == []
    for _ in range(2):
        tables.write_by_day(rows, path)
        stored = tables.stored_by_day(spark, path, rows.schema)
        assert sorted(r.title for r in stored.collect()) == ["a", "b", "c", "d"]
    recent = tables.read_recent(spark, path, "2025-03-10", 9)
    assert sorted(r.title for r in recent.collect()) == ["a", "b", "c"]
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(isnull(day" in plan and "2025-03-01" in plan
    assert tables.read_recent(spark, path, "2025-03-10 10:00:01", 9).filter("title = 'a'").count() == 0
    new = rows.filter("title IN ('a', 'c')").withColumn("content", F.lit("new"))
    tables.write_by_day(new.filter("title = 'a'"), path)  # only that day
    tables.add_by_day(new.filter("title = 'c'").unionByName(new.filter("title = 'a'").withColumn("link", F.lit("u9"))), path)
    got = sorted((r.title, r.link, r.content) for r in tables.stored_by_day(spark, path, rows.schema).collect())
    assert got == [("a", "u0", "new"), ("a", "u9", "new"), ("b", "u1", "2"), ("c", "u2", "new"), ("d", "u3", "4")]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_joins(spark, how):
    left = spark.range(1000).selectExpr("if(id % 2 = 0, 'hot', concat('k', id % 90)) AS k", "cast(id % 7 AS int) AS v")
    left = left.unionByName(spark.createDataFrame([(None, 1)], "k string, v int"))
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("k3", 3), ("none", 4), (None, 5)], "k string, w int")
    salted = salted_join(left, right, ["k"], how)
    assert sorted(map(repr, salted.collect())) == sorted(map(repr, left.join(right, ["k"], how).collect()))


def test_hot_rows_are_dealt_out(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        left = spark.range(20_000).selectExpr("if(id % 2 = 0, 'hot', concat('k', id)) AS k", "id")
        right = spark.range(100).selectExpr("if(id = 0, 'hot', concat('k', id)) AS k")
        assert len(hot_keys(left, ["k"], 0.2)) <= 5
        sizes = lambda df: [r.n for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
        plain, dealt = (sizes(j) for j in (left.join(right, ["k"], "left"), salted_join(left, right, ["k"], "left")))
        assert max(plain) > 10_000 and max(dealt) < 4_000 and sum(plain) == sum(dealt) == 20_000
    finally:
        for name, value in (("autoBroadcastJoinThreshold", "10m"), ("adaptive.enabled", "true"), ("shuffle.partitions", "4")):
            spark.conf.set(f"spark.sql.{name}", value)
    with pytest.raises(ValueError, match="full"):
        salted_join(left, right, ["k"], "full")

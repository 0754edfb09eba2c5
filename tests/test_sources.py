"""Round trips, result files, summaries and the shared folder."""

import datetime as dt

import pytest

import newslens as nl
from newslens.sources import tables, workspace

NASTY = 'He said "no",\nthen\\left, \'x\'  '
COUNTED = nl.mentions.entities_of(nl.COUNT_RULES)


@pytest.fixture
def rows(articles):
    return articles((NASTY, NASTY, "2025-03-01 08:05:06"), (None, "", None), ("uml", "oli", "2025-03-02"))


def content(df, form="parquet"):
    """All rows; empty text counts as none where CSV cannot tell them apart."""
    rows = [tuple(r) for r in df.collect()]
    if form == "csv":
        rows = [tuple(None if v == "" else v for v in r) for r in rows]
    return sorted(map(repr, rows))


@pytest.mark.parametrize("form", ["csv", "parquet"])
def test_articles(spark, rows, tmp_path, form):
    path = str(tmp_path / "a")
    tables.write_articles(rows, path, form)
    back = tables.read_articles(spark, path, form)
    assert back.schema.names == nl.schemas.STORED_ARTICLE.names
    assert content(back.drop("date_text"), form) == content(rows, form)
    with pytest.raises(Exception):
        tables.write_articles(rows, path, form)
    tables.write_articles(rows, path, form, mode="overwrite")


@pytest.mark.parametrize("form", ["csv", "parquet"])
def test_tracked_and_labelled(spark, rows, tmp_path, form):
    tracked = nl.track_mentions(rows)
    tables.write_tracked(tracked, str(tmp_path / "t"), form)
    back = tables.read_tracked(spark, str(tmp_path / "t"), COUNTED, form)
    assert content(back, form) == content(tracked, form)
    labelled = nl.label_articles(rows, nl.Lexicon(("no",), ("oli",)))
    tables.write_labelled(labelled, str(tmp_path / "l"), form)
    back = tables.read_labelled(spark, str(tmp_path / "l"), form)
    assert content(back, form) == content(labelled, form)


def test_file_written_by_another_tool(spark, tmp_path):
    file = tmp_path / "n.csv"
    file.write_text(
        'source,title,link,content,published_date\n'
        'Kathmandu Post,"A ""b"", c",u1,"x\ny",2025-12-05 00:00:00\n'
        'Setopati,No Title,u2,,2025-12-22 14:05\n'
        'Setopati,t,u3,z,soon\nOnlineKhabar,t,u4,z,\n'
    )
    got = tables.read_articles(spark, str(file), "csv").orderBy("link").collect()
    assert (got[0].title, got[0].content) == ('A "b", c', "x\ny")
    assert [r.published_date for r in got] == [
        dt.datetime(2025, 12, 5), dt.datetime(2025, 12, 22, 14, 5), None, None
    ]
    assert got[1].content is None
    assert [r.date_text for r in got][1:3] == ["2025-12-22 14:05", "soon"]


def test_columns_are_read_by_name(spark, tmp_path):
    file = tmp_path / "n.csv"
    file.write_text("title,extra,published_date,source,content,link\nT,x,2025-12-05,S,C,u\n")
    row = tables.read_articles(spark, str(file), "csv").collect()[0]
    assert (row.source, row.title, row.link, row.content) == ("S", "T", "u", "C")
    file.write_text("title,source,content,link\nT,S,C,u\n")
    with pytest.raises(ValueError, match="published_date"):
        tables.read_articles(spark, str(file), "csv")


def test_files_of_other_headers_are_an_error(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.csv").write_text("source,title,link,content,published_date\nS,T,u,C,\n")
    (tmp_path / "d" / "b.csv").write_text("title,source,link,content,published_date\nT,S,u,C,\n")
    with pytest.raises(Exception, match="header"):
        tables.read_articles(spark, str(tmp_path / "d"), "csv").collect()


def test_printed_dates_stay_in_parquet(spark, rows, tmp_path):
    from pyspark.sql import functions as F

    tables.write_articles(rows.withColumn("date_text", F.lit("soon")), str(tmp_path / "a"))
    assert {r.date_text for r in tables.read_articles(spark, str(tmp_path / "a")).collect()} == {"soon"}


def test_printed_dates_reach_the_file(spark, rows, tmp_path):
    from pyspark.sql import functions as F

    tables.write_articles(rows.withColumn("date_text", F.lit("as printed")), str(tmp_path / "a"), "csv")
    raw = spark.read.options(header=True, multiLine=True, escape='"').csv(str(tmp_path / "a"))
    assert {r.published_date for r in raw.collect()} == {"as printed"}
    assert raw.columns == nl.schemas.ARTICLE.names


@pytest.mark.parametrize("view", ["Leader", "Party"])
def test_results(spark, tmp_path, view):
    file = tmp_path / "r.csv"
    file.write_text(
        f"{view},Sentiment_Score,Volume_Score,Momentum,MCI_v2,Total_Mentions\n"
        "KP_Oli,-0.113,0.267,-0.04,0.023,407.0\n"
    )
    table = tables.read_results(spark, str(file), view)
    assert [tuple(r) for r in table.collect()] == [("KP_Oli", -0.113, 0.267, -0.04, 0.023, 407)]
    tables.write_results(table, str(tmp_path / "out"), view)
    parts = list((tmp_path / "out").glob("part-*"))
    assert len(parts) == 1
    assert parts[0].read_text().splitlines()[0] == file.read_text().splitlines()[0]
    assert content(tables.read_results(spark, str(tmp_path / "out"), view)) == content(table)
    with pytest.raises(ValueError):
        tables.read_results(spark, str(file), "City")


def test_landed_pages(spark, tmp_path):
    rows = [("s", "u", 200, "<p>"), ("s", "v", 500, "<p>"), ("s", "w", None, "<p>")]
    spark.createDataFrame(rows, nl.schemas.LANDED_PAGE).write.parquet(str(tmp_path / "p"))
    assert [r.url for r in tables.read_landed_pages(spark, str(tmp_path / "p")).collect()] == ["u"]


def test_union_and_summary(rows):
    both = tables.union_sources(rows, rows.select(*reversed(rows.columns)))
    assert both.count() == 6
    row = tables.run_summary(both).collect()[0].asDict()
    assert row == {"source": 6, "title": 4, "link": 6, "content": 6, "published_date": 4, "total_rows": 6}


def test_written_tables_lie_in_the_shared_folder(spark):
    stored = workspace.written(spark.range(5), "numbers")
    assert stored.count() == 5
    assert workspace.own_folder(spark).removeprefix("file:") in stored.inputFiles()[0]
    again = workspace.written(spark.range(5).selectExpr("id", "id % 2 AS k"), "n", ["k"])
    assert again.columns == ["id", "k"] and again.filter("k = 1").count() == 2


class Session:
    """As much of a session as the shared folder asks for."""

    def __init__(self, master, folder=None, context_folder=None):
        self.master, self.context_folder = master, context_folder
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = self

    def getCheckpointDir(self):
        return self.context_folder


def test_shared_folder_is_the_sessions():
    assert workspace.shared_folder(Session("yarn", "hdfs:/x", "hdfs:/y")) == "hdfs:/x"
    assert workspace.shared_folder(Session("yarn", None, "hdfs:/y")) == "hdfs:/y"
    for master in ("yarn", "local[2]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            workspace.shared_folder(Session(master))


def test_written_tables_can_be_deleted(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(workspace, "shared_folder", lambda spark: str(tmp_path))
    workspace.written(spark.range(3), "gone")
    assert list(tmp_path.rglob("*.parquet"))
    workspace.clean_up(spark)
    assert not list(tmp_path.rglob("*.parquet"))

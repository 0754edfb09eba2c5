"""Every registered query against its SQL on the smallest tables."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
EXTRA = entry.training_data.queries() if entry.training_data else {}  # they have their own tests
QUERIES = {n: q for n, q in entry.queries().items() if n not in EXTRA and n != "pipeline"}
SQL = {n: q for n, q in entry.oracle_sql().items() if n in QUERIES}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in os.listdir(SF):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{file}'")
    yield con
    con.close()


def rows(names, values):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(repr([row[i] for i in order]) for row in values)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = df.collect()
    assert got
    result = duck.execute(SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    assert rows(df.columns, got) == rows(names, result.fetchall())


def test_entry(spark):
    assert {r.entity for r in entry.entry(spark).collect()} == {"KP_Oli", "Balen_Shah", "Gagan_Thapa"}


def test_every_query_has_its_sql():
    assert set(SQL) == set(QUERIES)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {n for n in QUERIES if n.startswith("csv")}))
def test_plan_has_no_product_and_one_python_step(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text  # no row-at-a-time functions
    assert len(re.findall(r"ArrowEvalPython", text)) <= 1


def test_plans_of_row_wise_jobs_do_not_shuffle(spark, tmp_path):
    import newslens as nl

    spark.createDataFrame([], nl.schemas.ARTICLE).write.parquet(str(tmp_path / "a"))
    stored = nl.tables.read_articles(spark, str(tmp_path / "a"))
    for df in (
        nl.track_mentions(stored),
        nl.label_articles(stored, nl.Lexicon(("good",), ("bad",))),
        nl.sentence_mentions(stored, nl.LEADER_PATTERNS, nl.Lexicon(("good",), ("bad",))),
        nl.clean.with_keywords(stored, nl.KEYWORDS),
    ):
        assert "Exchange" not in plan(df)
    totals = nl.mention_totals(nl.track_mentions(stored), ["RSP"])
    assert re.search(r"ReadSchema: struct<title:string,content:string>", plan(totals))
    dated = nl.daily_mentions(stored, nl.LEADER_VARIANTS)
    assert "PushedFilters: [IsNotNull(published_date)]" in plan(dated)

"""Walking order: hand cases and a comparison with plainly walking the pages."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import newslens as nl

AS_OF = dt.datetime(2025, 4, 1)
NEW, OLD = dt.datetime(2025, 3, 1), dt.datetime(2025, 1, 1)
SCHEMA = "source string, page_no int, pos int, url string, published_date timestamp_ntz"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def places(df):
    return sorted((r.source, r.page_no, r.pos) for r in df.collect())


@pytest.fixture(params=["few", "many", "known"])
def sources(request, spark):
    """Known sources, or unknown ones that are broadcast or shuffled."""
    if request.param == "many":
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield ["s", "t", "u"] if request.param == "known" else None
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_cutoff_cases(spark, sources):
    df = table(spark, [("s", 1, 0, "a", NEW), ("s", 1, 1, "b", OLD), ("s", 1, 2, "c", NEW),
                       ("s", 2, 0, "d", NEW), ("t", 1, 0, "e", None), ("t", 1, 1, "f", NEW)])
    cut = lambda mode: places(nl.listing.cutoff(df, mode, AS_OF, sources=sources))
    rest = [("t", 1, 0), ("t", 1, 1)]
    assert cut("immediate") == [("s", 1, 0), *rest]
    assert cut("page_end") == [("s", 1, 0), ("s", 1, 2), *rest]
    with pytest.raises(ValueError):
        cut("later")
    with pytest.raises(ValueError, match="pos"):
        nl.listing.cutoff(df.drop("pos"), "immediate", AS_OF)


def test_cutoff_edge_is_kept(spark, sources):
    edge = AS_OF - dt.timedelta(days=60)
    df = table(spark, [("s", 1, 0, "a", edge), ("s", 1, 1, "b", edge - dt.timedelta(seconds=1))])
    assert places(nl.listing.cutoff(df, "immediate", AS_OF, sources=sources)) == [("s", 1, 0)]


def test_duplicate_cases(spark):
    df = table(spark, [("s", 1, 0, "a", None), ("s", 1, 1, "a", None), ("s", 2, 0, "a", None)])
    assert places(nl.listing.first_seen(df)) == [("s", 1, 0)]
    assert places(nl.listing.not_on_earlier_page(df)) == [("s", 1, 0), ("s", 1, 1)]


def test_page_cap(spark):
    df = table(spark, [("s", p, 0, str(p), None) for p in range(1, 14)])
    assert nl.listing.capped(df, nl.rules.KATHMANDU_PAGES).count() == 11


def walk(rows, how):
    """The pages opened one after the other."""
    kept = []
    for source in sorted({r[0] for r in rows}):
        mine = sorted(r for r in rows if r[0] == source)
        seen, page = set(), 1
        if how == "first":
            for r in mine:
                if r[3] not in seen:
                    seen.add(r[3])
                    kept.append(r[:3])
            continue
        while fresh := [r for r in mine if r[1] == page and r[3] not in seen]:
            kept += [r[:3] for r in fresh]
            seen |= {r[3] for r in fresh}
            page += 1
    return sorted(kept)


@pytest.mark.parametrize("seed", range(4))
def test_against_plain_walk(spark, sources, seed):
    rng = random.Random(seed)
    rows = [
        (s, p, i, f"u{rng.randrange(4 + seed * 6)}", None)
        for s in "stu"
        for p in range(1, 9)
        if rng.random() < (0.95 if p > 1 else 0.7)
        for i in range(rng.randrange(1, 5))
    ]
    df = table(spark, rows)
    assert places(nl.listing.first_seen(df)) == walk(rows, "first")
    fresh = nl.listing.not_on_earlier_page(df)
    assert places(nl.listing.until_exhausted(fresh, sources)) == walk(rows, "earlier_page")
    assert places(nl.listing.until_exhausted(fresh, sources, df)) == walk(rows, "earlier_page")
    before = nl.listing.not_on_earlier_page(nl.listing.until_exhausted(df, sources))
    assert places(before) == walk(rows, "earlier_page")


def test_building_a_walk_starts_no_job(spark):
    df = table(spark, [("s", 1, 0, "a", NEW), ("s", 2, 0, "a", NEW)])
    spark.sparkContext.setJobGroup("building", "")
    try:
        for walked in (
            nl.listing.not_on_earlier_page(df), nl.listing.until_exhausted(df),
            nl.listing.cutoff(df, "page_end", AS_OF), nl.visits(df.withColumn("source", F.lit("Setopati"))),
        ):
            walked._jdf.queryExecution().executedPlan().toString()
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("building")
        assert df.count() == 2
        assert spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_first_page(spark, sources):
    df = table(spark, [("s", 2, 0, "a", None), ("s", 3, 0, "b", None), ("t", 1, 0, "c", None), ("u", 0, 0, "d", None)])
    assert places(nl.listing.until_exhausted(df, sources)) == [("t", 1, 0)]
    assert places(nl.listing.until_exhausted(df, sources, first_page=2)) == [("s", 2, 0), ("s", 3, 0)]
    assert places(nl.listing.until_exhausted(df.limit(0), sources)) == []


def test_one_hot_address(spark):
    rows = [("s", p, i, "hot" if i < 10 else f"u{p}-{i}", None) for p in range(1, 60) for i in range(20)]
    df = table(spark, rows)
    assert places(nl.listing.first_seen(df)) == walk(rows, "first")
    fresh = nl.listing.not_on_earlier_page(df)
    assert places(nl.listing.until_exhausted(fresh)) == walk(rows, "earlier_page")

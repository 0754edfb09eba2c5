import random

import newslens as nl
from newslens.operators import order
from newslens.plans import walks
from newslens.plans.articles import pages_of

LISTING = "source string, page_no int, pos int, url string"
SITES = ("Kathmandu Post", "Setopati", "OnlineKhabar")


def test_runs_open_what_one_walk_opens(spark, tmp_path):
    for seed in range(3):
        random.seed(seed)
        rows = []
        for site in SITES:
            for page in range(1, 10):
                if random.random() < 0.07:
                    continue
                fresh = random.random() < 0.85
                for pos in range(4):
                    n = random.randrange(60) if fresh else random.randrange(6)
                    rows.append((site, page, pos, f"u{n}"))
        links = spark.createDataFrame(rows, LISTING)
        want = sorted(map(tuple, nl.visits(links).collect()))
        for cuts in ([9], [4, 9], [1, 2, 5, 9, 9]):
            store = walks.WalkStore(spark, str(tmp_path / f"{seed}-{len(cuts)}"))
            got = [tuple(r) for upto in cuts for r in walks.go_on(links, store, upto).collect()]
            assert sorted(got) == want, (seed, cuts)
            assert len(store.deltas.paths()) == len(cuts)
    ended = {r.source: r.ended for r in store.progress().collect()}
    assert not ended["Kathmandu Post"]


def test_pages_are_filtered_before_they_are_joined(spark):
    pages = spark.range(4000).selectExpr("'Setopati' AS source", "concat('u', id) AS url", "200 AS status", "'<p>' AS html")
    opened = spark.range(100).selectExpr("'Setopati' AS source", "concat('u', id * 7) AS url")
    found = pages_of(pages, opened)
    assert sorted(r.url for r in found.collect()) == sorted(f"u{7 * i}" for i in range(100))
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    scanned = plan.split("Subquery")[0]
    assert "LeftSemi" in scanned and "hashpartitioning" not in scanned and "Filter" in scanned


def test_rank(spark):
    random.seed(1)
    rows = [(i, random.randrange(20), random.choice("abc")) for i in range(500)]
    df = spark.createDataFrame(rows, "id int, score int, name string").repartition(7)
    from pyspark.sql import functions as F

    ranked = order.global_rank(df, F.desc("score"), F.asc("name"), F.asc("id"), partitions=5)
    want = sorted(rows, key=lambda r: (-r[1], r[2], r[0]))
    assert [tuple(r)[:3] for r in sorted(ranked.collect(), key=lambda r: r["rank"])] == want
    assert sorted(r["rank"] for r in ranked.collect()) == list(range(1, 501))
    assert order.global_rank(df.limit(0), "score").collect() == []
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("SinglePartition") == 1 and "rangepartitioning" not in plan  # the window over sizes only


def test_share(spark):
    df = spark.createDataFrame([("x", "a", 1), ("x", "b", 3), ("y", "c", 0), ("y", "d", 0)], "g string, e string, n int")
    got = {r.e: r.share for r in order.with_share(df, "n").collect()}
    assert got == {"a": 0.25, "b": 0.75, "c": 0.0, "d": 0.0}
    assert {r.e: r.share for r in order.with_share(df, "n", by=["g"]).collect()} == {"a": 0.25, "b": 0.75, "c": None, "d": None}
    assert order.with_share(df.limit(0), "n").collect() == []

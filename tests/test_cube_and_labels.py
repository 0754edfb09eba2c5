import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import newslens as nl
from newslens.plans import cube

TONE = nl.Lexicon(("good",), ("bad",))
NAMES = nl.mentions.entities_of(nl.LEADER_PATTERNS)


def random_news(articles, seed, n=80):
    random.seed(seed)
    words = ["oli.", "balen", "gagan!", "good", "bad", "shah.", "x"]
    first = dt.datetime(2025, 1, 1)
    rows = []
    for _ in range(n):
        at = first + dt.timedelta(days=random.choice([0, 1, 29, 30, 31, 59, 60, 61, 90]), seconds=random.choice([0, 1, 43_200, 86_399]))
        rows.append((random.choice(words), " ".join(random.choices(words, k=6)), str(at)))
    return articles(*rows, ("oli good", "", None), ("oli", "bad", "junk"))


def test_each_day_equals_the_index_of_the_articles_up_to_it(articles):
    news = random_news(articles, 3)
    cells = cube.cube(news, nl.LEADER_PATTERNS, TONE)
    got = {}
    for r in cube.index_by_day(cells, entities=NAMES).collect():
        got.setdefault(r.date, set()).add(tuple(r)[1:])
    days = [r.d for r in news.select(F.to_date("published_date").alias("d")).filter("d IS NOT NULL").distinct().collect()]
    assert sorted(got) == sorted(days)
    for day in (min(days), sorted(days)[len(days) // 2], max(days)):
        upto = news.filter(F.to_date("published_date") <= F.lit(day))
        assert got[day] == set(map(tuple, nl.confidence_index(upto, nl.LEADER_PATTERNS, TONE).collect()))


def test_cubes_merge(articles):
    news = random_news(articles, 4, 40)
    whole = sorted(cube.merge(cube.cube(news, nl.LEADER_PATTERNS, TONE)).collect(), key=repr)
    at = F.col("published_date")
    for split in (F.hash("link") % 2 == 0, at < F.lit("2025-02-01").cast("timestamp_ntz")):
        parts = [cube.cube(news.filter(s), nl.LEADER_PATTERNS, TONE) for s in (split, ~split)]
        both = cube.merge(*parts).collect()
        cells = lambda rows: sorted((r for r in rows if r.entity), key=repr)
        newest = lambda rows: {d: max(r.at for r in rows if r.day == d) for d in {r.day for r in rows}}
        assert cells(both) == cells(whole) and newest(both) == newest(whole)


def test_empty_cube(articles):
    none = articles(("oli", "", None))
    cells = cube.cube(none, nl.LEADER_PATTERNS, TONE)
    assert cube.index_by_day(cells, entities=NAMES).collect() == []


def counting_model(folder):
    path = str(folder)

    def load():
        import os
        import uuid

        def predict(texts):
            for _ in texts:
                open(os.path.join(path, uuid.uuid4().hex), "w").close()
            return [("positive" if "good" in t else "negative" if "bad" in t else "neutral", 1.0) for t in texts]

        return predict

    return nl.Model(load, key=f"counting {folder}")


def test_a_second_run_scores_nothing(spark, articles, tmp_path):
    (tmp_path / "calls").mkdir()
    calls = lambda: len(list((tmp_path / "calls").iterdir()))
    model = counting_model(tmp_path / "calls")
    store = nl.LabelStore(spark, str(tmp_path / "store"), model.key)
    news = articles(("oli uml", "good oli. bad nc! balen", "2025-01-05"), ("oli uml", "good oli. rsp", "2025-02-20"))
    sets = {"leaders": nl.LEADER_PATTERNS, "parties": nl.PARTY_PATTERNS}
    first = sorted(nl.confidence_indexes(news, sets, model, store).collect())
    # " good oli", "oli uml good oli", " bad nc", " balen", " rsp": a sentence of both sets is one text
    assert calls() == 4 and len(store.deltas.paths()) == 1 and store.read().count() == 4
    assert sorted(nl.confidence_indexes(news, sets, model, store).collect()) == first
    assert calls() == 4 and len(store.deltas.paths()) == 1
    more = news.unionByName(articles(("gagan", "", "2025-02-21")))
    nl.confidence_indexes(more, sets, model, store)
    assert calls() == 5 and len(store.deltas.paths()) == 2
    for name, patterns in sets.items():
        alone = nl.confidence_index(news, patterns, model).collect()
        assert sorted(tuple(r)[1:] for r in first if r["set"] == name) == sorted(map(tuple, alone))
    other = nl.LabelStore(spark, str(tmp_path / "store"), "another model")
    assert other.deltas.paths() == [] and other.read().collect() == []


def test_only_published_deltas_count(spark, tmp_path):
    import os

    store = nl.LabelStore(spark, str(tmp_path), "m/1")
    texts = spark.createDataFrame([("good",), ("good",), (None,)], "text string")
    assert store.add(texts, TONE) == 2 and store.add(texts, TONE) == 0
    delta = store.deltas.paths()[0].removeprefix("file:")
    os.rename(f"{delta}/_SUCCESS", f"{delta}/_gone")
    assert store.deltas.paths() == [] and store.read().collect() == []
    assert store.add(texts, TONE) == 2
    os.rename(f"{delta}/_gone", f"{delta}/_SUCCESS")  # the same texts twice
    assert store.read().count() == 2
    keyed = spark.createDataFrame([("good",), ("new",)], "t string").select("t", F.sha2("t", 256).alias("text_key"))
    assert sorted((r.t, r.label, r.score) for r in store.labelled(keyed).collect()) == [("good", "positive", 1.0), ("new", "error", 0.0)]


def test_a_failing_text_is_tried_again(spark, tmp_path):
    def load():
        def predict(texts):
            if "bad" in texts:
                raise RuntimeError("bad")
            return [("neutral", 0.5) for _ in texts]

        return predict

    store = nl.LabelStore(spark, str(tmp_path), "f")
    texts = spark.createDataFrame([("bad",), ("fine",)], "text string")
    model = nl.Model(load, key="failing sometimes")
    assert store.add(texts, model, on_error="label") == 1 and store.add(texts, model, on_error="label") == 0
    with pytest.raises(Exception, match="bad"):
        store.add(texts, model)

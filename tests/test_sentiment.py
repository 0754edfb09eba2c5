"""The scorers' contract."""

import pandas as pd
import pytest

import newslens as nl
from newslens.functions.sentiment import score_batch


def picky():
    """Fails on "boom"; defined inside, so that it travels with the plan."""

    def load():
        def predict(texts):
            if any("boom" in t for t in texts):
                raise RuntimeError("boom")
            return [("positive" if len(t) < 900 else "long", 0.75) for t in texts]

        return predict

    return nl.Model(load)


def test_article_labels_survive_failures(articles):
    df = articles(("boom", "fine", None), ("", "boom", None), ("", None, None), ("", "x" * 900, None))
    got = nl.label_articles(df, picky()).orderBy("link").collect()
    assert [(r.sentiment, r.confidence) for r in got] == [
        ("positive", 0.75), ("error", 0.0), ("positive", 0.75), ("long", 0.75)
    ]
    assert got[0].asDict().keys() == {*df.columns, "sentiment", "confidence"}


def test_sentence_labels_do_not(articles):
    df = articles(("", "kp boom", "2025-01-01"))
    with pytest.raises(Exception, match="boom"):
        nl.sentence_mentions(df, nl.LEADER_PATTERNS, picky()).collect()


WORDS = nl.Lexicon(positive=("good",), negative=("bad", "Très mal"))


def test_lexicon(articles):
    texts = ["Good and bad", "BAD", "x", None, "goodbye badly", "très MAL!", "ügood"]
    got = nl.label_articles(articles(*[("bad", t, None) for t in texts]), WORDS).orderBy("link").collect()
    assert [(r.sentiment, r.confidence) for r in got] == [
        ("positive", 1.0), ("negative", 1.0), ("neutral", 0.0), ("neutral", 0.0), ("neutral", 0.0),
        ("negative", 1.0), ("neutral", 0.0),
    ]
    none = nl.Lexicon(positive=(), negative=())
    assert {r.sentiment for r in nl.label_articles(articles(("", "good", None)), none).collect()} == {"neutral"}


def test_a_scorer_must_be_given(articles):
    with pytest.raises(TypeError):
        nl.label_articles(articles(("", "x", None)))


def test_whole_texts_unless_limited(articles):
    df = articles(("", "x" * 600 + " good", None))
    assert nl.label_articles(df, WORDS).collect()[0].sentiment == "positive"
    assert nl.label_articles(df, WORDS, nl.plans.labels.MAX_CHARS).collect()[0].sentiment == "neutral"


def noting(folder):
    """A model that leaves a file for each load and for each text it sees, with the worker's process."""

    def load():
        import os
        import uuid

        (folder / f"load-{os.getpid()}-{uuid.uuid4().hex}").touch()

        def predict(texts):
            for _ in texts:
                (folder / f"text-{os.getpid()}-{uuid.uuid4().hex}").touch()
            return [("positive", 1.0) for _ in texts]

        return predict

    return nl.Model(load)


def noted(folder, kind):
    return len(list(folder.glob(f"{kind}-*")))


def workers(folder, kind):
    """Process of each note."""
    return [path.name.split("-")[1] for path in folder.glob(f"{kind}-*")]


def test_a_worker_loads_a_model_once(spark, tmp_path):
    from pyspark.sql import functions as F

    texts = spark.range(400, numPartitions=40).select(F.col("id").cast("string").alias("t"))
    scored = texts.select(noting(tmp_path).score(F.col("t"))["label"].alias("label"))
    assert scored.filter("label = 'positive'").count() == 400
    # how many workers there are, and when they are replaced, is up to Spark; each loads once, whatever its tasks
    loads = workers(tmp_path, "load")
    assert noted(tmp_path, "text") == 400 and len(loads) == len(set(loads)) < 40
    assert set(loads) == set(workers(tmp_path, "text"))
    before = noted(tmp_path, "load")
    assert texts.select(noting(tmp_path).score(F.col("t"))["label"].alias("l")).distinct().count() == 1
    assert noted(tmp_path, "load") > before  # another model is another key


def test_each_distinct_text_is_scored_once_in_many_tasks(spark, articles, tmp_path):
    from pyspark.sql import functions as F

    from newslens.plans.confidence import labelled_rows

    news = articles(*[("", f"uml number {i % 30:02}. rsp {i % 7} and uml", "2025-03-01") for i in range(300)])
    rows = labelled_rows(news, nl.PARTY_PATTERNS, noting(tmp_path), max_chars=14)
    assert [tuple(r) for r in rows.groupBy("label").agg(F.sum("n")).collect()] == [("positive", 300 + 600)]
    assert noted(tmp_path, "text") == 30 + 7
    assert rows.rdd.getNumPartitions() >= int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_equal_texts_of_a_batch_are_scored_once():
    asked = []

    def predict(texts):
        asked.extend(texts)
        return [(t, 1.0) for t in texts]

    got = score_batch(predict, pd.Series(["a", "b", "a", None, ""]), "raise")
    assert asked == ["a", "b", ""]
    assert list(got.label) == ["a", "b", "a", "", ""]
    assert score_batch(predict, pd.Series([], dtype=object), "raise").empty


def test_wrong_number_of_labels_is_an_error():
    with pytest.raises(ValueError, match="labels"):
        score_batch(lambda texts: [], pd.Series(["a"]), "raise")
    assert list(score_batch(lambda texts: [], pd.Series(["a"]), "label").label) == ["error"]
    with pytest.raises(ValueError):
        picky().score(None, on_error="ignore")

"""The index: windows, formula, invariances."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import newslens as nl
from newslens.plans.confidence import labelled_counts, scores, with_periods
from newslens.rules import EntityPattern

A, B = EntityPattern("A", r"\bann\b", ("ann",)), EntityPattern("B", r"\bbob\b")

# A published result table, used as input and to check the formula.
LEADERS = [
    ("KP_Oli", -0.113, 0.267, -0.040, 0.023, 407),
    ("Balen_Shah", -0.062, 0.371, 0.038, 0.098, 565),
    ("Gagan_Thapa", -0.022, 0.361, 0.051, 0.115, 550),
]
PARTIES = [
    ("CPN_UML", -0.090, 0.334, -0.098, 0.035, 702),
    ("Nepali_Congress", -0.039, 0.303, -0.001, 0.075, 638),
    ("RSP", -0.033, 0.363, -0.023, 0.089, 764),
]


WORDS = nl.Lexicon(positive=("good",), negative=("bad",))


def index(df, patterns=(A, B), scorer=WORDS, **options):
    return {r.entity: r for r in nl.confidence_index(df, patterns, scorer, **options).collect()}


def test_window_edges(articles):
    newest = dt.datetime(2025, 3, 31, 12)
    second = dt.timedelta(seconds=1)
    month, two = dt.timedelta(days=30), dt.timedelta(days=60)
    dates = [newest, newest - month, newest - month - second, newest - two, newest - two - second]
    df = articles(*[(str(i), "", str(d)) for i, d in enumerate(dates)])
    got = [(r.recent, r.previous) for r in with_periods(df).orderBy("title").collect()]
    new, old = (True, False), (False, True)
    assert got == [new, new, old, old, (False, False)]


def test_hand_computed(articles):
    df = articles(
        ("Ann good", "bad ann! x. bob ann", "2025-03-31"),  # ann good bad / x / bob ann
        ("", "ann bad. ann", "2025-02-15"),
        ("", "ann good", "2024-01-01"),
        ("", "bob good", None),  # no date: not counted at all
    )
    got = index(df)
    # A: 2 neutral + 2 good + 1 bad of 5; recent 1/2; previous -1/2
    assert tuple(got["A"])[1:] == (0.2, 0.833, 1.0, round(0.4 * 0.2 + 0.3 * 5 / 6 + 0.3, 3), 5)
    assert tuple(got["B"])[1:] == (0.0, 0.167, 0.0, 0.05, 1)


def test_empty_previous_window(articles):
    got = index(articles(("", "ann good", "2025-03-31")))
    assert got["A"].momentum == got["A"].sentiment_score == 1.0


def test_unmentioned(articles):
    df = articles(("", "ann", "2025-03-31"))
    assert tuple(index(df)["B"]) == ("B", 0.0, 0.0, 0.0, 0.0, 0)
    assert set(index(df, keep_unmentioned=False)) == {"A"}
    nobody = articles(("", "x", "2025-03-31"))
    assert {r.total_mentions for r in index(nobody).values()} == {0}
    empty = nl.confidence_index(nobody, (A, B), WORDS, keep_unmentioned=False)
    assert empty.collect() == [] and empty.columns == nl.schemas.RESULT.names
    assert index(articles(("", "ann", None)))["A"].total_mentions == 0


def test_several_patterns_of_one_entity(articles):
    df = articles(("", "ann and bob. bob. x", "2025-03-31"))
    both = (A, EntityPattern("A", r"\bbob\b"))
    assert index(df, both)["A"].total_mentions == 2


def test_label_only_of_the_scorers_reach(articles):
    far = "ann " + "x" * 600 + " good"
    assert index(articles(("", far, "2025-03-31")), max_chars=512)["A"].sentiment_score == 0.0
    assert index(articles(("", far, "2025-03-31")))["A"].sentiment_score == 1.0
    # the entity may stand behind the scorer's reach
    late = articles(("", "good " + "x" * 600 + " ann", "2025-03-31"))
    assert index(late, max_chars=512)["A"].total_mentions == 1


def random_news(seed, n=60):
    rng = random.Random(seed)
    words = ["ann", "bob", "good", "bad", "x.", "y!", "z?", "w"]
    return [
        (rng.choice(words), " ".join(rng.choices(words, k=12)), f"2025-0{rng.randint(1, 3)}-1{rng.randint(0, 9)}")
        for _ in range(n)
    ]


def brute(rows, patterns):
    import re

    dated = [(f"{t} {c}".lower(), dt.datetime.fromisoformat(d)) for t, c, d in rows]
    newest = max(d for _, d in dated)
    month = dt.timedelta(days=30)
    found = {}
    for p in patterns:
        found[p.entity] = [
            ("positive" if "good" in s else "negative" if "bad" in s else "neutral", d)
            for t, d in dated
            for s in re.split("[.!?]", t)
            if re.search(p.pattern, s)
        ]
    everything = sum(map(len, found.values()))

    def balance(labels):
        return (labels.count("positive") - labels.count("negative")) / len(labels) if labels else 0

    result = {}
    for entity, hits in found.items():
        s = balance([label for label, _ in hits])
        m = balance([x for x, d in hits if d >= newest - month]) - balance(
            [x for x, d in hits if newest - 2 * month <= d < newest - month]
        )
        v = len(hits) / everything
        result[entity] = (s, v, m, 0.4 * s + 0.3 * v + 0.3 * m, len(hits))
    return result


def close(got, want):
    return all(abs(g - w) <= 0.000501 for g, w in zip(tuple(got)[1:], want))


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(articles, seed):
    rows = random_news(seed)
    want = brute(rows, (A, B))
    got = index(articles(*rows))
    assert all(close(got[e], want[e]) for e in want)


def test_invariances(articles):
    rows = random_news(7)
    base = index(articles(*rows))
    shuffled = random.Random(1).sample(rows, len(rows))
    assert index(articles(*shuffled).repartition(5)) == base
    alone = index(articles(*rows), (A,))
    assert alone["A"].total_mentions == base["A"].total_mentions
    assert alone["A"].sentiment_score == base["A"].sentiment_score
    assert alone["A"].volume_score == 1.0


def test_model_scores_each_distinct_sentence_once(spark, articles):
    calls = spark.sparkContext.accumulator(0)

    def load():
        def predict(texts):
            calls.add(len(texts))
            return [("positive" if "good" in t else "neutral", 1.0) for t in texts]

        return predict

    rows = [("", "ann and bob good. ann", "2025-03-31")] * 200
    df = articles(*rows).repartition(8)
    got = index(df, scorer=nl.Model(load))
    assert calls.value == 2
    assert got["A"].total_mentions == 400 and got["B"].total_mentions == 200
    assert got == index(df)
    assert got == index(df, scorer=nl.Model(load), score_partitions=3)


def test_volume_and_index_of_published_results(spark):
    for table in (LEADERS, PARTIES):
        everything = sum(r[-1] for r in table)
        for _, s, v, m, mci, n in table:
            assert round(n / everything, 3) == v
            assert abs(0.4 * s + 0.3 * v + 0.3 * m - mci) < 0.001
    counts = spark.createDataFrame(
        [("A", "positive", 3, 2, 1), ("A", "negative", 1, 1, 0), ("A", "other", 4, 1, 1)],
        "entity string, label string, n long, recent long, previous long",
    )
    assert tuple(scores(counts).collect()[0]) == ("A", 0.25, 1.0, -0.25, 0.325, 8)


def test_volumes_sum_to_one(articles):
    counts = labelled_counts(articles(*random_news(3)), (A, B), scorer=WORDS)
    total = counts.agg(F.sum("n")).collect()[0][0]
    got = nl.confidence_index(articles(*random_news(3)), (A, B), WORDS).collect()
    assert sum(r.total_mentions for r in got) == total
    assert all(-1 <= r.sentiment_score <= 1 for r in got)


def test_sentence_mentions(articles):
    df = articles(("", "ann good bob. x. bob", "2025-03-31"))
    got = {(r.pos, r.entity, r.label) for r in nl.sentence_mentions(df, (A, B), WORDS).collect()}
    assert got == {(0, "A", "positive"), (0, "B", "positive"), (2, "B", "neutral")}

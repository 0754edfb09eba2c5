import math

import numpy as np
import pyarrow as pa
import pytest

from newslens.llm.arrays import string_buffer
from newslens.llm.quality import WIDTH, _fit, class_prior, features, learn, score, slopes, train


def of(*texts):
    return features(*string_buffer(pa.array(texts, pa.string())))


def test_features_do_not_depend_on_neighbours():
    texts = ["One two.\nOne two.", None, "", "ÄÖ | ab !! 12", "x"]
    together = of(*texts)
    assert together.shape == (5, WIDTH) and np.isfinite(together).all()
    for k, t in enumerate(texts):
        assert np.allclose(of(t)[0], together[k], atol=1e-6)
    assert (together[1] == together[2]).all()


def test_prior_and_separation_from_positives_and_mixture():
    rng = np.random.default_rng(3)
    good, bad = rng.normal(1.0, 1.0, (3000, 5)), rng.normal(-1.5, 1.0, (600, 5))
    p, u = good[:1000], np.concatenate([good[1000:], bad])  # 2000 of 2600 unlabelled are positive
    model = train(p, u)
    assert abs(model.prior - 2000 / 2600) < 0.1
    s = model.score(u)
    assert s[:2000].mean() > 0.85 and s[2000:].mean() < 0.2


def test_class_prior_of_identical_scores_is_near_one():
    scores = np.linspace(0, 1, 2000)
    assert class_prior(scores, scores) > 0.9 > class_prior(scores[:20], scores[:20])


@pytest.mark.parametrize("true", [0.3, 0.5, 0.85])
def test_prior_is_estimated_not_assumed(true):
    rng = np.random.default_rng(11)
    n = 3000
    good, bad = rng.normal(1.0, 1.0, (1000 + n, 5)), rng.normal(-1.5, 1.0, (n, 5))
    k = int(n * true)
    u = np.concatenate([good[1000 : 1000 + k], bad[: n - k]])
    assert abs(train(good[:1000], u[rng.permutation(n)]).prior - true) < 0.08


def brute_risk(zp, zu, prior):
    """The risk of positives and the estimated risk of negatives, a text at a time."""
    minus = lambda z: math.log1p(math.exp(z))
    plus = sum(math.log1p(math.exp(-z)) for z in zp) / len(zp)
    return prior * plus, sum(map(minus, zu)) / len(zu) - prior * sum(map(minus, zp)) / len(zp)


@pytest.mark.parametrize("shift", [0.0, 6.0])
def test_slopes_are_those_of_the_non_negative_risk(shift):
    rng = np.random.default_rng(4)
    zp, zu, prior = rng.normal(shift, 1.0, 7), rng.normal(-shift, 1.0, 9), 0.6
    below = brute_risk(zp, zu, prior)[1] < 0
    assert below == (shift > 0)

    def loss(z):  # below zero, the term of negatives alone, turned round
        plus, rest = brute_risk(z[:7], z[7:], prior)
        return -rest if below else plus + rest

    z = np.concatenate([zp, zu])
    want = [(loss(z + d) - loss(z - d)) / 2e-5 for d in np.eye(16) * 1e-5]
    assert np.allclose(np.concatenate(slopes(zp, zu, prior)), want, atol=1e-6)


def test_positives_and_a_mixture_do_as_well_as_labels():
    rng = np.random.default_rng(8)
    draw = lambda n: (rng.normal(1.0, 1.0, (n, 1)), rng.normal(-1.5, 1.0, (n, 1)))
    good, bad = draw(3000)
    w, b = _fit(good[:1500], np.concatenate([good[1500:], bad[:1500]]), 0.5, 1)
    yes, no = draw(5000)
    right = ((yes @ w + b > 0).mean() + (no @ w + b < 0).mean()) / 2
    best = ((yes > -0.25).mean() + (no < -0.25).mean()) / 2  # halfway between the means
    assert right > best - 0.02


def test_odd_rows(spark):
    good = [(i, f"A plain sentence with number {i} and some words.") for i in range(300)]
    junk = [(1000 + i, f"$$$ {i} !!! %%% ### {i} &&& " * 5) for i in range(100)]
    docs = spark.createDataFrame([(*r, "own") for r in good + junk], "doc_id int, text string, score string")
    model = learn(docs.filter("doc_id < 200"), docs)
    odd = spark.createDataFrame(
        [(1, None, 3), (2, "", 3), (3, "word " * 50_000, 3), (4, good[0][1], 3), (4, good[0][1], 3), (None, junk[0][1], 3)],
        "doc_id int, text string, other int",
    )
    out = score(odd, model)
    assert out.columns == ["doc_id", "text", "other", "score"]
    got = [r.score for r in out.collect()]
    assert all(0 <= s <= 1 for s in got) and got[0] == got[1] and got[3] == got[4] > got[5]
    assert score(docs, model).columns == ["doc_id", "text", "score"]
    assert score(odd.limit(0), model).collect() == []
    nothing = learn(docs.limit(0), docs.limit(0))
    assert {r.score for r in score(odd, nothing).collect()} == {0.5}

"""Sentiment scorers: text column in, ``struct<label string, score double>`` out.

The labels that count are ``positive`` and ``negative``; anything else only adds to totals.
"""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from newslens.functions.text import spelled

POSITIVE, NEGATIVE, NEUTRAL, ERROR = "positive", "negative", "neutral", "error"

# A loaded model: a list of texts to as many (label, score) pairs.
Predict = Callable[[list[str]], Sequence[tuple[str, float]]]


@dataclass(frozen=True)
class Lexicon:
    """Own word lists: a positive word decides, else a negative one, else neutral.

    Words match as whole words in any case. A native expression, so scoring stays in the
    scan's stage.
    """

    positive: tuple[str, ...]
    negative: tuple[str, ...]

    native = True

    def score(self, text: Column, on_error: str = "raise") -> Column:
        lowered = F.lower(text)
        found = {
            label: spelled(lowered, [w.lower() for w in words]) if words else F.lit(False)
            for label, words in ((POSITIVE, self.positive), (NEGATIVE, self.negative))
        }
        label = (
            F.when(found[POSITIVE], POSITIVE).when(found[NEGATIVE], NEGATIVE).otherwise(NEUTRAL)
        )
        score = F.when(found[POSITIVE] | found[NEGATIVE], 1.0).otherwise(0.0)
        return F.struct(label.alias("label"), score.alias("score"))


@dataclass(frozen=True)
class Model:
    """An external model, loaded once per Python worker and fed Arrow batches.

    ``load`` returns the predict function; it runs on the executors. ``key`` names the loaded
    model there: a worker that has it does not load it again. Equal texts of a batch are scored
    once. ``on_error="label"`` turns a failing text into ``("error", 0.0)``; ``"raise"``
    fails the job.
    """

    load: Callable[[], Predict]
    key: str = field(default_factory=lambda: uuid.uuid4().hex)

    native = False

    def score(self, text: Column, on_error: str = "raise") -> Column:
        if on_error not in ("raise", "label"):
            raise ValueError(f"unknown error rule {on_error!r}")
        load, key = self.load, self.key

        @F.pandas_udf("label string, score double")
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            predict = loaded(load, key)
            for batch in batches:
                yield score_batch(predict, batch, on_error)

        # keeps a filter on the label from running the model a second time
        return run.asNondeterministic()(text)


def loaded(load: Callable[[], Predict], key: str) -> Predict:
    """The worker's model of this key.

    Kept beside the worker's modules: this module itself travels with every task as a copy.
    """
    kept = sys.modules.setdefault("_newslens_models", types.ModuleType("_newslens_models"))
    if key not in kept.__dict__:
        kept.__dict__[key] = load()
    return kept.__dict__[key]


def score_batch(predict: Predict, texts: pd.Series, on_error: str) -> pd.DataFrame:
    """Score each distinct text once; after a failed batch, one by one."""
    codes, distinct = pd.factorize(texts.fillna(""))
    asked = list(distinct)
    try:
        pairs = _pairs(predict, asked)
    except Exception:
        if on_error == "raise":
            raise
        pairs = [_one(predict, text) for text in asked]
    scored = pd.DataFrame(pairs, columns=["label", "score"])
    return scored.iloc[codes].reset_index(drop=True)


def _pairs(predict: Predict, texts: list[str]) -> list[tuple[str, float]]:
    pairs = [(label, float(score)) for label, score in predict(texts)] if texts else []
    if len(pairs) != len(texts):
        raise ValueError(f"{len(texts)} texts gave {len(pairs)} labels")
    return pairs


def _one(predict: Predict, text: str) -> tuple[str, float]:
    try:
        return _pairs(predict, [text])[0]
    except Exception:
        return (ERROR, 0.0)

"""Media-coverage analytics on Spark: articles, mentions, sentiment, confidence index."""

from pyspark import cloudpickle as _cloudpickle


from newslens.functions.sentiment import Lexicon, Model
from newslens import rules, schemas
from newslens.operators import clean, extract, listing, mentions, order, phrases, terms
from newslens.plans.articles import build_articles, of_status, visits
from newslens.plans import cube, walks
from newslens.plans.confidence import confidence_index, confidence_indexes, sentence_mentions
from newslens.plans.labels import label_articles
from newslens.plans.tracking import expand_counts, mention_totals, track_mentions
from newslens.plans.views import (
    coverage_ratio,
    daily_mentions,
    gauges,
    momentum_trend,
    ranking,
    scenario,
)
from newslens.rules import (
    COUNT_RULES,
    KEYWORDS,
    LEADER_PATTERNS,
    LEADER_VARIANTS,
    PARTY_LEADERS,
    PARTY_PATTERNS,
    PARTY_VARIANTS,
    SITE_RULES,
    CountRule,
    EntityPattern,
    SiteRule,
    Variants,
)
from newslens.sources import tables
from newslens.sources.labels import LabelStore

# The Python steps travel with the plan, so executors need no installed copy.
_cloudpickle.register_pickle_by_value(__import__(__name__))

__all__ = [n for n in dir() if not n.startswith("_")]

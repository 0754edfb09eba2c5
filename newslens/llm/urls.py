"""URL verdicts by longest match in a trie of host labels and path segments.

A rule has a verdict, a host and a path. It fits a URL whose host is the rule's host or a
subdomain of it, and whose path starts with the rule's path. Of the rules that fit, the one
with the most host labels wins, then the one with the longest path; of equal (host, path)
pairs the last one given holds. Without a rule the default verdict holds.

Defined results: a null URL, or one without ``://``, has an empty host and path, fits no rule
and gets the default verdict. Equal rows give equal rows. An empty table gives an empty table.
Columns of the input that clash with an added one (host, path, rule, verdict) are replaced.
A URL of any length is read whole.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslens.llm.common import LOWER, UPPER

#: Rules in one broadcast trie; more rules go into several tries, broadcast one by one.
RULES_PER_TRIE = 200_000
#: Longest rule in characters: with the number of rules it bounds the size of a broadcast.
MAX_RULE = 2_000

ADDED = ("host", "path", "rule", "verdict")


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str = ""

    @property
    def text(self) -> str:
        return self.host + self.path


def trie(rules: Sequence[Rule]) -> dict:
    """Rules by reversed host labels; below each host, by whole path segments.

    ``None`` leads from a host to its paths, and from a path to the rules that end inside the
    next segment, longest ending first.
    """
    top: dict = {}
    for rule in rules:
        labels = rule.host.split(".")[::-1] if rule.host else []
        node = top
        for label in labels:
            node = node.setdefault(label, {})
        *whole, ending = rule.path.split("/")
        node = node.setdefault(None, {})
        for segment in whole:
            node = node.setdefault(segment, {})
        endings = node.setdefault(None, {})
        endings[ending] = (len(labels), len(rule.path), rule.text, rule.verdict)
        node[None] = dict(sorted(endings.items(), key=lambda e: -len(e[0])))
    return top


def find(node: dict, host: str, path: str) -> tuple | None:
    """The winning rule (labels, characters of path, text, verdict): deeper hosts first."""
    levels = [node[None]] if None in node else []
    for label in reversed(host.split(".") if host else []):
        node = node.get(label)
        if node is None:
            break
        if None in node:
            levels.append(node[None])
    segments = path.split("/")
    for paths in reversed(levels):
        best = None
        for segment in segments:
            fits = (r for end, r in paths.get(None, {}).items() if segment.startswith(end))
            best = next(fits, best)
            paths = paths.get(segment)
            if paths is None:
                break
        if best:
            return best
    return None


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    at = F.coalesce(F.locate("://", url), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    raw = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(raw, UPPER, LOWER), path


def judge(
    pages: DataFrame, rules: Sequence[Rule], url: str = "url", default: str = "allow"
) -> DataFrame:
    """Adds host, path, rule (null without one) and verdict to every row.

    Each trie is broadcast: at most ``RULES_PER_TRIE`` rules of ``MAX_RULE`` characters.
    A longer list is split; the best match over all tries is kept, so nothing is cut off.
    """
    for rule in rules:
        if rule.verdict not in ("allow", "block"):
            raise ValueError(f"unknown verdict {rule.verdict!r}")
        if len(rule.text) > MAX_RULE:
            raise ValueError(f"a rule is longer than {MAX_RULE} characters")
    host, path = host_and_path(F.col(url))
    kept = [c for c in pages.columns if c.lower() not in ADDED]
    rows = pages.select(F.struct(*kept).alias("row"), host.alias("host"), path.alias("path"))
    last = list({(r.host, r.path): r for r in rules}.values())
    best = F.struct(
        F.lit(-1).alias("labels"), F.lit(-1).alias("chars"),
        F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"),
    )
    context = pages.sparkSession.sparkContext
    for start in range(0, len(last), RULES_PER_TRIE):
        tree = context.broadcast(trie(last[start : start + RULES_PER_TRIE]))
        best = F.greatest(best, _matches(tree, default)(F.col("host"), F.col("path")))
    return rows.withColumn("best", best).select("row.*", "host", "path", "best.rule", "best.verdict")


def _matches(tree, default: str):
    none = (-1, -1, None, default)

    @F.pandas_udf("labels int, chars int, rule string, verdict string")
    def match(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for hosts, paths in batches:
            rows = [find(tree.value, h, p) or none for h, p in zip(hosts, paths)]
            yield pd.DataFrame(rows, columns=["labels", "chars", "rule", "verdict"])

    return match

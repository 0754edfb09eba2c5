"""The jobs from the command line, one step each.

Each step reads tables by path and writes a table; Parquet unless the path ends in ``.csv``.
Results (one row per entity) are always CSV with the titles of their view. Steps with several
tables write them below ``--out``.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

import newslens as nl
from newslens.sources import tables

VIEWS = {
    "Leader": (nl.LEADER_PATTERNS, nl.LEADER_VARIANTS),
    "Party": (nl.PARTY_PATTERNS, nl.PARTY_VARIANTS),
}


def _form(path: str) -> str:
    return "csv" if path.rstrip("/").endswith(".csv") else "parquet"


def _articles(spark: SparkSession, path: str) -> DataFrame:
    return tables.read_articles(spark, path, _form(path))


def _scorer(args: argparse.Namespace) -> nl.Lexicon:
    return nl.Lexicon(tuple(args.positive), tuple(args.negative))


def articles(spark: SparkSession, args: argparse.Namespace) -> None:
    pages = spark.read.schema(nl.schemas.LANDED_PAGE).parquet(args.pages)
    lists = spark.read.schema(nl.schemas.LISTING_PAGE).parquet(args.listing_pages)
    built = nl.build_articles(pages, nl.extract.links(lists), as_of=args.as_of)
    tables.write_articles(built, args.out, _form(args.out), args.mode)
    summary = tables.run_summary(_articles(spark, args.out)).first()  # one row
    print(*[f"{name}: {n}" for name, n in summary.asDict().items()], sep="\n")


def track(spark: SparkSession, args: argparse.Namespace) -> None:
    entities = nl.mentions.entities_of(nl.COUNT_RULES)
    tracked = nl.track_mentions(_articles(spark, args.articles))
    tables.write_tracked(tracked, args.out, _form(args.out), args.mode)
    stored = tables.read_tracked(spark, args.out, entities, _form(args.out))
    nl.mention_totals(stored, entities).write.mode(args.mode).parquet(args.totals)


def label(spark: SparkSession, args: argparse.Namespace) -> None:
    labelled = nl.label_articles(_articles(spark, args.articles), _scorer(args))
    tables.write_labelled(labelled, args.out, _form(args.out), args.mode)


def confidence(spark: SparkSession, args: argparse.Namespace) -> None:
    patterns, _ = VIEWS[args.view]
    results = nl.confidence_index(
        _articles(spark, args.articles),
        patterns,
        _scorer(args),
        keep_unmentioned=args.view == "Leader",
    )
    tables.write_results(results, args.out, args.view, args.mode)


def ranking(spark: SparkSession, args: argparse.Namespace) -> None:
    results = tables.read_results(spark, args.results, args.view)
    scenarios = nl.scenario(results, *args.weights)
    for view in (nl.ranking, nl.momentum_trend, nl.gauges):
        view(scenarios).write.mode(args.mode).parquet(f"{args.out.rstrip('/')}/{view.__name__}")


def daily(spark: SparkSession, args: argparse.Namespace) -> None:
    _, variants = VIEWS[args.view]
    results = tables.read_results(spark, args.results, args.view) if args.results else None
    days = nl.daily_mentions(_articles(spark, args.articles), variants, args.last_days, results)
    days.write.mode(args.mode).parquet(args.out)


def ratio(spark: SparkSession, args: argparse.Namespace) -> None:
    nl.coverage_ratio(_articles(spark, args.articles)).write.mode(args.mode).parquet(args.out)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="newslens", description=__doc__.splitlines()[0])
    steps = top.add_subparsers(required=True)

    def step(run, *paths: str, view: bool = False, words: bool = False):
        sub = steps.add_parser(run.__name__)
        sub.set_defaults(run=run)
        for path in (*paths, "out"):
            sub.add_argument(f"--{path}", required=True)
        sub.add_argument("--mode", default="error", choices=["error", "overwrite"])
        if view:
            sub.add_argument("--view", default="Leader", choices=list(VIEWS))
        if words:
            for tone in ("positive", "negative"):
                sub.add_argument(f"--{tone}", nargs="+", required=True, help=f"{tone} words")
        return sub

    step(articles, "pages", "listing-pages").add_argument("--as-of", help="default: now")
    step(track, "articles", "totals")
    step(label, "articles", words=True)
    step(confidence, "articles", view=True, words=True)
    step(ranking, "results", view=True).add_argument(
        "--weights", nargs=3, type=float, default=(0.4, 0.3, 0.3), metavar=("S", "V", "M")
    )
    sub = step(daily, "articles", view=True)
    sub.add_argument("--last-days", type=int, help="default: all days")
    sub.add_argument("--results", help="only the entities of this result file")
    step(ratio, "articles")
    return top


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(SparkSession.builder.appName("newslens").getOrCreate(), args)


if __name__ == "__main__":
    main()

"""Literal spellings given as a table, of any number, found by joining.

A text is cut into words and what stands between them. Where a word is the first of some spelling, the stretches of
as many words as spellings have are built, and equi-joined with the spellings: a spelling is found as whole words exactly if it
is such a stretch. Both steps first ask a Bloom filter of the spellings, so that a text sends on little more
than what it holds. The texts themselves are never shuffled. Everything is Spark expressions.

Spellings that do not begin and end with a word character are few and cannot be cut so; they go through the
automaton of ``terms``.

Rows are told apart by their number in the scan, so rows that agree in all columns count each. Null text is empty.
A spelling that is null or empty finds nothing; repeated ones count once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslens.functions import text
from newslens.operators import clean, terms
from newslens.operators.bloom import Filter

_PIECES, _WORD = r"(?U)\w+|\W+", r"(?U)^\w(?:.*\w)?$"
_FIRST, _WHOLE = 1, 2  # the filter's two kinds of entry


def pieces(column: Column) -> Column:
    """Words and what stands between them, in turn."""
    return F.regexp_extract_all(column, F.lit(_PIECES), F.lit(0))


def table_of(variants) -> list[tuple[str, str]]:
    """(entity, variant) rows of ``Variants`` rules, for ``createDataFrame``."""
    return [(v.entity, spelling) for v in variants for spelling in v.variants]


def _cleaned(variants: DataFrame) -> DataFrame:
    rows = variants.select("entity", F.col("variant").alias("gram")).filter("entity IS NOT NULL AND gram != ''")
    return rows.distinct().withColumn("pieces", pieces(F.col("gram")))


def named(articles: DataFrame, variants: DataFrame, *keep: Column | str) -> DataFrame:
    """(entity, row, *keep): once for each article and each entity whose spelling its title or content holds."""
    spelled = _cleaned(variants)
    joined = spelled.filter(F.col("gram").rlike(_WORD))
    lengths = joined.groupBy(F.expr("(size(pieces) + 1) div 2").cast("int").alias("n")).agg(F.count(F.lit(1)).alias("spellings"))
    lengths = sorted(lengths.collect())  # a row for each length in words
    rows = clean.no_null_text(articles).select(
        F.monotonically_increasing_id().alias("row"), *keep,
        F.lower("title").alias("_title"), F.lower("content").alias("_content"),
    )
    kept = [c for c in rows.columns if c not in ("_title", "_content")]
    odd = spelled.filter(~F.col("gram").rlike(_WORD)).select("entity", "gram")
    found = []
    if lengths:
        keys = joined.select(
            F.explode(F.array(F.xxhash64(F.lit(_FIRST), F.col("pieces")[0]), F.xxhash64(F.lit(_WHOLE), "gram"))).alias("key")
        )
        bloom = Filter(keys, 2 * sum(r["spellings"] for r in lengths))
        cut = rows.withColumns({"_title": pieces(F.col("_title")), "_content": pieces(F.col("_content")), "_words": bloom.words.scalar()})
        grams = F.array_union(*[_grams(F.col(c), bloom, [r["n"] for r in lengths]) for c in ("_title", "_content")])
        grams = cut.select(*kept, F.explode(grams).alias("gram"))
        found.append(grams.join(joined.select("entity", "gram"), "gram").select("entity", *kept))
    if not odd.isEmpty():
        escaped = F.regexp_replace("gram", r"([\\\[\](){}.*+?^$|\-&~#])", r"\\$1")
        rules = odd.select("entity", F.concat(F.lit(r"\b"), escaped, F.lit(r"\b")).alias("pattern"))
        both = rows.select(*kept, F.explode(F.array("_title", "_content")).alias("_text"))
        both = terms.with_candidates(both, "_text", rules, "_rules")
        found.append(both.select(F.explode(terms.matching(F.col("_text"), F.col("_rules"))).alias("entity"), *kept))
    if not found:
        return rows.select(F.lit(None).cast("string").alias("entity"), *kept).filter("false")
    every = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    return every.dropDuplicates(["row", "entity"])


def _grams(cut: Column, bloom: Filter, lengths: list[int]) -> Column:
    """The distinct stretches of words that may be spellings."""
    held = lambda kind, value: bloom.may_hold(F.col("_words"), F.xxhash64(F.lit(kind), value))
    first = F.when(F.get(cut, F.lit(0)).rlike(r"(?U)^\w"), 1).otherwise(2)
    places = F.when(F.size(cut) >= first, F.sequence(first, F.size(cut), F.lit(2))).otherwise(F.array().cast("array<int>"))
    starts = F.filter(places, lambda i: held(_FIRST, F.element_at(cut, i)))
    stretches = F.transform(
        starts,
        lambda i: F.transform(
            F.array(*map(F.lit, lengths)),
            lambda n: F.when(i + 2 * n - 2 <= F.size(cut), F.array_join(F.slice(cut, i, 2 * n - 1), "")),
        ),
    )
    return F.filter(F.array_distinct(F.flatten(stretches)), lambda g: g.isNotNull() & held(_WHOLE, g))


def article_counts(articles: DataFrame, variants: DataFrame) -> DataFrame:
    """(entity, articles): articles that name each entity of the table, zero included."""
    counted = named(articles, variants).groupBy("entity").agg(F.count(F.lit(1)).alias("articles"))
    every = variants.select("entity").filter("entity IS NOT NULL").distinct()
    return every.join(counted, "entity", "left").select("entity", F.coalesce("articles", F.lit(0)).alias("articles"))


def daily_mentions(articles: DataFrame, variants: DataFrame) -> DataFrame:
    """(entity, date, mentions): articles per entity and day, days without any left out."""
    dated = clean.with_day(clean.dated(articles))
    return named(dated, variants, "date").groupBy("entity", "date").agg(F.count(F.lit(1)).alias("mentions"))


def coverage_ratio(articles: DataFrame, pairs: DataFrame, parties: DataFrame, leaders: DataFrame) -> DataFrame:
    """(party, leader, leader_to_party_ratio): leader articles / (party articles + 1).

    ``pairs`` is a table (party, leader), the others are (entity, variant). One pass over the texts counts
    both kinds, which the pairs join one after the other. A pair without variants fails the job.
    """
    kinds = {"party": parties, "leader": leaders}
    # a party and a leader may share a name
    tagged = [v.select(F.concat(F.lit(f"{k}:"), "entity").alias("entity"), "variant") for k, v in kinds.items()]
    counted = article_counts(clean.dated(articles), tagged[0].unionByName(tagged[1]))
    rows = pairs.select("party", "leader")
    for kind in kinds:
        mine = counted.filter(F.col("entity").startswith(f"{kind}:")).select(
            F.substring("entity", len(kind) + 2, 1 << 30).alias(kind), F.col("articles").alias(f"_{kind}")
        )
        missing = F.raise_error(F.concat(F.lit("no variants for "), F.col(kind)))
        rows = rows.join(mine, kind, "left").withColumn(f"_{kind}", F.coalesce(f"_{kind}", missing.cast("bigint")))
    ratio = F.round(F.col("_leader") / (F.col("_party") + 1), 3)
    return rows.select("party", "leader", ratio.alias("leader_to_party_ratio"))

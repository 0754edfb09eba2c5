"""Document fingerprints from closed syncmers.

The alphabet is the text's words. In scripts that are written without spaces, and in runs of more than ``LONG``
code points, each code point is a word. A k-mer of ``K`` words is an anchor if the least hash
among its inner ``S``-mers lies at its first or last place. Whether a k-mer is an anchor depends on
nothing but itself, so a passage gives the same anchors wherever it stands, and their positions
can be matched between documents. The fingerprint is the bottom-``SIZE`` sketch of a text's
anchors: their ``SIZE`` least hashes, in hex. The likeness of two fingerprints is the share of the
``SIZE`` least hashes of both that both have, an estimate of the anchors' Jaccard similarity.

A text of fewer than ``K`` words has anchors of ``SHORT_K`` code points instead, by ``SHORT_S``-mers, over its words with one space
between them. Sketches of texts of fewer than 2 * ``K`` words have both kinds, so that short texts are comparable with
somewhat longer ones.

Everything is DataFrame expressions over the array of a text's words; a text is read whole.

Defined results: null text is empty; an empty text has no anchor and an empty fingerprint, whose
likeness to another empty one is 1 and to any other 0. Very long texts are read whole and have as many hashes in
their sketch as others. Repeated rows have equal fingerprints each; an empty table gives an empty table. A text without a word, or of fewer than ``K`` words
and ``SHORT_K`` code points, has one anchor, the hash of all of it. Equal texts have equal fingerprints.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newslens.llm.common import or_empty, written

K, S, SIZE = 5, 2, 64
SHORT_K, SHORT_S, LONG = 10, 4, 32
SLICE_ROWS = 1024
BOUNDS = 1000  # quantiles of the ids at most
WORD_GAPS = r"[\x20\x09-\x0D]+"
#: Thai, Lao, Tibetan, Burmese, Khmer, ideographs and kana.
UNSEGMENTED = (
    r"[\x{0E00}-\x{109F}\x{1780}-\x{17FF}\x{2E80}-\x{2FDF}\x{3005}-\x{3007}\x{3031}-\x{312F}\x{31F0}-\x{31FF}"
    r"\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{323AF}]"
)


def with_anchors(df: DataFrame, text: str, out: str, k: int = K, s: int = S, short: str | None = None) -> DataFrame:
    """Adds ``out``: array of struct(position in words, or code points if there are too few, hash), in text order.

    Also adds ``short``, if named: the anchors of code points of texts that have at least ``k`` words, but fewer than 2 * ``k``.
    """
    if not 0 < s < k:
        raise ValueError("the inner length must be between 0 and k")
    words, seen, spelled = f"_{out}_words", f"_{out}_hashes", f"_{out}_spelled"
    df = df.withColumn(words, _words(or_empty(text)))
    df = df.withColumn(seen, F.transform(words, lambda w: F.xxhash64(w)))
    df = _syncmers(df, seen, out, k, s)
    df = _spelled(df, words, spelled, F.size(words) < (2 * k if short else k))
    whole = F.array(F.struct(F.lit(0).alias("position"), F.xxhash64(or_empty(text), F.lit(k)).alias("hash")))
    none = F.array().cast("array<struct<position:int,hash:bigint>>")
    rest = F.when(F.length(or_empty(text)) > 0, whole).otherwise(none)
    if short:
        df = df.withColumn(short, F.when(F.size(words) >= k, F.coalesce(spelled, none)).otherwise(none))
    return df.withColumn(out, F.coalesce(out, spelled, rest)).drop(words, seen, spelled)


def _words(text: Column) -> Column:
    """The words of a text, those of ``UNSEGMENTED`` scripts and long runs by code points."""
    apart = F.when(text.rlike(UNSEGMENTED), F.regexp_replace(text, f"({UNSEGMENTED})", " $1 ")).otherwise(text)
    split = F.filter(F.split(apart, WORD_GAPS), lambda w: w != "")
    parts = F.flatten(F.transform(split, lambda w: F.when(F.length(w) > LONG, F.split(w, "")).otherwise(F.array(w))))
    return F.when(F.exists(split, lambda w: F.length(w) > LONG), parts).otherwise(split)


def _syncmers(df: DataFrame, hashes: str, out: str, k: int, s: int) -> DataFrame:
    """Adds ``out``, the anchors of a sequence of hashes; null if it has fewer than ``k``."""
    width, inner = k - s + 1, f"_{out}_inner"
    hashed = F.transform(
        F.sequence(F.lit(1), F.size(hashes) - (s - 1)), lambda i: F.xxhash64(F.slice(hashes, i, s))
    )
    df = df.withColumn(inner, F.when(F.size(hashes) >= k, hashed))
    edges = F.filter(
        F.sequence(F.lit(1), F.size(inner) - (width - 1)),
        lambda i: F.array_min(F.slice(inner, i, width))
        == F.least(F.get(F.col(inner), i - 1), F.get(F.col(inner), i + (width - 2))),
    )
    # inner s-mers at steps of s, and the last one, spell the whole k-mer
    steps = [*range(0, k - s, s), k - s]
    anchors = F.transform(
        edges,
        lambda i: F.struct(
            (i - 1).alias("position"),
            F.xxhash64(*[F.get(F.col(inner), i - 1 + step) for step in steps]).alias("hash"),
        ),
    )
    return df.withColumn(out, F.when(F.col(inner).isNotNull(), anchors)).drop(inner)


def _spelled(df: DataFrame, words: str, out: str, when: Column) -> DataFrame:
    """Adds ``out``, the anchors of the code points of few words; null without such."""
    seen = f"_{out}_hashes"
    letters = F.transform(F.split(F.array_join(words, " "), ""), lambda c: F.xxhash64(c))
    df = df.withColumn(seen, F.when(when, letters))
    df = _syncmers(df, seen, out, SHORT_K, SHORT_S).drop(seen)
    return df.withColumn(out, F.when(F.size(out) > 0, F.col(out)))


def sketch(anchors: str | Column, size: int = SIZE) -> Column:
    """The ``size`` least distinct anchor hashes, ascending."""
    hashes = F.transform(anchors, lambda a: a["hash"])
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, size)


def fingerprint(sketch: str | Column) -> Column:
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def likeness(a: str, b: str, size: int = SIZE) -> Column:
    """Share of the least ``size`` hashes of both sketches that are in both."""
    least = F.slice(F.sort_array(F.array_union(a, b)), 1, size)
    both = F.size(F.array_intersect(least, F.array_intersect(a, b)))
    return F.when(F.size(least) == 0, 1.0).otherwise(F.try_divide(both.cast("double"), F.size(least)))


def with_next(
    docs: DataFrame,
    id: str,
    value: str,
    derive: Callable[[DataFrame], DataFrame] = lambda df: df,
    derived: Sequence[str] = (),
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Adds ``next_<value>``: of the row with the next id, ascending; of the last row, the first's.

    Rows are cut into slices of about ``slice_rows``: at up to ``BOUNDS`` quantiles of the ids, then between two of them by
    width. An id at a quantile has slices of its own, by a hash of the value, so neither a few ids far from the others nor an
    id with many rows makes a slice large (over ``rows / BOUNDS``). Each slice also gets a copy of the row
    that follows it, so one shuffle is enough. ``derive`` adds columns after that
    shuffle, and those in ``derived`` are also taken from the next row. Rows of one id are ordered by the
    value, those of an id with several slices by its hash first; rows without an id come first and are such an id. Texts
    cross the network once: what is copied is found by a join with one number per slice.

    Defined results: an empty table gives an empty table; repeated rows follow each other; a single row is its own next. Ids are
    whole numbers. The columns that this adds for itself must not be there before: ``_id``, ``_tie``, ``_slice``, ``_copy``.
    """
    clash = {"_id", "_tie", "_slice", "_copy"} & set(docs.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are this operator's own")
    rows = _sliced(docs.withColumn("_id", F.col(id).cast("bigint")), value, slice_rows)

    firsts = rows.groupBy("_slice").agg(F.min(F.struct("_id", "_tie")).alias("_key"))
    block = F.floor(F.col("_slice") / 4096).cast("bigint")
    firsts = written(firsts.withColumn("_block", block), "firsts")
    inside = Window.partitionBy("_block").orderBy("_slice")
    ends = firsts.groupBy("_block").agg(F.max("_slice").alias("_end"))
    across = Window.partitionBy(F.lit(0)).orderBy("_block")  # a row per 4096 ranges
    last = ends.agg(F.max("_end").alias("m")).scalar()
    ends = ends.select("_block", F.coalesce(F.lag("_end").over(across), last).alias("_earlier"))
    halo = firsts.withColumn("_to", F.lag("_slice").over(inside)).join(ends, "_block")
    # a row per range: written, so that its size is known when the join with the texts is planned
    halo = written(halo.select("_key.*", F.coalesce("_to", "_earlier").alias("_to")), "halo")
    following = rows["_id"].eqNullSafe(halo["_id"]) & (rows["_tie"] == halo["_tie"])
    copies = rows.drop("_slice").join(halo, following).select(
        *[rows[c] for c in rows.columns if c != "_slice"], halo["_to"].alias("_slice")
    )
    both = rows.withColumn("_copy", F.lit(False)).unionByName(copies.withColumn("_copy", F.lit(True)))
    both = derive(both.repartition("_slice"))
    order = Window.partitionBy("_slice").orderBy("_copy", "_id", "_tie", value)
    return (
        both.withColumns({f"next_{v}": F.lead(v).over(order) for v in (value, *derived)})
        .filter("NOT _copy")
        .drop("_copy", "_id", "_tie", "_slice")
    )


def _sliced(rows: DataFrame, value: str, slice_rows: int) -> DataFrame:
    """Adds ``_slice``, which ascends with (_id, _tie), and ``_tie``, by which the rows of an id with several slices are ordered."""
    n = rows.count()
    parts = max(1, min(BOUNDS, -(-n // slice_rows)))
    points = F.lit(",".join(str(k / parts) for k in range(1, parts + 1)))
    points = F.split(points, ",").cast("array<double>")
    bounds = rows.agg(F.percentile_approx("_id", points, F.lit(100 * BOUNDS)).alias("b")).first()["b"] or []
    listed = F.split(F.lit(",".join(map(str, sorted(set(bounds))))), ",")
    listed = listed.cast("array<bigint>") if bounds else F.array().cast("array<bigint>")
    rows = rows.withColumn("_bounds", listed)
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(BOUNDS.bit_length()))])
    below = F.aggregate(
        steps, F.lit(0), lambda at, step: F.when(F.get("_bounds", at + step - 1) < F.col("_id"), at + step).otherwise(at)
    )
    rows = rows.withColumn("_below", below)
    at_bound = F.coalesce((F.get("_bounds", F.col("_below")) == F.col("_id")).cast("int"), F.lit(0))
    rows = rows.withColumn("_range", F.when(F.col("_id").isNull(), 0).otherwise(1 + 2 * F.col("_below") + at_bound))
    rows = rows.drop("_bounds", "_below")

    counts = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("n"), F.min("_id").alias("low"), F.max("_id").alias("high"))
    ranges, first = [], 0
    for r in sorted(counts.collect()):  # at most 2 * BOUNDS + 2 rows
        slices = -(-r["n"] // slice_rows)
        one_id = r["low"] == r["high"]
        width = 1.0 if one_id else (r["high"] - r["low"] + 1) / slices
        ranges.append((r["_range"], first, slices, one_id, float(r["low"] or 0), width))
        first += slices
    schema = "_range int, _first long, _slices long, _one boolean, _low double, _width double"
    placed = rows.join(F.broadcast(rows.sparkSession.createDataFrame(ranges, schema)), "_range")
    share = F.pmod(F.xxhash64(value), F.lit(1 << 31))
    by_hash = F.floor(share * F.col("_slices") / F.lit(float(1 << 31)))
    by_width = F.least(F.floor((F.col("_id").cast("double") - F.col("_low")) / F.col("_width")), F.col("_slices") - 1)
    several = F.col("_one") & (F.col("_slices") > 1)
    return placed.select(
        *[c for c in rows.columns if c != "_range"],
        (F.col("_first") + F.when(F.col("_one"), by_hash).otherwise(by_width)).cast("bigint").alias("_slice"),
        F.when(several, share).otherwise(F.lit(0)).cast("bigint").alias("_tie"),
    )


def with_sketch(df: DataFrame, text: str = "text", out: str = "sketch") -> DataFrame:
    """Adds the sketch of a text."""
    df = with_anchors(df, text, "_anchors", short="_short")
    return df.withColumn(out, sketch(F.concat("_anchors", "_short"))).drop("_anchors", "_short")

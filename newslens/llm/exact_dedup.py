"""Exact deduplication by progressive refinement: length, then prefix hash, then full hash.

Texts are equal when they are the same after every character of ``[\\x20\\x09-\\x0D]`` is
deleted. Rows are first grouped by the length of the normalised text; rows of shared lengths by length and hash of a
short prefix; the full digest decides only for rows whose (length, prefix hash) is shared. What survives a step
is told to the next scan by a Bloom filter, so no text enters a shuffle: lengths, prefix hashes and digests do. (The
operator's result names the digest of every text, so the last scan takes it of all; ``copy_groups`` alone takes it of
survivors.) Groupings are aggregates with map-side combining, and the join that tells each row its
group deals out the rows of frequent texts, so one text may hold any share of the rows.

Of a group, the row with the most code points in its original text stays, then the smallest
id (a null id counts as the largest). Defined results: null text is the empty text, and equal to
every text of spaces only. One row comes out for each row; rows that agree in id, length and normalised text are one
document and are kept or dropped alike, and ``group_size`` counts each of them. An empty table gives an
empty table. Texts of any length are read whole. Other columns are never read, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslens.llm.common import or_empty, without_spaces, written
from newslens.operators.bloom import Filter
from newslens.operators.salted import salted_join

PREFIX = 64  # characters of the normalised text behind the second key


def _told(rows: DataFrame, keys: DataFrame, key: Column) -> DataFrame:
    """Rows whose key may be among ``keys``, in the scan's stage."""
    held = Filter(keys, keys.count())
    return rows.withColumn("_words", held.words.scalar()).withColumn("told", held.may_hold(F.col("_words"), key)).drop("_words")


def _survivors(docs: DataFrame, text: str, prefix: int) -> tuple[DataFrame, Column, Column]:
    """(keys that several rows share, the key of a row, the normalised text): by length, then by length and prefix hash."""
    plain = without_spaces(or_empty(text))
    size = F.length(plain)
    by_size = F.xxhash64(size)
    sizes = docs.select(by_size.alias("key")).groupBy("key").count().filter("count > 1").select("key")
    shared = _told(docs.select(by_size.alias("size_key"), plain.alias("plain")), written(sizes, "lengths"), F.col("size_key"))
    key = F.xxhash64(F.length("plain"), F.substring("plain", 1, prefix))
    starts = shared.filter("told").select(key.alias("key")).groupBy("key").count().filter("count > 1").select("key")
    return written(starts, "starts"), F.xxhash64(size, F.substring(plain, 1, prefix)), plain


def _hashed(docs: DataFrame, id: str, text: str, prefix: int, all_rows: bool) -> DataFrame:
    """(id, n_chars, digest, told) of the rows that may have a copy, or of all."""
    starts, key, plain = _survivors(docs, text, prefix)
    rows = docs.select(
        F.col(id).alias("id"), F.length(or_empty(text)).cast("bigint").alias("n_chars"), key.alias("key"), plain.alias("plain")
    )
    rows = _told(rows, starts, F.col("key"))
    rows = rows if all_rows else rows.filter("told")
    return written(rows.select("id", "n_chars", F.sha2("plain", 256).alias("digest"), "told"), "digests")


def _groups(hashed: DataFrame) -> DataFrame:
    best = F.min(F.struct((-F.col("n_chars")).alias("c"), F.col("id").isNull().alias("n"), "id"))
    return (
        hashed.filter("told")
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("group_size"), best.alias("best"))
        .filter("group_size > 1")
        .select(
            "digest",
            F.col("best.id").alias("keep_id"),
            (-F.col("best.c")).alias("keep_chars"),
            "group_size",
        )
    )


def copy_groups(docs: DataFrame, id: str = "doc_id", text: str = "text", prefix: int = PREFIX) -> DataFrame:
    """(digest, keep_id, keep_chars, group_size): one row per text that several rows have."""
    return _groups(_hashed(docs, id, text, prefix, all_rows=False))


def exact_dedup(docs: DataFrame, id: str = "doc_id", text: str = "text", prefix: int = PREFIX) -> DataFrame:
    """One row per row: (id, n_chars, digest, keep_id, group_size, kept)."""
    each = _hashed(docs, id, text, prefix, all_rows=True)
    alone = F.col("group_size").isNull()
    chosen = F.col("keep_id").eqNullSafe(F.col("id")) & (F.col("keep_chars") == F.col("n_chars"))
    found = salted_join(each.filter("told").drop("told"), written(_groups(each), "groups"), ["digest"], "left")
    columns = [F.col("id").alias(id), "n_chars", "digest"]
    found = found.select(
        *columns,
        F.when(alone, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        (alone | F.coalesce(chosen, F.lit(False))).alias("kept"),
    )
    lone = each.filter("NOT told").select(*columns, F.col("id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept"))
    return found.unionByName(lone)

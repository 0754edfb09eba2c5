"""Column expressions and plan helpers that several operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslens.sources.workspace import written

SPACES = " \t\n\x0b\f\r"  # the characters [\x20\x09-\x0D]
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

__all__ = ["LOWER", "SPACES", "UPPER", "WORD", "doc_part", "or_empty", "without_spaces", "word_count", "written"]


def or_empty(text: str | Column) -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def without_spaces(text: Column) -> Column:
    return F.translate(text, SPACES, "")


def word_count(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+`` as bigint."""
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def doc_part(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as the text ``''``."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % parts


def columns_but(df: DataFrame, *names: str) -> list[str]:
    return [c for c in df.columns if c not in names]

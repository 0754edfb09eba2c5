"""Text expressions. Everything here stays inside the JVM."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def or_empty(text: Column | str) -> Column:
    """Null text becomes the empty string."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def full_text(title: Column | str = "title", content: Column | str = "content") -> Column:
    """Lowercased title, a space, content: the text mentions are counted in."""
    return F.lower(F.concat_ws(" ", or_empty(title), or_empty(content)))


def search_text(title: Column | str = "title", content: Column | str = "content") -> Column:
    """Lowercased content, a space, title: the text keywords are looked up in."""
    return F.lower(F.concat_ws(" ", or_empty(content), or_empty(title)))


def shortest(words: Iterable[str]) -> list[str]:
    """Drop every word that contains another one.

    A text holds some word of the list exactly when it holds some word of this one.
    """
    kept: list[str] = []
    for word in sorted(set(words), key=lambda w: (len(w), w)):
        if not any(k in word for k in kept):
            kept.append(word)
    return kept


def contains_any(text: Column, words: Iterable[str]) -> Column:
    """Plain substring test for any of ``words``; no word boundaries."""
    return reduce(or_, [text.contains(w) for w in shortest(words)], F.lit(False))


def held(value: Column, use: Callable[[Column], Column]) -> Column:
    """Compute ``value`` once and hand it to ``use``.

    A filter pushed below a projection repeats the projected expression at every place
    it is used; holding it in a one-element array keeps it to one evaluation per row.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def any_keyword(text: Column, keywords: Iterable[str]) -> Column:
    """True when any keyword occurs in the (already lowercased) text."""
    words = list(keywords)
    return held(text, lambda t: contains_any(t, words))


_BOUNDED_WORD = re.compile(r"(?<!\\)\\b([a-z0-9]+)(?![a-z0-9?*+{])")


def word_first(pattern: str) -> str:
    """``\\bword`` as ``word(?<=\\bword)``: the same matches, found faster.

    The engine then skips to the letters before it looks at the boundary, which is the
    dearer test. Patterns with character classes are left alone.
    """
    return pattern if "[" in pattern else _BOUNDED_WORD.sub(r"\1(?<=\\b\1)", pattern)


def unicode_pattern(pattern: str) -> str:
    """Word characters and spaces by Unicode, whatever the Java version's default is."""
    return "(?U)" + word_first(pattern)


def matches(text: Column, pattern: str, needs: Sequence[str] = ()) -> Column:
    """Regex search, tried only where a needed substring is present."""
    found = text.rlike(unicode_pattern(pattern))
    return contains_any(text, needs) & found if needs else found


def count_matches(
    text: Column, pattern: str, needs: Sequence[str] = (), context: Sequence[str] = ()
) -> Column:
    """Number of regex hits; 0 where no context substring occurs."""
    hits = F.regexp_count(text, F.lit(unicode_pattern(pattern)))
    for words in (context, needs):
        if words:
            hits = F.when(contains_any(text, words), hits).otherwise(F.lit(0))
    return hits


def word_pattern(words: str) -> str:
    """The literal spelling as whole words."""
    return rf"\b{re.escape(words)}\b"


def telling(spellings: Iterable[str]) -> list[str]:
    """Drop every spelling that holds another one as whole words: that one decides alone."""
    every = list(dict.fromkeys(spellings))
    return [
        s for s in every if not any(o != s and re.search(word_pattern(o), s) for o in every)
    ]


def spelled(text: Column, spellings: Iterable[str]) -> Column:
    """Any of the literal spellings as whole words.

    One search per spelling, as a lone literal is found much faster than an alternation.
    """
    return reduce(or_, [matches(text, word_pattern(s), (s,)) for s in telling(spellings)])


def sentences(text: Column) -> Column:
    """Split at every full stop, exclamation and question mark."""
    return F.split(text, "[.!?]")


def clipped(text: Column, max_chars: int | None = None) -> Column:
    """What the scorer gets to see: the whole text, unless it has a limit in characters."""
    return text if max_chars is None else F.substring(text, 1, max_chars)

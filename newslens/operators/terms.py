"""Rules given as a table, of any number.

A rule is a row (entity, pattern, context); a keyword is a row (keyword). Every match of a pattern contains one of a
few literals, which are read off the pattern. An automaton over the literals of all rules finds in one pass over a text
which rules may match there; only their patterns are then tried, as Spark expressions. So no text meets a rule it
shares no literal with, and there is no product of texts and rules. Patterns without a literal (``\\d+``)
are tried on every text. Rules that are one whole word (``\\bword\\b``) are counted by the words of the text, in one
pass for all of them; their patterns are tried only where a word stands beside a character whose kind depends on the engine.

The automaton is built in the Python workers from a broadcast rule table, whose bytes are counted first. A table
over ``MAX_BYTES`` is not broadcast whole: its whole words are joined with the words of the texts, after a Bloom filter, and the
others are dealt into parts that are under it. Each part is its own pass over the texts, and what is found is joined by row.

Texts are taken as they are, so lower-case them for lower-case rules. Null texts match nothing.
Repeated rules count once. An empty rule table matches nothing.
"""

from __future__ import annotations

import re
import sys
import types
import uuid
from collections import Counter
from collections.abc import Iterable, Sequence
from functools import reduce
from re import _parser  # the standard library's own reader of patterns

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslens.functions import text as texts
from newslens.operators.bloom import Filter
from newslens.sources.workspace import written

MAX_BYTES = 32 << 20  # of rules in one automaton
ROW_BYTES = 64  # counted for each rule besides its strings
RULE = "entity string, pattern string, context array<string>"
_FOUND = RULE.replace(" ", ":").replace(",:", ",") + ",hits:int"


# --- literals of a pattern ----------------------------------------------------------


def literals(pattern: str) -> tuple[str, ...]:
    """Strings of which every match contains one; none if there are no such strings."""
    try:
        parsed = _parser.parse(pattern)
    except (re.error, OverflowError, RecursionError):
        return ()  # written for another engine
    if parsed.state.flags & re.IGNORECASE:
        return ()
    return tuple(sorted(_best(parsed) or ()))


def _best(items: Iterable, run: str = "") -> set[str] | None:
    """Of all sets of strings that ``run`` and the sequence after it need, the one whose shortest string is longest."""
    found: list[set[str]] = []
    for op, value in items:
        name = str(op)
        if name == "LITERAL":
            run += chr(value)
            continue
        if name == "AT":  # takes no characters
            continue
        if run:
            found.append({run})
        needed = _needed(name, value, run)
        run = ""
        if needed:
            found.append(needed)
    if run:
        found.append({run})
    return max(found, key=lambda s: (min(map(len, s)), -len(s)), default=None)


def _needed(name: str, value, run: str) -> set[str] | None:
    """What one item needs, together with the letters right before it."""
    if name == "SUBPATTERN":
        return None if value[1] & re.IGNORECASE else _best(value[-1], run)
    if name == "ATOMIC_GROUP":
        return _best(value, run)
    if name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
        return _best(value[2], run) if value[0] > 0 else None
    if name == "BRANCH":
        branches = [_best(branch, run) for branch in value[1]]
        return set().union(*branches) if all(branches) else None
    return None


# --- candidates ---------------------------------------------------------------------


def _parts(rules: DataFrame, max_bytes: int) -> int:
    size = F.sum(reduce(lambda a, b: a + b, [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in rules.columns], F.lit(ROW_BYTES)))
    return max(1, -(-(rules.agg(size.alias("n")).first()["n"] or 0) // max_bytes))


def _dealt(rules: DataFrame, parts: int) -> list[DataFrame]:
    """The rules in parts of about equal bytes."""
    if parts == 1:
        return [rules]
    part = F.pmod(F.xxhash64(*rules.columns), F.lit(parts))
    return [rules.filter(part == i) for i in range(parts)]


class Automaton:
    """Rules by their literals, built once in each Python worker."""

    def __init__(self, rows: Sequence[tuple[tuple[str, ...], object]]):
        by_literal: dict[str, list[int]] = {}
        self.values, self.always = [v for _, v in rows], []
        for i, (needs, _) in enumerate(rows):
            if not needs:
                self.always.append(i)
            for literal in needs:
                by_literal.setdefault(literal, []).append(i)
        self.automaton = ahocorasick.Automaton()
        for literal, which in by_literal.items():
            self.automaton.add_word(literal, which)
        self.automaton.make_automaton()
        self.empty = not by_literal

    def any(self, text: str | None) -> bool:
        if not text:
            return bool(self.always) and text is not None
        return bool(self.always) or (not self.empty and next(self.automaton.iter(text), None) is not None)

    def found(self, text: str | None) -> list:
        if text is None:
            return []
        which = set(self.always)
        if text and not self.empty:
            for lists in {id(w): w for _, w in self.automaton.iter(text)}.values():
                which.update(lists)
        return [self.values[i] for i in sorted(which)]


# --- whole words --------------------------------------------------------------------

_WHOLE_WORD = r"\\b[A-Za-z0-9_]+\\b"  # a rule that is one word
# Characters that are surely letters, or surely none, for the engine's word boundary; of all others it has to decide.
_LETTER = "A-Za-z0-9_\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_NO_LETTER = "\x00-/:-@\\[-\\^`{-\x7f\u00a0-\u00a9\u00ab-\u00b1\u00b4\u00b6-\u00b8\u00bb\u00bf\u2010-\u2027\u2030-\u203e\u2041-\u2053"
_ASCII_WORDS, _STRETCHES, _LETTERS = (re.compile(p) for p in ("[A-Za-z0-9_]+", f"[^{_NO_LETTER}]+", f"[{_LETTER}]+"))


def words_of(text: str) -> dict[str, int | None]:
    """How often each word stands in the text as a whole one; None where only the engine can tell."""
    if text.isascii():
        return Counter(_ASCII_WORDS.findall(text))
    out: dict[str, int | None] = dict(Counter(_STRETCHES.findall(text)))
    unsure = [s for s in out if not s.isascii() and not _LETTERS.fullmatch(s)]
    for stretch in unsure:
        del out[stretch]
    for stretch in unsure:
        out.update(dict.fromkeys(_LETTERS.findall(stretch)))
    return out


class Rules:
    """A table of rules, built once in each Python worker."""

    def __init__(self, rules: list[tuple[str, str, list[str]]]):
        whole = re.compile(_WHOLE_WORD)
        self.words: dict[str, list[int]] = {}
        rest = []
        for i, (_, pattern, _) in enumerate(rules):
            if whole.fullmatch(pattern):
                self.words.setdefault(pattern[2:-2], []).append(i)
            else:
                rest.append((literals(pattern), i))
        self.rest = Automaton(rest)
        entities, patterns, contexts = zip(*rules) if rules else ((), (), ())
        self.columns = [
            pa.array(entities, pa.string()), pa.array(map(texts.unicode_pattern, patterns), pa.string()),
            pa.array(contexts, pa.list_(pa.string())),
        ]

    def found(self, column: pa.Array) -> pa.Array:
        """The rules that may match each text; ``hits`` is their number where it is known."""
        which, hits, ends = [], [], [0]
        for item in column:
            text = item.as_py()
            if text is not None:
                mine: dict[int, int | None] = dict.fromkeys(self.rest.found(text))
                if self.words:
                    seen = words_of(text)
                    for word in seen.keys() & self.words.keys():
                        mine.update(dict.fromkeys(self.words[word], seen[word]))
                for i in sorted(mine):
                    which.append(i)
                    hits.append(mine[i])
            ends.append(len(which))
        at = pa.array(which, pa.int64())
        rules = pa.StructArray.from_arrays([*(c.take(at) for c in self.columns), pa.array(hits, pa.int32())], names=["entity", "pattern", "context", "hits"])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rules)


def _kept(key: str, build) -> Automaton:
    """The worker's automaton of this key; it keeps one at a time, so passes do not add up."""
    kept = sys.modules.setdefault("_newslens_terms", types.ModuleType("_newslens_terms"))
    if getattr(kept, "key", None) != key:
        kept.automaton, kept.key = None, key
        kept.automaton = build()
    return kept.automaton


def _candidates(rules: DataFrame):
    """An Arrow function: the rules of one part, whose bytes are bounded, that may match each text."""
    rows = [(r["entity"], r["pattern"], list(r["context"] or [])) for r in rules.collect()]
    shared, key = rules.sparkSession.sparkContext.broadcast(rows), uuid.uuid4().hex

    @F.arrow_udf(f"array<struct<{_FOUND}>>")
    def run(column: pa.Array) -> pa.Array:
        return _kept(key, lambda: Rules(shared.value)).found(column)

    return run


def _words():
    """An Arrow function: ``words_of`` each text."""

    @F.arrow_udf("array<struct<word:string,hits:int>>")
    def run(column: pa.Array) -> pa.Array:
        words, hits, ends = [], [], [0]
        for item in column:
            seen = words_of(item.as_py() or "")
            words.extend(seen)
            hits.extend(seen.values())
            ends.append(len(words))
        return pa.ListArray.from_arrays(
            pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(words, pa.string()), pa.array(hits, pa.int32())], names=["word", "hits"])
        )

    return run


def _joined(numbered: DataFrame, text: str, rules: DataFrame, out: str) -> DataFrame:
    """(_row, out) of the rules that are whole words, of any number, joined with the words of the texts."""
    rules = written(rules.select(F.expr("substring(pattern, 3, length(pattern) - 4)").alias("word"), *rules.columns), "words")
    held = Filter(rules.select(F.xxhash64("word").alias("key")), rules.count())
    found = numbered.select("_row", held.words.scalar().alias("_words"), F.explode(_words().asNondeterministic()(F.col(text))).alias("_w"))
    found = found.select("_row", "_words", "_w.word", "_w.hits").filter(held.may_hold(F.col("_words"), F.xxhash64("word")))
    pattern = F.concat(F.lit("(?U)"), F.col("word"), F.concat(F.lit(r"(?<=\b"), F.col("word"), F.lit(r")\b")))
    found = found.drop("_words").join(rules, "word").withColumn("pattern", pattern)
    return found.groupBy("_row").agg(F.collect_list(F.struct("entity", "pattern", "context", "hits")).alias(out))


def cleaned(rules: DataFrame) -> DataFrame:
    """(entity, pattern, context), each rule once; without a context column every text is context enough."""
    context = F.col("context") if "context" in rules.columns else F.lit(None)
    named = rules.filter("entity IS NOT NULL AND pattern IS NOT NULL").select(
        "entity", "pattern", F.array_compact(F.coalesce(context.cast("array<string>"), F.array().cast("array<string>"))).alias("context")
    )
    return named.distinct()


def with_candidates(
    rows: DataFrame, text: str, rules: DataFrame, out: str = "candidates", max_bytes: int = MAX_BYTES
) -> DataFrame:
    """``rows`` with the rules that may match ``text``, as ``array<struct<entity, pattern, context, hits>>``.

    ``hits`` is the number of matches where it is known, else null; rules that are known not to match are left out.
    """
    rules = cleaned(rules)
    parts = _parts(rules, max_bytes)
    if parts == 1:
        return rows.withColumn(out, _candidates(rules).asNondeterministic()(F.col(text)))
    numbered = written(rows.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    rules = written(rules.withColumn("_whole", F.col("pattern").rlike(rf"\A{_WHOLE_WORD}\z")), "rules")
    whole, rest = (rules.filter(kind).drop("_whole") for kind in ("_whole", "NOT _whole"))
    passes = [_candidates(part) for part in _dealt(rest, _parts(rest, max_bytes))]
    found = [numbered.select("_row", one.asNondeterministic()(F.col(text)).alias(out)).filter(F.size(out) > 0) for one in passes]
    found.append(_joined(numbered, text, whole, out))
    found = reduce(DataFrame.unionByName, found).groupBy("_row").agg(F.flatten(F.collect_list(out)).alias(out))
    none = F.array().cast(found.schema[out].dataType)
    return numbered.join(found, "_row", "left").withColumn(out, F.coalesce(out, none)).drop("_row")


# --- rules on texts -----------------------------------------------------------------


def matching(text: Column, candidates: Column) -> Column:
    """Names of the entities with a candidate whose pattern is found, each once, by name."""
    hit = F.filter(candidates, lambda c: F.coalesce(c["hits"] > 0, F.rlike(text, c["pattern"])))
    return F.sort_array(F.array_distinct(F.transform(hit, lambda c: c["entity"])))


def counts(text: Column, candidates: Column) -> Column:
    """Map of entity to the hits of its candidates; a context counts only where one of its substrings stands.

    Entities without a hit are not in the map.
    """
    open_ = lambda c: (F.size(c["context"]) == 0) | F.exists(c["context"], lambda w: text.contains(w))
    hits = F.transform(
        candidates,
        lambda c: F.struct(
            c["entity"].alias("entity"), F.when(open_(c), F.coalesce(c["hits"], F.regexp_count(text, c["pattern"]))).otherwise(0).alias("n")
        ),
    )
    return texts.held(F.filter(hits, lambda h: h["n"] > 0), _summed)


def _summed(hits: Column) -> Column:
    names, n = F.transform(hits, lambda h: h["entity"]), F.transform(hits, lambda h: h["n"])
    # nearly always each entity has one rule here
    alone = F.size(F.array_distinct(names)) == F.size(hits)
    return F.when(alone, F.map_from_arrays(names, n)).otherwise(texts.held(F.sort_array(hits), _added))


def _added(hits: Column) -> Column:
    """Hits by entity to the map of their sums; each is read once."""
    name = lambda i: F.element_at(hits, i)["entity"]
    starts = F.filter(F.sequence(F.lit(1), F.size(hits)), lambda i: (i == 1) | (name(i) != name(F.greatest(i - 1, F.lit(1)))))

    def summed(starts: Column) -> Column:
        end = lambda k: F.coalesce(F.get(starts, k + 1), F.size(hits) + 1)
        total = lambda i, k: F.aggregate(F.slice(hits, i, end(k) - i), F.lit(0), lambda s, h: s + h["n"])
        return F.map_from_arrays(F.transform(starts, name), F.transform(starts, total))

    return texts.held(starts, summed)


def any_keyword(rows: DataFrame, text: Column, keywords: DataFrame, max_bytes: int = MAX_BYTES) -> Column:
    """True where any keyword of the table is a substring; null keywords are none, the empty one is everywhere."""
    rules = keywords.select("keyword").filter("keyword IS NOT NULL").distinct()
    found = []
    for part in _dealt(rules, _parts(rules, max_bytes)):
        shared = rows.sparkSession.sparkContext.broadcast([((r.keyword,) if r.keyword else (), r.keyword) for r in part.collect()])
        found.append(_flag(shared, uuid.uuid4().hex)(text))
    return reduce(lambda a, b: a | b, found)


def _flag(shared, key: str):
    @F.arrow_udf("boolean")
    def run(column: pa.Array) -> pa.Array:
        automaton = _kept(key, lambda: Automaton(shared.value))
        return pa.array([automaton.any(t) for t in column.to_pylist()], pa.bool_())

    return run

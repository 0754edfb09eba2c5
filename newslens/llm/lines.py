"""Line deduplication by a deletion-neighbourhood join, within one edit.

Two lines are near if one insertion, deletion or substitution of a code point turns one into the other.
Each line stands for its variants: itself, and itself without the character at each place. A
line and another without one character are near if they are equal; two lines without the character at the
same place are near if the rests are equal. So lines that share a hashed key are one edit
apart, the earliest line of a key is found by an aggregate, and no pairs inside a key are made.
The pairs (line, earliest line of a key) are then verified on their texts.

Most lines have no near line, and are told apart before they send all their variants. Of two near
lines, either the first or the last half agrees; a first pass sends hashes of both halves, and only
lines that share one with another go on. Of ``PARTS`` equal parts of a line, at most one holds the edit; a
second pass sends a hash of all but each part, and only the places of parts that are shared so
send variants. Which hashes are shared is told to the tasks by a bit map of 2 ** ``BITS`` bits,
whose size does not depend on the data: a full map would only let more lines through.

A line is dropped if an earlier one, by (id, place in the text), is equal or near; it does not matter whether
that one stays. Lines are compared without the spaces at their ends; a line without any other character stays.
Equal lines are found at every length from ``min_repeat`` code points, 1 unless said otherwise. Near lines have
``min_chars`` code points or more: one edit of a short line is another line.

A line may be any share of the rows. Lines with over ``SHARE`` of the repeated rows, which are known from the counts, are
dealt over ``DEALS`` salts where rows are told whether they stay.

Defined results: null text is empty and stays as it is. A text that loses all its lines is empty. Rows
without an id come last. Rows that agree in id and text are one document: they keep the same lines. An empty
table gives an empty table. All columns of the input pass through, whatever their names; ``text`` and, if
there, ``n_chars`` are those of the lines that stay. Texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslens.llm.arrays import Spans, mixed, pieces, rows_of, runs, string_buffer
from newslens.llm.common import SPACES, or_empty, written

MIN_CHARS, MIN_REPEAT = 20, 1
PARTS = 16
BITS = 27
#: At most 1 / SHARE lines are dealt, each over DEALS salts.
SHARE, DEALS = 0.001, 256

_U = np.uint64
_GAP = np.zeros(256, dtype=bool)
_GAP[[ord(c) for c in SPACES]] = True
SUBSTITUTED, WHOLE, DELETED = 0, 1, 2


class Lines:
    """The lines of texts that lie end to end: rows, places, and hashes of their parts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, min_chars: int):
        starts, ends = runs(data != 10, offsets)
        self.row = rows_of(starts, offsets)
        breaks = np.concatenate([[0], np.cumsum(data == 10)])
        self.place = (breaks[starts] - breaks[offsets[self.row]]).astype(np.int32)
        solid = np.flatnonzero(~_GAP[data])  # trim both ends
        first, last = np.searchsorted(solid, starts), np.searchsorted(solid, ends) - 1
        some = first <= last
        self.row, self.place, first, last = (x[some] for x in (self.row, self.place, first, last))
        self.byte_start, self.byte_end = solid[first], solid[last] + 1
        lead = (data & 0xC0) != 0x80
        at = np.concatenate([[0], np.cumsum(lead)])
        text = data.tobytes().decode("utf-8", "replace")
        self.codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        self.start, self.end = at[self.byte_start], at[self.byte_end]
        self._keep(np.flatnonzero(self.end - self.start >= min_chars))
        self.spans = Spans(self.codes, 3)
        self.whole = mixed(self.spans.raw(self.start, self.end))

    def _keep(self, which: np.ndarray) -> None:
        for name in ("row", "place", "byte_start", "byte_end", "start", "end", "whole"):
            if hasattr(self, name):
                setattr(self, name, getattr(self, name)[which])

    def halves(self) -> tuple[np.ndarray, np.ndarray]:
        """(line, key): the first and the last q characters, for q about half the length.

        q is on a coarse grid, so that it is nearly always the same for lines of length n and n + 1.
        """
        n = self.end - self.start
        lines, keys = [], []
        for q, which in ((_half(n), np.arange(len(n))), (_half(n - 1), np.flatnonzero(_half(n - 1) != _half(n)))):
            q = q[which]
            for side, (a, b) in enumerate(((self.start[which], self.start[which] + q), (self.end[which] - q, self.end[which]))):
                lines.append(which)
                keys.append(mixed(self.spans.raw(a, b) + mixed((2 * q + side).astype(np.uint64))))
        return np.concatenate(lines), np.concatenate(keys)

    def parts(self, parts: int) -> tuple[np.ndarray, ...]:
        """(line, shorter length, part start, part end, key): all but one part of the line, where the
        line is the shorter or equal one of two near lines, and where it is the longer one."""
        out = []
        for less in (0, 1):
            n = self.end - self.start - less
            line = np.repeat(np.arange(len(n)), parts)
            part = np.tile(np.arange(parts), len(n))
            size = n[line]
            a, b = part * size // parts, (part + 1) * size // parts
            head = self.spans.raw(self.start[line], self.start[line] + a)
            tail = self.spans.raw(self.end[line] - (size - b), self.end[line])
            label = mixed((size * parts + part).astype(np.uint64))
            out.append((line, size, a, b, mixed(head + mixed(tail + label))))
        return tuple(np.concatenate(x) for x in zip(*out))

    def variants(self, line: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, ...]:
        """(line, kind, key, second key) of the variants that lack a character in the given parts."""
        second = Spans(self.codes, 4)
        longer = size < (self.end - self.start)[line]
        count = np.where(longer, b - a + 1, b - a)
        where = np.repeat(np.arange(len(line)), count)
        i = np.arange(len(where)) - np.repeat(np.cumsum(count) - count, count) + a[where]
        own, long_ = line[where], longer[where]
        at = self.start[own] + i
        place = np.where(long_, 0, mixed((i + 1).astype(np.uint64)))  # a substitution is at one place
        keys = []
        for spans in (self.spans, second):
            rest = spans.raw(self.start[own], at) + spans.raw(at + 1, self.end[own]) * spans.power(i)
            keys.append(mixed(rest + place))
        whole = np.unique(line[~longer])
        kinds = np.concatenate([np.where(long_, DELETED, SUBSTITUTED), np.full(len(whole), WHOLE)])
        for k, spans in enumerate((self.spans, second)):
            keys[k] = np.concatenate([keys[k], mixed(spans.raw(self.start[whole], self.end[whole]))])
        return np.concatenate([own, whole]), kinds, keys[0], keys[1]


def _half(n: np.ndarray) -> np.ndarray:
    """The largest of 1, 2, 3, 4, 6, 8, 12, 16, 24 ... that is at most (n - 1) / 2."""
    room = np.maximum((n - 1) // 2, 1)
    power = (1 << np.floor(np.log2(room)).astype(np.int64)).astype(np.int64)
    return np.where(power + power // 2 <= room, power + power // 2, power)


def _has(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys >> _U(64 - BITS)
    return (bits[(at >> _U(3)).astype(np.int64)] >> (at & _U(7)).astype(np.uint8)) & 1 == 1


def _over_lines(texts: DataFrame, schema: pa.Schema, sql: str, rows_of_piece, min_chars: int) -> DataFrame:
    """The columns that ``rows_of_piece`` makes of the lines of each piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = string_buffer(batch.column(batch.num_columns - 1))
            for start, end in pieces(offsets):
                at = offsets[start : end + 1]
                part = data[at[0] : at[-1]]
                if len(part):
                    found = rows_of_piece(Lines(part, at - at[0], min_chars))
                    yield pa.RecordBatch.from_arrays(found, schema=schema)

    return texts.mapInArrow(run, sql)


_KEYS = pa.schema([("key", pa.int64()), ("line", pa.int64())])


def _key_rows(key: np.ndarray, line: np.ndarray) -> list[pa.Array]:
    """Distinct (key, line) of a piece."""
    order = np.lexsort((line, key))
    key, line = key[order], line[order]
    new = np.ones(len(key), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (line[1:] != line[:-1])
    return [pa.array(key[new].view(np.int64), pa.int64()), pa.array(line[new].view(np.int64), pa.int64())]


def _shared(keys: DataFrame) -> np.ndarray:
    """Bit map of the keys that different lines have."""
    shared = (
        keys.groupBy("key")
        .agg(F.min("line").alias("a"), F.max("line").alias("b"))
        .filter("a != b")
        .select(F.shiftrightunsigned("key", 64 - BITS).alias("at"))
    )
    words = shared.groupBy(F.shiftright("at", 5).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(at & 31 as int))")).alias("bits")
    )
    out = np.zeros(1 << (BITS - 5), dtype=np.uint32)
    table = words.toArrow()  # at most 2 ** (BITS - 5) rows
    out[table.column("word").to_numpy()] = table.column("bits").to_numpy().astype(np.uint32)
    return out.view(np.uint8)


def _order(*more: Column) -> Column:
    return F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("mark"), F.col("place"), *more)


def near_lines(texts: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(line): each line of (id, mark, text) that has an earlier line within one edit, but not equal."""
    spark = texts.sparkSession
    context = spark.sparkContext
    only = texts.select("text")

    def halves(lines: Lines) -> list[pa.Array]:
        line, key = lines.halves()
        return _key_rows(key, lines.whole[line])

    first = context.broadcast(_shared(_over_lines(only, _KEYS, "key long, line long", halves, min_chars)))

    def narrowed(lines: Lines) -> None:
        line, key = lines.halves()
        lines._keep(np.unique(line[_has(first.value, key)]))

    def parts(lines: Lines) -> list[pa.Array]:
        narrowed(lines)
        line, _, _, _, key = lines.parts(PARTS)
        return _key_rows(key, lines.whole[line])

    second = context.broadcast(_shared(_over_lines(only, _KEYS, "key long, line long", parts, min_chars)))

    id_type = texts.select("id").schema[0]
    def variants(lines: Lines, start: int, data: np.ndarray) -> tuple[list[pa.Array], pa.Array]:
        narrowed(lines)
        line, size, a, b, key = lines.parts(PARTS)
        hit = _has(second.value, key)
        line, size, a, b = line[hit], size[hit], a[hit], b[hit]
        own, kind, key, key2 = lines.variants(line, size, a, b)
        named = np.unique(own)
        spelled = [data[lines.byte_start[k] : lines.byte_end[k]].tobytes().decode("utf-8", "replace") for k in named]
        none = len(own)
        return [
            pa.array(np.concatenate([lines.whole[own], lines.whole[named]]).view(np.int64), pa.int64()),
            pa.concat_arrays([pa.array(kind, pa.int32()), pa.nulls(len(named), pa.int32())]),
            pa.concat_arrays([pa.array(key.view(np.int64), pa.int64()), pa.nulls(len(named), pa.int64())]),
            pa.concat_arrays([pa.array(key2.view(np.int64), pa.int64()), pa.nulls(len(named), pa.int64())]),
            pa.concat_arrays([pa.nulls(none, pa.int32()), pa.array(lines.place[named], pa.int32())]),
            pa.concat_arrays([pa.nulls(none, pa.string()), pa.array(spelled, pa.string())]),
        ], pa.concat_arrays([pa.nulls(none, pa.int32()), pa.array(lines.row[named] + start, pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = string_buffer(batch.column(2))
            for start, end in pieces(offsets):
                at = offsets[start : end + 1]
                part = data[at[0] : at[-1]]
                if not len(part):
                    continue
                columns, row = variants(Lines(part, at - at[0], min_chars), start, part)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(row), batch.column(1).take(row), *columns],
                    names=["id", "mark", "name", "kind", "key", "key2", "place", "line"],
                )

    rows = written(
        texts.select("id", "mark", "text").mapInArrow(
            run,
            f"id {id_type.dataType.simpleString()}, mark long, name long, kind int, key long, key2 long, place int, line string",
        ),
        "variants",
    )
    first.destroy()
    second.destroy()
    lines = (
        rows.filter("kind IS NULL")
        .groupBy("name")
        .agg(F.min(_order()).alias("at"), F.first("line").alias("line"))
    )
    lines = written(lines, "lines")
    keyed = rows.filter("kind IS NOT NULL").select("name", "kind", "key", "key2").distinct()
    keyed = keyed.join(lines.select("name", "at"), "name")

    def earliest(kind: int) -> Column:
        return F.min(F.when(F.col("kind") == kind, F.struct("at", F.col("name").alias("earlier"))))

    least = keyed.groupBy("key", "key2").agg(
        F.count(F.lit(1)).alias("n"),
        *[earliest(k).alias(f"of{k}") for k in (SUBSTITUTED, WHOLE, DELETED)],
    )
    other = (
        F.when(F.col("kind") == SUBSTITUTED, F.col(f"of{SUBSTITUTED}"))
        .when(F.col("kind") == WHOLE, F.col(f"of{DELETED}"))
        .otherwise(F.col(f"of{WHOLE}"))
    )
    pairs = (
        keyed.join(least.filter("n > 1").drop("n"), ["key", "key2"])
        .withColumn("other", other)
        .filter(F.col("other.at") < F.col("at"))
        .select("name", F.col("other.earlier").alias("earlier"))
        .distinct()
    )
    spelled = lines.select("name", "line")
    checked = pairs.join(spelled, "name").join(
        spelled.select(F.col("name").alias("earlier"), F.col("line").alias("before")), "earlier"
    )
    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines, before = (batch.column(k).to_pylist() for k in (0, 1))
            found = [x for x, y in zip(lines, before) if one_edit(x, y)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["line"])

    return checked.select("line", "before").mapInArrow(near, "line string").distinct()


def one_edit(a: str, b: str) -> bool:
    """Whether one insertion, deletion or substitution at most lies between two lines.

    By the end of their common start, found by halving: a full distance would take the square of
    the length.
    """
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[low:middle] == b[low:middle] else (low, middle - 1)
    return a[low + 1 :] == b[low + 1 :] or a[low + 1 :] == b[low:] or a[low:] == b[low + 1 :]


def _texts(docs: DataFrame, id: str, text: str) -> DataFrame:
    """(id, mark, text): ``mark`` tells rows of one id apart."""
    return docs.select(
        F.col(id).alias("id"), F.xxhash64(or_empty(text)).alias("mark"), or_empty(text).alias("text")
    )


def _name(line: Column) -> list[Column]:
    """Two hashes, 128 bits, that stand for a line."""
    return [F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(7), line).alias("h2")]


def dropped_lines(
    docs: DataFrame, id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_repeat: int = MIN_REPEAT
) -> DataFrame:
    """(id, mark, places): the places of the lines that each document loses."""
    texts = _texts(docs, id, text)
    near = near_lines(texts, min_chars)
    line = F.btrim("part", F.lit(SPACES))
    each = texts.select("id", "mark", F.posexplode(F.split("text", "\n")).alias("place", "part"))
    each = each.select("id", "mark", "place", line.alias("line")).filter(F.length("line") >= max(min_repeat, 1))
    each = each.select("id", "mark", "place", *_name(F.col("line")))
    firsts = each.groupBy("h1", "h2").agg(F.min(_order()).alias("first"), F.count(F.lit(1)).alias("n"))
    near = near.select(*_name(F.col("line")), F.lit(True).alias("near"))
    told = firsts.filter("n > 1").join(near, ["h1", "h2"], "full")
    told = written(told.select("h1", "h2", "first", "n", F.coalesce("near", F.lit(False)).alias("near")), "told")
    rows = told.agg(F.sum("n")).first()[0] or 0
    hot = [r.h1 for r in told.filter(F.col("n") > rows * SHARE).select("h1").collect()]  # at most 1 / SHARE
    salts = F.sequence(F.lit(0), F.when(F.col("h1").isin(hot), DEALS - 1).otherwise(0))
    dealt = F.when(F.col("h1").isin(hot), F.pmod(F.xxhash64("id", "mark", "place"), F.lit(DEALS))).otherwise(0).cast("int")
    told = told.drop("n").withColumn("salt", F.explode(salts))
    gone = F.col("near") | (F.col("first") < _order())
    return (
        each.withColumn("salt", dealt)
        .join(told, ["h1", "h2", "salt"])
        .filter(gone)
        .groupBy("id", "mark")
        .agg(F.collect_set("place").alias("places"))
    )


def line_dedup(
    docs: DataFrame, id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_repeat: int = MIN_REPEAT
) -> DataFrame:
    """The documents without their dropped lines, and ``n_lines`` and ``n_dropped``."""
    places = dropped_lines(docs, id, text, min_chars, min_repeat)
    rows = docs.select(F.struct("*").alias("doc"), F.xxhash64(or_empty(text)).alias("mark"))
    places = places.withColumnRenamed("mark", "of")
    same = rows[f"doc.{id}"].eqNullSafe(places["id"]) & (rows["mark"] == places["of"])
    rows = rows.join(places, same, "left")
    parts = F.split(or_empty(f"doc.{text}"), "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("places"))
    rows = rows.withColumn("parts", parts)
    joined = F.array_join(F.transform(kept, lambda k: F.get(F.col("parts"), k)), "\n")
    new = F.when(F.col("places").isNull(), F.col(f"doc.{text}")).otherwise(joined)
    rows = rows.select("doc", new.alias("new"), F.size("parts").alias("n_lines"), F.coalesce(F.size("places"), F.lit(0)).alias("n_dropped"))
    out = []
    for field in docs.schema.fields:
        if field.name == text:
            out.append(F.col("new").alias(text))
        elif field.name == "n_chars":
            out.append(F.when(F.col("n_dropped") > 0, F.length("new")).otherwise(F.col("doc.n_chars")).cast(field.dataType).alias("n_chars"))
        else:
            out.append(F.col(f"doc.`{field.name}`"))
    taken = {f.name.lower() for f in docs.schema.fields}
    counts = [c for c in ("n_lines", "n_dropped") if c not in taken]
    return rows.select(*out, *counts)

"""A hierarchical Pitman-Yor language model, learned and applied by Spark.

A text is its lines, each its words and one line end, and one text end. Four kinds of restaurants are nested:

- The line restaurant seats the lines of the training texts; the text end is one of them, the
  empty line. A repeated line or passage is so known as a whole. It holds one table for each line, which draws its words and end from
- the context restaurants, one for each word, and one for the start of a line: each seats what came next in the distinct lines.
  They share their parent,
- the word restaurant, whose customers are the tables of all contexts. New tables draw words from
- the spelling model, a hierarchy of restaurants over bytes: the context of ``ORDER`` - 1
  bytes shares the restaurant of the context one byte shorter as its parent, down to the empty
  context and the uniform distribution over 256 bytes. Its customers are the tables of the word
  restaurant. A word is spelled with a space after it; unknown words are only spelled.

The seating of contexts, words and bytes is sampled by Gibbs sweeps.
A sweep reseats the customers of each kind in each restaurant one after another (in blocks, once
there are many), given all others and the parent's probabilities; the tables it opens are the customers
of the parent. After ``BURN`` sweeps the predictive probabilities of words in their contexts are averaged over
``SAMPLES`` sweeps, and the averages give the score. Kinds of a restaurant are reseated together, against the counts of the
sweep before; in the first sweep each kind of a context has one table.

How it is spread: scan tasks cut their texts into chunks, and write for each its documents' words as
numbers inside the chunk, and its distinct words and lines. A chunk asks slices of hashes, whose number grows with the
bytes of text, by packed arrays: of its words (64 bits; words of equal hash would be one), of its lines, and of its pairs of neighbours
(of as many bits as the corpus needs, see ``SPARE_BITS``). A slice answers with sums over all chunks, and tells for one chunk that it
stands for a line or pair. Pairs are counted in the one training copy of a line that stands for all. A chunk seats the pairs
it stands for, which are written once and read in every sweep; the random numbers hang on the pair's hash, so every chunk that scores the pair finds the same tables,
and however the input is cut, the customers are the same. The distinct words stay in their slices. Each sweep sends
a slice's distinct n-grams to the restaurant trees, one for every last two bytes of a context: such a tree
shares all parents down to that context, holds at most 256 ** (ORDER - 2) kinds, and needs from outside only
the probabilities after one byte, a table of 256 x 256. The probabilities of the words go back to the chunks that
have them. So neither the vocabulary nor a text list is ever in one place. Tables that several steps read are
written to the shared folder.

Defined results: null text is empty and has one token, the end. A text of any length is one piece of
its chunk and read whole. Repeated rows each count and get equal scores. Without any training text all words
are unknown and only spelled. An empty table gives an empty table. Only the id and the text are read, so
the names of other columns cannot clash; the id may be null.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslens.llm.arrays import Spans, lowered, mixed, pieces, rows_of, string_buffer, word_hashes, words
from newslens.llm.common import or_empty, written
from newslens.sources.workspace import delete, new_path, written_at

ORDER = 5
DISCOUNT, STRENGTH = 0.75, 1.0
BURN, SAMPLES = 1, 2
#: Bytes of text that one chunk is about.
CHUNK_BYTES = 11_000_000
#: Bytes of text whose pairs one slice of the pairs' hashes is about, and the least number of slices, in bits.
SLICE_BYTES, SLICE_BITS = 16_000_000, 6
#: The same for slices of words and lines.
WORD_BYTES, WORD_BITS = 32_000_000, 3
#: Bits of a pair's hash beyond those of the corpus's number of bytes: an unseen pair is taken for a seen one once in 2 ** SPARE_BITS.
SPARE_BITS = 20
#: Pairs of a chunk that are scored at once.
SCORED = 1 << 18


# --- seating ------------------------------------------------------------------------


def seat(rng: np.random.Generator, customers: np.ndarray, others: np.ndarray, parent: np.ndarray,
         discount: float, strength: float) -> np.ndarray:
    """Tables of each kind after all its customers sat down again, one after another.

    ``others`` are the restaurant's tables of other kinds, ``parent`` the probability of the kind
    in the parent. The first customer opens a table; the next opens one in proportion to
    (strength + discount * tables) * parent, and joins one in proportion to customers - discount *
    own tables. After 32 customers they come in blocks of a sixteenth.
    """
    customers = customers.astype(np.int64)
    tables = np.minimum(customers, 1)
    live = np.flatnonzero(customers > 1)
    done, block = 1, 1
    while len(live):
        here = tables[live]
        new = (strength + discount * (others[live] + here)) * parent[live]
        chance = new / (new + np.maximum(done - discount * here, 1e-12))
        size = np.minimum(customers[live] - done, block)
        tables[live] += rng.binomial(size, np.clip(chance, 0.0, 1.0))
        done += block
        block = max(1, done // 16) if done >= 32 else 1
        live = live[customers[live] > done]
    return tables


class Level:
    """Restaurants of one context length: kinds (context, byte) and their restaurants."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        contexts = keys >> np.uint64(8)
        self.contexts, self.room = np.unique(contexts, return_inverse=True)

    def update(self, rng, customers: np.ndarray, parent: np.ndarray, discount: float, strength: float) -> None:
        """Reseat everybody; keeps customers, tables and the predictive probability of each kind."""
        if not hasattr(self, "tables"):
            self.tables = np.minimum(customers, 1)
        rooms = len(self.contexts)
        per_room = np.bincount(self.room, weights=self.tables, minlength=rooms)
        others = per_room[self.room] - self.tables
        self.customers = customers
        self.tables = seat(rng, customers, others, parent, discount, strength)

    def predict(self, parent: np.ndarray, discount: float, strength: float) -> np.ndarray:
        rooms = len(self.contexts)
        total = np.bincount(self.room, weights=self.customers, minlength=rooms)[self.room]
        tables = np.bincount(self.room, weights=self.tables, minlength=rooms)[self.room]
        own = np.maximum(self.customers - discount * self.tables, 0.0)
        return (own + (strength + discount * tables) * parent) / (strength + total)


def tree_sweep(keys: np.ndarray, customers: np.ndarray, top: np.ndarray, rng: np.random.Generator,
               order: int = ORDER, inner: int = 2) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One tree: distinct sorted n-grams (bytes in a number) that end a context alike in two bytes.

    Returns their predictive probabilities, and what the tree's root sends up: bytes and tables.
    """
    levels, below = [], []
    own = keys
    for length in range(order, 2, -1):
        mask = np.uint64((1 << (8 * length)) - 1)
        parents, index = np.unique(own & mask, return_inverse=True)
        if length < order:
            below.append(index)
        levels.append(Level(parents))
        own = parents
    # levels[0] has the whole n-grams; below[k] leads from a kind of levels[k] to levels[k + 1]
    root = levels[-1].keys
    outer = top[((root >> np.uint64(8)) & np.uint64(0xFF)).astype(np.int64), (root & np.uint64(0xFF)).astype(np.int64)]
    guess = [np.full(len(level.keys), 1.0 / 256.0) for level in levels]
    guess[-1] = outer
    for _ in range(inner):
        arriving = customers.astype(np.int64)
        for k, level in enumerate(levels):
            level.update(rng, arriving, guess[k], DISCOUNT, STRENGTH)
            if k < len(below):
                arriving = np.bincount(below[k], weights=level.tables, minlength=len(levels[k + 1].keys)).astype(np.int64)
        chance = outer
        for k in range(len(levels) - 1, -1, -1):
            guess[k] = chance
            found = levels[k].predict(chance, DISCOUNT, STRENGTH)
            chance = found[below[k - 1]] if k else found
    return chance, (root & np.uint64(0xFF)).astype(np.int64), levels[-1].tables


def top_sweep(customers: np.ndarray, before: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Probabilities after one byte from what the trees sent up; 256 x 256."""
    kinds = np.flatnonzero(customers.ravel() > 0).astype(np.uint64)
    every = np.arange(256 * 256, dtype=np.uint64)
    level, root = Level(every), Level(np.arange(256, dtype=np.uint64))
    byte = (every & np.uint64(0xFF)).astype(np.int64)
    uniform = np.full(256, 1.0 / 256.0)
    if not len(kinds):
        return np.full((256, 256), 1.0 / 256.0)
    one = before.mean(axis=0)
    for _ in range(2):
        level.update(rng, customers.ravel().astype(np.int64), one[byte], DISCOUNT, STRENGTH)
        sent = np.bincount(byte, weights=level.tables, minlength=256).astype(np.int64)
        root.update(rng, sent, uniform, DISCOUNT, STRENGTH)
        one = root.predict(uniform, DISCOUNT, STRENGTH)
    return level.predict(one[byte], DISCOUNT, STRENGTH).reshape(256, 256)


# --- texts to chunks ----------------------------------------------------------------


def packed(numbers: np.ndarray, kind, level: int = 1) -> bytes:
    """Numbers as compressed bytes, byte by byte of their width."""
    plain = np.ascontiguousarray(numbers.astype(kind))
    width = plain.dtype.itemsize
    return zlib.compress(plain.view(np.uint8).reshape(-1, width).T.tobytes(), level)


def unpacked(blob: bytes, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    plain = np.frombuffer(zlib.decompress(blob), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(plain.T).reshape(-1).view(kind)


def narrow(numbers: np.ndarray) -> bytes:
    """Counts as compressed bytes of the least width that holds them all; its width comes first."""
    top = int(numbers.max()) if len(numbers) else 0
    kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if top <= np.iinfo(k).max)
    return bytes([np.dtype(kind).itemsize]) + packed(numbers, kind)


def widened(blob: bytes) -> np.ndarray:
    return unpacked(blob[1:], np.dtype(f"u{blob[0]}")).astype(np.int64)


def least(numbers: np.ndarray) -> bytes:
    """Counts in the least width that holds them all, which comes first; for the many short ones."""
    top = int(numbers.max()) if len(numbers) else 0
    kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if top <= np.iinfo(k).max)
    return bytes([np.dtype(kind).itemsize]) + numbers.astype(kind).tobytes()


def wide(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, f"u{blob[0]}", offset=1).astype(np.int64)


def rising(numbers: np.ndarray) -> bytes:
    """Ascending uint64 as their differences, in as few bytes each as hold them all."""
    steps = np.diff(numbers, prepend=np.uint64(0))
    steps[:1] = 0
    width = max(1, (int(steps.max()).bit_length() + 7) // 8) if len(steps) else 1
    first = int(numbers[0]) if len(numbers) else 0
    rest = steps.view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + first.to_bytes(8, "little") + rest.tobytes()


def risen(blob: bytes) -> np.ndarray:
    width = blob[0]
    rest = np.frombuffer(blob, np.uint8, offset=9).reshape(-1, width)
    steps = np.zeros((len(rest), 8), dtype=np.uint8)
    steps[:, :width] = rest
    steps = steps.reshape(-1).view(np.uint64)
    steps[:1] = int.from_bytes(blob[1:9], "little")
    return np.cumsum(steps, dtype=np.uint64)


#: Numbers of the text end and the line end in every chunk, and their hashes.
END, LINE_END = 0, 1

_FIELDS = ("ids", "held", "words", "lines", "line_words", "tokens", "line_numbers", "hashes", "line_hashes", "spelled", "lengths")
_CHUNKED = "chunk long, " + ", ".join(f"{f} binary" for f in _FIELDS)
_C_TYPE = pa.schema([("chunk", pa.int64()), *[(f, pa.binary()) for f in _FIELDS]])


class Chunk:
    """Documents whose words and lines are numbered together."""

    def __init__(self):
        self.ids, self.held, self.words, self.lines, self.line_words = [], [], [], [], []
        self.hashes, self.line_hashes, self.size = [], [], 0
        # distinct words of each piece; the ends have no place in a text
        self.kinds, self.spelled = [np.array([END, LINE_END], dtype=np.uint64)], [pa.array([b"", b"\n"], pa.large_binary())]

    def add(self, ids: pa.Array, held: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> None:
        data = lowered(data)
        starts, ends = words(data, offsets)
        hashes = np.maximum(word_hashes(data, starts, ends), np.uint64(2))
        rows = len(offsets) - 1
        owner = rows_of(starts, offsets)
        # a word starts a line if a line break, or the start of its text, comes after the word before
        breaks = np.concatenate([[0], np.cumsum(data == 10)])[starts]
        new = np.ones(len(starts), dtype=bool)
        new[1:] = (breaks[1:] != breaks[:-1]) | (owner[1:] != owner[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(starts))
        self.line_hashes.append(np.maximum(mixed(Spans(hashes, 1).raw(first, last[: len(first)])), np.uint64(2)))
        self.line_words.append(np.diff(np.append(first, len(starts))))
        self.lines.append(np.bincount(owner[first], minlength=rows))
        self.words.append(np.bincount(owner, minlength=rows))
        self.hashes.append(hashes)
        self.ids.append(ids)
        self.held.append(held)
        self.size += len(data)
        unique, at = np.unique(hashes, return_index=True)
        self.kinds.append(unique)
        self.spelled.append(_cut_out(data, starts[at], ends[at]))

    def row(self, name: int) -> pa.RecordBatch:
        kinds, tokens = _numbered(np.concatenate(self.hashes))
        lines, line_numbers = _numbered(np.concatenate(self.line_hashes))
        unique, first = np.unique(np.concatenate(self.kinds), return_index=True)
        spelled, at = _joined(pa.concat_arrays(self.spelled).take(pa.array(first[np.searchsorted(unique, kinds)])))
        values = [
            name, _ids_out(self.ids), packed(np.concatenate(self.held), np.uint8), narrow(np.concatenate(self.words)),
            narrow(np.concatenate(self.lines)), narrow(np.concatenate(self.line_words)), packed(tokens, np.int32),
            narrow(line_numbers), kinds.tobytes(), lines.tobytes(), zlib.compress(spelled, 1),
            narrow(np.diff(at)),
        ]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _C_TYPE)], schema=_C_TYPE)


def _cut_out(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Parts of a buffer as a binary column."""
    size = ends - starts
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    parts = data[np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], size)]
    return pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(parts)])


def _joined(column: pa.Array) -> tuple[bytes, np.ndarray]:
    """The bytes of a large_binary column without nulls, end to end, and where each starts."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return (data.to_pybytes()[at[0] : at[-1]] if data else b""), at - at[0]


class Read:
    """A chunk as it was written: its documents, lines and words, and their order by hash."""

    def __init__(self, row: dict):
        self.held = unpacked(row["held"], np.uint8).astype(bool)
        self.words, self.lines, self.line_words = (widened(row[c]) for c in ("words", "lines", "line_words"))
        self.line_numbers = widened(row["line_numbers"])
        self.tokens = unpacked(row["tokens"], np.int32)
        self.hashes, self.line_hashes = (np.frombuffer(row[c], np.uint64) for c in ("hashes", "line_hashes"))
        self.trained_lines = np.repeat(~self.held, self.lines)
        self.ends = int((~self.held).sum())

    def pairs(self, width: int):
        return line_pairs(self.tokens, self.line_words, self.hashes, width)

    def word_counts(self) -> np.ndarray:
        n = np.bincount(self.tokens, weights=np.repeat(~self.held, self.words), minlength=len(self.hashes)).astype(np.int64)
        n[END] = self.ends
        return n

    def line_counts(self) -> np.ndarray:
        n = np.bincount(self.line_numbers, weights=self.trained_lines, minlength=len(self.line_hashes)).astype(np.int64)
        n[END] = self.ends
        return n

    def opened(self, opens: np.ndarray) -> np.ndarray:
        """Which places of ``line_pairs`` are in the training copy that stands for all equal lines."""
        first = np.zeros(len(self.line_numbers), dtype=bool)
        places = np.flatnonzero(self.trained_lines)
        first[places[np.unique(self.line_numbers[places], return_index=True)[1]]] = True
        first &= opens[self.line_numbers].astype(bool)
        return np.append(np.repeat(first, self.line_words + 1), opens[END])


def line_pairs(tokens: np.ndarray, line_words: np.ndarray, hashes: np.ndarray, width: int = 64) -> tuple[np.ndarray, ...]:
    """Neighbours in the lines of a chunk: sorted hashes of the distinct ones, the pair of each place, and both numbers of each pair.

    A place is a word or the end of its line, in text order, and last the text end: a line end in the
    context of a line end, which is also the context of the first word of a line. Hashes have ``width`` bits.
    """
    ends = np.array([LINE_END], dtype=tokens.dtype)
    after = np.concatenate([np.insert(tokens, np.cumsum(line_words), LINE_END), ends])
    bits, spot = len(hashes).bit_length(), len(after).bit_length()
    key = np.full(len(after), LINE_END, dtype=np.uint64)
    key[1:] = after[:-1]
    key <<= np.uint64(bits)
    key |= after.astype(np.uint64)
    del after
    if 2 * bits + spot <= 64:  # the place rides along in one plain sort
        key <<= np.uint64(spot)
        key |= np.arange(len(key), dtype=np.uint64)
        key.sort()
        place = (key & np.uint64((1 << spot) - 1)).astype(np.int32)
        key >>= np.uint64(spot)
    else:
        place = np.argsort(key, kind="stable")
        key = key[place]
    new = np.ones(len(key), dtype=bool)
    new[1:] = key[1:] != key[:-1]
    key = key[new]
    first, second = (key >> np.uint64(bits)).astype(np.int32), (key & np.uint64((1 << bits) - 1)).astype(np.int32)
    del key
    found = _pair_hashes(hashes, first, second, width)
    order = np.argsort(found, kind="stable")
    rank = np.empty(len(order), dtype=np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    which = np.empty(len(place), dtype=np.int32)
    number = np.cumsum(new, dtype=np.int32)
    number -= 1
    which[place] = rank[number]
    return found[order], which, first[order], second[order]


def _pair_hashes(hashes: np.ndarray, first: np.ndarray, second: np.ndarray, width: int) -> np.ndarray:
    """Of pairs of numbers of words with these hashes."""
    words = mixed(hashes + np.uint64(1))
    found = words[first]
    found *= np.uint64(3)
    found += words[second]
    return mixed(found) >> np.uint64(64 - width)


def _slices(hashes: np.ndarray, bits: int, width: int = 64) -> Iterator[tuple[int, int, int]]:
    """(slice, start, end) of the slices of ascending hashes that have some."""
    number = (hashes >> np.uint64(width - bits)).astype(np.int64)
    start = np.flatnonzero(np.diff(number, prepend=-1))
    yield from zip(number[start].tolist(), start.tolist(), np.append(start[1:], len(hashes)).tolist())


def _names() -> Iterator[int]:
    """Numbers that no other task gives, for a table that is written once."""
    task = TaskContext.get().partitionId()
    return iter(range(task << 24, (task + 1) << 24))


def _numbered(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes, frequent ones first after those of the two ends; the number of each place."""
    coded = pa.array(hashes).dictionary_encode()
    unique, which = coded.dictionary.to_numpy(), coded.indices.to_numpy()
    count = np.bincount(which, minlength=len(unique))
    frequent = np.lexsort((unique, -count))
    rank = np.empty(len(unique), dtype=np.int64)
    rank[frequent] = np.arange(2, len(unique) + 2)
    ends = np.array([END, LINE_END], dtype=np.uint64)
    return np.concatenate([ends, unique[frequent]]), rank[which]


def _chunked(texts: DataFrame) -> DataFrame:
    """Of (id, held, text): per chunk a row of its documents, with words and lines as numbers, and what these are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, names = Chunk(), _names()
        for batch in batches:
            data, offsets = string_buffer(batch.column(2))
            held = np.asarray(batch.column(1).to_pylist(), dtype=bool)
            for start, end in pieces(offsets):
                at = offsets[start : end + 1]
                chunk.add(batch.column(0).slice(start, end - start), held[start:end], data[at[0] : at[-1]], at - at[0])
                if chunk.size >= CHUNK_BYTES:
                    yield chunk.row(next(names))
                    chunk = Chunk()
        if chunk.ids:
            yield chunk.row(next(names))

    return texts.mapInArrow(run, _CHUNKED)


def _ids_out(ids: list[pa.Array]) -> bytes:
    """A column of ids as bytes; nulls stay."""
    joined = pa.chunked_array(ids).combine_chunks() if len(ids) > 1 else ids[0]
    batch = pa.RecordBatch.from_arrays([joined], names=["id"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _ids_in(blob: bytes) -> pa.Array:
    with pa.ipc.open_stream(blob) as stream:
        return stream.read_all().column("id").combine_chunks()


# --- questions of chunks to slices of hashes ------------------------------------------


def _table(schema: str, *columns: list) -> pa.Table:
    """Columns as an Arrow table of a SQL schema of long, int and binary."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "float": pa.float32()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.table([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])


def _batches(table: pa.Table) -> Iterator[pa.RecordBatch]:
    yield from table.to_batches()


_ASKED = "slice long, chunk long, hashes binary, n binary, spelled binary, lengths binary"


def _word_questions(documents: DataFrame, bits: int, lines: bool = False) -> DataFrame:
    """The words (or lines) of each chunk with their counts in training texts, by slice of their hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunk = Read(row)
                hashes, n = (chunk.line_hashes, chunk.line_counts()) if lines else (chunk.hashes, chunk.word_counts())
                order = np.argsort(hashes, kind="stable")
                hashes, n = hashes[order], n[order]
                cuts = list(_slices(hashes, bits))
                spelled = lengths = [None] * len(cuts)
                if not lines:
                    words = _binary(row["spelled"], row["lengths"]).take(pa.array(order))
                    text, at = _joined(words)
                    spelled = [zlib.compress(text[at[a] : at[b]], 1) for _, a, b in cuts]
                    lengths = [narrow(np.diff(at[a : b + 1])) for _, a, b in cuts]
                yield from _batches(_table(
                    _ASKED, [c for c, _, _ in cuts], [row["chunk"]] * len(cuts), [rising(hashes[a:b]) for _, a, b in cuts],
                    [narrow(n[a:b]) for _, a, b in cuts], spelled, lengths,
                ))

    return documents.mapInArrow(run, _ASKED)


def _binary(spelled: bytes, lengths: bytes) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(widened(lengths))]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(zlib.decompress(spelled))])


def _merged(group: pa.Table, *counts: str) -> tuple:
    """Of the questions to a slice, by chunk: distinct hashes, which is where, where chunks end, and sums of the counts."""
    rows = [risen(h) for h in group.column("hashes").to_pylist()]
    kinds, index, which = np.unique(np.concatenate(rows), return_index=True, return_inverse=True)
    sums = []
    for name in counts:
        n = np.concatenate([widened(c) for c in group.column(name).to_pylist()])
        sums.append(np.bincount(which, weights=n, minlength=len(kinds)).astype(np.int64))
    return kinds, index, which, np.cumsum([len(r) for r in rows])[:-1], sums


_COUNTED = "words long, chunk long, hashes binary, spelled binary, lengths binary, seen binary, at binary, kinds long, total long"


def _counted_words(asked: DataFrame) -> DataFrame:
    """A row of the distinct words of each slice, ascending by hash, with their counts; and a row for each chunk: which it has."""

    def run(key: tuple, group: pa.Table) -> pa.Table:
        kinds, index, which, cuts, (n,) = _merged(group, "n")
        words = pa.concat_arrays([_binary(s, k) for s, k in zip(group.column("spelled").to_pylist(), group.column("lengths").to_pylist())])
        text, at = _joined(words.take(pa.array(index)))
        rest = [None] * group.num_rows
        return _table(
            _COUNTED, [key[0].as_py()] * (1 + len(rest)), [None, *group.column("chunk").to_pylist()], [rising(kinds), *rest],
            [zlib.compress(text, 1), *rest], [narrow(np.diff(at)), *rest], [narrow(n), *rest],
            [None, *[rising(w.astype(np.uint64)) for w in np.split(which, cuts)]],
            [int((n > 0).sum()), *rest], [int(n.sum()), *rest],
        )

    return asked.groupBy("slice").applyInArrow(run, _COUNTED)


_COUNTS = "chunk long, slice long, counts binary, opens binary, once long, twice long, kinds long, total long"


def _counts(asked: DataFrame) -> DataFrame:
    """A slice's answer to each chunk: the sums over all chunks, and which kinds the chunk stands for.

    One of the chunks that have a kind in their training texts does: the first by number.
    """

    def run(key: tuple, group: pa.Table) -> pa.Table:
        group = group.sort_by("chunk")
        kinds, _, which, cuts, (total,) = _merged(group, "n")
        n = np.concatenate([widened(c) for c in group.column("n").to_pylist()])
        opens, trained = np.zeros(len(n), dtype=np.uint8), np.flatnonzero(n)
        opens[trained[np.unique(which[trained], return_index=True)[1]]] = 1
        size = group.num_rows
        facts = [int((total == 1).sum()), int((total == 2).sum()), int((total > 0).sum()), int(total.sum())]
        return _table(
            _COUNTS, group.column("chunk").to_pylist(), [key[0].as_py()] * size, [narrow(c) for c in np.split(total[which], cuts)],
            [packed(o, np.uint8) for o in np.split(opens, cuts)], *[[f] + [0] * (size - 1) for f in facts],
        )

    return asked.groupBy("slice").applyInArrow(run, _COUNTS)


def _facts(counts: DataFrame) -> dict:
    names = ("once", "twice", "kinds", "total")
    return counts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names]).first().asDict()


def _in_order(found: list[dict], column: str, read) -> np.ndarray:
    """The answers of all slices to a chunk, ascending by hash."""
    return np.concatenate([read(r[column]) for r in sorted(found, key=lambda r: r["slice"])])


def _by_number(order: np.ndarray, found: list[dict], column: str, read) -> np.ndarray:
    """The answers of all slices to a chunk, by its own numbers; ``order`` sorts their hashes."""
    values = _in_order(found, column, read)
    out = np.empty_like(values)
    out[order] = values
    return out


def _ascending(hashes: np.ndarray) -> np.ndarray:
    return np.argsort(hashes, kind="stable")


# --- contexts of words --------------------------------------------------------------

_FOUND = "chunk long, slice long, counts binary, opens binary, chance binary, rooms binary, seats binary, sweep int, what int"
_LINES, _PAIRS, _WORDS_OF = 0, 1, 2


def _told(counts: DataFrame, what: int, *columns: str) -> DataFrame:
    """Answers in one shape, so that one cogroup brings all to the chunk."""
    have = {"chunk", "slice", *columns}
    return counts.select(
        *[(F.col(n) if n in have else F.lit(what if n == "what" else None).cast(k)).alias(n)
          for n, k in (f.split() for f in _FOUND.split(", "))]
    )


def _pair_questions(documents: DataFrame, line_answers: DataFrame, bits: int, width: int) -> DataFrame:
    """The pairs of each chunk by slice, counted in one training copy of each distinct line of the corpus."""

    def run(key: tuple, mine: pa.Table, found: pa.Table) -> pa.Table:
        row = mine.to_pylist()[0]
        chunk = Read(row)
        pairs, which, _, _ = chunk.pairs(width)
        opens = _by_number(_ascending(chunk.line_hashes), found.to_pylist(), "opens", _flags)
        n = np.bincount(which, weights=chunk.opened(opens), minlength=len(pairs)).astype(np.int64)
        cuts = list(_slices(pairs, bits, width))
        none = [None] * len(cuts)
        return _table(_ASKED, [c for c, _, _ in cuts], [row["chunk"]] * len(cuts), [rising(pairs[a:b]) for _, a, b in cuts],
                      [narrow(n[a:b]) for _, a, b in cuts], none, none)

    return documents.groupBy("chunk").cogroup(line_answers.groupBy("chunk")).applyInArrow(run, _ASKED)


_OWN = "chunk long, hashes binary, before binary, after binary, counts binary"


def _own_pairs(documents: DataFrame, answers: DataFrame, width: int) -> DataFrame:
    """The pairs that each chunk stands for, which it seats in every sweep: their words' numbers, ascending, and their counts."""

    def run(key: tuple, mine: pa.Table, found: pa.Table) -> pa.Table:
        row, found = mine.to_pylist()[0], found.to_pylist()
        hashes = np.frombuffer(row["hashes"], np.uint64)
        _, _, before, after = line_pairs(unpacked(row["tokens"], np.int32), widened(row["line_words"]), hashes, width)
        own = np.flatnonzero(_in_order(found, "opens", _flags))
        own = own[np.lexsort((after[own], before[own]))]
        return _table(
            _OWN, [row["chunk"]], [row["hashes"]], [narrow(np.diff(before[own], prepend=0))], [narrow(after[own])],
            [narrow(_in_order(found, "counts", widened)[own])],
        )

    return documents.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(run, _OWN)


def seat_alike(names: np.ndarray, customers: np.ndarray, others: np.ndarray, parent: np.ndarray,
               discount: float, strength: float, seed: int) -> np.ndarray:
    """``seat`` with random numbers that depend on the name of a kind: every chunk that holds it draws the same.

    A block of customers opens the whole number of tables next to its expectation, up or down by chance.
    """
    customers = customers.astype(np.int64)
    tables = np.minimum(customers, 1)
    live = np.flatnonzero(customers > 1)
    done, block = 1, 1
    while len(live):
        here = tables[live]
        new = (strength + discount * (others[live] + here)) * parent[live]
        chance = new / (new + np.maximum(done - discount * here, 1e-12))
        size = np.minimum(customers[live] - done, block)
        salt = mixed(np.array([seed], dtype=np.uint64) * np.uint64(1 << 40) + np.uint64(done))
        draw = (mixed(names[live] + salt) >> np.uint64(11)).astype(np.float64) / (1 << 53)
        tables[live] += np.floor(size * chance + draw).astype(np.int64)
        done += block
        block = max(1, done // 16) if done >= 32 else 1
        live = live[customers[live] > done]
    return tables


def _context_tables(sweep: int, pairs: np.ndarray, counts: np.ndarray, before: np.ndarray, after: np.ndarray,
                    chance: np.ndarray | None, rooms: np.ndarray | None, discount: float, seed: int) -> np.ndarray:
    """Tables of each pair: one for each kind at first, then as the sweeps seat them."""
    if not sweep:
        return np.minimum(counts, 1)
    others = np.maximum(rooms[before] - 1, 0)
    return seat_alike(pairs, counts, others, chance[after], discount, STRENGTH, seed * 64 + sweep)


_SENT = "words long, chunk long, at binary, sent binary, rooms binary, seats binary"


def _sent(own: DataFrame, told: DataFrame | None, sweep: int, bits: int, width: int, discount: float, seed: int) -> DataFrame:
    """What the contexts of each chunk's own pairs send: tables of each word, tables and customers in its context.

    ``told`` is what the sweep before made of the chunk's words; the first sweep needs nothing.
    """

    def sent(row: dict, found: list[dict]) -> pa.Table:
        hashes = np.frombuffer(row["hashes"], np.uint64)
        before, after, counts = np.cumsum(widened(row["before"])), widened(row["after"]), widened(row["counts"])
        order = _ascending(hashes)
        names = chance = rooms = None
        if sweep:
            names = _pair_hashes(hashes, before, after, width)
            chance = 10.0 ** _by_number(order, found, "chance", _floats)
            rooms = _by_number(order, found, "rooms", widened)
        tables = _context_tables(sweep, names, counts, before, after, chance, rooms, discount, seed)
        sums = [np.bincount(x, weights=w, minlength=len(order)).astype(np.int64)[order]
                for x, w in ((after, tables), (before, tables), (before, counts))]
        cuts = list(_slices(hashes[order], bits))
        return _table(_SENT, [c for c, _, _ in cuts], [row["chunk"]] * len(cuts), [None] * len(cuts),
                      *[[narrow(x[a:b]) for _, a, b in cuts] for x in sums])

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield from _batches(sent(batch.slice(k, 1).to_pylist()[0], []))

    def run(key: tuple, mine: pa.Table, found: pa.Table) -> pa.Table:
        return sent(mine.to_pylist()[0], found.to_pylist())

    if told is None:
        return own.mapInArrow(alone, _SENT)
    return own.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(run, _SENT)


def _flags(blob: bytes) -> np.ndarray:
    return unpacked(blob, np.uint8)


def _floats(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, np.float32).astype(np.float64)


# --- words and their spelling -------------------------------------------------------

_WORDS = (
    "words long, hashes binary, spelled binary, lengths binary, seen binary, n binary, tables binary, rooms binary, "
    "seats binary, spelling binary, chance binary"
)


def _word_rows(counted: DataFrame) -> DataFrame:
    """The distinct words before they are seated; a word's first guess falls by its length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lengths = widened(row["lengths"])
                none = narrow(np.zeros(len(lengths), dtype=np.int64))
                guess = packed(np.exp(-3.0 * (lengths + 1.0)), np.float64)
                yield from _batches(_table(
                    _WORDS, [row["words"]], [row["hashes"]], [row["spelled"]], [row["lengths"]], [row["seen"]],
                    [none], [none], [none], [none], [guess], [None],
                ))

    return counted.mapInArrow(run, _WORDS)


def spelling_ngrams(spelled: np.ndarray, lengths: np.ndarray, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram that ends at each byte of a word or at its end, word of each): order bytes in a number."""
    rows = len(lengths)
    size = lengths + 1
    begin = np.concatenate([[0], np.cumsum(size)])
    text = np.full(int(begin[-1]), 0x20, dtype=np.uint64)
    owner = np.repeat(np.arange(rows), size)
    place = np.arange(len(text)) - begin[owner]
    text[place < lengths[owner]] = spelled
    keys = text.copy()
    for back in range(1, order):
        earlier = np.full(len(text), 0x20, dtype=np.uint64)
        earlier[back:] = text[:-back] if back < len(text) else earlier[back:]
        earlier[place < back] = 0x20
        keys |= earlier << np.uint64(8 * back)
    return keys, owner


_SEATED = "words long, tree int, keys binary, customers binary, n binary, tables binary, rooms binary, seats binary"


def _asked(word_rows: DataFrame, sent: DataFrame, members: DataFrame, tables: int, sweep: int, seed: int, discount: float, strength: float) -> DataFrame:
    """Seat what the contexts sent and ask for the words' n-grams, by tree; a row of tree -1 holds the seating."""

    def run(key: tuple, mine: pa.Table, found: pa.Table) -> pa.Table:
        row, slice_ = mine.to_pylist()[0], mine.column("words").to_pylist()[0]
        old, parts = widened(row["tables"]), found.to_pylist()
        n, rooms, seats = (_summed(parts, name, len(old)) for name in ("sent", "rooms", "seats"))
        rng = np.random.default_rng([seed, sweep, slice_])
        seated = seat(rng, n, np.maximum(tables - old, 0), unpacked(row["spelling"], np.float64), discount, strength)
        spelled = np.frombuffer(zlib.decompress(row["spelled"]), np.uint8)
        keys, owner = spelling_ngrams(spelled, widened(row["lengths"]))
        unique, which = np.unique(keys, return_inverse=True)
        customers = np.bincount(which, weights=seated[owner], minlength=len(unique)).astype(np.int64)
        tree = ((unique >> np.uint64(8)) & np.uint64(0xFFFF)).astype(np.int32)
        order = np.argsort(tree, kind="stable")
        tree, unique, customers = tree[order], unique[order], customers[order]
        cuts = np.flatnonzero(np.diff(tree, prepend=-1))
        parts = list(zip(cuts, np.append(cuts[1:], len(tree))))
        none = [None] * len(parts)
        return _table(
            _SEATED, [slice_] * (len(parts) + 1), [*tree[cuts].tolist(), -1], [*[rising(unique[a:b]) for a, b in parts], None],
            [*[least(customers[a:b]) for a, b in parts], None], *[[*none, narrow(x)] for x in (n, seated, rooms, seats)],
        )

    found = sent.unionByName(members, allowMissingColumns=True)
    return word_rows.groupBy("words").cogroup(found.groupBy("words")).applyInArrow(run, _SEATED)


def _summed(parts: list[dict], name: str, size: int) -> np.ndarray:
    """What chunks sent to the words of a slice; other rows tell which words a chunk has."""
    at = {p["chunk"]: p["at"] for p in parts if p["at"] is not None}
    out = np.zeros(size, dtype=np.int64)
    for part in parts:
        if part["at"] is None:
            out[risen(at[part["chunk"]]).astype(np.int64)] += widened(part[name])
    return out


def _answers(asked: DataFrame, top, sweep: int, seed: int) -> DataFrame:
    """(words, tree, chances, sent): each asked n-gram's probability; what the tree's root sends up."""
    schema = pa.schema([("words", pa.int64()), ("tree", pa.int32()), ("chances", pa.binary()), ("sent", pa.binary())])

    def run(key: tuple, group: pa.Table) -> pa.Table:
        tree = key[0].as_py()
        rows = [(w, risen(k), wide(c)) for w, k, c in zip(
            group.column("words").to_pylist(), group.column("keys").to_pylist(), group.column("customers").to_pylist())]
        keys, which = np.unique(np.concatenate([k for _, k, _ in rows]), return_inverse=True)
        customers = np.bincount(which, weights=np.concatenate([c for _, _, c in rows]), minlength=len(keys))
        rng = np.random.default_rng([seed, sweep, tree])
        chance, byte, tables = tree_sweep(keys, customers, top.value, rng)
        sent = np.bincount(byte, weights=tables, minlength=256).astype(np.int64)
        found = np.split(chance[which].astype(np.float32), np.cumsum([len(k) for _, k, _ in rows])[:-1])
        return pa.Table.from_arrays(
            [
                pa.array([*[w for w, _, _ in rows], None], pa.int64()),
                pa.array([tree] * (len(rows) + 1), pa.int32()),
                pa.array([*[f.tobytes() for f in found], None], pa.binary()),
                pa.array([*[None] * len(rows), sent.tobytes()], pa.binary()),
            ],
            schema=schema,
        )

    return asked.groupBy("tree").applyInArrow(run, "words long, tree int, chances binary, sent binary")


def _spelled(word_rows: DataFrame, seated: DataFrame, answers: DataFrame, totals: dict, discount: float, strength: float) -> DataFrame:
    """The word rows with new tables and spelling, and this sweep's predictive probability of each word."""

    def run(key: tuple, mine: pa.Table, found: pa.Table) -> pa.Table:
        row = mine.to_pylist()[0]
        found = found.to_pylist()
        new = next(f for f in found if f["tables"] is not None)
        blobs = {f["tree"]: f["chances"] for f in found if f["chances"] is not None}
        lengths, n, tables = widened(row["lengths"]), widened(new["n"]), widened(new["tables"])
        keys, owner = spelling_ngrams(np.frombuffer(zlib.decompress(row["spelled"]), np.uint8), lengths)
        unique, which = np.unique(keys, return_inverse=True)
        tree = ((unique >> np.uint64(8)) & np.uint64(0xFFFF)).astype(np.int32)
        order = np.argsort(tree, kind="stable")
        chances = np.empty(len(unique))
        chances[order] = np.concatenate([np.frombuffer(blobs[t], np.float32) for t in np.unique(tree).tolist()])
        spelling = np.exp(np.bincount(owner, weights=np.log(chances)[which], minlength=len(lengths)))
        opened = strength + discount * totals["tables"]
        chance = (np.maximum(n - discount * tables, 0.0) + opened * spelling) / (strength + totals["n"])
        chance = np.maximum(chance, 1e-300)
        return _table(
            _WORDS, [row["words"]], [row["hashes"]], [row["spelled"]], [row["lengths"]], [row["seen"]], [new["n"]], [new["tables"]],
            [new["rooms"]], [new["seats"]], [packed(spelling, np.float64)], [np.log10(chance).astype(np.float32).tobytes()],
        )

    shape = "words long, tree int, chances binary, n binary, tables binary, rooms binary, seats binary"
    both = [
        df.select(*[(F.col(n) if n in df.columns else F.lit(None).cast(k)).alias(n) for n, k in (f.split() for f in shape.split(", "))])
        for df in (seated, answers)
    ]
    found = both[0].unionByName(both[1])
    return word_rows.groupBy("words").cogroup(found.groupBy("words")).applyInArrow(run, _WORDS)


def _totals(seated: DataFrame) -> dict:
    """Tables and customers of the word restaurant."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from _batches(_table("tables long, n long", [int(widened(row["tables"]).sum())], [int(widened(row["n"]).sum())]))

    sums = seated.select("tables", "n").mapInArrow(run, "tables long, n long")
    return sums.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tables", "n")]).first().asDict()


_KNOWN = "words long, sweep int, seen binary, rooms binary, seats binary, chance binary"


def _of_words(members: DataFrame, known: DataFrame) -> DataFrame:
    """What each chunk is to know of its words after each of the ``known`` sweeps: (chunk, slice, counts, chance, rooms, seats, sweep).

    Counts and customers in the contexts are the same after every sweep; the first of the given ones tells them.
    """
    out = "chunk long, slice long, counts binary, chance binary, rooms binary, seats binary, sweep int"

    def run(key: tuple, chunks: pa.Table, words: pa.Table) -> pa.Table:
        number, slices = chunks.column("chunk").to_pylist(), chunks.column("words").to_pylist()
        at = [risen(a).astype(np.int64) for a in chunks.column("at").to_pylist()]
        told = []
        for k, row in enumerate(sorted(words.to_pylist(), key=lambda r: r["sweep"])):
            counts, rooms, seats = (widened(row[c]) for c in ("seen", "rooms", "seats"))
            chance, none = np.frombuffer(row["chance"], np.float32), [None] * len(at)
            told.append(_table(
                out, number, slices, none if k else [narrow(counts[p]) for p in at], [chance[p].tobytes() for p in at],
                [narrow(rooms[p]) for p in at], none if k else [narrow(seats[p]) for p in at], [row["sweep"]] * len(at),
            ))
        return pa.concat_tables(told)

    return members.groupBy("words").cogroup(known.groupBy("words")).applyInArrow(run, out)


def _sent_facts(sent: DataFrame, members: DataFrame) -> tuple[int, int]:
    """How many words have one table in all contexts, and how many have two."""

    def run(key: tuple, group: pa.Table) -> pa.Table:
        parts = group.to_pylist()
        size = 1 + max((int(risen(p["at"])[-1]) for p in parts if p["at"] is not None), default=0)
        n = _summed(parts, "sent", size)
        return _table("once long, twice long", [int((n == 1).sum())], [int((n == 2).sum())])

    both = sent.select("words", "chunk", "at", "sent").unionByName(members, allowMissingColumns=True)
    found = both.groupBy("words").applyInArrow(run, "once long, twice long")
    return tuple(found.agg(F.coalesce(F.sum("once"), F.lit(0)), F.coalesce(F.sum("twice"), F.lit(0))).first())


def _sent_up(answers: DataFrame) -> np.ndarray:
    """What the trees sent up, by the byte before: at most 256 x 256 numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((256, 256), dtype=np.int64)
        for batch in batches:
            for tree, sent in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                out[tree & 0xFF] += np.frombuffer(sent, np.int64)
        at = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(out.ravel()[at], pa.int64())], names=["at", "n"])

    sums = answers.filter("sent IS NOT NULL").select("tree", "sent").mapInArrow(run, "at long, n long")
    out = np.zeros(256 * 256, dtype=np.int64)
    for row in sums.groupBy("at").agg(F.sum("n").alias("n")).collect():
        out[row["at"]] = row["n"]
    return out.reshape(256, 256)


def score(docs: DataFrame, held_out: Column, id: str = "doc_id", text: str = "text", seed: int = 17) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity) of every row.

    Learns from the rows where ``held_out`` is false. ``score`` is the model's log10
    probability of the text, ``base_score`` that of single words with 0.1 added to each count.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id].dataType.simpleString()
    texts = docs.select(
        F.col(id).alias("id"), F.coalesce(held_out, F.lit(False)).alias("held"), or_empty(text).alias("text")
    )
    n_bytes = texts.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    bits, word_bits = max(SLICE_BITS, (n_bytes // SLICE_BYTES).bit_length()), max(WORD_BITS, (n_bytes // WORD_BYTES).bit_length())
    width = min(64, n_bytes.bit_length() + SPARE_BITS)
    documents = written(_chunked(texts), "chunks")
    of_lines = documents.select("chunk", "held", "words", "lines", "line_words", "tokens", "line_numbers", "hashes", "line_hashes")
    counted = written(_counted_words(_word_questions(documents, word_bits)), "counted")
    members = counted.filter("chunk IS NOT NULL").select("words", "chunk", "at")
    rows = _word_rows(counted.filter("chunk IS NULL").select("words", "hashes", "spelled", "lengths", "seen"))
    lines = written(_counts(_word_questions(documents, word_bits, lines=True)), "lines")
    pairs = written(_counts(_pair_questions(of_lines, lines.select("chunk", "slice", "opens"), bits, width)), "pairs")
    word = counted.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("kinds", "total")]).first().asDict()
    line, pair = _facts(lines), _facts(pairs)
    own_path = new_path(spark, "own")
    own = written_at(_own_pairs(documents.select("chunk", "tokens", "line_words", "hashes"), pairs.select("chunk", "slice", "counts", "opens"), width), own_path)
    line_discount, line_strength = _discount(line["once"], line["twice"]), 1.0
    pair_discount = _discount(pair["once"], pair["twice"])

    at, told = {"words": new_path(spark, "words")}, []
    rows, strength, totals = written_at(rows, at["words"]), 10.0, {"tables": word["kinds"]}
    top = np.full((256, 256), 1.0 / 256.0)
    for sweep in range(BURN + SAMPLES):
        old, at = at, {name: new_path(spark, name) for name in ("sent", "words", "asked", "answers")}
        known = _of_words(members, told[-1]).select("chunk", "slice", "chance", "rooms") if sweep else None
        sent = written_at(_sent(own, known, sweep, word_bits, width, pair_discount, seed), at["sent"])
        if not sweep:
            discount = _discount(*_sent_facts(sent, members))
        asked = written_at(_asked(rows, sent, members, totals["tables"], sweep, seed, discount, strength), at["asked"])
        seated = asked.filter("tree = -1").select("words", "tree", "n", "tables", "rooms", "seats")
        totals = _totals(seated)
        shared = spark.sparkContext.broadcast(top)  # 512 KB
        answers = written_at(_answers(asked.filter("tree >= 0").select("words", "tree", "keys", "customers"), shared, sweep, seed), at["answers"])
        rows = written_at(_spelled(rows, seated, answers.filter("words IS NOT NULL"), totals, discount, strength), at["words"])
        top = top_sweep(_sent_up(answers), top, np.random.default_rng([seed, sweep]))
        slim = rows.withColumn("sweep", F.lit(sweep)).select(*[f.split()[0] for f in _KNOWN.split(", ")])
        told.append(written(slim, "told"))
        for path in (old["words"], at["sent"], at["asked"], at["answers"]):  # nothing reads them any more
            delete(spark, path)
    told = told[BURN - 1 :]  # the first is only what the next sweep was seated by
    delete(spark, own_path)
    known = told[0]
    for later in told[1:]:
        known = known.unionByName(later)
    found = _told(lines, _LINES, "counts").unionByName(_told(pairs, _PAIRS, "counts"))
    found = found.unionByName(_told(_of_words(members, known), _WORDS_OF, "counts", "chance", "rooms", "seats", "sweep"))

    out = f"id {id_type}, held_out boolean, n_tokens long, n_known long, known double, score double"

    def run(key: tuple, mine: pa.Table, found: pa.Table) -> pa.Table:
        row, found = mine.to_pylist()[0], found.to_pylist()
        chunk = Read(row)
        names, which, before, after = chunk.pairs(width)
        counts = _in_order([f for f in found if f["what"] == _PAIRS], "counts", widened)
        of_line = _by_number(_ascending(chunk.line_hashes), [f for f in found if f["what"] == _LINES], "counts", widened)
        order = _ascending(chunk.hashes)

        def of_word(k: int, name: str, read) -> np.ndarray:
            return _by_number(order, [f for f in found if f["what"] == _WORDS_OF and f["sweep"] == BURN - 1 + k], name, read)

        c, seats = of_word(0, "counts", widened), of_word(0, "seats", widened)
        states = [(10.0 ** of_word(k, "chance", _floats), of_word(k, "rooms", widened)) for k in range(1 + SAMPLES)]
        del found
        follows = np.zeros(len(names))
        for start in range(0, len(names), SCORED):  # pairs do not hang on each other
            some = slice(start, start + SCORED)
            first, second, n = before[some], after[some], counts[some]
            for k, (chance, rooms) in enumerate(states[1:]):
                tables = _context_tables(BURN + k, names[some], n, first, second, *states[k], pair_discount, seed)
                new = (STRENGTH + pair_discount * rooms[first]) * chance[second]
                follows[some] += (np.maximum(n - pair_discount * tables, 0.0) + new) / (STRENGTH + seats[first])
        del names, before, after, counts, states
        follows /= SAMPLES
        np.log10(follows, out=follows)
        drawn = _sums(follows[which[:-1]], chunk.line_words + 1)
        total = line_strength + line["total"]

        def seen(numbers: np.ndarray, new: np.ndarray) -> np.ndarray:
            """log10 probability of lines that a new table would draw with 10 ** new."""
            n = of_line[numbers]
            with np.errstate(divide="ignore"):
                old = np.log10((n - line_discount * (n > 0)) / total)
            return np.logaddexp(old * _TEN, (new + np.log10((line_strength + line_discount * line["kinds"]) / total)) * _TEN) / _TEN

        end = seen(np.array([END]), follows[which[-1:]])[0]
        return pa.Table.from_arrays(
            [
                _ids_in(row["ids"]),
                pa.array(chunk.held),
                pa.array(chunk.words + 1),
                pa.array((_sums((c[chunk.tokens] > 0).astype(float), chunk.words) + (c[END] > 0)).astype(np.int64)),
                pa.array(_sums(np.log10(c + 0.1)[chunk.tokens], chunk.words) + np.log10(c[END] + 0.1)),
                pa.array(_sums(seen(chunk.line_numbers, drawn), chunk.lines) + end),
            ],
            names=["id", "held_out", "n_tokens", "n_known", "known", "score"],
        )

    scored = documents.drop("spelled", "lengths").groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(run, out)
    size = float(np.log10(word["total"] + 0.1 * (word["kinds"] + 1)))
    return scored.select(
        F.col("id").alias(id),
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(word["total"]).cast("bigint").alias("train_tokens"),
        (F.col("known") - F.col("n_tokens") * F.lit(size)).alias("base_score"),
        "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )


_TEN = np.log(10.0)


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive groups of the given sizes, which may be 0."""
    upto = np.concatenate([[0.0], np.cumsum(values)])
    ends = np.cumsum(sizes)
    return upto[ends] - upto[ends - sizes]


def _discount(once: int, twice: int) -> float:
    """The usual estimate from the numbers of kinds seen once and twice."""
    return min(max(once / max(once + 2.0 * twice, 1.0), 0.05), 0.95)

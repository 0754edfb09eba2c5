"""Near duplicates: a Jaccard join on word 5-grams by MinHash banding.

A text's set is the distinct hashes (64 bits) of its runs of ``WORDS`` words: letters and digits in lower
case, all else apart. Texts with equal sets are first folded into one node. Each node has
``bands * rows`` minima of permuted hashes; ``bands`` is the least number that reaches the target recall at
the threshold, 1 - (1 - threshold ** rows) ** bands. Nodes are shuffled on their band hashes; what shares
a band is a candidate. Candidates are gathered into components by links to the least node of each band,
and all texts of a component are verified against each other on their full sets.

Verification is by blocks: a component of more than ``BLOCK`` nodes is cut into blocks by a hash, and a task
holds two blocks at most. It returns, for each node, the number of its links and its least linked
neighbours, never the pairs. The work inside a component still grows with the square of its
different texts; its memory and its rows do not. Classes are the components of the verified links.

Defined results: null text is empty. A text of fewer than ``WORDS`` words has one gram, all its words. A text
without a word has no set and is a copy of equal texts only. ``n_links`` counts different texts of similarity
``threshold`` or more, so exact copies of a text have equal counts and do not count each other. ``class_id``
is the least id of the class; a null id counts only if the class has no other. Repeated rows each come out. An
empty table gives an empty table. Only the id and the text are read, so names of other columns cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslens.llm.arrays import Spans, mixed, pieces, rows_of, runs, string_buffer, word_hashes
from newslens.llm.common import or_empty, written
from newslens.llm.components import components

WORDS, THRESHOLD, RECALL, ROWS = 5, 0.8, 0.999, 5
BLOCK = 1024
#: A gram that is in more texts than this of two blocks is counted by a matrix product.
COMMON = 48

_LETTERS = np.zeros(256, dtype=bool)
_LETTERS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def band_count(threshold: float, recall: float, rows: int) -> int:
    """Bands of ``rows`` rows that find a pair at the threshold with this probability."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))


def grams(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of each text's distinct grams, in order; texts in lower case."""
    starts, ends = runs(_LETTERS[data], offsets)
    hashes = word_hashes(data, starts, ends)
    owner = rows_of(starts, offsets)
    rows = len(offsets) - 1
    count = np.bincount(owner, minlength=rows)
    begin = np.concatenate([[0], np.cumsum(count)])
    size = np.where(count >= words, count - words + 1, np.minimum(count, 1))
    row = np.repeat(np.arange(rows), size)
    place = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size) + begin[row]
    spans = Spans(hashes, 2)
    value = mixed(spans.raw(place, np.minimum(place + words, begin[row + 1])))
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[new], value[new]


def signatures(row: np.ndarray, value: np.ndarray, rows: int, bands: int, per_band: int) -> tuple:
    """(set name of 16 bytes or None, set size, band hashes or None) of each text."""
    size = np.bincount(row, minlength=rows)
    some = np.flatnonzero(size)
    names, tables = [None] * rows, [None] * rows
    if len(some):
        starts = (np.cumsum(size) - size)[some]
        first = np.add.reduceat(mixed(value), starts)
        second = np.add.reduceat(mixed(value ^ np.uint64(0x5851F42D4C957F2D)), starts)
        out = np.empty((len(some), bands), dtype=np.uint64)
        for band in range(bands):
            mix = np.full(len(some), band + 1, dtype=np.uint64)
            for k in range(per_band):
                a = np.uint64((0xD6E8FEB86659FD93 * (2 * (band * per_band + k) + 3)) % (1 << 64) | 1)
                b = mixed(np.array([band * per_band + k + 1], dtype=np.uint64))[0]
                lows = np.minimum.reduceat((value ^ b) * a, starts)
                mix = mixed(mix * np.uint64(0x9E3779B97F4A7C15) + lows)
            out[:, band] = mix
        for k, at in enumerate(some):
            names[at] = first[k].tobytes() + second[k].tobytes()
            tables[at] = out[k].view(np.int64)
    return names, size, tables


def _signed(texts: DataFrame, bands: int, per_band: int, words: int) -> DataFrame:
    """(id, copy, node, size, bands) of (id, copy, text in lower case)."""
    fields = texts.schema
    schema = f"id {fields['id'].dataType.simpleString()}, copy binary, node binary, size int, bands array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = string_buffer(batch.column(2))
            for start, end in pieces(offsets):
                at = offsets[start : end + 1]
                row, value = grams(data[at[0] : at[-1]], at - at[0], words)
                names, size, tables = signatures(row, value, end - start, bands, per_band)
                copy = batch.column(1).slice(start, end - start)
                # a text without a word is named by itself
                names = [n or b"\xff" + c for n, c in zip(names, copy.to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, end - start), copy, pa.array(names, pa.binary()),
                        pa.array(size, pa.int32()), pa.array(tables, pa.list_(pa.int64())),
                    ],
                    names=["id", "copy", "node", "size", "bands"],
                )

    return texts.mapInArrow(run, schema)


def _sets(rows: DataFrame, words: int) -> DataFrame:
    """The rows with the binary ``grams`` (sorted uint64) in place of ``text``, their last column."""
    kept = [f for f in rows.schema.fields if f.name != "text"]
    schema = ", ".join([*[f"{f.name} {f.dataType.simpleString()}" for f in kept], "grams binary"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = string_buffer(batch.column(len(kept)))
            for start, end in pieces(offsets):
                at = offsets[start : end + 1]
                row, value = grams(data[at[0] : at[-1]], at - at[0], words)
                cuts = np.cumsum(np.bincount(row, minlength=end - start))[:-1]
                found = [v.tobytes() for v in np.split(value, cuts)]
                own = [batch.column(k).slice(start, end - start) for k in range(len(kept))]
                yield pa.RecordBatch.from_arrays([*own, pa.array(found, pa.binary())], names=[*[f.name for f in kept], "grams"])

    return rows.select(*[f.name for f in kept], "text").mapInArrow(run, schema)


def shared_grams(sets: list[np.ndarray]) -> np.ndarray:
    """(set, set) sizes of all intersections; the diagonal is 0."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    value = np.concatenate(sets)
    order = np.argsort(value, kind="stable")
    owner, value = owner[order], value[order]
    start = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]])[: len(value)])
    count = np.diff(np.append(start, len(value)))
    out = np.zeros((n, n), dtype=np.float32)
    often = np.flatnonzero(count > COMMON)
    for at in range(0, len(often), 1024):
        part = often[at : at + 1024]
        held = np.zeros((n, len(part)), dtype=np.float32)
        column = np.repeat(np.arange(len(part)), count[part])
        place = np.concatenate([np.arange(start[g], start[g] + count[g]) for g in part])
        held[owner[place], column] = 1.0
        out += held @ held.T
    out = np.triu(out, 1)
    flat = out.reshape(-1)
    few = count[(count > 1) & (count <= COMMON)]
    for times in np.unique(few).tolist():
        same = start[count == times]
        for at in range(0, len(same), 100_000):
            # owners of a gram ascend, so each pair falls into the upper half
            texts = owner[same[at : at + 100_000, None] + np.arange(times)].astype(np.int64)
            for a in range(times - 1):
                np.add.at(flat, (texts[:, a : a + 1] * n + texts[:, a + 1 :]).ravel(), np.float32(1))
    return out + out.T


def _roots(linked: np.ndarray) -> np.ndarray:
    """Least index of each component of a symmetric matrix."""
    label = np.arange(len(linked))
    while True:
        low = np.where(linked, label[None, :], len(linked)).min(axis=1, initial=len(linked))
        new = np.minimum(label, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def verified(nodes: list[bytes], sets: list[np.ndarray], texts: np.ndarray, side: np.ndarray, threshold: float):
    """(node, number of linked texts, root) of one component's block, or of two blocks against each other."""
    both = shared_grams(sets)
    size = np.array([len(s) for s in sets], dtype=np.float64)
    union = size[:, None] + size[None, :] - both
    linked = both >= threshold * union - 1e-6
    np.fill_diagonal(linked, False)
    if side.any():
        linked &= side[:, None] != side[None, :]
    roots = _roots(linked)
    return [(nodes[k], int(linked[k] @ texts), nodes[roots[k]]) for k in range(len(nodes)) if linked[k].any()]


def _links(sets: DataFrame, threshold: float) -> DataFrame:
    """(node, links, root) of (task, root, node, texts, side, grams)."""
    schema = pa.schema([("node", pa.binary()), ("links", pa.int64()), ("near", pa.binary())])

    def run(key: tuple, group: pa.Table) -> pa.Table:
        found = []
        columns = {c: group.column(c).to_pylist() for c in ("root", "node", "texts", "side", "grams")}
        order = sorted(range(group.num_rows), key=lambda k: (columns["root"][k], columns["node"][k], columns["side"][k]))
        at = 0
        while at < len(order):
            end = at
            while end < len(order) and columns["root"][order[end]] == columns["root"][order[at]]:
                end += 1
            own = [k for n, k in enumerate(order[at:end]) if not n or columns["node"][k] != columns["node"][order[at + n - 1]]]
            found += verified(
                [columns["node"][k] for k in own],
                [np.frombuffer(columns["grams"][k], np.uint64) for k in own],
                np.array([columns["texts"][k] for k in own]),
                np.array([columns["side"][k] for k in own]),
                threshold,
            )
            at = end
        return pa.Table.from_pydict(
            {"node": [f[0] for f in found], "links": [f[1] for f in found], "near": [f[2] for f in found]}, schema=schema
        )

    return sets.groupBy("task").applyInArrow(run, "node binary, links long, near binary")


def near_duplicates(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    rows: int = ROWS,
    words: int = WORDS,
) -> DataFrame:
    """(id, copy, class_id, class_size, n_links, kept) of every row; ``copy`` is the md5 of the text.

    ``kept`` marks the rows of the one text of each class that stays: the least (id, copy).
    """
    bands = band_count(threshold, recall, rows)
    texts = docs.select(
        F.col(id).alias("id"), F.unhex(F.md5(or_empty(text).cast("binary"))).alias("copy"),
        F.lower(or_empty(text)).alias("text"),
    )
    signed = written(_signed(texts, bands, rows, words), "signed")

    copies = signed.groupBy("node", "copy").agg(
        F.count(F.lit(1)).alias("docs"), F.min(_id_order()).alias("least"),
        F.first("size").alias("size"), F.first("bands").alias("bands"),
    )
    nodes = copies.groupBy("node").agg(
        F.sum("docs").alias("docs"), F.count(F.lit(1)).alias("texts"), F.min("least").alias("least"),
        F.first("size").alias("size"), F.first("bands").alias("bands"),
    )
    nodes = written(nodes, "nodes")

    banded = nodes.filter("size > 0").select("node", F.posexplode("bands").alias("band", "hash"))
    firsts = banded.groupBy("band", "hash").agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("n"))
    pairs = banded.join(firsts.filter("n > 1").drop("n"), ["band", "hash"]).filter("node != first")
    near = written(components(pairs.select(F.col("node").alias("a"), F.col("first").alias("b"))), "candidates")

    sizes = near.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    total = near.count()
    placed = (
        near.join(sizes, "root")
        .join(nodes.select("node", "texts", "least"), "node")
        .withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    )
    wanted = placed.select(
        F.col("least.id").alias("id"), F.col("least.copy").alias("copy"), "root", "node", "texts", "blocks", "block"
    )
    same = texts["id"].eqNullSafe(wanted["id"]) & (texts["copy"] == wanted["copy"])
    found = texts.join(wanted, same).select("root", "node", "texts", "blocks", "block", "text")
    other = F.sequence(F.lit(0), F.col("blocks") - 1)
    sets = written(_sets(found, words), "sets").withColumn("other", F.explode(other))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    alone = F.concat(F.lit("s"), F.pmod(F.xxhash64("root"), F.lit(max(1, total // 2000))).cast("string"))
    several = F.concat_ws("-", F.hex("root"), low, high)
    sets = sets.select(
        F.when(F.col("blocks") == 1, alone).otherwise(several).alias("task"), "root", "node", "texts",
        F.when(F.col("block") == F.col("other"), 0).when(F.col("block") < F.col("other"), 1).otherwise(2).alias("side"),
        "grams",
    )
    links = written(_links(sets, threshold), "verified")
    classes = components(links.select(F.col("node").alias("a"), F.col("near").alias("b")))
    counts = links.groupBy("node").agg(F.sum("links").alias("links"))

    of_node = (
        nodes.select("node", "docs", "texts", "least")
        .join(classes, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
        .join(counts, "node", "left")
    )
    of_class = of_node.groupBy("root").agg(F.sum("docs").alias("class_size"), F.min("least").alias("stays"))
    of_node = of_node.join(of_class, "root").select(
        "node", "class_size", "stays", (F.coalesce("links", F.lit(0)) + F.col("texts") - 1).alias("n_links")
    )
    mine = F.col("id").eqNullSafe(F.col("stays.id")) & (F.col("copy") == F.col("stays.copy"))
    return signed.select("id", "copy", "node").join(of_node, "node").select(
        F.col("id").alias(id), "copy", F.col("stays.id").alias("class_id"), "class_size", "n_links", mine.alias("kept")
    )


def _id_order():
    """(no id, id, copy): rows with an id first."""
    return F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("copy").alias("copy"))


def one_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay: one of each class."""
    stays = near_duplicates(docs, id, text, **options).filter("kept")
    stays = stays.groupBy(F.col(id).alias("id"), "copy").agg(F.count(F.lit(1)).alias("n"))
    rows = docs.select(F.struct("*").alias("doc"), F.unhex(F.md5(or_empty(text).cast("binary"))).alias("mark"))
    same = rows[f"doc.{id}"].eqNullSafe(stays["id"]) & (rows["mark"] == stays["copy"])
    rows = rows.join(stays, same)
    # rows that repeat id and text are rare, so only they are shuffled once more
    again = rows.filter("n > 1").dropDuplicates(["id", "mark"])
    return rows.filter("n = 1").unionByName(again).select("doc.*")

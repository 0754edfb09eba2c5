"""Approximate nearest neighbours: one navigable small-world graph per shard, shard results merged.

Equal vectors are one node, which carries the ``k + 1`` smallest of its ids: no query can need more of
them, so any share of the rows may hold one vector. Nodes are dealt into shards by a hash of the
vector. In each shard a task builds a hierarchical graph: a node's top layer is drawn from its hash, nodes are
numbered by layer from the top, so that each layer holds a prefix of them and its links are one flat array
(nodes x links). Nodes join a layer in batches: each looks for its neighbours in the graph so far with a
beam of ``BUILD``, and among its batch, and links to those that are nearer to it than to a link already chosen.
Index rows (flat arrays, one row per shard and vector length) are written to the shared folder.

A block of queries meets each shard once: it descends the upper layers greedily and searches the lowest
with a beam of ``BEAM``, all queries of the block at a time. Of what a beam finds, exact distances in double precision on
the original vectors rank the rows; the nearest ``k`` of all shards are merged by a window with a group
limit. Every row is indexed; what a beam misses is missed, so results are approximate (measured recall: README).

Defined results: rows with a null id or vector, a null or infinite component or NaN, or only zeros
take no part. Rows that agree in id and vector are one row. A query is compared with vectors of its length; its
own row is left out. Fewer than ``k`` rows: all of them. Ties go to smaller ids. Squares beyond the
range of doubles count as infinite. An empty table gives an empty table. Other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newslens.llm.blocks import TASKS, block_count, whole_vector
from newslens.llm.common import written

SHARD, QUERIES = 4096, 1024  # vectors of a shard, queries of a block
LINKS = 12  # links of a node in the upper layers; twice as many in the lowest
BUILD, BEAM = 48, 128
BATCH = 512  # nodes that join at once
CELLS = 1 << 22  # numbers in the largest array


def squared(vectors: np.ndarray, left: np.ndarray, queries: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Squared distances of pairs of rows."""
    out = np.empty(len(left))
    step = max(1, CELLS // max(1, vectors.shape[1]))
    for i in range(0, len(left), step):
        gap = vectors[left[i : i + step]] - queries[right[i : i + step]]
        out[i : i + step] = np.einsum("ij,ij->i", gap, gap)
    return out


def beam(vectors: np.ndarray, links: np.ndarray, queries: np.ndarray, entry: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(node, squared distance) of up to ``width`` nodes near each query, nearest first; -1 and inf where there are fewer."""
    n, m = len(queries), links.shape[1]
    node, far = np.full((n, width), -1, np.int64), np.full((n, width), np.inf)
    node[:, 0], far[:, 0] = entry, squared(vectors, entry, queries, np.arange(n))
    done = np.ones((n, width), dtype=bool)
    done[:, 0] = False
    seen = np.zeros((n, len(links) + 1), dtype=bool)  # one more for "no link"
    seen[:, -1] = True
    seen[np.arange(n), entry] = True
    while True:
        row = np.flatnonzero(~done.all(axis=1))
        if not len(row):
            return node, far
        at = (~done[row]).argmax(axis=1)
        done[row, at] = True
        near = links[node[row, at]]
        new = ~seen[row[:, None], near]
        seen[row[:, None], near] = True
        i, j = np.nonzero(new)
        gaps = np.full((len(row), m), np.inf)
        gaps[i, j] = squared(vectors, near[i, j], queries, row[i])
        # only rows with a new node that is nearer than their last
        better = (gaps < far[row, -1:]).any(axis=1)
        row, near, gaps = row[better], near[better], gaps[better]
        every_far = np.concatenate([far[row], gaps], axis=1)
        order = np.argsort(every_far, axis=1, kind="stable")[:, :width]
        far[row] = np.take_along_axis(every_far, order, axis=1)
        node[row] = np.take_along_axis(np.concatenate([node[row], near], axis=1), order, axis=1)
        open_ = np.concatenate([done[row], np.isinf(gaps)], axis=1)
        done[row] = np.take_along_axis(open_, order, axis=1) | np.isinf(far[row])


def chosen(vectors: np.ndarray, node: np.ndarray, far: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` links for each row of candidates, sorted by distance: first those that are nearer to
    the row's node than to a link chosen before, then the nearest of the others; -1 fills up."""
    n, c = node.shape
    out = np.full((n, most), -1, np.int64)
    step = max(1, CELLS // max(1, c * (vectors.shape[1] + c)))
    for i in range(0, n, step):
        ids, gaps = node[i : i + step], far[i : i + step]
        points = vectors[np.maximum(ids, 0)]
        norms = np.einsum("ijk,ijk->ij", points, points)
        between = norms[:, :, None] + norms[:, None, :] - 2 * (points @ points.transpose(0, 2, 1))
        nearest = np.full(ids.shape, np.inf)  # of the links chosen so far
        keep, count = np.zeros(ids.shape, dtype=bool), np.zeros(len(ids), np.int64)
        for j in range(c):
            take = (ids[:, j] >= 0) & (gaps[:, j] < nearest[:, j]) & (count < most)
            keep[:, j] = take
            count += take
            nearest[take] = np.minimum(nearest[take], between[take, j])
        # stable: chosen ones first, then the others by distance, then the gaps
        order = np.argsort(np.where(keep, 0, np.where(ids >= 0, 1, 2)), axis=1, kind="stable")[:, :most]
        out[i : i + step, : order.shape[1]] = np.take_along_axis(ids, order, axis=1)
    return out


def _unique_sorted(node: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Candidates by distance."""
    order = np.lexsort((node, far), axis=1)
    return np.take_along_axis(node, order, axis=1), np.take_along_axis(far, order, axis=1)


def _link_back(vectors: np.ndarray, links: np.ndarray, new: np.ndarray) -> None:
    """Each link of the new nodes gets its way back; where there is no room the best are chosen."""
    most = links.shape[1]
    source, target = np.repeat(new, most), links[new].ravel()
    source, target = source[target >= 0], target[target >= 0]
    here = (links[target] == source[:, None]).any(axis=1)
    source, target = source[~here], target[~here]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    node, first, count = np.unique(target, return_index=True, return_counts=True)
    incoming = np.full((len(node), max(1, count.max(initial=0))), -1, np.int64)
    row = np.repeat(np.arange(len(node)), count)
    incoming[row, np.arange(len(target)) - np.repeat(first, count)] = source
    every = np.concatenate([links[node], incoming], axis=1)
    room = (every >= 0).sum(axis=1) <= most
    packed = np.take_along_axis(every, np.argsort(every < 0, axis=1, kind="stable"), axis=1)
    links[node[room]] = packed[room, :most]
    node, every = node[~room], packed[~room]
    if len(node):
        i, j = np.nonzero(every >= 0)
        far = np.full(every.shape, np.inf)
        far[i, j] = squared(vectors, every[i, j], vectors, node[i])
        links[node] = chosen(vectors, *_unique_sorted(every, far), most)


def build(vectors: np.ndarray, sizes: list[int]) -> list[np.ndarray]:
    """The links of each layer, from the lowest; ``sizes`` are the layers' numbers of nodes, which are prefixes."""
    layers: list[np.ndarray] = []
    for level in range(len(sizes) - 1, -1, -1):
        size, most = sizes[level], LINKS * (2 if level == 0 else 1)
        links = np.full((size, most), -1, np.int64)
        above = len(layers[0]) if layers else 0
        done = 1
        while done < size:
            stop = min(size, 2 * done, done + BATCH)
            if done < above:  # these stand in the layer above, whose entries need not be here yet
                stop = min(stop, above)
            new = np.arange(done, stop)
            entry = descend(vectors, layers, vectors[new]) if done >= above and layers else np.zeros(len(new), np.int64)
            # links of nodes still to come are empty, so the search stays among those that are here
            node, far = beam(vectors, links, vectors[new], entry, BUILD)
            # those of the batch that come before
            points = vectors[new]
            norms = np.einsum("ij,ij->i", points, points)
            inner = norms[:, None] + norms[None] - 2 * points @ points.T
            inner[np.triu_indices(len(new))] = np.inf
            few = min(len(new), BUILD)
            pick = np.argpartition(inner, few - 1, axis=1)[:, :few]
            i, j = np.nonzero(np.isfinite(np.take_along_axis(inner, pick, axis=1)))
            mates, gaps = np.full(pick.shape, -1, np.int64), np.full(pick.shape, np.inf)
            mates[i, j] = new[pick[i, j]]
            gaps[i, j] = squared(vectors, mates[i, j], vectors, new[i])
            node, far = _unique_sorted(np.concatenate([node, mates], axis=1), np.concatenate([far, gaps], axis=1))
            links[new] = chosen(vectors, node[:, :BUILD], far[:, :BUILD], most)
            _link_back(vectors, links, new)
            done = stop
        layers.insert(0, links)
    return layers


def descend(vectors: np.ndarray, layers: list[np.ndarray], queries: np.ndarray) -> np.ndarray:
    """The node at which each query enters the layer below ``layers`` (given from the lowest)."""
    at = np.zeros(len(queries), np.int64)
    for links in reversed(layers):
        at = beam(vectors, links, queries, at, 1)[0][:, 0]
    return at


def search(vectors: np.ndarray, layers: list[np.ndarray], queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    return beam(vectors, layers[0], queries, descend(vectors, layers[1:], queries), width)


def level_sizes(hashes: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """(order of the nodes, number of nodes of each layer); layers above the lowest hold every ``LINKS``-th, and so on."""
    share = ((hashes.astype(np.uint64) >> np.uint64(11)).astype(float) + 1) / 2**53
    level = np.floor(-np.log(share) / math.log(LINKS)).astype(int)
    order = np.lexsort((hashes, -level))
    return order, [int((level >= k).sum()) for k in range(level.max() + 1)]


_INDEX = "dims int, shard int, vectors binary, sizes array<int>, links array<binary>, ids array<{id}>, counts array<int>"
_FOUND = "query {id}, query_row long, id {id}, score double"


def _indexed(table: pa.Table) -> pa.Table:
    dims, shard = table.column("dims")[0], table.column("shard")[0]
    table = table.sort_by([("node", "ascending"), ("ids_text", "ascending")])
    order, sizes = level_sizes(table.column("node").to_numpy())
    table = table.take(pa.array(order))
    vectors = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(order), -1)
    ids = table.column("ids").combine_chunks()
    layers = build(np.ascontiguousarray(vectors, dtype="<f8"), sizes)
    counts = pc.list_value_length(ids)
    return pa.table({
        "dims": pa.array([dims.as_py()], pa.int32()), "shard": pa.array([shard.as_py()], pa.int32()),
        "vectors": pa.array([vectors.astype("<f8").tobytes()], pa.binary()),
        "sizes": pa.array([sizes], pa.list_(pa.int32())),
        "links": pa.array([[x.astype("<i4").tobytes() for x in layers]], pa.list_(pa.binary())),
        "ids": pa.ListArray.from_arrays(pa.array([0, len(ids.flatten())], pa.int32()), ids.flatten()),
        "counts": pa.array([counts.to_numpy(zero_copy_only=False)], pa.list_(pa.int32())),
    })


class Index:
    """One shard, read from its flat arrays."""

    def __init__(self, row: pa.Table):
        get = lambda name: row.column(name)[0]
        self.dims = get("dims").as_py()
        self.vectors = np.frombuffer(get("vectors").as_py(), "<f8").reshape(-1, self.dims)
        self.layers = [
            np.frombuffer(x, "<i4").reshape(n, -1).astype(np.int64) for n, x in zip(get("sizes").as_py(), get("links").as_py())
        ]
        self.ids = get("ids").values
        self.counts = np.array(get("counts").as_py(), dtype=np.int64)
        self.starts = np.cumsum(self.counts) - self.counts

    def nearest(self, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, place of an id, squared distance) of what the beams find; equal vectors give all their ids."""
        node, far = search(self.vectors, self.layers, queries, width)
        q, j = np.nonzero(node >= 0)
        node, far = node[q, j], far[q, j]
        count = self.counts[node]
        place = np.repeat(self.starts[node] - np.cumsum(count) + count, count) + np.arange(count.sum())
        return np.repeat(q, count), place, np.repeat(far, count)


def _searched(k: int, width: int, id_type: str) -> Callable:
    def step(queries: pa.Table, index: pa.Table) -> pa.Table:
        kind = queries.schema.field("id").type
        if not queries.num_rows or not index.num_rows:
            none = pa.array([], kind)
            return pa.table({"query": none, "query_row": pa.array([], pa.int64()), "id": none, "score": pa.array([], pa.float64())})
        shard = Index(index)
        asked = queries.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, shard.dims)
        row, place, far = shard.nearest(np.ascontiguousarray(asked), width)
        ids = shard.ids.take(pa.array(place))
        mine = queries.column("id").combine_chunks().take(pa.array(row))
        itself = pc.equal(ids, mine).to_numpy(zero_copy_only=False) & (far == 0)
        order = np.flatnonzero(~itself)
        rank_of_id = pc.rank(ids, tiebreaker="min").to_numpy()
        order = order[np.lexsort((rank_of_id[order], far[order], row[order]))]
        first = np.flatnonzero(np.concatenate([[True], row[order][1:] != row[order][:-1]])) if len(order) else order
        rank = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
        order = order[rank < k]
        take = pa.array(order)
        return pa.table({
            "query": mine.take(take), "query_row": queries.column("row").combine_chunks().take(pa.array(row[order])),
            "id": ids.take(take), "score": pa.array(np.sqrt(far[order])),
        })

    return step


def nearest(
    rows: DataFrame, queries: str | Column, id: str = "vec_id", vector: str = "embedding", k: int = 10,
    shard: int = SHARD, width: int = BEAM,
) -> DataFrame:
    """(query_id, rank, {id}, score) of the ``k`` nearest rows found for each row that meets the condition ``queries``."""
    condition = F.expr(queries) if isinstance(queries, str) else queries
    name = lambda c: F.col(f"`{c}`")
    used = rows.filter(name(id).isNotNull() & whole_vector(vector) & F.exists(name(vector), lambda x: x != 0)).select(
        name(id).alias("id"), name(vector).cast("array<double>").alias("vector"),
        F.coalesce(condition, F.lit(False)).alias("asks"),
    )
    kind = used.schema["id"].dataType.simpleString()
    # rows that agree in id and vector are one; it asks if any of them does
    used = used.groupBy("id", "vector").agg(F.max("asks").alias("asks"))
    used = written(used.select("*", F.size("vector").alias("dims"), F.xxhash64("vector").alias("node")), "vectors")
    by_id = Window.partitionBy("vector").orderBy("id")
    nodes = used.drop("asks").withColumn("place", F.row_number().over(by_id)).filter(F.col("place") <= k + 1)
    nodes = nodes.groupBy("vector").agg(
        F.first("dims").alias("dims"), F.first("node").alias("node"), F.sort_array(F.collect_list("id")).alias("ids")
    )
    nodes = written(nodes, "nodes")
    counts = nodes.groupBy("dims").agg(F.ceil(F.count(F.lit(1)) / shard).cast("int").alias("shards"))
    placed = nodes.join(counts, "dims").withColumn("shard", F.pmod(F.xxhash64("node"), F.col("shards")).cast("int"))
    placed = placed.drop("shards").withColumn("ids_text", F.col("ids").cast("string"))
    # few bytes, much work: one task for each shard, not as many as fill a partition
    shards = counts.agg(F.sum("shards").alias("n")).first()["n"] or 1
    index = placed.repartition(min(shards, TASKS), "dims", "shard").groupBy("dims", "shard").applyInArrow(_indexed, _INDEX.format(id=kind))
    index = written(index, "index")

    asking = used.filter("asks").select("dims", "id", "vector", F.xxhash64("id", "vector").alias("row"))
    blocks = block_count(asking.count(), QUERIES)
    asking = asking.withColumn("block", F.pmod("row", F.lit(blocks)).cast("int")).join(counts, "dims")
    asking = asking.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).drop("shards")
    copies = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    keys = ["dims", "shard", "block"]
    tasks = min(shards * blocks, TASKS)
    asking, copies = (side.repartition(tasks, *keys).groupBy(*keys) for side in (asking, copies))
    found = asking.cogroup(copies).applyInArrow(_searched(k, width, kind), _FOUND.format(id=kind))
    order = Window.partitionBy("query", "query_row").orderBy("score", "id")
    found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return found.select(F.col("query").alias("query_id"), "rank", F.col("id").alias(id), "score")

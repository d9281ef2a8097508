"""Approximate nearest neighbours by cosine: one hierarchical navigable small-world graph per shard, results merged.

Equal vectors are one node with the smallest ids that have it, so a vector that much of the table repeats is no hot
spot and ties still go to the smallest id. Nodes are dealt to shards of about ``rows_per_shard`` by a hash of the vector.
A shard's graph has layers drawn from the node's place; each layer is a flat array of neighbour numbers, -1 where a node has
fewer. Nodes join in batches: each batch searches the graph so far, keeps neighbours no two of which are nearer to each
other than to the node, then the nearest left out, and is linked back by the same rule.

A search walks down the layers and then keeps a beam of ``ef`` nodes on the lowest, for many queries at a time. Every query
goes to every shard of its width, in blocks of ``queries_per_block``; what the shards return is scored on the original
vectors in double precision and ranked by query. Memory of a task: one shard and one block, whatever the input.

A query costs one search in each shard, so larger shards mean less work: raise ``rows_per_shard`` as far as a task's memory
allows. Beams are approximate; the tests measure recall against brute force.

Defined cases. Vectors that are null, empty or zero, or hold null or non-finite components, are neither queries nor
candidates. Vectors of different widths never meet. A query's own row is no candidate, other rows with its id or its vector
are. Queries with fewer candidates get them all; a query id that several rows have gets the ranks of each. Null ids are no
queries and come last among ties. An empty table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerleaf.session import materialise

ROWS_PER_SHARD = 8192
QUERIES_PER_BLOCK = 4096
#: Links of a node on the upper layers; twice as many on the lowest.
LINKS = 16
EF_BUILD, EF_SEARCH = 64, 128
#: Nodes that join at a time, and queries that search at a time.
TOGETHER = 256
#: Beam places that are followed in one step.
FOLLOWED = 8
SEED = 42
NO_ID = (1 << 63) - 1

_INDEX = "width int, shard int, vectors binary, ids array<array<long>>, layers array<struct<nodes:binary,links:binary,many:int>>"
_LAYERS = pa.list_(pa.struct([("nodes", pa.binary()), ("links", pa.binary()), ("many", pa.int32())]))


def usable(vector: Column) -> Column:
    """No null, no component that is null or not finite, and not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


# -- graphs, in numpy -------------------------------------------------------------------------------------------------
def directions(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, in single precision; scaled by a power of two first so that no square overflows."""
    _, power = np.frexp(np.abs(vectors).max(axis=1, keepdims=True))
    scaled = np.ldexp(vectors, -power)
    return (scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))).astype(np.float32)


def cosines(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Cosine of each pair of rows, in double precision on the vectors as they are but for a power of two."""
    scaled = [np.ldexp(v, -np.frexp(np.abs(v).max(axis=1, keepdims=True))[1]) for v in (queries, vectors)]
    q, v = scaled
    return (q * v).sum(axis=1) / (np.sqrt((q * q).sum(axis=1)) * np.sqrt((v * v).sum(axis=1)))


def beam(points: np.ndarray, links: np.ndarray, queries: np.ndarray, entries: np.ndarray, ef: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``ef`` nearest nodes that a best-first walk finds for each query, nearest first: numbers (-1: none) and cosines."""
    many, size = len(queries), len(points)
    seen = np.zeros((many, size), dtype=bool)
    stamp = np.empty((many, size), dtype=np.int32)
    ids = np.full((many, ef), -1, dtype=np.int64)
    near = np.full((many, ef), -np.inf, dtype=np.float32)
    done = np.ones((many, ef), dtype=bool)
    entries = entries[:, :ef]
    width = entries.shape[1]
    ids[:, :width] = entries
    near[:, :width] = np.where(entries >= 0, np.einsum("bed,bd->be", points[entries], queries), -np.inf)
    done[:, :width] = entries < 0
    rows = np.arange(many)
    seen[np.repeat(rows, width)[(entries >= 0).ravel()], entries[entries >= 0]] = True
    order = np.argsort(-near, axis=1, kind="stable")
    ids, near, done = (np.take_along_axis(x, order, axis=1) for x in (ids, near, done))
    open_rows = rows
    while len(open_rows):
        nearest = np.argsort(done[open_rows], axis=1, kind="stable")[:, :FOLLOWED]
        chosen = np.where(np.take_along_axis(done[open_rows], nearest, axis=1), -1, np.take_along_axis(ids[open_rows], nearest, axis=1))
        done[open_rows[:, None], nearest] = True
        around = np.where(chosen[:, :, None] >= 0, links[chosen], -1).reshape(len(open_rows), -1)
        row = np.broadcast_to(open_rows[:, None], around.shape)
        place = np.broadcast_to(np.arange(around.shape[1], dtype=np.int32), around.shape)
        # of a node that several neighbours name, one mention
        fresh = (around >= 0) & ~seen[row, around]
        r, node, at = row[fresh], around[fresh], place[fresh]
        stamp[r, node] = at
        first = stamp[r, node] == at
        r, node, at = r[first], node[first], at[first]
        seen[r, node] = True
        more_ids = np.full((many, around.shape[1]), -1, dtype=np.int64)
        more = np.full((many, around.shape[1]), -np.inf, dtype=np.float32)
        more_ids[r, at] = node
        more[r, at] = np.einsum("nd,nd->n", points[node], queries[r])
        all_near = np.concatenate([near[open_rows], more[open_rows]], axis=1)
        best = np.argpartition(-all_near, ef - 1, axis=1)[:, :ef] if all_near.shape[1] > ef else np.broadcast_to(np.arange(ef), (len(open_rows), ef))
        best = np.take_along_axis(best, np.argsort(-np.take_along_axis(all_near, best, axis=1), axis=1, kind="stable"), axis=1)
        near[open_rows] = np.take_along_axis(all_near, best, axis=1)
        ids[open_rows] = np.take_along_axis(np.concatenate([ids[open_rows], more_ids[open_rows]], axis=1), best, axis=1)
        done[open_rows] = np.take_along_axis(np.concatenate([done[open_rows], more_ids[open_rows] < 0], axis=1), best, axis=1)
        open_rows = open_rows[~done[open_rows].all(axis=1)]
    return ids, near


def spread_out(points: np.ndarray, ids: np.ndarray, near: np.ndarray, wanted: int) -> np.ndarray:
    """Of candidates (nearest first, -1: none) those nearer to the node than to any taken before; then the nearest others."""
    many, width = ids.shape
    among = points[np.maximum(ids, 0)]
    between = among @ among.transpose(0, 2, 1)
    taken = np.zeros((many, width), dtype=bool)
    for j in range(width):
        hidden = ((between[:, j] > near[:, j, None]) & taken).any(axis=1)
        taken[:, j] = (ids[:, j] >= 0) & ~hidden & (taken.sum(axis=1) < wanted)
    order = np.argsort(np.where(taken, 0, np.where(ids >= 0, 1, 2)), axis=1, kind="stable")[:, :wanted]
    return np.take_along_axis(ids, order, axis=1)


def _link_back(points: np.ndarray, links: np.ndarray, nodes: np.ndarray, chosen: np.ndarray) -> None:
    """Adds each new node to its neighbours' lists; full lists are chosen anew."""
    width = links.shape[1]
    source, target = np.repeat(nodes, chosen.shape[1]), chosen.ravel()
    source, target = source[target >= 0], target[target >= 0]
    near = np.einsum("nd,nd->n", points[source], points[target])
    order = np.lexsort((-near, target))
    source, target = source[order], target[order]
    heads = np.flatnonzero(np.append(True, target[1:] != target[:-1])) if len(target) else np.zeros(0, dtype=np.int64)
    sizes = np.diff(np.append(heads, len(target)))
    place = np.arange(len(target)) - np.repeat(heads, sizes)
    nearest = place < width
    named = target[heads]
    offered = np.full((len(named), 2 * width), -1, dtype=np.int64)
    offered[:, :width] = links[named]
    offered[np.repeat(np.arange(len(named)), sizes)[nearest], width + place[nearest]] = source[nearest]
    # a pair that chose each other in one batch is offered twice
    offered.sort(axis=1)
    offered[:, 1:][offered[:, 1:] == offered[:, :-1]] = -1
    for begin in range(0, len(named), 1024):
        node, ids = named[begin : begin + 1024], offered[begin : begin + 1024]
        close = np.where(ids >= 0, np.einsum("nkd,nd->nk", points[np.maximum(ids, 0)], points[node]), -np.inf)
        order = np.argsort(-close, axis=1, kind="stable")
        ids, close = np.take_along_axis(ids, order, axis=1), np.take_along_axis(close, order, axis=1)
        full = (ids >= 0).sum(axis=1) > width
        links[node[~full]] = ids[~full, :width]
        if full.any():
            links[node[full]] = spread_out(points, ids[full], close[full], width)


def _entries(points: np.ndarray, above: list[tuple[np.ndarray, np.ndarray]], queries: np.ndarray, many: int = 4) -> np.ndarray:
    """Nodes to start from: the way down through the layers above, from the first node of the topmost."""
    if not above:
        return np.zeros((len(queries), 1), dtype=np.int64)
    at = np.zeros((len(queries), 1), dtype=np.int64)
    for nodes, links in above:
        # numbers on a layer are places in its list, and each list begins like the one below
        at, _ = beam(points[nodes], links, queries, at, many)
    return at


def build(points: np.ndarray, links: int = LINKS, ef: int = EF_BUILD, seed: int = SEED) -> list[tuple[np.ndarray, np.ndarray]]:
    """Layers from the top down: node numbers and flat neighbour arrays, whose numbers are places in the layer's nodes.

    Nodes are renumbered by layer so that those of a layer are the first of the next: ``nodes`` of the lowest layer is the
    order of all points.
    """
    size = len(points)
    height = (-np.log(1 - np.random.default_rng(seed).random(size)) / math.log(links)).astype(int)
    order = np.argsort(-height, kind="stable")
    ordered = points[order]
    layers: list[tuple[np.ndarray, np.ndarray]] = []
    for level in range(int(height.max()), -1, -1):
        many, width = int((height >= level).sum()), links * (1 if level else 2)
        near = np.full((many, width), -1, dtype=np.int32)
        _fill(ordered[:many], near, layers, links, ef)
        layers.append((np.arange(many), near))
    return [(order[nodes], near) for nodes, near in layers]


def _fill(points: np.ndarray, links: np.ndarray, above: list[tuple[np.ndarray, np.ndarray]], wanted: int, ef: int) -> None:
    joined = 0
    while joined < len(points):
        # a batch is never larger than what it joins, but for the first
        batch = np.arange(joined, min(len(points), joined + (min(TOGETHER, joined) or 64)))
        found, near = np.zeros((len(batch), 0), dtype=np.int64), np.zeros((len(batch), 0), dtype=np.float32)
        if joined:
            start = np.minimum(_entries(points, above, points[batch]), joined - 1)
            start = np.where((start[:, :1] == start) & (np.arange(start.shape[1]) > 0), -1, start)
            found, near = beam(points[:joined], links[:joined], points[batch], _distinct(start), ef)
        # members of a batch do not see each other in the graph
        inside = points[batch] @ points[batch].T
        np.fill_diagonal(inside, -np.inf)
        k = min(wanted, len(batch))
        mates = np.argpartition(-inside, k - 1, axis=1)[:, :k]
        beside = np.take_along_axis(inside, mates, axis=1)
        found = np.concatenate([found, np.where(beside > -np.inf, batch[mates], -1)], axis=1)
        near = np.concatenate([near, beside], axis=1)
        order = np.argsort(-near, axis=1, kind="stable")[:, : max(ef, wanted)]
        chosen = spread_out(points, np.take_along_axis(found, order, axis=1), np.take_along_axis(near, order, axis=1), wanted)
        links[batch, : chosen.shape[1]] = chosen
        _link_back(points, links, batch, chosen)
        joined += len(batch)


def _distinct(ids: np.ndarray) -> np.ndarray:
    ids = np.sort(ids, axis=1)[:, ::-1].copy()
    ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
    return ids


def nearest(points: np.ndarray, layers: list[tuple[np.ndarray, np.ndarray]], queries: np.ndarray, ef: int = EF_SEARCH) -> np.ndarray:
    """Point numbers (-1: none) nearest to each query, nearest first, by walking down ``layers`` of ``build``."""
    order, lowest = layers[-1]
    ordered = points[order]
    above = [(np.arange(len(nodes)), links) for nodes, links in layers[:-1]]
    out = []
    for begin in range(0, len(queries), TOGETHER):
        part = queries[begin : begin + TOGETHER]
        ids, _ = beam(ordered, lowest, part, _distinct(_entries(ordered, above, part)), min(ef, max(len(points), 1)))
        out.append(np.where(ids >= 0, order[ids], -1))
    return np.concatenate(out) if out else np.zeros((0, ef), dtype=np.int64)


# -- shards, on Spark -------------------------------------------------------------------------------------------------
def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _graph(links: int, ef: int, seed: int):
    def run(rows: pa.Table) -> pa.Table:
        width, shard = rows.column("width")[0].as_py(), rows.column("shard")[0].as_py()
        vectors = _matrix(rows.column("vector"), width)
        layers = [{"nodes": n.astype("<i4").tobytes(), "links": k.astype("<i4").tobytes(), "many": len(n)} for n, k in build(directions(vectors), links, ef, seed)]
        return pa.table({
            "width": pa.array([width], pa.int32()), "shard": pa.array([shard], pa.int32()), "vectors": pa.array([vectors.astype("<f8").tobytes()], pa.binary()),
            "ids": pa.array([rows.column("ids").to_pylist()], pa.list_(pa.list_(pa.int64()))), "layers": pa.array([layers], _LAYERS),
        })

    return run


def nodes(vectors: DataFrame, id_col: str, vector_col: str, copies: int) -> DataFrame:
    """One row per distinct usable vector with the ``copies`` smallest ids that have it; a null id is the largest number."""
    vector = F.col(vector_col)
    rows = vectors.filter(usable(vector)).select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), vector.alias("vector"))
    # Spark keeps so many rows of a vector per task before the shuffle
    smallest = Window.partitionBy("vector").orderBy("id")
    kept = rows.withColumn("place", F.row_number().over(smallest)).filter(F.col("place") <= copies)
    return kept.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))


def build_index(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 5,
    rows_per_shard: int = ROWS_PER_SHARD,
    links: int = LINKS,
    ef: int = EF_BUILD,
    seed: int = SEED,
) -> DataFrame:
    """One row per shard: original vectors, ids of each, and the layers of its graph. Serves searches for up to ``k`` neighbours."""
    distinct = materialise(nodes(vectors, id_col, vector_col, k + 1).withColumn("width", F.size("vector")), "vectors")
    counts = distinct.groupBy("width").agg(F.ceil(F.count(F.lit(1)) / rows_per_shard).cast("int").alias("shards"))
    # a row per width
    dealt = distinct.join(counts, "width").withColumn("shard", F.pmod(F.xxhash64("vector", F.lit(seed)), F.col("shards")).cast("int"))
    shards = dealt.select("width", "shard", "vector", "ids").groupBy("width", "shard")
    return materialise(shards.applyInArrow(_graph(links, ef, seed), _INDEX), "index")


def _ranked(k: int, ef: int):
    """The ``k`` best rows of one shard for each query of a block."""

    def run(shard: pa.Table, asked: pa.Table) -> pa.Table:
        if not shard.num_rows or not asked.num_rows:
            return _FOUND.empty_table()
        row = shard.slice(0, 1).to_pylist()[0]
        vectors = np.frombuffer(row["vectors"], "<f8").reshape(-1, row["width"])
        points, ids = directions(vectors), row["ids"]
        layers = [(np.frombuffer(x["nodes"], "<i4").astype(np.int64), np.frombuffer(x["links"], "<i4").reshape(x["many"], -1).astype(np.int64)) for x in row["layers"]]
        out: list[tuple[int, int, int, float]] = []
        queries, numbers, own = _matrix(asked.column("vector"), row["width"]), asked.column("number").to_pylist(), asked.column("query_id").to_pylist()
        for begin in range(0, len(queries), TOGETHER):
            part = queries[begin : begin + TOGETHER]
            # single precision settles who is looked at, twice as many as are wanted; double precision who is returned
            found = nearest(points, layers, directions(part), ef)[:, : 2 * k + 8]
            at, place = np.nonzero(found >= 0)
            score = cosines(part[at], vectors[found[at, place]])
            for i, cut in enumerate(np.split(np.arange(len(at)), np.searchsorted(at, np.arange(1, len(part))))):
                out += _best(numbers[begin + i], own[begin + i], part[i], [(float(score[j]), int(found[at[j], place[j]])) for j in cut], vectors, ids, k)
        return pa.Table.from_arrays([pa.array([r[c] for r in out], _FOUND.field(c).type) for c in range(4)], schema=_FOUND)

    return run


_FOUND = pa.schema([("number", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _best(number: int, own: int, query: np.ndarray, scored: list[tuple[float, int]], vectors: np.ndarray, ids: list[list[int]], k: int) -> Iterator[tuple[int, int, int, float]]:
    rows = []
    for score, node in scored:
        members = list(ids[node])
        if own in members and np.array_equal(vectors[node], query):
            members.remove(own)
        rows += [(-score, i) for i in members]
    return [(number, own, i, -s) for s, i in sorted(rows)[:k]]


def search(
    index: DataFrame,
    queries: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 5,
    ef: int = EF_SEARCH,
    queries_per_block: int = QUERIES_PER_BLOCK,
) -> DataFrame:
    """The ``k`` nearest rows of each query other than its own: query_id, rank from 1, vec_id, score."""
    vector = F.col(vector_col)
    usable_rows = queries.filter(usable(vector) & F.col(id_col).isNotNull())
    numbered = usable_rows.select(F.col(id_col).cast("long").alias("query_id"), vector.alias("vector"), F.size(vector).alias("width"))
    numbered = materialise(numbered.withColumn("number", F.monotonically_increasing_id()), "queries")
    many = numbered.count()
    blocks = max(1, math.ceil(many / queries_per_block))
    block = F.pmod(F.xxhash64("number"), F.lit(blocks)).cast("int")
    shards = index.groupBy("width").agg(F.max("shard").alias("last"))
    asked = numbered.join(shards, "width").withColumn("block", block).withColumn("shard", F.explode(F.sequence(F.lit(0), "last"))).drop("last")
    copies = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    keys = ["width", "shard", "block"]
    found = copies.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(_ranked(k, ef), "number long, query_id long, vec_id long, score double")
    by = Window.partitionBy("number").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.nullif("vec_id", F.lit(NO_ID)).alias("vec_id"), "score")


def neighbours(vectors: DataFrame, every: int, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5) -> DataFrame:
    """Rows whose id is divisible by ``every`` against all rows."""
    index = build_index(vectors, id_col, vector_col, k)
    return search(index, vectors.filter(F.col(id_col) % every == 0), id_col, vector_col, k)

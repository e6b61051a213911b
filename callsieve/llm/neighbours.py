"""Nearest neighbours by cosine: a navigable small-world graph per shard, shard results merged."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from callsieve.llm.shared import stored
from callsieve.shipping import ship_package

SHARD_VECTORS = 8192
LINKS = 16  # upper layers; the lowest has twice as many
CANDIDATES = 64
BEAM = 96
EXPANDED = 4  # beam entries looked into at a time
BLOCK = 256
QUERIES_PER_BLOCK = 1024
BLOCKS_PER_TASK = 8
SEED = 5

INDEX = (
    "dim int, shard int, n int, layers array<int>, links array<binary>, vectors binary, "
    "id_ends binary, ids binary"
)


def usable(vector: Column) -> Column:
    """Not null or zero, all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def normalised(vectors: np.ndarray) -> np.ndarray:
    wide = vectors.astype(np.float64)
    wide /= np.abs(wide).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return (wide / np.linalg.norm(wide, axis=1, keepdims=True)).astype(np.float32)


def chosen_links(near: np.ndarray, sims: np.ndarray, unit: np.ndarray, links: int) -> np.ndarray:
    """Of each row's candidates (nearest first, -1 for none), up to `links` that lie in different directions.

    A candidate is taken if it is nearer to the node than to any one taken before; places left over go to
    the nearest of the others, so that tight groups stay connected.
    """
    vectors = unit[near]
    between = vectors @ vectors.transpose(0, 2, 1)
    taken = np.zeros(near.shape, bool)
    for c in range(near.shape[1]):
        blocked = (taken & (between[:, c, :] >= sims[:, c, None])).any(axis=1)
        taken[:, c] = (near[:, c] >= 0) & ~blocked & (taken.sum(axis=1) < links)
    rank = np.where(taken, 0, np.where(near >= 0, 1, 2)) * near.shape[1] + np.arange(near.shape[1])
    order = np.argsort(rank, axis=1)[:, :links]
    return np.take_along_axis(near, order, axis=1)


def layer_links(unit: np.ndarray, links: int, candidates: int) -> np.ndarray:
    """One layer over `unit`, in order of insertion: flat neighbour arrays, -1 where there is none.

    A node is linked to some of the nearest of those inserted before it, and they back to it. A node with too
    many links keeps the best of them by the same choice.
    """
    n = len(unit)
    forward = np.full((n, links), -1, np.int32)
    for start in range(0, n, BLOCK):
        stop = min(start + BLOCK, n)
        sims = unit[start:stop] @ unit[:stop].T
        sims[np.arange(stop)[None, :] >= np.arange(start, stop)[:, None]] = -np.inf
        width = min(candidates, stop)
        near = np.argpartition(-sims, width - 1, axis=1)[:, :width]
        close = np.take_along_axis(sims, near, axis=1)
        order = np.argsort(-close, axis=1)
        near, close = np.take_along_axis(near, order, axis=1), np.take_along_axis(close, order, axis=1)
        near = np.where(np.isfinite(close), near, -1)
        made = chosen_links(near, close, unit, links // 2)
        forward[start:stop, : made.shape[1]] = made
    source, place = np.nonzero(forward >= 0)
    target = forward[source, place]
    ends = np.concatenate([np.stack([source, target]), np.stack([target, source])], axis=1)
    sims = np.einsum("ed,ed->e", unit[ends[0]], unit[ends[1]])
    order = np.lexsort((-sims, ends[0]))
    node, other, sims = ends[0][order], ends[1][order], sims[order]
    first = np.searchsorted(node, np.arange(n))
    place = np.arange(len(node)) - first[node]
    inside = place < candidates
    wide = int(place[inside].max(initial=-1)) + 1
    near, close = np.full((n, wide), -1, np.int64), np.full((n, wide), -np.inf, np.float32)
    near[node[inside], place[inside]], close[node[inside], place[inside]] = other[inside], sims[inside]
    out = np.full((n, links), -1, np.int32)
    for start in range(0, n, BLOCK):
        made = chosen_links(near[start : start + BLOCK], close[start : start + BLOCK], unit, links)
        out[start : start + BLOCK, : made.shape[1]] = made
    return out


def build(unit: np.ndarray, links: int = LINKS, candidates: int = CANDIDATES) -> list[np.ndarray]:
    """The layers of a graph over unit vectors that are in order of insertion, lowest layer first.

    Each layer holds the first nodes of the one below, one in `links` of them.
    """
    layers, n = [layer_links(unit, 2 * links, candidates)], len(unit)
    while n > links:
        n = max(1, n // links)
        layers.append(layer_links(unit[:n], links, candidates))
    return layers


def search(layers: list[np.ndarray], unit: np.ndarray, queries: np.ndarray, beam: int = BEAM) -> np.ndarray:
    """The nodes found for each query, up to `beam` of them, -1 for none.

    Down the layers each query walks to its best neighbour until none is better. On the lowest layer
    it keeps a beam of the best nodes seen and looks into them, best first, until all are looked into.
    """
    at = np.zeros(len(queries), np.int64)
    best = queries @ unit[0]
    for layer in reversed(layers[1:]):
        while True:
            near = layer[at]
            sims = np.where(near >= 0, (unit[near] @ queries[:, :, None])[:, :, 0], -np.inf)
            step = sims.argmax(axis=1)
            better = sims[np.arange(len(at)), step] > best
            if not better.any():
                break
            at[better] = near[np.arange(len(at)), step][better]
            best[better] = sims[np.arange(len(at)), step][better]
    n = len(queries)
    rows = np.arange(n)
    nodes, sims = np.full((n, beam), -1, np.int64), np.full((n, beam), -np.inf, np.float32)
    nodes[:, 0], sims[:, 0] = at, best
    done = np.ones((n, beam), bool)
    done[:, 0] = False
    seen = np.zeros((n, len(unit) + 1), bool)  # the last column stands for no neighbour
    seen[rows, at] = True
    seen[:, -1] = True
    while (open_rows := np.flatnonzero((~done).any(axis=1))).size:
        waiting = np.where(done[open_rows], -np.inf, sims[open_rows])
        take = np.argpartition(-waiting, EXPANDED - 1, axis=1)[:, :EXPANDED] if beam > EXPANDED else np.argsort(-waiting)
        valid = np.isfinite(np.take_along_axis(waiting, take, axis=1))
        done[open_rows[:, None], take] = True
        near = layers[0][np.where(valid, nodes[open_rows[:, None], take], -1)]
        near = np.where(valid[:, :, None], near, -1).reshape(len(open_rows), -1)
        near = np.sort(near, axis=1)
        again = np.zeros(near.shape, bool)
        again[:, 1:] = near[:, 1:] == near[:, :-1]
        new = ~again & ~seen[open_rows[:, None], near]
        seen[open_rows[:, None], near] = True
        close = np.where(new, (unit[near] @ queries[open_rows][:, :, None])[:, :, 0], -np.inf)
        both = np.concatenate([sims[open_rows], close], axis=1)
        keep = np.argpartition(-both, beam - 1, axis=1)[:, :beam]
        ids = np.concatenate([nodes[open_rows], near], axis=1)
        finished = np.concatenate([done[open_rows], ~new], axis=1)
        sims[open_rows] = np.take_along_axis(both, keep, axis=1)
        nodes[open_rows] = np.where(
            np.isfinite(sims[open_rows]), np.take_along_axis(ids, keep, axis=1), -1
        )
        done[open_rows] = np.take_along_axis(finished, keep, axis=1) | (nodes[open_rows] < 0)
    return nodes


def cosines(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Cosines in double precision, scaled first so that nothing overflows."""
    left, right = (x.astype(np.float64) / np.abs(x).max(axis=-1, keepdims=True) for x in (left, right))
    norms = np.sqrt((left * left).sum(axis=-1)) * np.sqrt((right * right).sum(axis=-1))
    return (left * right).sum(axis=-1) / norms


def one_row_per_id(vectors: DataFrame, id_column: str, vector: str) -> DataFrame:
    kept = vectors.filter(F.col(id_column).isNotNull() & usable(F.col(vector)))
    return kept.groupBy(F.col(id_column).cast("long").alias("vec_id")).agg(F.min(vector).alias("vector"))


def index(vectors: DataFrame, k: int, per_shard: int = SHARD_VECTORS) -> tuple[DataFrame, int]:
    """A stored table with one graph per row, and the number of shards.

    Equal vectors are one node, which names its k + 1 smallest ids: enough for the k nearest of any
    query, and no limit on how often a vector occurs. Spark keeps those few per task before it shuffles.
    Vectors are dealt to shards by a hash, so shards are alike, and their number follows the table.
    """
    smallest = Window.partitionBy("vector").orderBy("vec_id")
    few = vectors.withColumn("place", F.row_number().over(smallest)).filter(F.col("place") <= k + 1)
    nodes = few.groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    nodes = stored(nodes)
    count = nodes.count()
    shards = max(1, -(-count // per_shard))
    dealt = nodes.select(
        F.size("vector").alias("dim"),
        F.pmod(F.xxhash64("vector"), F.lit(shards)).cast("int").alias("shard"),
        F.xxhash64(F.lit(SEED), "vector").alias("turn"),
        "vector",
        "ids",
    )
    wide = "float" if vectors.schema["vector"].dataType.elementType.simpleString() == "float" else "double"

    def made(table: pa.Table) -> pa.Table:
        table = table.sort_by([("turn", "ascending")])
        dim = table["dim"][0].as_py()
        raw = table["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
        layers = build(normalised(raw))
        ids = table["ids"].combine_chunks()
        row = {
            "dim": dim,
            "shard": table["shard"][0].as_py(),
            "n": len(raw),
            "layers": [len(x) for x in layers],
            "links": [x.astype("<i4").tobytes() for x in layers],
            "vectors": raw.astype("<f4" if wide == "float" else "<f8").tobytes(),
            "id_ends": np.cumsum(ids.value_lengths().to_numpy()).astype("<i8").tobytes(),
            "ids": ids.flatten().to_numpy().astype("<i8").tobytes(),
        }
        return pa.Table.from_pylist([row], schema=arrow_schema)

    arrow_schema = pa.schema(
        [
            ("dim", pa.int32()), ("shard", pa.int32()), ("n", pa.int32()), ("layers", pa.list_(pa.int32())),
            ("links", pa.list_(pa.binary())), ("vectors", pa.binary()), ("id_ends", pa.binary()), ("ids", pa.binary()),
        ]
    )
    return stored(dealt.groupBy("dim", "shard").applyInArrow(made, INDEX)), shards


def found_in_shard(row: dict, query_ids: np.ndarray, queries: np.ndarray, k: int, beam: int) -> Iterator[tuple]:
    """`query_id, vec_id, score` of the k best of one shard for each query, by cosines of the original vectors."""
    kind = "<f4" if len(row["vectors"]) == 4 * row["n"] * row["dim"] else "<f8"
    raw = np.frombuffer(row["vectors"], kind).reshape(row["n"], row["dim"])
    layers = [np.frombuffer(x, "<i4").reshape(n, -1) for n, x in zip(row["layers"], row["links"], strict=True)]
    ends = np.append(0, np.frombuffer(row["id_ends"], "<i8"))
    ids = np.frombuffer(row["ids"], "<i8")
    unit, targets = normalised(raw), normalised(queries)
    beam = min(max(beam, k + 1), max(len(raw), EXPANDED + 1))
    for start in range(0, len(queries), BLOCK):
        nodes = search(layers, unit, targets[start : start + BLOCK], beam)
        for i, own in enumerate(nodes, start):
            own = own[own >= 0]
            scores = cosines(raw[own], queries[i][None, :])
            several = [(-s, v) for s, node in zip(scores, own, strict=True) for v in ids[ends[node] : ends[node + 1]]]
            for score, vec_id in sorted(x for x in several if x[1] != query_ids[i])[:k]:
                yield int(query_ids[i]), int(vec_id), float(-score)


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    id_column: str = "vec_id",
    vector: str = "embedding",
    per_shard: int = SHARD_VECTORS,
    beam: int = BEAM,
) -> DataFrame:
    """`query_id, rank, vec_id, score`: the k vectors found nearest to each row that `is_query` holds for.

    Rows with a null id, or whose vector is null, zero or holds null or non-finite components, take no
    part. Only vectors of the same length are compared. An id that occurs several times counts once, with
    the smallest of its vectors. Every vector is in a graph, and every query searches every shard, in
    blocks of queries; only the k best of a shard leave it. Ties go to the smaller id.
    """
    ship_package(vectors.sparkSession)
    rows = one_row_per_id(vectors, id_column, vector)
    table, shards = index(rows, k, per_shard)
    asked = rows.filter(is_query).withColumn("dim", F.size("vector"))
    blocks = max(1, -(-asked.count() // QUERIES_PER_BLOCK))
    asked = asked.groupBy("dim", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("block")).agg(
        F.collect_list("vec_id").alias("query_ids"), F.flatten(F.collect_list("vector")).alias("queries")
    )
    # A task gets about one shard and a few blocks, as an Arrow batch may hold all rows of a task.
    turns = -(-blocks // BLOCKS_PER_TASK)
    turn = F.floor(F.col("block") / BLOCKS_PER_TASK).cast("int").alias("turn")
    every_shard = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    asked = asked.select("dim", turn, every_shard, "query_ids", "queries")
    table = table.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(turns - 1))))
    key = ["dim", "shard", "turn"]
    pairs = asked.repartition(shards * turns, *key).join(table.repartition(shards * turns, *key), key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                ids = row.pop("query_ids").values.to_numpy(zero_copy_only=False)
                queries = row.pop("queries").values.to_numpy(zero_copy_only=False).reshape(len(ids), -1)
                found = list(found_in_shard({k: v.as_py() for k, v in row.items()}, ids, queries, k, beam))
                columns = zip(zip(*found, strict=True), (pa.int64(), pa.int64(), pa.float64()), strict=True)
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], ["query_id", "vec_id", "score"])

    found = pairs.mapInArrow(run, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")

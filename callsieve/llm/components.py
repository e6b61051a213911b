"""Connected components of a table of links, by rounds of contraction."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from callsieve.llm.shared import stored
from callsieve.shipping import ship_package

MAX_ROUNDS = 60
FEW_LINKS = 10_000


def components(links: DataFrame, most: int | None = None) -> DataFrame:
    """`node, component` for every end of `links` (columns `a, b`, of one type): nodes that links join share a component.

    In each round every node moves to the neighbour (or itself) with the smallest hash of that round, links are
    renamed, and links within a node go. Most nodes vanish in a round, however long the chains
    are, as the hashes differ from round to round. Choosing is an aggregation that is combined in the tasks, so
    a node with very many links loads no task; the joins that rename have the links on their split side. The last
    `FEW_LINKS` links are joined by one task, whose result, with that bound, is broadcast.

    Every round's tables are written and read again: with the sizes of its files the planner never multiplies
    the estimates of earlier rounds, which would soon fill the driver with numbers of millions of digits. Their files follow the
    number of links; the first table's do if the caller knows that there are `most` links at most.
    """
    edges = stored(links.select("a", "b").filter(F.col("a") != F.col("b")).distinct(), most)
    if (left := edges.count()) <= FEW_LINKS:
        return joined_by_one_task(edges)
    nodes = stored(edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct(), 2 * left)
    ends = nodes.count()
    names = nodes.select("node", F.col("node").alias("component"))
    for turn in range(MAX_ROUNDS):
        if left == 0:
            return names
        if left <= FEW_LINKS:
            last = F.broadcast(joined_by_one_task(edges).toDF("old", "new"))
            moved = names.join(last, F.col("component") == F.col("old"), "left")
            return moved.select("node", F.coalesce("new", "component").alias("component"))

        def order(name: str):
            return F.struct(F.xxhash64(F.lit(turn), F.col(name)).alias("h"), F.col(name).alias("to"))

        both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
        nearest = both.groupBy("a").agg(F.min(order("b")).alias("other"))
        moves = stored(
            nearest.select(F.col("a").alias("old"), F.least("other", order("a"))["to"].alias("new")),
            min(ends, 2 * left),
        )
        moved = lambda df, name: (
            df.join(moves, F.col(name) == F.col("old"), "left").withColumn(name, F.coalesce("new", name)).drop("old", "new")
        )
        edges = stored(moved(moved(edges, "a"), "b").filter(F.col("a") != F.col("b")).distinct(), left)
        names = stored(moved(names, "component"), ends)
        left = edges.count()
    raise RuntimeError("links did not contract; this does not happen with working hashes")


def joined_by_one_task(links: DataFrame) -> DataFrame:
    """`node, component` of at most `FEW_LINKS` links."""
    ship_package(links.sparkSession)
    kind = links.schema["a"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict = {}
        node_type = None
        for batch in batches:
            node_type = batch.column(0).type
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x, y = root(parent, a), root(parent, b)
                parent[max(x, y)] = min(x, y)
        if parent:
            ends = [root(parent, node) for node in parent]
            yield pa.RecordBatch.from_arrays([pa.array(list(parent), node_type), pa.array(ends, node_type)], ["node", "component"])

    return stored(links.coalesce(1).mapInArrow(run, f"node {kind}, component {kind}"))


def root(parent: dict, node):
    """The end of a node's path, which is shortened on the way."""
    parent.setdefault(node, node)
    while parent[node] != node:
        parent[node] = parent[parent[node]]
        node = parent[node]
    return node

"""Near-duplicate documents: a forest of sorted MinHash signatures proposes pairs, whole shingle sets confirm them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from callsieve.llm.components import components
from callsieve.llm.shared import FILE_TEXTS, broadcast_if_small, fresh, stored
from callsieve.llm.words import find_words, give_back_memory, mix, powers, text_slices, window_hashes
from callsieve.shipping import ship_package

WORDS = 5
PERCENT = 75
TREES = 20
LEVELS = 5
# A pair at the limit shares the first LEAST values of a tree with probability 0.75^3, so all 20 trees miss it
# once in fifty thousand times; one at 0.8 once in a million.
LEAST = 3
NEIGHBOURS = 2
SMALL_REGION = 24
# What a block of sets may hold on average; a longer set still is in one block.
BLOCK_SETS = 512
BLOCK_SHINGLES = 512 * BLOCK_SETS
# Pairs whose signatures agree in under 0.54 of 100 places are not looked at: for a pair at the limit that
# is almost five standard deviations off.
LEAST_AGREEMENT = 0.54
COLUMNS = 2048

SETS = "doc_id long, text_hash long, n_shingles long, set_key binary, signature binary"


def hash_functions() -> tuple[np.ndarray, np.ndarray]:
    values = mix(np.arange(1, 2 * TREES * LEVELS + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
    a, b = values[: TREES * LEVELS], values[TREES * LEVELS :]
    return ((a >> np.uint64(32)) | np.uint64(1)).astype(np.uint32), (b >> np.uint64(32)).astype(np.uint32)


FACTORS, ADDENDS = hash_functions()


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text, as 64-bit hashes."""
    for _, data, bounds in text_slices(texts):
        words = find_words(data, bounds, lower=True)
        hashes, fits = window_hashes(words, WORDS)
        for first, last in zip(words.first[:-1], words.first[1:], strict=True):
            n = last - first
            if n >= WORDS:
                yield np.unique(hashes[first : last - WORDS + 1])
            elif n:
                short = words.hashes[first:last] * powers(n + 1)[1:]
                yield mix(short.sum(keepdims=True, dtype=np.uint64) + np.uint64(n))
            else:
                yield np.empty(0, np.uint64)


def signature(shingles: np.ndarray) -> bytes:
    """The smallest value of each hash function, big-endian, tree after tree."""
    small = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(FACTORS), 0xFFFFFFFF, np.uint32)
    for start in range(0, len(small), COLUMNS):
        part = small[None, start : start + COLUMNS] * FACTORS[:, None] + ADDENDS[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    return least.astype(">u4").tobytes()


def set_key(shingles: np.ndarray) -> bytes:
    """16 bytes that name a set."""
    twice = mix(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return np.array([mix(shingles).sum(dtype=np.uint64), twice + np.uint64(len(shingles))], ">u8").tobytes()


def shingled(docs: DataFrame) -> DataFrame:
    """Every row's shingle count, a key of its set, and its signature; the last two are null for an empty set.

    `text_hash` tells rows with one id apart.
    """
    ship_package(docs.sparkSession)
    names = [f.split()[0] for f in SETS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                (len(s), set_key(s), signature(s)) if len(s) else (0, None, None) for s in shingle_sets(batch.column(2))
            ]
            sizes, keys, marks = zip(*found, strict=True) if found else ((), (), ())
            made = [pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(marks, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], names)
            give_back_memory()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(run, SETS)


def sizes_fit(a: str, b: str) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * PERCENT


def forest(sets: DataFrame, values: int = LEVELS) -> DataFrame:
    """`sets` once per tree, with `path`: the first `values` values of that tree, in an order that sorts as they do."""
    tree = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")
    path = F.substring("signature", F.col("tree") * (4 * LEVELS) + 1, F.lit(4 * values)).alias("path")
    kept = [c for c in sets.columns if c != "signature"]
    return sets.select("*", tree).select("tree", path, *kept)


def neighbours(sets: DataFrame) -> DataFrame:
    """Pairs `a, b` of sets that are among the next `NEIGHBOURS` in some tree's order and share `LEAST` values there.

    Sorting brings the longest common prefixes together, so the depth at which two sets meet is as deep as
    their part of the tree is crowded. The order is dealt out in ranges; the last rows of a range meet
    the first ones of the next through a table of those rows alone.
    """
    trees = forest(sets.select("set_key", "n_shingles", "signature"))
    ordered = trees.repartitionByRange("tree", "path", "set_key").sortWithinPartitions("tree", "path", "set_key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        first: list[tuple] = []
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            if len(first) < NEIGHBOURS:
                first += rows[: NEIGHBOURS - len(first)]
            yield paired(held + rows, len(held))
            held = (held + rows)[-NEIGHBOURS:]
            del rows
            give_back_memory()
        edge = dict.fromkeys(first + held)
        columns = list(zip(*edge, strict=True)) or [(), (), (), ()]
        kinds = [pa.int32(), pa.binary(), pa.binary(), pa.int64()]
        empty = pa.nulls(len(edge), pa.binary())
        yield pa.RecordBatch.from_arrays([empty, empty, *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], names)

    def paired(rows: list[tuple], known: int) -> pa.RecordBatch:
        """Pairs whose second row is new."""
        pairs = set()
        for step in range(1, NEIGHBOURS + 1):
            for left, right in zip(rows[max(0, known - step) :], rows[max(0, known - step) + step :], strict=False):
                if left[0] == right[0] and left[1][: 4 * LEAST] == right[1][: 4 * LEAST]:
                    low, high = sorted((left[3], right[3]))
                    if low * 100 >= high * PERCENT and left[2] != right[2]:
                        pairs.add((min(left[2], right[2]), max(left[2], right[2])))
        a, b = zip(*pairs, strict=True) if pairs else ((), ())
        none = [pa.nulls(len(a), t) for t in (pa.int32(), pa.binary(), pa.binary(), pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary()), *none], names)

    names = ["a", "b", "tree", "path", "set_key", "n_shingles"]
    schema = "a binary, b binary, tree int, path binary, set_key binary, n_shingles long"
    found = stored(ordered.mapInArrow(run, schema))
    edge = found.filter(F.col("set_key").isNotNull())
    region = F.substring(F.col("path"), 1, 4 * LEAST)
    left = edge.select("tree", region.alias("region"), F.col("set_key").alias("a"), F.col("n_shingles").alias("n_a"))
    right = left.toDF("tree", "region", "b", "n_b")
    across = left.join(right, ["tree", "region"]).filter((F.col("a") < F.col("b")) & sizes_fit("n_a", "n_b"))
    return found.filter(F.col("a").isNotNull()).select("a", "b").union(across.select("a", "b")).distinct()


def alike(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """`a, b, agree` of the pairs whose signatures agree in enough places."""
    left = sets.select(F.col("set_key").alias("a"), F.col("signature").alias("left"))
    right = sets.select(F.col("set_key").alias("b"), F.col("signature").alias("right"))
    both = pairs.join(left, "a").join(right, "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = TREES * LEVELS
        for batch in batches:
            if batch.num_rows:
                first, second = (
                    np.frombuffer(b"".join(batch.column(i).to_pylist()), ">u4").reshape(-1, width) for i in (2, 3)
                )
                agree = (first == second).mean(axis=1)
                keep = pa.array(agree >= LEAST_AGREEMENT)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(agree)], ["a", "b", "agree"]
                ).filter(keep)

    return both.select("a", "b", "left", "right").mapInArrow(run, "a binary, b binary, agree double")


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs `a, b` of sets whose similarity, on the whole sets, reaches the limit.

    `texts` has one text per set; only texts of sets in some pair are shuffled.
    """
    left = texts.select(F.col("set_key").alias("a"), F.col("text").alias("left"))
    right = texts.select(F.col("set_key").alias("b"), F.col("text").alias("right"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for first, second in zip(shingle_sets(batch.column(2)), shingle_sets(batch.column(3)), strict=True):
                common = len(np.intersect1d(first, second, assume_unique=True))
                good.append(100 * common >= PERCENT * (len(first) + len(second) - common))
            pairs = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"])
            yield pairs.filter(pa.array(good, pa.bool_()))
            give_back_memory()

    return both.select("a", "b", "left", "right").mapInArrow(run, "a binary, b binary")


def open_regions(sets: DataFrame, names: DataFrame) -> DataFrame:
    """`region, members, set_key, n_shingles, component` of all sets in regions that hold several components so far.

    A region is what shares `LEAST` values in a tree. A region in one component is done.
    """
    known = names.select(F.col("node").alias("set_key"), "component")
    named = sets.select("set_key", "n_shingles", "signature").join(known, "set_key", "left")
    rows = forest(named.withColumn("component", F.xxhash64(F.coalesce("component", "set_key"))), LEAST)
    rows = rows.withColumn("region", F.xxhash64("tree", "path")).drop("tree", "path", "low")
    regions = rows.groupBy("region").agg(
        F.count(F.lit(1)).alias("members"), F.min("component").alias("low"), F.max("component").alias("high")
    )
    mixed = stored(regions.filter(F.col("low") != F.col("high")).select("region", "members"))
    return stored(rows.join(broadcast_if_small(mixed), "region"))


def pairs_of_small_regions(rows: DataFrame) -> DataFrame:
    """All pairs `a, b` of a small open region that are in different components."""
    small = rows.filter(F.col("members") <= SMALL_REGION)
    left = small.select(
        "region", F.col("set_key").alias("a"), F.col("n_shingles").alias("n_a"), F.col("component").alias("c_a")
    )
    right = left.toDF("region", "b", "n_b", "c_b")
    apart = (F.col("a") < F.col("b")) & (F.col("c_a") != F.col("c_b")) & sizes_fit("n_a", "n_b")
    return left.join(right, "region").filter(apart).select("a", "b").distinct()


def links_of_large_regions(rows: DataFrame, sets: DataFrame, docs: DataFrame) -> DataFrame | None:
    """Links `a, b` that join the components in large open regions, from comparing whole sets; None without such regions.

    Regions with sets in common form a cluster. Its largest component needs no look inside; the sets outside it
    are compared with all sets of the cluster, exactly, a block of sets against a block at a time. Blocks are bounded by
    their sets and by the shingles in them, so long texts lie in blocks of few. Of the links between two blocks those
    that join components are given out, at most one per component.
    """
    large = rows.filter(F.col("members") > SMALL_REGION)
    if large.isEmpty():
        return None
    ends = large.select(F.unhex(F.hex("region")).alias("a"), F.col("set_key").alias("b"))
    clusters = components(ends, large.count()).toDF("set_key", "cluster")
    members = stored(large.select("set_key", "component", "n_shingles").distinct().join(clusters, "set_key"))
    counts = members.groupBy("cluster", "component").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("shingles")
    )
    sums = counts.groupBy("cluster").agg(
        F.sum("n").alias("n"),
        F.sum("shingles").alias("shingles"),
        F.max_by(F.struct("component", "n", "shingles"), F.struct("n", "component")).alias("main"),
    )

    def block_count(n: Column, shingles: Column) -> Column:
        return F.greatest(F.ceil(n / BLOCK_SETS), F.ceil(shingles / BLOCK_SHINGLES))

    n, shingles = F.col("n"), F.col("shingles")
    sizes = sums.select(
        "cluster",
        block_count(n, shingles).alias("all"),
        block_count(n - F.col("main.n"), shingles - F.col("main.shingles")).alias("outside"),
        F.col("main.component").alias("main"),
    )
    texts = texts_of(members.select("set_key"), sets, docs)
    given = members.join(stored(sizes), "cluster").join(texts, "set_key")

    def blocks(of: DataFrame, size: str, name: str) -> DataFrame:
        keys = of.groupBy("cluster", F.pmod(F.xxhash64("set_key"), F.col(size)).alias(name))
        return keys.agg(F.collect_list(F.struct("set_key", "component", "text")).alias(f"{name}_sets"))

    every = blocks(given, "all", "right")
    outside = given.filter(F.col("component") != F.col("main"))
    target = F.explode(F.sequence(F.lit(0).cast("long"), F.col("all") - 1)).alias("right")
    outside = blocks(outside, "outside", "left").join(sizes.select("cluster", "all"), "cluster").select("*", target)
    pairs = outside.join(every, ["cluster", "right"]).repartition("cluster", "left", "right")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                sides = []
                for column in (0, 1):
                    rows = batch.column(column)[i].values
                    keys, own, texts = (rows.field(k) for k in range(3))
                    sides.append((keys.to_pylist(), own.to_pylist(), list(shingle_sets(texts))))
                found = list(joining_links(*sides))
                a, b = zip(*found, strict=True) if found else ((), ())
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])
                give_back_memory()

    return pairs.select("left_sets", "right_sets").mapInArrow(run, "a binary, b binary")


def joining_links(left: tuple, right: tuple) -> Iterator[tuple[bytes, bytes]]:
    """Links between two blocks of (keys, components, shingle sets) that join components not yet joined here."""
    keys, own, sets = right
    distinct, which = np.unique(np.concatenate(sets), return_inverse=True)
    sizes = np.array([len(s) for s in sets])
    starts = np.cumsum(sizes) - sizes
    names, component = np.unique(np.array(own), return_inverse=True)
    marked = np.zeros(len(distinct) + 1, np.uint8)
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    for key, name, shingles in zip(*left, strict=True):
        at = np.minimum(np.searchsorted(distinct, shingles), len(distinct) - 1)
        at = at[distinct[at] == shingles]
        marked[at] = 1
        common = np.add.reduceat(marked[which], starts, dtype=np.int64)
        marked[at] = 0
        linked = np.flatnonzero(100 * common >= PERCENT * (len(shingles) + sizes - common))
        for c, first in zip(*np.unique(component[linked], return_index=True), strict=True):
            x, y = root(name), root(int(names[c]))
            if x != y:
                parent[x] = y
                yield key, keys[linked[first]]


def texts_of(keys: DataFrame, sets: DataFrame, docs: DataFrame) -> DataFrame:
    """`set_key, text`: one text for each of the sets named in `keys`, stored.

    Only the keys move if their size allows it; the corpus is read once and its other texts are left.
    """
    wanted = stored(sets.join(keys.distinct(), "set_key").select("set_key", "low"))
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("hash"), "text")
    own = F.col("id").eqNullSafe(F.col("low.doc_id")) & (F.col("hash") == F.col("low.text_hash"))
    texts = rows.join(broadcast_if_small(wanted), own).groupBy("set_key").agg(F.first("text").alias("text"))
    return stored(texts, wanted.count(), FILE_TEXTS)


def between(pairs: DataFrame, names: DataFrame) -> DataFrame:
    """The pairs whose two ends are in different components."""
    left, right = names.toDF("a", "c_a"), names.toDF("b", "c_b")
    both = pairs.select("a", "b").join(left, "a", "left").join(right, "b", "left")
    return both.filter(F.coalesce("c_a", "a") != F.coalesce("c_b", "b")).select("a", "b")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """`doc_id, n_shingles, component_id, kept` for every row of `docs`.

    Rows whose sets are equal are one node of the graph; so rows with an id in common, or without an id, need no
    treatment of their own. `component_id` is the smallest id of the rows that are linked, directly or
    through others; a row whose set is empty has its own id. `kept` says that the two ids are equal (a
    row without an id is kept only if no row of its component has one). Texts are used whole.
    """
    marked, labels = classes(docs)
    rows = marked.join(labels, "set_key", "left")
    component = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    rows = rows.withColumn("component_id", component)
    return rows.select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows with their sets (`shingled`, without signatures), and `set_key, component_id` for every set."""
    marked = stored(shingled(docs))
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    sets = marked.filter(F.col("n_shingles") > 0).groupBy("set_key").agg(
        F.first("n_shingles").alias("n_shingles"), F.min(place).alias("low"), F.first("signature").alias("signature")
    )
    sets = stored(sets)

    close = stored(alike(neighbours(sets), sets))
    n = close.count()
    texts = texts_of(close.select(F.col("a").alias("set_key")).union(close.select("b")), sets, docs)
    best = close.select("a", "b", "agree").union(close.select(F.col("b"), F.col("a"), "agree"))
    best = best.groupBy("a").agg(F.max_by("b", F.struct("agree", "b")).alias("b"))
    best = best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = stored(confirmed(best, texts))
    links = stored(links.union(confirmed(between(close, components(links, n)), texts)))

    names = components(links, 2 * n)
    rows = open_regions(sets, names)
    rest = stored(alike(pairs_of_small_regions(rows), sets))
    if not rest.isEmpty():
        texts = texts_of(rest.select(F.col("a").alias("set_key")).union(rest.select("b")), sets, docs)
        links = stored(links.union(confirmed(rest, texts)))
    more = links_of_large_regions(rows, sets, docs)
    if more is not None or not rest.isEmpty():
        names = components(links if more is None else links.union(more))
    every = sets.select("set_key", F.col("low.doc_id").alias("doc_id")).join(
        names.toDF("set_key", "component"), "set_key", "left"
    )
    every = stored(every.withColumn("component", F.coalesce("component", "set_key")))
    lowest = every.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    labels = every.join(lowest, "component").select("set_key", "component_id")
    return marked.drop("signature"), labels


def deduplicated(docs: DataFrame) -> DataFrame:
    """`docs` with one row for each component; rows with an empty set all stay.

    The row that stays has the component's smallest id; of several such rows it is the one with the smallest hash
    of its text, and equal rows are kept once.
    """
    marked, labels = classes(docs)
    rows = marked.join(labels, "set_key")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    groups = rows.groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("set_key")).alias("own"))
    stays = stored(groups.agg(F.min(order).alias("stays")).select("stays.doc_id", "stays.text_hash").distinct())
    named = rows.select("doc_id", "text_hash").groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("times"))
    id_, hash_, times = fresh(docs, "_id", "_hash", "_times")
    named = named.toDF(id_, hash_, times)
    chosen = F.col(id_).eqNullSafe(F.col("doc_id")) & (F.col(hash_) == F.col("text_hash"))
    gone = stored(named.join(stays, chosen, "left_anti"))
    twice = stored(named.filter(F.col(times) > 1).join(stays, chosen, "left_semi"))
    same = F.col(id_).eqNullSafe(F.col("doc_id").cast("long")) & (F.col(hash_) == F.xxhash64("text"))
    rest = docs.join(broadcast_if_small(gone), same, "left_anti")
    if twice.isEmpty():
        return rest
    once = rest.join(broadcast_if_small(twice), same).dropDuplicates([id_, hash_]).drop(id_, hash_, times)
    return rest.join(broadcast_if_small(twice), same, "left_anti").unionByName(once)

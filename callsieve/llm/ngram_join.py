"""Documents with almost equal n-gram sets: the global n-gram order cut into fragments, overlaps counted by fragment."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from callsieve.llm.components import components
from callsieve.llm.shared import broadcast_if_small, stored
from callsieve.llm.words import find_words, mix, powers, text_slices, window_hashes
from callsieve.shipping import ship_package

WORDS = 3
PERCENT = 90
# A quarter of a set's n-grams is nearly always enough for its prefix, a tenth, to leave out the frequent ones among them.
FRAGMENT_BITS = 2
FRAGMENTS = 1 << FRAGMENT_BITS
CELL = 24  # sets that share an n-gram of their prefixes: up to here each is paired with each
# At most this many n-grams have more than one part in this many of all rows; those are broadcast.
FREQUENT = 10_000
BLOCK_SETS = 1024
BLOCK_BYTES = 4 << 20
COLUMNS = 2048
CLASS_WIDTH = 1.12  # sets that link are in one class of sizes or in two that touch

SETS = "doc_id long, text_hash long, n_shingles long, set_key binary, grams array<long>, spread array<int>"


def gram_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct n-grams of each text, as 64-bit hashes; a text of fewer words is one n-gram."""
    for _, data, bounds in text_slices(texts):
        words = find_words(data, bounds, lower=True)
        hashes, _ = window_hashes(words, WORDS)
        for first, last in zip(words.first[:-1], words.first[1:], strict=True):
            n = last - first
            if n >= WORDS:
                yield np.unique(hashes[first : last - WORDS + 1])
            elif n:
                short = words.hashes[first:last] * powers(n + 1)[1:]
                yield mix(short.sum(keepdims=True, dtype=np.uint64) + np.uint64(n))
            else:
                yield np.empty(0, np.uint64)


def fragment(grams: np.ndarray) -> np.ndarray:
    """Which part of the global order n-grams are in: their first bits."""
    return (grams.view(np.uint64) >> np.uint64(64 - FRAGMENT_BITS)).astype(np.int64)


def missing(n):
    """How many n-grams of a set of n a linked set may lack."""
    return n - -(-PERCENT * n // 100)


def set_key(grams: np.ndarray) -> bytes:
    """16 bytes that name a set."""
    twice = mix(grams ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return np.array([mix(grams).sum(dtype=np.uint64), twice + np.uint64(len(grams))], ">u8").tobytes()


def marked_rows(docs: DataFrame) -> DataFrame:
    """Every row's set: its size, a key, the n-grams of its first fragments, and how many each of these holds.

    Fragments are taken until they hold one n-gram more than a linked set may lack. A linked pair shares one of the
    n-grams that come first in both sets, so later fragments play no part in finding pairs.
    """
    ship_package(docs.sparkSession)
    names = [f.split()[0] for f in SETS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, firsts, spreads = [], [], [], []
            for grams in gram_sets(batch.column(2)):
                own = fragment(grams)
                first = grams[: int(np.searchsorted(own, own[missing(len(grams))], "right"))] if len(grams) else grams
                sizes.append(len(grams))
                keys.append(set_key(grams) if len(grams) else None)
                firsts.append(first.view(np.int64))
                spreads.append(np.bincount(own[: len(first)], minlength=FRAGMENTS).astype(np.int32))
            made = [
                pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(firsts, pa.list_(pa.int64())),
                pa.array(spreads, pa.list_(pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(run, SETS)


def with_counts(rows: DataFrame, counts: DataFrame, total: int) -> DataFrame:
    """`rows` joined with `counts` by `gram`, where `counts.n_sets` is how many rows an n-gram has.

    N-grams with over a `FREQUENT`th of all rows are at most `FREQUENT`, and meet their rows by broadcast, so that
    no task of the shuffled join for the others gets a frequent one's rows.
    """
    limit = max(1000, total // FREQUENT)
    often = F.broadcast(counts.filter(F.col("n_sets") > limit))
    rest = rows.join(often.select("gram"), "gram", "left_anti").join(counts.filter(F.col("n_sets") <= limit), "gram")
    return rows.join(often, "gram").unionByName(rest)


def prefixes(sets: DataFrame) -> DataFrame:
    """`gram, sid, n, place` for the n-grams of each set's prefix that other sets' first fragments hold too, stored.

    The global order goes fragment by fragment and by frequency within one. An n-gram that a single set has can't
    link it, but takes a place: sets whose first n-grams are all their own drop out here.
    """
    emitted = sets.select("sid", F.explode("grams").alias("gram"))
    counts = emitted.groupBy("gram").agg(F.count(F.lit(1)).alias("n_sets"))
    counts = stored(counts.filter(F.col("n_sets") > 1))
    total = sets.agg(F.sum(F.size("grams"))).first()[0] or 0
    shared = with_counts(emitted, counts, total)
    shared = shared.groupBy("sid").agg(F.collect_list("gram").alias("grams"), F.collect_list("n_sets").alias("n_sets"))
    given = sets.select("sid", F.col("n_shingles").alias("n"), "spread").join(shared, "sid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            sid, n = (batch.column(k).to_numpy() for k in (0, 1))
            spread = batch.column(2).flatten().to_numpy().reshape(rows, FRAGMENTS).astype(np.int64)
            row = np.repeat(np.arange(rows), batch.column(3).value_lengths().to_numpy())
            grams, often = (batch.column(k).flatten().to_numpy() for k in (3, 4))
            part = fragment(grams)
            order = np.lexsort((grams, often, part, row))
            grams, row, part = grams[order], row[order], part[order]
            group = row * FRAGMENTS + part
            held = np.bincount(group, minlength=rows * FRAGMENTS)
            own = (spread - held.reshape(rows, FRAGMENTS) + np.cumsum(spread, axis=1) - spread).ravel()
            place = own[group] + np.arange(len(group)) - (np.cumsum(held) - held)[group]
            keep = place <= missing(n)[row]
            columns = [pa.array(x[keep]) for x in (grams, sid[row], n[row], place)]
            yield pa.RecordBatch.from_arrays(columns, ["gram", "sid", "n", "place"])

    return stored(given.mapInArrow(run, "gram long, sid long, n long, place long"))


def can_link(n_a: str, place_a: str, n_b: str, place_b: str) -> Column:
    """False if two sets whose first common n-gram has these places are too different."""
    common = F.least(F.col(n_a) - F.col(place_a), F.col(n_b) - F.col(place_b))
    enough = common * (100 + PERCENT) >= (F.col(n_a) + F.col(n_b)) * PERCENT
    return enough & (F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * PERCENT)


def celled(rows: DataFrame) -> DataFrame:
    """Prefix rows of n-grams in several prefixes, with how many, and the one with the earliest place as `hub`; stored."""
    cells = rows.groupBy("gram").agg(
        F.count(F.lit(1)).alias("n_sets"), F.min(F.struct("place", "sid", "n")).alias("hub")
    )
    return stored(with_counts(rows, stored(cells.filter(F.col("n_sets") > 1)), rows.count()))


def candidate_pairs(rows: DataFrame) -> DataFrame:
    """Pairs `a, b` of every set with the hubs of its cells, and all pairs of small cells."""
    hubs = rows.select("gram", "sid", "n", "place", F.col("hub.sid").alias("b"), F.col("hub.n").alias("n_b"), F.col("hub.place").alias("place_b"))
    hubs = hubs.filter((F.col("sid") != F.col("b")) & can_link("n", "place", "n_b", "place_b")).select("sid", "b")
    small = rows.filter((F.col("n_sets") > 2) & (F.col("n_sets") <= CELL)).select("gram", "sid", "n", "place")
    both = small.join(small.toDF("gram", "b", "n_b", "place_b"), "gram")
    both = both.filter((F.col("sid") < F.col("b")) & can_link("n", "place", "n_b", "place_b")).select("sid", "b")
    every = hubs.union(both)
    return every.select(F.least("sid", "b").alias("a"), F.greatest("sid", "b").alias("b")).distinct()


def fragments_of(keys: DataFrame, sets: DataFrame, docs: DataFrame) -> DataFrame:
    """`sid, n, part, grams` (sorted, as bytes) of the sets named in `keys`, a row per fragment, stored.

    The corpus is read once; only the sets asked for are cut up, where they are read. Rows that are repeated as they are
    come out several times.
    """
    ship_package(docs.sparkSession)
    wanted = sets.join(keys.select("sid").distinct(), "sid").select("sid", "low")
    wanted = broadcast_if_small(stored(wanted))
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("hash"), "text")
    own = F.col("id").eqNullSafe(F.col("low.doc_id")) & (F.col("hash") == F.col("low.text_hash"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sids = batch.column(0).to_pylist()
            made = []
            for sid, grams in zip(sids, gram_sets(batch.column(1)), strict=True):
                ends = np.searchsorted(fragment(grams), np.arange(FRAGMENTS + 1))
                for k, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
                    if b > a:
                        made.append((sid, len(grams), k, grams[a:b].tobytes()))
            columns = zip(*made, strict=True) if made else ((), (), (), ())
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["sid", "n", "part", "grams"])

    return stored(rows.join(wanted, own).select("sid", "text").mapInArrow(run, "sid long, n long, part int, grams binary"))


def confirmed(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """The pairs `a, b` that reach the limit: overlaps counted in each fragment, then summed for the pair."""
    left = parts.select(F.col("sid").alias("a"), "part", F.col("n").alias("n_a"), F.col("grams").alias("left"))
    right = parts.select(F.col("sid").alias("b"), "part", F.col("n").alias("n_b"), F.col("grams").alias("right"))
    met = pairs.join(left, "a").join(right, ["b", "part"]).select("a", "b", "n_a", "n_b", "part", "left", "right")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            common = [
                len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))
                for x, y in zip(batch.column(5).to_pylist(), batch.column(6).to_pylist(), strict=True)
            ]
            columns = [*(batch.column(k) for k in range(5)), pa.array(common, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b", "n_a", "n_b", "part", "common"])

    counted = met.mapInArrow(run, "a long, b long, n_a long, n_b long, part int, common long")
    # A fragment's count may come several times, from repeated rows, so each is taken once.
    each = [F.coalesce(F.max(F.when(F.col("part") == k, F.col("common"))), F.lit(0).cast("long")) for k in range(FRAGMENTS)]
    summed = counted.groupBy("a", "b", "n_a", "n_b").agg(sum(each[1:], each[0]).alias("common"))
    enough = F.col("common") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("common")) * PERCENT
    return summed.filter(enough).select("a", "b")


def links_of_large_cells(rows: DataFrame, names: DataFrame, sets: DataFrame, docs: DataFrame) -> DataFrame | None:
    """Links `a, b` that join components within cells of over `CELL` sets; None if every such cell is in one component.

    Cells with sets in common are put together. Sets outside the largest component of such a cluster are compared with each other
    and with its sets, if their sizes fit, a block of sets with a block of sets: partial overlaps as a matrix for each
    fragment, and their sum. Blocks are bounded in bytes. Of the links between two blocks those that join components
    come out.
    """
    ship_package(docs.sparkSession)
    large = rows.filter(F.col("n_sets") > CELL).select("gram", "sid", "n", F.col("hub.sid").alias("hub"))
    known = names.select(F.col("node").alias("sid"), "component")
    large = large.join(known, "sid", "left").withColumn("component", F.coalesce("component", "sid"))
    large = stored(large)
    several = large.groupBy("gram").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    several = stored(several.filter(F.col("low") != F.col("high")).select("gram"))
    if several.isEmpty():
        return None
    opened = large.join(broadcast_if_small(several), "gram", "left_semi")
    clusters = components(opened.select(F.col("sid").alias("a"), F.col("hub").alias("b"))).toDF("sid", "cluster")
    size = F.floor(F.log(F.col("n")) / F.log(F.lit(CLASS_WIDTH))).cast("int")
    members = stored(opened.select("sid", "n", "component", size.alias("size")).distinct().join(clusters, "sid"))
    main = members.groupBy("cluster", "component").agg(F.count(F.lit(1)).alias("k"))
    main = main.groupBy("cluster").agg(F.max_by("component", F.struct("k", "component")).alias("main"))
    members = stored(members.join(stored(main), "cluster").withColumn("outside", F.col("component") != F.col("main")))
    kind = ["cluster", "size", "outside"]
    blocks = members.groupBy(*kind).agg(
        F.greatest(
            F.ceil(F.count(F.lit(1)) / BLOCK_SETS), F.ceil(F.sum(F.col("n") * 8) / BLOCK_BYTES), F.lit(1)
        ).alias("blocks")
    )
    blocks = stored(blocks)
    placed = stored(members.join(blocks, kind).withColumn("block", F.pmod(F.xxhash64("sid"), "blocks")).select("sid", "component", *kind, "block"))
    given = placed.join(fragments_of(members, sets, docs), "sid")
    row = F.struct("sid", "component", "n", "part", "grams")
    every = stored(given.groupBy(*kind, "block").agg(F.collect_list(row).alias("held")))

    # Each pair of blocks of one size, or of one size and the next, is compared once, unless both are in the largest component.
    key = F.struct("size", "outside", "block")
    first = every.select("cluster", key.alias("left_key"))
    near = F.explode(F.array(F.col("left_key.size"), F.col("left_key.size") + 1)).alias("size")
    second = every.select("cluster", "size", key.alias("right_key"))
    pairs = first.select("*", near).join(second, ["cluster", "size"]).filter(F.col("left_key.outside") | F.col("right_key.outside"))
    pairs = stored(pairs.filter(F.col("left_key") <= F.col("right_key")).drop("size"))
    left = every.select("cluster", key.alias("left_key"), F.col("held").alias("left"))
    right = every.select("cluster", key.alias("right_key"), F.col("held").alias("right"))
    met = pairs.join(left, ["cluster", "left_key"]).join(right, ["cluster", "right_key"]).select("left", "right")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                found = list(joining_links(*(block_of(batch.column(k)[i].values) for k in (0, 1))))
                a, b = zip(*found, strict=True) if found else ((), ())
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return met.mapInArrow(run, "a long, b long")


def block_of(rows: pa.StructArray) -> tuple:
    """`sids, components, sizes` of a block's sets, and for each fragment which set each n-gram is of, and the n-grams."""
    sid, component, n, part = (rows.field(k).to_numpy() for k in range(4))
    sids, first, which = np.unique(sid, return_index=True, return_inverse=True)
    grams = [np.frombuffer(g, np.uint64) for g in rows.field(4).to_pylist()]
    parts = []
    for k in range(FRAGMENTS):
        own = np.flatnonzero(part == k)
        lengths = [len(grams[i]) for i in own]
        flat = np.concatenate([grams[i] for i in own]) if len(own) else np.empty(0, np.uint64)
        parts.append((np.repeat(which[own], lengths), flat))
    return sids, component[first], n[first], parts


def partial_overlaps(left: tuple, right: tuple, shape: tuple[int, int]) -> np.ndarray:
    """How many n-grams of one fragment each set on the left has in common with each on the right."""
    common = np.zeros(shape, np.int64)
    both = np.intersect1d(left[1], right[1])
    for start in range(0, len(both), COLUMNS):
        part = both[start : start + COLUMNS]
        sides = []
        for (own, grams), rows in ((left, shape[0]), (right, shape[1])):
            at = np.minimum(np.searchsorted(part, grams), len(part) - 1)
            hit = part[at] == grams
            marks = np.zeros((rows, len(part)), np.float32)
            marks[own[hit], at[hit]] = 1
            sides.append(marks)
        common += (sides[0] @ sides[1].T).astype(np.int64)
    return common


def joining_links(left: tuple, right: tuple) -> Iterator[tuple[int, int]]:
    """Links between two blocks that join components not yet joined here."""
    shape = len(left[0]), len(right[0])
    common = sum(partial_overlaps(a, b, shape) for a, b in zip(left[3], right[3], strict=True))
    linked = 100 * common >= PERCENT * (left[2][:, None] + right[2][None, :] - common)
    linked &= left[1][:, None] != right[1][None, :]
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    for i, j in zip(*(x.tolist() for x in np.nonzero(linked)), strict=True):
        x, y = root(int(left[1][i])), root(int(right[1][j]))
        if x != y:
            parent[x] = y
            yield int(left[0][i]), int(right[0][j])


def joined(docs: DataFrame) -> DataFrame:
    """`doc_id, n_shingles, component_id` for every row of `docs`: documents that links reach share an id.

    Two documents link when their sets of distinct `WORDS`-word shingles have a Jaccard similarity of `PERCENT` % or
    more; a text with fewer words is one shingle, and a null or empty text, or one without words, links with nothing. Texts
    are used whole, however long. Rows with equal sets are one node, so copies, repeated rows, rows with one id and rows
    without an id need no treatment of their own. `component_id` is the smallest id in the component (null if none of
    its rows has one), or the row's own id if its set is empty. An empty table gives no rows; other columns play no part.

    Every set's n-grams have one global order, cut into `FRAGMENTS` parts by their first hash bits and sorted by
    frequency within a part. Two sets that link share one of the first n-grams of both; sets meet by those, their
    overlaps are counted in each fragment on its own and summed for the pair. In cells of many sets every set first
    meets the cell's hub; what is still apart is compared in blocks, again fragment by fragment.
    """
    marked = stored(marked_rows(docs))
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    sets = marked.filter(F.col("n_shingles") > 0).groupBy("set_key").agg(
        F.first("n_shingles").alias("n_shingles"), F.min(place).alias("low"), F.first("grams").alias("grams"),
        F.first("spread").alias("spread"),
    )
    sets = stored(sets.withColumn("sid", F.monotonically_increasing_id()))
    rows = celled(prefixes(sets))
    pairs = stored(candidate_pairs(rows))
    ends = pairs.select(F.col("a").alias("sid")).union(pairs.select("b"))
    links = stored(confirmed(pairs, fragments_of(ends, sets, docs)))
    names = components(links)
    more = links_of_large_cells(rows, names, sets, docs)
    more = None if more is None else stored(more)
    if more is not None:
        # Only what the blocks add is joined anew, as links between the components so far.
        named = names.toDF("end", "name")
        renamed = more.join(named.toDF("a", "x"), "a", "left").join(named.toDF("b", "y"), "b", "left")
        moves = components(renamed.select(F.coalesce("x", "a").alias("a"), F.coalesce("y", "b").alias("b")))
        every = names.union(more.select("a", "a").union(more.select("b", "b")).distinct().toDF("node", "component"))
        every = every.groupBy("node").agg(F.min_by("component", F.col("component") == F.col("node")).alias("component"))
        moved = every.join(moves.toDF("component", "new"), "component", "left")
        names = moved.select("node", F.coalesce("new", "component").alias("component"))
    named = sets.select("sid", "set_key", F.col("low.doc_id").alias("doc_id")).join(
        names.toDF("sid", "component"), "sid", "left"
    )
    named = stored(named.withColumn("component", F.coalesce("component", "sid")))
    lowest = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    labels = named.join(lowest, "component").select("set_key", "component_id")
    found = marked.select("doc_id", "n_shingles", "set_key").join(labels, "set_key", "left")
    component = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id"))

"""Hard negatives: candidates in blocks along a Hilbert curve, whose zone maps tell which blocks an anchor must read."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from callsieve.llm.shared import stored
from callsieve.shipping import ship_package

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
LOWEST, HIGHEST = 30, 90  # per cent of the positive's score
BITS = 4  # of each component in a row's place on the curve
BLOCK = 256  # rows
SHELF = 64  # blocks that a task reads for one section of anchors after the other
MAPS = 1024  # zone maps that one task reads for one section of anchors
SECTION = 1024  # anchors
CHUNK = 64  # anchors at a time in a task
# Scores under this are exact in doubles, and so are the bounds of their windows.
LARGEST_SCORE = 1 << 49

ROWS = "row long, vec_id long, label long, anchor boolean, place binary, cells binary"
BLOCKS = "block long, label long, anchors int, rows binary, ids binary, asked binary, cells binary, low binary, high binary"


def curve_places(points: np.ndarray, bits: int) -> np.ndarray:
    """Each point's place on the Hilbert curve, as bytes that sort as the places do.

    Points have integer coordinates of `bits` bits. Per level, from the highest bit: a cube whose bit is set in a
    dimension turns the lower bits of the first dimension over, otherwise those of the two dimensions change places
    (Skilling, "Programming the Hilbert curve", 2004).
    """
    n, width = points.shape
    axes = np.ascontiguousarray(points.T).astype(np.uint32)
    for level in range(bits - 1, 0, -1):
        bit, lower = np.uint32(1 << level), np.uint32((1 << level) - 1)
        for axis in axes:
            inside = (axis & bit) != 0
            change = np.where(inside, np.uint32(0), (axes[0] ^ axis) & lower)
            axes[0] ^= np.where(inside, lower, change)
            axis ^= change
    np.bitwise_xor.accumulate(axes, axis=0, out=axes)
    turned = np.zeros(n, np.uint32)
    for level in range(bits - 1, 0, -1):
        turned ^= np.where(axes[-1] & np.uint32(1 << level), np.uint32((1 << level) - 1), np.uint32(0))
    axes ^= turned
    planes = [(axes >> np.uint32(level)) & np.uint32(1) for level in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes).T.astype(np.uint8), axis=1)


def usable_rows(vectors: DataFrame, id_column: str, label: str, vector: str) -> DataFrame:
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.col(label).cast("long").alias("label"),
        F.col(vector).cast("array<double>").alias("vector"),
    )
    return rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & finite)


def integer_rows(rows: DataFrame, is_anchor: Column, scale: int) -> tuple[DataFrame, int]:
    """`ROWS` of all usable rows, stored: integer components as bytes, places on the curve; and their width."""
    ship_package(rows.sparkSession)
    found = rows.agg(F.max(F.size("vector")), F.min(F.array_min("vector")), F.max(F.array_max("vector"))).first()
    width, low, high = max(found[0] or 0, 1), np.floor(scale * (found[1] or 0.0)), np.floor(scale * (found[2] or 0.0))
    low, high = min(low, 0.0), max(high, 0.0)
    if width * max(abs(low), abs(high)) ** 2 >= LARGEST_SCORE:
        raise ValueError(f"inner products of components times {scale} must stay under {LARGEST_SCORE}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                own = part.column(4)
                lengths = own.value_lengths().to_numpy()
                raw = np.zeros((len(own), width))
                raw[np.arange(width) < lengths[:, None]] = own.flatten().to_numpy(zero_copy_only=False)
                cells = np.floor(scale * raw).astype(np.int32)
                points = ((cells - int(low)).astype(np.int64) << BITS) // (int(high) - int(low) + 1)
                columns = [pa.array([x.tobytes() for x in m], pa.binary()) for m in (curve_places(points, BITS), cells)]
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in range(4)), *columns], names)

    names = [f.split()[0] for f in ROWS.split(", ")]
    anchor = F.coalesce(is_anchor, F.lit(False)).alias("anchor")
    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", anchor, "vector")
    return stored(numbered.mapInArrow(run, ROWS)), width


def curve_blocks(rows: DataFrame, width: int) -> DataFrame:
    """`BLOCKS`: up to `BLOCK` rows of one label, along the curve, with the least and largest of each component; stored.

    Rows are dealt out in ranges, down to single rows, so a frequent label, vector or id spreads over tasks.
    """
    order = ["label", "place", "vec_id", "row"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, rest = TaskContext.get().partitionId() << 33, None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            label = table["label"].to_numpy()
            ends = np.flatnonzero(np.diff(label)) + 1
            cuts = [0]
            for end in [*ends.tolist(), len(label)]:
                cuts += range(cuts[-1] + BLOCK, end, BLOCK)
                cuts.append(end)
            done = [block(table.slice(a, b - a), made + k) for k, (a, b) in enumerate(zip(cuts[:-2], cuts[1:-1], strict=True))]
            made += len(done)
            rest = table.slice(cuts[-2])
            if done:
                yield pa.RecordBatch.from_pylist(done, arrow_schema)
        if rest is not None and rest.num_rows:
            yield pa.RecordBatch.from_pylist([block(rest, made)], arrow_schema)

    def block(table: pa.Table, number: int) -> dict:
        joined = b"".join(table["cells"].to_pylist())
        cells = np.frombuffer(joined, np.int32).reshape(-1, width)
        asked = table["anchor"].to_numpy()
        return {
            "block": number,
            "label": table["label"][0].as_py(),
            "anchors": int(asked.sum()),
            "rows": table["row"].to_numpy().tobytes(),
            "ids": table["vec_id"].to_numpy().tobytes(),
            "asked": asked.tobytes(),
            "cells": joined,
            "low": cells.min(axis=0).tobytes(),
            "high": cells.max(axis=0).tobytes(),
        }

    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    arrow_schema = pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in BLOCKS.split(", ")])
    return stored(ranged.mapInArrow(run, BLOCKS))


class Shelf:
    """Blocks side by side, as a task reads them."""

    def __init__(self, blocks: list[dict], width: int):
        self.label = np.array([b["label"] for b in blocks])
        self.low, self.high = (
            np.frombuffer(b"".join(b[k] for b in blocks), np.int32).reshape(-1, width).astype(np.float64) for k in ("low", "high")
        )
        if "cells" in blocks[0]:
            self.sizes = [len(b["rows"]) // 8 for b in blocks]
            self.rows, self.ids = (np.frombuffer(b"".join(b[k] for b in blocks), np.int64) for k in ("rows", "ids"))
            self.cells = np.frombuffer(b"".join(b["cells"] for b in blocks), np.int32).reshape(-1, width).astype(np.float64)
            self.labels = np.repeat(self.label, self.sizes)
            self.turn = np.empty(len(self.ids), np.int64)
            self.turn[np.lexsort((self.rows, self.ids))] = np.arange(len(self.ids))
            self.block = np.repeat(np.arange(len(blocks)), self.sizes)


class Anchors:
    """Some anchors of a section: their rows, and for each the score windows in which candidates count."""

    def __init__(self, anchors: list[dict], width: int, same_label: bool):
        self.row = np.array([a["row"] for a in anchors], np.int64)
        self.label = np.array([a["label"] for a in anchors], np.int64)
        self.cells = np.frombuffer(b"".join(a["cells"] for a in anchors), np.int32).reshape(-1, width).astype(np.float64)
        windows = max((len(a["least"]) for a in anchors), default=0)
        self.least, self.most = np.full((len(anchors), windows), LARGEST_SCORE), np.full((len(anchors), windows), -LARGEST_SCORE)
        for i, a in enumerate(anchors):
            self.least[i, : len(a["least"])], self.most[i, : len(a["most"])] = a["least"], a["most"]
        self.same_label = same_label

    def fits(self, label: np.ndarray) -> np.ndarray:
        return (self.label[:, None] == label[None, :]) == self.same_label

    def must_read(self, shelf: Shelf) -> np.ndarray:
        """Which anchor must read which block: the interval of its scores there, from the zone map, meets a window."""
        plus, minus = np.maximum(self.cells, 0), np.minimum(self.cells, 0)
        highest = plus @ shelf.high.T + minus @ shelf.low.T
        lowest = plus @ shelf.low.T + minus @ shelf.high.T
        met = np.zeros(highest.shape, bool)
        for least, most in zip(self.least.T, self.most.T, strict=True):
            met |= (highest >= least[:, None]) & (lowest <= most[:, None])
        return met & self.fits(shelf.label)

    def best(self, shelf: Shelf, k: int) -> Iterator[tuple]:
        """`anchor, window, vec_id, row, score` of the k best candidates in each window; ties go to the smaller id."""
        read = self.must_read(shelf).any(axis=0)
        at = np.flatnonzero(read[shelf.block])
        if not len(at):
            return
        scores = self.cells @ shelf.cells[at].T
        fits = self.fits(shelf.labels[at]) & (self.row[:, None] != shelf.rows[at][None, :])
        fits &= (scores >= self.least.min(axis=1)[:, None]) & (scores <= self.most.max(axis=1)[:, None])
        anchor, column = np.nonzero(fits)
        score = scores[anchor, column].astype(np.int64)
        order = np.lexsort((shelf.turn[at][column], -score, anchor))
        anchor, score, candidate = anchor[order], score[order], at[column[order]]
        for w, (least, most) in enumerate(zip(self.least.T, self.most.T, strict=True)):
            inside = np.flatnonzero((score >= least[anchor]) & (score <= most[anchor]))
            own = anchor[inside]
            top = inside[np.arange(len(own)) - np.searchsorted(own, own) < k]
            found = candidate[top]
            yield self.row[anchor[top]], np.full(len(top), w), shelf.ids[found], shelf.rows[found], score[top]


def chunks(anchors: list[dict], width: int, same_label: bool) -> Iterator[Anchors]:
    for start in range(0, len(anchors), CHUNK):
        yield Anchors(anchors[start : start + CHUNK], width, same_label)


def found_in_blocks(
    sections: DataFrame, blocks: DataFrame, shelves: int, width: int, same_label: bool, k: int
) -> DataFrame:
    """`anchor, window, vec_id, row, score`: the k best candidates of each window in every shelf that has any.

    Zone maps alone meet all sections of anchors first, about `MAPS` at a time. Then every shelf meets the sections that
    call for any of its blocks, and gives them these and no other. Nothing here is broadcast: Spark goes by the size of
    files, which are packed and hold long lists, and what it takes for small would go through the driver whole.
    """
    together = max(1, MAPS // SHELF)
    shelf = F.pmod(F.xxhash64("block"), F.lit(shelves)).cast("int").alias("shelf")
    maps = blocks.select(F.struct("block", shelf, "label", "low", "high").alias("map"))
    maps = maps.groupBy(F.floor(F.col("map.shelf") / together).cast("int").alias("atlas")).agg(F.collect_list("map").alias("maps"))
    atlas = F.explode(F.sequence(F.lit(0), F.lit((shelves - 1) // together))).alias("atlas")
    asked = sections.select("section", "anchors", atlas)

    def called_for(row: dict) -> Iterator[tuple]:
        held = Shelf(row["maps"], width)
        read = np.zeros(len(held.label), bool)
        for own in chunks(row["anchors"], width, same_label):
            read |= own.must_read(held).any(axis=0)
        needed = {}
        for i in np.flatnonzero(read).tolist():
            needed.setdefault(row["maps"][i]["shelf"], []).append(row["maps"][i]["block"])
        for number, own in needed.items():
            yield row["section"], number, own

    kinds = (pa.int32(), pa.int32(), pa.list_(pa.int64()))
    needed = by_row(asked.join(maps.hint("merge"), "atlas"), called_for, "section int, shelf int, needed array<long>", kinds)
    calling = needed.join(sections.hint("merge"), "section").repartition(shelves, "shelf")
    held = blocks.select(shelf, F.struct("block", "label", "rows", "ids", "cells", "low", "high").alias("own"))
    held = held.repartition(shelves, "shelf").groupBy("shelf").agg(F.collect_list("own").alias("blocks"))
    called = F.filter("blocks", lambda block: F.array_contains("needed", block["block"])).alias("blocks")
    parts = calling.join(held.hint("merge"), "shelf").select("anchors", called)

    def best(row: dict) -> Iterator[tuple]:
        held = Shelf(row["blocks"], width)
        for own in chunks(row["anchors"], width, same_label):
            for columns in own.best(held, k):
                yield from zip(*(c.tolist() for c in columns), strict=True)

    schema = "anchor long, window int, vec_id long, row long, score long"
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
    return by_row(parts, best, schema, kinds)


def by_row(df: DataFrame, function: Callable[[dict], Iterator[tuple]], schema: str, kinds: tuple) -> DataFrame:
    """What `function` yields for each row, which holds a bounded piece of work."""
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                made = list(function(batch.slice(i, 1).to_pylist()[0]))
                columns = zip(*made, strict=True) if made else [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    return df.mapInArrow(run, schema)


def anchors_of(blocks: DataFrame, width: int) -> DataFrame:
    """`row, vec_id, label, cells, least` of all anchors, stored.

    `least` is the score of the last of the best `POSITIVES` in the anchor's own block, which no positive is under; null
    if the block is too small.
    """

    def own_block(row: dict) -> Iterator[tuple]:
        rows, ids = (np.frombuffer(row[k], np.int64) for k in ("rows", "ids"))
        cells = np.frombuffer(row["cells"], np.int32).reshape(-1, width)
        for i in np.flatnonzero(np.frombuffer(row["asked"], bool)).tolist():
            scores = np.delete(cells.astype(np.float64) @ cells[i], i)
            least = int(np.partition(scores, -POSITIVES)[-POSITIVES]) if len(scores) >= POSITIVES else None
            yield int(rows[i]), int(ids[i]), row["label"], cells[i].tobytes(), least

    schema = "row long, vec_id long, label long, cells binary, least long"
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64())
    return stored(by_row(blocks.filter(F.col("anchors") > 0), own_block, schema, kinds))


def sectioned(anchors: DataFrame, sections: int) -> DataFrame:
    """Anchors in sections of about `SECTION`, one row each, stored."""
    section = F.pmod(F.xxhash64("row"), F.lit(sections)).cast("int").alias("section")
    given = F.struct("row", "label", "cells", "least", "most")
    return stored(anchors.groupBy(section).agg(F.collect_list(given).alias("anchors")))


def first_of(found: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mined(
    vectors: DataFrame,
    is_anchor: Column,
    id_column: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
    scale: int = SCALE,
) -> DataFrame:
    """`anchor_id, positive_id, rank, negative_id, positive_score, negative_score` of every anchor.

    `is_anchor` is a condition on `vec_id` (and `label`). A component x counts as floor(scale * x), and a score is an integer inner
    product. An anchor's positives are the `POSITIVES` other rows of its label with the highest scores; for each of
    them, of the rows of other labels that score `LOWEST` to `HIGHEST` % of what the positive scores, the `NEGATIVES` highest come
    back. Ties go to the smaller id.

    Rows with a null id, label or vector, or with null or non-finite components, take no part. Where vectors
    differ in length, missing components count as 0. A repeated row counts each time, as anchor, positive and
    negative. A positive that scores below 0 has no negatives, and an anchor without positives no rows; an empty table
    gives none. Vectors so long or large that scores reach `LARGEST_SCORE` are an error. Other columns play no part.
    """
    rows, width = integer_rows(usable_rows(vectors, id_column, label, vector), is_anchor, scale)
    blocks = curve_blocks(rows, width)
    shelves = max(1, -(-blocks.count() // SHELF))
    anchors = anchors_of(blocks, width)
    sections = max(1, -(-anchors.count() // SECTION))
    least = F.array(F.coalesce("least", F.lit(-LARGEST_SCORE))).alias("least")
    own = anchors.select("row", "label", "cells", least, F.array(F.lit(LARGEST_SCORE)).alias("most"))
    positives = found_in_blocks(sectioned(own, sections), blocks, shelves, width, True, POSITIVES)
    positives = first_of(positives, ["anchor"], POSITIVES).select(
        "anchor", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    positives = stored(positives)

    scores = positives.groupBy("anchor").agg(F.array_sort(F.collect_set("positive_score")).alias("scores"))
    asked = anchors.join(scores.withColumnRenamed("anchor", "row").hint("merge"), "row").select(
        "row", "label", "cells", "scores",
        F.expr(f"transform(scores, p -> -((-p * {LOWEST} - pmod(-p * {LOWEST}, 100L)) div 100))").alias("least"),
        F.expr(f"transform(scores, p -> (p * {HIGHEST} - pmod(p * {HIGHEST}, 100L)) div 100)").alias("most"),
    )
    asked = stored(asked)
    negatives = found_in_blocks(sectioned(asked, sections), blocks, shelves, width, False, NEGATIVES)
    negatives = first_of(negatives, ["anchor", "window"], NEGATIVES)
    windows = asked.select(F.col("row").alias("anchor"), F.posexplode("scores").alias("window", "positive_score"))
    named = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return (
        negatives.join(windows.hint("merge"), ["anchor", "window"])
        .join(positives.hint("merge"), ["anchor", "positive_score"])
        .join(named.hint("merge"), "anchor")
        .select(
            "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score"),
        )
    )

"""Removing passages that an earlier document holds, found as maximal repeats of enhanced suffix arrays.

A suffix array over all bytes of a corpus would have to pass every suffix through a shuffle. Here each
string of LENGTH bytes has an anchor, the GRAM bytes in it whose hash is smallest, so equal strings have
equal anchors. Only anchors found in several documents matter, and around such an anchor only the
bytes that a string of LENGTH with it can reach: its context. Contexts with the same anchor meet in one
task, which builds the suffix array of their suffixes and scans its common-prefix intervals.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from callsieve.llm.shared import broadcast_if_small, stored
from callsieve.llm.words import prefix_hashes, range_hashes, text_slices
from callsieve.shipping import ship_package

LENGTH = 50
GRAM = 26
REACH = LENGTH - GRAM  # bytes beside the anchor that a string can start before it
BLOCK_BYTES = 6 << 20
BYTES_PER_PART = 16 << 20
BLOCKS_PER_TASK = 4
CHUNK = 1 << 19
SUFFIXES_AT_ONCE = 100_000
WIDTH = 80  # a suffix of a context, in whole 8-byte words
UNKNOWN = 256  # the byte before a suffix that starts its context
ALL = np.uint32((1 << (REACH + 1)) - 1)

BLOCKS = "block long, ids array<long>, sizes array<int>, data binary"
ANCHORS = "part int, block long, once binary, many binary"
MASKS = "block long, part int, mask binary"
CONTEXTS = "part int, block long, grams binary, hashes binary, first binary, left binary, sizes binary, data binary"
FOUND = "block long, part int, bits binary"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, starts array<long>, ends array<long>, kept_sha256 string"


@dataclass
class Block:
    """The documents of a block, and all anchors in it, in order."""

    ids: np.ndarray
    bounds: np.ndarray
    data: np.ndarray
    at: np.ndarray  # where an anchor starts
    doc: np.ndarray
    grams: np.ndarray  # hash of its bytes
    low: np.ndarray  # first and last start of the strings whose anchor it is
    high: np.ndarray
    hashes: np.ndarray  # of its context
    start: np.ndarray  # of its context
    end: np.ndarray


def unpack(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = batch.column("ids")[i].values.to_numpy()
    sizes = batch.column("sizes")[i].values.to_numpy()
    data = zstandard.ZstdDecompressor().decompress(batch.column("data")[i].as_py())
    return ids, np.append(0, np.cumsum(sizes, dtype=np.int64)), np.frombuffer(data, np.uint8)


def anchors_of(sums: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The starts of all strings of LENGTH bytes inside a text, and the anchor of each: of equal hashes the last."""
    starts, anchors = [], []
    place = np.uint64((1 << 20) - 1)
    for first in range(0, len(sums) - LENGTH, CHUNK):
        at = np.arange(first, min(first + CHUNK + REACH, len(sums) - GRAM))
        least = (range_hashes(sums, at, at + GRAM) & ~place) | (place - (at - first).astype(np.uint64))
        size = 1
        while 2 * size <= REACH + 1:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if size <= REACH:
            rest = REACH + 1 - size
            least = np.minimum(least[:-rest], least[rest:])
        start = at[: len(least)]
        inside = start + LENGTH <= bounds[np.searchsorted(bounds, start, "right")]
        starts.append(start[inside])
        anchors.append(first + (place - (least[inside] & place)).astype(np.int64))
    none = np.empty(0, np.int64)
    return np.concatenate(starts or [none]), np.concatenate(anchors or [none])


def read_block(ids: np.ndarray, bounds: np.ndarray, data: np.ndarray) -> Block:
    """All anchors of a block; long blocks are hashed in slices of whole texts."""
    parts = []
    text = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(ids), [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(data)]
    )
    for first, piece, limits in text_slices(text):
        sums = prefix_hashes(piece)
        starts, anchors = anchors_of(sums, limits)
        new = np.flatnonzero(np.append(True, anchors[1:] != anchors[:-1])) if len(anchors) else np.empty(0, np.int64)
        at = anchors[new]
        doc = np.searchsorted(limits, at, "right") - 1
        start, end = np.maximum(at - REACH, limits[doc]), np.minimum(at + LENGTH, limits[doc + 1])
        context = range_hashes(sums, start, end) + (at - start).astype(np.uint64)
        shift = bounds[first]
        last = starts[np.append(new[1:], len(starts)) - 1] if len(new) else starts
        places = (x + shift for x in (at, starts[new], last, start, end))
        parts.append((*places, doc + first, range_hashes(sums, at, at + GRAM), context))
    at, low, high, start, end, doc, grams, context = (np.concatenate(x) for x in zip(*parts, strict=True))
    return Block(ids, bounds, data, at, doc, grams, low, high, context, start, end)


def part_of(grams: np.ndarray, parts: int) -> np.ndarray:
    return ((grams >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)


def short_keys(block: Block, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct short keys of a block's anchors, sorted: part, then 32 bits of the hash. Then whether several
    documents hold it, and for each anchor which key it has."""
    keys = (part_of(block.grams, parts).astype(np.uint64) << np.uint64(32)) | (block.grams & np.uint64(0xFFFFFFFF))
    distinct, which = np.unique(keys, return_inverse=True)
    low, high = np.full(len(distinct), len(block.ids)), np.full(len(distinct), -1)
    np.minimum.at(low, which, block.doc)
    np.maximum.at(high, which, block.doc)
    return distinct, low != high, which


def blocks_of(docs: DataFrame) -> DataFrame:
    """`doc_id, text` rows gathered into compressed blocks, each within one task's rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        ids, texts, size = [], [], 0

        def row() -> pa.RecordBatch:
            data = zstandard.ZstdCompressor(level=3).compress(b"".join(texts))
            values = ((part << 32) + made, list(ids), [len(t) for t in texts], data)
            kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip(values, kinds, strict=True)], ["block", "ids", "sizes", "data"]
            )

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = text.as_py().encode()
                if ids and size + len(data) > BLOCK_BYTES:
                    yield row()
                    made, ids, texts, size = made + 1, [], [], 0
                ids.append(doc_id)
                texts.append(data)
                size += len(data)
        if ids:
            yield row()

    return stored(docs.select("doc_id", "text").mapInArrow(run, BLOCKS))


def shared_anchors(blocks: DataFrame, parts: int) -> DataFrame:
    """For each block and part a bit for each anchor key that one of its documents holds: does another block hold it?

    A block names a key once, so a passage of very many documents is no load. Keys are short; a chance
    match only lets an anchor through that the comparison of contexts then drops.
    """

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                distinct, several, _ = short_keys(read_block(*unpack(batch, i)), parts)
                edges = np.searchsorted(distinct, np.arange(parts + 1, dtype=np.uint64) << np.uint64(32))
                rows = []
                for part, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                    own, many = distinct[a:b].astype("<u4"), several[a:b]
                    if b > a:
                        rows.append((part, batch.column("block")[i].as_py(), own[~many].tobytes(), own[many].tobytes()))
                if rows:
                    kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
                    columns = zip(zip(*rows, strict=True), kinds, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in columns], ["part", "block", "once", "many"])

    def compare(table: pa.Table) -> pa.Table:
        once = [np.frombuffer(x, "<u4") for x in table["once"].to_pylist()]
        many = [np.frombuffer(x, "<u4") for x in table["many"].to_pylist()]
        found, times = np.unique(np.concatenate(once + [np.unique(x) for x in many]), return_counts=True)
        shared = np.union1d(found[times > 1], np.concatenate(many))
        masks = [np.isin(x, shared, assume_unique=True) for x in once]
        rows = [
            (block, part, np.packbits(mask).tobytes())
            for block, part, mask in zip(table["block"].to_pylist(), table["part"].to_pylist(), masks, strict=True)
            if mask.any()
        ]
        columns = zip(*rows, strict=True) if rows else ((), (), ())
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["block", "part", "mask"])

    kinds = (pa.int64(), pa.int32(), pa.binary())
    return stored(blocks.mapInArrow(keys, ANCHORS).groupBy("part").applyInArrow(compare, MASKS))


@dataclass
class Entries:
    """The distinct contexts of a block's shared anchors, sorted by part, anchor and context."""

    part: np.ndarray
    grams: np.ndarray
    hashes: np.ndarray
    first: np.ndarray  # smallest id that has it in this block
    sample: np.ndarray  # an anchor of the block that has it
    anchors: np.ndarray  # the shared anchors, and for each which entry it has
    which: np.ndarray


def entries_of(block: Block, parts: int, masks: list[dict] | None) -> Entries:
    distinct, shared, which = short_keys(block, parts)
    single = ~shared
    edges = np.searchsorted(distinct, np.arange(parts + 1, dtype=np.uint64) << np.uint64(32))
    for row in masks or ():
        once = np.flatnonzero(single[edges[row["part"]] : edges[row["part"] + 1]]) + edges[row["part"]]
        bits = np.unpackbits(np.frombuffer(row["mask"], np.uint8), count=len(once)).astype(bool)
        shared[once[bits]] = True
    anchors = np.flatnonzero(shared[which])
    part = part_of(block.grams[anchors], parts)
    ids = block.ids[block.doc[anchors]]
    order = np.lexsort((ids, block.hashes[anchors], block.grams[anchors], part))
    grams, hashes = block.grams[anchors[order]], block.hashes[anchors[order]]
    new = np.ones(len(order), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (hashes[1:] != hashes[:-1])
    entry = np.empty(len(order), np.int64)
    entry[order] = np.cumsum(new) - 1
    return Entries(part[order][new], grams[new], hashes[new], ids[order][new], anchors[order][new], anchors, entry)


def contexts_of(block: Block, entries: Entries, parts: int, name: int) -> Iterator[tuple]:
    edges = np.searchsorted(entries.part, np.arange(parts + 1))
    for part, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        if b > a:
            own = entries.sample[a:b]
            start, end = block.start[own], block.end[own]
            data = b"".join(block.data[x:y].tobytes() for x, y in zip(start, end, strict=True))
            left = (block.at[own] - start).astype(np.uint8)
            arrays = (entries.grams[a:b], entries.hashes[a:b], entries.first[a:b], left, (end - start).astype(np.uint8))
            yield (part, name, *(x.tobytes() for x in arrays), data)


def intervals(common: np.ndarray, values: np.ndarray, before: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """Maximal repeats of a run of suffixes in order, as `first, end, length, smallest value`.

    `common[i]` is the common prefix of suffixes i-1 and i. A stack holds the open common-prefix intervals;
    one closes where the common prefix gets shorter, after those inside it. It is given out if its suffixes
    do not all have one and the same byte before them: otherwise a longer repeat covers it.
    """
    stack: list[list] = []  # length, first suffix, smallest value, byte before all of them (or UNKNOWN)

    def merged(left: list, value: int, byte: int) -> None:
        left[2] = min(left[2], value)
        left[3] = left[3] if left[3] == byte else UNKNOWN

    for i in range(len(values) + 1):
        length = int(common[i]) if 0 < i < len(values) else 0
        open_first = i - 1
        carried = (int(values[i - 1]), int(before[i - 1])) if i else None
        while stack and stack[-1][0] > length:
            own = stack.pop()
            merged(own, *carried)
            if own[3] == UNKNOWN:
                yield own[1], i, own[0], own[2]
            open_first, carried = own[1], (own[2], own[3])
        if stack and stack[-1][0] == length:
            merged(stack[-1], *carried)
        elif length:
            stack.append([length, open_first, *carried])


def repeated_bits(data: np.ndarray, left: np.ndarray, sizes: np.ndarray, group: np.ndarray, value: np.ndarray) -> np.ndarray:
    """For each context, which of its strings of LENGTH bytes occur in a context of smaller value, by bit.

    Bit o stands for the string that starts o bytes before the anchor. `group` numbers anchors;
    contexts of one anchor stand together.
    """
    n = len(left)
    bits = np.zeros(n, np.uint32)
    table = np.zeros((n, LENGTH + REACH + WIDTH), np.uint8)
    ends = np.cumsum(sizes, dtype=np.int64)
    row = np.repeat(np.arange(n), sizes)
    table[row, np.arange(len(data)) - np.repeat(ends - sizes, sizes)] = data
    views = np.lib.stride_tricks.sliding_window_view(table, WIDTH, axis=1)
    count = np.minimum(left.astype(np.int64), sizes.astype(np.int64) - LENGTH) + 1
    of = np.repeat(np.arange(n), count)
    start = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    words = np.ascontiguousarray(views[of, start]).view(">u8").astype(np.uint64)
    long = sizes[of].astype(np.int64) - start
    order = np.lexsort((long, *words.T[::-1], group[of]))
    of, start, words, long = of[order], start[order], words[order], long[order]

    differ = words[1:] != words[:-1]
    word = np.where(differ.any(axis=1), differ.argmax(axis=1), words.shape[1] - 1)
    rows = np.arange(len(word))
    change = words[1:][rows, word] ^ words[:-1][rows, word]
    same_bytes = sum((change >> np.uint64(8 * k) == 0).astype(np.int64) for k in range(8))
    common = np.zeros(len(of) + 1, np.int64)
    common[1:-1] = np.minimum(8 * word + same_bytes, np.minimum(long[1:], long[:-1]))
    common[1:-1][group[of[1:]] != group[of[:-1]]] = 0

    run = np.cumsum(common[:-1] < LENGTH) - 1
    first = np.flatnonzero(common[:-1] < LENGTH)
    last = np.append(first[1:], len(of))
    before = np.where(start > 0, table[of, np.maximum(start - 1, 0)].astype(np.int64), UNKNOWN)
    values = value[of]
    low, high = np.minimum.reduceat(values, first), np.maximum.reduceat(values, first)
    byte_low, byte_high = np.minimum.reduceat(before, first), np.maximum.reduceat(before, first)
    longest, shortest = np.zeros(len(first), np.int64), np.full(len(first), WIDTH)
    inner = np.flatnonzero(common[:-1] >= LENGTH)
    np.maximum.at(longest, run[inner], common[inner])
    np.minimum.at(shortest, run[inner], common[inner])
    # Runs of one suffix, of one value, or that a longer repeat covers give nothing.
    useful = (low < high) & ((byte_low != byte_high) | (byte_high == UNKNOWN))
    reach = np.zeros(len(of), np.int64)
    flat = useful & (longest == shortest)
    plain = flat[run] & (values > low[run])
    reach[plain] = longest[run[plain]]
    for k in np.flatnonzero(useful & ~flat):
        a, b = first[k], last[k]
        own = reach[a:b]
        for x, y, length, smallest in intervals(common[a:b], values[a:b], before[a:b]):
            np.maximum(own[x:y], np.where(values[a:b][x:y] > smallest, length, 0), out=own[x:y])
    hit = np.flatnonzero(reach)
    nearest = left[of[hit]].astype(np.int64) - np.minimum(left[of[hit]], start[hit] + reach[hit] - LENGTH)
    farthest = left[of[hit]].astype(np.int64) - start[hit]
    np.bitwise_or.at(bits, of[hit], ((1 << (farthest + 1)) - (1 << nearest)).astype(np.uint32))
    return bits


def earlier_strings(blocks: DataFrame, masks: DataFrame, parts: int) -> DataFrame:
    """For each block and part the bits of its entries: which strings around an anchor an earlier document holds."""

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int32(), pa.int64(), *[pa.binary()] * 6)
        names = [f.split()[0] for f in CONTEXTS.split(", ")]
        for batch in batches:
            for i in range(batch.num_rows):
                block = read_block(*unpack(batch, i))
                entries = entries_of(block, parts, batch.column("masks")[i].as_py())
                rows = list(contexts_of(block, entries, parts, batch.column("block")[i].as_py()))
                if rows:
                    columns = zip(zip(*rows, strict=True), kinds, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in columns], names)

    def compare(table: pa.Table) -> pa.Table:
        counts = [len(x) // 8 for x in table["grams"].to_pylist()]
        joined = {
            name: np.frombuffer(b"".join(table[name].to_pylist()), kind)
            for name, kind in (("grams", "<u8"), ("hashes", "<u8"), ("first", "<i8"), ("left", "u1"), ("sizes", "u1"), ("data", "u1"))
        }
        grams, hashes, first, sizes = (joined[x] for x in ("grams", "hashes", "first", "sizes"))
        order = np.lexsort((first, hashes, grams))
        new = np.ones(len(order), bool)
        new[1:] = (grams[order[1:]] != grams[order[:-1]]) | (hashes[order[1:]] != hashes[order[:-1]])
        context = np.empty(len(order), np.int64)
        context[order] = np.cumsum(new) - 1
        sample = order[new]
        smallest = first[sample]
        anchor = np.cumsum(np.append(True, grams[sample[1:]] != grams[sample[:-1]])) - 1
        # An anchor with one context needs no comparison: all its strings are the same.
        mixed = np.flatnonzero(np.bincount(anchor)[anchor] > 1)
        bits = np.zeros(len(sample), np.uint32)
        ends = np.cumsum(sizes, dtype=np.int64)
        done = 0
        while done < len(mixed):
            stop = min(done + SUFFIXES_AT_ONCE // (REACH + 1), len(mixed))
            while stop < len(mixed) and anchor[mixed[stop]] == anchor[mixed[stop - 1]]:
                stop += 1
            own = sample[mixed[done:stop]]
            data = np.concatenate([joined["data"][ends[x] - sizes[x] : ends[x]] for x in own])
            bits[mixed[done:stop]] = repeated_bits(
                data, joined["left"][own], sizes[own], anchor[mixed[done:stop]], smallest[mixed[done:stop]]
            )
            done = stop
        found = np.where(first > smallest[context], ALL, bits[context]).astype("<u4")
        edges = np.append(0, np.cumsum(counts))
        rows = [
            (block, part, found[a:b].tobytes())
            for block, part, a, b in zip(table["block"].to_pylist(), table["part"].to_pylist(), edges[:-1], edges[1:], strict=True)
            if found[a:b].any()
        ]
        columns = zip(*rows, strict=True) if rows else ((), (), ())
        kinds = (pa.int64(), pa.int32(), pa.binary())
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["block", "part", "bits"])

    given = with_lists(blocks, masks, "mask", "masks")
    return stored(given.mapInArrow(contexts, CONTEXTS).groupBy("part").applyInArrow(compare, FOUND))


def with_lists(blocks: DataFrame, rows: DataFrame, value: str, name: str) -> DataFrame:
    """`blocks` with an array of what was found for each part; at most one element per part."""
    lists = rows.groupBy("block").agg(F.collect_list(F.struct("part", value)).alias(name))
    return blocks.join(lists, "block", "left")


def removed_in(block: Block, entries: Entries, parts: int, found: list[dict] | None) -> np.ndarray:
    """For each byte of the block whether it goes."""
    bits = np.zeros(len(entries.first), np.uint32)
    edges = np.searchsorted(entries.part, np.arange(parts + 1))
    for row in found or ():
        bits[edges[row["part"]] : edges[row["part"] + 1]] = np.frombuffer(row["bits"], "<u4")
    later = block.ids[block.doc[entries.anchors]] > entries.first[entries.which]
    own = np.where(later, ALL, bits[entries.which])
    change = np.zeros(len(block.data) + 1, np.int32)
    whole = entries.anchors[own == ALL]
    np.add.at(change, block.low[whole], 1)
    np.add.at(change, block.high[whole] + LENGTH, -1)
    some = (own != 0) & (own != ALL)
    anchors, own = entries.anchors[some], own[some]
    for o in range(REACH + 1):
        start = block.at[anchors] - o
        hit = start[(own >> np.uint32(o) & 1 == 1) & (start >= block.low[anchors]) & (start <= block.high[anchors])]
        np.add.at(change, hit, 1)
        np.add.at(change, hit + LENGTH, -1)
    return np.cumsum(change[:-1]) > 0


def cut_blocks(blocks: DataFrame, masks: DataFrame, found: DataFrame, parts: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (*[pa.int64()] * 4, pa.list_(pa.int64()), pa.list_(pa.int64()), pa.string())
        names = [f.split()[0] for f in RESULT.split(", ")]
        for batch in batches:
            for i in range(batch.num_rows):
                block = read_block(*unpack(batch, i))
                entries = entries_of(block, parts, batch.column("masks")[i].as_py())
                gone = removed_in(block, entries, parts, batch.column("found")[i].as_py())
                rows = []
                for doc_id, a, b in zip(block.ids, block.bounds[:-1], block.bounds[1:], strict=True):
                    own = gone[a:b]
                    edge = np.flatnonzero(np.diff(own, prepend=False, append=False))
                    starts, ends = edge[::2], edge[1::2]
                    digest = hashlib.sha256(block.data[a:b][~own]).hexdigest()
                    rows.append((int(doc_id), b - a, int((ends - starts).sum()), len(starts), starts, ends, digest))
                columns = zip(zip(*rows, strict=True), kinds, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in columns], names)

    given = with_lists(with_lists(blocks, masks, "mask", "masks"), found, "bits", "found")
    return given.mapInArrow(run, RESULT)


def without_repeats(docs: DataFrame) -> DataFrame:
    """`doc_id, n_bytes, n_removed, n_spans, starts, ends, kept_sha256` for every row of `docs`.

    Every byte goes that lies in a string of LENGTH bytes which also starts in a document with a smaller
    id; matches never cross documents and are judged on the texts as given. `starts` and `ends` are the
    removed runs in bytes. A null text is empty. A row without an id keeps all its bytes and takes
    none from others. Rows with one id do not take from each other. A whole text that a smaller id
    also has goes without a search, so copies load no task.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = F.octet_length("text").cast("long")
    keys = rows.filter(F.col("doc_id").isNotNull() & (size >= LENGTH)).groupBy(F.md5("text").alias("copy_of"))
    copies = stored(keys.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("top")).filter("low < top").drop("top"))
    marked = rows.join(broadcast_if_small(copies), F.md5("text") == F.col("copy_of"), "left")
    whole = (size >= LENGTH) & F.col("doc_id").isNotNull() & F.coalesce(F.col("low") < F.col("doc_id"), F.lit(False))
    searched = (size >= LENGTH) & F.col("doc_id").isNotNull() & ~whole

    blocks = blocks_of(marked.filter(searched))
    seen = blocks.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda total, x: total + x)).alias("bytes"),
    ).first()
    parts = max(32, -(-(seen["bytes"] or 0) // BYTES_PER_PART))
    dealt = blocks.repartition(max(1, -(-seen["n"] // BLOCKS_PER_TASK)), "block")
    masks = shared_anchors(blocks, parts)
    found = earlier_strings(dealt, masks, parts)
    none = F.array().cast("array<long>")
    simple = marked.filter(~searched).select(
        "doc_id",
        size.alias("n_bytes"),
        F.when(whole, size).otherwise(F.lit(0)).cast("long").alias("n_removed"),
        F.when(whole, 1).otherwise(0).cast("long").alias("n_spans"),
        F.when(whole, F.array(F.lit(0).cast("long"))).otherwise(none).alias("starts"),
        F.when(whole, F.array(size)).otherwise(none).alias("ends"),
        F.sha2(F.when(whole, F.lit("")).otherwise(F.col("text")), 256).alias("kept_sha256"),
    )
    return cut_blocks(dealt, masks, found, parts).unionByName(simple)

"""Token ids in training order: a keyed permutation gives every sequence a slot, shards hold slots."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from callsieve.llm.packing import OUT_BYTES
from callsieve.llm.shared import broadcast_if_small, first_numbers, stored
from callsieve.llm.tokens import VOCABULARY, token_ids
from callsieve.shipping import ship_package

STRIDE = 1024
SLOTS_PER_SHARD = 512
ROUNDS = 6
PAD = 0
ID_TYPE = "<u2" if VOCABULARY <= 1 << 16 else "<u4"

SEQUENCES = "doc_id long, start long, length int, ids binary, part int, place long"
SHARDS = (
    "shard long, first_slot long, slots int, stride_bytes int, doc_ids array<long>, starts array<long>, "
    "lengths array<int>, payload binary"
)
SLOTS = "slot long, shard long, byte_offset long, doc_id long, start long, length int, ids binary"


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permuted(values: np.ndarray, size: int, key: int, inverse: bool = False) -> np.ndarray:
    """A permutation of 0 .. size-1 that depends on `key`, or its inverse.

    A Feistel network permutes the smallest even-bit domain that holds `size`. A value that lands beyond
    `size` goes through again until it is inside, which keeps the whole a permutation. The domain is
    under four times `size`, so that takes under four passes on average.
    """
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    shift, mask = np.uint64(half), np.uint64((1 << half) - 1)
    keys = mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ np.uint64(key % (1 << 64)))

    def network(x: np.ndarray) -> np.ndarray:
        left, right = x >> shift, x & mask
        if inverse:
            for k in keys[::-1]:
                left, right = right ^ (mix(left + k) & mask), left
        else:
            for k in keys:
                left, right = right, left ^ (mix(right + k) & mask)
        return left << shift | right

    out = network(values.astype(np.uint64))
    while (outside := out >= np.uint64(size)).any():
        out[outside] = network(out[outside])
    return out.astype(np.int64)


def sequences(docs: DataFrame, stride: int = STRIDE, tokenizer: str | None = None) -> DataFrame:
    """Every document's ids cut at each `stride`: `doc_id, start, length, ids`, and where each was made.

    The last sequence of a document may be short; a null or empty text has none. No sequence holds
    two documents. Equal rows, and rows whose id is null, are documents of their own.
    """
    ship_package(docs.sparkSession)
    names = [f.split()[0] for f in SEQUENCES.split(", ")]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place = TaskContext.get().partitionId(), 0
        rows, size = [], 0
        for given in batches:
            for doc_id, text in zip(given.column(0).to_pylist(), given.column(1), strict=True):
                ids = token_ids(text.as_py(), tokenizer).astype(ID_TYPE)
                for start in range(0, len(ids), stride):
                    piece = ids[start : start + stride]
                    rows.append((doc_id, start, len(piece), piece.tobytes(), part, place))
                    place += 1
                    size += piece.nbytes
                if size > OUT_BYTES:
                    columns = zip(zip(*rows), types, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names)
                    rows, size = [], 0
        if rows:
            columns = zip(zip(*rows), types, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SEQUENCES)


def slotted(table: DataFrame, key: int) -> DataFrame:
    """A stored table of sequences with `slot`, the place of each in the training order.

    A sequence's number is its place in its task's part of the stored table after all earlier parts; the
    counts per part are all that is shuffled for it. The slot is the keyed permutation of that number.
    """
    total = table.count()
    counts = table.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    firsts = first_numbers(counts.withColumn("length", F.lit(0))).select("part", "first")

    @F.pandas_udf(T.LongType())
    def slot(numbers: pd.Series) -> pd.Series:
        return pd.Series(permuted(numbers.to_numpy(), total, key))

    numbered = table.join(broadcast_if_small(firsts), "part")
    return numbered.withColumn("slot", slot(F.col("first") + F.col("place"))).drop("part", "place", "first")


def shards(placed: DataFrame, stride: int = STRIDE, per_shard: int = SLOTS_PER_SHARD) -> DataFrame:
    """One row per shard: `per_shard` slots in order, each `stride` ids wide, padded with id 0.

    Slot s is at byte (s mod per_shard) * stride_bytes of the payload of shard s div per_shard, so a reader
    can start anywhere. Shards are range-partitioned, so a task holds neighbouring ones; it has
    one in memory at a time.
    """
    width = stride * np.dtype(ID_TYPE).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in SHARDS.split(", ")]
        types = [
            pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()),
            pa.list_(pa.int32()), pa.binary(),
        ]

        def made(shard: int, rows: list[tuple]) -> pa.RecordBatch:
            payload = b"".join(ids.ljust(width, bytes([PAD])) for *_, ids in rows)
            docs, starts, lengths = (list(x) for x in list(zip(*rows, strict=True))[:3])
            values = (shard, shard * per_shard, len(rows), width, docs, starts, lengths, payload)
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names)

        now, rows = None, []
        for batch in batches:
            for shard, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if shard != now and rows:
                    yield made(now, rows)
                    rows = []
                now = shard
                rows.append(tuple(row))
        if rows:
            yield made(now, rows)

    ordered = placed.withColumn("shard", F.floor(F.col("slot") / per_shard))
    ordered = ordered.repartitionByRange("shard").sortWithinPartitions("shard", "slot")
    return ordered.select("shard", "doc_id", "start", "length", "ids").mapInArrow(run, SHARDS)


def training_shards(docs: DataFrame, key: int, stride: int = STRIDE, per_shard: int = SLOTS_PER_SHARD) -> DataFrame:
    """The stored table of shards for `docs`, in the order that `key` gives."""
    placed = slotted(stored(sequences(docs, stride)), key)
    return stored(shards(placed, stride, per_shard))


def read_slots(table: DataFrame, first_slot: int = 0) -> DataFrame:
    """The sequences of a table of shards from `first_slot` on: where each lies, and its ids without padding."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in SLOTS.split(", ")]
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                at = range(max(0, first_slot - row["first_slot"]), row["slots"])
                wide, size = row["stride_bytes"], np.dtype(ID_TYPE).itemsize
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["first_slot"] + i for i in at], pa.int64()),
                        pa.array([row["shard"] for _ in at], pa.int64()),
                        pa.array([i * wide for i in at], pa.int64()),
                        pa.array([row["doc_ids"][i] for i in at], pa.int64()),
                        pa.array([row["starts"][i] for i in at], pa.int64()),
                        pa.array([row["lengths"][i] for i in at], pa.int32()),
                        pa.array([row["payload"][i * wide : i * wide + size * row["lengths"][i]] for i in at], pa.binary()),
                    ],
                    names,
                )

    rest = table.filter(F.col("first_slot") + F.col("slots") > first_slot)
    return rest.mapInArrow(run, SLOTS)

"""Packing by powers of two: documents cut into binary-length pieces, equal lengths bucketed."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from callsieve.llm.shared import broadcast_if_small, first_numbers, stored
from callsieve.llm.tokens import token_ids
from callsieve.llm.words import give_back_memory
from callsieve.shipping import ship_package

MAX_LENGTH = 1024
END = 0
OUT_BYTES = 8 << 20

PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary, part int, place long"


def piece_lengths(n: int, max_length: int = MAX_LENGTH) -> list[int]:
    """`n` as pieces of `max_length` (a power of two) and then the powers of two of the rest, longest first."""
    whole, rest = divmod(n, max_length)
    return [max_length] * whole + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]


def cut(docs: DataFrame, max_length: int = MAX_LENGTH, tokenizer: str | None = None) -> DataFrame:
    """The pieces of every document: `doc_id, start, length, doc_tokens, ids`, and where each was made.

    A document is the ids of its whole text and then id 0; a null or empty text is that id alone, so
    every row gives at least one piece. `ids` are little-endian unsigned 32-bit integers. `part` is
    the task and `place` counts pieces of this length in it: `packed` numbers sequences by them. Equal
    rows, and rows whose id is null, are documents of their own. Other columns are not used.
    """
    ship_package(docs.sparkSession)
    names = [f.split()[0] for f in PIECES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), Counter()
        rows, size = [], 0

        def batch() -> pa.RecordBatch:
            types = [pa.int64()] * 4 + [pa.binary(), pa.int32(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(zip(*rows), types, strict=True)], names
            )

        for given in batches:
            for doc_id, text in zip(given.column(0).to_pylist(), given.column(1), strict=True):
                ids = np.append(token_ids(text.as_py(), tokenizer), np.uint32(END)).astype("<u4")
                start, data = 0, ids.tobytes()
                for length in piece_lengths(len(ids), max_length):
                    piece = data[4 * start : 4 * (start + length)]
                    rows.append((doc_id, start, length, len(ids), piece, part, seen[length]))
                    seen[length] += 1
                    start += length
                size += len(data)
                if size > OUT_BYTES or len(rows) > 20_000:
                    yield batch()
                    rows, size = [], 0
            give_back_memory()
        if rows:
            yield batch()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


def packed(pieces: DataFrame) -> DataFrame:
    """`pieces` with `sequence_id` and `offset`: every piece is a sequence, numbered bucket by bucket.

    All sequences of the longest length come first, then those of half that length, and so on, so any
    run of ids is a bucket from which batches of equal length can be drawn. As lengths are powers of
    two, nothing is padded, no sequence holds two documents, and offsets are 0. Pieces are stored
    once, with their numbers within task and length; only the counts per task and length are shuffled.
    While those are small enough to broadcast no piece is shuffled, and columns such as `ids` stay with their rows.
    """
    table = stored(pieces)
    firsts = first_numbers(table.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")))
    return (
        table.join(broadcast_if_small(firsts), ["part", "length"])
        .withColumn("sequence_id", F.col("first") + F.col("place"))
        .withColumn("offset", F.lit(0).cast("long"))
        .drop("part", "place", "first")
    )

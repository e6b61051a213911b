"""Bloom filters and count-min sketches as one array of longs that Spark builds and looks up.

Both are computed by an aggregation into a fixed number of slots, whatever the number of rows. The array is the one row
of a DataFrame; expressions get it as a scalar subquery, so it is sent to the executors once per query and looked up
in generated code.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

CHUNK = 1024  # slots gathered together first, so that the array is put together from few rows


def slot_array(slots: DataFrame, size: int) -> DataFrame:
    """One row with the array `slots`: `value` by `slot` 0 to size - 1, and 0 where a slot has no row."""
    chunk = F.col("slot").cast("long") - F.pmod("slot", F.lit(CHUNK))
    entry = F.struct(F.pmod("slot", F.lit(CHUNK)).cast("int").alias("at"), "value")
    chunks = slots.groupBy(chunk.alias("chunk")).agg(F.map_from_entries(F.collect_list(entry)).alias("held"))
    every = slots.sparkSession.range(0, size, CHUNK, max(1, size // CHUNK // 1024)).toDF("chunk")
    places = F.sequence(F.lit(0), F.lit(min(size, CHUNK) - 1))
    filled = F.transform(places, lambda i: F.coalesce(F.try_element_at("held", i), F.lit(0).cast("long")))
    full = every.join(chunks, "chunk", "left").select("chunk", filled.alias("held"))
    ordered = F.array_sort(F.collect_list(F.struct("chunk", "held")))
    return full.agg(F.flatten(F.transform(ordered, lambda c: c["held"])).alias("slots"))


def power_of_two(at_least: int, at_most: int) -> int:
    return min(1 << max(0, (max(1, at_least) - 1).bit_length()), at_most)


@dataclass(frozen=True)
class BloomFilter:
    """Tells values that are surely not among the keys from those that may be."""

    words: DataFrame
    bits: int
    hashes: int

    def may_hold(self, value: Column) -> Column:
        """False only for values that are no key; NULL for NULL."""
        words = self.words.scalar()
        found = F.lit(True)
        for i in range(self.hashes):
            bit = _hash(value, i, self.bits)
            word = F.get(words, F.shiftright(bit, 6).cast("int"))
            found = found & (word.bitwiseAND(_mask(bit)) != 0)
        return F.when(value.isNotNull(), found)


def bloom_filter(keys: DataFrame, key: str, expected: int, bits_per_key: int = 12, max_bits: int = 1 << 27) -> BloomFilter:
    """A filter over the non-NULL values of `key`, sized for `expected` of them.

    With 12 bits and 4 hashes a key about one other value in 200 passes. Beyond `max_bits` (16 MB) it gets
    fuller and lets more values pass, but never drops a key.
    """
    bits, hashes = max(64 * CHUNK, power_of_two(expected * bits_per_key, max_bits)), 4
    value = F.col(key)
    positions = F.explode(F.array(*[_hash(value, i, bits) for i in range(hashes)])).alias("bit")
    set_bits = keys.filter(value.isNotNull()).select(positions)
    words = set_bits.groupBy(F.shiftright("bit", 6).alias("slot")).agg(F.bit_or(_mask(F.col("bit"))).alias("value"))
    return BloomFilter(slot_array(words, bits // 64), bits, hashes)


@dataclass(frozen=True)
class CountMinSketch:
    """Counts by value that are never too low."""

    counts: DataFrame
    width: int
    depth: int

    def at_most(self, value: Column) -> Column:
        """How often a value occurs at most."""
        counts = self.counts.scalar()
        return F.least(*[F.get(counts, _slot(value, i, self.width)) for i in range(self.depth)])


def count_min_sketch(
    rows: DataFrame, column: str, expected: int, error: int, depth: int = 4, max_width: int = 1 << 20
) -> CountMinSketch:
    """Counts of the values of `column` (NULL is one of them), at most about `error` too high for `expected` rows.

    One count is too high by over `error` with probability e^-depth. Beyond `max_width` (32 MB for all rows of
    counters) counts get higher than that, but never too low.
    """
    width = max(CHUNK, power_of_two(-(-3 * expected // max(1, error)), max_width))
    slots = F.explode(F.array(*[_slot(F.col(column), i, width) for i in range(depth)])).alias("slot")
    counts = rows.select(slots).groupBy("slot").agg(F.count(F.lit(1)).alias("value"))
    return CountMinSketch(slot_array(counts, width * depth), width, depth)


def _hash(value: Column, i: int, size: int) -> Column:
    return F.xxhash64(F.lit(i), value).bitwiseAND(F.lit(size - 1).cast("long"))


def _slot(value: Column, i: int, width: int) -> Column:
    return (_hash(value, i, width) + F.lit(i * width)).cast("int")


def _mask(bit: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(F.lit(63).cast("long")).cast("int"))

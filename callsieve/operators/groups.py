"""Groups of bounded size, for operators that must hold a group's rows together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F, types as T

from callsieve.operators.checkpoints import BROADCAST_BYTES, checkpointed, size_in_bytes

PART = "_part"
MAX_ROWS = 100_000
ROWS_PER_TASK = 500_000
RESERVED = (PART, "_large", "_rows", "_row", "_range", "_place", "_before")


def bounded_parts(
    rows: DataFrame,
    key: str,
    order: Sequence[str] | None = None,
    max_rows: int = MAX_ROWS,
    spread: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """All rows as they are, shuffled so that each (key, `_part`) is together and holds `max_rows` at most.

    Parts are slices of a key's rows in `order` (all columns that have an order, if not given): part
    p holds rows p * max_rows to (p + 1) * max_rows - 1. So a key within the bound is part 0. A first
    pass counts rows per key from the key column alone, and only longer keys are sorted and numbered,
    which `numbered_rows` does without bringing a key to one task. Rows that are equal in `order` are told apart
    by where they were read.

    With `spread` the number of partitions follows the rows counted; without it adaptive
    execution merges small partitions.
    """
    if max_rows < 1:
        raise ValueError("max_rows must be at least 1")
    if taken := [c for c in rows.columns if c.lower() in RESERVED]:
        raise ValueError(f"rename the columns {taken}: these names are used while working")
    counts = rows.groupBy(F.col(key).alias("_large")).agg(F.count(F.lit(1)).alias("_rows"))
    large = checkpointed(counts.filter(F.col("_rows") > max_rows).select("_large"))
    fixed = []
    if spread:
        total = rows.count()
        least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        fixed = [max(least, -(-total // ROWS_PER_TASK))]
    size = size_in_bytes(large)
    if size == 0:
        return rows.repartition(*fixed, key).withColumn(PART, F.lit(0))
    if size <= broadcast_bytes:
        large = F.broadcast(large)

    is_large = F.col(key).eqNullSafe(F.col("_large"))
    small_keys = rows.join(large, is_large, "left_anti").withColumn(PART, F.lit(0))
    long = numbered_rows(rows.join(large, is_large, "left_semi"), key, order or _ordered_columns(rows))
    large_keys = long.withColumn(PART, F.floor(F.col("_place") / max_rows).cast("int")).drop("_place")
    return small_keys.unionByName(large_keys).repartition(*fixed, key, PART)


def numbered_rows(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """`rows` with `_place`: each row's number from 0 among its key's rows in `order`.

    Rows are dealt out in ranges of (key, order, where they were read), so a key, or copies of one
    row, spread over as many tasks as they fill. Numbers count within a key's rows of one range,
    and start after those of earlier ranges; such starts exist for at most one key per range.
    """
    read = checkpointed(rows).withColumn("_row", F.monotonically_increasing_id())
    by = [key, *order, "_row"]
    ranged = read.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_range", F.spark_partition_id())
    ranged = checkpointed(ranged)
    counts = ranged.groupBy(key, "_range").agg(F.count(F.lit(1)).alias("_rows"))
    ranges = Window.partitionBy(key).orderBy("_range")
    before = F.sum("_rows").over(ranges.rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.withColumn("_before", before).filter(F.col("_before").isNotNull())
    starts = checkpointed(starts.select(F.col(key).alias("_large"), F.col("_range").alias("_rows"), "_before"))
    inside = F.row_number().over(Window.partitionBy(key, "_range").orderBy(*by[1:])) - 1
    same = F.col(key).eqNullSafe(F.col("_large")) & (F.col("_range") == F.col("_rows"))
    placed = ranged.withColumn("_place", inside).join(F.broadcast(starts), same, "left")
    place = (F.col("_place") + F.coalesce("_before", F.lit(0))).alias("_place")
    return placed.select(*[F.col(f"`{c}`") for c in rows.columns], place)


def _ordered_columns(rows: DataFrame) -> list[str]:
    """The columns that Spark can sort by: all but maps, and variants, at any depth."""

    def has_order(kind: T.DataType) -> bool:
        if isinstance(kind, T.ArrayType):
            return has_order(kind.elementType)
        if isinstance(kind, T.StructType):
            return all(has_order(f.dataType) for f in kind.fields)
        return not isinstance(kind, T.MapType | T.VariantType)

    return [f.name for f in rows.schema.fields if has_order(f.dataType)]

"""Repeatable row splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from callsieve.operators.checkpoints import BROADCAST_BYTES, checkpointed, size_in_bytes

SPREAD = 2654435761  # Fixed value: the golden-ratio multiplier of multiplicative hashing.


def split_point(row_id: Column) -> Column:
    """An integer id as a number in [0, 1), spread evenly whatever the step between ids.

    Integer arithmetic only, so other SQL engines agree with it.
    """
    return F.pmod(F.pmod(row_id.cast("bigint"), F.lit(2**31)) * SPREAD, F.lit(2**32)) / F.lit(2.0**32)


def with_part(
    rows: DataFrame,
    id_column: str,
    fraction: float,
    held_out: str = "test",
    rest: str = "train",
    start: float = 0.0,
) -> DataFrame:
    """Every row with a `part` column: `held_out` for about `fraction` of the ids, else `rest`.

    A second split with a `start` past the first one's range holds out other rows.
    """
    point = split_point(F.col(id_column))
    chosen = (point >= start) & (point < start + fraction)
    return rows.withColumn("part", F.when(chosen, held_out).otherwise(rest))


def content_point(*columns: str) -> Column:
    """Like `split_point` for rows without an id: equal rows always land on the same side."""
    return split_point(F.xxhash64(*columns))


def with_exact_part(
    rows: DataFrame,
    id_column: str,
    class_column: str,
    fraction: float,
    held_out: str = "test",
    rest: str = "train",
    accuracy: int = 10_000,
) -> DataFrame:
    """Every row with a `part` column: of each class, `fraction` of its rows, rounded to whole ones, are `held_out`.

    Those are the rows whose ids have the smallest `split_point`, ties going to smaller ids. NULL is a class of its
    own, and rows without an id come last. No class is sorted as a whole: a quantile sketch brackets each class's cut
    point, one pass counts the rows below the bracket, and only the rows in it, a share of about 5 / `accuracy` of all,
    are numbered. Rows that are equal in both columns are interchangeable.
    """
    if taken := [c for c in rows.columns if c.lower() in ("part", "_point", "_class", "_low", "_high", "_wanted", "_below", "_place")]:
        raise ValueError(f"rename the columns {taken}: these names are used while working")
    point = F.coalesce(split_point(F.col(id_column)), F.lit(1.0)).alias("_point")
    pointed = rows.select("*", point)
    margin = 2.5 / accuracy
    ends = F.array(F.lit(max(0.0, fraction - margin)), F.lit(min(1.0, fraction + margin)))
    classes = pointed.groupBy(F.col(class_column).alias("_class")).agg(
        F.floor(F.count(F.lit(1)) * fraction + 0.5).alias("_wanted"),
        F.percentile_approx("_point", ends, accuracy).alias("_ends"),
        F.min("_point").alias("_least"),
        F.max("_point").alias("_most"),
    )
    # Where the bracket reaches an end of the class it must take all of that end.
    low = F.when(F.lit(fraction <= margin), F.col("_least")).otherwise(F.get("_ends", F.lit(0)))
    high = F.when(F.lit(fraction >= 1 - margin), F.col("_most")).otherwise(F.get("_ends", F.lit(1)))
    classes = checkpointed(classes.select("_class", "_wanted", low.alias("_low"), high.alias("_high")))
    small = size_in_bytes(classes) <= BROADCAST_BYTES
    classes = F.broadcast(classes) if small else classes
    own = F.col(class_column).eqNullSafe(F.col("_class"))
    placed = pointed.join(classes, own)
    below = placed.groupBy(F.col(class_column).alias("_class")).agg(
        F.count_if(F.col("_point") < F.col("_low")).alias("_below")
    )
    below = checkpointed(below)
    below = F.broadcast(below) if small else below
    inside = (F.col("_point") >= F.col("_low")) & (F.col("_point") <= F.col("_high"))
    order = Window.partitionBy(class_column).orderBy("_point", F.col(id_column).asc_nulls_last())
    numbered = placed.filter(inside).withColumn("_place", F.row_number().over(order)).drop("_class").join(below, own)
    part = lambda chosen: F.when(chosen, held_out).otherwise(rest).alias("part")
    columns = [F.col(f"`{c}`") for c in rows.columns]
    near = numbered.select(*columns, part(F.col("_below") + F.col("_place") <= F.col("_wanted")))
    return placed.filter(~inside).select(*columns, part(F.col("_point") < F.col("_low"))).unionByName(near)

"""The call-leg table in the catalog, laid out so that its aggregates need no shuffle."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from callsieve.operators.calls import CALL_KEYS
from callsieve.operators.checkpoints import BROADCAST_BYTES, checkpointed, size_in_bytes, use_checkpoint_dir

DAY = "_add_day"
CALLER = "calling_number"
BUCKETS = 32


@dataclass(frozen=True)
class LegTable:
    """Two catalog tables that hold all legs, partitioned by day.

    `by_caller` has the ordinary callers, in buckets of the caller: legs of one caller, and so of one call and one
    session, are in one bucket. A caller with more than its share would fill a bucket alone, so frequent
    callers are in `by_call`, in buckets of (caller, callee, call id): a session is still in one bucket, a caller in all.
    """

    spark: SparkSession
    by_caller: str
    by_call: str

    @property
    def parts(self) -> tuple[DataFrame, DataFrame]:
        return self.spark.table(self.by_caller), self.spark.table(self.by_call)

    def legs(self) -> DataFrame:
        ordinary, frequent = self.parts
        return ordinary.unionByName(frequent)

    def drop(self) -> None:
        """Remove both tables from the catalog; their files stay in the table's folder."""
        for name in (self.by_caller, self.by_call):
            self.spark.sql(f"drop table if exists {name}")


def write_leg_table(
    legs: DataFrame,
    name: str | None = None,
    folder: str | None = None,
    buckets: int = BUCKETS,
    frequent_legs: int | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> LegTable:
    """Write all legs as a `LegTable` called `name`, its files in `folder` (by default, under the checkpoint folder).

    A caller is frequent with over `frequent_legs` legs on some day; by default, with more than the share of one
    bucket in the largest day, which holds for fewer than `buckets` callers a day. A NULL caller is one caller.
    """
    spark = legs.sparkSession
    name = name or f"legs_{uuid.uuid4().hex}"
    if folder is None:
        use_checkpoint_dir(spark)
        folder = f"{spark.sparkContext.getCheckpointDir()}/{name}"
    counts = checkpointed(legs.groupBy(DAY, CALLER).agg(F.count(F.lit(1)).alias("n")))
    if frequent_legs is None:
        largest = counts.groupBy(DAY).agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] or 0
        frequent_legs = -(-largest // buckets)
    frequent = checkpointed(counts.filter(F.col("n") > frequent_legs).select(F.col(CALLER).alias("_frequent")).distinct())
    if size_in_bytes(frequent) <= broadcast_bytes:
        frequent = F.broadcast(frequent)
    same = F.col(CALLER).eqNullSafe(F.col("_frequent"))

    def write(rows: DataFrame, keys: tuple[str, ...], table: str) -> None:
        # Rows are dealt out as buckets are, so each task writes one file per day: its bucket.
        writer = rows.repartition(buckets, *keys).write.format("parquet").partitionBy(DAY)
        writer.bucketBy(buckets, *keys).sortBy(*keys).option("path", f"{folder}/{table}").saveAsTable(table)

    table = LegTable(spark, f"{name}_by_caller", f"{name}_by_call")
    write(legs.join(frequent, same, "left_anti"), (CALLER,), table.by_caller)
    write(legs.join(frequent, same, "left_semi"), CALL_KEYS, table.by_call)
    return table

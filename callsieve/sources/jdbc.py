"""Partitioned reads from and bounded writes to JDBC tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, DataFrameReader, DataFrameWriter, SparkSession


def column_bounds(
    spark: SparkSession, url: str, table: str, column: str, options: Mapping[str, str] | None = None
) -> tuple[int, int] | None:
    """Smallest and largest value of a numeric column, computed by the database; None if it has none."""
    low, high = (
        spark.read.format("jdbc")
        .options(url=url, query=f"select min({column}) as lo, max({column}) as hi from {table}")
        .options(**dict(options or {}))
        .load()
        .first()
    )
    return None if low is None else (int(low), int(high))


def jdbc_reader(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    lower: int,
    upper: int,
    partitions: int,
    fetch_rows: int = 10_000,
    options: Mapping[str, str] | None = None,
) -> DataFrameReader:
    """A reader that splits the table into `partitions` ranges of `column`.

    The bounds only place the cuts: rows below, above and with a NULL column are read too.
    Use a column whose values repeat little, such as the primary key, so the ranges stay even.
    `partitions` is also the number of connections the database must serve at once.
    """
    if partitions < 1:
        raise ValueError("partitions must be at least 1")
    if upper < lower:
        raise ValueError("upper must not be below lower")
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, fetchsize=fetch_rows)
    if partitions > 1:
        reader = reader.options(
            partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=partitions
        )
    return reader.options(**dict(options or {}))


def read_jdbc(spark: SparkSession, url: str, table: str, column: str, partitions: int, **kwargs) -> DataFrame:
    """The whole table, read in parallel. Filters and column lists are pushed into the database."""
    bounds = column_bounds(spark, url, table, column, kwargs.get("options")) or (0, 0)
    return jdbc_reader(spark, url, table, column, *bounds, partitions, **kwargs).load()


def jdbc_writer(
    df: DataFrame,
    url: str,
    table: str,
    partitions: int,
    mode: str = "append",
    batch_rows: int = 10_000,
    options: Mapping[str, str] | None = None,
) -> DataFrameWriter:
    """A writer that opens at most `partitions` connections.

    Each partition is one transaction, so a task that fails leaves nothing behind. A task whose
    executor is lost after its commit is run again: give the target table a primary key.
    """
    return (
        df.write.format("jdbc")
        .mode(mode)
        .options(url=url, dbtable=table, numPartitions=partitions, batchsize=batch_rows)
        .options(**dict(options or {}))
    )


def write_jdbc(df: DataFrame, url: str, table: str, partitions: int, **kwargs) -> None:
    jdbc_writer(df, url, table, partitions, **kwargs).save()

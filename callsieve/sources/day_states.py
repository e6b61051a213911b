"""Sessions and calls kept as mergeable states per day, so that late legs touch their own days only.

Two tables in one folder, both partitioned by day: `sessions` has each session's latest start, seconds and legs, and
`calls` has each distinct call that counts when heavy callers are looked for. Both merge: two days, or a day
and its late legs, by the same aggregates that made them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from callsieve.operators.calls import (
    CALL_KEYS,
    SESSION_COLUMNS,
    SESSION_KEYS,
    SuspectRules,
    counted_legs,
    session_measures,
)
from callsieve.operators.checkpoints import checkpointed, exists
from callsieve.operators.endpoint_join import either_endpoint_join

DAY = "_add_day"
ENDS = ("calling_number", "called_number")


def write_day_states(legs: DataFrame, folder: str, rules: SuspectRules = SuspectRules()) -> None:
    """Replace the states of the days that `legs` has by those of `legs`; files of other days stay as they are.

    `legs` holds all legs of these days that are to count (for example, those of the watched addresses). Legs without a
    day are a day of their own.
    """
    _replace_days(_sessions_of(legs), f"{folder}/sessions")
    _replace_days(_calls_of(legs, rules), f"{folder}/calls")


def add_late_legs(late: DataFrame, folder: str, rules: SuspectRules = SuspectRules()) -> None:
    """Merge legs that came late into the states of their days.

    Only the late legs and the states of their days are read, and only those days are written. Each leg must be
    added once: the states can't tell a leg that is already in them.
    """
    spark = late.sparkSession
    days = F.broadcast(late.select(F.col(DAY).alias("_late")).distinct())

    def of_late_days(name: str, made: DataFrame) -> DataFrame:
        if not exists(spark, f"{folder}/{name}"):
            return made
        kept = spark.read.schema(made.schema).parquet(f"{folder}/{name}")
        return kept.join(days, F.col(DAY).eqNullSafe(F.col("_late")), "left_semi").unionByName(made)

    sessions = of_late_days("sessions", _sessions_of(late)).groupBy(DAY, *SESSION_KEYS).agg(*_merged_measures())
    calls = of_late_days("calls", _calls_of(late, rules)).distinct()
    # A table can't be overwritten while it is read, so the new states are computed first.
    for name, new in (("sessions", checkpointed(sessions)), ("calls", checkpointed(calls))):
        _replace_days(new, f"{folder}/{name}")


def sessions_of_days(spark: SparkSession, folder: str, *days: int) -> DataFrame:
    """The roll-up of the given days, or of all: what `session_rollup` gives for their legs."""
    states = _read(spark, f"{folder}/sessions", days)
    return states.groupBy(*SESSION_KEYS).agg(*_merged_measures()).select(*SESSION_COLUMNS)


def heavy_callers_of_days(spark: SparkSession, folder: str, rules: SuspectRules, *days: int) -> DataFrame:
    """What `heavy_callers` gives for the legs of the given days, or of all."""
    calls = _read(spark, f"{folder}/calls", days).select(*CALL_KEYS).distinct()
    counted = calls.groupBy("calling_number").agg(F.count(F.lit(1)).alias("calls"))
    return counted.filter(F.col("calls") >= rules.min_calls)


def suspect_traffic_of_days(spark: SparkSession, folder: str, rules: SuspectRules, *days: int) -> DataFrame:
    """What `suspect_traffic` gives for the legs of the given days, or of all."""
    heavy = heavy_callers_of_days(spark, folder, rules, *days).select("calling_number")
    return either_endpoint_join(sessions_of_days(spark, folder, *days), heavy, ENDS, "calling_number")


def _sessions_of(legs: DataFrame) -> DataFrame:
    return legs.groupBy(DAY, *SESSION_KEYS).agg(*session_measures())


def _calls_of(legs: DataFrame, rules: SuspectRules) -> DataFrame:
    return counted_legs(legs, rules).select(DAY, *CALL_KEYS).distinct()


def _merged_measures() -> list:
    return [F.max("btime").alias("btime"), F.sum("duration").alias("duration"), F.sum("cnt").alias("cnt")]


def _read(spark: SparkSession, table: str, days: tuple[int, ...]) -> DataFrame:
    states = spark.read.parquet(table)
    return states.filter(F.col(DAY).isin(*days)) if days else states


def _replace_days(states: DataFrame, table: str) -> None:
    # Several files a day, by caller, so that a day with most of the rows is not one task's work.
    dealt = states.repartition(DAY, F.pmod(F.xxhash64("calling_number", "callid"), F.lit(16)))
    writer = dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY)
    writer.parquet(table)

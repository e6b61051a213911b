"""All sessions that touch a heavy caller on either end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from callsieve.functions.casts import FRACTION_ONLY, NUMBER
from callsieve.operators.calls import (
    SESSION_COLUMNS,
    SESSION_KEYS,
    SuspectRules,
    counted_legs,
    heavy_callers,
    legs_of_day,
    session_measures,
    session_rollup,
)
from callsieve.operators.checkpoints import BROADCAST_BYTES, checkpointed, size_in_bytes
from callsieve.operators.endpoint_join import either_endpoint_join
from callsieve.operators.sketches import bloom_filter, count_min_sketch

ENDS = ("calling_number", "called_number")


def suspect_traffic(legs: DataFrame, rules: SuspectRules = SuspectRules()) -> DataFrame:
    """Sessions of the day with a heavy caller as caller or callee, once per heavy end.

    One lazy plan for every size: roll-up, heavy callers, and an equi-join on each session's ends, which
    adaptive execution broadcasts or shuffles, splitting skewed keys.
    """
    today = legs_of_day(legs, rules)
    heavy = heavy_callers(today, rules).select("calling_number")
    return either_endpoint_join(session_rollup(today), heavy, ENDS, "calling_number")


def suspect_traffic_measured(
    legs: DataFrame, rules: SuspectRules = SuspectRules(), broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """The same result, with the heavy callers computed and measured at once.

    If they fit `broadcast_bytes`, they drop the other legs before the roll-up's shuffle, which pays where
    few sessions are suspect; if not, the sessions are rolled up first. Runs jobs when called, and
    needs a checkpoint folder (`spark.checkpoint.dir`).
    """
    today = legs_of_day(legs, rules)
    heavy = checkpointed(heavy_callers(today, rules).select("calling_number"))
    if size_in_bytes(heavy) <= broadcast_bytes:
        return _filter_then_roll_up(today, heavy)
    return either_endpoint_join(session_rollup(today), heavy, ENDS, "calling_number")


def _filter_then_roll_up(today: DataFrame, heavy: DataFrame) -> DataFrame:
    # Both ends are session keys, so all legs of a session match the same heavy callers, and the
    # number of matches can ride through the roll-up as one more key.
    caller = F.broadcast(heavy.select(F.col("calling_number").alias("_caller")))
    callee = F.broadcast(heavy.select(F.col("calling_number").alias("_callee")))
    same = F.col("_caller").eqNullSafe(F.col("_callee"))
    matches = F.when(F.col("_caller").isNotNull() & F.col("_callee").isNotNull() & ~same, 2).otherwise(1)
    sessions = (
        today.join(caller, F.col("calling_number") == F.col("_caller"), "left")
        .join(callee, F.col("called_number") == F.col("_callee"), "left")
        .filter(F.col("_caller").isNotNull() | F.col("_callee").isNotNull())
        .groupBy(*SESSION_KEYS, matches.alias("_matches"))
        .agg(*session_measures())
    )
    return sessions.withColumn("_match", F.explode(F.sequence(F.lit(1), "_matches"))).select(*SESSION_COLUMNS)


def sketched_heavy_callers(legs: DataFrame, rules: SuspectRules = SuspectRules(), expected: int | None = None) -> DataFrame:
    """What `heavy_callers` gives; callers who surely have too few legs are left out before calls are shuffled.

    A count-min sketch bounds each caller's legs from above, and a caller has no more calls than legs, so no heavy caller goes
    and the count of those that stay is exact. It pays where most callers are light. `expected` is about how many legs
    there are (counted, if not given), for which the sketch is sized.
    """
    counted = counted_legs(legs, rules)
    expected = counted.count() if expected is None else expected
    sketch = count_min_sketch(counted, "calling_number", expected, max(1, rules.min_calls // 2))
    return heavy_callers(legs.filter(sketch.at_most(F.col("calling_number")) >= rules.min_calls), rules)


def suspect_traffic_filtered(legs: DataFrame, rules: SuspectRules = SuspectRules()) -> DataFrame:
    """What `suspect_traffic` gives, for lists of heavy callers that are too long to broadcast.

    A Bloom filter over the heavy callers, tested on both ends, drops the legs of other sessions before the roll-up
    shuffles them; the join after it is exact. Computes the heavy callers when called, and needs a checkpoint folder.
    """
    today = legs_of_day(legs, rules)
    heavy = checkpointed(heavy_callers(today, rules).select("calling_number"))
    # Both ends are session keys: all legs of a session pass or go.
    known = bloom_filter(heavy, "calling_number", heavy.count())
    first, second = (F.coalesce(known.may_hold(F.col(end)), F.lit(False)) for end in ENDS)
    return either_endpoint_join(session_rollup(today.filter(first | second)), heavy, ENDS, "calling_number")


def suspect_traffic_sql(
    spark: SparkSession, legs: DataFrame, rules: SuspectRules = SuspectRules()
) -> DataFrame:
    """The same result as one SQL statement, the join type left to adaptive execution."""
    number = "case when {0} rlike :number then try_cast(substring_index({0}, '.', 1) as bigint)" + (
        " when {0} rlike :fraction then 0L end"
    )
    seconds = "coalesce(case protocolid when '120' then call_duration else answerdur end, '0')"
    excluded = " ".join(
        f"and not startswith(calling_number, :excluded{i})"
        for i, _ in enumerate(rules.excluded_caller_prefixes)
    )
    keys = ", ".join(SESSION_KEYS)
    return spark.sql(
        f"""
        with today as (
          select * from {{legs}} where _add_day = :day and startswith(dest_ne_ip, :address)
        ), sessions as (
          select {keys}, max({number.format("btime")}) as btime,
            sum({number.format(f"({seconds})")}) as duration, count(*) as cnt
          from today group by {keys}
        ), heavy as (
          select calling_number as number
          from (
            select distinct calling_number, called_number, callid from today
            where (mathch_fraud_pattern = '0' or mathch_white_pattern = '0') {excluded}
          )
          group by calling_number
          having count(*) >= :min_calls and length(calling_number) > :longer_than
        ), ends as (
          select *, explode(array_distinct(array(calling_number, called_number))) as number
          from sessions
        )
        select {", ".join(SESSION_COLUMNS)} from ends join heavy using (number)
        """,
        args={
            "number": NUMBER,
            "fraction": FRACTION_ONLY,
            "day": rules.day,
            "address": rules.address_prefix,
            "min_calls": rules.min_calls,
            "longer_than": rules.longer_than,
        }
        | {f"excluded{i}": p for i, p in enumerate(rules.excluded_caller_prefixes)},
        legs=legs,
    )

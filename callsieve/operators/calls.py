"""Filters and aggregates over call legs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from callsieve.functions.casts import lenient_bigint

# What identifies one session, and the order of the roll-up's columns.
SESSION_KEYS = (
    "calling_number",
    "called_number",
    "callid",
    "calling_operator",
    "calling_location",
    "calling_countryname",
    "calling_provincename",
    "calling_cityname",
    "called_operator",
    "called_localion",
)
SESSION_COLUMNS = (
    "calling_number",
    "called_number",
    "calling_operator",
    "calling_location",
    "called_operator",
    "called_localion",
    "calling_countryname",
    "calling_provincename",
    "calling_cityname",
    "btime",
    "duration",
    "callid",
    "cnt",
)
CALL_KEYS = ("calling_number", "called_number", "callid")


@dataclass(frozen=True)
class SuspectRules:
    """What makes a number suspect. The defaults are fixed values."""

    day: int = 20171111
    address_prefix: str = "10.14"
    excluded_caller_prefixes: tuple[str, ...] = ("400", "95")
    min_calls: int = 100
    longer_than: int = 10


def legs_of_day(legs: DataFrame, rules: SuspectRules) -> DataFrame:
    """Legs of the day that went through the watched addresses."""
    return legs.filter(
        (F.col("_add_day") == rules.day) & F.col("dest_ne_ip").startswith(rules.address_prefix)
    )


def allowed_caller(rules: SuspectRules) -> Column:
    """False for excluded prefixes, NULL for a NULL caller."""
    allowed = F.lit(True)
    for prefix in rules.excluded_caller_prefixes:
        allowed = allowed & ~F.col("calling_number").startswith(prefix)
    return allowed


def pattern_clear() -> Column:
    """Whether at least one pattern flag is '0'; NULL where that is unknown."""
    return (F.col("mathch_fraud_pattern") == "0") | (F.col("mathch_white_pattern") == "0")


def leg_seconds() -> Column:
    """Seconds of one leg: which column holds them depends on the protocol. NULL counts as 0, text as NULL."""
    raw = F.when(F.col("protocolid") == "120", F.col("call_duration")).otherwise(F.col("answerdur"))
    return lenient_bigint(F.coalesce(raw, F.lit("0")))


def session_measures() -> list[Column]:
    return [
        F.max(lenient_bigint(F.col("btime"))).alias("btime"),
        F.sum(leg_seconds()).alias("duration"),
        F.count(F.lit(1)).alias("cnt"),
    ]


def session_rollup(legs: DataFrame) -> DataFrame:
    """Legs to sessions: latest start, summed seconds and number of legs."""
    return legs.groupBy(*SESSION_KEYS).agg(*session_measures()).select(*SESSION_COLUMNS)


def distinct_calls(legs: DataFrame) -> DataFrame:
    """Distinct (caller, callee, call id); NULL callees count as one value."""
    return legs.select(*CALL_KEYS).distinct()


def counted_legs(legs: DataFrame, rules: SuspectRules) -> DataFrame:
    """The legs that count when heavy callers are looked for."""
    return legs.filter(
        pattern_clear() & allowed_caller(rules) & (F.length("calling_number") > rules.longer_than)
    )


def heavy_callers(legs: DataFrame, rules: SuspectRules) -> DataFrame:
    """Callers with at least `min_calls` distinct calls, and how many they made."""
    return (
        distinct_calls(counted_legs(legs, rules))
        .groupBy("calling_number")
        .agg(F.count(F.lit(1)).alias("calls"))
        .filter(F.col("calls") >= rules.min_calls)
    )

"""Sessions, distinct calls, heavy callers and suspect traffic from a stored leg table, without shuffling its legs.

Every aggregate runs on both parts of the table, within buckets. Only heavy callers among the frequent ones
need more: one count per bucket and caller is shuffled and added up.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from callsieve.operators.calls import SuspectRules, distinct_calls, heavy_callers, legs_of_day, session_rollup
from callsieve.operators.endpoint_join import either_endpoint_join
from callsieve.plans.suspect_traffic import ENDS
from callsieve.sources.leg_table import LegTable


def _of_both(table: LegTable, made: Callable[[DataFrame], DataFrame], rules: SuspectRules | None) -> DataFrame:
    # No caller is in both parts, so groups that have the caller among their keys are whole in one of them.
    ordinary, frequent = (made(legs if rules is None else legs_of_day(legs, rules)) for legs in table.parts)
    return ordinary.unionByName(frequent)


def stored_sessions(table: LegTable, rules: SuspectRules | None = None) -> DataFrame:
    """All sessions, or those of the rules' day and addresses."""
    return _of_both(table, session_rollup, rules)


def stored_distinct_calls(table: LegTable, rules: SuspectRules | None = None) -> DataFrame:
    return _of_both(table, distinct_calls, rules)


def stored_heavy_callers(table: LegTable, rules: SuspectRules = SuspectRules()) -> DataFrame:
    return _of_both(table, lambda legs: heavy_callers(legs, rules), rules)


def stored_suspect_traffic(table: LegTable, rules: SuspectRules = SuspectRules()) -> DataFrame:
    """What `suspect_traffic` gives; the join on the sessions' ends is the first to shuffle anything."""
    heavy = stored_heavy_callers(table, rules).select("calling_number")
    return either_endpoint_join(stored_sessions(table, rules), heavy, ENDS, "calling_number")

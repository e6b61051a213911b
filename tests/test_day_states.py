import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from callsieve.operators.calls import SuspectRules, heavy_callers, session_rollup
from callsieve.operators.endpoint_join import either_endpoint_join
from callsieve.sources.day_states import (
    add_late_legs,
    heavy_callers_of_days,
    sessions_of_days,
    suspect_traffic_of_days,
    write_day_states,
)
from callsieve.sources.tables import LEG_SCHEMA

RULES = SuspectRules(min_calls=4)
DAYS = [20171111, 20171112, 20171113, None]


@pytest.fixture(scope="module")
def legs(spark):
    draw = random.Random(6)
    numbers = [f"130{i:08d}" for i in range(40)] + ["95123456789", None]

    def leg(i):
        values = {
            "calling_number": numbers[0] if i % 3 == 0 else draw.choice(numbers), "called_number": draw.choice(numbers),
            "callid": draw.choice([None, str(i // 3)]), "btime": draw.choice([str(i), "x"]), "protocolid": "121",
            "answerdur": draw.choice(["5", None, "z"]), "mathch_fraud_pattern": draw.choice(["0", "1"]), "_add_day": draw.choice(DAYS),
        }
        return [values.get(name) for name in LEG_SCHEMA.names]

    return spark.createDataFrame([leg(i) for i in range(2000)], LEG_SCHEMA).withColumn("late", F.expr("btime like '%3'"))


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def files(folder):
    return {p: p.stat().st_mtime_ns for p in Path(folder).rglob("*.parquet")}


def test_late_legs_give_what_all_legs_give(spark, legs, tmp_path):
    folder = str(tmp_path / "states")
    add_late_legs(legs.filter("late").drop("late"), folder, RULES)  # even before any state is there
    add_late_legs(legs.filter("not late and _add_day = 20171112").drop("late"), folder, RULES)
    add_late_legs(legs.filter("not late and _add_day <=> null").drop("late"), folder, RULES)
    add_late_legs(legs.filter("not late and _add_day in (20171111, 20171113)").drop("late"), folder, RULES)
    every = legs.drop("late")
    assert rows(sessions_of_days(spark, folder)) == rows(session_rollup(every))
    assert rows(heavy_callers_of_days(spark, folder, RULES)) == rows(heavy_callers(every, RULES)) != []
    day = every.filter("_add_day = 20171112")
    assert rows(sessions_of_days(spark, folder, 20171112)) == rows(session_rollup(day))
    heavy = heavy_callers(day, RULES).select("calling_number")
    expected = either_endpoint_join(session_rollup(day), heavy, ("calling_number", "called_number"), "calling_number")
    assert rows(suspect_traffic_of_days(spark, folder, RULES, 20171112)) == rows(expected) != []


def test_other_days_stay_untouched(spark, legs, tmp_path):
    folder = str(tmp_path / "states")
    every = legs.drop("late")
    write_day_states(every, folder, RULES)
    before, whole = files(folder), rows(sessions_of_days(spark, folder))
    write_day_states(every.filter("_add_day = 20171112"), folder, RULES)
    assert rows(sessions_of_days(spark, folder)) == whole
    add_late_legs(every.limit(0), folder, RULES)
    add_late_legs(every.filter("_add_day = 20171112").limit(1), folder, RULES)
    changed = {p for p in set(before) ^ set(files(folder))} | {p for p, t in files(folder).items() if before.get(p, t) != t}
    assert changed and all("_add_day=20171112" in str(p) for p in changed)
    assert any("_add_day=20171111" in str(p) for p in before)

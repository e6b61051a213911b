import random

import pytest
from pyspark.sql import functions as F

from callsieve.operators import sketches
from callsieve.operators.calls import SuspectRules, distinct_calls, heavy_callers, legs_of_day, session_rollup
from callsieve.plans.stored_traffic import (
    stored_distinct_calls,
    stored_heavy_callers,
    stored_sessions,
    stored_suspect_traffic,
)
from callsieve.plans.suspect_traffic import sketched_heavy_callers, suspect_traffic, suspect_traffic_filtered
from callsieve.sources.leg_table import write_leg_table
from callsieve.sources.tables import LEG_SCHEMA

RULES = SuspectRules(min_calls=5)


@pytest.fixture(scope="module")
def legs(spark):
    """Legs of which a third are one caller's, with NULL callers, callees and call ids, on two days."""
    draw = random.Random(3)
    numbers = [f"130{i:08d}" for i in range(60)] + ["4001", None]

    def leg(i):
        caller = numbers[0] if i % 3 == 0 else draw.choice(numbers)
        values = {
            "calling_number": caller, "called_number": draw.choice(numbers), "callid": draw.choice([None, str(i), str(i // 2)]),
            "btime": str(1510329600 + i), "protocolid": draw.choice(["120", "121"]), "call_duration": "5", "answerdur": "7",
            "dest_ne_ip": draw.choice(["10.14.1.1", "10.15.1.1"]), "mathch_fraud_pattern": draw.choice(["0", "1", None]),
            "mathch_white_pattern": "1", "_add_day": 20171111 + (i % 5 == 0),
        }
        return [values.get(name) for name in LEG_SCHEMA.names]

    return spark.createDataFrame([leg(i) for i in range(3000)], LEG_SCHEMA)


@pytest.fixture(scope="module")
def table(legs):
    made = write_leg_table(legs, buckets=8)
    yield made
    made.drop()


def rows(df):
    names = sorted(df.columns)
    return sorted(map(str, df.select(*names).collect()))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_all_legs_are_stored_and_a_frequent_caller_is_spread(legs, table):
    assert rows(table.legs()) == rows(legs)
    ordinary, frequent = table.parts
    assert [r[0] for r in frequent.select("calling_number").distinct().collect()] == ["13000000000"]
    assert ordinary.filter("calling_number = '13000000000'").count() == 0
    file_sizes = frequent.groupBy(F.input_file_name()).count().groupBy().agg(F.max("count"), F.count("*")).first()
    assert file_sizes[1] == 16 and file_sizes[0] < 0.3 * frequent.count()


def test_same_rows_as_from_the_legs(legs, table):
    today = legs_of_day(legs, RULES)
    assert rows(stored_distinct_calls(table)) == rows(distinct_calls(legs))
    assert rows(stored_sessions(table, RULES)) == rows(session_rollup(today))
    assert rows(stored_sessions(table)) == rows(session_rollup(legs))
    assert rows(stored_heavy_callers(table, RULES)) == rows(heavy_callers(today, RULES)) != []
    assert rows(stored_suspect_traffic(table, RULES)) == rows(suspect_traffic(legs, RULES)) != []


def test_aggregates_shuffle_nothing(table):
    ordinary, frequent = (legs_of_day(part, RULES) for part in table.parts)
    for part in (ordinary, frequent):
        assert "Exchange" not in plan(distinct_calls(part))
        assert "Exchange" not in plan(session_rollup(part))
    assert "Exchange" not in plan(heavy_callers(ordinary, RULES))
    assert plan(heavy_callers(frequent, RULES)).count("Exchange") == 1  # of counts per bucket
    assert "Exchange" not in plan(stored_sessions(table, RULES))


def test_only_the_days_files_are_read(table):
    scan = legs_of_day(table.parts[0], RULES).select(F.input_file_name().alias("f")).distinct().collect()
    assert scan and all("_add_day=20171111" in r["f"] for r in scan)
    assert "PartitionFilters: [isnotnull(_add_day" in plan(legs_of_day(table.parts[0], RULES))


def test_an_empty_table(spark, legs):
    made = write_leg_table(legs.limit(0), buckets=4)
    assert stored_suspect_traffic(made, RULES).count() == 0
    made.drop()


def test_bloom_filter_drops_no_key(spark):
    draw = random.Random(4)
    values = list({str(draw.getrandbits(60)) for _ in range(6000)})
    keys, others = values[:2000], values[2000:]
    for expected in (2000, 10):
        known = sketches.bloom_filter(spark.createDataFrame([(k,) for k in [*keys, None]], "k string"), "k", expected)
        asked = spark.createDataFrame([(v,) for v in [*values, None]], "v string")
        found = {r["v"]: r["hit"] for r in asked.select("v", known.may_hold(F.col("v")).alias("hit")).collect()}
        assert all(found[k] is True for k in keys) and found[None] is None
        assert sum(found[v] for v in others) < 0.02 * len(others)
    none = sketches.bloom_filter(spark.createDataFrame([], "k string"), "k", 0)
    assert not any(r[0] for r in asked.select(none.may_hold(F.col("v"))).collect())


def test_a_full_bloom_filter_still_drops_no_key(spark):
    keys = spark.range(20_000)
    known = sketches.bloom_filter(keys, "id", 20_000, bits_per_key=1, max_bits=64)
    assert keys.filter(known.may_hold(F.col("id"))).count() == 20_000


def test_count_min_is_never_too_low(spark):
    draw = random.Random(5)
    values = [min(int(draw.paretovariate(0.6)), 3000) for _ in range(20_000)] + [None] * 50
    frame = spark.createDataFrame([(v,) for v in values], "v long")
    sketch = sketches.count_min_sketch(frame, "v", len(values), 20)
    found = frame.groupBy("v").count().withColumn("most", sketch.at_most(F.col("v"))).collect()
    assert all(r["most"] >= r["count"] for r in found)
    assert sum(r["most"] > r["count"] + 20 for r in found) < 0.05 * len(found)
    assert {r["v"]: r["count"] for r in found}[None] == 50


def test_filtered_plans_give_the_same_rows(spark, legs, monkeypatch):
    today = legs_of_day(legs, RULES)
    assert rows(sketched_heavy_callers(today, RULES)) == rows(heavy_callers(today, RULES))
    assert rows(sketched_heavy_callers(today, RULES, expected=1)) == rows(heavy_callers(today, RULES))
    none = SuspectRules(min_calls=10**6)
    assert sketched_heavy_callers(today, none).count() == 0
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert rows(suspect_traffic_filtered(legs, RULES)) == rows(suspect_traffic(legs, RULES)) != []
        assert suspect_traffic_filtered(legs, none).count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def shuffled_rows(spark, run):
    """What `run` writes to shuffles, in rows."""
    sc = spark.sparkContext
    store = sc._jsc.sc().statusStore()
    listed = lambda: store.stageList(sc._jvm.java.util.ArrayList(), False, False, sc._gateway.new_array(sc._jvm.double, 0), sc._jvm.java.util.ArrayList())

    def total():
        sc._jsc.sc().listenerBus().waitUntilEmpty(10_000)
        stages = listed()
        return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))

    before = total()
    run()
    return total() - before


def test_filters_spare_shuffled_rows(spark, legs):
    """With few heavy callers among many, what reaches the roll-up's and the distinct's shuffle is little."""
    many = spark.range(30_000).select(
        *[
            {
                "calling_number": F.concat(F.lit("139"), F.lpad(F.when(F.col("id") % 100 == 0, 7).otherwise(F.col("id")).cast("string"), 8, "0")),
                "called_number": F.concat(F.lit("138"), F.lpad(F.col("id").cast("string"), 8, "0")),
                "callid": F.col("id").cast("string"), "dest_ne_ip": F.lit("10.14.1.1"), "mathch_fraud_pattern": F.lit("0"),
                "_add_day": F.lit(20171111),
            }.get(f.name, F.lit("1")).cast(f.dataType).alias(f.name)
            for f in LEG_SCHEMA.fields
        ]
    )
    rules = SuspectRules(min_calls=50)
    today = legs_of_day(many, rules)
    plain = shuffled_rows(spark, lambda: session_rollup(today).collect())
    heavy = spark.createDataFrame(heavy_callers(today, rules).select("calling_number").collect())
    known = sketches.bloom_filter(heavy, "calling_number", heavy.count())
    ends = known.may_hold(F.col("calling_number")) | known.may_hold(F.col("called_number"))
    kept = shuffled_rows(spark, lambda: session_rollup(today.filter(ends)).collect())
    assert plain >= 30_000 and heavy.count() == 1 and 300 <= kept < 0.1 * plain
    sketch = sketches.count_min_sketch(many, "calling_number", 30_000, 25)
    assert 300 <= many.filter(sketch.at_most(F.col("calling_number")) >= 50).count() < 0.1 * many.count()
    assert rows(sketched_heavy_callers(today, rules)) == rows(heavy_callers(today, rules)) != []
    assert rows(suspect_traffic_filtered(many, rules)) == rows(suspect_traffic(many, rules)) != []

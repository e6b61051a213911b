import random
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from callsieve.operators.calls import (
    SESSION_COLUMNS,
    SuspectRules,
    allowed_caller,
    distinct_calls,
    heavy_callers,
    legs_of_day,
    pattern_clear,
    session_rollup,
)
from callsieve.operators.endpoint_join import either_endpoint_join
from callsieve.plans.suspect_traffic import suspect_traffic, suspect_traffic_measured, suspect_traffic_sql
from callsieve.sources.derived import call_legs
from callsieve.sources.tables import LEG_SCHEMA, read_table, rows_to_frame
from conftest import TESTDATA

BASE = {
    "calling_number": "13000000001",
    "called_number": "13000000002",
    "btime": "1510329600",
    "protocolid": "120",
    "call_duration": "5",
    "answerdur": "7",
    "callid": "c",
    "dest_ne_ip": "10.14.1.1",
    "mathch_fraud_pattern": "0",
    "mathch_white_pattern": "1",
    "_add_day": 20171111,
}


def legs(spark, *changes):
    return rows_to_frame(
        spark, [[(BASE | c).get(name) for name in LEG_SCHEMA.names] for c in changes], LEG_SCHEMA
    )


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_day_and_prefix(spark):
    addresses = [{"dest_ne_ip": a} for a in ("10.140.2.2", "10x14.1.1", None)]
    frame = legs(spark, {}, *addresses, {"_add_day": 20171112})
    kept = legs_of_day(frame, SuspectRules()).collect()
    assert [r["dest_ne_ip"] for r in kept] == ["10.14.1.1", "10.140.2.2"]


def test_excluded_and_null_callers(spark):
    frame = legs(spark, *[{"calling_number": n} for n in ("4001", "1400", "951", "195", None)])
    kept = frame.filter(allowed_caller(SuspectRules())).collect()
    assert [r["calling_number"] for r in kept] == ["1400", "195"]


def test_null_pattern_flags(spark):
    flags = [("0", None), (None, "0"), ("1", None), (None, None), ("1", "1"), ("0", "1")]
    frame = legs(spark, *[{"mathch_fraud_pattern": f, "mathch_white_pattern": w} for f, w in flags])
    kept = frame.filter(pattern_clear()).select("mathch_fraud_pattern", "mathch_white_pattern").collect()
    assert [tuple(r) for r in kept] == [("0", None), (None, "0"), ("0", "1")]


def test_rollup(spark):
    frame = legs(
        spark,
        {},
        {"btime": "1510329700", "protocolid": None},  # NULL protocol takes answerdur
        {"protocolid": "121", "answerdur": None},  # NULL counts as 0
        {"protocolid": "121", "answerdur": ""},  # text that is no number is skipped
        {"callid": "d", "protocolid": "121", "answerdur": "x"},
        {"callid": "d", "protocolid": "121", "answerdur": ""},
        {"callid": "e", "btime": "z", "called_number": None},
    )
    rolled = session_rollup(frame)
    assert rolled.columns == list(SESSION_COLUMNS)
    assert [t for n, t in rolled.dtypes if n in ("btime", "duration", "cnt")] == ["bigint"] * 3
    assert {r["callid"]: (r["btime"], r["duration"], r["cnt"]) for r in rolled.collect()} == {
        "c": (1510329700, 12, 4),
        "d": (1510329600, None, 2),
        "e": (None, 5, 1),
    }


def test_null_callees_count_as_one_call(spark):
    frame = legs(
        spark,
        *[
            {"called_number": n, "callid": c}
            for n, c in ((None, "1"), (None, "1"), ("2", "1"), (None, "2"), (None, None))
        ],
    )
    assert distinct_calls(frame).count() == 4
    assert heavy_callers(frame, SuspectRules(min_calls=4)).first()["calls"] == 4
    assert heavy_callers(frame, SuspectRules(min_calls=5)).count() == 0


def test_short_callers_are_never_heavy(spark):
    frame = legs(spark, {"calling_number": "1300000000"}, {"calling_number": "13000000000"})
    found = heavy_callers(frame, SuspectRules(min_calls=1)).collect()
    assert [r["calling_number"] for r in found] == ["13000000000"]


def or_join(fact, keys):
    out = Counter()
    for row in fact:
        for (key,) in keys:
            out[row] += key is not None and key in (row[0], row[1])
    return +out


@pytest.mark.parametrize("seed", range(4))
def test_either_endpoint_join_equals_the_or_join(spark, seed):
    """NULL ends, equal ends, both ends known, duplicate and NULL keys, against brute force."""
    rng = random.Random(seed)
    fact = [(rng.choice([*"abcde", None]), rng.choice([*"abcde", None]), i) for i in range(60)]
    keys = [(rng.choice("abf") if rng.random() > 0.2 else None,) for _ in range(6)]
    frame = spark.createDataFrame(fact, "a string, b string, id int")
    key_frame = spark.createDataFrame(keys, "k string")
    expected = or_join(fact, keys)
    for partitions in (1, 2, 3, 4, 8):
        joined = either_endpoint_join(frame.repartition(partitions), key_frame, ("a", "b"), "k")
        assert Counter(map(tuple, joined.collect())) == expected
    shuffled = either_endpoint_join(frame, key_frame.hint("merge"), ("a", "b"), "k")
    assert "SortMergeJoin" in plan(shuffled) and Counter(map(tuple, shuffled.collect())) == expected


def test_either_endpoint_join_payload(spark):
    fact = spark.createDataFrame([("a", "b", 1), ("a", "a", 2)], "a string, b string, id int")
    keys = spark.createDataFrame([("a", "x"), ("b", "y")], "k string, tag string")
    joined = either_endpoint_join(fact, keys, ("a", "b"), "k", ["tag"])
    assert sorted((r["id"], r["tag"]) for r in joined.collect()) == [(1, "x"), (1, "y"), (2, "x")]


@pytest.fixture(scope="module")
def events_legs(spark):
    return call_legs(read_table(spark, str(TESTDATA / "sf0.01"), "events"))


def totals(df):
    return tuple(
        df.agg(
            F.count("*"), F.sum("btime"), F.sum("duration"), F.sum("cnt"), F.countDistinct("calling_number"),
            F.count_if(F.col("duration").isNull()),
        ).first()
    )


def test_all_ways_give_the_known_totals(spark, events_legs):
    rules = SuspectRules(min_calls=30)
    known = (3813, 5759076191109, 756021, 5702, 150, 274)
    assert totals(suspect_traffic(events_legs, rules)) == known
    assert totals(suspect_traffic_measured(events_legs, rules)) == known
    assert totals(suspect_traffic_measured(events_legs, rules, broadcast_bytes=0)) == known
    assert totals(suspect_traffic_sql(spark, events_legs, rules)) == known


@pytest.mark.parametrize("rules", [
    SuspectRules(min_calls=2, longer_than=0, excluded_caller_prefixes=()),
    SuspectRules(min_calls=1, address_prefix="10", excluded_caller_prefixes=("13",)),
    SuspectRules(min_calls=1, day=20171112),
    SuspectRules(),
])
def test_random_legs_against_the_or_join(spark, rules):
    rng = random.Random(str(rules))
    numbers = ["4001234567890", "95123456789", "13012345678", "13087654321", "1301", None]
    changes = [
        {
            "calling_number": rng.choice(numbers),
            "called_number": rng.choice(numbers),
            "callid": rng.choice("abcdefgh"),
            "btime": rng.choice(["5", "6.5", None]),
            "protocolid": rng.choice(["120", "121", None]),
            "call_duration": rng.choice(["3", ".5", None, "x"]),
            "answerdur": rng.choice(["4", "1e3", None]),
            "dest_ne_ip": rng.choice(["10.14.1", "10.15.1", None]),
            "mathch_fraud_pattern": rng.choice(["0", "1", None]),
            "mathch_white_pattern": rng.choice(["0", "1", None]),
            "_add_day": rng.choice([20171111, 20171112, None]),
        }
        for _ in range(150)
    ]
    frame = legs(spark, *changes)
    today = legs_of_day(frame, rules)
    heavy = [(r["calling_number"],) for r in heavy_callers(today, rules).collect()]
    sessions = [(r["calling_number"], r["called_number"], *r) for r in session_rollup(today).collect()]
    expected = Counter({row[2:]: n for row, n in or_join(sessions, heavy).items()})
    assert Counter(map(tuple, suspect_traffic(frame, rules).collect())) == expected
    assert Counter(map(tuple, suspect_traffic_measured(frame, rules).collect())) == expected
    assert Counter(map(tuple, suspect_traffic_measured(frame, rules, broadcast_bytes=0).collect())) == expected
    assert Counter(map(tuple, suspect_traffic_sql(spark, frame, rules).collect())) == expected


def test_plan_on_a_partitioned_catalog_table(spark, events_legs):
    events_legs.write.partitionBy("_add_day").saveAsTable("call_legs_by_day")
    table, rules = spark.table("call_legs_by_day"), SuspectRules(min_calls=30)

    measured = suspect_traffic_measured(table, rules)
    fits = plan(measured)
    assert "NestedLoop" not in fits and "CartesianProduct" not in fits
    assert fits.count("BroadcastHashJoin") == 2 and fits.count("Exchange hashpartitioning") == 1
    assert "PartitionFilters: [isnotnull(_add_day" in fits and "= 20171111)]" in fits
    assert "StringStartsWith(dest_ne_ip,10.14)" in fits
    assert "mathch_fraud_pattern" not in fits and "mathch_white_pattern" not in fits

    for other in (suspect_traffic(table, rules), suspect_traffic_measured(table, rules, broadcast_bytes=0)):
        assert "NestedLoop" not in plan(other) and "CartesianProduct" not in plan(other)

    callers = plan(heavy_callers(legs_of_day(table, rules), rules))
    assert "= 20171111)]" in callers and "StringStartsWith(dest_ne_ip,10.14)" in callers
    assert "answerdur" not in callers and "call_duration" not in callers and "btime" not in callers
    assert totals(measured)[0] == 3813


def test_skewed_caller_is_split_when_the_join_is_shuffled(spark):
    """One caller with most of the sessions: adaptive execution must be able to split the join."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        spread = F.concat(F.lit("130"), F.lpad((F.col("id") % 50000).cast("string"), 8, "0"))
        frame = spark.range(0, 60000, 1, 8).select(
            *[
                {
                    "calling_number": F.when(F.col("id") % 16 > 0, "13099999999").otherwise(spread),
                    "called_number": F.lit(None).cast("string"),
                    "callid": F.col("id").cast("string"),
                }.get(name, F.lit(BASE.get(name)).cast(LEG_SCHEMA[name].dataType)).alias(name)
                for name in LEG_SCHEMA.names
            ]
        )
        found = suspect_traffic_measured(frame, SuspectRules(min_calls=1), broadcast_bytes=0)
        assert len(found.collect()) == 60000
        assert "SortMergeJoin(skew=true)" in plan(found)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_duckdb_or_join_agrees(spark):
    """The explode form against a literal OR join in another engine."""
    rng = random.Random(7)
    fact = [(rng.choice([*"abcd", None]), rng.choice([*"abcd", None]), i) for i in range(200)]
    keys = [(k,) for k in ("a", "a", "c", None, "z")]
    con = duckdb.connect()
    con.execute("create table fact(a varchar, b varchar, id int)")
    con.executemany("insert into fact values (?, ?, ?)", fact)
    con.execute("create table keys_(k varchar)")
    con.executemany("insert into keys_ values (?)", keys)
    expected = con.execute("select f.* from fact f join keys_ on f.a = k or f.b = k").fetchall()
    joined = either_endpoint_join(
        spark.createDataFrame(fact, "a string, b string, id int"),
        spark.createDataFrame(keys, "k string"), ("a", "b"), "k",
    )
    assert Counter(map(tuple, joined.collect())) == Counter(expected)


def test_clashing_columns_are_refused(spark):
    fact = spark.createDataFrame([("a", "b", 1)], "x string, y string, n int")
    keys = spark.createDataFrame([("a", 2)], "k string, n int")
    with pytest.raises(ValueError, match="'n'"):
        either_endpoint_join(fact, keys, ("x", "y"), "k", ["n"])
    with pytest.raises(ValueError, match="_endpoint"):
        either_endpoint_join(fact.withColumnRenamed("n", "_Endpoint"), keys, ("x", "y"), "k")

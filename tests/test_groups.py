from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from callsieve.operators.groups import PART, bounded_parts
from callsieve.operators.history import CALL_FIELDS_WITHOUT_EVENT, collect_history, first_n, score_by_key, score_whole_keys
from callsieve.sources.tables import rows_to_frame

# Made up: one phone with two calls, one callee with a leading zero.
CALL_ROWS = [
    ("100", "204", "call_dst", 1, 2, "17", 3),
    ("101", "0991", "call_src", 2, 2, "3", 22),
    ("102", "207", "call_src", 0, 1, "90", 9),
    ("101", "205", "call_dst", 2, 9, "4", 23),
    ("103", "208", "call_dst", 2, 2, "61", 0),
]

SUMMARY = "phone1 string, n bigint, seconds bigint"


def scored(rows, max_rows=100_000):
    def summarise(calls: pd.DataFrame) -> pd.DataFrame:
        seconds = calls["callDuration"].astype("int64").sum()
        return pd.DataFrame({"phone1": calls["phone1"].iloc[:1], "n": len(calls), "seconds": seconds})

    merge = [F.sum("n").alias("n"), F.sum("seconds").alias("seconds")]
    return score_by_key(rows, "phone1", summarise, SUMMARY, merge, max_rows)


@pytest.fixture(scope="module")
def skewed(spark):
    """One phone with many copies of one call and many different ones, a NULL phone, small phones."""
    rows = [("hot", "copy", "call_src", 1, 1, "7", 1)] * 500
    rows += [("hot", f"other{i}", "call_dst", 1, 2, str(i), i % 24) for i in range(500)]
    rows += [(None, f"x{i % 3}", "call_dst", 1, 2, "3", 4) for i in range(200)]
    rows += [(f"cold{i}", "y", None, None, 2, "1", 5) for i in range(40)]
    return rows, rows_to_frame(spark, rows).repartition(5)


def unpacked(histories):
    return Counter(tuple(c) for r in histories.collect() for c in r["calls"])


def test_small_keys_are_one_part(spark):
    histories = collect_history(rows_to_frame(spark, CALL_ROWS)).collect()
    assert {r["phone1"]: (len(r["calls"]), sum(int(c["callDuration"]) for c in r["calls"])) for r in histories} == {
        "100": (1, 17),
        "101": (2, 7),
        "102": (1, 90),
        "103": (1, 61),
    }
    assert {r["part"] for r in histories} == {0}


def test_fields_are_a_parameter(spark):
    histories = collect_history(rows_to_frame(spark, CALL_ROWS), fields=CALL_FIELDS_WITHOUT_EVENT).collect()
    assert [r["phone1"] for r in histories if len(r["calls"]) == 2] == ["101"]
    assert all(list(c.asDict()) == list(CALL_FIELDS_WITHOUT_EVENT) for r in histories for c in r["calls"])


@pytest.mark.parametrize("max_rows", [1, 30, 100, 199, 200, 1000, 5000])
def test_every_row_is_kept_and_parts_are_bounded(skewed, max_rows):
    rows, frame = skewed
    histories = collect_history(frame, max_rows=max_rows).cache()
    assert unpacked(histories) == Counter(rows)
    sizes = {(r["phone1"], r["part"]): len(r["calls"]) for r in histories.collect()}
    assert len(sizes) == histories.count()
    assert max(sizes.values()) <= max_rows
    for phone in {r[0] for r in rows}:
        parts = sorted((r["part"], r["calls"]) for r in histories.collect() if r["phone1"] == phone)
        assert [p for p, _ in parts] == list(range(len(parts)))
        assert all(len(calls) == max_rows for _, calls in parts[:-1])
        joined = [tuple(c) for _, calls in parts for c in calls]
        assert joined == sorted((r for r in rows if r[0] == phone), key=lambda r: [(x is not None, x) for x in r])
    histories.unpersist()


def test_copies_of_one_row_are_spread(spark):
    frame = rows_to_frame(spark, [("hot", "copy", "call_src", 1, 1, "7", 1)] * 1000)
    sizes = [len(r["calls"]) for r in collect_history(frame, max_rows=100).collect()]
    assert sizes == [100] * 10


@pytest.mark.parametrize("max_rows", [1, 5, 1000])
def test_values_come_back_as_they_were(spark, max_rows):
    """Signed zeros, text under a collation, and maps, whether keys are cut or not."""
    rows = [(1, z, t) for z in (0.0, -0.0) for t in ("A", "a", "a")]
    frame = spark.createDataFrame(rows, "k int, z double, t string").withColumn("t", F.expr("t collate UTF8_LCASE"))
    histories = collect_history(frame, "k", ["z", "t"], max_rows, "calls").select(F.inline("calls"))
    seen = Counter((str(r["z"]), r["t"]) for r in histories.collect())
    assert seen == Counter((str(z), t) for _, z, t in rows)

    def entries(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"k": group["k"].iloc[:1], "n": sum(len(m) for m in group["m"])})

    maps = frame.select("k", F.create_map("t", "z").alias("m"))
    found = score_by_key(maps, "k", entries, "k int, n bigint", [F.sum("n").alias("n")], max_rows)
    assert [tuple(r) for r in found.collect()] == [(1, 6)]


def test_functions_that_need_whole_keys(skewed):
    _, frame = skewed

    def middle(group: pd.DataFrame) -> pd.DataFrame:
        seconds = group["callDuration"].astype("int64")
        return pd.DataFrame({"phone1": group["phone1"].iloc[:1], "middle": float(seconds.median())})

    found = {r[0]: r[1] for r in score_whole_keys(frame, "phone1", middle, "phone1 string, middle double").collect()}
    assert found["hot"] == 7.0 and found[None] == 3.0 and len(found) == 42
    with pytest.raises(ValueError, match="over the limit"):
        score_whole_keys(frame, "phone1", middle, "phone1 string, middle double", max_rows=999)


def test_keys_beyond_a_double_stay_apart(spark):
    keys = [2**53, 2**53 + 1, None, 2**53, None]
    frame = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k bigint, v bigint").coalesce(1)

    def total(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"k": group["k"].iloc[:1].to_numpy(), "v": group["v"].sum()})

    found = score_by_key(frame, "k", total, "k bigint, v bigint", [F.sum("v").alias("v"), F.count("*").alias("n")])
    assert {tuple(r) for r in found.collect()} == {(2**53, 3, 1), (2**53 + 1, 1, 1), (None, 6, 1)}


def test_null_and_nan_keys_stay_apart(spark):
    frame = spark.createDataFrame([(None, 1), (float("nan"), 2), (float("nan"), 3), (1.0, 4)], "k double, v bigint")

    def total(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"v": [group["v"].sum()]})

    found = score_whole_keys(frame.coalesce(1), "k", total, "v bigint").collect()
    assert sorted(r["v"] for r in found) == [1, 4, 5]


def test_working_names_are_refused(spark):
    frame = spark.createDataFrame([(1, 2)], "k int, _PART int")
    with pytest.raises(ValueError, match="_PART"):
        collect_history(frame, "k", ["_PART"])


def test_parts_do_not_depend_on_partitioning(skewed):
    _, frame = skewed
    seen = [
        sorted(map(str, collect_history(frame.repartition(n), max_rows=50).collect())) for n in (1, 2, 3, 4, 8)
    ]
    assert all(s == seen[0] for s in seen)


def test_without_large_keys_the_rows_are_read_as_they_are(skewed):
    _, frame = skewed
    plan = bounded_parts(frame, "phone1")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Union" not in plan


def test_large_key_list_beyond_the_broadcast_limit(skewed):
    rows, frame = skewed
    parts = bounded_parts(frame, "phone1", max_rows=50, broadcast_bytes=0)
    assert Counter(map(tuple, parts.drop(PART).collect())) == Counter(rows)


@pytest.mark.parametrize("max_rows", [60, 5000])
def test_score_is_the_same_however_keys_are_cut(skewed, max_rows):
    rows, frame = skewed
    expected = {}
    for phone, *_, seconds, _ in rows:
        n, total = expected.get(phone, (0, 0))
        expected[phone] = (n + 1, total + int(seconds))
    assert {r["phone1"]: (r["n"], r["seconds"]) for r in scored(frame, max_rows).collect()} == expected


def test_score_does_not_depend_on_partitioning(spark):
    frame = rows_to_frame(spark, CALL_ROWS)
    seen = [sorted(map(tuple, scored(frame.repartition(n)).collect())) for n in (1, 2, 3, 4, 8)]
    assert all(s == seen[0] for s in seen)


def test_groups_longer_than_a_batch(skewed, spark):
    rows, frame = skewed
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        found = {r["phone1"]: r["n"] for r in scored(frame).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert found == Counter(r[0] for r in rows)


def test_numeric_key_with_nulls(spark):
    frame = spark.createDataFrame([(1, 5), (None, 6), (None, 7), (2, 8), (1, 9)], "k bigint, v bigint")

    def total(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"k": group["k"].iloc[:1].astype("Int64"), "v": group["v"].sum()})

    found = score_by_key(frame, "k", total, "k bigint, v bigint", [F.sum("v").alias("v"), F.count("*").alias("n")])
    assert {tuple(r) for r in found.collect()} == {(1, 14, 1), (None, 13, 1), (2, 8, 1)}


def test_first_n(spark):
    scores = scored(rows_to_frame(spark, CALL_ROWS))
    assert [tuple(r) for r in first_n(scores, 2, "phone1").collect()] == [
        ("100", 1, 17),
        ("101", 2, 7),
    ]
    assert [f.dataType.simpleString() for f in rows_to_frame(spark, CALL_ROWS).schema] == [
        "string", "string", "string", "int", "int", "string", "int",
    ]


def test_max_rows_must_be_positive(spark):
    with pytest.raises(ValueError):
        bounded_parts(rows_to_frame(spark, CALL_ROWS), "phone1", max_rows=0)

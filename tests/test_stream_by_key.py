import random

import pandas as pd
import pyarrow as pa
import pytest

from callsieve.operators.history import stream_by_key

SCHEMA = "k string, n long, digest long, batches long"


def made_walk():
    def walked(values):
        """A number that depends on the order of all values."""
        digest = 7
        for v in values:
            digest = (digest * 31 + (-1 if v is None else v)) % 1_000_003
        return digest

    return walked


walked = made_walk()


def summary_of(digest_of):
    """The function is made here so that it is sent to the tasks whole: they can't import this file."""

    def summary(batches):
        key, values, count = None, [], 0
        for batch in batches:
            assert 0 < batch.num_rows <= 10 and len(set(batch.column("k").to_pylist())) == 1
            key, count = batch.column("k")[0].as_py(), count + 1
            values += batch.column("v").to_pylist()
        yield pa.RecordBatch.from_pylist(
            [{"k": key, "n": len(values), "digest": digest_of(values), "batches": count}],
            pa.schema([("k", pa.string()), ("n", pa.int64()), ("digest", pa.int64()), ("batches", pa.int64())]),
        )

    return summary


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(1)
    made = [("hot", draw.randrange(10**6)) for _ in range(1500)] + [(None, draw.choice([None, 1, 2])) for _ in range(40)]
    made += [(f"k{draw.randrange(300)}", draw.choice([None, draw.randrange(9)])) for _ in range(1500)]
    draw.shuffle(made)
    return made


@pytest.mark.parametrize("arrow_rows", [3, 10, 10_000])
def test_order_dependent_results_are_exact(spark, rows, arrow_rows):
    expected = {}
    for k, v in rows:
        expected.setdefault(k, []).append(v)
    frame = spark.createDataFrame(rows, "k string, v long").repartition(6)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", arrow_rows)
    try:
        found = stream_by_key(frame, "k", ["v"], summary_of(made_walk()), SCHEMA, 10).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(found) == len(expected)
    for r in found:
        values = sorted(expected[r["k"]], key=lambda v: -1 if v is None else v)
        assert (r["n"], r["digest"]) == (len(values), walked(values))
        assert r["batches"] >= -(-len(values) // 10)


def test_a_function_may_stop_early_or_read_nothing(spark, rows):
    def first_value(batches):
        first = next(batches)
        yield pd.DataFrame({"v": first.column("v").to_pylist()[:1], "k": first.column("k").to_pylist()[:1]})

    def nothing(batches):
        return iter(())

    frame = spark.createDataFrame(rows, "k string, v long")
    found = {r["k"]: r["v"] for r in stream_by_key(frame, "k", ["v"], first_value, "k string, v long", 4).collect()}
    assert found["hot"] == min(v for k, v in rows if k == "hot") and len(found) == len({k for k, _ in rows})
    assert stream_by_key(frame, "k", ["v"], nothing, "k string, v long").count() == 0


def test_several_results_for_a_key(spark):
    def running(batches):
        total = 0
        for batch in batches:
            made = []
            for v in batch.column("v").to_pylist():
                total += v
                made.append(total)
            yield pa.table({"k": batch.column("k"), "total": pa.array(made)})

    frame = spark.range(1000).selectExpr("id % 2 as k", "id as v")
    found = stream_by_key(frame, "k", ["v"], running, "k long, total long", 7).groupBy("k").max("total").collect()
    assert {r[0]: r[1] for r in found} == {0: sum(range(0, 1000, 2)), 1: sum(range(1, 1000, 2))}


def test_empty_table_and_bad_batch_size(spark):
    frame = spark.createDataFrame([], "k string, v long")
    assert stream_by_key(frame, "k", ["v"], summary_of(made_walk()), SCHEMA).collect() == []
    with pytest.raises(ValueError, match="batch_rows"):
        stream_by_key(frame, "k", ["v"], summary_of(made_walk()), SCHEMA, 0)

import numpy as np
import pytest
from hypothesis import given, strategies as st

from callsieve.llm import token_shards as shards
from callsieve.llm.shared import stored
from callsieve.llm.tokens import token_ids
from conftest import TESTDATA


@given(st.integers(1, 3000), st.integers(0, 2**70))
def test_permutation_and_its_inverse(size, key):
    slots = shards.permuted(np.arange(size), size, key)
    assert sorted(slots) == list(range(size))
    assert shards.permuted(slots, size, key, inverse=True).tolist() == list(range(size))


def test_keys_give_different_orders():
    assert (shards.permuted(np.arange(1000), 1000, 1) != shards.permuted(np.arange(1000), 1000, 2)).mean() > 0.9


@pytest.fixture(scope="module")
def written(spark):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet")
    return docs, shards.training_shards(docs, key=3, stride=64, per_shard=50)


def test_round_trip(written):
    docs, table = written
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = shards.read_slots(table).collect()
    assert sorted(r["slot"] for r in rows) == list(range(len(rows)))
    found = {(r["doc_id"], r["start"]): np.frombuffer(r["ids"], "<u2").tolist() for r in rows}
    expected = {
        (d, i): ids[i : i + 64].tolist()
        for d, t in texts.items()
        for ids in [token_ids(t)]
        for i in range(0, len(ids), 64)
    }
    assert found == expected
    assert all(r["shard"] == r["slot"] // 50 and r["byte_offset"] == r["slot"] % 50 * 128 for r in rows)


def test_payloads_have_a_fixed_stride(written):
    rows = sorted(written[1].collect(), key=lambda r: r["shard"])
    assert all(len(r["payload"]) == r["slots"] * 128 for r in rows)
    assert all(r["slots"] == 50 for r in rows[:-1]) and [r["shard"] for r in rows] == list(range(len(rows)))


def test_reading_resumes_anywhere(written):
    rows = shards.read_slots(written[1], first_slot=77).collect()
    everything = shards.read_slots(written[1]).collect()
    assert sorted(r["slot"] for r in rows) == list(range(77, len(everything)))


def test_order_is_that_of_the_key(documents):
    table = stored(shards.sequences(documents(["a b c"] * 40), 2))
    once, again = (
        {(r["doc_id"], r["start"]): r["slot"] for r in shards.slotted(table, 5).collect()} for _ in range(2)
    )
    assert once == again
    assert once != {(r["doc_id"], r["start"]): r["slot"] for r in shards.slotted(table, 6).collect()}


def test_odd_rows(documents):
    docs = documents([(1, None), (None, "a"), (2, ""), (3, "b c"), (3, "b c"), (4, "x" * 50_000)])
    rows = shards.read_slots(shards.training_shards(docs, 1)).collect()
    assert sorted((r["doc_id"] or 0) for r in rows)[:3] == [0, 3, 3]
    assert sum(r["length"] for r in rows if r["doc_id"] == 4) == len(token_ids("x" * 50_000))


def test_columns_with_the_names_of_the_result(documents):
    docs = documents([(i, f"text {i}") for i in range(20)])
    docs = docs.selectExpr("*", "1 as SLOT", "2 as shard", "3 as part", "4 as place", "'x' as ids", "5 as length")
    rows = shards.read_slots(shards.training_shards(docs, 1)).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(20)) and sorted(r["slot"] for r in rows) == list(range(20))


def test_slots_do_not_depend_on_how_parts_are_numbered(spark):
    """Each sequence's slot is the permutation of its place after all earlier parts, by a plain count."""
    rows = [(part, place, part * 100 + place) for part in (0, 3, 7) for place in range(part + 2)]
    table = stored(spark.createDataFrame(rows, "part int, place long, name long"))
    found = {r["name"]: r["slot"] for r in shards.slotted(table, 11).collect()}
    names = [name for *_, name in sorted(rows)]
    assert found == dict(zip(names, shards.permuted(np.arange(len(names)), len(names), 11).tolist(), strict=True))


def test_empty_table(documents):
    assert shards.read_slots(shards.training_shards(documents([]), 1)).count() == 0

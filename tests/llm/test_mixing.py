import pytest

from callsieve.llm import mixing, queries
from conftest import TESTDATA


def by_rounds(sizes, weights=(1, 2, 3), cap=3):
    """Targets by sharing the excess again until nothing is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, full = dict.fromkeys(names, 0.0), set()
    left = float(sum(sizes.values()))
    while left > 1e-9 and (open_ := [s for s in names if s not in full]):
        total, over = sum(weight[s] for s in open_), 0.0
        for s in open_:
            target[s] += left * weight[s] / total
        for s in open_:
            if target[s] >= cap * sizes[s]:
                over += target[s] - cap * sizes[s]
                target[s] = cap * sizes[s]
                full.add(s)
        left = over
    return target


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 10, "b": 10, "c": 10}, {"a": 1, "b": 100, "c": 1000, None: 7}, {"z": 5}, {"a": 0, "b": 0}, {"a": 0, "b": 9},
        {f"s{i:02}": (i * 37) % 50 for i in range(20)}, {"é": 100, "Z": 3, "a": 2, None: 1},
    ],
)
def test_targets(spark, sizes):
    rows = mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, size long")).collect()
    expected = by_rounds(sizes)
    assert {r["source"]: r["target"] for r in rows} == pytest.approx(expected)


def test_sources_come_near_their_targets(spark):
    rows = queries.op9_mixing(spark, str(TESTDATA / "sf0.1")).collect()
    taken, target = {}, {}
    for r in rows:
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        target[r["source"]] = r["target"]
        assert r["taken"] <= 3 * r["size"] and r["taken"] % max(r["size"], 1) == 0
    assert all(abs(taken[s] - target[s]) < 0.1 * target[s] for s in target)
    again = queries.op9_mixing(spark, str(TESTDATA / "sf0.1")).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, again), key=str)


def test_rows_are_emitted_as_often_as_taken(documents):
    docs = documents([(i, "w " * (i % 7 + 1), "abc"[i % 3]) for i in range(90)])
    docs = docs.selectExpr("*", "doc_id as TARGET", "'x' as copies")
    taken = {r["doc_id"]: r["copies"] for r in mixing.mixed(docs).collect()}
    rows = mixing.emitted(docs)
    assert rows.columns == docs.columns
    counts = {r["doc_id"]: r["count"] for r in rows.groupBy("doc_id").count().collect()}
    assert counts == {d: n for d, n in taken.items() if n}


def test_ties_and_a_very_long_text(documents):
    """Equal rows fare alike, and so do all draws of a source whose rate is whole: the first one is used."""
    long = "w " * 300_000
    docs = documents([(1, long, "a"), (1, long, "a"), (2, "x y", "b"), (2, "x y", "b"), (3, "x y", "b")])
    rows = mixing.mixed(docs).collect()
    for doc_id, size in ((1, 300_000), (2, 2)):
        own = [r for r in rows if r["doc_id"] == doc_id]
        assert len(own) == 2 and len({r["copies"] for r in own}) == 1 and {r["size"] for r in own} == {size}
    # b may have three times its size at most, all draws agree on that
    assert {r["copies"] for r in rows if r["source"] == "b"} == {3}
    again = mixing.mixed(docs.repartition(3)).collect()
    assert sorted((r["doc_id"], r["copies"]) for r in again) == sorted((r["doc_id"], r["copies"]) for r in rows)


def test_odd_rows(documents):
    docs = documents([(1, None, "a"), (1, None, "a"), (None, "b c", None), (2, "", "b"), (3, "x", "b")])
    rows = mixing.mixed(docs).collect()
    assert sorted((r["size"], r["source_size"]) for r in rows) == [(0, 0), (0, 0), (0, 1), (1, 1), (2, 2)]
    assert {r["copies"] for r in rows if r["source"] == "a"} == {0}
    assert mixing.mixed(documents([])).count() == 0 and mixing.emitted(documents([])).count() == 0

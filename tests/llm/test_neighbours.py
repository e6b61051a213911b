import numpy as np
import pytest
from pyspark.sql import functions as F

from callsieve.llm import neighbours, queries
from conftest import TESTDATA

SCHEMA = "vec_id long, embedding array<float>"


def exact(rows, k=5):
    """query -> [(id, cosine)] over rows of (id, vector), all in double precision."""
    ids = np.array([i for i, _ in rows])
    table = np.array([v for _, v in rows], np.float64)
    table /= np.linalg.norm(table, axis=1, keepdims=True)
    out = {}
    for i in np.flatnonzero(ids % 50 == 0):
        scores = table @ table[i]
        order = sorted((-s, v) for s, v in zip(scores, ids, strict=True) if v != ids[i])[:k]
        out[int(ids[i])] = [(int(v), -s) for s, v in order]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def recall(got, true):
    assert set(got) == set(true)
    return np.mean([len({v for v, _ in got[q]} & {v for v, _ in true[q]}) / len(true[q]) for q in true])


@pytest.mark.parametrize("per_shard", [neighbours.SHARD_VECTORS, 300])
def test_recall_and_scores(spark, per_shard):
    vectors = spark.read.parquet(f"{TESTDATA}/sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    true = exact(rows)
    got = found(neighbours.nearest(vectors, F.col("vec_id") % 50 == 0, 5, per_shard=per_shard))
    assert recall(got, true) >= 0.9
    table = dict(rows)
    for q, pairs in got.items():
        a = np.array(table[q], float)
        for v, score in pairs:
            b = np.array(table[v], float)
            assert score == pytest.approx(a @ b / np.linalg.norm(a) / np.linalg.norm(b), abs=1e-12)


def test_query(spark):
    got = found(queries.op4_neighbours(spark, str(TESTDATA / "sf0.001")))
    rows = spark.read.parquet(f"{TESTDATA}/sf0.001/embeddings.parquet").collect()
    assert recall(got, exact([(r["vec_id"], r["embedding"]) for r in rows])) >= 0.95


def test_equal_vectors_go_by_id(spark):
    rows = [(i, [1.0, 2.0]) for i in range(400)] + [(1000, [2.0, 1.0])]
    got = found(neighbours.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0, 5))
    assert [v for v, _ in got[0]] == [1, 2, 3, 4, 5] and [v for v, _ in got[50]] == [0, 1, 2, 3, 4]
    assert [v for v, _ in got[1000]] == [0, 1, 2, 3, 4]


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]),
        (None, [1.0, 0.0]), (0, [1.0, 0.0]), (7, [1.0, 1.0, 1.0]), (50, [3e38, 3e38]), (100, None), (8, []),
    ]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as RANK", "2 as vector", "3 as shard")
    got = found(neighbours.nearest(df, F.col("vec_id") % 50 == 0, 5))
    assert {q: [v for v, _ in pairs] for q, pairs in got.items()} == {0: [50, 1], 50: [0, 1]}
    assert got[50][0][1] == pytest.approx(0.5**0.5)
    assert neighbours.nearest(df.limit(0), F.col("vec_id") % 50 == 0, 5).count() == 0


def test_every_node_is_in_the_lowest_layer():
    unit = neighbours.normalised(np.random.default_rng(0).normal(size=(700, 16)))
    layers = neighbours.build(unit)
    assert [len(x) for x in layers] == [700, 43, 2]
    reached, edge = {0}, [0]
    while edge:
        edge = [int(v) for u in edge for v in layers[0][u] if v >= 0 and v not in reached and not reached.add(int(v))]
    assert len(reached) == 700

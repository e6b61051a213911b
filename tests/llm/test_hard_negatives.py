import math
import random

import numpy as np
import pytest

from callsieve.llm import hard_negatives
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<double>, label int, ROW int, Block int"


def brute_force(rows):
    kept = [
        (i, [math.floor(256 * x) for x in v], lab) for i, v, lab in rows
        if i is not None and v is not None and lab is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    made = []
    for k, (anchor, cells, label) in enumerate(kept):
        if anchor % 100:
            continue
        scored = [(-sum(a * b for a, b in zip(cells, c)), i, lab) for j, (i, c, lab) in enumerate(kept) if j != k]
        for p, positive, _ in sorted(x for x in scored if x[2] == label)[:5]:
            good = sorted(x for x in scored if x[2] != label and 30 * -p <= 100 * -x[0] <= 90 * -p)[:10]
            made += [(anchor, positive, rank, i, -p, -s) for rank, (s, i, _) in enumerate(good, 1)]
    return sorted(made)


def checked(spark, rows, least=0):
    table = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA)
    found = sorted(map(tuple, hard_negatives.mined(table, F.col("vec_id") % 100 == 0).collect()))
    assert found == brute_force(rows) and len(found) >= least


def vectors(draw, n, width, labels=3):
    middle = [[draw.gauss(0, 1) for _ in range(width)] for _ in range(6)]
    return [
        (i, [m + draw.gauss(0, 0.6) for m in draw.choice(middle)], draw.randrange(labels)) for i in range(0, 10 * n, 10)
    ]


@pytest.mark.parametrize("block, shelf, section", [(hard_negatives.BLOCK, hard_negatives.SHELF, hard_negatives.SECTION), (7, 3, 5)])
def test_many_blocks_against_brute_force(spark, monkeypatch, block, shelf, section):
    for name, value in (("BLOCK", block), ("SHELF", shelf), ("SECTION", section), ("CHUNK", 4)):
        monkeypatch.setattr(hard_negatives, name, value)
    checked(spark, vectors(random.Random(1), 400, 6), 200)


def test_no_table_is_broadcast_however_small_its_files(spark, monkeypatch):
    """Also where several groups of zone maps, shelves and sections meet."""
    for name, value in (("BLOCK", 7), ("SHELF", 3), ("MAPS", 6), ("SECTION", 5), ("CHUNK", 4)):
        monkeypatch.setattr(hard_negatives, name, value)
    made, stored = [], hard_negatives.stored
    monkeypatch.setattr(hard_negatives, "stored", lambda df: made.append(df) or stored(df))
    rows = vectors(random.Random(5), 400, 6)
    table = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA)
    found = hard_negatives.mined(table, F.col("vec_id") % 100 == 0)
    assert sorted(map(tuple, found.collect())) == brute_force(rows)
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in [*made, found]]
    assert sum("Join" in plan for plan in plans) >= 3
    assert not [plan for plan in plans if "Broadcast" in plan]


def test_ties_repeated_rows_nulls_and_other_lengths(spark):
    draw = random.Random(2)
    rows = [(i, [draw.choice([0.0, 0.5, 1.0]) for _ in range(3)], draw.choice([0, 1, 1, None])) for i in range(0, 2000, 20)]
    rows += [(300, [1.0, 1.0, 0.5], 1)] * 4 + [(301, [1.0, 0.5, 0.5], 0)] * 15
    rows += [(None, [1.0] * 3, 1), (400, None, 1), (500, [], 1), (600, [1.0, None, 1.0], 0), (700, [math.nan] * 3, 1)]
    rows += [(800, [math.inf, 0.0, 0.0], 0), (900, [1.0, 0.2], 1), (1000, [0.5] * 5, 0), (-100, [-1.0, 0.3, 0.2], 1)]
    checked(spark, rows, 50)


def test_no_positive_and_no_rows(spark):
    checked(spark, [(0, [1.0], 1), (1, [1.0], 2), (100, [-1.0], 3), (101, [1.0], 3), (102, [-0.5], 4)])
    checked(spark, [])


def test_scores_that_would_not_be_exact_are_refused(spark):
    with pytest.raises(ValueError, match="must stay under"):
        checked(spark, [(0, [1e9], 1), (1, [1.0], 2)])


def test_curve_visits_neighbours():
    """Along the curve each step goes to a neighbouring point, and all points are visited."""
    for width, bits in ((2, 3), (3, 2), (4, 1)):
        side = 1 << bits
        points = np.array([[(i // side**k) % side for k in range(width)] for i in range(side**width)])
        places = [x.tobytes() for x in hard_negatives.curve_places(points, bits)]
        walk = points[sorted(range(len(points)), key=lambda i: places[i])]
        assert len(set(places)) == len(points)
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_zone_maps_bound_all_scores():
    rng = np.random.default_rng(4)
    cells = rng.integers(-50, 50, (40, 5)).astype(np.int32)
    row = {"label": 1, "low": cells.min(axis=0).tobytes(), "high": cells.max(axis=0).tobytes()}
    shelf = hard_negatives.Shelf([row], 5)
    for own in rng.integers(-50, 50, (30, 5)).astype(np.int32):
        scores = cells.astype(np.int64) @ own
        for least, most in ((scores.max(), 10**6), (-(10**6), scores.min()), (scores.max() + 10**6, 10**7)):
            asked = {"row": 1, "label": 2, "cells": own.tobytes(), "least": [least], "most": [most]}
            must = hard_negatives.Anchors([asked], 5, False).must_read(shelf)
            assert must.item() == (least <= scores.max() + 10**5)

import random

import pytest
from pyspark.sql import functions as F

from callsieve.ml.split import split_point, with_exact_part
from callsieve.operators.history import collect_history, variant_history, variant_rows
from callsieve.sources.tables import rows_to_frame


@pytest.mark.parametrize("fraction", [0.0, 0.1, 0.333, 0.9999, 1.0])
@pytest.mark.parametrize("accuracy", [20, 10_000])
def test_each_class_gets_its_share_to_the_row(spark, fraction, accuracy):
    draw = random.Random(1)
    data = [(draw.randrange(800), draw.choice(["a", "a", "a", "b", None])) for _ in range(3000)]
    data += [(None, "a"), (None, None), (5, "alone"), (7, "two"), (7, "two")]
    frame = spark.createDataFrame(data, "id long, kind string").repartition(4)
    found = with_exact_part(frame, "id", "kind", fraction, accuracy=accuracy).collect()
    assert sorted(map(str, ((r["id"], r["kind"]) for r in found))) == sorted(map(str, data))
    points = {r["id"]: r["p"] for r in spark.range(800).select("id", split_point(F.col("id")).alias("p")).collect()}
    for kind in {k for _, k in data}:
        own = sorted((points.get(i, 1.0), i is None, i) for i, k in data if k == kind)
        wanted = int(len(own) * fraction + 0.5)
        chosen = sorted((points.get(r["id"], 1.0), r["id"] is None, r["id"]) for r in found if r["kind"] == kind and r["part"] == "test")
        assert chosen == own[:wanted]


def test_many_rows(spark):
    frame = spark.range(200_000).selectExpr("id", "id % 2 as kind")
    counts = with_exact_part(frame, "id", "kind", 0.1).filter("part = 'test'").groupBy("kind").count().collect()
    assert {r["kind"]: r["count"] for r in counts} == {0: 10_000, 1: 10_000}


def test_empty_tables_and_working_names(spark):
    assert with_exact_part(spark.createDataFrame([], "id long, kind string"), "id", "kind", 0.1).count() == 0
    with pytest.raises(ValueError, match="rename"):
        with_exact_part(spark.createDataFrame([(1, 2)], "id long, PART int"), "id", "PART", 0.1)


def test_variant_histories_give_the_calls_back(spark, tmp_path):
    calls = [("100", "204", "call_dst", 1, 2, "17", 3), ("101", None, "call_src", 2, 2, "3", 22), ("101", "205", None, 2, None, "4", 23)]
    made = variant_history(collect_history(rows_to_frame(spark, calls)))
    assert dict(made.dtypes)["calls"] == "variant"
    for shredded in ("true", "false"):
        spark.conf.set("spark.sql.variant.writeShredding.enabled", shredded)
        try:
            made.write.parquet(str(tmp_path / shredded))
        finally:
            spark.conf.unset("spark.sql.variant.writeShredding.enabled")
        fields = {"phone2": "string", "phone2_type": "int", "callDuration": "string", "nowhere": "int"}
        found = variant_rows(spark.read.parquet(str(tmp_path / shredded)), fields).collect()
        assert sorted((r["phone1"], r["phone2"] or "", r["phone2_type"] or -1, r["callDuration"]) for r in found) == sorted(
            (c[0], c[1] or "", -1 if c[4] is None else c[4], c[5]) for c in calls
        )
        assert all(r["nowhere"] is None for r in found)

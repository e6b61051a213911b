import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F, types as T

from callsieve.functions import arrays, casts, python_udfs, text

# What a non-ANSI cast from text to bigint gives.
CASTS = [
    (None, None), ("", None), (" ", None), ("abc", None), ("12", 12), (" 12 ", 12), ("-12", -12), ("+12", 12),
    ("12.7", 12), ("-12.7", -12), (" 12.7 ", 12), ("12.", 12), (".5", 0), ("-.5", 0), (".", 0), ("12.9999999", 12),
    ("1e3", None), ("1.5e3", None), ("12.7.1", None), ("12.7abc", None), ("1 2", None), ("-", None), ("+", None),
    ("9223372036854775807", 9223372036854775807), ("9223372036854775808", None),
    ("-9223372036854775808", -9223372036854775808), ("9223372036854775807.9", 9223372036854775807),
    ("\t12\n", 12), ("\x0112.5\x7f", 12), ("12\n\n", 12), ("1\n2", None), ("12 .5", None), ("12. 5", None),
    ("-.", 0), (" .5 ", 0), ("..5", None), ("\u00a012", None), ("\u0661\u0662", None), ("+-1", None), ("1,000", None),
    ("0012", 12), ("0x10", None), ("NaN", None), ("12L", None),
]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_lenient_bigint(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        frame = spark.createDataFrame(CASTS, "txt string, expected bigint").repartition(2)
        made = frame.withColumn("made", casts.lenient_bigint(F.col("txt")))
        assert [r for r in made.collect() if r["made"] != r["expected"]] == []
        if ansi == "false":
            plain = frame.withColumn("made", F.col("txt").cast("bigint"))
            assert [r for r in plain.collect() if r["made"] != r["expected"]] == []
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_replace_all(spark):
    frame = spark.createDataFrame([("List(a, List(b)) (c)",), (None,)], "txt string")
    assert [r[0] for r in frame.select(text.replace_all(F.col("txt"))).collect()] == ["[a, [b]] [c]", None]


def test_nested_json_keeps_quotes_nulls_and_leading_zeros(spark):
    frame = spark.createDataFrame(
        [([("085", None, 1), ("List(1)", "b", 2)],)], "calls array<struct<a: string, b: string, c: int>>"
    )
    assert frame.select(text.nested_json(F.col("calls"))).first()[0] == (
        '[{"a":"085","b":null,"c":1},{"a":"List(1)","b":"b","c":2}]'
    )


def test_matrix_functions(spark):
    values = [1.0, 2.1, 3.3, 4.5, 5.6, 6.7]
    frame = spark.createDataFrame([(values, 2), (values[:5], 0), (None, None)], "v array<float>, label int")
    reshaped = frame.select(arrays.reshape(F.col("v"), 3, 2).alias("m"))
    as_float = [float(np.float32(v)) for v in values]
    assert [r["m"] for r in reshaped.collect()] == [[as_float[0:2], as_float[2:4], as_float[4:6]], None, None]
    assert reshaped.select(arrays.flatten_matrix(F.col("m"))).first()[0] == as_float
    hot = frame.select(arrays.one_hot(F.col("label"), 3).alias("h"))
    assert [r["h"] for r in hot.collect()] == [[0.0, 0.0, 1.0], [1.0, 0.0, 0.0], None]
    assert hot.select(arrays.class_index(F.col("h"))).first()[0] == 2.0


def test_labels_and_their_arrays(spark):
    frame = spark.createDataFrame([([0.0, 0.0],), (None,), ([0.2, 0.7],), ([-1.0, -0.5],)], "h array<double>")
    assert [r[0] for r in frame.select(arrays.class_index(F.col("h"))).collect()] == [None, None, 1.0, None]
    for wrong in (3, -1, 2.7, float("nan")):
        with pytest.raises(Exception, match="labels must be in 0..2"):
            spark.createDataFrame([(float(wrong),)], "l double").select(arrays.one_hot(F.col("l"), 3)).collect()


def test_scale_is_32_bit_division(spark):
    pixels = list(range(256))
    frame = spark.createDataFrame([(pixels,)], "v array<int>")
    scaled = frame.select(arrays.scale(F.col("v"), 255.0).alias("s"))
    assert scaled.schema["s"].dataType == T.ArrayType(T.FloatType())
    assert np.array_equal(
        np.array(scaled.first()["s"], np.float32), np.array(pixels, np.float32) / np.float32(255)
    )


def test_python_functions(spark, tmp_path):
    module = tmp_path / "user_scores.py"
    module.write_text("def add(a, b):\n    return a + b\n")
    frame = spark.createDataFrame([(2, 3), (4, 5)], "a int, b int")

    add = python_udfs.module_function(spark, str(module), "add", "long")
    assert [r[0] for r in frame.select(add("a", "b")).collect()] == [5, 9]

    twice = python_udfs.batch_function(lambda a: a * 2, "long")
    assert [r[0] for r in frame.select(twice("a")).collect()] == [4, 8]

    def add_in_sql(a: pd.Series, b: pd.Series) -> pd.Series:
        return a + b

    python_udfs.register_function(spark, "test_add", add_in_sql, "long")
    assert [r[0] for r in spark.sql("select test_add(a, b) from {f}", f=frame).collect()] == [5, 9]


def test_map_matrices(spark):
    values = [1.0, 2.1, 3.3, 4.5, 5.6, 6.7]
    frame = spark.createDataFrame(
        [(1, values), (2, None), (3, values[:4]), (4, values[::-1])], "id int, v array<float>"
    ).coalesce(1)
    made = python_udfs.map_matrices(
        frame, "v", (3, 2), lambda m: m.sum(axis=2), "row_sums"
    )
    assert made.columns == ["id", "row_sums"]
    found = {r["id"]: r["row_sums"] for r in made.collect()}
    assert found[1] == pytest.approx([3.1, 7.8, 12.3], rel=1e-6)
    assert found[4] == pytest.approx([12.3, 7.8, 3.1], rel=1e-6)
    assert found[2] is None and found[3] is None
    empty = python_udfs.map_matrices(frame.filter("id > 9"), "v", (3, 2), lambda m: m.sum(axis=2), "s")
    assert empty.count() == 0

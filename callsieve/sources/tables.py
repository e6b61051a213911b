"""Table and literal sources."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

CALL_SCHEMA = T.StructType(
    [
        T.StructField("phone1", T.StringType()),
        T.StructField("phone2", T.StringType()),
        T.StructField("call_event", T.StringType()),
        T.StructField("phone1_type", T.IntegerType()),
        T.StructField("phone2_type", T.IntegerType()),
        T.StructField("callDuration", T.StringType()),
        T.StructField("hours", T.IntegerType()),
    ]
)

# Column names of the call-leg table, misspellings included.
LEG_SCHEMA = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in (
            "calling_number",
            "called_number",
            "calling_operator",
            "calling_location",
            "called_operator",
            "called_localion",
            "calling_countryname",
            "calling_provincename",
            "calling_cityname",
            "btime",
            "protocolid",
            "call_duration",
            "answerdur",
            "callid",
            "dest_ne_ip",
            "mathch_fraud_pattern",
            "mathch_white_pattern",
        )
    ]
    + [T.StructField("_add_day", T.IntegerType())]
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rows_to_frame(
    spark: SparkSession, rows: Iterable[Sequence], schema: T.StructType = CALL_SCHEMA
) -> DataFrame:
    """A DataFrame from driver-side tuples, with the types declared rather than inferred."""
    return spark.createDataFrame([tuple(row) for row in rows], schema)


def typed_fields(schema: T.StructType) -> list[Column]:
    """Each field of `schema` taken by name and cast to its declared type."""
    return [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]

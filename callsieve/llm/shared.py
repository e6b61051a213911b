"""Small helpers of the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from callsieve.operators.checkpoints import BROADCAST_BYTES, size_in_bytes, use_checkpoint_dir

# One word: a run of bytes that are no ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
# Rows a file, where the number of rows is known beforehand: of links or names, and of texts.
FILE_ROWS, FILE_TEXTS = 10_000, 1_000
# Parts whose counts one window of `first_numbers` adds up.
PARTS_AT_ONCE = 4096


def stored(df: DataFrame, most: int | None = None, file_rows: int = FILE_ROWS) -> DataFrame:
    """`df` written once as Parquet to a new folder in the checkpoint folder, and read again.

    The table cuts lineage: a lost executor costs a re-read, not a recomputation, and columns that a
    later step does not use are not read. With `most`, the number of rows that `df` has at most, there is a
    file for each `file_rows` of these, or fewer: on local disks every file of its own takes processes of its own (Hadoop's
    `chmod`), each of which for a moment adds to what its executor takes.
    """
    spark = df.sparkSession
    if most is not None:
        df = df.coalesce(max(1, -(-most // file_rows)))
    use_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def first_numbers(counts: DataFrame) -> DataFrame:
    """`part, length, first` from `part, length, n`, stored: how many rows come before a part's rows of a length.

    Longer lengths come first, and within one the parts in order. Counts are added up in runs of `PARTS_AT_ONCE`
    parts; only the sums of the runs, one for each run and length, go through one task.
    """
    runs = counts.withColumn("run", F.floor(F.col("part") / PARTS_AT_ONCE))
    within = Window.partitionBy("length", "run").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.orderBy(F.col("length").desc(), "run").rowsBetween(Window.unboundedPreceding, -1)
    sums = runs.groupBy("length", "run").agg(F.sum("n").alias("all"))
    sums = sums.select("length", "run", F.coalesce(F.sum("all").over(across), F.lit(0)).alias("before"))
    own = runs.withColumn("own", F.coalesce(F.sum("n").over(within), F.lit(0)))
    return stored(own.join(sums, ["length", "run"]).select("part", "length", (F.col("before") + F.col("own")).alias("first")))


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """`df` with a broadcast hint if its measured size allows it; otherwise as it is, for a shuffled join."""
    return F.broadcast(df) if size_in_bytes(df) <= BROADCAST_BYTES else df


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for working columns that no column of `df` has, whatever the case."""
    taken = {c.lower() for c in df.columns}
    made = []
    for name in names:
        while name.lower() in taken:
            name = f"{name}_"
        taken.add(name.lower())
        made.append(name)
    return made


def plain_names(df: DataFrame, *used: str) -> list[str]:
    """Names for the columns of `df` that clash with nothing; only the `used` columns keep theirs."""
    return [c if c in used else f"_column_{i}" for i, c in enumerate(df.columns)]


def named_as(df: DataFrame, names: list[str], like: DataFrame) -> DataFrame:
    """The columns `names` of `df`, called as in `like`."""
    return df.select(*[F.col(n).alias(c) for n, c in zip(names, like.columns, strict=True)])


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")

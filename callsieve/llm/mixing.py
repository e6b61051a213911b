"""Mixing sources to target weights: whole repetitions plus one seeded draw per document."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from callsieve.llm.shared import broadcast_if_small, fresh, named_as, plain_names, word_count
from callsieve.operators.checkpoints import checkpointed

WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
DRAWS = 8


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = MAX_REPEATS) -> DataFrame:
    """Each source's share of all words: `source, source_size, target`, from rows of `source, size`.

    Sources take the weights in code-point order, null last, over and over. A target stops at `cap`
    times the source's size, and what is over is shared again by weight. That sharing ends at one
    level: every source gets weight * level or its cap. In the order of cap / weight, the level is the
    first one at which the next source stays below its cap. One row per source goes through the
    ordering; documents do not.
    """
    totals = checkpointed(sizes.groupBy("source").agg(F.sum("size").alias("source_size")))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    most = F.col("source_size") * cap
    ranked = totals.withColumn("weight", weight.cast("long")).withColumn("most", most)
    order = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = F.sum("source_size").over(Window.partitionBy())
    left = everything - F.coalesce(F.sum("most").over(before), F.lit(0))
    level = left.cast("double") / F.sum("weight").over(rest).cast("double")
    levels = ranked.withColumn("level", level)
    fits = F.when(F.col("level") * F.col("weight") <= F.col("most"), F.col("level"))
    final = F.max_by(fits, F.when(fits.isNotNull(), -F.col("most") / F.col("weight"))).over(Window.partitionBy())
    target = F.least(F.col("most").cast("double"), F.col("weight") * final)
    return levels.select("source", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def draw(number: int, *key: Column) -> Column:
    """A number in [0, 1) that depends on the key and on which draw it is, the same in every run."""
    text = F.concat_ws("|", F.lit(str(number // 4)), *key)
    part = F.substring(F.md5(text), 1 + 8 * (number % 4), 8)
    return F.conv(part, 16, 10).cast("double") / F.lit(4294967296.0)


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = MAX_REPEATS, draws: int = DRAWS) -> DataFrame:
    """`docs` with `size, source_size, target, copies`: how often the mix takes each document.

    A source's rate is target / size. A document is taken floor(rate) times, plus once more with
    probability rate - floor(rate). The draw is a hash of the document's id and text, so reruns agree and
    equal rows fare alike. `draws` independent draws are made for a source, and the one whose total is
    nearest to the target is used for all its documents. That takes one pass that keeps `draws` sums
    per source, so a few long documents do not carry a source far from its target.

    Null texts have size 0 and are taken by the same rule; a null source is a source of its own, the
    last one; a null id is an empty one. Sources without words have rate 0. Columns of `docs` that have
    one of the new names are replaced. An empty table stays empty.
    """
    made = ["size", "source_size", "target", "copies"]
    docs = docs.drop(*[c for c in docs.columns if c.lower() in made])
    owner, rate, chosen = fresh(docs, "_owner", "_rate", "_chosen")
    sized = docs.withColumn("size", word_count(F.col("text")))
    targets = checkpointed(source_targets(sized.select("source", "size"), weights, cap))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    targets = targets.withColumn(rate, ratio).withColumnRenamed("source", owner)

    key = (F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(F.coalesce("text", F.lit(""))))
    spare = F.col(rate) - F.floor(rate)

    def times(number: int) -> Column:
        return F.floor(rate) + F.when(draw(number, *key) < spare, 1).otherwise(0)

    same = F.col("source").eqNullSafe(F.col(owner))
    rows = sized.join(broadcast_if_small(targets), same)
    totals = rows.groupBy(owner, "target").agg(
        *[F.sum(F.col("size") * times(i)).cast("double").alias(f"taken_{i}") for i in range(draws)]
    )
    off = [F.abs(F.col(f"taken_{i}") - F.col("target")) for i in range(draws)]
    best = reduce(lambda found, i: F.when(off[i] == F.least(*off), i).otherwise(found), reversed(range(draws)), F.lit(0))
    best = totals.select(owner, (best if draws > 1 else F.lit(0)).alias(chosen))
    targets = checkpointed(
        targets.alias("t").join(best.alias("b"), F.col(f"t.{owner}").eqNullSafe(F.col(f"b.{owner}")), "left")
        .select("t.*", F.coalesce(chosen, F.lit(0)).alias(chosen))
    )
    copies = reduce(lambda found, i: F.when(F.col(chosen) == i, times(i)).otherwise(found), range(draws), F.lit(None))
    return (
        sized.join(broadcast_if_small(targets), same)
        .withColumn("copies", copies.cast("long"))
        .drop(owner, rate, chosen)
    )


def emitted(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: every row of `docs` as often as it is taken, with the columns of `docs`."""
    names = plain_names(docs, "doc_id", "source", "text")
    taken = mixed(docs.toDF(*names), **settings).filter(F.col("copies") > 0)
    (copy,) = fresh(taken, "_copy")
    again = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias(copy)
    return named_as(taken.select(*names, again), names, docs)

"""Language identification by error-correcting output codes over byte n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from callsieve.llm.shared import broadcast_if_small, stored
from callsieve.llm.words import text_slices
from callsieve.operators.checkpoints import checkpointed
from callsieve.shipping import ship_package

# Distinct texts of each language that a model is fitted on, at most; all of them if there are fewer.
TEXTS_PER_LANGUAGE = 5_000
BUCKETS = 1 << 16
SMOOTHING = 0.5
UNKNOWN = "und"
# A text is ambiguous if its second language scores at least this share of the first one's score.
AMBIGUOUS = 0.5
SHARPNESS = 2.0
CONTRAST = 6.0
# N-grams without evidence that are added to every text, so that a few letters do not look certain.
PRIOR_GRAMS = 20
SEED = 11

PREDICTIONS = "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean"


def letters_lut() -> np.ndarray:
    """Bytes other than ASCII letters and parts of longer characters become one and the same byte."""
    lut = np.full(256, 32, np.uint8)
    keep = np.r_[97:123, 128:256]
    lut[keep] = keep
    return lut


LUT = letters_lut()


def grams(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A bucket for the three bytes that start at each byte, each text read as if two blanks followed it.

    `bounds` are where the texts start and the last one ends.
    """
    data = LUT[data].astype(np.uint32)
    padded = np.append(data, np.uint32([32, 32]))
    second, third = padded[1:-1].copy(), padded[2:].copy()
    for back, after in ((1, (second, third)), (2, (third,))):
        at = bounds[1:] - back
        at = at[at >= bounds[:-1]]
        for following in after:
            following[at] = 32
    code = (data << np.uint32(16)) | (second << np.uint32(8)) | third
    return ((code * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int64)


def lowered(texts: pa.Array) -> pa.Array:
    return pa.array([t.lower() if t else "" for t in texts.to_pylist()], pa.large_string())


def codewords(n: int, seed: int = SEED) -> np.ndarray:
    """A row of +1 and -1 for each of n languages.

    Up to seven languages get every way of parting them in two, so rows differ in over half of the
    bits. More get the random rows, of 15 bits per doubling of n, whose closest pair is farthest apart.
    """
    if n <= 7:
        columns = [(1, *rest) for rest in product((1, -1), repeat=max(n - 1, 0)) if -1 in rest]
        return np.array(columns, np.int8).reshape(-1, n).T
    width = 15 * int(np.ceil(np.log2(n)))
    random = np.random.default_rng(seed)
    tries = [random.choice(np.array([-1, 1], np.int8), (n, width)) for _ in range(50)]

    def closest(rows: np.ndarray) -> int:
        same = rows.astype(np.int32) @ rows.T.astype(np.int32)
        np.fill_diagonal(same, -width)
        return -int(same.max())

    return max(tries, key=closest)


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # buckets x bits
    trust: np.ndarray  # languages x bits: how far each bit is trusted for a language; rows sum to 1


def margins(texts: pa.Array, weights: np.ndarray) -> np.ndarray:
    """For each text and bit, the mean log-odds of the text's n-grams."""
    out = np.zeros((len(texts), weights.shape[1]), np.float32)
    for first, data, bounds in text_slices(lowered(texts)):
        if not len(data):
            continue
        totals = np.zeros((len(data) + 1, weights.shape[1]))
        np.cumsum(weights[grams(data, bounds)], axis=0, out=totals[1:])
        long = np.diff(bounds) + PRIOR_GRAMS
        out[first : first + len(long)] = (totals[bounds[1:]] - totals[bounds[:-1]]) / long[:, None]
    return out


def losses(found: np.ndarray, model: Model) -> np.ndarray:
    """Each language's loss: the logistic loss of every bit against its codeword, weighted by trust."""
    agree = model.code[None, :, :] * found[:, None, :]
    return (model.trust[None, :, :] * np.logaddexp(0, -SHARPNESS * agree)).sum(axis=2)


def training_texts(docs: DataFrame, per_language: int) -> DataFrame:
    """`lang, text` of up to `per_language` distinct texts of every language: those with the smallest hashes.

    A first pass counts, roughly, each language's distinct texts; that gives each language's share of all hashes, with
    some to spare. So a rare language is taken whole, copies count once, and what is kept is bounded for any table.
    """
    labelled = docs.filter(F.col("lang").isNotNull() & (F.length("text") > 0)).select("lang", "text")
    hash_ = F.xxhash64("text").bitwiseAND(F.lit((1 << 62) - 1))
    sizes = labelled.groupBy(F.col("lang").alias("own")).agg(F.approx_count_distinct(hash_).alias("n"))
    wanted = per_language + 8 * per_language**0.5 + 16
    share = F.least(F.lit(1.0), F.lit(wanted * 1.2) / F.col("n")) * float(1 << 62)
    sizes = checkpointed(sizes.select("own", share.alias("below")))
    near = labelled.withColumn("hash", hash_).join(broadcast_if_small(sizes), F.col("lang") == F.col("own"))
    near = near.filter(F.col("hash") <= F.col("below")).groupBy("lang", "hash").agg(F.first("text").alias("text"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("hash"))
    return stored(near.withColumn("place", place).filter(F.col("place") <= per_language).select("lang", "text"))


def fit(docs: DataFrame, per_language: int = TEXTS_PER_LANGUAGE) -> Model | None:
    """A model from `per_language` texts at most of every language in `docs`, None if no row has a language and a text.

    The texts are a sample by hash (`training_texts`), so the model does not grow with the table. Tasks count
    n-grams per language; the driver gets at most 65,536 sums per language. Each bit is a naive Bayes
    classifier between the languages on its two sides, all languages weighing the same. A second pass over
    the sample finds how often each bit is right for each language: that is its weight in decoding.
    """
    ship_package(docs.sparkSession)
    sample = training_texts(docs, per_language)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            for lang in set(langs):
                own = totals.setdefault(lang, np.zeros(BUCKETS, np.int64))
                for _, data, bounds in text_slices(lowered(batch.column(1).filter(pa.array(langs == lang)))):
                    own += np.bincount(grams(data, bounds), minlength=BUCKETS)
        for lang, own in totals.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at)), pa.array(at), pa.array(own[at])], ["lang", "bucket", "n"]
            )

    counts = sample.mapInArrow(counted, "lang string, bucket long, n long")
    rows = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    if not rows.num_rows:
        return None
    names = np.array(rows["lang"].to_pylist(), object)
    languages = sorted(set(names))
    table = np.zeros((len(languages), BUCKETS))
    table[[languages.index(x) for x in names], rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    share = (table + SMOOTHING) / (table.sum(axis=1, keepdims=True) + SMOOTHING * BUCKETS)
    code = codewords(len(languages))
    sides = [[share[code[:, b] == side].mean(axis=0) for side in (1, -1)] for b in range(code.shape[1])]
    weights = np.array([np.log(yes / no) for yes, no in sides], np.float32).reshape(-1, BUCKETS).T.copy()

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        right, seen = np.zeros(code.shape), np.zeros(len(languages))
        for batch in batches:
            own = np.array([languages.index(x) for x in batch.column(0).to_pylist()], int)
            good = margins(batch.column(1), weights) * code[own] > 0
            np.add.at(right, own, good)
            np.add.at(seen, own, 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(languages))), pa.array(list(right), pa.list_(pa.float64())), pa.array(seen)],
            ["lang", "right", "seen"],
        )

    trust = np.ones(code.shape)
    seen = np.ones(len(languages))
    sums = sample.mapInArrow(judged, "lang long, right array<double>, seen double").groupBy("lang").agg(
        F.sum("seen").alias("seen"),
        *[F.sum(F.col("right")[b]).alias(f"b{b}") for b in range(code.shape[1])],
    )
    for row in sums.collect():
        trust[row["lang"]] += [row[f"b{b}"] for b in range(code.shape[1])]
        seen[row["lang"]] += row["seen"]
    trust /= seen[:, None]
    return Model(languages, code, weights, trust / np.maximum(trust.sum(axis=1, keepdims=True), 1e-12))


def decoded(texts: pa.Array, model: Model | None) -> tuple[list[str], np.ndarray, np.ndarray]:
    """For each text: its language, a score of 0 to 1, and whether a second language is as likely."""
    some = np.array([bool(t) and any(map(str.isalpha, t)) for t in texts.to_pylist()], bool)
    if model is None or not len(texts):
        return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
    if len(model.languages) == 1:
        return [model.languages[0] if s else UNKNOWN for s in some], some.astype(float), np.zeros(len(texts), bool)
    loss = losses(margins(texts, model.weights), model)
    best = loss.argmin(axis=1)
    odds = np.exp(-CONTRAST * (loss - loss.min(axis=1, keepdims=True)))
    score = np.where(some, 1 / odds.sum(axis=1), 0.0)
    close = some & (np.sort(odds, axis=1)[:, -2] >= AMBIGUOUS)
    return [model.languages[b] if s else UNKNOWN for b, s in zip(best, some, strict=True)], score, close


def held_out(doc_id: Column) -> Column:
    """One document in four, by its id. A null id is not held out, and not learned from either."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def predicted(docs: DataFrame, model: Model | None) -> DataFrame:
    """`doc_id, held_out, lang_pred, score, ambiguous` for every row of `docs`, from its text alone.

    A null text, or one without a letter, is `und` with score 0; so is every text if there is no model.
    Texts are read whole, and each on its own: nothing is shuffled. Other columns are not used.
    """
    names = [f.split()[0] for f in PREDICTIONS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, score, close = decoded(batch.column(2), model)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(langs, pa.string()), pa.array(score), pa.array(close)], names
            )

    ids = F.col("doc_id").cast("long").alias("doc_id")
    return docs.select(ids, held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(run, PREDICTIONS)


def identified(docs: DataFrame, per_language: int = TEXTS_PER_LANGUAGE) -> DataFrame:
    """Learn from the documents that are not held out, then predict all of them."""
    known = docs.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    return predicted(docs, fit(known, per_language))

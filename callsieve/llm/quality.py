"""Quality rules: counts of a text's words and lines, and its repeats by a suffix array of words."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from callsieve.llm.shared import fresh
from callsieve.llm.words import Words, find_words, give_back_memory, powers, text_slices, window_hashes
from callsieve.shipping import ship_package

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
# A repeat counts from this many words on; shorter ones are everyday phrases.
MIN_REPEAT = 8
MAX_COVERED_PERCENT = 40
MAX_LONGEST = 100
SYMBOLS = b"#*$%&|<>"

MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "covered_words long, longest_repeat long"
)


def suffix_order(words: Words) -> np.ndarray:
    """The suffix array of every text, one text after the other: suffixes of words, in order.

    A word is compared by its hash, which is an order of the alphabet like any other. Ranks of the
    first 1, 2, 4, ... words are refined until no two suffixes of a text tie; settled ones drop out.
    """
    n = len(words.hashes)
    doc = words.doc()
    end = words.first[1:][doc]
    place = np.arange(n)
    order = np.lexsort((words.hashes, doc))
    new = np.ones(n, bool)
    new[1:] = (words.hashes[order[1:]] != words.hashes[order[:-1]]) | (doc[order[1:]] != doc[order[:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, place, 0))
    tied = order[~(new & np.append(new[1:], True))]
    width = 1
    while len(tied):
        follows = tied + width
        key = np.where(follows < end[tied], rank[np.minimum(follows, n - 1)], -1)
        by = np.lexsort((key, rank[tied]))
        tied, key = tied[by], key[by]
        old = rank[tied]
        group = np.ones(len(tied), bool)
        group[1:] = old[1:] != old[:-1]
        new = group.copy()
        new[1:] |= key[1:] != key[:-1]
        place = np.arange(len(tied))
        first = np.maximum.accumulate(np.where(group, place, 0))
        rank[tied] = old + np.maximum.accumulate(np.where(new, place, 0)) - first
        tied = tied[~(new & np.append(new[1:], True))]
        width *= 2
    suffixes = np.empty(n, np.int64)
    suffixes[rank] = np.arange(n)
    return suffixes


def common_words(words: Words, suffixes: np.ndarray, least: int) -> np.ndarray:
    """How many words each suffix shares with the one before it in the array, 0 if under `least`."""
    windows, fits = window_hashes(words, least)
    doc = words.doc()
    windows, fits = windows[suffixes], fits[suffixes]
    near = fits[1:] & fits[:-1] & (windows[1:] == windows[:-1])
    at = 1 + np.flatnonzero(near & (doc[suffixes[1:]] == doc[suffixes[:-1]]))
    left, right = suffixes[at - 1], suffixes[at]
    sums = np.zeros(len(words.hashes) + 1, np.uint64)
    np.cumsum(words.hashes * powers(len(words.hashes)), out=sums[1:])
    back = powers(len(sums), inverse=True)
    end = words.first[1:][doc[left]]
    low, high = np.full(len(at), least), np.minimum(end - left, end - right)
    while (low < high).any():
        middle = (low + high + 1) // 2
        equal = (sums[left + middle] - sums[left]) * back[left] == (sums[right + middle] - sums[right]) * back[right]
        low, high = np.where(equal, middle, low), np.where(equal, high, middle - 1)
    common = np.zeros(len(suffixes), np.int64)
    common[at] = low
    return common


def repeat_measures(words: Words, least: int = MIN_REPEAT) -> tuple[np.ndarray, np.ndarray]:
    """For each text: words covered by repeats of `least` words or more, and the longest repeat.

    Between neighbours of the suffix array, the larger of a suffix's two common prefixes is its longest
    repeat: the deepest common-prefix interval that it lies in. Repeats that another one extends
    to the left lie inside that one's span, so the union over all suffixes is that over all maximal
    repeats.
    """
    n_texts = len(words.first) - 1
    at = suffix_order(words)
    common = common_words(words, at, least)
    reach = common.copy()
    reach[:-1] = np.maximum(reach[:-1], common[1:])
    change = np.zeros(len(words.hashes) + 1, np.int64)
    at, reach = at[reach > 0], reach[reach > 0]
    np.add.at(change, at, 1)
    np.add.at(change, at + reach, -1)
    covered = np.zeros(len(words.hashes) + 1, np.int64)
    np.cumsum(np.cumsum(change[:-1]) > 0, out=covered[1:])
    longest = np.zeros(n_texts, np.int64)
    np.maximum.at(longest, words.doc()[at], reach)
    return covered[words.first[1:]] - covered[words.first[:-1]], longest


def repeated_words(words: Words, width: int = 3) -> np.ndarray:
    """For each text: words that lie in a window of `width` words found twice or more in the text."""
    hashes, fits = window_hashes(words, width)
    doc = words.doc()
    at = np.flatnonzero(fits)
    order = at[np.lexsort((hashes[at], doc[at]))]
    same = np.zeros(len(order) + 1, bool)
    same[1:-1] = (hashes[order[1:]] == hashes[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]])
    twice = order[same[1:] | same[:-1]]
    inside = np.zeros(len(words.hashes) + 1, np.int64)
    for k in range(width):
        inside[twice + k] = 1
    total = np.zeros(len(inside), np.int64)
    np.cumsum(inside[:-1], out=total[1:])
    return total[words.first[1:]] - total[words.first[:-1]]


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip(b" \t\n\v\f\r")]
    return len(lines) - len(set(lines))


def text_measures(texts: pa.Array) -> list[np.ndarray]:
    """The columns of MEASURES for a column of texts."""
    found = []
    for _, data, bounds in text_slices(texts):
        words = find_words(data, bounds)
        raw = data.tobytes()
        # A byte that does not continue a character starts one; white space is one byte a character.
        chars = np.zeros(len(data) + 1, np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=chars[1:])
        solid = np.zeros(len(words.starts) + 1, np.int64)
        np.cumsum(chars[words.ends] - chars[words.starts], out=solid[1:])
        symbols = np.zeros(len(data) + 1, np.int64)
        np.cumsum(np.isin(data, np.frombuffer(SYMBOLS, np.uint8)), out=symbols[1:])
        covered, longest = repeat_measures(words)
        found.append(
            (
                words.counts,
                solid[words.first[1:]] - solid[words.first[:-1]],
                symbols[bounds[1:]] - symbols[bounds[:-1]],
                np.array([duplicate_lines(raw[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)], np.int64),
                repeated_words(words),
                covered,
                longest,
            )
        )
    return [np.concatenate(column) for column in zip(*found, strict=True)]


def measured(docs: DataFrame) -> DataFrame:
    """`docs` with the columns of MEASURES; a column of `docs` with such a name is replaced.

    A null text has no words. Each text is measured whole and by itself: nothing is shuffled, and a
    task holds a few megabytes of text at a time, or one text.
    """
    ship_package(docs.sparkSession)
    names = [f.split()[0] for f in MEASURES.split(", ")]
    docs = docs.drop(*[c for c in docs.columns if c.lower() in names])

    def measure(texts: pa.Array) -> pa.Array:
        columns = text_measures(texts) if len(texts) else [()] * len(names)
        give_back_memory()
        return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    # Only texts go to Python and only figures come back; the other columns stay where they are.
    (made,) = fresh(docs, "_measures")
    found = docs.withColumn(made, F.arrow_udf(measure, MEASURES)("text"))
    return found.select(*[F.col(f"`{c}`") for c in docs.columns], *[F.col(f"{made}.{name}") for name in names])


def judged(docs: DataFrame) -> DataFrame:
    """`measured`, with `base_failed` and `kept`.

    A text fails the base rules with under 50 words, or with over half of them in repeated three-word
    windows. It is also rejected if repeats of 8 words or more cover over 40 % of its words, or if its
    longest repeat has over 100 words.
    """
    docs = docs.drop(*[c for c in docs.columns if c.lower() in ("base_failed", "kept")])
    failed = (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED_PERCENT
    )
    good = (F.col("covered_words") * 100 <= F.col("n_words") * MAX_COVERED_PERCENT) & (
        F.col("longest_repeat") <= MAX_LONGEST
    )
    return measured(docs).withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & good)

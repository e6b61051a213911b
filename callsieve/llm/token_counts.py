"""Token counts of every prefix by dynamic programming over the vocabulary."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, functions as F

from callsieve.llm.shared import stored
from callsieve.shipping import ship_package

MODEL = "piece_bpe_32k.model"
BUDGET = 4096
SPACE = "▁"  # how the library writes a space
UNITS = re.compile("▁*[^▁\n]+|▁+|\n")
CACHE_UNITS = 600_000
CACHED_LENGTH = 64  # longer units hardly come again, and their counts would fill the memory
OUT_BYTES = 8 << 20
NORMAL = 1


class PrefixCounter:
    """Exact token counts of prefixes for one vocabulary.

    The tokens of a prefix are those of a shorter prefix and one more token, and just one last token is
    possible: the one whose pair with the token before it is left apart by the merge rules. So
    one pass from left to right, which keeps the last token and the count for each prefix, gives
    the count of every prefix. A space or line end is never joined to what stands before it, so texts fall
    into units that are counted once and remembered.
    """

    def __init__(self, path: str):
        library = sentencepiece.SentencePieceProcessor(model_file=path)
        size = range(library.get_piece_size())
        skipped = {i for i in size if library.is_control(i) or library.is_unknown(i) or library.is_byte(i)}
        pieces = {library.id_to_piece(i): library.get_score(i) for i in size if i not in skipped}
        if any(SPACE in p.lstrip(SPACE) or "\n" in p for p in pieces):
            raise ValueError("this vocabulary joins a space or line end to what stands before it")
        lengths = sorted((len(p) for p in pieces if not p.strip(SPACE)), reverse=True)
        self.longest_run = lengths[0]
        self.rest_of_run = np.array([self.greedy(k, lengths) for k in range(self.longest_run)])
        self.scores = pieces
        runs = range(1, 3 * self.longest_run)
        if any(len(self.merged(SPACE * k)) != self.run_tokens(np.array([k]))[0] for k in runs):
            raise ValueError("this vocabulary does not join runs of spaces from the longest piece down")
        self.scores = {p: s for p, s in pieces.items() if not p.startswith(SPACE * 2)}
        self.made: dict[str, tuple[float, str, str]] = {}
        self.tokens = {p for p in self.scores if self.is_reached(p)}
        self.backwards = self.backward_trie()
        self.pairs: dict[str, dict[str, bool]] = {}  # by the left and the right token
        self.n_pairs = 0
        self.units: dict[str, bytes] = {}
        self.totals: dict[str, int] = {}

    def backward_trie(self) -> dict:
        """All tokens from their last character to their first, as nested dicts; a token ends under ""."""
        trie: dict = {}
        for token in self.tokens:
            node = trie
            for character in reversed(token):
                node = node.setdefault(character, {})
            node[""] = token
        return trie

    def is_reached(self, piece: str) -> bool:
        """Whether the merge rules give this piece for its own text; keeps the last merge that makes it."""
        if len(piece) == 1:
            return True
        parts, before = list(piece), []
        while len(parts) > 1 and (at := self.best_pair(parts)) is not None:
            before = parts[at : at + 2]
            parts[at : at + 2] = ["".join(before)]
        if len(parts) == 1:
            self.made[piece] = (-self.scores[piece], *before)
        return len(parts) == 1

    def best_pair(self, parts: list[str]) -> int | None:
        """Where the merge rules join next: the best-scored pair, the leftmost of equals."""
        found = [
            (-self.scores[both], i) for i in range(len(parts) - 1) if (both := parts[i] + parts[i + 1]) in self.scores
        ]
        return min(found)[1] if found else None

    @staticmethod
    def greedy(spaces: int, lengths: list[int]) -> int:
        tokens = 0
        for length in lengths:
            tokens, spaces = tokens + spaces // length, spaces % length
        return tokens

    def run_tokens(self, spaces: np.ndarray) -> np.ndarray:
        """How many tokens runs of spaces take."""
        return spaces // self.longest_run + self.rest_of_run[spaces % self.longest_run]

    def merged(self, text: str) -> list[str]:
        """The merge rules themselves, for short texts."""
        parts = list(text)
        while (at := self.best_pair(parts)) is not None:
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def apart(self, left: str, right: str) -> bool:
        """Whether the merge rules leave these two tokens side by side.

        Goes back through the merges that made them, the latest first, and asks at each step whether the
        two parts then at the border would have been joined before that merge. Of merges of equal score the
        left one comes first.
        """
        known = self.pairs.setdefault(left, {}).get(right)
        if known is not None:
            return known
        key, known = (left, right), True
        before, strict = float("inf"), True
        while True:
            score = self.scores.get(left + right)
            if score is not None and (-score < before or (not strict and -score == before)):
                known = False
                break
            a, b = self.made.get(left), self.made.get(right)
            if a is None and b is None:
                break
            if b is None or (a is not None and a[0] > b[0]):
                before, strict, left = a[0], True, a[2]
            else:
                before, strict, right = b[0], False, b[1]
        self.n_pairs += 1
        if self.n_pairs > 2 * CACHE_UNITS:
            self.n_pairs = 0
            for beside in self.pairs.values():
                beside.clear()
        self.pairs[key[0]][key[1]] = known
        return known

    def word(self, text: str) -> tuple[list[int], list[str]]:
        """For each prefix of a unit with at most one space in front: its count, and its last token."""
        counts, last, beside = [0], [""], [{}]  # `beside`: what is known of each last token's pairs
        trie, pairs, apart = self.backwards, self.pairs, self.apart
        for end in range(1, len(text) + 1):
            node, start = trie, end
            while start:
                start -= 1
                node = node.get(text[start])
                if node is None:
                    start = -1
                    break
                token = node.get("")
                if token is None:
                    continue
                if not start:
                    break
                known = beside[start].get(token)
                if known is None:
                    known = apart(last[start], token)
                if known:
                    break
            else:
                start = -1
            if start < 0:  # a character that is not in the vocabulary is written as its bytes
                token, start = text[end - 1], end - 1
                counts.append(counts[start] + len(token.encode(errors="surrogatepass")))
            else:
                counts.append(counts[start] + 1)
            last.append(token)
            beside.append(pairs.get(token) or pairs.setdefault(token, {}))
        return counts[1:], last[1:]

    def unit(self, text: str) -> bytes:
        """Counts of the prefixes of one unit, as unsigned ints: spaces and a word, only spaces, or a line end.

        Runs of spaces are joined after everything else, by the longest runs in the vocabulary. The last
        space belongs to the word if that takes it.
        """
        word = text.lstrip(SPACE)
        spaces = len(text) - len(word)
        if spaces <= 1 and word:
            made = array("I", self.word(text)[0]).tobytes()
        else:
            counts = self.run_tokens(np.arange(1, spaces + 1))
            if not spaces:
                counts = np.array(self.word(word)[0])
            elif word:
                found = np.array(self.word(SPACE + word)[0][1:])
                # The first token of a prefix is the space alone until some prefix takes it.
                alone = np.array([self.space_alone(SPACE + word[: i + 1]) for i in range(len(word))])
                before, joined = self.run_tokens(np.array([spaces - 1, spaces])) - [0, 1]
                counts = np.concatenate([counts, found + np.where(alone, joined, before)])
            made = counts.astype(np.uint32).tobytes()
        if len(self.units) > CACHE_UNITS:
            self.units.clear()
        if len(text) <= CACHED_LENGTH:
            self.units[text] = made
        return made

    def space_alone(self, text: str) -> bool:
        """Whether the tokens of a text with one leading space begin with the space itself."""
        _, last = self.word(text)
        end = len(text)
        while end - len(last[end - 1]) > 0:
            end -= len(last[end - 1])
        return last[end - 1] == SPACE

    def total(self, text: str) -> int:
        if not text:
            return 0
        pieces = UNITS.findall(SPACE + text.replace(" ", SPACE))
        totals = self.totals
        if len(totals) > CACHE_UNITS:
            totals.clear()
        for piece in set(pieces).difference(totals):
            spaces = len(piece) - len(piece.lstrip(SPACE))
            one = piece == "\n" or spaces == len(piece) or spaces > 1
            totals[piece] = int(np.frombuffer(self.unit(piece), np.uint32)[-1]) if one else self.word(piece)[0][-1]
        return sum(map(totals.__getitem__, pieces))

    def prefixes(self, text: str) -> np.ndarray:
        """The token count of each prefix of `text`, by code points, from the first character on."""
        if not text:
            return np.zeros(0, np.uint32)
        pieces = UNITS.findall(SPACE + text.replace(" ", SPACE))
        known, unit = self.units.get, self.unit
        counts = np.frombuffer(b"".join([known(p) or unit(p) for p in pieces]), np.uint32)
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        own = counts[np.cumsum(lengths) - 1]
        counts = counts + np.repeat(np.cumsum(own, dtype=np.uint32) - own, lengths)
        return counts[1:]  # without the space that the library puts in front


@lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def token_counts(docs: DataFrame, model: str | None = None, prefixes: bool = True) -> DataFrame:
    """`doc_id, n_bytes, n_tokens`, and with `prefixes` the token count of every prefix of the text.

    `prefix_tokens` holds one little-endian unsigned 32-bit number per code point; `tokens_within` and
    `prefix_within` answer from it, and `n_tokens` is its last one. A null text is an empty one with no tokens. Nothing is shuffled.
    Columns other than `doc_id` and `text` are not used.
    """
    ship_package(docs.sparkSession)
    schema = "doc_id long, n_bytes long, n_tokens long" + ", prefix_tokens binary" * prefixes
    types = [pa.int64(), pa.int64(), pa.int64()] + [pa.binary()] * prefixes
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counter(model or public_tokenizers.path(MODEL))
        for given in batches:
            rows, size = [], 0
            for doc_id, value in zip(given.column(0).to_pylist(), given.column(1), strict=True):
                text = value.as_py() or ""
                if prefixes:
                    made = counts.prefixes(text).astype("<u4").tobytes()
                    row = (doc_id, len(text.encode()), tokens_within(made, len(text)), made)
                    size += len(made)
                else:
                    row = (doc_id, len(text.encode()), counts.total(text))
                rows.append(row)
                if size > OUT_BYTES:
                    yield batch(rows)
                    rows, size = [], 0
            if rows:
                yield batch(rows)

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(zip(*rows, strict=True), types, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def last_count(prefix_tokens: Column) -> Column:
    """The last number of `prefix_tokens`, which is the whole text's token count; 0 for an empty text."""
    last = F.hex(F.substring(prefix_tokens, -4, 4))
    big_endian = F.concat(*[F.substring(last, at, 2) for at in (7, 5, 3, 1)])
    return F.when(F.octet_length(prefix_tokens) > 0, F.conv(big_endian, 16, 10).cast("long")).otherwise(F.lit(0))


def counted_table(docs: DataFrame, model: str | None = None) -> DataFrame:
    """The rows of `token_counts` with their prefix counts, written once to the checkpoint folder and read again."""
    return stored(token_counts(docs, model))


def over_limit(table: DataFrame, budget: int = BUDGET) -> DataFrame:
    """`doc_id, n_bytes, n_tokens, over_limit` from the prefix counts in `table`.

    A text is over the limit if its longest prefix is, which is `prefix_within` stopping short of its end.
    """
    n_tokens = last_count(F.col("prefix_tokens"))
    return table.select("doc_id", "n_bytes", n_tokens.alias("n_tokens"), (n_tokens > budget).alias("over_limit"))


def tokens_within(prefix_tokens: bytes, characters: int) -> int:
    """How many tokens the first `characters` code points take."""
    return int(np.frombuffer(prefix_tokens, "<u4")[characters - 1]) if characters else 0


def prefix_within(prefix_tokens: bytes, budget: int) -> int:
    """The longest prefix, in code points, that takes at most `budget` tokens."""
    fits = np.flatnonzero(np.frombuffer(prefix_tokens, "<u4") <= budget)
    return int(fits[-1]) + 1 if len(fits) else 0

import random
import re

import numpy as np
import pytest

from callsieve.llm import ngram_join

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < 3:
        return {tuple(words)} - {()}
    return {tuple(words[i : i + 3]) for i in range(len(words) - 2)}


def brute_force(docs):
    """doc_id -> (set size, smallest linked id), for rows of (doc_id, text)."""
    sets = [(i, shingles(t)) for i, t in docs]
    parent = {i: i for i, _ in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for k, (a, left) in enumerate(sets):
        for b, right in sets[:k]:
            if left and right and 100 * len(left & right) >= 90 * len(left | right):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (len(s), root(i)) for i, s in sets}


def found(docs):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.joined(docs).collect()}


def edited(draw, base, most):
    words = list(base)
    for _ in range(draw.randint(0, most)):
        at = draw.randrange(len(words))
        words[at : at + draw.randint(0, 2)] = [f"new{draw.random()}"] * draw.randint(0, 1)
    return " ".join(words)


@pytest.mark.parametrize("cell, block", [(ngram_join.CELL, ngram_join.BLOCK_SETS), (2, 16)])
def test_groups_of_near_copies(documents, monkeypatch, cell, block):
    """With small cells the comparison in blocks has to find what the hubs leave."""
    monkeypatch.setattr(ngram_join, "CELL", cell)
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", block)
    draw = random.Random(7)
    rows = []
    for group in range(4):
        base = [draw.choice("abcdefgh") + str(draw.randrange(9)) for _ in range((9, 30, 60, 150)[group])]
        rows += [(1000 * group + 500 - i, edited(draw, base, 4 + 2 * group)) for i in range(60)]
    rows += [(9000 + i, "the same passage in all of these texts and then " + " ".join(f"w{draw.random()}" for _ in range(i))) for i in range(60)]
    draw.shuffle(rows)
    assert found(documents(rows)) == brute_force(rows)


def test_small_alphabet(documents):
    """Few words, so that most shingles are frequent and places in the order are shared."""
    draw = random.Random(8)
    rows = [(i, " ".join(draw.choice("xyz") for _ in range(draw.randint(0, 14)))) for i in range(300)]
    assert found(documents(rows)) == brute_force(rows)


def test_at_the_limit(documents):
    words = [f"w{i}" for i in range(12)]
    rows = [(1, " ".join(words[:12])), (2, " ".join(words[:11])), (3, " ".join(words[:10])), (4, "w0 w1 W2")]
    assert found(documents(rows)) == brute_force(rows) == {1: (10, 1), 2: (9, 1), 3: (8, 3), 4: (1, 4)}


def test_short_and_odd_texts(documents):
    rows = [
        (9, "One"), (3, "ONE"), (5, "one two"), (7, None), (8, ""), (6, " \n"), (4, "À b"), (2, "à b"), (11, "a b c"),
        (10, "A  b\tc"),
    ]
    assert found(documents(rows)) == brute_force(rows)


def test_a_long_text(documents):
    words = [f"w{i}" for i in range(80_000)]
    rows = [(2, " ".join(words)), (1, " ".join(words[:75_000])), (3, " ".join(words[:60_000]))]
    assert found(documents(rows)) == {2: (79_998, 1), 1: (74_998, 1), 3: (59_998, 3)}


def test_repeated_rows_null_ids_and_clashing_names(documents):
    text = "a b c d e f g h"
    docs = documents([(3, text), (3, text), (3, "other text"), (None, text), (None, "q r s t"), (5, None)])
    docs = docs.selectExpr("*", "1 as SID", "2 as set_key", "3 as gram", "4 as Component")
    rows = sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"] or 0) for r in ngram_join.joined(docs).collect())
    assert rows == [(0, 2, 0), (0, 6, 3), (3, 1, 3), (3, 6, 3), (3, 6, 3), (5, 0, 5)]


def test_empty_table(documents):
    assert ngram_join.joined(documents([])).collect() == []


def test_partial_overlaps_add_up():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 2**64, 3000, dtype=np.uint64)
    sets = [np.unique(rng.choice(pool, 400)) for _ in range(12)]

    def parts(own):
        for k in range(ngram_join.FRAGMENTS):
            cut = [s[ngram_join.fragment(s) == k] for s in own]
            yield np.repeat(np.arange(len(own)), [len(c) for c in cut]), np.concatenate(cut)

    total = sum(ngram_join.partial_overlaps(a, b, (5, 7)) for a, b in zip(parts(sets[:5]), parts(sets[5:])))
    assert (total == [[len(np.intersect1d(a, b)) for b in sets[5:]] for a in sets[:5]]).all()

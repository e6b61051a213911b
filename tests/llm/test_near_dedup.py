import random
import re

import pytest

from callsieve.llm import near_dedup, queries
from callsieve.llm.components import components
from conftest import TESTDATA

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} - {()}
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


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
            if left and right and 100 * len(left & right) >= 75 * len(left | right):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (len(s), root(i)) for i, s in sets}


def found(rows):
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet").select("doc_id", "text").collect()
    rows = queries.op2_near_dedup(spark, str(TESTDATA / "sf0.01")).collect()
    assert len(rows) == len(docs)
    assert found(rows) == brute_force([(d["doc_id"], d["text"]) for d in docs])


@pytest.mark.parametrize("small", [near_dedup.SMALL_REGION, 1])
def test_a_large_group_of_near_copies(documents, monkeypatch, small):
    """With regions of over one set counted as large, the comparison in blocks has to find the rest."""
    monkeypatch.setattr(near_dedup, "SMALL_REGION", small)
    monkeypatch.setattr(near_dedup, "BLOCK_SETS", 16)
    draw = random.Random(4)
    base = [draw.choice("abcdefgh") + str(i) for i in range(60)]
    rows = []
    for i in range(120):
        words = list(base)
        for _ in range(draw.randint(0, 3)):
            words[draw.randrange(60)] = f"new{draw.random()}"
        rows.append((1000 - i, " ".join(words)))
    rows += [(i, f"other text number {i} of its own with some words {i}") for i in range(20)]
    assert found(near_dedup.near_duplicates(documents(rows)).collect()) == brute_force(rows)


def test_blocks_are_bounded_by_shingles(documents, monkeypatch):
    """Long near copies, among short ones, in blocks of a few sets."""
    monkeypatch.setattr(near_dedup, "SMALL_REGION", 1)
    monkeypatch.setattr(near_dedup, "BLOCK_SHINGLES", 2000)
    draw = random.Random(5)
    rows = []
    for size, copies in ((900, 25), (30, 40)):
        base = [draw.choice("abcd") + str(i) for i in range(size)]
        for _ in range(copies):
            words = list(base)
            for _ in range(draw.randint(0, size // 40)):
                words[draw.randrange(size)] = f"new{draw.random()}"
            rows.append((len(rows), " ".join(words)))
    assert found(near_dedup.near_duplicates(documents(rows)).collect()) == brute_force(rows)


def test_short_and_odd_texts(documents):
    rows = [
        (9, "One two"), (3, "one TWO"), (5, "one two three"), (7, None), (8, ""), (6, " \n"), (4, "ÀB c d e f"),
        (2, "àb c d e f"), (1, "x"), (11, "a b c d e"), (10, "A  b\tc d\ne"),
    ]
    assert found(near_dedup.near_duplicates(documents(rows)).collect()) == brute_force(rows)


def test_a_long_text(documents):
    words = [f"w{i}" for i in range(60_000)]
    rows = [(2, " ".join(words)), (1, " ".join(words[:50_000])), (3, " ".join(words[:20_000]))]
    assert found(near_dedup.near_duplicates(documents(rows)).collect()) == brute_force(rows)


def test_repeated_rows_and_null_ids(documents):
    text = "a b c d e f g h"
    docs = documents([(3, text), (3, text), (3, "another text of five words"), (None, text), (None, "q r s t u v"), (5, None)])
    docs = docs.selectExpr("*", "1 as KEPT", "2 as set_key")
    rows = near_dedup.near_duplicates(docs).collect()
    assert sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"] or 0, r["kept"]) for r in rows) == [
        (0, 2, 0, True), (0, 4, 3, False), (3, 1, 3, True), (3, 4, 3, True), (3, 4, 3, True), (5, 0, 5, True)
    ]
    left = near_dedup.deduplicated(docs).collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in left) in (
        [(0, "q r s t u v"), (3, text), (5, "")],
        [(0, "q r s t u v"), (3, "another text of five words"), (5, "")],
    )


def test_empty_table(documents):
    assert near_dedup.near_duplicates(documents([])).count() == 0
    assert near_dedup.deduplicated(documents([])).count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(1, i) for i in range(2, 40)] + [(7, 7), (300, 301), (301, 300)]
    rows = components(spark.createDataFrame(links, "a long, b long")).collect()
    groups = {}
    for r in rows:
        groups.setdefault(r["component"], set()).add(r["node"])
    assert sorted(map(sorted, groups.values())) == [list(range(1, 40)), list(range(100, 161)), [300, 301]]

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from callsieve.llm import queries, repeats
from conftest import TESTDATA


def brute_force(docs):
    """doc_id -> (bytes, removed, runs, digest) for rows of distinct ids."""
    seen, out = set(), {}
    for doc_id, text in sorted(docs):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        own = [data[i : i + 50] for i in range(len(data) - 49)]
        for i, string in enumerate(own):
            if string in seen:
                gone[i : i + 50] = True
        seen.update(own)
        runs = int((np.diff(gone, prepend=False, append=False).sum() + 1) // 2) if len(gone) else 0
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        out[doc_id] = (len(data), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
    return out


def found(rows):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows}


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet").select("doc_id", "text").collect()
    rows = queries.op8_repeats(spark, str(TESTDATA / "sf0.01")).collect()
    assert len(rows) == len(docs)
    assert found(rows) == brute_force([(d["doc_id"], d["text"]) for d in docs])


@pytest.mark.parametrize("seed", range(3))
def test_passages_cut_at_random(documents, monkeypatch, seed):
    """Many overlapping pieces of few passages, over several blocks: every kind of border occurs."""
    monkeypatch.setattr(repeats, "CHUNK", 64)
    draw = random.Random(seed)
    passages = ["".join(draw.choice("abcdé ") for _ in range(200)) for _ in range(3)] + ["ab" * 90, "z" * 130]
    rows = []
    for i in draw.sample(range(1000), 60):
        pieces = []
        for _ in range(draw.randint(1, 3)):
            passage = draw.choice(passages)
            start = draw.randrange(len(passage))
            pieces.append(passage[start : start + draw.randint(20, 150)] + draw.choice(["", "x", "yy"]))
        rows.append((i, "".join(pieces)))
    assert found(repeats.without_repeats(documents(rows).repartition(5)).collect()) == brute_force(rows)


def test_spans_are_the_removed_runs(documents):
    shared = "this passage is long enough to be found again, and then some more of it"
    (row,) = repeats.without_repeats(documents([(1, shared), (2, "é" + shared + " own end")])).filter("doc_id = 2").collect()
    assert (row["starts"], row["ends"]) == ([2], [2 + len(shared)])


def test_odd_rows(documents):
    text = "".join(chr(97 + i % 26) + str(i) for i in range(60))
    rows = [(5, text), (2, text), (7, None), (8, ""), (9, "q" * 49), (1, "q" * 49), (4, "q" * 50), (6, "q" * 51)]
    assert found(repeats.without_repeats(documents(rows)).collect()) == brute_force(rows)
    odd = documents([(5, text), (5, text), (None, text), (9, text + "!")]).selectExpr("*", "1 as LOW", "2 as copy_of")
    got = sorted((r["doc_id"] or 0, r["n_removed"]) for r in repeats.without_repeats(odd).collect())
    assert got == [(0, 0), (5, 0), (5, 0), (9, len(text))]


def test_a_long_text(documents):
    draw = random.Random(1)
    long = "".join(draw.choice("abcdefgh ") for _ in range(3_000_000))
    rows = [(1, long), (2, "x" + long[1_500_000:1_500_400])]
    got = found(repeats.without_repeats(documents(rows)).collect())
    assert got[2][:3] == (401, 400, 1) and got[1][1] == 0


def test_empty_table(documents):
    assert repeats.without_repeats(documents([])).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 9), st.sampled_from([97, 98, repeats.UNKNOWN])), min_size=2, max_size=12), st.data())
def test_intervals_against_their_definition(suffixes, data):
    common = [0] + [data.draw(st.integers(1, 4)) for _ in suffixes[1:]] + [0]
    values, before = (np.array(x) for x in zip(*suffixes, strict=True))
    expected = set()
    n = len(suffixes)
    for a in range(n):
        for b in range(a + 2, n + 1):
            inside = min(common[a + 1 : b])
            if (a == 0 or common[a] < inside) and (b == n or common[b] < inside):
                if len(set(before[a:b].tolist())) > 1 or repeats.UNKNOWN in before[a:b]:
                    expected.add((a, b, inside, int(values[a:b].min())))
    assert set(repeats.intervals(np.array(common), values, before)) == expected

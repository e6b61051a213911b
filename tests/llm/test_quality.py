import re
from collections import Counter

import pyarrow as pa
from hypothesis import given, settings, strategies as st

from callsieve.llm import quality, queries
from conftest import TESTDATA

WORD = re.compile(r"[^\x20\x09-\x0D]+")
NAMES = [f.split()[0] for f in quality.MEASURES.split(", ")]


def brute_force(text):
    words = WORD.findall(text or "")
    n, least = len(words), quality.MIN_REPEAT
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    triples = Counter(tuple(words[i : i + 3]) for i in range(n - 2))
    inside = {j for i in range(n - 2) if triples[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    starts: dict[tuple, list[int]] = {}
    for i in range(n - least + 1):
        starts.setdefault(tuple(words[i : i + least]), []).append(i)
    covered, longest = set(), 0
    for at in starts.values():
        for a in at:
            for b in at:
                if a < b:
                    k = least
                    while b + k < n and words[a + k] == words[b + k]:
                        k += 1
                    longest = max(longest, k)
                    covered |= {*range(a, a + k), *range(b, b + k)}
    return (
        n, sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
        len(inside), len(covered), longest,
    )


def measured(texts):
    return list(zip(*(c.tolist() for c in quality.text_measures(pa.array(texts, pa.string()))), strict=True))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.none() | st.text("ab \n|", max_size=120) | st.text(max_size=20), min_size=1, max_size=6))
def test_measures_against_brute_force(texts):
    assert measured(texts) == [brute_force(t) for t in texts]


def test_odd_texts():
    texts = ["", None, "a " * 40, "\n\n", "x\ty\x0bz\x0c\r é漢\x1c|#", "one two three four five six seven eight " * 2]
    assert measured(texts) == [brute_force(t) for t in texts]


def test_long_texts_are_measured_whole():
    words = " ".join(f"w{i}" for i in range(300_000))
    n, *_, covered, longest = measured([words + " " + words[:1000]])[0]
    copied = len(words[:1000].split()) - 1
    assert n > 300_000 and 2 * copied <= covered <= 2 * copied + 2 and copied <= longest <= copied + 1


def test_query_against_brute_force(spark):
    rows = queries.op5_quality_rules(spark, str(TESTDATA / "sf0.001")).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        expected = brute_force(texts[r["doc_id"]])
        assert tuple(r[n] for n in NAMES) == expected
        n, *_, repeated, covered, longest = expected
        assert r["base_failed"] == (n < 50 or 100 * repeated > 50 * n)
        assert r["kept"] == (not r["base_failed"] and 100 * covered <= 40 * n and longest <= 100)


def test_most_labelled_good_documents_are_kept(spark):
    labels = spark.read.parquet(f"{TESTDATA}/sf0.1/labels.parquet")
    rows = queries.op5_quality_rules(spark, str(TESTDATA / "sf0.1")).filter("not base_failed").join(labels, "doc_id")
    good = rows.filter("quality = 1").selectExpr("avg(cast(kept as int))").first()[0]
    assert good > 0.995


def test_odd_rows(documents):
    docs = documents([(None, "a b"), (1, None), (1, None), (2, "")]).selectExpr("*", "'x' as N_WORDS", "1 as kept")
    rows = quality.judged(docs).collect()
    assert sorted(r["n_words"] for r in rows) == [0, 0, 0, 2] and not any(r["kept"] for r in rows)
    assert quality.judged(documents([])).count() == 0

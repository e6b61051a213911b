import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st

from callsieve.llm import queries, token_counts as counts
from conftest import TESTDATA

PATH = public_tokenizers.path(counts.MODEL)
ODD = [
    "", " ", "  ", "\n", "\n\n ", " a", "  a", "   1", "▁x y", "日本語 テキスト\t\t x", "𝒳 😀😀 é́", "a" * 300, " " * 100 + "b",
    "x" + " " * 47, " " * 15 + "漢", "<s> </s> <unk> <0x0A>", "\x00a\x00", "   \n   z", "ﬁ ①", "the the  the",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@settings(max_examples=300, deadline=None)
@given(st.text("abeht \n▁1é漢😀.", max_size=40) | st.text(max_size=20))
def test_counts_of_all_prefixes_are_those_of_the_library(text):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH) if not _kept else _kept[0]
    _kept[:] = [library]
    found = counts.counter(PATH).prefixes(text)
    assert found.tolist() == [len(library.encode(text[: i + 1])) for i in range(len(text))]
    assert counts.counter(PATH).total(text) == len(library.encode(text))


_kept: list[sentencepiece.SentencePieceProcessor] = []


def test_odd_texts(library):
    assert [counts.counter(PATH).total(t) for t in ODD] == [len(library.encode(t)) for t in ODD]


def test_every_piece_of_the_vocabulary(library):
    pieces = [library.id_to_piece(i).replace("▁", " ") for i in range(259, library.get_piece_size())]
    found = [counts.counter(PATH).total(p) for p in pieces]
    assert found == [len(x) for x in library.encode(pieces)]


def test_query_against_the_library(spark, library):
    rows = queries.op6_token_counts(spark, str(TESTDATA / "sf0.01")).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet").collect()}
    for r in rows:
        n = len(library.encode(texts[r["doc_id"]] or ""))
        assert (r["n_tokens"], r["over_limit"]) == (n, n > 4096)
        assert r["n_bytes"] == len((texts[r["doc_id"]] or "").encode())


def test_budget_questions(documents, library):
    text = "In of the inanin. Thonst  aonthrein\n日本 x"
    (row,) = counts.token_counts(documents([text])).collect()
    for budget in range(row["n_tokens"] + 2):
        end = counts.prefix_within(row["prefix_tokens"], budget)
        assert end == max([i for i in range(len(text) + 1) if len(library.encode(text[:i])) <= budget])
    assert counts.tokens_within(row["prefix_tokens"], 9) == len(library.encode(text[:9]))
    assert counts.tokens_within(row["prefix_tokens"], 0) == 0


def test_odd_rows(documents):
    rows = counts.token_counts(documents([(None, "a"), (1, None), (1, None), (2, "")])).collect()
    assert sorted((r["n_bytes"], r["n_tokens"], len(np.frombuffer(r["prefix_tokens"], "<u4"))) for r in rows) == [
        (0, 0, 0), (0, 0, 0), (0, 0, 0), (1, 1, 1)
    ]
    assert counts.token_counts(documents([])).count() == 0


def test_columns_with_the_names_of_the_result(documents, library):
    docs = documents([(1, "a b"), (2, "c d e")]).selectExpr("*", "9 as N_TOKENS", "8 as n_bytes", "'x' as prefix_tokens")
    rows = {r["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in counts.over_limit(counts.counted_table(docs)).collect()}
    assert rows == {1: (3, len(library.encode("a b"))), 2: (5, len(library.encode("c d e")))}


def test_query_writes_and_reads_the_count_of_every_prefix(spark, library, monkeypatch):
    written = []
    kept = counts.stored
    monkeypatch.setattr(counts, "stored", lambda df: written.append(kept(df)) or written[-1])
    found = {r["doc_id"]: r for r in queries.op6_token_counts(spark, str(TESTDATA / "sf0.001")).collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet").collect()}
    rows = written[0].collect()
    assert len(rows) == len(found) == len(texts)
    for r in rows:
        text, made = texts[r["doc_id"]], r["prefix_tokens"]
        assert len(made) == 4 * len(text)
        for end in {0, len(text) // 3, len(text)}:
            assert counts.tokens_within(made, end) == len(library.encode(text[:end]))
        assert found[r["doc_id"]]["n_tokens"] == counts.tokens_within(made, len(text))
        assert found[r["doc_id"]]["over_limit"] == (counts.prefix_within(made, counts.BUDGET) < len(text))


def test_last_count_of_large_and_empty_arrays(spark):
    rows = [(np.array(x, "<u4").tobytes(),) for x in ([], [5], [1, 258], [7, 3_000_000_000])]
    table = spark.createDataFrame(rows, "prefix_tokens binary")
    assert [r[0] for r in table.select(counts.last_count(table["prefix_tokens"])).collect()] == [0, 5, 258, 3_000_000_000]

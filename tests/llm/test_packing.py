import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from callsieve.llm import packing, queries
from callsieve.llm.tokens import token_ids
from conftest import TESTDATA

ODD = [
    "", " ", "  a", "a\n\n b", "x \x1c y", "\x85 \xa0 q", "don't I'LL 'S", "日本語 テキスト", "a<|endoftext|> b",
    "  <|endoftext|>\n", "é é", "😀😀", "\x00", "1234567 890", "word " * 3000,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@given(st.text(max_size=60))
def test_ids_are_those_of_the_other_library(text):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")) if not _kept else _kept[0]
    _kept[:] = [tokenizer]
    assert token_ids(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


_kept: list[Tokenizer] = []


def test_odd_texts_have_the_same_ids(library):
    for text in ODD:
        assert token_ids(text).tolist() == library.encode(text, add_special_tokens=False).ids


@given(st.integers(1, 10_000))
def test_lengths_are_powers_of_two_and_add_up(n):
    lengths = packing.piece_lengths(n)
    assert sum(lengths) == n and lengths == sorted(lengths, reverse=True)
    assert all(x & (x - 1) == 0 and x <= 1024 for x in lengths)
    assert len(set(lengths[n // 1024 :])) == len(lengths[n // 1024 :])


def checked(rows, texts, library):
    """`rows` against a packing by hand; returns how many sequences there are."""
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
    for doc_id, text in texts.items():
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        at = 0
        for r in sorted(by_doc[doc_id], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            piece = np.array(ids[at : at + r["length"]], "<u4")
            assert r["ids_crc32"] == zlib.crc32(piece.tobytes())
            at += r["length"]
        assert at == len(ids)
    assert sorted(r["sequence_id"] for r in rows) == list(range(len(rows)))
    assert {r["offset"] for r in rows} == {0}
    lengths = [r["length"] for r in sorted(rows, key=lambda r: r["sequence_id"])]
    assert lengths == sorted(lengths, reverse=True)


def test_query_against_brute_force(spark, library):
    rows = queries.op1_packing(spark, str(TESTDATA / "sf0.001")).collect()
    docs = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet").select("doc_id", "text").collect()
    checked(rows, {d["doc_id"]: d["text"] for d in docs}, library)


def test_odd_rows(spark, documents, library):
    texts = dict(enumerate([*ODD, None]))
    docs = documents(list(texts.items())).withColumn("part", F.lit(1)).withColumn("LENGTH", F.lit("x"))
    pieces = packing.cut(docs.repartition(3)).withColumn("ids_crc32", F.crc32("ids"))
    checked(packing.packed(pieces).collect(), texts, library)


def test_repeated_rows_and_null_ids_are_documents_of_their_own(documents):
    rows = packing.packed(packing.cut(documents([(1, "a b"), (1, "a b"), (None, "a b")]))).collect()
    assert len({r["sequence_id"] for r in rows}) == len(rows) == 6
    assert sorted(len(r["ids"]) for r in rows) == [4, 4, 4, 8, 8, 8]


def test_empty_table(documents):
    assert packing.packed(packing.cut(documents([]))).count() == 0

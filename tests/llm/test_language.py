import numpy as np
import pytest

from callsieve.llm import language, queries
from conftest import TESTDATA


@pytest.mark.parametrize("n", [1, 2, 3, 4, 7, 8, 40])
def test_codewords_are_far_apart(n):
    code = language.codewords(n)
    assert code.shape[0] == n
    if n > 1:
        apart = (code[:, None, :] != code[None, :, :]).sum(axis=2) + np.eye(n) * code.shape[1]
        assert apart.min() >= code.shape[1] / 4


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.1/documents.parquet").select("doc_id", "lang")
    rows = queries.op7_language(spark, str(TESTDATA / "sf0.1")).join(docs, "doc_id").filter("held_out")
    assert rows.selectExpr("avg(cast(lang = lang_pred as int))").first()[0] > 0.99
    assert rows.filter("score < 0 or score > 1").count() == 0


def test_which_rows_are_held_out(documents):
    import zlib

    rows = language.predicted(documents([(i, "a") for i in range(40)] + [(None, "a")]), None).collect()
    for r in rows:
        expected = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2
        assert r["held_out"] == expected and r["lang_pred"] == "und" and r["score"] == 0


def learned(documents):
    rows = [(i, "der die und nicht ein schöner", None, "de") for i in range(30)]
    rows += [(i, "the and with some of them", None, "en") for i in range(30, 60)]
    return documents(rows + [(60, None, None, "fr"), (61, "", None, "fr"), (62, "words", None, None)])


def test_odd_texts(documents):
    model = language.fit(learned(documents))
    assert model.languages == ["de", "en"]
    odd = documents([(1, None), (1, "12 !? \n"), (None, "the and with"), (2, "ein schöner"), (3, "e"), (4, "the " * 90_000)])
    rows = language.predicted(odd.selectExpr("*", "1 as SCORE", "2 as held_out"), model).collect()
    by_text = sorted((r["doc_id"] or 0, r["lang_pred"]) for r in rows)
    assert by_text[:4] == [(0, "en"), (1, "und"), (1, "und"), (2, "de")] and by_text[5] == (4, "en")
    assert [r["ambiguous"] for r in rows if r["doc_id"] == 3] == [True]


def test_one_language_or_none(documents):
    only = language.identified(documents([(i, "the and", None, "en") for i in range(9)] + [(10, "7")])).collect()
    assert {r["lang_pred"] for r in only if r["doc_id"] != 10} == {"en"}
    assert [r["lang_pred"] for r in only if r["doc_id"] == 10] == ["und"]
    assert [r["lang_pred"] for r in language.identified(documents([(1, "a b")])).collect()] == ["und"]
    assert language.identified(documents([])).count() == 0


def test_scores_do_not_depend_on_the_next_text():
    import pyarrow as pa

    weights = np.random.default_rng(1).normal(size=(language.BUCKETS, 3)).astype(np.float32)
    texts = ["ab", "the", "é", "", "der und", "a", "zz"]
    alone = np.concatenate([language.margins(pa.array([t]), weights) for t in texts])
    assert np.allclose(language.margins(pa.array(texts), weights), alone, atol=1e-6)
    assert np.allclose(language.margins(pa.array(texts[::-1]), weights)[::-1], alone, atol=1e-6)


def test_copies_do_not_fill_the_sample(documents):
    rows = [(i, "the and with some of them", None, "en") for i in range(400)]
    found = language.identified(documents(rows), 20).collect()
    assert {r["lang_pred"] for r in found} == {"en"}


def test_rare_languages_are_learned(documents):
    draw = np.random.default_rng(2)
    word = lambda letters: "".join(draw.choice(list(letters), 5))
    rows = [(i, " ".join(word("aehimnorst") for _ in range(12)), None, "en") for i in range(4000)]
    rows += [(4000 + i, " ".join(word("аеиностр") for _ in range(12)), None, "ru") for i in range(12)]
    docs = documents(rows)
    sample = language.training_texts(docs, 200).groupBy("lang").count().collect()
    assert {r["lang"]: r["count"] for r in sample} == {"en": 200, "ru": 12}
    found = {r["doc_id"]: r["lang_pred"] for r in language.identified(docs, 200).collect()}
    assert all(found[4000 + i] == "ru" for i in range(12)) and sum(found[i] == "en" for i in range(4000)) > 3990


def test_decoding_against_plain_python():
    """Loss-weighted decoding, bit by bit and language by language."""
    import math
    import pyarrow as pa

    draw = np.random.default_rng(3)
    names = ["aa", "bb", "cc", "dd", "ee"]
    code = language.codewords(5)
    trust = draw.random(code.shape)
    model = language.Model(names, code, draw.normal(size=(language.BUCKETS, code.shape[1])).astype(np.float32), trust)
    texts = ["some words of a text", "ein anderer Text", "été", "12", "", None, "x", "longer " * 50]
    langs, scores, _ = language.decoded(pa.array(texts), model)
    for text, lang, score in zip(texts, langs, scores):
        if not text or not any(c.isalpha() for c in text):
            assert (lang, score) == ("und", 0)
            continue
        data = np.frombuffer(text.lower().encode(), np.uint8)
        sums = [0.0] * code.shape[1]
        for at in language.grams(data, np.array([0, len(data)])):
            sums = [s + float(w) for s, w in zip(sums, model.weights[at])]
        found = [s / (len(data) + language.PRIOR_GRAMS) for s in sums]
        loss = [
            sum(t * math.log1p(math.exp(-language.SHARPNESS * c * f)) for t, c, f in zip(trust[k], code[k].tolist(), found))
            for k in range(5)
        ]
        assert lang == names[loss.index(min(loss))]
        assert score == pytest.approx(1 / sum(math.exp(-language.CONTRAST * (x - min(loss))) for x in loss), rel=1e-3)

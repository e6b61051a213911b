import corpus_pipeline as pipeline
from callsieve.llm import line_dedup, mixing, quality
from callsieve.llm.shared import stored
from conftest import TESTDATA
from test_near_dedup import brute_force as near_classes
from test_packing import checked


def test_stages_against_brute_force(spark):
    from tokenizers import Tokenizer
    import public_tokenizers

    docs = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet")
    names, columns = [n for n, _ in pipeline.STAGES], docs.columns
    assert names == ["quality rules", "line dedup", "near dedup", "source mix", "packing"]
    steps = []
    for _, stage in pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, ""))
        assert docs.columns == columns
        steps.append({r["doc_id"]: r for r in docs.collect()})
    given = {r["doc_id"]: r for r in spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet").collect()}
    verdict = {r["doc_id"]: r["kept"] for r in quality.judged(spark.createDataFrame(list(given.values()))).collect()}
    assert set(steps[0]) == {d for d, kept in verdict.items() if kept} and len(steps[0]) < len(given)
    cut = line_dedup.without_boilerplate(spark.createDataFrame(list(steps[0].values()))).collect()
    assert {r["doc_id"]: r["text"] for r in cut} == {d: r["text"] for d, r in steps[1].items()}
    assert all(len(r["text"]) == r["n_chars"] for r in steps[1].values())
    classes = near_classes([(d, r["text"]) for d, r in steps[1].items()])
    assert set(steps[2]) == {d for d, (_, low) in classes.items() if low == d}
    taken = mixing.mixed(spark.createDataFrame(list(steps[2].values()))).collect()
    assert docs.count() == sum(r["copies"] for r in taken) > 0
    rows = pipeline.run(spark, f"{TESTDATA}/sf0.001")
    assert rows.selectExpr("sum(length)").first()[0] == rows.selectExpr("sum(octet_length(ids)) / 4").first()[0]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    whole = sum(len(library.encode(steps[2][r["doc_id"]]["text"], add_special_tokens=False).ids) * r["copies"] + r["copies"] for r in taken)
    assert rows.selectExpr("sum(length)").first()[0] == whole
    once = [r for r in pipeline.STAGES[-1][1](spark, spark.createDataFrame(list(steps[2].values())), "").collect()]
    checked(once, {d: r["text"] for d, r in steps[2].items()}, library)


def test_a_very_long_text_goes_through_whole(spark, documents):
    long = "\n".join(" ".join(f"w{17 * i + j}" for j in range(20)) for i in range(20_000))
    short = " ".join(f"s{i}" for i in range(60))
    docs = documents([(1, long, "a"), (2, long + " end", "a"), (3, short, "b"), (3, short, "b")])
    for _, stage in pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, ""))
    assert {(r["doc_id"], r["text"]) for r in docs.collect()} <= {(1, long), (3, short)}
    copies = docs.filter("doc_id = 1").count()
    assert copies >= 1
    pieces = pipeline.STAGES[-1][1](spark, docs, "").filter("doc_id = 1")
    tokens = {r["doc_tokens"] for r in pieces.select("doc_tokens").distinct().collect()}
    assert len(tokens) == 1 and pieces.selectExpr("sum(length)").first()[0] == copies * tokens.pop() > 400_000


def test_empty_and_odd_tables(spark, documents):
    for docs in (
        documents([]),
        documents([(None, None, None), (1, "", "a"), (1, "", "a"), (2, "w " * 60, None)]).selectExpr("*", "1 as KEPT"),
    ):
        for _, stage in pipeline.STAGES:
            docs = stored(stage(spark, docs, ""))
        docs.count()

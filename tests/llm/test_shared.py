import random
from collections import Counter

from callsieve.llm import components, shared


def test_first_numbers(spark, monkeypatch):
    """Parts in several runs, with lengths that some of them lack."""
    monkeypatch.setattr(shared, "PARTS_AT_ONCE", 4)
    draw = random.Random(1)
    counts = [(p, 1 << k, draw.randint(1, 9)) for p in range(30) for k in range(4) if draw.random() < 0.7]
    draw.shuffle(counts)
    expected, total = {}, 0
    for length, part, n in sorted((-length, part, n) for part, length, n in counts):
        expected[part, -length] = total
        total += n
    schema = "part int, length long, n long"
    rows = shared.first_numbers(spark.createDataFrame(counts, schema)).collect()
    assert {(r["part"], r["length"]): r["first"] for r in rows} == expected and len(rows) == len(counts)
    assert shared.first_numbers(spark.createDataFrame([], schema)).count() == 0


def test_files_follow_the_rows_and_not_the_partitions(spark, tmp_path, monkeypatch):
    few = spark.range(25, numPartitions=25)
    assert len(shared.stored(few).inputFiles()) == 25
    made = shared.stored(few, 30, file_rows=10)
    assert len(made.inputFiles()) == 3 and {r[0] for r in made.collect()} == set(range(25))
    assert shared.stored(few.filter("id < 0"), 0).count() == 0

    written = []

    def noted(df, *most, **settings):
        table = shared.stored(df, *most, **settings)
        written.append(len(table.inputFiles()))
        return table

    monkeypatch.setattr(components, "stored", noted)
    monkeypatch.setattr(components, "FEW_LINKS", 5)
    links = [(i, i + 1) for i in range(400) if i % 10 != 9]
    names = components.components(spark.createDataFrame(links, "a long, b long").repartition(40), len(links)).collect()
    lowest: dict = {}
    for r in names:
        lowest.setdefault(r["component"], set()).add(r["node"] // 10)
    assert len(names) == 400 and len(lowest) == 40 and all(len(tens) == 1 for tens in lowest.values())
    assert len(written) > 4 and Counter(written) == {1: len(written)}

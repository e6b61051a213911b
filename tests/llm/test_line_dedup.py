from collections import Counter

from callsieve.llm import line_dedup


def rows_of(df):
    return sorted(((r["doc_id"] or 0, r["n_lines"], r["n_dropped"], r["text"]) for r in df.collect()), key=str)


def test_lines_go_by_their_share_of_a_site(documents):
    pages = [(i, f"menu\nown {i}\n" + (" footer \n" if i < 5 else "") + "\nend", "a") for i in range(40)]
    pages += [(100 + i, f"menu\nown {i}", "b") for i in range(4)]
    got = {d: t for d, _, _, t in rows_of(line_dedup.without_boilerplate(documents(pages)))}
    assert got[7] == "own 7\n"  # menu and end are on all pages of a, a blank line stays
    assert got[0] == "own 0\n\n" or got[0] == "own 0\n"
    assert got[101] == "menu\nown 1"  # too few pages to tell


def test_against_counting(spark, documents):
    pages = [(i, "\n".join(f"l{(i * k) % 23}" for k in range(1, 9)), ["x", None][i % 2]) for i in range(120)]
    counts, totals = Counter(), Counter()
    for _, text, host in pages:
        totals[host] += 1
        counts.update((host, line) for line in set(text.split("\n")))
    often = {key for key, n in counts.items() if n >= 5 and n * 100 > 10 * totals[key[0]]}
    expected = [
        (i, 8, sum((h, x) in often for x in t.split("\n")), "\n".join(x for x in t.split("\n") if (h, x) not in often))
        for i, t, h in pages
    ]
    assert rows_of(line_dedup.without_boilerplate(documents(pages))) == sorted(expected, key=str)
    assert any(e[2] for e in expected) and any(e[2] < 8 for e in expected)


def test_a_very_long_text(documents):
    long = "menu\n" + "\n".join(f"line {i}" for i in range(200_000)) + "\nmenu"
    pages = [(0, long, "a")] + [(i, f"menu\nown {i}", "a") for i in range(1, 9)]
    rows = {d: (n, gone, t) for d, n, gone, t in rows_of(line_dedup.without_boilerplate(documents(pages)))}
    assert rows[0] == (200_002, 2, long[5:-5]) and rows[3] == (2, 1, "own 3")


def test_odd_rows(documents):
    docs = documents([(1, None, None), (None, "", "a"), (2, "x", "a"), (2, "x", "a"), (3, "\n" * 1000, "a")])
    docs = docs.selectExpr("*", "1 as N_LINES", "2 as line", "3 as host", "4 as lines")
    assert [r[1:3] for r in rows_of(line_dedup.without_boilerplate(docs))] == [(1, 0), (0, 0), (1, 0), (1, 0), (1001, 0)]
    assert line_dedup.without_boilerplate(documents([])).count() == 0

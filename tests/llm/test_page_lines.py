from collections import Counter

import __spark_entry__ as driver
from callsieve.llm import page_lines
from conftest import TESTDATA

SCHEMA = "page_id long, url string, html string"


def test_a_line_on_every_host_goes_from_all_of_them(spark):
    rows = []
    for host in range(9):  # a line on 8 to 16 % of every host's pages, as one on about 10 % falls out by chance
        often = 8 + host
        for i in range(100):
            banner = "<div>banner of all</div>" if i < often else ""
            menu = f"<ul><li>menu {host}</li></ul>" if i % 2 else ""
            rare = f"<p>seen {host} {i // 5}</p>"
            rows.append((len(rows), f"https://u@H{host}.org:80/{i}?x", f"<html>{banner}{menu}{rare}own <b>t</b> {i}\nend {i}"))
    found = page_lines.without_site_lines(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == len(rows) and {r["host"] for r in found} == {f"h{h}.org" for h in range(9)}
    assert not any("menu" in r["text"] for r in found)
    left = Counter(r["host"] for r in found if "banner of all" in r["text"])
    assert not left
    assert all(f"own t {r['page_id'] % 100}\nend {r['page_id'] % 100}" in r["text"] for r in found)


def test_lines_and_hosts(spark):
    html = "<p>a<b>b</b><!-- <p>x --><script>'</p>'</script> c<BR/>d\r\n\n e <pa>f</p>"
    rows = [(1, "http://A.b/c", html), (2, "no address", ""), (3, None, None)]
    found = page_lines.without_site_lines(spark.createDataFrame(rows, SCHEMA)).orderBy("page_id").collect()
    assert [tuple(r) for r in found] == [(1, "a.b", 3, 0, "ab   c\nd\ne f"), (2, None, 0, 0, ""), (3, None, 0, 0, None)]
    assert page_lines.without_site_lines(spark.createDataFrame([], SCHEMA)).count() == 0


def test_the_cut_parts_rare_from_frequent():
    assert page_lines.least_percent({1: 90, 2: 40, 3: 10, 20: 4, 25: 3}) == 4
    assert page_lines.least_percent({100: 7}) == page_lines.least_percent({}) == page_lines.MAX_PERCENT
    assert page_lines.least_percent({5: 180, 12: 9, 50: 900}) <= page_lines.MAX_PERCENT
    assert page_lines.least_percent({0: 1_000_000, 50: 10}) == page_lines.LEAST_PERCENT
    assert page_lines.least_percent({0: 1_000_000, 50: 10}, 1) == 1


def dropped(pages, least=2):
    """(page, line) pairs that go, by counting in Python."""
    hosts = Counter(h for _, h, _ in pages)
    on = Counter((h, x) for _, h, lines in pages for x in set(lines))
    histogram = Counter(n * 100 // hosts[h] for (h, _), n in on.items() if n >= 5)
    best, most = 10, 0
    for cut in sorted(histogram)[1:]:
        low = [p for p, n in histogram.items() for _ in range(n) if p < cut]
        high = [p for p, n in histogram.items() for _ in range(n) if p >= cut]
        gap = len(low) * len(high) * (sum(low) / len(low) - sum(high) / len(high)) ** 2
        if gap > most * (1 + 1e-9):
            best, most = max(low) + 1, gap
    best = max(least, min(best, 10))
    all_hosts = {x: sum((h, x) in on for h in hosts) for _, x in on}
    everywhere = {
        x for x, n in all_hosts.items()
        if 2 * n > len(hosts) and (k := sum(on[h, x] for h in hosts)) >= 5 and 100 * k >= best * len(pages)
    }
    return {
        (i, x) for i, h, lines in pages for x in lines
        if x in everywhere or on[h, x] >= 5 and 100 * on[h, x] >= best * hosts[h]
    }


def test_large_hosts_against_counting(spark):
    """One host of 2,000 pages with a menu on half of them and quotes on a few pages each, among small hosts."""
    pages = []
    for i in range(2000):
        lines = [f"own {i}"] + ["menu"] * (i % 2) + [f"quote {i % 333}", "footer" if i % 40 else "foot"]
        pages.append((i, "big.org", lines))
    for i in range(2000, 2200):
        pages.append((i, f"h{i % 7}.org", [f"own {i}", "menu 2" if i % 3 else "menu 3", f"line {i % 50}", "footer"]))
    rows = [(i, f"http://{h}/{i}", "".join(f"<p>{x}</p>" for x in lines)) for i, h, lines in pages]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as HOST", "2 as site", "3 as lines", "4 as gone")
    found = page_lines.without_site_lines(frame).collect()
    gone = dropped(pages)
    assert {(r["page_id"], x) for (_, h, lines), r in zip(pages, sorted(found), strict=True) for x in set(lines) - set(r["text"].split("\n"))} == gone
    assert not any(x.startswith("quote") for _, x in gone) and sum(x == "menu" for _, x in gone) == 1000


def test_quotes_on_a_large_host_stay(spark):
    rows = [(i, "http://a.b/", f"<p>{'menu' if i % 2 else f'own {i}'}</p><p>quote {i % 250}</p>") for i in range(1500)]
    found = page_lines.without_site_lines(spark.createDataFrame(rows, SCHEMA))
    assert found.selectExpr("sum(n_dropped)").first()[0] == 750


def test_long_pages_ties_and_repeated_rows(spark):
    long = "<p>x</p>" * 50_000 + "".join(f"<p>only {i}</p>" for i in range(20_000))
    rows = [(1, "http://a.b/", long)] + [(2, "http://a.b/", "<p>same</p>")] * 6 + [(i, "http://c.d/", f"<p>{i}") for i in range(3, 9)]
    found = page_lines.without_site_lines(spark.createDataFrame(rows, SCHEMA)).collect()
    by_page = sorted((r["page_id"], r["n_lines"], r["n_dropped"]) for r in found)
    assert by_page[:7] == [(1, 70_000, 0)] + [(2, 1, 1)] * 6 and len(by_page) == 13


def test_query_keeps_all_pages(spark):
    rows = driver.queries()["op3_page_lines"](spark, str(TESTDATA / "sf0.1")).collect()
    assert len(rows) == spark.read.parquet(f"{TESTDATA}/sf0.1/pages.parquet").count()
    assert any(r["n_dropped"] for r in rows) and all(r["n_dropped"] <= r["n_lines"] for r in rows)

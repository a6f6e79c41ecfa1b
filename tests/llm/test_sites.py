from collections import Counter

from pyspark.sql import functions as F

from factloom.llm.sites import host_of, html_lines, text_lines, without_boilerplate


def test_lines_and_hosts(spark):
    html = "<!DOCTYPE html><html><head><title> A  b</title><style>p{}</style><SCRIPT x='1'>if(a<b){'</p>'}</SCRIPT ></head><body><!-- <p>no</p>\n --><p class=x>one<b>two</b><br/>three\n four<li>é &amp;\t</li><pre></pre></body>"
    frame = spark.createDataFrame([(html,), (None,), ("",), ("plain",)], "html string")
    assert [r.l for r in frame.select(html_lines(F.col("html")).alias("l")).collect()] == [["A  b", "onetwo", "three", "four", "é &amp;"], [], [], ["plain"]]
    urls = ["HTTP://User@Www.A.org:80/x", "https://b.org?q", "ftp://c", "/rel", "", None, "mailto:x@y.z"]
    frame = spark.createDataFrame([(u,) for u in urls], "url string")
    assert [r.h for r in frame.select(host_of(F.col("url")).alias("h")).collect()] == ["www.a.org", "b.org", "c", "", "", "", ""]


def test_lines_that_a_host_repeats_go(spark):
    rows = []
    for n in range(40):
        host = "http://big.org/" if n % 3 else "http://small.org/"
        text = [f"page {n}", "everywhere", "everywhere", f"tenth {n % 10}", *(["rare"] if n in (1, 2, 4, 5) else []), *(["often"] if n % 3 and n < 20 else [])]
        rows.append((n, host + str(n), "\n".join(text)))
    rows += [(50 + n, None if n % 2 else "/x", "everywhere") for n in range(8)] + [(60, "http://one.org", "everywhere"), (61, "http://big.org", None), (None, "http://big.org", "everywhere\nnull id")]
    rows += [(70, "http://copies.org", "same\n" + "x" * 100_000)] * 6
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, body string, line string, host string").repartition(3)
    got = without_boilerplate(frame, lines=text_lines(F.col("body")), host=host_of(F.col("url")), ratio=0.2, min_pages=5).collect()
    hosts, held = Counter(), Counter()
    split = lambda t: [x for x in (t or "").split("\n") if x]
    of = lambda u: u.split("/")[2] if u and u.startswith("http") else ""
    for _, u, t in rows:
        hosts[of(u)] += 1
        held.update((of(u), x) for x in set(split(t)))
    want = []
    for i, u, t in rows:
        kept = [x for x in split(t) if not of(u) or held[of(u), x] < 5 or held[of(u), x] <= 0.2 * hosts[of(u)]]
        want.append((i or -1, of(u), len(split(t)), len(split(t)) - len(kept), "\n".join(kept)))
    assert sorted((r.id or -1, r.host, r.n_lines, r.n_dropped, r.text) for r in got) == sorted(want)
    assert {x for h, x in held if h == "big.org"} - {x for r in got if r.host == "big.org" for x in split(r.text)} == {"everywhere", "often"}
    assert without_boilerplate(frame.limit(0), lines=text_lines(F.col("body")), host=host_of(F.col("url"))).count() == 0

"""Wrappers are inferred from all pages of a host."""

import random

from pyspark.sql import functions as F

from lakeward.llm import wrappers as W

PAGES = "page_id long, url string, html string"


def page(i, body, end="All rights"):
    return f"<html><body><div class=top>Home</div><div id=story><h2>Title {i}</h2>{body}</div><div class=foot>{end}</div></body></html>"


def words(i, n=40):
    rng = random.Random(i)
    return "<p>" + " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(n)) + "</p>"


def texts(df):
    return {r["page_id"]: r["text"].split("\n") for r in W.extract(df).collect()}


def test_a_text_of_a_few_pages_is_no_template(spark):
    """Six pages of forty share a sentence: the six that come first by hash, which were the sample once."""
    ids = spark.range(40).select(F.col("id").alias("page_id"), F.format_string("https://a.example/%d", "id").alias("url"))
    first = {r["page_id"] for r in ids.orderBy(F.xxhash64("page_id", "url"), "page_id").limit(6).collect()}
    rows = [(i, f"https://a.example/{i}", page(i, words(i) + ("<p>Read this first</p>" if i in first else ""))) for i in range(40)]
    got = texts(spark.createDataFrame(rows, PAGES).repartition(3))
    assert {i for i, t in got.items() if "Read this first" in t} == first
    assert all("All rights" not in t and "Home" not in t and f"Title {i}" in t for i, t in got.items())


def test_long_pages_count_and_an_odd_one_does_not_spoil(spark):
    """Pages of over 200,000 characters have a wrapper; one page without the template leaves it to the others."""
    rows = [(i, "//b.example/x", page(i, words(i, 30_000) + "<div>Share this page</div>")) for i in range(9)]
    rows.append((9, "//b.example/x", page(9, words(9, 30_000), end="Gone")))
    got = texts(spark.createDataFrame(rows, PAGES).repartition(4))
    assert all(len(t) == 2 and t[0] == f"Title {i}" for i, t in got.items())


def test_expression_of_all_pages(spark):
    """More than 600 tokens are aligned; parts aligned apart give what aligning in turn gives."""
    rows = [(i, "//c.example", page(i, "".join(words(99 * i + k, 2) + f"<b>{k}</b>" * (k % 2) + f"<div class=x{k}>t</div>" for k in range(150))
                                    + ("<i>late</i>" if i % 2 else ""))) for i in range(6)]
    got = W.wrappers(spark.createDataFrame(rows, PAGES).repartition(3)).collect()
    assert len(got) == 1 and got[0]["expression"] == W.infer([r[2] for r in rows])["expression"]
    assert got[0]["expression"].endswith("</body></html>") and "(<i>)?" in got[0]["expression"]


def test_alignment_is_a_longest_common_subsequence():
    rng = random.Random(5)
    for _ in range(300):
        a, b = ([rng.choice("abc") for _ in range(rng.randint(0, 20))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        out = W.align(a, b)
        assert [i for i, _ in out if i is not None] == list(range(len(a))) and [j for _, j in out if j is not None] == list(range(len(b)))
        both = [(i, j) for i, j in out if None not in (i, j)]
        assert all(a[i] == b[j] for i, j in both) and len(both) == best[-1][-1]


def test_pages_are_read_by_their_place_in_the_expression(spark):
    """A page whose story is one element deeper than the others' has no element with the region's path: aligned
    with the expression, it has the region.  Its texts are template where the expression has them, not in slots."""
    def story(i):
        wide = ("<div class=wide>", "</div>") if i % 8 == 0 else ("", "")
        said = "Home" if i == 3 else f"said {i}"
        return (f"<html><body><div class=top>Home</div><div class=side><b>Side {i}</b></div>{wide[0]}<div id=story><h2>Title {i}</h2>{words(i)}"
                f"<h3>{said}</h3><p>Read <b>more</b></p></div>{wide[1]}<div class=foot>All rights</div></body></html>")
    rows = [(i, "https://d.example/x", story(i)) for i in range(20)]
    got = texts(spark.createDataFrame(rows, PAGES).repartition(3))
    assert got == {i: [f"Title {i}", words(i)[3:-4], "Home" if i == 3 else f"said {i}"] for i in range(20)}

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakeward.llm import collocations

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def counts(rows, longest):
    f = {}
    for lang, text in rows:
        of = f.setdefault(lang or "und" if lang is None else lang, Counter())
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")):
            w = re.findall(r"[^ \t]+", piece)
            of.update(" ".join(w[i:i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    return f


def brute(rows, longest=3, least=10, share=50, top=2000):
    out = []
    for lang, f in counts(rows, longest).items():
        n = sum(c for p, c in f.items() if " " not in p)
        often = {p: c for p, c in f.items() if " " in p and c >= least}
        most = Counter()
        for p, c in often.items():
            w = p.split(" ")
            for k in range(2, len(w)):
                for i in range(len(w) - k + 1):
                    inner = " ".join(w[i:i + k])
                    most[inner] = max(most[inner], c)
        kept = []
        for p, a in often.items():
            if p in most and 100 * most[p] >= share * a:
                continue
            w = p.split(" ")
            cuts = []
            for k in range(1, len(w)):
                l, r = f[" ".join(w[:k])], f[" ".join(w[k:])]
                cuts.append((1000000 * a * a // (l * r), k, l, r))
            score, _, l, r = min(cuts)
            kept.append((-score, -a, p.encode(), l, r))
        out += [(lang, i, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(kept)[:top], 1)]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string")


def got(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


ROWS = [("en", "One two three four, one TWO three! two\tthree  five")] * 12 + [("en", "a b c d e f g h. i j k l m n o p")] * 11 + \
    [("en", "x y. y x; x\r\ny x y x y x y x")] * 10 + [(None, "é É é É. und da ist")] * 10 + [("", "a b")] * 10 + [("de", "a b")] * 9


@pytest.mark.parametrize("longest,share", [(2, 50), (3, 50), (4, 50), (3, 101), (5, 90)])
def test_equals_counting_every_phrase(spark, longest, share):
    assert got(collocations.collocations(table(spark, ROWS), longest, share=share)) == brute(ROWS, longest, share=share)


def test_the_first_of_each_lang(spark):
    assert got(collocations.collocations(table(spark, ROWS), top=3)) == brute(ROWS, top=3)


def test_paths_are_compacted(spark):
    nodes = collocations.graph(table(spark, ROWS), 3, 10)
    flow = collocations.flow(nodes, 2)
    paths = {(r.lang, " ".join(r.words)): r.f for r in collocations.unitigs(nodes, flow, 3).collect()}
    assert paths["en", "a b c d e f g h"] == 11 and paths["en", "i j k l m n o p"] == 11
    assert paths["en", "one two three"] == 24 and paths["en", "two three four"] == 12 and paths["en", "x y x"] == 30


def test_crowded_nodes_are_dealt_to_parts(spark, monkeypatch):
    rows = ROWS + [("en", f"item no {i}") for i in range(300)] * 12
    monkeypatch.setattr(collocations, "LOOK", 1)
    assert {"en item", "en item no"} <= set(collocations.crowded(table(spark, rows)))
    assert got(collocations.collocations(table(spark, rows))) == brute(rows)


def test_odd_rows(spark, odd):
    rows = [(r.lang, r.text) for r in odd.collect()] + [("en", None), (None, None)]
    clash = table(spark, rows).withColumns({c: F.lit("x") for c in ("gram", "c", "node", "phrase", "f", "words", "head", "rank", "n")})
    assert got(collocations.collocations(clash)) == brute(rows)
    assert got(collocations.collocations(odd.limit(0))) == []


def test_large_counts_are_exact(spark):
    """A score of counts whose products pass 64 bits."""
    f = 3_000_000_017
    a, l, r = (F.lit(x).cast("long").cast("decimal(19,0)") for x in (f, f + 5, 2 * f))
    score = spark.range(1).select(F.call_function("div", a * a * F.lit(1_000_000).cast("decimal(7,0)"), l * r).alias("s")).first().s
    assert score == 1_000_000 * f * f // ((f + 5) * 2 * f)

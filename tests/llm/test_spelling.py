import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeward.llm import spelling
from lakeward.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def edits(w, alphabet):
    out = {w[:i] + w[i + 1:] for i in range(len(w))} | {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in alphabet}
    return (out | {w[:i] + c + w[i + 1:] for i in range(len(w)) for c in alphabet}) - {w}


def brute(rows, letters=6, least=5, times=5):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c in spelling.UPPER else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= letters and c >= least}
    alphabet = {c for w in n for c in w}
    near = {w: [v for v in edits(w, alphabet) if v in n] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= times * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def got(df):
    rows = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_equals_brute_force_on_a_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert len(want) > 300 and any(r[1] for r in want) and any(r[4] > 1 for r in want)
    assert got(QUERIES["op12_spelling"][0](spark, SF)) == want


def test_chains_ties_and_accents(spark, docs):
    words = {"kitten": 130, "kittens": 26, "kittené": 5, "mitten": 130, "xitten": 5, "xittenß": 5, "bitten": 130, "garden": 7,
             "gardens": 7, "short": 99, "Écolier": 25, "écolier": 5, "colier": 5}
    rows = [(i, " ".join([w] * n)) for i, (w, n) in enumerate(words.items())]
    out = got(spelling.variants(docs(rows)))
    assert out == brute(rows)
    by = {r[0]: r for r in out}
    assert by["xitten"][1] == "bitten" and by["xittenß"][2] == "xittenß"        # ties: the smallest; 5 is not 5 x 5
    assert by["kittens"][2] == "kitten" and "Écolier" in by                     # only A-Z is lower-cased


def test_a_root_is_the_end_of_a_chain(spark):
    forms = spark.createDataFrame([(str(i), str(i + 1)) for i in range(37)], "word string, form string")
    assert {(r.word, r.root) for r in spelling.roots(forms).collect()} == {(str(i), "37") for i in range(37)}
    assert spelling.roots(forms.limit(0)).count() == 0


def test_odd_rows_and_long_words(spark, odd, docs):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    long = "q" * 3_000
    rows += [(100 + i, f"{long} {long}z kitten") for i in range(5)]
    want = brute([(i, t.replace(long, "longword") if t else t) for i, t in rows])
    assert len(got(spelling.variants(docs(rows), least=3))) >= len(want) - 2
    out = {len(r[0]): r for r in got(spelling.variants(docs(rows))) if len(r[0]) > 100}
    assert out[3_000][4] == 1 and out[3_001][4] == 1
    empty = odd.limit(0)
    assert spelling.variants(empty).count() == 0
    clash = odd.withColumns({c: F.lit("x") for c in ("word", "n", "id", "key", "h", "run", "form", "root")})
    assert spelling.variants(clash).count() == spelling.variants(odd).count()


@pytest.mark.parametrize("symbols,n,edits_at_once", [(2, 5, 1 << 19), (6, 9, 1 << 19), (3, 9, 8), (6, 1, 8)])
def test_neighbourhoods_are_full(symbols, n, edits_at_once):
    s = np.random.default_rng(n).integers(1, symbols + 1, (5, n)).astype(np.uint64)
    found = [set() for _ in s]
    for rows, h in spelling.neighbourhoods(s, symbols, edits_at_once):
        for r, x in zip(rows, h):
            found[r].add(int(x))
    for row, have in zip(s.tolist(), found):
        text = "".join(map(str, row))
        around = {text} | edits(text, [str(c) for c in range(1, symbols + 1)])
        assert {int(spelling.keys(np.array([[int(c) for c in t]], np.uint64))[0]) for t in around if t} <= have
        assert len(have) == len(around)


def test_differ_by_one():
    for a in ("", "a", "ab", "abc", "abcabc", "aaaa"):
        for b in ("", "a", "ab", "abc", "abd", "xabc", "abxcabc", "aaa", "aaab"):
            assert spelling.differ_by_one(a, b) == (b in edits(a, "abcdx") and a != b)

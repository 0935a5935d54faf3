"""Divergence rules, containment search and sharding (built-in functions only)."""

import collections
import math
import random
import re

import duckdb
import pytest
from odd_rows import ODD
from pyspark.sql import functions as F

from lakeward.llm import containment as C
from lakeward.llm import divergence as D
from lakeward.llm import extendible as X
from lakeward.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_rules(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    times = collections.Counter(windows)
    covered = {j for i, w in enumerate(windows) if times[w] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed)


def brute_js(p, q):
    def kl(a, m):
        return sum(x * math.log2(x / m[k]) for k, x in a.items() if x)
    m = {k: (p.get(k, 0) + q.get(k, 0)) / 2 for k in set(p) | set(q)}
    return math.sqrt(max(0.0, (kl(p, m) + kl(q, m)) / 2))


def share(counts):
    total = sum(counts.values())
    return {k: n / total for k, n in counts.items()} if total else {}


def char_counts(text):
    out = collections.Counter()
    for c in text:
        out["space" if c in " \t\n\v\f\r" else "symbol" if c in "#*$%&|<>" else "upper" if c.isupper() else "letter" if c.isalpha()
            else "digit" if c.isdecimal() else "other"] += 1
    return out


def word_counts(text, lang):
    known = D.COMMON[lang].split()
    return collections.Counter(w.lower() if w.lower() in known else "" for w in WORD.findall(text))


def test_rules_and_distances(spark):
    rng = random.Random(7)
    vocab = {"en": ["the", "of", "The", "x1", "cat", "##", "a|b"], "de": ["der", "Die", "und", "Wort", "ÄÖ", "9"]}
    rows = []
    for i in range(60):
        lang = rng.choice(["en", "de"])
        rows.append((i, "".join(rng.choice(vocab[lang]) + rng.choice([" ", " ", "\n"]) for _ in range(rng.randint(0, 120))), lang))
    rows += [(100 + i, t, None) for i, (_, t) in enumerate(ODD)]
    got = {r["doc_id"]: r for r in D.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    chars, words = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for _, text, lang in rows:
        chars[lang] += char_counts(text or "")
        if lang:
            words[lang] += word_counts(text, lang)
    assert len(got) == len(rows)
    for i, text, lang in rows:
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == brute_rules(text)
        text, usual = text or "", True
        if len(text) >= D.LEAST_CHARS:
            js = brute_js(share(char_counts(text)), share(chars[lang]))
            assert r["chars_js"] == pytest.approx(js, abs=2e-6)
            usual &= js <= D.CHARS_LIMIT + D.CHARS_NOISE / math.sqrt(len(text))
        else:
            assert r["chars_js"] is None
        if lang and r["n_words"] >= D.LEAST_WORDS:
            js = brute_js(share(word_counts(text, lang)), share(words[lang]))
            assert r["words_js"] == pytest.approx(js, abs=2e-6)
            usual &= js <= D.WORDS_LIMIT + D.WORDS_NOISE / math.sqrt(r["n_words"])
        else:
            assert r["words_js"] is None
        assert r["kept"] == (usual and not r["base_failed"])


def test_rules_on_empty_table_and_extra_columns(odd):
    clash = odd.withColumn("n_words", F.lit("x")).withColumn("words", F.lit(1)).withColumn("kept", F.lit(0))
    assert D.judge(clash).count() == len(ODD)
    assert D.judge(odd.limit(0)).count() == 0


def tokens(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def brute_pairs(docs, items):
    def sh(t):
        w = tokens(t)
        return {" ".join(w[i:i + 5]) for i in range(len(w) - 4)}
    out = {}
    for i, t in items:
        s = sh(t)
        for d, u in docs:
            n = len(s & sh(u))
            if s and n >= 0.8 * len(s) - 1e-9:
                out[d, i] = max(out.get((d, i), (0, 0)), (n / len(s), n))
    return {k: v[1] for k, v in out.items()}


def test_containment_equals_brute_force(spark, docs):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(3, 70)))) for i in range(40)] + [(50, None), (51, ""), (3, "another text of id three here and now")]
    rows = []
    for d in range(80):
        body = rng.choices(words, k=rng.randint(0, 200))
        if d % 2:
            text = rng.choice(items[:40])[1].split()
            for _ in range(rng.randint(0, 4)):
                text[rng.randrange(len(text))] = "changed"
            at = rng.randint(0, len(body))
            body[at:at] = text
        rows.append((d, rng.choice([" ", ", ", "\n"]).join(body).upper() if d % 3 else " ".join(body)))
    rows += ODD + [rows[1], rows[1], (1, "a different text under a known id")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["n_shared"] for r in C.pairs(docs(rows), bench).collect()}
    assert got == brute_pairs(rows, items) and len(got) > 10
    hit = {(d, t) for d, t in rows for i in items if brute_pairs([(d, t)], [i])}
    left = C.without(docs(rows), bench)
    assert sorted(str((r["doc_id"], r["text"])) for r in left.collect()) == sorted(str(r) for r in rows if r not in hit)
    assert left.columns == docs(rows).columns
    assert C.pairs(docs(rows), bench.limit(0)).count() == 0 and C.without(docs(rows).limit(0), bench).count() == 0


def test_sketch_never_misses():
    """Any set that lacks at most a fifth of an item holds a value of its sketch."""
    for q in range(1, 300):
        largest = 2 ** (math.floor(math.log2(q)) + 1) - 1
        assert min(q, math.floor(0.2 * largest + 1e-9) + 1) > q - math.ceil(0.8 * q - 1e-9)


def brute_shards(rows, limit):
    import hashlib
    bits = [f"{int(hashlib.md5(str('' if k is None else k).encode()).hexdigest()[:15], 16):060b}" for k, _ in rows]
    out = []
    for b in bits:
        for d in range(61):
            same = [n for x, (_, n) in zip(bits, rows) if x[:d] == b[:d]]
            if sum(same) <= limit or len(same) == 1:
                out.append((b[:d], sum(same)))
                break
        else:
            out.append(None)
    return out


@pytest.mark.parametrize("limit", [1, 50, 400, 10 ** 9])
def test_shards_equal_brute_force(spark, limit):
    rng = random.Random(limit)
    rows = [(i if i else None, rng.choice([0, 1, 5, 60, 500])) for i in range(150)]
    table = spark.createDataFrame(rows, "k long, n long")
    got = {r["k"]: (r["shard"], r["shard_bytes"]) for r in X.assign(table, "k", F.col("n"), limit).collect()}
    assert got == {k: s for (k, _), s in zip(rows, brute_shards(rows, limit))}


def test_a_hot_key_is_split_too(spark):
    rows = [(7, 10)] * 200 + [(i, 10) for i in range(100, 200)]
    out = X.assign(spark.createDataFrame(rows, "k long, n long").withColumn("shard", F.lit("x")), "k", F.col("n"), 100)
    shards = collections.Counter(r["shard"] for r in out.collect())
    assert sum(shards.values()) == 300 and max(shards.values()) <= 10
    prefixes = sorted(shards)
    assert not any(b.startswith(a) for a, b in zip(prefixes, prefixes[1:]))
    assert X.assign(spark.createDataFrame([], "k long, n long"), "k", F.col("n"), 10).count() == 0


@pytest.mark.parametrize("name", ["op5_divergence", "op7_extendible_sharding", "op9_containment"])
def test_queries_with_sql(spark, name):
    from tools.oracle_check import rows
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    fn, sql = QUERIES[name]
    assert rows(fn(spark, sf).toPandas()) == rows(con.sql(sql).df())

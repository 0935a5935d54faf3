"""Compression classifier, cross-entropy difference, surrogates, wrappers, pipeline."""

import html as htmllib
import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pytest
from odd_rows import ODD
from pyspark.sql import functions as F

from lakeward.llm import compress_quality as Q
from lakeward.llm import cross_entropy as E
from lakeward.llm import surrogates as S
from lakeward.llm import wrappers as W
from lakeward.llm.queries import QUERIES
from lakeward.session import ARROW_BATCH

SF = "/root/testdata/sf0.01"


def test_classifier_on_held_out_labels(spark):
    rows = QUERIES["op2_compress_quality"][0](spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    pdf = rows.join(labels, "doc_id").toPandas()
    held = pdf[pdf["held_out"]]
    assert (held["predicted"] == held["quality"]).mean() > 0.97
    assert held[held["quality"] == 1]["predicted"].mean() > 0.98
    assert pdf["score"].between(0, 1).all() and rows.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_classifier_takes_odd_rows_and_missing_classes(spark, odd):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in Q.score(odd, Q.train(odd, none)).collect()} == {0.5}
    one = spark.createDataFrame([(5, 1), (6, 1), (5, 0), (7, None), (None, 1)], "doc_id long, quality int")
    assert all(r["predicted"] == 1 for r in Q.score(odd, Q.train(odd, one)).collect())
    clash = odd.withColumn("score", F.lit("x")).withColumn("predicted", F.lit("y"))
    out = Q.score(clash, Q.train(clash, one), with_rows=True)
    assert out.columns == clash.columns and out.count() == len(ODD)
    assert Q.score(odd.limit(0), Q.train(odd, one)).count() == 0


def brute_models(texts, target, size):
    """Bigram models counted with plain dictionaries."""
    words = [(t or "").lower().encode().split() for t in texts]
    top = sorted(Counter(w for ws in words for w in ws if len(w) <= E.LONGEST).items(), key=lambda x: (-x[1], x[0]))[:size - 1]
    ids = {w: i + 1 for i, (w, _) in enumerate(top)}
    counts = np.zeros((2, size, size))
    for ws, is_target in zip(words, target):
        seq = [0] + [ids.get(w, 0) for w in ws]
        for a, b in zip(seq, seq[1:]):
            counts[int(is_target), a, b] += 1
    counts[0] *= counts[1].sum() / counts[0].sum()
    return ids, E.losses(counts[1]), E.losses(counts[0])


def test_cross_entropy_equals_counting_by_hand(spark, docs):
    rng = random.Random(2)
    texts = [" ".join(rng.choices(["a", "B", "c", "rare%d" % i, "x" * 99], [8, 5, 4, 1, 1], k=rng.randint(0, 40))) for i in range(50)]
    texts += [None, "", "A a"]
    target = [i % 3 == 0 for i in range(len(texts))]
    table = docs(texts)
    marks = spark.createDataFrame([(i,) for i, t in enumerate(target) if t] * 2 + [(None,)], "doc_id long")
    models = E.train(table, marks, size=16)
    ids, t, b = brute_models(texts, target, 16)
    assert models.ids == ids
    assert np.allclose(models.target, t) and np.allclose(models.background, b)
    assert np.allclose(np.exp(-models.target).sum(1), 1, atol=1e-5)
    for r in E.score(table, models).collect():
        seq = [0] + [ids.get(w, 0) for w in (texts[r["doc_id"]] or "").lower().encode().split()]
        n = len(seq) - 1
        assert r["n_tokens"] == n
        want = sum(t[x, y] - b[x, y] for x, y in zip(seq, seq[1:])) / n if n else 0
        assert r["score"] == pytest.approx(want, abs=1e-4)


@pytest.mark.parametrize("word, pair, bucket", [(1 / 50_000, 1 / 4_000, 10 ** 6), (0.02, 0.02, 50), (2, 2, 100)])
def test_cross_entropy_of_all_words(spark, docs, monkeypatch, word, pair, bucket):
    """More words than a closed vocabulary has, against plain dictionaries; nothing, some or all frequent."""
    monkeypatch.setattr(E, "FREQUENT_WORD", word)
    monkeypatch.setattr(E, "FREQUENT_PAIR", pair)
    monkeypatch.setattr(E, "BUCKET", bucket)
    rng = random.Random(2)
    texts = [" ".join(rng.choices(["a", "B", "c", "w%d" % rng.randrange(5000), "x" * 99 + str(i % 4)], [8, 5, 4, 30, 1], k=rng.randint(0, 40)))
             + " " + " ".join(f"own{i}_{k}" for k in range(60)) for i in range(50)]
    texts += [None, "", "A a", "A a", " é É\t日本\x0bé ", "one", texts[0]]
    target = [i % 3 == 0 for i in range(len(texts))]
    marks = spark.createDataFrame([(i,) for i, t in enumerate(target) if t] * 2 + [(None,)], "doc_id long")
    split = [(t or "").lower().encode().split() for t in texts]
    assert len({w for ws in split for w in ws}) > E.VOCABULARY
    pairs, ones, before = Counter(), Counter(), Counter()
    for ws, side in zip(split, target):
        for a, b in zip([None, *ws], ws):
            pairs[side, a, b] += 1
            ones[side, b] += 1
            before[side, a] += 1
    tokens = {s: sum(n for (k, _), n in ones.items() if k == s) for s in (True, False)}
    distinct = len({w for _, w in ones})

    def loss(side, a, b):
        x = 1 if side else tokens[True] / tokens[False]
        each = (x * ones[side, b] + 1) / (x * tokens[side] + distinct)
        return -np.log((x * pairs[side, a, b] + E.STRENGTH * each) / (x * before[side, a] + E.STRENGTH))
    got = E.difference(docs(texts), marks).collect()
    assert len(got) == len(texts)
    for r in got:
        ws = split[r["doc_id"]]
        assert r["n_tokens"] == len(ws)
        for side, name in ((True, "target_loss"), (False, "background_loss")):
            want = sum(loss(side, a, b) for a, b in zip([None, *ws], ws)) / len(ws) if ws else 0
            assert r[name] == pytest.approx(want, abs=1e-9)
        assert r["score"] == pytest.approx(r["target_loss"] - r["background_loss"])


def test_cross_entropy_sends_a_chunks_bigrams_once(spark, docs, monkeypatch):
    """What chunks and buckets exchange grows neither with the buckets nor with the texts that share a bigram."""
    rng = random.Random(3)
    texts = [" ".join(rng.choices(["v%d" % i for i in range(60)], k=50)) for _ in range(400)]
    marked = docs(texts).select("doc_id", "text", (F.col("doc_id") % 3 == 0).alias("target"), F.col("doc_id").alias("at"))
    monkeypatch.setattr(E, "WORTH", 1)
    monkeypatch.setattr(E, "BUCKET", 10_000)            # two chunks of 10,000 tokens
    model = E._frequent(marked.select("text", "target"))
    shared = spark.sparkContext.broadcast(model)
    chunked = E._chunked(marked, 20_000)
    split = {r["doc_id"]: (r["chunk"], r["text"].split()) for r in chunked.collect()}
    assert len({c for c, _ in split.values()}) == 2
    asked = {(c, a, b) for c, ws in split.values() for a, b in zip([None, *ws], ws)}
    _, _, pair, _ = E.bigrams(texts)
    rest = len(asked) - 2 * len(set(pair.tolist()) & set(model.pairs.tolist()))
    for buckets in (1, 16, 256):
        got = E._answers(chunked, shared, buckets).collect()
        assert len(got) <= 2 * buckets and len(got) == len({(r["chunk"], r["bucket"]) for r in got})
        assert sum(len(E._whole(r["pairs"], r["large_pairs"], 2)) for r in got) <= len(asked)
        assert sum(len(E._whole(r["pairs"], r["large_pairs"], 2)) for r in got) >= rest


def test_cross_entropy_holds_little_for_each_token():
    """Most bytes a token that a chunk takes at once while its bigrams are made, told apart and looked up."""
    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randrange(400_000)}" for _ in range(1000)) for _ in range(1200)]
    E.bigrams(texts[:10])                               # makes the powers, which stay
    tracemalloc.start()
    try:
        def most(f, *args):
            tracemalloc.reset_peak()
            held, out = tracemalloc.get_traced_memory()[0], f(*args)
            return (tracemalloc.get_traced_memory()[1] - held) / 1_200_000, out
        size, (_, word, pair, _) = most(E.bigrams, texts)
        assert size < 45
        assert most(E._distinct, word, pair, word[:0], 7)[0] < 85
        assert most(E._lookup, np.sort(word[:100]), word)[0] < 13
    finally:
        tracemalloc.stop()


def test_cross_entropy_hands_texts_over_in_small_batches(spark, docs):
    name, most = ARROW_BATCH
    before = spark.conf.get(name, None)
    spark.conf.unset(name)
    try:
        E.difference(docs(["a b", "c"]), docs(["a b"]))
        assert spark.conf.get(name) in (most, str(4 << 20))
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def test_cross_entropy_of_many_rows_without_words(spark, docs, monkeypatch):
    """Rows without words make chunks too, also without any bigram; large counts come back whole."""
    monkeypatch.setattr(E, "ROWS", 5)
    monkeypatch.setattr(E, "FREQUENT_WORD", 2)
    monkeypatch.setattr(E, "FREQUENT_PAIR", 2)
    texts = ["", None, " "] * 20 + ["a b " * 200] * 3
    table = docs(texts)
    got = {r["doc_id"]: r for r in E.difference(table, table.where("doc_id = 60")).collect()}
    assert sorted(got) == list(range(63))
    assert {(got[i]["n_tokens"], got[i]["target_loss"], got[i]["background_loss"]) for i in range(60)} == {(0, 0.0, 0.0)}
    # 400 tokens of the target, 800 of the background counted at half: equal models
    each = (200 + 1) / (400 + 2)
    want = -(np.log((1 + E.STRENGTH * each) / (1 + E.STRENGTH)) + 200 * np.log((200 + E.STRENGTH * each) / (200 + E.STRENGTH))
             + 199 * np.log((199 + E.STRENGTH * each) / (199 + E.STRENGTH))) / 400
    for i in (60, 61, 62):
        assert got[i]["n_tokens"] == 400 and got[i]["score"] == pytest.approx(0, abs=1e-9)
        assert got[i]["target_loss"] == pytest.approx(want, abs=1e-9)


def test_cross_entropy_of_all_words_on_odd_rows(spark, odd):
    none = spark.createDataFrame([], "doc_id long")
    clash = odd.withColumn("target", F.lit("x")).withColumn("score", F.lit(1)).withColumn("h", F.lit(2))
    rows = E.difference(clash, none).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(d for d, _ in ODD)
    assert E.difference(odd.limit(0), none).count() == 0


def test_cross_entropy_on_odd_rows(spark, odd):
    none = spark.createDataFrame([], "doc_id long")
    clash = odd.withColumn("target", F.lit("x")).withColumn("score", F.lit(1))
    assert E.score(clash, E.train(clash, none)).count() == len(ODD)
    assert E.score(odd.limit(0), E.train(odd.limit(0), none)).count() == 0


KEY = b"test key"
PERSONAL = """Mr. John Smith met Frau ANNA MÜLLER and Dr Peter Weiss; Smith said +1 (988) 555-2485 or 988-555-2485.
SMITH, 王小明先生, господин Пётр Иванов, 4111 1111 1111 1111, DE89 3704 0044 0532 0130 00, 123-45-6789, a.B9@Mail.example, A.b9@mail.example, 42.144.35.254 10.1.2.3"""


def test_surrogates_keep_type_format_and_coreference():
    found = S.entities(PERSONAL)
    new = {(k, PERSONAL[a:b]): S.render(S.surrogate(KEY, k, c), PERSONAL[a:b], k, c) for a, b, k, c in found}
    kinds = Counter(k.split(":")[0] for _, _, k, _ in found)
    assert kinds == {"given": 4, "family": 6, "person": 1, "card": 1, "iban": 1, "ssn": 1, "email": 2, "ip": 2, "phone": 2}
    by = {m: v for (k, m), v in new.items()}
    assert by["SMITH"] == by["Smith"].upper() and by["ANNA"].isupper()
    assert S.luhn(re.sub(r"\D", "", by["4111 1111 1111 1111"])) and re.fullmatch(r"4\d{3} \d{4} \d{4} \d{4}", by["4111 1111 1111 1111"])
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", by["+1 (988) 555-2485"])
    assert re.sub(r"\D", "", by["+1 (988) 555-2485"])[1:] == re.sub(r"\D", "", by["988-555-2485"])
    assert by["a.B9@Mail.example"].lower() == by["A.b9@mail.example"].lower()
    assert by["10.1.2.3"].startswith("10.") and S.script(by["Пётр"]) == "cyrillic" and all("一" <= c <= "鿿" for c in by["王小明"])
    assert any(by["John"].endswith(e) for e in S.ENDINGS["latin", "m"]) and any(by["ANNA"].lower().endswith(e) for e in S.ENDINGS["latin", "f"])
    assert all(v != m for (_, m), v in new.items())


def test_surrogates_stay_distinct_when_draws_collide(spark, docs, monkeypatch):
    """With a tiny space many first draws collide, also with the corpus's own entities."""
    texts = [f"call 20{i % 10}-555-{1000 + i} or Mr {n}" for i, n in enumerate(["Smith", "Jones"] * 60)]
    table = docs(texts)
    real = S.surrogate

    def small(key, kind, canon, attempt=0):
        value = real(key, kind, canon, attempt)
        return f"{int(value) % 300:010d}" if kind == "phone" else value
    monkeypatch.setattr(S, "surrogate", small)

    from pyspark import cloudpickle as spark_pickle
    spark_pickle.register_pickle_by_value(S)
    try:
        found = S.mentions(table)
        late = {(r["kind"], r["canon"]): r["attempt"] for r in S.attempts(found, KEY).collect()}
    finally:
        spark_pickle.unregister_pickle_by_value(S)
    canon = {(r["kind"], r["canon"]) for r in found.collect()}
    drawn = {e: small(KEY, *e, late.get(e, 0)) for e in canon}
    assert len(late) > 5 and len(set((k, v) for (k, _), v in drawn.items())) == len(canon)
    assert not {(k, v) for (k, _), v in drawn.items()} & canon


def test_surrogates_of_documents(docs, odd):
    rows = docs([(1, PERSONAL), (2, "Smith alone, and write to A.b9@mail.example"), (3, None), (1, PERSONAL)])
    out = {}
    for r in S.replace(rows, KEY).collect():
        out.setdefault(r["doc_id"], r)
    assert S.replace(rows, KEY).count() == 4 and out[3]["text"] is None
    mail = re.findall(r"\S+@\S+[a-z]", out[1]["text"])
    assert mail[0].lower() in out[2]["text"].lower() and "mail.example" not in out[1]["text"]
    assert S.replace(odd, KEY).count() == len(ODD) and S.replace(odd.limit(0), KEY).count() == 0
    clash = odd.withColumn("late", F.lit(1)).withColumn("k1", F.lit(2))
    assert S.replace(clash, KEY).count() == len(ODD)


def article(page):
    """The pages of the test tables: the article's headings and paragraphs."""
    inner = page[page.index("<article>") + 9:].split("</article>")[0]
    parts = [re.sub(r"<[^>]*>", "", re.sub("<br>", " ", p)) for p in re.split(r"</?(?:p|h1)>", inner)]
    return "\n".join(t for t in (" ".join(htmllib.unescape(p).split()) for p in parts) if t)


def test_pages_of_the_test_table(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    want = {r["page_id"]: article(r["html"]) for r in pages.collect()}
    got = QUERIES["op10_html_wrappers"][0](spark, SF).collect()
    assert {r["page_id"]: r["text"] for r in got} == want and all(r["n_chars"] == len(r["text"]) for r in got)


def test_wrapper_without_article_element():
    """The region is found by what varies; shared texts are template."""
    rng = random.Random(1)

    def page(i):
        body = "".join(f"<p>{' '.join(rng.choices(['w%d' % k for k in range(99)], k=30))} &amp; p{i}</p>" for _ in range(rng.randint(1, 5)))
        ad = "<div class='ad'>buy</div>" if i % 2 else ""
        return (f"<html><body><div class=top><ul><li><a href=/>Home</a></li><li><a href=/x>News{i}</a></li></ul></div>{ad}"
                f"<div id=story><h2>Title {i}</h2><p>Share this page</p>{body}<section class='comments'><p>me too</p></section></div>"
                f"<div class=foot>All rights</div></body></html>")
    sample = [page(i) for i in range(6)]
    wrapper = W.infer(sample)
    assert wrapper["region"] == "body/div.story" and "All rights" in wrapper["template"]
    assert "(<div.ad>)?" in wrapper["expression"] or "?" in wrapper["expression"]
    assert ")+" in wrapper["expression"] and "#SLOT" in wrapper["expression"]
    text = W.blocks(page(9), wrapper)
    assert text[0] == "Title 9" and all("& p9" in t for t in text[1:]) and len(text) > 1


@pytest.mark.parametrize("page, want", [
    ("<article><h1>A&nbsp; b</h1><p>one<p>two <b>bo</b>ld<br>x</article>", ["A b", "one", "two bold x"]),
    ("<nav><article>card</article></nav><article>real<aside>no</aside> text</article>", ["real", "text"]),
    ("<main><div class='cookie-notice'>ok?</div><p>t &lt;b&gt; &am</main><footer>f</footer>", ["t <b> &am"]),
    ("<p>no region</p><script>var a='<p>x</p>'</script><form>f</form>", ["no region"]),
    ("<article><p>cut off <a href='x", ["cut off"]),
    ("<article><p title='a>b'>q</p><!-- <p>c</p> --><textarea>t</textarea></article>", ["q"]),
    ("plain & text", ["plain & text"]), ("", []), ("<", ["<"]), ("<article></article>", []),
])
def test_blocks(page, want):
    assert W.blocks(page, W.infer([page])) == want


def test_pages_with_odd_rows(spark):
    rows = [(1, None, "<article>x</article>"), (2, "no host", None), (3, "https://a.example/1", ""), (3, "https://a.example/1", ""),
            (None, "https://A.example:80/2", "<p>" + "y " * 300_000 + "</p>"), (5, "//b.example", "<div>" * 3000 + "deep")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit(1)).withColumn("text", F.lit(2))
    got = W.extract(pages).collect()
    assert Counter((r["page_id"], r["text"][:4], r["n_chars"]) for r in got) == Counter(
        [(1, "x", 1), (2, "", 0), (3, "", 0), (3, "", 0), (None, "y y ", 599_999), (5, "deep", 4)])
    assert W.extract(pages.limit(0)).count() == 0


def test_pipeline_equals_its_parts(spark):
    """Stage by stage against plain Python over the same rows."""
    import corpus_pipeline as P
    from test_secret_scan import brute as base_spans
    from test_simhash import brute_components, brute_fingerprint
    from test_text_rules import brute_pairs
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = docs.columns
    steps = [docs]
    for _, stage in P.STAGES:
        steps.append(stage(spark, steps[-1], sf).persist())
    assert all(s.columns == names for s in steps[:-1])
    rows = [{r["doc_id"]: r["text"] for r in s.collect()} for s in steps[:-1]]
    before = list(rows[1].items())
    root = brute_components([(d, brute_fingerprint(t)) for d, t in before])
    assert set(rows[2]) == {d for (d, _), r in zip(before, root) if d == r}
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    leaked = {d for d, _ in brute_pairs(list(rows[2].items()), bench)}
    assert set(rows[3]) == set(rows[2]) - leaked
    assert set(rows[4]) == set(rows[3])
    for d, text in rows[4].items():
        spans = base_spans(rows[3][d])
        assert not base_spans(text) and (text == rows[3][d]) == (not spans)
    from test_bpe import TIK
    for r in steps[-1].collect():
        assert list(r["token_ids"]) == TIK.encode_ordinary(rows[4][r["doc_id"]]) and r["n_tokens"] == len(r["token_ids"])

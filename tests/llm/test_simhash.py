import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lakeward.llm import simhash as H
from lakeward.llm.components import components
from odd_rows import ODD


def brute_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [b" ".join(words)]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows):
    """doc_id -> smallest id reachable, by comparing all pairs."""
    fp = [f for _, f in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if (fp[i] ^ fp[j]).bit_count() <= 4:
                group[root(i)] = root(j)
    low = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            low[root(i)] = min(low.get(root(i), doc_id), doc_id)
    return [low.get(root(i)) for i in range(len(rows))]


def test_fingerprint():
    rng = random.Random(1)
    for text in [t for _, t in ODD if not t or len(t) < 1000] + [
            " ".join(rng.choices(["a", "B", "c,", "dd", "É"], k=n)) for n in (1, 3, 4, 5, 50, 5000)]:
        assert H.fingerprint(text) == brute_fingerprint(text)


def test_hashes_are_sparks(spark):
    from pyspark.sql import functions as F
    got = spark.createDataFrame([("a b c d",)], "s string").select(F.xxhash64("s")).first()[0]
    assert got % (1 << 64) == xxhash.xxh64_intdigest(b"a b c d", 42)


@pytest.mark.parametrize("distance", [0, 1, 2, 3, 4, 6])
def test_variants_meet(distance):
    rng = random.Random(distance)
    masks = H.variants(distance)
    for _ in range(500):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(0, distance)):
            b ^= 1 << bit
        assert any(a & m == b & m for m in masks)


def test_blocks_meet():
    rng = random.Random(2)
    for _ in range(500):
        used = rng.choice(H.variants(4))
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample([i for i in range(64) if not used >> i & 1], 4):
            b ^= 1 << bit
        assert any(a & m == b & m for m in H.blocks(used, 4))


@pytest.mark.parametrize("most, work", [(1 << 20, 10 ** 8), (60, 10 ** 8), (1 << 20, 200)])
def test_groups_equal_brute_force(spark, most, work):
    """Random fingerprints, chains, and a dense set; small limits force splitting."""
    rng = random.Random(most + work)
    fps = [rng.getrandbits(64) for _ in range(150)]
    chain = rng.getrandbits(64)
    for i in range(40):
        chain ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5)))
        fps.append(chain)
    centre = rng.getrandbits(64)
    for _ in range(120):
        fps.append(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))))
    fps = list(dict.fromkeys(fps))
    table = spark.createDataFrame([(int(np.array(f, np.uint64).view(np.int64)),) for f in fps], "fp long")
    linked = components(H.links(table, 4, most, work)).collect()
    root = {r["node"]: r["root"] for r in linked}
    signed = [int(np.array(f, np.uint64).view(np.int64)) for f in fps]
    want = brute_components(list(zip(signed, fps)))
    assert [root.get(s, s) for s in signed] == want


def test_operator_on_odd_rows(docs, odd):
    got = H.near_duplicates(odd).collect()
    assert len(got) == len(ODD)
    fps = [(d, brute_fingerprint(t)) for d, t in ODD]
    want = sorted((str(d), f"{f:016x}", c) for (d, f), c in zip(fps, brute_components(fps)))
    assert sorted((str(r["doc_id"]), r["fingerprint"], r["component_id"]) for r in got) == want
    assert H.near_duplicates(odd.limit(0)).count() == 0


def test_one_of_each(docs, odd):
    out = H.one_of_each(odd)
    assert out.columns == odd.columns
    # 1 to 3 have no words; 5 and 6, and the rows with id 7, are alike
    assert sorted(r["doc_id"] or 0 for r in out.collect()) == [0, 1, 4, 5, 7, 8, 9]


def test_one_of_each_with_clashing_columns(spark, odd):
    """The helper columns' names are taken already, by the documents' own columns."""
    names = ["id", "_id", "fp", "n", "first", "row", "component_id", "fingerprint"]
    wide = odd.select("*", *[F.lit(i).alias(c) for i, c in enumerate(names)])
    out = H.one_of_each(wide)
    assert out.columns == wide.columns
    got = out.collect()
    assert sorted(r["doc_id"] or 0 for r in got) == [0, 1, 4, 5, 7, 8, 9]
    assert all([r[c] for c in names] == list(range(len(names))) for r in got)
    assert H.one_of_each(wide.limit(0)).count() == 0


def test_one_of_each_with_repeated_ids(docs):
    """Rows of one id in different groups: each group keeps its own row."""
    a, b, c = ("alpha beta gamma delta epsilon", "one two three four five six", "seven eight nine ten eleven")
    rows = [(1, a), (5, a), (5, b), (5, b), (6, b), (7, c), (None, c + " x y z w"), (None, "quite another text than the others")]
    got = sorted(((r["doc_id"] or 0, r["text"]) for r in H.one_of_each(docs(rows)).collect()))
    assert got == sorted([(1, a), (5, b), (7, c), (0, c + " x y z w"), (0, "quite another text than the others")])


def test_components_of_a_long_path(spark):
    n = 60
    links = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1000), (2000, 2001), (2001, 2000)], "a long, b long")
    root = {r["node"]: r["root"] for r in components(links).collect()}
    assert root == {**{i: 0 for i in range(1, n + 1)}, 2001: 2000}

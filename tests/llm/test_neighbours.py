import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeward.llm import neighbours
from lakeward.llm.queries import QUERIES

VECTORS = "vec_id long, embedding array<float>, label int"


def brute(rows, k=20):
    rows = [(i, np.array(v, float)) for i, v in rows]
    out = {}
    for at, (i, v) in enumerate(rows):
        if i % 20 == 0:
            others = sorted(((-float(v @ w), j) for n, (j, w) in enumerate(rows) if n != at))[:k]
            out.setdefault(i, []).extend((rank, j, -s) for rank, (s, j) in enumerate(others, 1))
    return out


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], 0) for i, v in rows], VECTORS)


def found(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {q: sorted(v) for q, v in out.items()}


def test_recall_and_scores_on_a_table(spark):
    e = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").collect()
    want = brute([(r.vec_id, r.embedding) for r in e])
    got = found(QUERIES["op13_neighbours"][0](spark, "/root/testdata/sf0.1"))
    assert got.keys() == want.keys() and all([r[0] for r in v] == list(range(1, 21)) for v in got.values())
    hits = [len({r[1] for r in got[q]} & {r[1] for r in want[q]}) / 20 for q in want]
    assert np.mean(hits) >= 0.95
    exact = {(q, j): s for q, v in want.items() for _, j, s in v}
    assert all(s == pytest.approx(exact[q, j], abs=1e-12) for q, v in got.items() for _, j, s in v if (q, j) in exact)


def test_few_rows_ties_and_lengths(spark):
    rng = np.random.default_rng(3)
    rows = [(i, np.float32(rng.normal(size=5) * 10.0 ** rng.integers(-3, 4))) for i in range(0, 60, 5)]
    rows += [(7, rows[1][1]), (6, rows[1][1]), (0, rows[2][1]), (20, rows[0][1])]           # ties, and ids of several rows
    got, want = found(neighbours.nearest(table(spark, rows), F.col("id") % 20 == 0)), brute(rows)
    assert got.keys() == want.keys()
    for q in want:
        assert sorted(got[q]) == [pytest.approx(x) for x in sorted(want[q])]


def test_odd_rows_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1, 0]), (1, [0.5, 0.5]), (20, None), (40, [0, 0]), (2, [nan, 1]), (3, [inf, 1]), (4, [None, 1]), (None, [1, 1]),
            (60, [1, 2, 3]), (5, []), (6, [-1, 0])]
    t = table(spark, rows).withColumns({c: F.lit(1) for c in ("id", "node", "vector", "code", "scale", "a", "b", "s", "q", "rank")})
    assert found(neighbours.nearest(t, F.col("id") % 20 == 0)) == {0: [(1, 1, 0.5), (2, 6, -1.0)]}
    assert neighbours.nearest(t.limit(0), F.col("id") % 20 == 0).count() == 0
    assert found(neighbours.nearest(t.where("vec_id = 0"), F.col("id") % 20 == 0)) == {}


def test_many_copies_of_a_vector(spark):
    """A node that a third of all rows keep, and copies that tie."""
    rng = np.random.default_rng(5)
    rows = [(i, np.float32([1, 0, 0, 0])) for i in range(300)] + [(300 + i, np.float32(rng.normal(size=4))) for i in range(600)]
    got = found(neighbours.nearest(table(spark, rows), F.col("id") % 20 == 0, k=5, degree=10, beam=100))
    want = brute(rows, 5)
    assert got.keys() == want.keys()
    near = [abs(sum(s for *_, s in got[q]) - sum(s for *_, s in want[q])) < 1e-6 for q in want]
    assert np.mean(near) > 0.9


def test_rounds_and_steps_have_few_shuffles(spark, monkeypatch):
    """A round has five and a step of the search two: many short stages of many tasks are what they cost."""
    rng = np.random.default_rng(6)
    rows = [(i, np.float32(rng.normal(size=4))) for i in range(200)]
    shuffles, cut = {}, neighbours.cut

    def counted(df, name, *args):
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = plan[plan.find("== Initial Plan"):] if "== Initial Plan" in plan else plan
        shuffles.setdefault(name, []).append(len(re.findall(r"(?<![A-Za-z])Exchange ", plan)))
        return cut(df, name, *args)
    monkeypatch.setattr(neighbours, "cut", counted)
    assert len(found(neighbours.nearest(table(spark, rows), F.col("id") % 20 == 0, k=5, degree=10, beam=50))) == 10
    assert len(shuffles["links"]) > 2 and max(shuffles["links"][1:]) <= 5
    assert len(shuffles["beams"]) > 2 and max(shuffles["beams"][1:]) <= 2
    assert "carried" not in shuffles


@pytest.mark.parametrize("few", [0, 10 ** 6])
def test_whole_graph_or_few_of_its_nodes(spark, monkeypatch, few):
    monkeypatch.setattr(neighbours, "FEW", few)
    rng = np.random.default_rng(7)
    rows = [(i, np.float32(rng.normal(size=3))) for i in range(150)]
    got, want = found(neighbours.nearest(table(spark, rows), F.col("id") % 20 == 0, k=5, degree=10, beam=150)), brute(rows, 5)
    assert {q: [r[1] for r in v] for q, v in got.items()} == {q: [r[1] for r in v] for q, v in want.items()}


def test_rows_of_one_neighbour_count_once(spark):
    """What is found again takes no place of another, in Spark's first selection either."""
    rows = [(1, 1, None, False, b"x", 0.5)] + [(1, b, float(b), b % 2 == 0, None, None) for b in (2, 3, 4, 5)] * 3 + [(1, 5, 5.0, False, None, None)]
    t = spark.createDataFrame(rows, "a long, b long, s double, new boolean, code binary, scale double").repartition(4)
    got = {r.b: r for r in neighbours._best(t, "a", "new", 3).collect()}
    assert sorted(got) == [1, 3, 4, 5] and {r.least for r in got.values()} == {3.0}
    assert [got[b].new for b in (1, 3, 4, 5)] == [False, False, True, False]
    assert bytes(got[1].code) == b"x" and got[1].scale == 0.5 and got[4].code is None

"""Approximate nearest neighbours by inner product: a graph made by NN-descent,
searched greedily.

Every vector starts with neighbours chosen by hash.  In each round the vectors
that share a neighbour are compared there, a Spark join bringing the vectors to
the node where they meet, and each keeps the nearest it has seen; only pairs
with a link that is new count.  A search walks the graph from a query's own
node: all queries at once expand the nodes of their beams where the graph has
them, until no beam has a node left to expand.  Graph and beams hold vectors of
one byte a component; the nearest of a beam are then compared exactly.

Rounds and steps of the search are many and mostly short, so each has as few
shuffles as it can: five a round, two a step.  Links and beams have a row of
their node's own (``b`` is the node), which brings its vector along.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeward.llm.shared import cut

#: Neighbours that a node keeps, and the nearest of those that keep it, with
#: which it compares them; links it starts with, few since almost any pair is
#: nearer; rounds, and the share of changed links that ends them.
DEGREE, REVERSE, START, ROUNDS, STILL = 20, 20, 6, 9, 0.02
#: Nodes of a query's beam; of these the nearest are compared exactly.
BEAM, EXACT = 400, 100
#: Nodes whose neighbours a task compares at once.
TOGETHER = 512
#: Nodes to expand, at most, that a step of the search sends to every task, to read these of the graph only.
FEW = 100_000


def prepared(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``node`` (0, 1, 2 ...), ``id``, ``vector`` (doubles), ``code`` (a byte a
    component) and ``scale`` of the vectors that take part, written once.

    Vectors that are null, zero or hold null or non-finite components take no
    part, nor do rows without an id, nor vectors of another length than most have."""
    v = F.col("vector")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
            .where(F.col("id").isNotNull() & v.isNotNull() & finite))
    sizes = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    rows = rows.where(F.size("vector") == (sizes["size"] if sizes else 0))

    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                x = np.stack(b["vector"])
                largest = np.abs(x).max(1)
                code = np.rint(x / largest[:, None] * 127).astype(np.int8)
                b["code"], b["scale"] = [c.tobytes() for c in code], largest / 127
                yield b
    rows = cut(rows.mapInPandas(coded, "id long, vector array<double>, code binary, scale double")
               .withColumn("place", F.monotonically_increasing_id()), "vectors")
    # places are (partition, row): the rows of each partition give the first number of the next, one number a partition
    part = F.shiftright("place", 33)
    counts = sorted(rows.groupBy(part.alias("p")).count().collect())
    firsts, total = [], 0
    for p, n in counts:
        firsts += [F.lit(p), F.lit(total - (p << 33))]
        total += n
    node = F.col("place") + (F.create_map(*firsts)[part] if firsts else F.lit(0))
    return cut(rows.select(node.alias("node"), "id", "vector", "code", "scale"), "nodes")


def _nearest(rows: DataFrame, of: str, k: int) -> DataFrame:
    """The ``k`` rows of each ``of`` with the largest ``s``; Spark keeps no more
    than these of any part before it brings them together."""
    order = Window.partitionBy(of).orderBy(F.desc("s"), "b")
    return rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).drop("place")


def _best(rows: DataFrame, of: str, flag: str, k: int) -> DataFrame:
    """Of rows (``of``, b, s, ``flag``, code, scale), some there more than once: the ``k``
    of each ``of`` with the largest ``s``, ``flag`` if all of them have it, and besides the
    row of its own; with ``least``, the ``s`` that another has to exceed.  Spark keeps no
    more than these of any part before it brings them together, in one shuffle."""
    each = Window.partitionBy(of)
    place = F.dense_rank().over(each.orderBy(F.desc(F.col("b") == F.col(of)), F.desc("s"), "b"))      # one for the same b
    best = (rows.withColumn("place", place).where(F.col("place") <= k + 1).groupBy(of, "b")
            .agg(F.min(flag).alias(flag), *[F.max(c).alias(c) for c in ("s", "code", "scale")])
            .withColumn("place", F.row_number().over(each.orderBy(F.desc(F.col("b") == F.col(of)), F.desc("s"), "b"))))
    return (best.where(F.col("place") <= k + 1)
            .withColumn("least", F.when(F.count("s").over(each) >= k, F.min("s").over(each)).otherwise(-np.inf)).drop("place"))


def _found(rows: DataFrame, flag: str) -> DataFrame:
    """``rows`` as new ones for ``_best``: they have ``flag`` and no vector."""
    return rows.withColumns({flag: F.lit(True), "code": F.lit(None).cast("binary"), "scale": F.lit(None).cast("double")})


def _chosen(nodes: DataFrame, total: int, degree: int) -> DataFrame:
    """Links (``a``, ``b``) of every node with ``degree`` others chosen by hash,
    or with all others if there are no more."""
    if total - 1 <= degree:
        step = F.explode(F.sequence(F.lit(1), F.lit(max(1, total - 1))))
    else:
        step = F.explode(F.array_distinct(F.transform(
            F.sequence(F.lit(1), F.lit(degree)), lambda i: F.pmod(F.xxhash64("node", i), F.lit(total - 1)) + 1)))
    links = nodes.select(F.col("node").alias("a"), step.alias("step"))
    return links.select("a", ((F.col("a") + F.col("step")) % max(total, 1)).alias("b")).where("a != b")


def _together(rows: DataFrame, by: str, *then: Column) -> DataFrame:
    """Rows of equal ``by`` in one partition, one after the other.  The hash is
    not what joins partition by, so that the shuffle is never taken for one that
    is there already, which adaptive execution may then change."""
    return rows.repartition(F.xxhash64(by)).sortWithinPartitions(by, *then)


def _codes(b: pd.DataFrame) -> np.ndarray:
    return _table(b["code"])


def _table(codes) -> np.ndarray:
    """Codes as rows whose products are whole numbers that the type holds exactly,
    so that two vectors have one score wherever they meet."""
    x = np.frombuffer(b"".join(codes), np.int8).reshape(len(codes), -1)
    return x.astype(np.float32 if x.shape[1] * 127 * 127 < 1 << 24 else np.float64)


def _met(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """From rows (at, b, new, least, code, scale) in order of ``at`` and ``b``, new ones
    first: pairs of the ``b`` of one ``at`` with a new link among theirs, nearer than the
    first's ``least``, as links (a, b, s)."""
    held = None
    for batch in _and_none(batches):
        if batch is not None:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
        if held is None or not len(held):
            continue
        held = held[~held.duplicated(["at", "b"])]          # linked both ways
        at = held["at"].to_numpy()
        starts = np.concatenate(([0], np.flatnonzero(at[1:] != at[:-1]) + 1, [len(at)]))
        whole = len(starts) - 1 if batch is None else len(starts) - 2       # the last node's rows may go on
        b, new, least = held["b"].to_numpy(), held["new"].to_numpy(), held["least"].to_numpy()
        x, scale = _codes(held), held["scale"].to_numpy()
        for i in range(0, whole, TOGETHER):
            first, last = starts[i], starts[min(i + TOGETHER, whole)]
            sizes = np.diff(starts[i:min(i + TOGETHER, whole) + 1])
            place = np.full((len(sizes), sizes.max()), -1)
            group = np.repeat(np.arange(len(sizes)), sizes)
            place[group, np.arange(first, last) - np.repeat(starts[i:i + len(sizes)], sizes)] = np.arange(first, last)
            s = np.matmul(x[place], x[place].transpose(0, 2, 1)) * (scale[place][:, :, None] * scale[place][:, None, :])
            there = place >= 0
            fit = there[:, :, None] & there[:, None, :] & (new[place][:, :, None] | new[place][:, None, :])
            fit &= (s > least[place][:, :, None]) & (b[place][:, :, None] != b[place][:, None, :])
            g, one, two = np.nonzero(fit)
            if len(g):
                out = pd.DataFrame({"a": b[place[g, one]], "b": b[place[g, two]], "s": s[g, one, two]})
                yield out.drop_duplicates(["a", "b"])
        held = held.iloc[starts[whole]:]


def _and_none(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame | None]:
    yield from batches
    yield None


def _scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        if len(b):
            s = (_table(b["code"]) * _table(b["code2"])).sum(1) * (b["scale"] * b["scale2"])
            yield pd.DataFrame({"a": b["a"], "b": b["b"], "s": s})


def descend(nodes: DataFrame, degree: int = DEGREE, reverse: int = REVERSE, rounds: int = ROUNDS) -> DataFrame:
    """The neighbour graph: links (``a``, ``b``, ``s``) from every node to the
    ``degree`` nearest found, ``s`` by the codes."""
    light = nodes.select("node", "code", "scale")
    total = light.count()
    chosen = (_chosen(nodes, total, min(degree, START) if total - 1 > degree else degree).join(light.withColumnRenamed("node", "a"), "a")
              .join(light.select(F.col("node").alias("b"), F.col("code").alias("code2"), F.col("scale").alias("scale2")), "b"))
    none = F.lit(None).cast("double")
    alone = light.select(F.col("node").alias("a"), F.col("node").alias("b"), none.alias("s"), F.lit(False).alias("new"), "code", "scale")
    links = cut(_best(alone.unionByName(_found(chosen.mapInPandas(_scored, "a long, b long, s double"), "new")), "a", "new", degree), "links")
    for i in range(rounds if total - 1 > degree else 0):
        near, own = links.where("a != b"), links.where("a = b")
        back = _nearest(near.select(F.col("b").alias("to"), F.col("a").alias("b"), "s", "new"), "to", reverse if i else min(reverse, START))
        meet = near.select(F.col("a").alias("at"), "b", "new").unionAll(back.select("to", "b", "new"))
        found = (meet.join(own.select("b", "least", "code", "scale"), "b").select("at", "b", "new", "least", "code", "scale")
                 .transform(_together, "at", F.col("b"), F.desc("new")).mapInPandas(_met, "a long, b long, s double"))
        rows = links.select("a", "b", "s", F.lit(False).alias("new"), "code", "scale").unionByName(_found(found, "new"))
        links = cut(_best(rows, "a", "new", degree), "links")
        if links.where("a != b").agg(F.avg(F.col("new").cast("double"))).first()[0] < STILL:
            break
    return links.where("a != b").select("a", "b", "s")


def _walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """From rows in order of ``at``, first the one with the node's neighbours
    (``around``, with their ``codes`` and ``scales``), then the queries there (``q``,
    ``code``, ``scale``, ``least``): each query's neighbours nearer than its
    ``least``, as (q, b, s)."""
    at, around, x, scales = None, None, None, None
    for b in batches:
        here, q, least, scale = (b[c].to_numpy() for c in ("at", "q", "least", "scale"))
        cuts = np.flatnonzero(here[1:] != here[:-1]) + 1
        out = []
        for i, j in zip([0, *cuts], [*cuts, len(here)]) if len(here) else []:
            if here[i] != at:
                at, around = here[i], None
            row = b.iloc[i]
            if row["around"] is not None:
                around, x, scales = np.asarray(row["around"]), _table(row["codes"]), np.asarray(row["scales"])
                i += 1
            if i < j and around is not None:
                s = (_table(b["code"].iloc[i:j]) @ x.T) * (scale[i:j, None] * scales)
                one, two = np.nonzero((s > least[i:j, None]) & (q[i:j, None] != around))
                out.append((q[i:j][one], around[two], s[one, two]))
        if out:
            q, b, s = (np.concatenate(c) for c in zip(*out))
            yield pd.DataFrame({"q": q.astype(np.int64), "b": b, "s": s}).drop_duplicates(["q", "b"])


def search(nodes: DataFrame, links: DataFrame, queries: DataFrame, beam: int = BEAM, reverse: int = REVERSE) -> DataFrame:
    """(``q``, ``b``, ``s``): the beam of each of ``queries`` (``node``), in the end.

    A beam begins at the query's own node and grows by the neighbours of all its
    nodes, as long as these are among the ``beam`` nearest seen.  Links count both
    ways, but a node that very many others keep leads back to its ``reverse``
    nearest only."""
    light = nodes.select("node", "code", "scale")
    back = _nearest(links.select(F.col("b").alias("a"), F.col("a").alias("b"), "s"), "a", reverse)
    both = links.select("a", "b").unionAll(back.select("a", "b")).distinct()
    around = (both.join(light.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("at"))
              .agg(F.collect_list(F.struct("b", "code", "scale")).alias("x")))        # degree + reverse at most
    none = F.lit(None)
    graph = cut(around.select("at", none.cast("long").alias("q"), none.cast("double").alias("least"), none.cast("binary").alias("code"),
                              none.cast("double").alias("scale"), F.col("x.b").alias("around"), F.col("x.code").alias("codes"),
                              F.col("x.scale").alias("scales")), "graph")
    asked = light.join(queries.select("node"), "node", "left_semi")
    beams = cut(asked.select(F.col("node").alias("q"), F.col("node").alias("b"), none.cast("double").alias("s"), F.lit(True).alias("open"),
                             F.lit(-np.inf).alias("least"), "code", "scale"), "beams")
    own = F.col("q") == F.col("b")
    while count := (ends := beams.where("open")).count():
        sent = ends.select(F.col("b").alias("at"), "q", "least", "code", "scale", none.cast("array<long>").alias("around"),
                           none.cast("array<binary>").alias("codes"), none.cast("array<double>").alias("scales"))
        where = graph if count > FEW else graph.join(F.broadcast(ends.select(F.col("b").alias("at"))), "at", "left_semi")
        found = (where.unionByName(sent).transform(_together, "at", F.asc_nulls_first("q"))
                 .mapInPandas(_walk, "q long, b long, s double"))
        seen = beams.select("q", "b", "s", F.lit(False).alias("open"), *[F.when(own, F.col(c)).alias(c) for c in ("code", "scale")])
        best = _best(seen.unionByName(_found(found, "open")), "q", "open", beam)
        beams = cut(best.withColumns({c: F.when(F.col("open") | own, F.max(c).over(Window.partitionBy("q"))) for c in ("code", "scale")}),
                    "beams")
    return beams.where(~own).select("q", "b", "s")


def _compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        if len(b):
            score = np.einsum("nd,nd->n", np.stack(b["one"]), np.stack(b["two"]))
            yield pd.DataFrame({"query_id": b["query_id"], "q": b["q"], "vec_id": b["vec_id"], "score": score})


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
            degree: int = DEGREE, beam: int = BEAM, exact: int = EXACT) -> DataFrame:
    """The ``k`` nearest rows found of each row that ``is_query``, a condition on
    ``id``: ``query_id``, ``rank`` (from 1), ``vec_id`` and ``score``, the inner
    product in double precision.

    All other rows are candidates; fewer than ``k`` of them are all found, and
    ties go to the smaller id.  Vectors that are null, zero or hold null or
    non-finite components take no part, nor do rows without an id, nor vectors of
    another length than most have.  Rows of one id are rows each: queries of
    their own, and candidates of each other.  A table without rows gives none,
    other columns do not matter."""
    nodes = prepared(vectors, id_col, vector_col)
    links = descend(nodes, max(degree, k))
    found = search(nodes, links, nodes.where(is_query), max(beam, k))
    best = _nearest(found, "q", max(exact, k)).select("q", "b")
    one = nodes.select(F.col("node").alias("q"), F.col("id").alias("query_id"), F.col("vector").alias("one"))
    two = nodes.select(F.col("node").alias("b"), F.col("id").alias("vec_id"), F.col("vector").alias("two"))
    scored = (best.join(one, "q").join(two, "b").select("q", "query_id", "vec_id", "one", "two")
              .mapInPandas(_compared, "query_id long, q long, vec_id long, score double"))
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

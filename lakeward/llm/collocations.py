"""Phrase collocations mined from a weighted de Bruijn graph of word grams.

Nodes are phrases of ``longest - 1`` words, edges phrases of ``longest`` words
with their number of occurrences.  Only edges are counted over the texts, one
per word: the last words of a piece, which begin no whole edge, are counted as
shorter grams, the piece-end corrections.  A node occurs as often as its
outgoing edges and its corrections together, and shorter phrases follow in the
same way.  Unary paths of the graph, on which every word follows the last with
certainty, are compacted: the nodes inside have the weight of their path and
need no candidate of their own.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeward.llm.shared import cut
from lakeward.session import shuffle_partitions

#: Language of rows without one.
UNKNOWN = "und"
#: Grams that a task counts before it hands them over.
HELD = 400_000
#: Of so many rows one is looked at to find phrases that begin that share of the
#: grams, and the parts that these are dealt to; counts are the same without.
LOOK, SHARE, PARTS = 50, 0.002, 64
#: Lower case for A-Z, and one byte for all that ends a piece.
TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9)


def grams(text: bytes, longest: int) -> Iterator[bytes]:
    """One gram for every word of the text: the word and up to ``longest - 1``
    that follow it in its piece, joined by spaces."""
    for piece in text.translate(TABLE).split(b"\n"):
        words = piece.split()           # of the bytes that this splits at, only space and tab are left
        if len(words) >= longest:
            yield from map(b" ".join, zip(*(words[i:] for i in range(longest))))
        for i in range(max(0, len(words) - longest + 1), len(words)):
            yield b" ".join(words[i:])


def _counted(longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for lang, counts in held.items():
                columns = [pa.array([lang] * len(counts), pa.string()), pa.array(counts.keys(), pa.binary()).cast(pa.string()),
                           pa.array(counts.values(), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "gram", "c"])
            held.clear()
        for b in batches:
            for lang, text in zip(b["lang"].to_pylist(), b["text"].cast(pa.binary()).to_pylist()):
                if text:
                    held.setdefault(lang, Counter()).update(grams(text, longest))
                    if sum(map(len, held.values())) > HELD:
                        yield from out()
        yield from out()
    return run


def counted(docs: DataFrame, longest: int = 3) -> DataFrame:
    """``lang``, ``gram``, ``c``: how often each edge, and each shorter gram at a
    piece's end, occurs, added up as far as a task holds them."""
    rows = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text")
    return rows.mapInArrow(_counted(longest), "lang string, gram string, c long")


def first_words(gram: str | Column, n: int) -> Column:
    return F.substring_index(gram, " ", n)


def last_words(gram: str | Column, n: int) -> Column:
    return F.substring_index(gram, " ", -n)


def crowded(docs: DataFrame, longest: int = 3) -> list[str]:
    """``lang phrase`` of the nodes, and of the nodes without their last words,
    that begin a large share of all different grams, by some of the rows; fewer
    than 1 / SHARE of either can."""
    some = counted(docs.where(F.pmod(F.xxhash64("text"), F.lit(LOOK)) == 0), longest).select("lang", "gram").distinct()
    begin = F.explode(F.array_distinct(F.array(*[first_words("gram", k) for k in {longest - 1, shorter(longest)}])))
    begins = cut(some.select("lang", begin.alias("phrase")).groupBy(F.concat_ws(" ", "lang", "phrase").alias("phrase")).count(), "begins")
    total = begins.agg(F.sum("count")).first()[0] or 0
    return [r.phrase for r in begins.where(F.col("count") > F.lit(SHARE * total)).select("phrase").collect()]


def shorter(longest: int) -> int:
    """Words of a node but the last, one at least."""
    return max(1, longest - 2)


def graph(docs: DataFrame, longest: int = 3, least: int = 10) -> DataFrame:
    """The graph: ``lang``, ``node``, ``edge`` and ``c``.  With an edge, the edge's
    occurrences, if there are ``least`` at least; without, those of the node, its
    edges and corrections together.  Nodes of fewer than ``least`` are added up by
    their words but the last, so that no occurrence is lost.

    Grams that begin alike meet in one partition, where edges are counted and
    added up to nodes and shorter phrases without another shuffle.  What crowded
    phrases begin is dealt to parts, by nodes, or by grams if the node is crowded
    itself; such phrases then have rows of several parts."""
    many = crowded(docs, longest)
    begin, node = first_words("gram", shorter(longest)), first_words("gram", longest - 1)
    part = F.lit(0)
    if many:
        by = F.when(F.concat_ws(" ", "lang", node).isin(many), F.col("gram")).otherwise(node)
        part = F.when(F.concat_ws(" ", "lang", begin).isin(many), F.pmod(F.xxhash64(by), F.lit(PARTS)) + 1).otherwise(0)
    rows = counted(docs, longest).repartition("lang", begin, part)
    grams_of = (rows.groupBy("lang", begin.alias("begin"), part.alias("part"), "gram").agg(F.sum("c").alias("c"))
                .withColumn("node", node))
    # every gram counts for its node, a frequent edge for itself as well: one reading of the shuffle gives both
    none = F.lit(None).cast("string")
    for_node, for_edge = F.struct(none.alias("edge"), "c"), F.struct(F.col("gram").alias("edge"), "c")
    both = F.when((F.col("c") >= least) & (F.col("gram") != F.col("node")), F.array(for_node, for_edge)).otherwise(F.array(for_node))
    rows = (grams_of.select("lang", "begin", "part", "node", F.inline(both))
            .groupBy("lang", "begin", "part", "node", "edge").agg(F.sum("c").alias("c")))
    whole = ~F.concat_ws(" ", "lang", "node").isin(many) if many else F.lit(True)
    name = F.when(F.col("edge").isNull() & (F.col("c") < least) & whole, F.col("begin")).otherwise(F.col("node"))
    rows = rows.groupBy("lang", "begin", "part", name.alias("node"), "edge").agg(F.sum("c").alias("c"))
    return cut(rows.select("lang", "node", "edge", "c"), "graph")


def flow(nodes: DataFrame, words: int) -> DataFrame:
    """What passes through the phrases of that many words, fewer than an edge's:
    ``lang``, ``phrase`` and ``f``, all their occurrences; of several words, only
    phrases as frequent as the graph's edges."""
    rows = nodes.where(F.col("edge").isNull() & (first_words("node", words - 1) != F.col("node")))
    return rows.groupBy("lang", first_words("node", words).alias("phrase")).agg(F.sum("c").alias("f"))


def _chains(links: DataFrame) -> DataFrame:
    """``lang``, ``gram``, ``head`` and ``place`` of every edge that has one
    before it: the first edge of its path and its distance from there, by
    pointers of doubling length.  Paths have ends: a cycle without a way in would
    be a piece without a first word."""
    active = links.select("lang", "gram", F.col("before").alias("head"), F.lit(1).cast("long").alias("place"))
    while True:
        active = cut(active, "chains")
        ahead = active.select("lang", F.col("gram").alias("head"), F.col("head").alias("further"), F.col("place").alias("more"))
        if active.join(ahead, ["lang", "head"], "left_semi").isEmpty():
            return active
        active = active.join(ahead, ["lang", "head"], "left").select(
            "lang", "gram", F.coalesce("further", "head").alias("head"), (F.col("place") + F.coalesce("more", F.lit(0))).alias("place"))


def unitigs(nodes: DataFrame, often: DataFrame, longest: int = 3) -> DataFrame:
    """The frequent edges with their unary paths compacted: ``lang``, ``words``
    (array, a path's words in order) and ``f``, the occurrences of all its edges.

    A node is inside a path if one edge into it and one out of it have all its
    occurrences.  A path's inside holds no piece's begin or end, so no path is
    longer than the longest piece."""
    heavy = nodes.where("edge is not null").select("lang", F.col("edge").alias("gram"), "c")
    k = longest - 1
    full = often.select("lang", F.col("phrase").alias("at"), F.col("f").alias("c"))
    out = heavy.withColumn("at", first_words("gram", k)).join(full, ["lang", "at", "c"], "left_semi")
    into = heavy.withColumn("at", last_words("gram", k)).join(full, ["lang", "at", "c"], "left_semi")
    links = into.select("lang", "at", F.col("gram").alias("before")).join(out.select("lang", "at", "gram"), ["lang", "at"])
    chained = _chains(links)
    placed = heavy.join(chained, ["lang", "gram"], "left").select(
        "lang", F.coalesce("head", "gram").alias("head"), F.coalesce("place", F.lit(0)).alias("place"), "gram", "c")
    path = F.array_sort(F.collect_list(F.struct("place", "gram")))
    paths = placed.groupBy("lang", "head").agg(path.alias("path"), F.max("c").alias("f"))
    words = F.concat(F.split("head", " "), F.transform(
        F.slice("path", 2, F.greatest(F.size("path") - 1, F.lit(0))), lambda e: last_words(e["gram"], 1)))
    return paths.select("lang", words.alias("words"), "f")


def _windows(words: str, n: int) -> Column:
    """All phrases of ``n`` words of an array of words."""
    count = F.size(words) - n + 1
    return F.when(count > 0, F.transform(F.sequence(F.lit(1), count), lambda i: F.array_join(F.slice(words, i, n), " ")))


def phrases(docs: DataFrame, longest: int = 3, least: int = 10) -> tuple[DataFrame, DataFrame]:
    """Every phrase of 1 to ``longest`` words with at least ``least`` occurrences:
    ``lang``, ``phrase``, ``words``, ``f`` and ``inside`` (a node inside a unary
    path, so that a longer phrase occurs as often); and all words of each lang, as
    ``lang`` and ``n``."""
    nodes = graph(docs, longest, least)
    words = cut(flow(nodes, 1), "flow")
    often = ([words] + [flow(nodes, k) for k in range(2, longest)])
    often = [often[0].where(F.col("f") >= least)] + [cut(x.where(F.col("f") >= least), "flow") for x in often[1:]]
    paths = cut(unitigs(nodes, often[-1], longest), "unitigs")
    whole = paths.select("lang", F.explode(_windows("words", longest)).alias("phrase"), "f")
    within = paths.where(F.size("words") > longest).select(
        "lang", F.explode(F.slice(_windows("words", longest - 1), 2, F.size("words") - longest)).alias("phrase"), "f")
    junctions = often[-1].join(within, ["lang", "phrase"], "left_anti")
    parts = [(whole, longest, False), (within, longest - 1, True), (junctions, longest - 1, False)]
    parts += [(x, k, False) for k, x in enumerate(often[:-1], 1)]
    rows = [x.select("lang", "phrase", F.lit(k).alias("words"), "f", F.lit(inside).alias("inside")) for x, k, inside in parts]
    return cut(reduce(DataFrame.unionAll, rows), "phrases"), words.groupBy("lang").agg(F.sum("f").alias("n"))


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, share: int = 50, top: int = 2000) -> DataFrame:
    """The ``top`` collocations of every lang: ``lang``, ``rank`` (from 1),
    ``phrase``, ``a``, ``l``, ``r``, ``n`` and ``score``.

    A phrase of 2 to ``longest`` words, two at least, with a >= ``least``
    occurrences counts by its weakest cut into a first part (l occurrences) and
    the rest (r), by floor(1000000 a a / (l r)), exact in decimals of 38 digits;
    the smallest cut wins ties.  Phrases inside a longer one that has ``share``
    percent of their occurrences or more are left out.  Rows of a null lang count
    as ``und``, null and empty texts hold no words, repeated rows count each;
    tables without rows give none, other columns do not matter."""
    counts, totals = phrases(docs, longest, least)
    candidates = counts.where("words > 1").withColumn("parts", F.split("phrase", " "))
    inner = [candidates.where(F.col("words") == m).select("lang", F.explode(_windows("parts", k)).alias("phrase"), "f")
             for m in range(3, longest + 1) for k in range(2, m)]
    if inner:
        most = reduce(DataFrame.unionAll, inner).groupBy("lang", "phrase").agg(F.max("f").alias("most"))
        if share <= 100:
            candidates = candidates.where(~F.col("inside"))
        candidates = (candidates.join(most, ["lang", "phrase"], "left")
                      .where(F.col("most").isNull() | (100 * F.col("most") < share * F.col("f"))))
    pieces = F.transform(F.sequence(F.lit(1), F.col("words") - 1), lambda k: F.struct(
        k.alias("k"), F.array_join(F.slice("parts", 1, k), " ").alias("first"),
        F.array_join(F.slice("parts", k + 1, longest), " ").alias("rest")))
    part = counts.select("lang", "phrase", "f")
    cuts = (candidates.select("lang", "phrase", F.col("f").alias("a"), F.inline(pieces))
            .join(part.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
            .join(part.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"]))
    a, l, r = (F.col(c).cast("decimal(19,0)") for c in "alr")
    cuts = cuts.withColumn("score", F.call_function("div", a * a * F.lit(1_000_000).cast("decimal(7,0)"), l * r))
    weakest = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("w"))
    return (leading(weakest.select("lang", "phrase", "a", "w.l", "w.r", "w.score"), top).join(totals, "lang")
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


def leading(scored: DataFrame, top: int) -> DataFrame:
    """The first ``top`` of every lang, with their ranks.  Parts of a lang choose
    theirs first, so that no task holds more than ``top`` rows of each part."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(shuffle_partitions(scored.sparkSession)))
    some = (scored.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
            .where(F.col("rank") <= top))
    return (some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
            .where(F.col("rank") <= top).drop("part"))


#: DuckDB: every gram of every length counted on its own.
COLLOCATIONS_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL),
listed AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM listed, (VALUES (1), (2), (3)) AS sizes(k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
often AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS w, f AS a FROM f WHERE k > 1 AND f >= 10),
inner_of AS (
  SELECT lang, phrase, max(a) AS most FROM (
    SELECT lang, w[1] || ' ' || w[2] AS phrase, a FROM often WHERE k = 3
    UNION ALL SELECT lang, w[2] || ' ' || w[3], a FROM often WHERE k = 3) GROUP BY ALL),
open AS (
  SELECT o.* FROM often o LEFT JOIN inner_of i ON o.k = 2 AND i.lang = o.lang AND i.phrase = o.phrase
  WHERE i.most IS NULL OR 100 * i.most < 50 * o.a),
cuts AS (
  SELECT lang, phrase, a, c AS cut, array_to_string(w[1:c], ' ') AS head, array_to_string(w[c + 1:k], ' ') AS rest
  FROM open, (VALUES (1), (2)) AS places(c) WHERE c < k),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.cut, x.f AS l, y.f AS r,
         ((1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.head JOIN f y ON y.lang = c.lang AND y.phrase = c.rest),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM weakest)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

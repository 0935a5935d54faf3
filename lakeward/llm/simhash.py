"""SimHash near-duplicates found through deletion-variant signatures.

A fingerprint of 64 bits is cut into ``distance // 2 + 1`` segments, so few
that of two fingerprints with at most ``distance`` differing bits one segment
differs by at most one bit.  Each segment is indexed once for every one of its
bits taken out: two segments that differ by one bit at most agree in a variant.
Fingerprints that share a variant meet in a bucket and are verified over all
bits.  A bucket yields a spanning forest of its links, not all its pairs, which
takes little for a dense one.  One that takes too much is dealt out anew, by
further bits that two linked members must share, so no link is lost.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.llm.components import components
from lakeward.llm.shared import cut, unused

BITS, SEED = 64, 42
#: Comparisons that a bucket may take; it is split by further bits if they do
#: not suffice, or at once if it has more members than this.
WORK, MOST = 100_000_000, 1 << 20
#: Bits of a bucket's key beyond which it is not split further.
MOST_KEY_BITS = 48


def fingerprint(text: str | None, words: int = 4) -> int:
    """SimHash of the text's word shingles, repeats included; 0 without words."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    joined = memoryview(b" ".join(tokens))
    ends = np.cumsum([len(t) + 1 for t in tokens])
    starts = np.concatenate(([0], ends[:-1])).tolist()
    ends = (ends[words - 1:] - 1).tolist() or [len(joined)]
    digest = xxhash.xxh64_intdigest
    ones, n = np.zeros(BITS, np.int64), len(ends)
    for i in range(0, n, 4096):             # in blocks, so that long texts need no more memory
        h = np.array([digest(joined[s:e], SEED) for s, e in zip(starts[i:i + 4096], ends[i:i + 4096])], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = 4) -> DataFrame:
    """``doc_id`` and ``fp`` (bigint, the 64 bits as a signed number) of every row."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fp = np.array([fingerprint(t, words) for t in b["text"]], np.uint64).view(np.int64)
            yield pd.DataFrame({"doc_id": b["doc_id"], "fp": fp})
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id {kind}, fp long")


def segments(distance: int) -> list[int]:
    """Masks of the segments, of nearly equal length."""
    n = distance // 2 + 1
    edges = [round(i * BITS / n) for i in range(n + 1)]
    return [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]


def variants(distance: int) -> list[int]:
    """For every bit, the mask of its segment without it: what a variant keeps."""
    return [mask & ~(1 << bit) for mask in segments(distance) for bit in range(BITS) if mask >> bit & 1]


def blocks(used: int, distance: int) -> list[int]:
    """Masks of ``distance + 1`` blocks of the bits outside ``used``: of two
    fingerprints within the distance, one block at least is equal."""
    free = [bit for bit in range(BITS) if not used >> bit & 1]
    return [sum(1 << bit for bit in free[i::distance + 1]) for i in range(distance + 1)]


def forest(fp: np.ndarray, distance: int, work: int | None = None) -> list[tuple[int, int]] | None:
    """Positions (member, centre) of links that hold together what is linked
    among ``fp``: each member reached is taken out, so a dense set costs little.
    None if that takes more than ``work`` comparisons."""
    left, out, done = np.arange(len(fp)), [], 0
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            centre = queue.pop()
            done += len(left)
            if work is not None and done > work:
                return None
            near = np.bitwise_count(fp[left] ^ fp[centre]) <= distance
            if near.any():
                out += [(m, centre) for m in left[near].tolist()]
                queue += left[near].tolist()
                left = left[~near]
    return out


def _links(a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
    none = pd.array([None] * len(a), "Int64")
    return pd.DataFrame({"mask": none, "bits": none, "a": a.view(np.int64), "b": pd.array(b.view(np.int64), "Int64")})


def _split(mask: int, fp: np.ndarray, distance: int) -> Iterator[pd.DataFrame]:
    """The members of a large bucket under keys with one more block each."""
    for block in blocks(mask, distance):
        wider = np.uint64(mask | block)
        yield pd.DataFrame({"mask": wider.view(np.int64), "bits": (fp & wider).view(np.int64),
                            "a": fp.view(np.int64), "b": pd.array([None] * len(fp), "Int64")})


def _compare(distance: int, most: int, work: int, small: int = 16):
    """Task function over rows (mask, bits, fp) sorted by bucket (mask, bits).

    Gives links (a, b) with a null mask, and the members of buckets of more
    than ``most``, or that take more than ``work`` comparisons, under wider keys
    (mask, bits, a).  The rows of the bucket that is open at a batch's end wait
    for the next batch, unless it is split already."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, splitting = np.empty((3, 0), np.uint64), None
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                rows = np.concatenate((rows, batch[["mask", "bits", "fp"]].to_numpy(np.int64).T.view(np.uint64)), 1)
            mask, bits, fp = rows
            if not len(fp):
                continue
            starts = np.concatenate(([0], np.flatnonzero((mask[1:] != mask[:-1]) | (bits[1:] != bits[:-1])) + 1))
            sizes = np.diff(starts, append=len(fp))
            # the last bucket may go on; it is held back unless there is no more, or it is too large
            done = len(starts) - (batch is not None)
            for k in np.flatnonzero(sizes > small).tolist():
                key, members = (mask[starts[k]], bits[starts[k]]), fp[starts[k]:starts[k] + sizes[k]]
                more = int(key[0]).bit_count() < MOST_KEY_BITS
                found = None
                if not (more and (sizes[k] > most or key == splitting)):
                    if k >= done:
                        continue
                    found = forest(members, distance, work if more else None)
                if found is None:
                    yield from _split(int(key[0]), members, distance)
                    splitting = key
                    done = max(done, k + 1)
                elif found:
                    yield _links(*(members[list(side)] for side in zip(*found)))
            end = starts[done] if done < len(starts) else len(fp)
            # small buckets, all at once: every member with those up to `small` rows on
            bucket = np.repeat(np.where(sizes <= small, np.arange(len(starts)), -1), sizes)[:end]
            for step in range(1, small):
                at = np.flatnonzero((bucket[step:] == bucket[:-step]) & (bucket[step:] >= 0)) if step < end else []
                if not len(at):
                    break
                at = at[np.bitwise_count(fp[at] ^ fp[at + step]) <= distance]
                if len(at):
                    yield _links(fp[at], fp[at + step])
            rows = rows[:, end:]
    return run


def links(fps: DataFrame, distance: int = 4, most: int = MOST, work: int = WORK) -> DataFrame:
    """Links (``a``, ``b``) among distinct fingerprints (``fp``, bigint) that
    connect whatever chains of at most ``distance`` differing bits connect."""
    signed = [m - (1 << 64) if m >> 63 else m for m in variants(distance)]
    rows = (fps.select("fp").withColumn("mask", F.explode(F.array(*map(F.lit, signed))))
            .select("mask", F.col("mask").bitwiseAND(F.col("fp")).alias("bits"), "fp"))
    found = None
    while True:
        out = cut(rows.repartition("mask", "bits").sortWithinPartitions("mask", "bits")
                  .mapInPandas(_compare(distance, most, work), "mask long, bits long, a long, b long"), "pairs")
        pairs = out.where("mask is null").select("a", "b")
        found = pairs if found is None else found.unionAll(pairs)
        rows = out.where("mask is not null").select("mask", "bits", F.col("a").alias("fp"))
        if rows.isEmpty():
            return found


def near_duplicates(docs: DataFrame, words: int = 4, distance: int = 4) -> DataFrame:
    """Groups of rows whose fingerprints are linked: ``doc_id``, ``fingerprint``
    (16 hex digits) and ``component_id``, the smallest doc_id of all rows that
    chains of links reach.

    Null and empty texts have fingerprint zero and are linked like any others;
    repeated rows each give a row.  Equal fingerprints meet by aggregation, and
    only distinct ones are compared."""
    fps = cut(fingerprints(docs, words), "fingerprints")
    classes = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    linked = components(links(classes, distance))
    member = (classes.join(linked, F.col("fp") == F.col("node"), "left")
              .select("fp", "first", F.coalesce("root", "fp").alias("root")))
    group = member.groupBy("root").agg(F.min("first").alias("component_id"))
    of = cut(member.join(group, "root").select("fp", "component_id"), "members")
    return (fps.join(of, "fp")
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))


def one_of_each(docs: DataFrame, words: int = 4, distance: int = 4) -> DataFrame:
    """One row of each group of near-duplicates, with all its columns: the row
    whose doc_id is the group's component_id.

    Rows that go are taken out by their ids, a small part of all, so that the
    texts are not shuffled while these fit a broadcast.  Ids that several rows
    have are decided row by row, by id and fingerprint; of rows that are alike in
    both the one with the least text stays, a null text before all others.  Rows
    without an id are groups by their fingerprints alone.  Further columns may
    have any names."""
    ids = cut(near_duplicates(docs, words, distance), "groups")
    key = unused("id", docs)
    first = F.col("doc_id").eqNullSafe(F.col("component_id"))
    by_id = ids.groupBy(F.col("doc_id").alias(key)).agg(F.count("*").alias("n"), F.max(first).alias("first"))
    handled = cut(by_id.where((F.col("n") > 1) | ~F.col("first")), "handled")
    same = F.col("doc_id").eqNullSafe(F.col(key))
    once = docs.join(handled.select(key), same, "left_anti")
    several = handled.where("n > 1").select(key)
    if several.isEmpty():
        return once

    @F.pandas_udf("string")
    def digits(texts: pd.Series) -> pd.Series:
        return pd.Series([f"{fingerprint(t, words):016x}" for t in texts], dtype=object)
    kept = ids.where(first).select(F.col("doc_id").alias(key), F.col("fingerprint").alias("fp"), "component_id").distinct()
    rows = docs.join(several, same, "left_semi").select(F.struct("*").alias("row"), digits("text").alias("__fp"))
    rows = rows.join(kept, F.col("row.doc_id").eqNullSafe(F.col(key)) & (F.col("__fp") == F.col("fp")))
    best = rows.groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("fp"))).agg(
        F.min_by("row", F.struct(F.col("row.text"))).alias("row"))
    return once.unionByName(best.select("row.*"))

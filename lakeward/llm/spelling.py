"""Spelling variants of words, found through a reduced alphabet.

Letters are hashed to a few symbols.  Two words that differ by one inserted,
deleted or replaced letter differ by one symbol at most when reduced, so that
the reduced form of one is in the full one-edit neighbourhood of the other's.
Neighbourhoods of reduced words are small, whatever the letters; they are
joined with the reduced vocabulary, and the pairs met are verified on the words
themselves.  All edits of a word are hashed at once, from the sums of its
prefixes and suffixes, so that long words are never written out per edit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.llm.shared import cut

RUNS = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Symbols of the reduced alphabet, and edits that are hashed at a time.
SYMBOLS, EDITS = 6, 1 << 19
BASE = np.uint64(0x9E3779B97F4A7C15)
#: BASE * INVERSE = 1 modulo 2 ** 64.
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
#: Of so many runs one, by its crc32, is written with a letter less.
ERROR = 199


def runs(docs: DataFrame) -> DataFrame:
    """``word``: every run of letters of every text, A-Z lower-cased; where
    ``ERROR`` divides the crc32 of ``doc_id:run``, a letter is left out.  A null
    id counts as empty text, null texts have no runs."""
    text = F.translate("text", UPPER, LOWER)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(text, F.lit(RUNS), F.lit(0))).alias("run"))
    less = F.concat(F.expr("substring(run, 1, int(h % length(run)))"), F.expr("substring(run, int(h % length(run)) + 2)"))
    return (rows.withColumn("h", F.crc32(F.concat_ws(":", "id", "run")))
            .select(F.when(F.col("h") % ERROR == 0, less).otherwise(F.col("run")).alias("word")))


def vocabulary(docs: DataFrame, letters: int = 6, least: int = 5) -> DataFrame:
    """``id``, ``word`` and ``n`` of all words of at least that many letters and
    occurrences, written once so that ids stay."""
    counted = (runs(docs).where(F.length("word") >= letters).groupBy("word").agg(F.count("*").alias("n"))
               .where(F.col("n") >= least))
    return cut(counted.withColumn("id", F.monotonically_increasing_id()), "vocabulary")


def reduced(points: np.ndarray, symbols: int = SYMBOLS) -> np.ndarray:
    """Symbols, from 1 on, of code points."""
    h = points.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return (h >> np.uint64(40)) % np.uint64(symbols) + np.uint64(1)


def _mixed(h: np.ndarray, length: int) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * BASE + np.uint64(length * 0xBF58476D1CE4E5B9 % (1 << 64))
    return (h ^ (h >> np.uint64(29))).view(np.int64)


def _sums(s: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of symbols times powers of the base, of every prefix and every suffix
    of the rows of ``s``, and the powers; the last letter has power 0."""
    m, n = s.shape
    power = np.concatenate(([np.uint64(1)], np.cumprod(np.full(n + 1, BASE))))
    terms = s * power[n - 1::-1][:n]
    suffix = np.zeros((m, n + 1), np.uint64)
    suffix[:, :n] = np.cumsum(terms[:, ::-1], axis=1)[:, ::-1]
    return suffix[:, :1] - suffix, suffix, power


def keys(s: np.ndarray) -> np.ndarray:
    """The hash of each row of symbols itself."""
    return _mixed(_sums(s)[1][:, 0], s.shape[1])


def neighbourhoods(s: np.ndarray, symbols: int = SYMBOLS, edits: int = EDITS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and hashes of each row's full one-edit neighbourhood: itself, all
    deletions, replacements and insertions.  Equal ones of a row are given once,
    but for words of more edits than ``edits``, which come in blocks of places."""
    m, n = s.shape
    before, after, power = _sums(s)             # a prefix keeps the powers that it has in the whole
    for a in range(0, n + 1, max(1, edits // (2 * symbols * m))):
        b = min(n + 1, a + max(1, edits // (2 * symbols * m)))
        ends = power[n - np.arange(a, b)]       # power of a letter put in there
        out = [_mixed(before[:, a:b] * BASE + after[:, a:b] + np.uint64(c) * ends, n + 1) for c in range(1, symbols + 1)]
        if a == 0:
            out.append(_mixed(after[:, :1], n))
        e = min(b, n)
        if a < e:
            own, at = s[:, a:e], power[n - 1 - np.arange(a, e)]
            # a prefix moves one place down: its sum is taken without the shift that the whole has
            down = np.cumsum(np.concatenate((before[:, a:a + 1] * INVERSE, own[:, :-1] * (at[:-1] * INVERSE)), 1), axis=1)
            out.append(_mixed(down + after[:, a + 1:e + 1], n - 1))
            for step in range(1, symbols):      # the other symbols
                other = (own - np.uint64(1) + np.uint64(step)) % np.uint64(symbols) + np.uint64(1)
                out.append(_mixed(after[:, :1] + (other - own) * at, n))
        h = np.sort(np.concatenate(out, 1), axis=1)
        new = np.ones(h.shape, bool)
        new[:, 1:] = h[:, 1:] != h[:, :-1]
        rows, cols = np.nonzero(new)
        yield rows, h[rows, cols]


def _by_length(batch: pd.DataFrame, symbols: int, edits: int = EDITS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and symbols of a batch's words, those of one length together, no more
    than have ``edits`` edits, or one."""
    for n, group in batch.groupby(batch["word"].str.len()):
        most = max(1, edits // (2 * symbols * (n + 1)))
        for i in range(0, len(group), most):
            part = group.iloc[i:i + most]
            points = np.frombuffer("".join(part["word"]).encode("utf-32-le"), np.uint32).reshape(len(part), n)
            yield part["id"].to_numpy(), reduced(points, symbols)


def _keyed(symbols: int, whole: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for ids, s in _by_length(batch, symbols):
                for rows, h in neighbourhoods(s, symbols) if whole else [(np.arange(len(s)), keys(s))]:
                    yield pd.DataFrame({"key": h, "id": ids[rows]})
    return run


def differ_by_one(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced code point makes ``a`` to ``b``."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    low, high = 0, len(a)
    while low < high:               # the first place where they differ
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[low:middle] == b[low:middle] else (low, middle - 1)
    return a[low + (len(a) == len(b)):] == b[low + 1:]


def _verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        yield b[[differ_by_one(x, y) for x, y in zip(b["word"], b["other"])]]


def near(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """Pairs of a vocabulary's words that differ by one edit, each pair both ways:
    ``word``, ``n``, ``other``, ``other_n``.

    Hashes and ids travel, words only to the pairs met; equal hashes of other
    reduced words make no more than pairs that the verification drops."""
    around = words.select("id", "word").mapInPandas(_keyed(symbols, True), "key long, id long")
    index = words.select("id", "word").mapInPandas(_keyed(symbols, False), "key long, id long")
    met = (around.join(index.withColumnRenamed("id", "to"), "key").where("id < to").select("id", "to"))
    pairs = (cut(met, "met").join(words.select("id", "word", "n"), "id")
             .join(words.select(F.col("id").alias("to"), F.col("word").alias("other"), F.col("n").alias("other_n")), "to")
             .select("word", "n", "other", "other_n"))
    pairs = cut(pairs.mapInPandas(_verified, pairs.schema).distinct(), "near")
    return pairs.unionAll(pairs.select("other", "other_n", "word", "n"))


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` of words with a ``form``: the last of the forms that
    lead on from it, by pointers of doubling length.  Forms occur more often
    than their words, so that none leads back."""
    reached = forms.select("word", F.col("form").alias("root"))
    while True:
        reached = cut(reached, "roots")
        on = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if reached.join(on, "root", "left_semi").isEmpty():
            return reached
        reached = reached.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"))


def variants(docs: DataFrame, letters: int = 6, least: int = 5, times: int = 5, symbols: int = SYMBOLS) -> DataFrame:
    """The vocabulary with spelling variants grouped: ``word``, ``form``, ``root``,
    ``n``, ``n_near`` and ``form_n``.

    A word's form is the word one edit away with the largest ``n``, the smallest
    of those by code points, if it occurs ``times`` as often, else null; the root
    is the last of the forms that follow each other, the word itself without one.
    Null and empty texts hold no words, a null doc_id counts as empty text,
    repeated rows count each; tables without rows, or without frequent words,
    give none, other columns do not matter."""
    words = vocabulary(docs, letters, least)
    pairs = near(words, symbols)
    most = pairs.groupBy("word").agg(F.count("*").alias("n_near"), F.max("other_n").alias("other_n"))
    best = (pairs.join(most.select("word", "other_n"), ["word", "other_n"]).where(F.col("other_n") >= times * F.col("n"))
            .groupBy("word").agg(F.min("other").alias("form"), F.max("other_n").alias("form_n")))
    forms = cut(best, "forms")
    return (words.join(most.select("word", "n_near"), "word", "left").join(forms, "word", "left")
            .join(roots(forms), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                    F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n"))

"""Cross-entropy difference of two matched n-gram models.

A target model (of text one wants more of) and a background model are bigram
models of the same words.  They are matched: same order, same smoothing, and the
background's counts scaled to the target's number of tokens.  A document's
score is the mean over its tokens of the target's loss less the background's;
low scores resemble the target.

``difference`` counts all words and all bigrams of the corpus and looks the
losses up where the counts are, so that neither table has to fit one machine.
``train`` and ``score`` are for a closed vocabulary: the most frequent words,
all others being one unknown word, with two tables of ``vocabulary ** 2``
losses, which are broadcast and can be applied to other texts.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.llm.shared import cut
from lakeward.session import small_batches

#: Words of a closed vocabulary, with the unknown word, which also begins each text.
VOCABULARY = 2048
#: Pseudo-counts by which a word's followers are drawn to the words' frequencies.
STRENGTH = 50.0
#: A word of more bytes than this is unknown; a task sends its word counts at this many.
LONGEST, FLUSH = 64, 500_000


def words(text: str | None) -> list[bytes]:
    """Runs without ASCII white space, in lower case, as UTF-8."""
    return text.lower().encode("utf-8", "surrogatepass").split() if text else []


@dataclass(frozen=True)
class Models:
    """``ids`` of the words, and losses (nats) of a word after a word."""

    ids: dict[bytes, int]
    target: np.ndarray
    background: np.ndarray

    def pairs(self, text: str | None) -> np.ndarray:
        """Cells of the text's bigrams; the text's begin counts as unknown word."""
        get = self.ids.get
        ids = np.array([0] + [get(w, 0) for w in words(text)], np.int64)
        return ids[:-1] * len(self.target) + ids[1:]

    def score(self, text: str | None) -> tuple[int, float, float]:
        """Tokens, mean loss under the target, and under the background."""
        cells = self.pairs(text)
        n = len(cells)
        return (n, float(self.target.ravel()[cells].mean(dtype=np.float64)),
                float(self.background.ravel()[cells].mean(dtype=np.float64))) if n else (0, 0.0, 0.0)


def vocabulary(docs: DataFrame, size: int = VOCABULARY) -> dict[bytes, int]:
    """Ids from 1 of the ``size - 1`` words most frequent over all texts (ties:
    in the words' order)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for b in batches:
            for text in b["text"]:
                seen.update(words(text))
                if len(seen) > FLUSH:
                    yield pd.DataFrame({"word": list(seen), "n": list(seen.values())})
                    seen.clear()
        yield pd.DataFrame({"word": pd.Series(list(seen), dtype=object), "n": pd.Series(list(seen.values()), dtype="int64")})
    counts = (docs.select("text").mapInPandas(run, "word binary, n long").where(F.octet_length("word") <= LONGEST)
              .groupBy("word").agg(F.sum("n").alias("n")))
    top = counts.orderBy(F.desc("n"), "word").limit(size - 1).collect()
    return {bytes(r["word"]): i + 1 for i, r in enumerate(top)}


def losses(counts: np.ndarray, strength: float = STRENGTH) -> np.ndarray:
    """-log p(word | word before) for a table of bigram counts.  A row is drawn
    to the words' frequencies, these to equal ones by one count each; every
    row's probabilities sum to one.  Works in blocks of rows, to save memory."""
    each = counts.sum(0, dtype=np.float64) + 1.0
    each /= each.sum()
    out = np.empty(counts.shape, np.float32)
    for i in range(0, len(counts), 128):
        block = counts[i:i + 128].astype(np.float64)
        out[i:i + 128] = -np.log((block + strength * each) / (block.sum(1, keepdims=True) + strength))
    return out


def train(docs: DataFrame, is_target: DataFrame, size: int = VOCABULARY) -> Models:
    """Both models from ``docs`` (doc_id, text).  Rows whose doc_id is in
    ``is_target`` (doc_id) are the target, all others the background.  Without
    rows on a side its model knows equal frequencies only."""
    ids = vocabulary(docs, size)
    blank = Models(ids, np.empty((size, 0)), np.empty((size, 0)))
    marks = cut(is_target.select("doc_id").dropna().distinct().withColumn("target", F.lit(True)), "target")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables = np.zeros((2, size * size), np.int32)
        for b in batches:
            for text, target in zip(b["text"], b["target"]):
                cells, n = np.unique(blank.pairs(text), return_counts=True)
                tables[int(target)][cells] += n.astype(np.int32)
        cells = np.flatnonzero(tables[0] + tables[1])
        for i in range(0, len(cells), 100_000):
            at = cells[i:i + 100_000]
            yield pd.DataFrame({"cell": at.astype(np.int32), "background": tables[0][at].astype(np.int64),
                                "target": tables[1][at].astype(np.int64)})
    # sorted and merged at every size: the list of target rows grows with the corpus
    marked = docs.select("doc_id", "text").join(marks.hint("merge"), "doc_id", "left").select(
        "text", F.coalesce("target", F.lit(False)).alias("target"))
    sums = (marked.mapInPandas(run, "cell int, background long, target long").groupBy("cell")
            .agg(F.sum("background").alias("background"), F.sum("target").alias("target")))
    found = sums.toArrow()                  # at most size ** 2 rows
    cells = found["cell"].to_numpy()
    tables = []
    for side in ("target", "background"):
        table = np.zeros(size * size, np.float32)
        table[cells] = found[side].to_numpy()
        tables.append(table.reshape(size, size))
    del found, cells
    target, background = tables
    if target.any() and background.any():
        background *= target.sum(dtype=np.float64) / background.sum(dtype=np.float64)
    return Models(ids, losses(target), losses(background))


def score(docs: DataFrame, models: Models) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``target_loss``, ``background_loss`` (nats a token)
    and ``score``, their difference, for every row.  Null and empty texts have no
    tokens and score 0.  One pass without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(models)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for b in batches:
            out = pd.DataFrame([m.score(t) for t in b["text"]], columns=["n_tokens", "target_loss", "background_loss"])
            out.insert(0, "doc_id", b["doc_id"].to_numpy())
            yield out
    return (docs.select("doc_id", "text").mapInPandas(
        run, f"doc_id {kind}, n_tokens long, target_loss double, background_loss double")
        .withColumn("score", F.col("target_loss") - F.col("background_loss")))


# --- all words --------------------------------------------------------------------------------
#
# Words and bigrams are told apart by 64-bit hashes.  Texts are dealt to chunks of bounded
# size.  A chunk asks each bucket for the counts of its bigrams there, each once, in one
# packed row, and the bucket answers with one; so what is sent is at most a chunk's
# bigrams, however many buckets and texts there are.  A bucket holds all of a rare word's
# bigrams, so that the word's counts are the bucket's own.  Frequent words and bigrams are
# few, whatever the corpus; their counts are broadcast, and they burden no single bucket.

#: A word is frequent from this share of the tokens on, a bigram surely from twice its share.
FREQUENT_WORD, FREQUENT_PAIR = 1 / 50_000, 1 / 4_000
#: Tokens of a bucket, and buckets' worth of a chunk, on average; rows of a chunk; bytes of text hashed at once.
BUCKET, WORTH, ROWS, CHUNK = 2_000_000, 2, 200_000, 1 << 20
#: Tokens for which a task holds intermediate numbers at once.
BLOCK = 1 << 18
_BASE = 0x9E3779B97F4A7C15                  # odd, so it has an inverse
_VALUES = np.frombuffer(b"".join(hashlib.blake2b(bytes([i]), digest_size=8).digest() for i in range(256)), np.uint64)
_SPACE = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64."""
    def of(base: int) -> np.ndarray:
        out = np.full(n, base, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)
    return of(_BASE), of(pow(_BASE, -1, 1 << 64))


def bigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every word: the text's place, the word's hash, the hash of the word before (or
    the text's begin) and the word, and whether it is the text's last."""
    found, lot, size, first = [], [], 0, 0
    for i, text in enumerate(texts):
        lot.append(text.lower().encode("utf-8", "surrogatepass") if text else b"")
        size += len(lot[-1]) + 1
        if size >= CHUNK or i + 1 == len(texts):
            found.append(_paired(first, *_hashed(lot, size)))
            lot, size, first = [], 0, i + 1
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
    parts = [list(x) for x in zip(*found)]
    del found
    return tuple(np.concatenate(parts.pop(0)) for _ in range(4))


def _paired(first: int, doc: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, ...]:
    new = np.ones(len(doc) + 1, bool)
    new[1:-1] = doc[1:] != doc[:-1]
    before = np.concatenate((np.zeros(1, np.uint64), word))[:-1]
    before[new[:-1]] = 0
    pair = _mix(before * np.uint64(0xD1342543DE82EF95) + word)
    return (doc + first).astype(np.int32), word.view(np.int64), pair.view(np.int64), new[1:]


def _hashed(lot: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(b"\n".join(lot) + b"\n", np.uint8)
    up, down = _powers(1 << max(21, size.bit_length()))
    edge = np.flatnonzero(np.diff(_SPACE[raw], prepend=True))
    start, end = edge[::2], edge[1::2]
    sums = np.zeros(size + 1, np.uint64)
    np.cumsum(_VALUES[raw] * up[:size], out=sums[1:])
    word = _mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))
    begins = np.cumsum([0] + [len(t) + 1 for t in lot])
    return np.searchsorted(begins, start, "right") - 1, word


def _sums(key: np.ndarray, *weights: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The different keys, and every weight's sums."""
    keys, at = np.unique(key, return_inverse=True)
    return keys, [np.bincount(at, w, len(keys)).astype(np.int64) for w in weights]


def _lookup(known: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Places in the sorted ``known``, -1 for what is not there."""
    out = np.full(len(keys), -1, np.int32)
    for i in range(0, len(keys) if len(known) else 0, BLOCK):
        some = keys[i:i + BLOCK]
        at = np.minimum(np.searchsorted(known, some), len(known) - 1)
        out[i:i + BLOCK] = np.where(known[at] == some, at, -1)
    return out


@dataclass(frozen=True)
class Frequent:
    """Counts (target, background as scaled) of frequent words, as words and as
    words with a follower, and of frequent bigrams; tokens, words, texts in all."""

    words: np.ndarray
    counts: np.ndarray
    followed: np.ndarray
    pairs: np.ndarray
    pair_counts: np.ndarray
    scale: np.ndarray
    tokens: np.ndarray
    distinct: int
    texts: np.ndarray

    def losses(self, pair, word, followed, n, last) -> np.ndarray:
        """Both models' losses: of ``n`` times the word after the one before it, where
        the word's own row as the one before counts for it at its n - last followers."""
        each = (word + 1.0) / (self.tokens + self.distinct)
        return (-n[:, None] * np.log(pair + STRENGTH * each)
                + (n - last)[:, None] * np.log(followed + STRENGTH))


def _frequent(marked: DataFrame) -> Frequent:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            at, word, pair, last = bigrams(list(b["text"]))
            target = b["target"].to_numpy(bool)[at]
            one = [target, ~target]
            keys, sums = _sums(word, *one, *(x & ~last for x in one))
            pairs, more = _sums(pair, *one)
            some = more[0] + more[1] >= len(at) * FREQUENT_PAIR
            begins = np.bincount(target[last], minlength=2)[::-1]
            blank = np.zeros(some.sum(), np.int64)
            rows = [np.concatenate((x, y[some], [z])) for x, y, z in zip(
                [np.zeros(len(keys), np.int8), keys, *sums],
                [np.ones(len(pairs), np.int8), pairs, *more, np.zeros_like(pairs), np.zeros_like(pairs)],
                [2, 0, *begins, 0, 0])] if len(at) else [blank] * 6
            for i in range(0, len(rows[0]), 100_000):
                yield pd.DataFrame(dict(zip(("kind", "key", "t", "b", "ft", "fb"), (x[i:i + 100_000] for x in rows))))
    sums = cut(marked.mapInPandas(run, "kind byte, key long, t long, b long, ft long, fb long").groupBy("kind", "key")
               .agg(*[F.sum(c).alias(c) for c in ("t", "b", "ft", "fb")]), "words")
    whole = {r["kind"]: r for r in sums.groupBy("kind").agg(
        F.sum("t").alias("t"), F.sum("b").alias("b"), F.count(F.lit(1)).alias("n")).collect()}
    tokens = np.array([whole[0]["t"], whole[0]["b"]], float) if 0 in whole else np.zeros(2)
    scale = np.array([1.0, tokens[0] / tokens[1] if tokens.all() else 1.0])
    texts = np.array([whole[2]["t"], whole[2]["b"]], float) if 2 in whole else np.zeros(2)

    # a bigram with twice the share has at least this many in batches where it was noted
    def those(kind: int, least: float):
        rows = sums.where((F.col("kind") == kind) & (F.col("t") + F.col("b") >= least)).orderBy("key").toArrow()
        return rows["key"].to_numpy(), np.stack([rows[c].to_numpy() for c in ("t", "b", "ft", "fb")], 1)
    words_, counts = those(0, tokens.sum() * FREQUENT_WORD)
    pairs, _ = those(1, tokens.sum() * FREQUENT_PAIR)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = np.zeros((2, len(pairs)), np.int64)
        for b in batches:
            at, _, pair, _ = bigrams(list(b["text"]))
            place = _lookup(pairs, pair)
            target = b["target"].to_numpy(bool)[at]
            for k, side in enumerate((target, ~target)):
                out[k] += np.bincount(place[side & (place >= 0)], minlength=len(pairs))
        yield pd.DataFrame({"at": np.arange(len(pairs)), "t": out[0], "b": out[1]})
    pair_counts = np.zeros((len(pairs), 2))
    for r in marked.mapInPandas(count, "at long, t long, b long").groupBy("at").agg(
            F.sum("t").alias("t"), F.sum("b").alias("b")).collect() if len(pairs) else ():
        pair_counts[r["at"]] = r["t"], r["b"]
    return Frequent(words_, counts[:, :2] * scale, counts[:, 2:] * scale, pairs, pair_counts * scale, scale,
                    tokens * scale, whole[0]["n"] if 0 in whole else 0, texts * scale)


def _distinct(word: np.ndarray, pair: np.ndarray, known: np.ndarray, buckets: int) -> tuple[np.ndarray, ...]:
    """The different bigrams, whatever the order of the tokens: hash, word (0 for a frequent
    one), the word's place in the frequent words ``known`` (-1: rare), bucket; and every
    token's place among them.
    All of a rare word's bigrams are in one bucket, a frequent word's in many.  They are in
    the order of buckets, then rare words (frequent ones first), then hashes."""
    order = np.argsort(pair).astype(np.int32)
    pairs = pair[order]
    new = np.ones(len(pair), bool)
    new[1:] = pairs[1:] != pairs[:-1]
    start = np.flatnonzero(new)
    pairs = pairs[start]
    its = np.minimum.reduceat(word[order], start) if len(start) else word
    del start
    often = _lookup(known, its)
    rare = np.where(often < 0, its.view(np.uint64), np.uint64(0))
    bucket = (np.where(often < 0, rare, pairs.view(np.uint64)) % np.uint64(buckets)).astype(np.int32)
    del its
    by = np.lexsort((rare, bucket)).astype(np.int32)
    rank = np.empty(len(by), np.int32)
    rank[by] = np.arange(len(by), dtype=np.int32)
    place = np.empty(len(pair), np.int32)
    nth = np.cumsum(new, dtype=np.int32)
    nth -= 1
    place[order] = rank[nth]
    del order, rank, nth
    return pairs[by], rare[by].view(np.int64), often[by], bucket[by], place


def _begins(*columns: np.ndarray) -> np.ndarray:
    """Whether any column differs from the row before."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return new


def _small(counts: np.ndarray) -> tuple[bytes, bytes]:
    """Rows of counts, mostly small, as a byte each, compressed; those of 255 or more also whole."""
    counts = counts.ravel("F")
    return (zstandard.ZstdCompressor(1).compress(np.minimum(counts, 255).astype(np.uint8).tobytes()),
            counts[counts >= 255].astype(np.int64).tobytes())


def _whole(small: bytes, large: bytes, columns: int) -> np.ndarray:
    """What ``_small`` packed, in rows of ``columns``."""
    counts = np.frombuffer(zstandard.ZstdDecompressor().decompress(small), np.uint8).astype(np.int64)
    counts[counts == 255] = np.frombuffer(large, np.int64)
    return counts.reshape(columns, -1).T


ASKED = "chunk long, bucket long, words binary, pairs binary, begins binary, small binary, large binary"
ANSWERED = "chunk long, bucket long, pairs binary, large_pairs binary, words binary, large_words binary"


def _answers(chunked: DataFrame, shared, buckets: int) -> DataFrame:
    """A row for every chunk of ``chunked`` (chunk, text, target) and bucket with bigrams of
    it: counts in the whole corpus (target, background) of the different bigrams, in the
    order of ``_distinct``, and of their rare words, as words and as words with a follower;
    a word of no meaning stands for the frequent ones."""
    def ask(rows: pd.DataFrame) -> pd.DataFrame:
        known = shared.value
        at, word, pair, last = bigrams(list(rows["text"]))
        rest = _lookup(known.pairs, pair) < 0
        mark = (last * np.int8(2) + rows["target"].to_numpy(bool)[at])[rest]
        del at, last
        word, pair = word[rest], pair[rest]
        pairs, its, _, bucket, place = _distinct(word, pair, known.words, buckets)
        del word, pair, rest
        counts = np.stack([np.bincount(place[mark == k], minlength=len(pairs)).astype(np.int32) for k in range(4)], 1)
        del place, mark
        new = _begins(its, bucket)
        ends = np.append(np.flatnonzero(_begins(bucket)), len(pairs))
        out = []
        for i, j in zip(ends[:-1], ends[1:]):
            small, large = _small(counts[i:j])
            out.append((rows["chunk"].iloc[0], bucket[i], its[i:j][new[i:j]].tobytes(), pairs[i:j].tobytes(),
                        np.packbits(new[i:j]).tobytes(), small, large))
        return pd.DataFrame(out, columns=["chunk", "bucket", "words", "pairs", "begins", "small", "large"])

    def answer(rows: pd.DataFrame) -> pd.DataFrame:
        pair = np.concatenate([np.frombuffer(x, np.int64) for x in rows["pairs"]])
        word = [np.frombuffer(x, np.int64) for x in rows["words"]]
        sizes, ends = [len(x) // 8 for x in rows["pairs"]], np.cumsum([len(x) for x in word])
        new = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=n) for x, n in zip(rows["begins"], sizes)])
        counts = np.concatenate([_whole(*x, 4) for x in zip(rows["small"], rows["large"])])
        sides = [counts[:, 1] + counts[:, 3], counts[:, 0] + counts[:, 2]]
        _, of = np.unique(pair, return_inverse=True)
        pairs = np.stack([np.bincount(of, x)[of] for x in sides], 1).astype(np.int64)
        _, its = np.unique(np.concatenate(word), return_inverse=True)
        at = its[np.cumsum(new, dtype=np.int64) - 1]
        words_ = np.stack([np.bincount(at, x)[its] for x in (*sides, counts[:, 1], counts[:, 0])], 1).astype(np.int64)
        out = [(*_small(x), *_small(y)) for x, y in zip(np.split(pairs, np.cumsum(sizes)[:-1]), np.split(words_, ends[:-1]))]
        return pd.concat([rows[["chunk", "bucket"]].reset_index(drop=True), pd.DataFrame(
            out, columns=["pairs", "large_pairs", "words", "large_words"])], axis=1)
    return (chunked.groupBy("chunk").applyInPandas(ask, ASKED)
            .groupBy("bucket").applyInPandas(answer, ANSWERED))


def _chunked(marked: DataFrame, tokens: float) -> DataFrame:
    """Every row's ``chunk``, drawn by the row's own number ``at``, so that neither equal
    texts nor equal ids meet in one."""
    chunks = max(1, round(tokens / (WORTH * BUCKET) + marked.count() / ROWS))
    return marked.select(F.pmod(F.xxhash64("at"), F.lit(chunks)).alias("chunk"), "doc_id", "text", "target")


def difference(docs: DataFrame, is_target: DataFrame) -> DataFrame:
    """The columns of ``score`` for every row of ``docs`` (doc_id, text), from models of
    all words and all bigrams of ``docs``: rows whose doc_id is in ``is_target`` (doc_id)
    are the target, all others the background."""
    small_batches(docs.sparkSession)
    marks = cut(is_target.select("doc_id").dropna().distinct().withColumn("target", F.lit(True)), "target")
    # sorted and merged at every size: the list of target rows grows with the corpus
    marked = cut(docs.select("doc_id", "text").join(marks.hint("merge"), "doc_id", "left").select(
        "doc_id", "text", F.coalesce("target", F.lit(False)).alias("target"),
        F.monotonically_increasing_id().alias("at")), "marked", "zstd")
    model = _frequent(marked.select("text", "target"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    tokens = float((model.tokens / model.scale).sum())
    buckets = max(1, round(tokens / BUCKET))
    chunked = _chunked(marked, tokens)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def settle(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        known = shared.value
        at, word, pair, last = bigrams(list(rows["text"]))
        size = len(rows)
        tokens = np.bincount(at, minlength=size)
        out = np.where(tokens[:, None] > 0, np.log(known.texts + STRENGTH), 0.0)   # the begin as the word before
        place = _lookup(known.pairs, pair)
        here = place >= 0
        for i in range(0, len(at), BLOCK):
            of = np.flatnonzero(here[i:i + BLOCK]) + i
            its = _lookup(known.words, word[of])            # a frequent bigram's words are frequent
            lost = known.losses(known.pair_counts[place[of]], known.counts[its], known.followed[its],
                                np.ones(len(of)), last[of].astype(float))
            for k in (0, 1):
                out[:, k] += np.bincount(at[of], lost[:, k], size)
        del place
        if not here.all():
            at, last, word, pair = (x[~here] for x in (at, last, word, pair))
            _, rare, often, bucket, of = _distinct(word, pair, known.words, buckets)
            del word, pair
            answers = answers.sort_values("bucket")
            counts = np.concatenate([_whole(*x, 2) for x in zip(answers["pairs"], answers["large_pairs"])])
            whole = np.concatenate([_whole(*x, 4) for x in zip(answers["words"], answers["large_words"])])
            its = np.cumsum(_begins(rare, bucket), dtype=np.int32) - 1
            del rare, bucket
            of_word, of_pair = np.empty((2, len(its)))
            for k in (0, 1):
                for i in range(0, len(its), BLOCK):
                    some = slice(i, i + BLOCK)
                    count, followed = (whole[its[some], c] * known.scale[k] for c in (k, 2 + k))
                    if len(known.words):        # a bucket has not all of a frequent word's
                        count = np.where(often[some] < 0, count, known.counts[often[some], k])
                        followed = np.where(often[some] < 0, followed, known.followed[often[some], k])
                    each = (count + 1.0) / (known.tokens[k] + known.distinct)
                    of_word[some] = np.log(followed + STRENGTH)
                    of_pair[some] = np.log(counts[some, k] * known.scale[k] + STRENGTH * each)
                for i in range(0, len(at), BLOCK):
                    some = slice(i, i + BLOCK)
                    out[:, k] += np.bincount(at[some], np.where(last[some], 0.0, of_word[of[some]]) - of_pair[of[some]], size)
        mean = out / np.maximum(tokens, 1)[:, None]
        return pd.DataFrame({"doc_id": rows["doc_id"], "n_tokens": tokens, "target_loss": mean[:, 0],
                             "background_loss": mean[:, 1]})
    # both readings of the chunks are one shuffle
    return (chunked.groupBy("chunk").cogroup(_answers(chunked, shared, buckets).groupBy("chunk"))
            .applyInPandas(settle, f"doc_id {kind}, n_tokens long, target_loss double, background_loss double")
            .withColumn("score", F.col("target_loss") - F.col("background_loss")))

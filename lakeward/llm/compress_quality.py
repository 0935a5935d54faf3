"""Quality scores from compressed sizes.

Two zstandard dictionaries are built, one from texts labelled good and one from
texts labelled bad.  A text is cut into windows, each is compressed with either
dictionary, and the sizes are added up over the whole text.  The difference of
the two sums over their sum says which kind of text it resembles; a logistic
curve over it (and over the log of the compressed size a byte, as the same
difference means more in text that compresses badly) makes it a probability.
The curve is fitted on labelled texts that are in neither dictionary.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The sample that is fitted on: at most so many labelled texts of each kind,
#: those first by a hash of their id, none longer than so many bytes.
SAMPLE_ROWS, SAMPLE_BYTES = 4000, 32_768
DICTIONARY_BYTES, LEVEL, WINDOW = 112_640, 3, 2048
#: Bytes added to the sum of sizes, so that short texts differ less.
DOUBT = 64


@dataclass(frozen=True)
class Model:
    """Dictionaries (empty: none) and the curve over 50 times the difference (to
    bring it to the scale of the others), log size a byte, and one."""

    good: bytes
    bad: bytes
    weights: tuple[float, float, float]


def _dictionary(texts: list[bytes]) -> bytes:
    """A trained dictionary, or the texts themselves where they are too few."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, texts, level=LEVEL).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(texts)[-DICTIONARY_BYTES:]


class Sizes:
    def __init__(self, good: bytes, bad: bytes):
        self.compressors = []
        for content in (good, bad):
            options = {}
            if len(content) >= 8:
                options["dict_data"] = zstandard.ZstdCompressionDict(content)
                options["dict_data"].precompute_compress(level=LEVEL)
            self.compressors.append(zstandard.ZstdCompressor(
                level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False, **options))

    def features(self, text: str | None) -> tuple[float, float, float]:
        data = (text or "").encode("utf-8", "surrogatepass")
        good, bad = (sum(len(c.compress(data[i:i + WINDOW])) for i in range(0, max(1, len(data)), WINDOW))
                     for c in self.compressors)
        return 50 * (bad - good) / (bad + good + DOUBT), float(np.log(min(good, bad) / (len(data) + 1))), 1.0


def _curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton's method with a slight ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - y)) + 0.02 * w
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + 0.02 * np.eye(len(w)), slope)
        w = w - np.clip(step, -20, 20)
    return w


def fit(good: list[str], bad: list[str], n_good: int, n_bad: int) -> Model:
    """Every second distinct text goes into its dictionary, without the lines
    that other texts have too (they tell nothing of a text's kind); the others
    go to the curve, weighted to the classes' counts ``n_good`` and ``n_bad``.  With a
    class missing, the score is the smoothed share of good labels."""
    kinds = [list(dict.fromkeys(t.encode("utf-8", "surrogatepass") for t in texts if t)) for texts in (good, bad)]
    share = (n_good + 1) / (n_good + n_bad + 2)
    if min(map(len, kinds)) < 2:
        return Model(b"", b"", (0.0, 0.0, float(np.log(share / (1 - share)))))
    seen = Counter(line for k in kinds for t in k for line in set(t.split(b"\n")))
    own = [[b"\n".join(line for line in t.split(b"\n") if seen[line] == 1) for t in k[::2]] for k in kinds]
    model = Model(*(_dictionary([t for t in k if t]) for k in own), (0.0, 0.0, 0.0))
    sizes = Sizes(model.good, model.bad)
    x = [np.array([sizes.features(t.decode("utf-8", "surrogatepass")) for t in k[1::2]]) for k in kinds]
    y = np.repeat([1.0, 0.0], [len(x[0]), len(x[1])])
    n = len(y)
    weight = np.where(y == 1, share * n / len(x[0]), (1 - share) * n / len(x[1]))
    return Model(model.good, model.bad, tuple(map(float, _curve(np.concatenate(x), y, weight))))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on a bounded sample of ``labels`` (doc_id, quality 1 or 0).

    Ids labelled both ways and null labels are left out; the classes' counts
    are over all labels.  The ids are drawn from the labels alone, so that the
    documents are only filtered by a list of at most 2 * SAMPLE_ROWS ids, not
    shuffled; at most that many texts of at most SAMPLE_BYTES come to the
    driver.  Of several documents with one id the first text counts."""
    once = (labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id")
            .agg(F.min("quality").alias("quality"), F.max("quality").alias("most"))
            .where("quality = most").select("doc_id", "quality"))
    counts = {r["quality"]: r["count"] for r in once.groupBy("quality").count().collect()}
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    ids = [once.where(F.col("quality") == q).orderBy(*order).limit(SAMPLE_ROWS) for q in (0, 1)]
    rows = (docs.select("doc_id", "text").where(F.octet_length("text").between(1, SAMPLE_BYTES))
            .join(F.broadcast(ids[0].unionAll(ids[1])), "doc_id")
            .groupBy("doc_id", "quality").agg(F.min("text").alias("text")).collect())
    rows.sort(key=lambda r: r["doc_id"])
    texts = [[r["text"] for r in rows if r["quality"] == q] for q in (1, 0)]
    return fit(*texts, counts.get(1, 0), counts.get(0, 0))


def score(docs: DataFrame, model: Model, with_rows: bool = False) -> DataFrame:
    """Add ``score`` (0 to 1, higher: good is likelier) and ``predicted`` (1 if
    at least 0.5, else 0) to every row's ``doc_id``, or with ``with_rows`` to all
    columns.  Null and empty texts are scored as empty; columns of these names
    are replaced.  One pass over whole texts, no shuffle."""
    @F.pandas_udf("double")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        sizes, weights = Sizes(model.good, model.bad), np.array(model.weights)
        for s in texts:
            x = np.array([sizes.features(t) for t in s]).reshape(-1, 3)
            yield pd.Series(1 / (1 + np.exp(-np.clip(x @ weights, -700, 700))))
    rows = docs if with_rows else docs.select("doc_id", "text")
    rows = rows.withColumn("score", run("text"))
    rows = rows.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))
    return rows if with_rows else rows.drop("text")


def held_out(doc_id: str = "doc_id"):
    """Rows whose labels no training sees: CRC-32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))

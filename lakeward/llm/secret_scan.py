"""Secret scans: fixed patterns, and character Markov models of random strings
and of ordinary identifiers compared by their log-likelihood ratio.

The models are first-order chains over character classes that keep every ASCII
letter, digit and joining mark apart, started at the border of a token.  They
are trained from labelled samples (value, is it random).  Where no samples are
at hand they are drawn from the corpus itself: what the fixed patterns match is
random, other tokens of the same form are ordinary; one pass counts both over
all texts, and only two tables of counts leave the tasks.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The base patterns (kind, pattern, group whose length counts, least length).
BASE = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                          re.ASCII | re.IGNORECASE), 2, 12),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 16),
)
#: The same, for a quick search: a maximal run of hex digits is matched only if long enough.
HEX_RUN = re.compile(r"[0-9a-f]{16,}")
#: What the models look at: runs of token characters with at least this many.
LEAST = 16
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % LEAST)

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
JOINING = "+/_=-"
SIZE = len(ALPHABET) + 1                    # state 0 is the border
STATE = np.zeros(256, np.int64)
STATE[np.frombuffer(ALPHABET.encode(), np.uint8)] = np.arange(1, SIZE)


def states(value: str) -> np.ndarray:
    """Border, then the characters' states; other characters count as border."""
    return np.concatenate(([0], STATE[np.frombuffer(value.encode("ascii", "replace"), np.uint8)]))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base patterns, by start, then in the kinds' order."""
    spans = []
    for kind, pattern, group, least in BASE:
        for m in (HEX_RUN if kind == "hex" else pattern).finditer(text):
            if len(m[group]) >= least:
                spans.append((m.start(), m.end(), kind))
    order = {kind: i for i, (kind, *_) in enumerate(BASE)}
    return sorted(spans, key=lambda s: (s[0], order[s[2]]))


@dataclass(frozen=True)
class Markov:
    """Log-likelihood ratios of character steps, random over ordinary, and the
    mean ratio a character from which a token counts as random."""

    ratio: np.ndarray
    threshold: float

    def score(self, value: str) -> float:
        s = states(value)
        return float(self.ratio[s[:-1], s[1:]].mean()) if len(s) > 1 else 0.0


def markov(random: np.ndarray, ordinary: np.ndarray, threshold: float = 0.5,
           strength: float = 5.0) -> Markov:
    """Models from two tables of step counts.  A row is smoothed towards its
    model's character frequencies (``strength`` pseudo-counts), and these
    towards equal frequencies, so that steps never seen stay finite."""
    def log(counts: np.ndarray) -> np.ndarray:
        letters = counts.sum(0) + 1.0
        letters /= letters.sum()
        return np.log((counts + strength * letters) / (counts.sum(1, keepdims=True) + strength))
    return Markov(log(random.astype(float)) - log(ordinary.astype(float)), threshold)


def _count(table: np.ndarray, value: str) -> None:
    s = states(value)
    np.add.at(table, (s[:-1], s[1:]), 1)


def _tables(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the tasks' counts; at most 2 * SIZE * SIZE rows come to the driver."""
    out = np.zeros((2, SIZE * SIZE))
    for r in rows.groupBy("random", "cell").agg(F.sum("n").alias("n")).collect():
        out[int(r["random"]), r["cell"]] = r["n"]
    return out[1].reshape(SIZE, SIZE), out[0].reshape(SIZE, SIZE)


def _emit(tables: np.ndarray) -> pd.DataFrame:
    random, cell = np.nonzero(tables.reshape(2, -1))
    return pd.DataFrame({"random": random.astype(bool), "cell": cell.astype(np.int32),
                         "n": tables.reshape(2, -1)[random, cell]})


def train(samples: DataFrame, threshold: float = 0.5) -> Markov:
    """Models from labelled samples: ``value`` (string), ``random`` (boolean).
    Rows with a null are left out; without samples every ratio is zero."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables = np.zeros((2, SIZE, SIZE), np.int64)
        for b in batches:
            for value, random in zip(b["value"], b["random"]):
                _count(tables[int(random)], value)
        yield _emit(tables)
    rows = samples.select("value", "random").dropna()
    return markov(*_tables(rows.mapInPandas(run, "random boolean, cell int, n long")), threshold)


def train_on_texts(docs: DataFrame, threshold: float = 0.5) -> Markov:
    """Models from all texts: the values that base patterns match are the
    random samples, all other words the ordinary ones.  One pass; each task
    sends two tables of counts."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables = np.zeros((2, SIZE, SIZE), np.int64)
        for b in batches:
            for text in b["text"]:
                if not text:
                    continue
                rest, at = [], 0
                for start, end, kind in base_spans(text):
                    if end <= at:
                        continue
                    m = BASE[0][1].fullmatch(text, start, end) if kind == "assign" else None
                    _count(tables[1], m[2] if m else text[start:end])
                    rest.append(text[at:start])
                    at = end
                rest.append(text[at:])
                # all other words at once: the steps of the whole text but for those from border to border
                s = states(" ".join(rest))
                cells = s[:-1] * SIZE + s[1:]
                tables[0] += np.bincount(cells[cells > 0], minlength=SIZE * SIZE).reshape(SIZE, SIZE)
        yield _emit(tables)
    return markov(*_tables(docs.select("text").mapInPandas(run, "random boolean, cell int, n long")), threshold)


def stretches(value: str, model: Markov) -> list[tuple[int, int]]:
    """(start, end) of the random stretches of a run: those of at least LEAST
    characters whose ratios less the threshold have the largest sum, if that is
    not negative, widened to the joining marks around them; by start.  Steps from
    and to a joining mark tell nothing here: words are joined by them, too."""
    s = states(value)
    steps = np.where(np.maximum(s[:-1], s[1:]) >= SIZE - len(JOINING), 0.0, model.ratio[s[:-1], s[1:]])
    sums = np.concatenate(([0.0], np.cumsum(steps - model.threshold)))
    out, left = [], [(0, len(value))]
    while left:
        low, high = left.pop()
        if high - low < LEAST:
            continue
        least = np.minimum.accumulate(sums[low:high - LEAST + 1])
        gain = sums[low + LEAST:high + 1] - least
        k = int(gain.argmax())
        if gain[k] < 0:
            continue
        start, end = low + int(sums[low:low + k + 1].argmin()), low + LEAST + k
        while start > low and value[start - 1] not in JOINING:
            start -= 1
        while end < high and value[end] not in JOINING:
            end += 1
        out.append((start, end))
        left += [(low, start), (end, high)]
    return sorted(out)


def find(text: str, model: Markov) -> list[tuple[int, int, str]]:
    """Base spans, then the stretches of tokens, and of what base spans leave of
    them, that the models call random (kind ``markov``); by start, base kinds first."""
    spans, found, k = base_spans(text), [], 0
    taken: list[list[int]] = []             # the base spans, merged
    for start, end, _ in spans:
        if taken and start <= taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], end)
        else:
            taken.append([start, end])
    for m in TOKEN.finditer(text):
        while k < len(taken) and taken[k][1] <= m.start():
            k += 1
        at, j = m.start(), k
        while at < m.end():
            cut, after = taken[j] if j < len(taken) and taken[j][0] < m.end() else (m.end(), m.end())
            if cut - at >= LEAST and model.score(text[at:cut]) >= model.threshold:
                found.append((at, cut, "markov"))
            elif cut - at >= LEAST:
                found += [(at + a, at + b, "markov") for a, b in stretches(text[at:cut], model)]
            at, j = max(at, after), j + 1
    order = {kind: i for i, kind in enumerate([k for k, *_ in BASE] + ["markov"])}
    return sorted(spans + found, key=lambda s: (s[0], order[s[2]]))


def scan(docs: DataFrame, model: Markov, mask: str | None = None) -> DataFrame:
    """Find the secrets of every whole text.  A null text counts as empty.

    Returns ``doc_id``, ``found`` (array of start, end, kind; code points, end
    exclusive) and, with ``mask``, ``masked``: the text with each stretch of
    touching or overlapping spans replaced by ``mask`` (a null text stays
    null).  One pass, no shuffle; other columns of ``docs`` are not read."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for doc_id, text in zip(b["doc_id"], b["text"]):
                spans = find(text, model) if text else []
                rows.append((doc_id, [{"start": s, "end": e, "kind": k} for s, e, k in spans],
                             blot(text, spans, mask) if mask is not None else None))
            out = pd.DataFrame(rows, columns=["doc_id", "found", "masked"])
            out["doc_id"] = b["doc_id"].to_numpy()
            yield out
    out = docs.select("doc_id", "text").mapInPandas(
        run, f"doc_id {kind}, found array<struct<start: int, end: int, kind: string>>, masked string")
    return out if mask is not None else out.drop("masked")


def masked(docs: DataFrame, model: Markov, mask: str) -> DataFrame:
    """All columns of ``docs``, the secrets in ``text`` replaced by ``mask`` and
    ``n_chars`` the length of what is left.  Null texts stay null."""
    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([blot(t, find(t, model), mask) if t else t for t in texts], dtype=object)
    return docs.withColumn("text", run("text")).withColumn("n_chars", F.length("text").cast("long"))


def blot(text: str | None, spans: list[tuple[int, int, str]], mask: str) -> str | None:
    if not spans:
        return text
    out, at = [], 0
    for start, end, _ in sorted(spans):
        if start > at or not out:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join(out) + text[at:]


def digest(found: DataFrame) -> DataFrame:
    """The query's columns from ``scan``'s: counts of the base kinds, the
    SHA-256 of the base spans and all spans, as kind:start:end by comma."""
    def line(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
    def of(kind):
        return lambda s: s["kind"] == kind
    base = F.filter("found", lambda s: s["kind"] != "markov")
    return found.select("doc_id", *[F.size(F.filter("found", of(kind))).cast("long").alias(f"n_{kind}")
                                    for kind, *_ in BASE],
                        F.sha2(line(base), 256).alias("base_sha256"), line(F.col("found")).alias("spans"))


def sha256_line(spans: list[tuple[int, int, str]]) -> str:
    """For tests: the digest of base spans as the query gives it."""
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, e, k in spans).encode()).hexdigest()

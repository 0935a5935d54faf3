"""Byte-level BPE by dynamic programming over prefixes.

For every prefix of a byte string there is exactly one token that the encoding
of that prefix ends with.  The table of these last tokens is built from left to
right: the last token of ``data[:i]`` is the one token ``t`` ending at ``i``
whose predecessor, the stored last token of ``data[:i - len(t)]``, forms a pair
with ``t`` that byte-pair merging would leave unmerged.  Following the table
backwards from the end gives the encoding.  An entry depends only on the
``longest`` entries before it, so text can be appended without touching what is
stored, and after an edit the table is rebuilt only until it agrees with the
old one again.

Texts are first split by the vocabulary's pattern; merges never cross a match.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Parts of text (and pairs of tokens) that a worker remembers; beyond this the
#: memory is emptied.  Longer parts are encoded each time.
REMEMBERED, REMEMBER_CHARS = 100_000, 40
#: Ids that a worker gathers before it hands them over.
HANDED_OVER = 1 << 20
#: Fixed: the end of patterns that start a match at every space between two
#: characters that are not white space, so that texts can be cut there.
CUTS_AT_SPACES = r"| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Memory:
    """Remembers results for keys in two generations of bounded size; what is
    asked for again moves to the younger one, the older one is dropped whole."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def put(self, key, value):
        if len(self.young) >= self.size:
            self.old = dict(self.young)
            self.young.clear()              # callers hold on to this very dict
        self.young[key] = value
        return value

    def again(self, key):
        """The value of a key that is not among the young ones, or None."""
        value = self.old.get(key)
        return value if value is None else self.put(key, value)


class Vocabulary:
    """Ranks of byte strings; a token's id is its rank.

    ``halves[t]`` are the two tokens whose merge makes ``t``, found by running
    the merges below ``t``'s rank on ``t``'s own bytes.  ``merged`` is the
    inverse.  Byte strings that merging never produces are not used."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.cuts_at_spaces = pattern.endswith(CUTS_AT_SPACES)
        self.bytes = {i: b for b, i in ranks.items()}
        self.size = {i: len(b) for b, i in ranks.items()}
        self.halves: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        self.usable: dict[bytes, int] = {}
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            if len(token) == 1:
                self.usable[token] = rank
                continue
            parts = self._merge(token, rank)
            if len(parts) == 2:
                pair = (ranks[parts[0]], ranks[parts[1]])
                self.halves[rank], self.merged[pair] = pair, rank
                self.usable[token] = rank
        self.longest = max(map(len, self.usable), default=1)
        # the usable tokens' reversed bytes as a tree: steps[state << 8 | byte], ends[state]
        self.steps: dict[int, int] = {}
        self.ends = [-1]
        for token, rank in self.usable.items():
            state = 0
            for byte in reversed(token):
                state = self.steps.setdefault(state << 8 | byte, len(self.ends))
                if state == len(self.ends):
                    self.ends.append(-1)
            self.ends[state] = rank
        self.judged = Memory(REMEMBERED)     # pairs of tokens already tried
        missing = [b for b in range(256) if bytes([b]) not in self.usable]
        if missing:
            raise ValueError(f"the vocabulary lacks {len(missing)} single bytes")

    def _merge(self, data: bytes, below: int) -> list[bytes]:
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best, at = min((self.ranks.get(a + b, below), i)
                           for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if best >= below:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def follow(self, last: list[int]) -> list[int]:
        """The encoding, read off the table of last tokens from its end."""
        out, i, size = [], len(last), self.size
        while i:
            out.append(last[i - 1])
            i -= size[last[i - 1]]
        out.reverse()
        return out

    def judge(self, pair: int) -> bool:
        """``compatible`` of the two tokens in ``pair``, remembered."""
        ok = self.judged.again(pair)
        return self.judged.put(pair, self.compatible(pair >> 32, pair & 0xFFFFFFFF)) if ok is None else ok

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the bytes of ``left + right`` ends in this very pair.

        Both tokens are taken apart in reverse order of their merges.  At each
        step the two tokens that touch at the border must not have a merge
        that would have come before the one just undone."""
        undone = None                       # (rank, on the left?) of the merge undone last
        merged, halves = self.merged, self.halves
        a, b = left, right
        while True:
            m = merged.get((a, b))
            # of two equal ranks the leftmost merge comes first
            if m is not None and (undone is None or m < undone[0] or (m == undone[0] and not undone[1])):
                return False
            ha, hb = halves.get(a), halves.get(b)
            if ha is None and hb is None:
                return True
            # the later merge of the two is undone first; on a tie the right one
            if hb is None or (ha is not None and a > b):
                undone, a = (a, True), ha[1]
            else:
                undone, b = (b, False), hb[0]


class PrefixTable:
    """The last token of every prefix of one match (``last[i]`` for ``data[:i + 1]``)."""

    def __init__(self, vocab: Vocabulary, data: bytes = b""):
        self.vocab, self.data, self.last = vocab, b"", []
        self.append(data)

    def _next(self, i: int) -> int:
        """The last token of ``data[:i + 1]``.

        Walks back through the tokens' reversed bytes; of the tokens that end
        here, just one is compatible with the entry before it."""
        data, last, ends, step = self.data, self.last, self.vocab.ends, self.vocab.steps.get
        state, at, known = 0, i, self.vocab.judged.young.get
        while True:
            state = step(state << 8 | data[at])
            at -= 1
            token = ends[state]
            if token >= 0:
                if at < 0:
                    return token
                pair = last[at] << 32 | token
                ok = known(pair)
                if ok is None:
                    ok = self.vocab.judge(pair)
                if ok:
                    return token

    def append(self, more: bytes) -> None:
        """Add bytes at the end; entries already stored stay as they are."""
        self.data += more
        for i in range(len(self.last), len(self.data)):
            self.last.append(self._next(i))

    def edit(self, start: int, end: int, new: bytes) -> int:
        """Replace ``data[start:end]``; returns how many entries were computed.

        Behind the new bytes the old entries hold again as soon as ``longest``
        of them in a row come out the same."""
        old_tail = self.last[end:]
        self.data = self.data[:start] + new + self.data[end:]
        del self.last[start:]
        same = done = 0
        for i in range(start, len(self.data)):
            token = self._next(i)
            self.last.append(token)
            done += 1
            behind = done - 1 - len(new)
            same = same + 1 if behind >= 0 and token == old_tail[behind] else 0
            if same >= self.vocab.longest:
                self.last += old_tail[behind + 1:]
                break
        return done

    def tokens(self) -> list[int]:
        return self.vocab.follow(self.last)


class EncodedText:
    """A whole text kept as matches with prefix tables, for appends and edits."""

    def __init__(self, vocab: Vocabulary, text: str = ""):
        self.vocab, self.text = vocab, text
        self.spans, self.tables = [], []
        for m in vocab.pattern.finditer(text):
            self.spans.append(m.span())
            self.tables.append(PrefixTable(vocab, m.group().encode()))

    def append(self, more: str) -> int:
        return self.edit(len(self.text), len(self.text), more)

    def edit(self, start: int, end: int, new: str) -> int:
        """Replace ``text[start:end]``; returns the number of matches encoded.

        Matching starts anew two matches before the edit, for the pattern looks
        one character ahead, and stops where a match begins at an old border
        behind the edit.  A match that only grew is appended to."""
        shift = len(new) - (end - start)
        self.text = self.text[:start] + new + self.text[end:]
        first = 0
        while first < len(self.spans) and self.spans[first][1] < start:
            first += 1
        first = max(0, first - 2)
        at = self.spans[first][0] if self.spans else 0
        borders = {s + shift: k for k, (s, _) in enumerate(self.spans) if s >= end and k > first}
        spans, tables, rest, done = [], [], len(self.spans), 0
        for m in self.vocab.pattern.finditer(self.text, at):
            if m.start() in borders and m.start() > start + len(new):
                rest = borders[m.start()]
                break
            data, k = m.group().encode(), first + len(spans)
            old = self.tables[k] if k < len(self.tables) and self.spans[k][0] == m.start() < start else None
            if old is not None and data.startswith(old.data):
                old.append(data[len(old.data):])
            else:
                old = PrefixTable(self.vocab, data)
                done += 1
            spans.append(m.span())
            tables.append(old)
        self.spans[first:] = spans + [(s + shift, e + shift) for s, e in self.spans[rest:]]
        self.tables[first:] = tables + self.tables[rest:]
        return done

    def tokens(self) -> list[int]:
        return [t for table in self.tables for t in table.tokens()]


class Encoder:
    """Encodes whole texts; remembers the ids of short stretches of text.

    A text is cut before those spaces that have something other than white
    space on both sides.  The pattern starts a match at each of them, so the
    stretches can be matched, encoded and remembered one by one."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.parts, self.matches = Memory(REMEMBERED), Memory(REMEMBERED)
        self.lasts = Memory(REMEMBERED)      # prefixes of short matches -> their last tokens

    def last(self, data: bytes) -> int:
        """The last token of ``data``, a short prefix of a match.  Only the
        prefixes that it depends on are looked at, which are few when the longest
        tokens that ``data`` can end with are tried first."""
        token = self.lasts.again(data)
        if token is not None:
            return token
        vocab, ends, step = self.vocab, self.vocab.ends, self.vocab.steps.get
        token = vocab.usable.get(data)
        if token is None:
            state, tokens, known, judged = 0, [], self.lasts.young.get, vocab.judged.young.get
            for byte in reversed(data):
                state = step(state << 8 | byte)
                if state is None:
                    break
                if ends[state] >= 0:
                    tokens.append(ends[state])
            for token in reversed(tokens):
                before = data[:-vocab.size[token]]
                left = known(before)
                if left is None:
                    left = self.last(before)
                pair = left << 32 | token
                ok = judged(pair)
                if vocab.judge(pair) if ok is None else ok:
                    break
        return self.lasts.put(data, token)

    def match(self, piece: str) -> tuple[int, ...]:
        """The ids of one match, read off the last tokens of its prefixes."""
        data = piece.encode("utf-8", "surrogatepass")
        token = self.vocab.usable.get(data)
        if token is not None:
            return (token,)
        if len(data) > REMEMBER_CHARS:
            return tuple(PrefixTable(self.vocab, data).tokens())
        out, known, size = [], self.lasts.young.get, self.vocab.size
        while data:
            token = known(data)
            if token is None:
                token = self.last(data)
            out.append(token)
            data = data[:-size[token]]
        out.reverse()
        return tuple(out)

    def stretch(self, part: str) -> tuple[int, ...]:
        out, known, memory = [], self.matches.young.get, self.matches
        for piece in self.vocab.pattern.findall(part):
            ids = known(piece) or memory.again(piece)
            if ids is None:
                ids = self.match(piece)
                if len(piece) <= REMEMBER_CHARS:
                    memory.put(piece, ids)
            out += ids
        return tuple(out)

    def part(self, part: str) -> tuple[int, ...]:
        """The ids of a space and ``part``, which has white space at neither end."""
        ids = self.parts.again(part)
        if ids is not None:
            return ids
        # a mark behind an ASCII letter or digit is a match of its own
        if part[-1] in ".,;:!?" and part[-2:-1].isascii() and part[-2:-1].isalnum():
            return (self.parts.young.get(part[:-1]) or self.part(part[:-1])) + self.stretch(part[-1])
        # letters only (of Latin scripts, alike in all versions of Unicode): one match
        one = part.isalpha() and max(part) < "\u0250"
        ids = self.match(" " + part) if one else self.stretch(" " + part)
        return self.parts.put(part, ids) if len(part) <= REMEMBER_CHARS else ids

    def encode(self, text: str) -> list[int]:
        """``held`` is text not yet encoded; None when the last part is done."""
        parts = text.split(" ") if self.vocab.cuts_at_spaces else [text]
        known, out, held = self.parts.young.get, [], parts[0]
        for part in parts[1:]:
            ids = known(part) if held is None else None
            if ids is not None:
                out += ids
            elif part and not part[0].isspace() and (held is None or held and not held[-1].isspace()):
                if held is not None:
                    out += self.stretch(held)
                if part[-1].isspace():
                    held = " " + part
                else:
                    held = None
                    out += self.part(part)
            else:
                held = (held or "") + " " + part
        if held is not None:
            out += self.stretch(held)
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocab.bytes.__getitem__, ids))


@functools.lru_cache(maxsize=2)
def encoder(ranks_path: str, pattern: str) -> Encoder:
    """One encoder a worker, kept from task to task with what it remembers."""
    return Encoder(load(ranks_path, pattern))


@functools.lru_cache(maxsize=2)
def load(ranks_path: str, pattern: str) -> Vocabulary:
    """The vocabulary of a rank file (base64 bytes and rank a line), once a worker."""
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return Vocabulary(ranks, pattern)


def encode(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text",
           ids_col: str = "token_ids") -> DataFrame:
    """Add ``ids_col`` (array<int>), the ids of every whole text; a null text
    counts as empty, and so gives an empty array.  An existing column of that
    name is replaced.  One pass without a shuffle."""
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        enc = encoder(ranks_path, pattern)
        for texts in batches:
            flat, ends = array("i"), [0]
            for text in texts:
                flat.extend(enc.encode(text.as_py() or ""))
                ends.append(len(flat))
                if len(flat) >= HANDED_OVER:
                    yield as_lists(flat, ends)
                    flat, ends = array("i"), [0]
            yield as_lists(flat, ends)
    return docs.withColumn(ids_col, F.arrow_udf("array<int>")(ids)(F.col(text_col)))


def as_lists(flat: array, ends: list[int]) -> pa.Array:
    """Arrow lists of the ids between each two ends."""
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(flat, np.int32), pa.int32()))


def decode(docs: DataFrame, ranks_path: str, pattern: str, ids_col: str = "token_ids",
           out_col: str = "decoded") -> DataFrame:
    """Add ``out_col`` (binary), the bytes that the ids stand for; a null array
    gives a null."""
    @F.pandas_udf("binary")
    def join(ids: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoder(ranks_path, pattern)
        for s in ids:
            yield pd.Series([None if x is None else enc.decode(list(x)) for x in s], dtype=object)
    return docs.withColumn(out_col, join(F.col(ids_col)))


def round_trip(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Encode, decode and digest each row's text inside the task: ``doc_id``,
    ``n_tokens``, ``ids_sha256`` (decimal ids joined by one space) and
    ``decoded_sha256``.  The ids themselves never leave the worker."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, sha = encoder(ranks_path, pattern), hashlib.sha256
        decimal = {i: str(i) for i in enc.vocab.bytes}.__getitem__
        for b in batches:
            n, ids_sha, text_sha = [], [], []
            for text in b.column("text"):
                ids = enc.encode(text.as_py() or "")
                n.append(len(ids))
                ids_sha.append(sha(" ".join(map(decimal, ids)).encode()).hexdigest())
                text_sha.append(sha(enc.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")

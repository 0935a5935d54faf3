import base64
import hashlib

import public_tokenizers as P
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from lakeward.llm import bpe
from lakeward.llm.queries import byte_bpe
from odd_rows import ODD

PATH, PATTERN = byte_bpe()
VOCAB = bpe.load(PATH, PATTERN)
with open(PATH, "rb") as f:
    RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
TIK = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
ENCODER = bpe.Encoder(VOCAB)
PARTS = ["a", "b", "the", " ", "  ", "\n", " \n", "\t", "é", "日本", "🙂", "'s", "'ll", "12", "!!", "...", "\x00", "\xa0", "aaaa", "ABC", "://", "---"]
TEXT = st.lists(st.sampled_from(PARTS), max_size=40).map("".join) | st.text(max_size=60)


@settings(max_examples=400, deadline=None)
@given(TEXT)
def test_encodes_like_the_library(text):
    ids = ENCODER.encode(text)
    assert ids == TIK.encode_ordinary(text)
    assert ENCODER.decode(ids) == text.encode()


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=60))
def test_a_prefix_table_holds_each_prefix_encoding(data):
    table = bpe.PrefixTable(VOCAB, data)
    for i in range(1, len(data) + 1):
        part = TIK._encode_single_piece(data[:i])
        assert table.last[i - 1] == part[-1]
    assert table.tokens() == (TIK._encode_single_piece(data) if data else [])


@settings(max_examples=200, deadline=None)
@given(TEXT, st.lists(st.tuples(st.integers(0, 60), st.integers(0, 6), TEXT.map(lambda t: t[:8])), max_size=5))
def test_edits_and_appends_are_exact(text, edits):
    held = bpe.EncodedText(VOCAB, text)
    for at, length, new in edits:
        at = min(at, len(text))
        end = min(len(text), at + length)
        text = text[:at] + new + text[end:]
        held.edit(at, end, new)
        assert held.text == text and held.tokens() == TIK.encode_ordinary(text)
    held.append(" more")
    assert held.tokens() == TIK.encode_ordinary(text + " more")


def test_an_edit_computes_few_entries():
    table = bpe.PrefixTable(VOCAB, b"abcdefgh" * 2000)
    assert table.edit(100, 103, b"xyz") < 3 + 2 * VOCAB.longest
    assert table.tokens() == bpe.PrefixTable(VOCAB, table.data).tokens()


def test_one_long_match_is_linear():
    for text in ("a" * 100_000, "-" * 50_000, "ab" * 40_000):
        assert ENCODER.encode(text) == TIK.encode_ordinary(text)


def test_memory_is_bounded_and_keeps_what_is_used():
    m = bpe.Memory(10)
    for i in range(1000):
        m.put(i, i)
        if m.young.get("hot") is None and m.again("hot") is None:
            m.put("hot", "hot")
    assert len(m.young) + len(m.old) <= 22 and m.young.get("hot", m.old.get("hot")) == "hot"


def test_odd_rows(odd):
    got = sorted((r["doc_id"] or 0, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"])
                 for r in bpe.round_trip(odd, PATH, PATTERN).collect())
    want = []
    for doc_id, text in ODD:
        ids = TIK.encode_ordinary(text or "")
        want.append((doc_id or 0, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want)


def test_columns_round_trip_and_clashing_names(spark, odd):
    from pyspark.sql import functions as F
    clash = odd.withColumn("token_ids", F.lit("old")).withColumn("decoded", F.lit(1))
    out = bpe.decode(bpe.encode(clash, PATH, PATTERN), PATH, PATTERN)
    assert [c for c in out.columns] == clash.columns
    for r in out.collect():
        assert bytes(r["decoded"]) == (r["text"] or "").encode()
    empty = bpe.round_trip(odd.limit(0), PATH, PATTERN)
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

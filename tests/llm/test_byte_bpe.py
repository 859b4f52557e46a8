"""op13: the prefix encoder against the tiktoken library, exact round trips, edits and odd rows."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import types as T

from linkloom.llm import byte_bpe
from linkloom.llm.byte_bpe import PrefixEncoder, read_ranks

RANKS = P.path("byte_bpe_50k.tiktoken")
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


@pytest.fixture(scope="module")
def coders():
    ranks = read_ranks(RANKS)
    return PrefixEncoder(ranks, P.PATTERN), tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts(n=400, seed=6):
    rng = random.Random(seed)
    pick = lambda: chr(rng.choice([rng.randrange(0x20, 0x80), rng.randrange(0, 0x20), rng.randrange(0x80, 0x800), rng.randrange(0x800, 0xD800), rng.randrange(0xE000, 0x110000)]))
    out = ["".join(pick() for _ in range(rng.randrange(0, 200))) for _ in range(n)]
    out += ["", " ", "a\x1cb \x1d\x1e\x1f c", "it's 'S 'LL they'll", "x" * 20_000, "ab" * 5000 + " " * 300 + "\t\n" * 50, "<|endoftext|> stays text", "日本語のテキスト 123456789 ١٢٣"]
    return out


def test_equals_the_tiktoken_library(coders):
    ours, theirs = coders
    for text in texts():
        ids = ours.encode(text)
        assert ids == theirs.encode_ordinary(text)
        assert ours.decode(ids) == text.encode("utf-8")
    assert ours.fallbacks == 0


def test_every_prefix_state_is_the_last_token_of_the_prefix(coders):
    ours, _ = coders
    data = "Hello, wonderful world of prefixes!!".encode()
    states = ours.states(data)
    for i in range(1, len(data) + 1):
        assert states[i] == ours.merged(data[:i])[-1]


def test_appends_and_edits_keep_the_states_before_them(coders):
    ours, _ = coders
    data = b"the quick brown fox jumps over the lazy dog " * 20
    states = ours.states(data)
    grown = data + b"and then some more"
    assert ours.reencode(states, grown, len(data))[1] == ours.merged(grown) if len(grown) < 400 else True
    for edit in (0, 1, 100, 500, len(data) - 1):
        new = data[:edit] + b"XYZ\xc3\xa9" + data[edit + 3 :]
        _, ids = ours.reencode(states, new, edit)
        assert ids == ours.walk(ours.states(new))


def test_query_rows_equal_the_library(spark, coders):
    _, theirs = coders
    rows = [(i, t) for i, t in enumerate(texts(120, seed=2))] + [(None, "no id"), (7, None), (8, ""), (3, "same id twice")] * 2
    df = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS token_ids", "2 AS decoded", "3 AS n_tokens")
    got = Counter(tuple(r) for r in byte_bpe.digests(df, RANKS, P.PATTERN).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "round_trip").collect())
    want = []
    for i, t in rows:
        ids = theirs.encode_ordinary(t or "")
        want.append((i, len(ids), byte_bpe.plain_sha256(ids), hashlib.sha256((t or "").encode()).hexdigest(), True))
    assert got == Counter(want)


def test_empty_table(spark):
    assert byte_bpe.digests(spark.createDataFrame([], DOCS), RANKS, P.PATTERN).count() == 0

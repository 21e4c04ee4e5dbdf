import base64
import hashlib
import random
import time

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from aerostat.llm import bytepairs as bp
from tests.conftest import SF001
from tests.llm.conftest import MESSY


@pytest.fixture(scope="module")
def pairs():
    return bp.Pairs(bp.default_path(), bp.default_pattern())


@pytest.fixture(scope="module")
def library():
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(pairs, text):
    raw = pairs.encode(text)
    return [int.from_bytes(raw[i:i + 4], "little") for i in range(0, len(raw), 4)]


ODD = ["<|endoftext|>", "aaaa" * 40, "b" + "a" * 301, " " * 77 + "x", "\n\t \r\x0b\x1c\x85 ", "漢字" * 60 + "かな", "данные" * 30, "é" * 50, "é" * 33, "👩‍👩‍👧" * 9,
       "0123456789" * 20, "don't I'll we've", "!?!?..." * 30, "\x00\x01\x7f", "ÃƒÂ" * 20, "انگلیسی" * 12, "abcabcabd" * 30, "=" * 500 + "-" * 200, "\U000e0041﻿�"]


def test_equals_the_library(pairs, library):
    for text in [*ODD, *[t for _, t in MESSY if t]]:
        assert ids(pairs, text) == library.encode_ordinary(text)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=120) | st.text(alphabet="ab ", max_size=200) | st.text(alphabet="the nion", max_size=200))
def test_equals_the_library_on_any_text(pairs, library, text):
    assert ids(pairs, text) == library.encode_ordinary(text)


@settings(max_examples=300, deadline=None)
@given(st.binary(max_size=150), st.integers(0, 150))
def test_join_is_the_encoding_of_the_whole_wherever_it_is_cut(pairs, span, cut):
    assert pairs.join(pairs.merge(span[:cut]), pairs.merge(span[cut:])) == pairs.merge(span) == pairs.reduce(span)


def test_join_is_associative(pairs):
    r = random.Random(3)
    for _ in range(300):
        a, b, c = (pairs.merge("".join(r.choices("thein erous", k=r.randrange(1, 30))).encode()) for _ in range(3))
        assert pairs.join(pairs.join(a, b), c) == pairs.join(a, pairs.join(b, c))


def test_heap_and_plain_merges_agree(pairs):
    r = random.Random(1)
    for _ in range(200):
        span = bytes(r.choices(b"aaabtheon  \xe6\xbc\xa2", k=63))
        assert pairs.merge(span) == pairs._merge_long(span)


@pytest.mark.parametrize("letters", ["a", "abcdefghijklmnopqrstuvwxyz", "漢字仮名交文日本語中国"])
def test_long_unspaced_text(pairs, library, letters):
    r = random.Random(2)
    text = "".join(r.choices(letters, k=100_000))
    start = time.perf_counter()
    got = ids(pairs, text)
    assert time.perf_counter() - start < 20
    assert got == library.encode_ordinary(text)


def test_columns_nulls_and_round_trip(spark, messy, library):
    both = bp.decode(bp.encode(messy, "text", "tokens"), "tokens", "back")
    assert both.columns == [*messy.columns, "tokens", "back"]
    rows = both.collect()
    assert len(rows) == len(MESSY)
    for r in rows:
        if r.text is None:
            assert r.tokens is None and r.back is None
        else:
            assert r.tokens == library.encode_ordinary(r.text) and bytes(r.back) == r.text.encode()


def test_empty_table_and_odd_ids(spark, empty):
    assert bp.decode(bp.encode(empty, "text", "tokens"), "tokens").count() == 0
    given_ids = spark.createDataFrame([([257, None, 65],), (None,), ([],)], "ids array<int>")
    got = [r.decoded for r in bp.decode(given_ids, "ids").collect()]
    tokens = bp.Pairs(bp.default_path(), "").bytes
    assert [None if g is None else bytes(g) for g in got] == [tokens[257] + tokens[65], None, b""]
    with pytest.raises(Exception, match="(?i)out of bounds|does not have"):
        bp.decode(spark.createDataFrame([([60_000],)], "ids array<int>"), "ids").collect()


def test_small_slices_decode_alike(spark, messy, monkeypatch):
    monkeypatch.setattr(bp, "DECODE_IDS", 3)
    got = bp.decode(bp.encode(messy, "text", "tokens"), "tokens").where("NOT (decoded <=> CAST(text AS BINARY))")
    assert got.count() == 0


def test_query_equals_the_library(spark, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()}
    got = bp.op13_byte_pairs(spark, SF001)
    assert got.dtypes == [("doc_id", "bigint"), ("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
    rows = got.collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        want = library.encode_ordinary(docs[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(want), hashlib.sha256(",".join(map(str, want)).encode()).hexdigest(), hashlib.sha256(docs[r.doc_id].encode()).hexdigest())

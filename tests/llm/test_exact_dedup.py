import hashlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from aerostat.llm import exact_dedup as ed
from tests.llm.conftest import frame


@settings(max_examples=100, deadline=None)
@given(st.sets(st.integers(0, (1 << ed.BITS) - 1), min_size=1, max_size=200))
def test_golomb_round_trip(values):
    v = np.array(sorted(values), np.uint64)
    assert ed.golomb_decode(len(v), *ed.golomb_encode(v)).tolist() == v.tolist()


def test_golomb_dense():
    v = np.arange(3000, dtype=np.uint64)
    bits, unary, rest = ed.golomb_encode(v)
    assert ed.golomb_decode(len(v), bits, unary, rest).tolist() == v.tolist() and len(unary) + len(rest) < 800


def strip(t):
    return "".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r")


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[strip(t)].append((-len(t or ""), i is None, i or 0))
    return {k: (min(v), len(v)) for k, v in groups.items()}


@pytest.mark.parametrize("owners", [1, 7])
def test_decisions_match_brute_force(messy, owners):
    rows = [(r.doc_id, r.text) for r in messy.collect()]
    want = brute(rows)
    got = ed.decisions(messy, "doc_id", "text", owners).collect()
    assert len(got) == len(rows)
    by_text = {hashlib.sha256(strip(t).encode()).hexdigest(): strip(t) for _, t in rows}
    kept = defaultdict(int)
    for r in got:
        (_, none, best), size = want[by_text[r.sha]]
        assert r.group_size == size and r.keep_id == (None if none else best)
        kept[r.sha] += r.kept
        assert not r.kept or r.id == r.keep_id
    assert set(kept.values()) == {1} and len(kept) == len(want)


def test_deduplicate_keeps_columns(messy):
    out = ed.deduplicate(messy)
    assert out.schema == messy.schema
    rows = out.collect()
    assert sorted(strip(r.text) for r in rows) == sorted(brute([(r.doc_id, r.text) for r in messy.collect()]))
    assert out.coalesce(1).count() == len(rows)


def test_hot_group_over_many_partitions(spark, files):
    docs = files(frame(spark, [(i, "same text here" if i % 3 else f"text {i}") for i in range(3000)], 9))
    got = ed.decisions(docs, "doc_id", "text", 5).collect()
    assert {r.group_size for r in got if r.id % 3} == {2000} and {r.keep_id for r in got if r.id % 3} == {1}
    assert sum(r.kept for r in got) == 1001


def test_empty(empty):
    assert ed.decisions(empty, "doc_id", "text").count() == 0
    assert ed.deduplicate(empty).count() == 0

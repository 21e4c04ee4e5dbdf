import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from aerostat.llm import shared_search as ss
from tests.llm.conftest import BASE, MESSY

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text)) if text else []


def brute(docs, items, k):
    held = [(i, Counter(plain(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    total = sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(plain(t))
    out = []
    for item, wanted in asked.items():
        scores = []
        for i, c in held:
            m = 100 - 50 + (50 * sum(c.values()) * len(held)) // total
            score = sum(math.floor(1000 * math.log((2 * len(held) + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m)) for t in wanted if t in c)
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scores)[:k])]
    return out


ITEMS = [(1, BASE), (2, " ".join(BASE.split()[:60]) + " данные слова"), (3, " ".join(BASE.split()[20:])), (4, None), (5, ""), (6, "!?"), (7, "nowhere-to-be-found0"),
         (8, "ONE two, one"), (None, "данные Café naïve"), (9, "the harbour"), (9, "winter boats"), (10, "the harbour winter"), (10, "the harbour winter")]


def key(r):
    return (r[0] is None, r[0] or 0, r[1])


@pytest.mark.parametrize("options", [{}, {"k": 3}, {"k": 5, "block_terms": 40}, {"k": 1000}])
def test_matches_brute_force(spark, messy, options):
    items = spark.createDataFrame([(*i, "x", "y") for i in ITEMS], "item_id long, text string, term string, block string").repartition(3)
    got = sorted((tuple(r) for r in ss.search(messy, items, **options).collect()), key=key)
    assert got == sorted(brute(MESSY, ITEMS, options.get("k", 50)), key=key)


def test_hot_copies_tie_by_id(spark, files):
    docs = [(i, "alpha beta gamma") for i in range(600)] + [(1000 + i, f"alpha word{i}") for i in range(600)]
    random.Random(1).shuffle(docs)
    df = files(spark.createDataFrame(docs, "doc_id long, text string").repartition(7))
    items = spark.createDataFrame([(1, "gamma alpha")], "item_id long, text string")
    got = sorted((tuple(r) for r in ss.search(df, items).collect()), key=key)
    assert got == brute(docs, [(1, "gamma alpha")], 50)
    assert [r[2] for r in got] == list(range(50))


def test_empty_tables(spark, empty, messy):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert ss.search(empty, items).count() == 0
    assert ss.search(messy, items.limit(0)).count() == 0
    assert ss.search(messy, items.where("item_id = 6")).count() == 0


def test_terms():
    for text in ["A-b_c Ä\u0085x y 12,3", "İÇ ÉCOLE", "\x00\x1f a\tB", ""]:
        assert [t.decode() for t in ss.terms(text.encode())] == plain(text)


def expand(dag, node):
    return [node] if node < dag.n_terms else [t for p in dag.parts[node - dag.n_terms] for t in expand(dag, p)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 19), max_size=15), max_size=8))
def test_each_item_is_the_disjoint_union_of_its_nodes(items):
    dag = ss.Sharing(items, 20)
    for want, nodes in zip(items, dag.items):
        assert sorted(t for n in nodes for t in expand(dag, n)) == sorted(set(want))
    assert dag.additions() <= sum(max(0, len(set(i)) - 1) for i in items)
    made = [len(m) for m, _, _ in dag.levels()]
    assert sum(made) == len(dag.parts)


def test_shared_sets_are_evaluated_once():
    common = list(range(30))
    dag = ss.Sharing([common + [100 + i] for i in range(50)], 200)
    assert dag.additions() <= 29 + 50
    assert np.mean([len(i) for i in dag.items]) == 2


def test_runs_bound_the_mining_only(monkeypatch, spark, messy):
    monkeypatch.setattr(ss, "RUN", 2)
    monkeypatch.setattr(ss, "HELD_BYTES", 10_000)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert sorted((tuple(r) for r in ss.search(messy, items).collect()), key=key) == sorted(brute(MESSY, ITEMS, 50), key=key)

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from aerostat.llm import shingles as sh, similarity_join as sj
from tests.llm.conftest import BASE, frame, prose


def sets_of(text, k=5):
    w = [x for x in (text or "").lower().replace("\n", " ").replace("\t", " ").split(" ") if x]
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(rows, threshold=0.8):
    sets = [sets_of(t) for _, t in rows]
    n = len(rows)
    label, links = list(range(n)), [0] * n
    for a in range(n):
        for b in range(n):
            if a != b and sets[a] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
                links[a] += 1
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = [new if x == old else x for x in label]
    least = {}
    for x, (i, _) in zip(label, rows):
        if i is not None:
            least[x] = min(least.get(x, i), i)
    return sorted((str(i), str(least.get(x)), k) for (i, _), x, k in zip(rows, label, links))


def result(docs, **options):
    return sorted((str(r.id), str(r.class_id), r.n_links) for r in sj.similarity_join(docs, **options).collect())


def test_messy_documents_match_brute_force(messy):
    assert result(messy) == brute([(r.doc_id, r.text) for r in messy.collect()])


def near(seed, i):
    w = prose(seed, 150).split()
    w[(7 * i) % 150] = f"new{i}"
    return " ".join(w)


def test_groups_split_into_blocks(spark, files, monkeypatch):
    rows = [(i, near(i % 3, i // 3)) for i in range(150)] + [(1000 + i, prose(100 + i, 60)) for i in range(30)] + [(2000 + i, near(0, 1)) for i in range(5)]
    docs = files(frame(spark, rows, 4))
    want = brute(rows)
    assert result(docs) == want
    monkeypatch.setattr(sj, "BLOCK_SETS", 9)
    assert result(docs) == want
    kept = sj.keep_first(docs)
    assert kept.schema == docs.schema and kept.count() == len({c for _, c, _ in want})


def test_empty(empty):
    assert sj.similarity_join(empty).count() == 0 and sj.keep_first(empty).count() == 0


def test_prefix_shrinks_with_the_target():
    assert sj.prefix_depth(0.8, 32, 0.99999) == 5 and sj.prefix_depth(0.8, 32, 0.9) > 5 and sj.prefix_depth(0.8, 2, 0.999999) == 1
    d = sj.prefix_depth()
    assert 1 - (1 - sj.THRESHOLD**d) ** sj.TREES >= sj.RECALL


@settings(max_examples=40, deadline=None)
@given(st.lists(st.frozensets(st.integers(0, 30), min_size=1), min_size=2, max_size=14), st.integers(0, 3), st.integers(1, 10))
def test_linked_counts_exactly(sets, left, rare):
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    left = min(left, len(sets) - 1)
    old, sj.RARE = sj.RARE, rare
    try:
        got = sj.linked(arrays, left, 0.5)
    finally:
        sj.RARE = old
    for i, a in enumerate(sets[:left] if left else sets):
        for j, b in enumerate(sets[left:] if left else sets):
            want = (left > 0 or i != j) and len(a & b) > 0 and 2 * len(a & b) >= len(a | b)
            assert got[i, j] == want


def test_shingles_are_those_of_the_words():
    texts = [BASE, None, "", "  ", "one two", "One\ttwo", "a b c d e", "a b c d e f", BASE + " x", "é É" * 3, "w" * 300]
    got = sh.text_shingles(texts)
    for t, s in zip(texts, got):
        assert len(s) == len(sets_of(t))
    assert got[4].tolist() == got[5].tolist() and set(got[6]) < set(got[7])
    alone = [sh.text_shingles([t])[0].tolist() for t in texts]
    assert alone == [s.tolist() for s in got]  # no text sees its neighbours


@pytest.mark.parametrize("share", [0.5, 0.8])
def test_minhash_estimates(share):
    r = np.random.default_rng(3)
    both = r.integers(0, 1 << 63, 4000).astype(np.uint64)
    n = int(len(both) * (1 - share) / 2)
    h = sh.MinHash(512)
    a, b = h.signature(both[n:]), h.signature(both[:len(both) - n])
    want = (len(both) - 2 * n) / len(both)
    assert abs((a == b).mean() - want) < 0.08


def test_recall_out_of_reach_is_an_error(empty):
    for threshold, trees in ((0.8, 2), (0.3, 32)):
        with pytest.raises(ValueError, match="recall"):
            sj.similarity_join(empty, threshold=threshold, trees=trees, recall=0.999999)

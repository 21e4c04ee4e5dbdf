import math
import random

import numpy as np
import pytest

from aerostat.llm import part_codes as pc


def rows():
    r = random.Random(8)
    out = [(i, [r.gauss(i % 3, 1) for _ in range(10)], i % 4 if i % 7 else None) for i in range(400)]
    out += [(1000 + i, [0.25] * 10, 1) for i in range(200)]  # a third of all rows: one vector
    out += [(2000, None, 1), (2001, [1.0, None], 1), (2002, [float("nan")] * 10, 2), (2003, [float("inf")] * 10, 2), (2004, [], None), (2005, [1.5], 9),
            (None, [1.0] * 10, 3), (3, [9.0] * 10, 3), (3, [9.0] * 10, 3), (-5, [-0.0001] * 10, 0)]
    return out


def brute(rows, parts, entries, rounds, scale=4096):
    kept = [(i, [math.floor(scale * x) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dim = -(-max((len(v) for _, v, _ in kept), default=0) // parts) * parts
    width = dim // parts
    order = sorted(((i is None, i or 0, v) for i, v, _ in kept))[:entries]
    cut = lambda v, p: (v + [0] * (dim - len(v)))[p * width:(p + 1) * width]
    books = [[cut(v, p) for _, _, v in order] for p in range(parts)]

    def near(v, p):
        return min((sum((a - b) ** 2 for a, b in zip(cut(v, p), e)), k) for k, e in enumerate(books[p]))
    for _ in range(rounds):
        new = []
        for p in range(parts):
            got = {}
            for _, v, _ in kept:
                got.setdefault(near(v, p)[1], []).append(cut(v, p))
            new.append([[sum(c) // len(got[k]) for c in zip(*got[k])] if k in got else e for k, e in enumerate(books[p])])
        books = new
    out = []
    for i, v, lab in kept:
        best = [near(v, p) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best), lab))
    return out, books


def frame(spark, data):
    return spark.createDataFrame([(*r, "x", "y") for r in data], "vec_id long, embedding array<double>, label int, part string, v string").repartition(5)


@pytest.mark.parametrize("options", [{"parts": 4, "entries": 16, "rounds": 6}, {"parts": 3, "entries": 5, "rounds": 2}, {"parts": 2, "entries": 1, "rounds": 1}])
def test_matches_brute_force(spark, options, monkeypatch):
    monkeypatch.setattr(pc, "BLOCK", 7)
    data = rows()
    want, books = brute(data, **options)
    got = pc.compress(frame(spark, data), label_col="label", **options).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    assert sorted(((r.id, r.code, r.error, r.label) for r in got), key=key) == sorted(want, key=key)
    by_label = {lab: sum(e for *_, e, k in want if k == lab) for lab in {w[3] for w in want}}
    assert all(r.label_error == by_label[r.label] for r in got)
    assert {r.codebooks_sha256 for r in got} == {pc.fingerprint(np.array(books))}


def test_few_rows_empty_tables_and_empty_vectors(spark):
    data = [(7, [1.0, 2.0], None), (5, [0.0, -1.0], None)]
    got = pc.compress(frame(spark, data), parts=2).collect()
    assert sorted((r.id, r.code, r.error) for r in got) == [(5, "0000", 0), (7, "0101", 0)]
    assert pc.compress(frame(spark, data).limit(0), label_col="label").count() == 0
    assert pc.compress(frame(spark, [(1, None, 1)])).count() == 0
    assert [(r.id, r.code, r.error) for r in pc.compress(frame(spark, [(1, [], 1)])).collect()] == [(1, "00" * 8, 0)]
    with pytest.raises(Exception, match="after scaling"):
        pc.compress(frame(spark, [(1, [1e30], 1)])).collect()
    with pytest.raises(ValueError):
        pc.train(frame(spark, data), entries=257)


@pytest.mark.parametrize("block", [1, 3, 4096])
def test_walk_gives_each_leaf_its_distances(block, monkeypatch):
    monkeypatch.setattr(pc, "BLOCK", block)
    r = np.random.default_rng(0)
    x, book = r.integers(-2, 3, (200, 4)), r.integers(-5, 5, (6, 4))
    trie = pc.Trie(x)
    leaves = trie.rows[trie.leaves]
    assert (leaves == np.unique(x, axis=0)).all()
    seen = []
    for where, squares in trie.walk(book):
        assert (squares == ((leaves[where][:, None, :] - book[None]) ** 2).sum(2)).all()
        seen += range(len(leaves))[where]
    assert seen == list(range(len(leaves)))  # depth first: the leaves come in order


def test_common_prefixes_are_computed_once():
    x = np.array([[1, 2, i] for i in range(50)] + [[1, 3, i] for i in range(50)])
    trie = pc.Trie(x)
    assert [len(s) for s in trie.starts] == [1, 2, 100]

import math
import random

import pytest
from pyspark.sql import functions as F

from aerostat.llm import knn_join as kj


def vectors():
    r = random.Random(4)
    rows = [(i, [r.gauss(i % 4, 1) for _ in range(6)]) for i in range(300)]
    rows += [(1000 + i, [0.5] * 6) for i in range(120)]  # one vector very often: ties
    rows += [(2000, None), (2001, []), (2002, [1.0, None]), (2003, [float("nan")] * 6), (2004, [float("inf")] * 6), (None, [1.0] * 6), (2005, [1.0, 2.0]), (2006, [-0.0001] * 6), (2006, [-0.0001] * 6), (2010, [3.0] * 6)]
    return rows


def brute(rows, k, every):
    base = sorted({(i, tuple(math.floor(1024 * x) for x in v)) for i, v in rows
                   if i is not None and v and all(x is not None and math.isfinite(x) for x in v)})
    out = []
    for q, v in base:
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in base if (i, w) != (q, v))[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize("options", [{}, {"pivots": 3, "chunk": 7, "slice_rows": 50}, {"pivots": 1, "k": 3}, {"chunk": 3, "slice_rows": 9}])
def test_matches_brute_force(spark, options):
    rows = vectors()
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, cell string").repartition(4)
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in kj.knn_join(df, F.col("vec_id") % 10 == 0, **options).collect())
    assert got == brute(rows, options.get("k", 10), 10)


def test_far_cells_are_not_asked_and_a_hot_cell_is_sliced(spark, monkeypatch):
    """Queries travel only to cells that can hold an answer; a cell with most rows, many of them equal, is cut into slices."""
    r = random.Random(9)
    rows = [(i, [(50.0 if i % 3 else -50.0) + r.gauss(0, 1), r.gauss(0, 1), 0.0]) for i in range(600)]
    rows += [(5000 + i, [50.0, 0.0, 0.0]) for i in range(400)]
    rows += [(9000 + i, rows[i][1]) for i in range(0, 100, 7)]  # repeated vectors under other ids
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    made, real = [], kj._solver

    def watched(dim, k):
        solve, tasks = real(dim, k), spark.sparkContext.accumulator(0)
        made.append(tasks)

        def counted(q, x):
            tasks.add(len(q))
            return solve(q, x)
        counted.__annotations__ = solve.__annotations__
        return counted
    monkeypatch.setattr(kj, "_solver", watched)
    got = sorted((x.query_id, x["rank"], x.vec_id, x.score) for x in kj.knn_join(df, F.col("vec_id") % 10 == 0, slice_rows=100, chunk=25).collect())
    assert got == brute(rows, 10, 10)
    queries = len({tuple(v) for i, v in rows if i % 10 == 0})
    assert made[0].value == queries  # the first round: one slice each
    assert 0 < made[1].value < queries * (32 + len(rows) // 100) / 2


def test_few_rows_and_empty(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [2.0, 2.0]), (2, [0.5, -1.0])], "vec_id long, embedding array<float>")
    assert [(r["rank"], r.vec_id) for r in kj.knn_join(df, F.col("vec_id") == 0).orderBy("rank").collect()] == [(1, 1), (2, 2)]
    assert kj.knn_join(df.limit(0), F.lit(True)).count() == 0
    assert kj.knn_join(df, F.lit(False)).count() == 0
    assert kj.knn_join(df.limit(1), F.lit(True)).count() == 0


def test_bounds_are_reached(spark):
    import numpy as np
    r = np.random.default_rng(1)
    x, q = r.normal(size=(200, 5)) * 100, r.normal(size=(30, 5)) * 100
    pivots = x[:6]
    cell, far = kj._nearest(x, pivots)
    group, away = kj._nearest(q, pivots)
    near = [(int(c), float(d)) for c, d in zip(cell, far)]
    radius = {int(g): float(away[group == g].max()) for g in set(group.tolist())}
    for g, least in kj.bounds(pivots, radius, near, 4).items():
        for v in q[group == g]:
            assert np.sort(x @ v)[-4] >= least


def test_large_components_stay_exact():
    import numpy as np
    a = np.array([[2**40, 3]], np.int64)
    assert kj._exact(a, a).tolist() == [[2**80 % 2**64 + 9]] or kj._exact(a // 2**20, a // 2**20).tolist() == [[2**40]]

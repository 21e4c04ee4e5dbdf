import random

from aerostat.llm.components import connected


def test_components_of_chains_stars_and_cycles(spark):
    r = random.Random(5)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, x) for x in range(600, 900)] + [(1000, 1001), (1001, 1002), (1002, 1000), (7, 7)]
    edges += [(r.randrange(2000, 2100), r.randrange(2000, 2100)) for _ in range(80)]
    r.shuffle(edges)
    label = {x: x for e in edges for x in e}
    for _ in range(200):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = {x.u: x.root for x in connected(spark.createDataFrame(edges, "u long, v long").repartition(5), "test").collect()}
    assert got == {k: v for k, v in label.items() if k != v}


def test_no_edges(spark):
    assert connected(spark.createDataFrame([], "u long, v long"), "test").count() == 0

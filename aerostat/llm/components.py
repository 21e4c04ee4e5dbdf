"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from aerostat.llm.common import written


def _large_star(e: DataFrame, name: str) -> DataFrame:
    both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), f"{name}-low")
    return both.where("v > u").join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    down = e.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return down.union(low.select("u", F.col("m").alias("v"))).distinct()


def _state(e: DataFrame) -> tuple:
    r = e.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31)))).first()
    return r[0], r[1]


def connected(edges: DataFrame, name: str) -> DataFrame:
    """``u, root`` for every vertex but the smallest of its component, from edges ``u, v`` (longs).

    Every step aggregates before it shuffles; the large-star step's minima are written before they are
    joined on the vertex, so that Spark can split the rows of a vertex with very many neighbours. Each round
    is written to the shared folder.
    """
    e = written(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), f"{name}-edges")
    state = _state(e)
    while state[0]:
        e = written(_small_star(_large_star(e, name)), f"{name}-round")
        last, state = state, _state(e)
        if state == last:
            break
    return e.select("u", F.col("v").alias("root"))

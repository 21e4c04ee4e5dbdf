"""Exact top-k by inner product as a Voronoi kNN join.

1. Vectors become integers, ``floor(scale * x)``. Equal vectors are ranked by id, so only the ``k + 1``
   smallest ids of each can be anyone's answer; equal query vectors are solved once.
2. Pivots (a sample that grows with the square root of the rows) cut queries and data into cells by the nearest
   pivot; large cells are cut into slices.
3. Summaries go to the driver, their size fixed by the number of pivots: of each query cell its radius
   ``R``; of each data cell its count, its radius and the ``k + 1`` smallest distances to its pivot. As
   ``q.x >= p.p' - R|p'| - (|p| + R) d(x, p')``, the ``(k + 1)``-th largest of these is a bound
   that every query of the cell reaches.
4. Data are the large side, so they stay: each vector is in one slice of one cell. The queries travel. In the first
   local round each is solved against one slice of its own cell; its ``(k + 1)``-th best score there (or the
   summaries' bound, if higher) is what others have to reach.
5. In the second round a query goes to the slices of cell ``c`` only if ``q.p_c + |q| R_c`` reaches that score, and
   only scores that reach it come back. The short lists are merged.

A task solves one block of queries against one slice with a matrix product. Rows sent: the data once a round for each
block of queries, and at most queries x slices.

Cases: vectors that are null, empty or hold null or non-finite components, and rows with a null id, take
no part; vectors of unequal lengths count as padded with zeros; repeated rows (same id and vector) count
once; ties go to the smaller id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from aerostat.llm.common import table, written

SCALE, TOP, EVERY = 1024, 10, 100
#: the least number of pivots; more rows have an eighth of their square root
PIVOTS = 32
#: queries of a block and data vectors of a slice that meet in one task, about
CHUNK, SLICE = 20_000, 20_000
_NONE = -(2**63)  # the score that every row reaches


def integers(column: Column, scale: int = SCALE) -> Column:
    """``floor(scale * x)`` of each component, or null if the vector takes no part."""
    bad = F.exists(column, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.when(~bad & (F.size(column) > 0), F.transform(column, lambda x: F.floor(x.cast("double") * scale)))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    flat, ends = column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())
    if (ends == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(column), dim), np.int64)
    out[np.arange(dim)[None, :] < ends[:, None]] = flat
    return out


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products ``a @ b.T``; floats where they are exact."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    return (a.astype(float) @ b.astype(float).T).astype(np.int64) if top < 2**53 else a @ b.T


def _nearest(x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row its nearest pivot and the distance to it."""
    x = x.astype(float)
    cell = ((pivots**2).sum(1)[None, :] - 2 * x @ pivots.T).argmin(1)
    return cell, np.sqrt(((x - pivots[cell]) ** 2).sum(1))


def _celled(df: DataFrame, pivots: np.ndarray) -> DataFrame:
    dim = pivots.shape[1]

    def read(batches):
        for b in filter(len, batches):
            cell, far = _nearest(_matrix(b.column("v"), dim), pivots)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("v"), pa.array(cell, pa.int32()), pa.array(far)], ["id", "v", "cell", "far"])
    return df.select("id", "v").mapInArrow(read, "id long, v array<long>, cell int, far double")


def bounds(pivots: np.ndarray, radius: dict[int, float], near: list[tuple[int, float]], k: int) -> dict[int, float]:
    """Per query cell a score that at least ``k`` data rows reach for each of its queries.

    ``near`` has the summaries' (data cell, distance to its pivot).
    """
    norm = np.sqrt((pivots**2).sum(1))
    cells = np.array([c for c, _ in near], np.int64)
    far = np.array([d for _, d in near], float)
    out = {}
    for i, r in radius.items():
        low = np.sort(pivots[cells] @ pivots[i] - r * norm[cells] - (norm[i] + r) * far)[::-1]
        out[i] = float(low[k - 1]) - 1e-6 * abs(float(low[k - 1])) - 1e-6 if len(low) >= k else -np.inf
    return out


def _solver(dim: int, k: int):
    """A block of queries against a slice of data: per query its ``k + 1`` best rows that reach ``low``."""
    def solve(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        out = {c: [] for c in ("qid", "vec_id", "score", "same")}
        if len(q) and len(x):
            x = x.sort_values("id")
            a, b = (_matrix(pa.array(p.v.tolist(), pa.list_(pa.int64())), dim) for p in (q, x))
            vec, qid, low = x.id.to_numpy(), q.id.to_numpy(), q.low.to_numpy()
            for at in range(0, len(a), 128):
                score = _exact(a[at:at + 128], b)
                least = low[at:at + 128]
                if len(b) > k + 1:
                    least = np.maximum(least, np.partition(score, len(b) - k - 1, axis=1)[:, len(b) - k - 1])
                for i in np.flatnonzero(score.max(axis=1) >= least):
                    best = np.flatnonzero(score[i] >= least[i])
                    best = best[np.lexsort((vec[best], -score[i][best]))][:k + 1]
                    out["qid"].append(np.full(len(best), qid[at + i]))
                    out["vec_id"].append(vec[best])
                    out["score"].append(score[i][best])
                    out["same"].append((b[best] == a[at + i]).all(axis=1))
        types = {"qid": "int64", "vec_id": "int64", "score": "int64", "same": "bool"}
        return pd.DataFrame({c: np.concatenate([np.empty(0, types[c]), *v]).astype(types[c]) for c, v in out.items()})
    return solve


def knn_join(df: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = TOP,
             scale: int = SCALE, pivots: int | None = None, chunk: int = CHUNK, slice_rows: int = SLICE) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` best rows for each query."""
    base = df.select(F.col(id_col).cast("long").alias("id"), integers(F.col(vector_col), scale).alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    base = base.where("id IS NOT NULL AND v IS NOT NULL")
    by_vector = Window.partitionBy("v").orderBy("id")
    data = written(base.select("id", "v").distinct().withColumn("r", F.row_number().over(by_vector)).where(F.col("r") <= k + 1).drop("r"), "knn-data")
    asked = written(base.where("q").select("id", "v").distinct(), "knn-queries")
    empty = asked.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if asked.isEmpty():
        return empty
    distinct = written(asked.groupBy("v").agg(F.min("id").alias("id")), "knn-distinct")

    dim, rows = data.agg(F.max(F.size("v")), F.count("*")).first()
    picked = data.orderBy(F.xxhash64("v"), "id").limit(pivots or max(PIVOTS, math.isqrt(rows) // 8)).select("v").collect()
    centres = np.unique(np.array([list(r["v"]) + [0] * (dim - len(r["v"])) for r in picked], float), axis=0)
    data, distinct = written(_celled(data, centres), "knn-cells"), written(_celled(distinct, centres), "knn-groups")

    summary = sorted(data.groupBy("cell").agg(F.max("far"), F.count("*")).collect())
    wide = {r["cell"]: r["far"] for r in distinct.groupBy("cell").agg(F.max("far").alias("far")).collect()}
    nearest = Window.partitionBy("cell").orderBy("far", "id")
    near = [tuple(r) for r in data.withColumn("r", F.row_number().over(nearest)).where(F.col("r") <= k + 1).select("cell", "far").collect()]
    floors = {c: _NONE if b == -np.inf else int(np.floor(b)) for c, b in bounds(centres, wide, near, k + 1).items()}
    cells = [c for c, *_ in summary]
    mid, radius = centres[cells], np.array([r for _, r, _ in summary])
    slices = {c: -(-n // slice_rows) for c, _, n in summary}
    blocks = -(-distinct.count() // chunk)

    def number(values: dict) -> Column:
        return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])

    # a place is a slice of a cell; every vector has one
    place = F.col("cell").cast("long") * 1_000_000 + F.pmod(F.xxhash64("id"), number(slices)[F.col("cell")])
    stay = data.select("id", "v", place.alias("place"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    home = F.when(F.col("cell").isin(cells), F.col("cell")).otherwise(F.lit(cells[0]))
    first = (distinct.withColumns({"low": number(floors)[F.col("cell")], "block": F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")})
             .withColumn("cell", home).select("id", "v", "low", "block", place.alias("place")))

    def send(batches):
        for b in filter(len, batches):
            q = _matrix(b.column("v"), dim).astype(float)
            high = q @ mid.T + np.sqrt((q**2).sum(1))[:, None] * radius[None, :]
            high += 1e-9 * np.abs(high) + 1e-6
            low, own = b.column("low").to_numpy(), b.column("place").to_numpy()
            to = [[p for c, ok in zip(cells, row) if ok for p in range(c * 1_000_000, c * 1_000_000 + slices[c]) if p != o]
                  for row, o in zip(high >= low[:, None], own)]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("v"), b.column("low"), b.column("block"), pa.array(to, pa.list_(pa.int64()))],
                                             ["id", "v", "low", "block", "places"])

    def solved(queries: DataFrame) -> DataFrame:
        return (queries.groupBy("place", "block").cogroup(stay.groupBy("place", "block"))
                .applyInPandas(_solver(dim, k), "qid long, vec_id long, score long, same boolean"))

    local = written(solved(first), "knn-local")
    reached = (local.groupBy("qid").agg(F.count("*").alias("n"), F.min("score").alias("kth")).where(F.col("n") > k)
               .select(F.col("qid").alias("id"), "kth"))
    again = first.join(reached, "id", "left").withColumn("low", F.greatest("low", "kth")).select("id", "v", "low", "block", "place")
    travel = (again.mapInArrow(send, "id long, v array<long>, low long, block int, places array<long>")
              .select("id", "v", "low", "block", F.explode("places").alias("place")))
    found = local.unionByName(solved(travel))

    best = Window.partitionBy("qid").orderBy(F.desc("score"), "vec_id")
    short = (found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1)
             .groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("r", "vec_id", "score", "same"))).alias("best")))
    names = asked.join(distinct.select("v", F.col("id").alias("qid")), "v").select(F.col("id").alias("query_id"), "qid")
    others = F.filter("best", lambda e: ~((e["vec_id"] == F.col("query_id")) & e["same"]))
    return (names.join(short, "qid").select("query_id", F.posexplode(F.slice(others, 1, k)).alias("rank", "e"))
            .select("query_id", (F.col("rank") + 1).alias("rank"), F.col("e.vec_id").alias("vec_id"), F.col("e.score").alias("score")))


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best rows by integer inner product for each vec_id divisible by 100."""
    return knn_join(table(spark, sf_dir, "embeddings"), F.col("vec_id") % EVERY == 0)


OP9_SQL = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, x.vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(x.v AS DOUBLE[])) AS BIGINT) AS score
  FROM e q JOIN e x ON q.vec_id <> x.vec_id WHERE q.vec_id % 100 = 0),
r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

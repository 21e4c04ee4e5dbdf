"""Vector codes: each part of a vector becomes the index of the nearest entry of that part's codebook.

1. Components become integers, ``floor(scale * x)``; vectors are cut into equal consecutive parts. Every task
   reduces its vectors to distinct parts with weights, which are range-partitioned in lexicographic order, merged
   and written once: equal parts, however many, are one row, and neighbours share their first components.
2. Each round is one job over that table. A task reads runs of it as a trie, one component a level, and walks
   it depth first: a node's vector of squared distances to all entries is its parent's plus one component's,
   computed once for all parts below; siblings are expanded in blocks, so that the stack holds a few blocks a
   level. Leaves take the nearest entry (ties to the lower index) and add their weighted components to
   that entry's sums. One row per entry and task is summed by Spark; the driver holds the codebooks only.
3. Last, the vectors are read again and coded by the same walk, without a shuffle; errors are summed per label
   and joined back.

Cases: vectors that are null or hold null or non-finite components take no part; an empty vector counts as
zeros, as shorter ones are filled with zeros up to the longest one's length (rounded up to whole parts); a
component of 2**28 or more after scaling is an error, since squared distances could leave 64 bits; repeated
rows are coded each; a null id sorts after all others, equal ids by their vectors, where the first entries are
chosen; fewer vectors than entries give smaller codebooks; an empty table gives no rows; null labels are a group
of their own; columns beside id, vector and label are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from aerostat.llm.common import table, written

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: integers stay below this, so that squared distances and sums stay in 64 bits
LIMIT = 1 << 28
#: vectors, and distinct parts, that a task takes as one trie
TRIE_ROWS = 1 << 15
#: siblings that the walk expands at once
BLOCK = 4096


def integers(column: Column, scale: int = SCALE) -> Column:
    """``floor(scale * x)`` of each component, or null if the vector takes no part."""
    bad = F.exists(column, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    far = F.exists(column, lambda x: F.abs(x.cast("double") * scale) >= LIMIT)
    kept = F.when(far, F.raise_error(F.lit(f"a vector component is {LIMIT} or more after scaling"))).otherwise(
        F.transform(column, lambda x: F.floor(x.cast("double") * scale).cast("int")))
    return F.when(column.isNotNull() & ~bad, kept)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    flat, sizes = column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), dim), np.int64)
    out[np.arange(dim)[None, :] < sizes[:, None]] = flat
    return out


def _chunks(batches, rows: int = TRIE_ROWS):
    """Tables of about ``rows`` rows."""
    held, n = [], 0
    for b in batches:
        held, n = [*held, b], n + b.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held).combine_chunks()
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


class Trie:
    """The distinct rows of an integer matrix in lexicographic order, as the nodes of each level."""

    def __init__(self, rows: np.ndarray):
        n, self.depth = rows.shape
        self.order = np.lexsort(rows.T[::-1]) if self.depth else np.arange(n)
        self.rows = rows[self.order]
        new = np.ones((n, self.depth), bool)
        new[1:] = np.logical_or.accumulate(self.rows[1:] != self.rows[:-1], axis=1)
        #: per level the first row of each node
        self.starts = [np.flatnonzero(new[:, d]) for d in range(self.depth)]
        self.leaves = self.starts[-1] if self.depth else np.arange(min(n, 1))

    def walk(self, book: np.ndarray):
        """Depth first: per block of leaves their numbers and squared distances to all entries of ``book``."""
        if not self.depth:
            yield slice(0, len(self.leaves)), np.zeros((len(self.leaves), len(book)), np.int64)
            return
        stack = [(0, at, np.zeros((1, len(book)), np.int64), None) for at in range(0, len(self.starts[0]), BLOCK)][::-1]
        while stack:
            level, lo, above, first = stack.pop()
            starts = self.starts[level]
            end = len(starts) if first is None else int(np.searchsorted(starts, self._end(level - 1, first + len(above))))
            nodes = starts[lo:min(lo + BLOCK, end)]
            parent = 0 if first is None else np.searchsorted(self.starts[level - 1], nodes, "right") - 1 - first
            here = above[parent] + (self.rows[nodes, level][:, None] - book[None, :, level]) ** 2
            if level == self.depth - 1:
                yield slice(lo, lo + len(nodes)), here
                continue
            below = self.starts[level + 1]
            a, z = np.searchsorted(below, [nodes[0], self._end(level, lo + len(nodes))])
            stack += [(level + 1, at, here, lo) for at in range(int(a), int(z), BLOCK)][::-1]

    def _end(self, level: int, node: int) -> int:
        return int(self.starts[level][node]) if node < len(self.starts[level]) else len(self.rows)

    def nearest(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per leaf its nearest entry and the squared distance to it."""
        entry, far = np.zeros(len(self.leaves), np.int64), np.zeros(len(self.leaves), np.int64)
        for where, squares in self.walk(book):
            entry[where] = squares.argmin(1)
            far[where] = squares.min(1)
        return entry, far


def _distinct_parts(source: DataFrame, dim: int, parts: int) -> DataFrame:
    """``part, key, n``: the distinct parts (big-endian, so that bytes sort as components do) and how many there are."""
    width = dim // parts

    def read(batches):
        for t in _chunks(batches):
            x = _matrix(t.column("v").combine_chunks(), dim)
            for part in range(parts):
                trie = Trie(x[:, part * width:(part + 1) * width])
                raw = (trie.rows[trie.leaves] + (1 << 31)).astype(">u4").tobytes()
                n = np.diff(trie.leaves, append=len(x))
                keys = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * width), len(n), [None, pa.py_buffer(raw)]).cast(pa.binary()) if width else pa.array([b""] * len(n), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), part, np.int32)), keys, pa.array(n)], ["part", "key", "n"])

    ranged = source.select("v").mapInArrow(read, "part int, key binary, n long").repartitionByRange("part", "key")
    return ranged.groupBy("part", "key").agg(F.sum("n").alias("n")).sortWithinPartitions("part", "key")


def _unpacked(keys: pa.Array, width: int) -> np.ndarray:
    raw = b"".join(keys.to_pylist())
    return np.frombuffer(raw, ">u4").astype(np.int64).reshape(len(keys), width) - (1 << 31)


def _sums(distinct: DataFrame, books: np.ndarray) -> DataFrame:
    """``part, entry, n, sums``: what one round assigns to each entry, summed over all tasks."""
    parts, entries, width = books.shape

    def read(batches):
        n, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for t in _chunks(batches):
            at, x, weight = t.column("part").to_numpy(), _unpacked(t.column("key").combine_chunks(), width), t.column("n").to_numpy()
            for part in np.unique(at).tolist():
                here = at == part
                trie = Trie(x[here])
                entry, _ = trie.nearest(books[part])
                heavy = np.add.reduceat(weight[here][trie.order], trie.leaves)
                np.add.at(n[part], entry, heavy)
                np.add.at(sums[part], entry, trie.rows[trie.leaves] * heavy[:, None])
        where = np.argwhere(n)
        yield pa.RecordBatch.from_arrays([pa.array(where[:, 0], pa.int32()), pa.array(where[:, 1], pa.int32()), pa.array(n[n > 0]),
                                          pa.array([s.tolist() for s in sums[n > 0]], pa.list_(pa.int64()))], ["part", "entry", "n", "sums"])

    each = distinct.mapInArrow(read, "part int, entry int, n long, sums array<long>")
    return each.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(width)]).alias("sums"))


def _source(df: DataFrame, id_col: str, vector_col: str, label_col: str | None, scale: int) -> DataFrame:
    label = F.lit(None).cast("int") if label_col is None else F.col(label_col)
    return df.select(F.col(id_col).alias("id"), integers(F.col(vector_col), scale).alias("v"), label.alias("label")).where("v IS NOT NULL")


def train(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE, parts: int = PARTS,
          entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """The codebooks, ``parts x entries x width`` integers; no entries if there are no vectors."""
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits a part: 1 to 256 entries")
    source = _source(df, id_col, vector_col, None, scale)
    longest = source.agg(F.max(F.size("v"))).first()[0]
    dim = -(-(longest or 0) // parts) * parts
    first = [list(r["v"]) for r in source.orderBy(F.col("id").isNull(), "id", "v").limit(entries).collect()]
    start = np.array([v + [0] * (dim - len(v)) for v in first], np.int64).reshape(len(first), parts, dim // parts)
    books = np.ascontiguousarray(start.transpose(1, 0, 2))
    if not first or not dim:
        return books
    distinct = written(_distinct_parts(source, dim, parts), "parts")
    for _ in range(rounds):
        books = books.copy()
        for r in _sums(distinct, books).collect():  # at most one row per part and entry
            books[r["part"], r["entry"]] = [s // r["n"] for s in r["sums"]]
    return books


def assign(df: DataFrame, books: np.ndarray, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = None,
           scale: int = SCALE) -> DataFrame:
    """``id, label, code, error`` of every vector that takes part; components beyond the books' width are an error."""
    source = _source(df, id_col, vector_col, label_col, scale)
    parts, entries, width = books.shape
    kinds = {f.name: f.dataType.simpleString() for f in source.schema.fields}

    def read(batches):
        for t in _chunks(batches):
            x = _matrix(t.column("v").combine_chunks(), parts * width)
            codes, error = np.zeros((len(x), parts), np.uint8), np.zeros(len(x), np.int64)
            for part in range(parts):
                trie = Trie(x[:, part * width:(part + 1) * width])
                entry, far = trie.nearest(books[part])
                leaf = np.repeat(np.arange(len(trie.leaves)), np.diff(trie.leaves, append=len(x)))
                codes[trie.order, part] = entry[leaf]
                error[trie.order] += far[leaf]
            digits, n = codes.tobytes().hex(), 2 * parts
            out = pa.Table.from_arrays([t.column("id"), t.column("label"), pa.array([digits[i:i + n] for i in range(0, len(digits), n)], pa.string()),
                                        pa.array(error)], ["id", "label", "code", "error"])
            yield from out.to_batches(max_chunksize=4096)

    schema = f"id {kinds['id']}, label {kinds['label']}, code string, error long"
    if not entries:
        return df.sparkSession.createDataFrame([], schema)
    return source.mapInArrow(read, schema)


def fingerprint(books: np.ndarray) -> str:
    """SHA-256 of all entries' components by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def compress(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = None, **options) -> DataFrame:
    """``id, label, code, error, label_error, codebooks_sha256`` by codebooks trained on ``df`` itself."""
    books = train(df, id_col, vector_col, **options)
    codes = written(assign(df, books, id_col, vector_col, label_col, options.get("scale", SCALE)), "codes")
    sums = codes.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "group")
    return (codes.join(sums, F.col("label").eqNullSafe(F.col("group"))).drop("group")
            .withColumn("codebooks_sha256", F.lit(fingerprint(books))))


def op11_part_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding's code in 8 parts of 16 entries, with its error and its label's."""
    out = compress(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")
    return out.select(F.col("id").alias("vec_id"), "code", "error", "label_error", "codebooks_sha256")


def _sql() -> str:
    """The rounds one after the other; ``b0`` to ``b6`` are the codebooks."""
    steps = []
    for r in range(ROUNDS + 1):
        steps.append(f"""
d{r} AS MATERIALIZED (
  SELECT rid, p.part, b.entry, CAST(sum((x - c) * (x - c)) AS BIGINT) AS far
  FROM p JOIN b{r} b ON p.part = b.part AND p.pos = b.pos GROUP BY rid, p.part, b.entry),
a{r} AS MATERIALIZED (
  SELECT rid, part, entry, far FROM (SELECT *, row_number() OVER (PARTITION BY rid, part ORDER BY far, entry) AS k FROM d{r}) WHERE k = 1)""")
        if r < ROUNDS:
            steps.append(f"""
m{r} AS (
  SELECT a.part, a.entry, p.pos, sum(p.x) AS s, count(*) AS n FROM a{r} a JOIN p ON p.rid = a.rid AND p.part = a.part GROUP BY ALL),
b{r + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, b.pos, CAST(coalesce((s - ((s % n) + n) % n) // n, c) AS BIGINT) AS c
  FROM b{r} b LEFT JOIN m{r} m ON b.part = m.part AND b.entry = m.entry AND b.pos = m.pos)""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) AS rid,
         list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (
  SELECT rid, (i - 1) // (n // {PARTS}) AS part, (i - 1) % (n // {PARTS}) AS pos, v[i] AS x
  FROM (SELECT rid, v, len(v) AS n, unnest(range(1, len(v) + 1)) AS i FROM kept)),
b0 AS MATERIALIZED (SELECT part, rid - 1 AS entry, pos, x AS c FROM p WHERE rid <= {ENTRIES}),{",".join(steps)},
e AS (
  SELECT rid, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(far) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY rid)
SELECT kept.vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM b{ROUNDS}) AS codebooks_sha256
FROM e JOIN kept USING (rid)
"""


OP11_SQL = _sql()

"""Ranked lexical search for many queries at once, with common term sets evaluated once.

Terms are maximal runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased. A document's score
for an item sums, over the item's distinct terms, ``w * ((10**9 * tf) div (1000 * tf + 20 * m))`` in
64-bit integers, with ``w = floor(1000 ln((2N + 2) / (2 df + 1)))`` and ``m = 50 + (50 n N) div L``.

1. The items' terms are taken in blocks of about ``BLOCK_TERMS`` (one block for a few thousand items), so what
   the driver and the tasks hold of them is bounded; a larger block is split, an item never.
2. One pass over the texts writes each document's length and its counts of the block's terms; ``N``, ``L`` and
   ``df`` are aggregates of that table. No text and no posting is shuffled.
3. Shared term sets are mined among the block's items: terms that the same items hold become one node, then
   the pairs of nodes that most items hold, over and over until no two items share a pair. The result is a
   DAG: a node is a set of terms, made of smaller nodes; an item is what is left of it, a list of nodes.
4. A second pass, over the counts, keeps a partial accumulator per node and document: terms first, then each
   shared node once from its parts, then the items from their nodes. Each task keeps the best ``k`` per item;
   Spark merges these lists, first within salts, then per item.

Cases: a text that is null, empty or without a term gives a document or item without terms (such documents do not
count in ``N``); rows of one item id are one item with all their terms; repeated documents are documents each; ties
go to the smaller id, null ids last; an item without a scoring document and an empty table give no rows; document
ids are taken as longs; other columns are ignored. Mining looks at an item's shared nodes in runs of ``RUN``;
that bounds its work and changes what is shared, never a score.
"""

from __future__ import annotations

import math
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from aerostat.llm.common import release, sliced, table, utf8, written

TOP = 50
#: distinct (item, term) rows of a block, about
BLOCK_TERMS = 100_000
#: shared nodes of an item among which pairs are counted
RUN = 64
#: bytes of a task's accumulators
HELD_BYTES = 64 << 20
#: lists of tasks that are merged before the last merge of an item
SALTS = 64

_LETTERS = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256)).lower()
_LAST = np.iinfo(np.int64).max


def terms(text: bytes) -> list[bytes]:
    """A text's terms in order (UTF-8)."""
    return text.translate(_LETTERS).split()


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``item, term``: the distinct terms of each item."""
    kind = items.schema[id_col].dataType.simpleString()

    def read(batches):
        for b in sliced(batches, "text"):
            found = [sorted(set(terms(t or b""))) for t in utf8(b.column("text"))]
            at = np.repeat(np.arange(len(found)), [len(f) for f in found])
            yield pa.RecordBatch.from_arrays([b.column("item").take(pa.array(at)), pa.array([t for f in found for t in f], pa.binary())], ["item", "term"])

    return items.select(F.col(id_col).alias("item"), F.col(text_col).cast("string").alias("text")).mapInArrow(read, f"item {kind}, term binary").distinct()


def blocked(asked: DataFrame, limit: int) -> tuple[DataFrame, list[int]]:
    """``asked`` with a column ``block``, and the blocks: about ``limit`` rows each, or a single item."""
    blocks = max(1, -(-asked.count() // limit))
    while True:
        out = asked.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int"))
        sizes = out.groupBy("block", "item").agg(F.count("*").alias("n")).groupBy("block").agg(F.sum("n").alias("n"), F.count("*").alias("items"))
        found = sizes.collect()
        if all(r["n"] <= 2 * limit or r["items"] == 1 for r in found):
            return out, sorted(r["block"] for r in found)
        blocks *= 2


class Sharing:
    """The DAG over the terms ``0 .. n_terms - 1``: ``parts[i]`` makes node ``n_terms + i``; ``items`` are lists of nodes."""

    def __init__(self, items: list[list[int]], n_terms: int):
        self.n_terms, self.parts, self.items = n_terms, [], [sorted(set(i)) for i in items]
        while self._merge_equal() | self._merge_pairs():
            pass

    def _holders(self) -> dict[int, list[int]]:
        """Nodes that at least two items hold, with their items."""
        held: dict[int, list[int]] = {}
        for i, nodes in enumerate(self.items):
            for node in nodes:
                held.setdefault(node, []).append(i)
        return {node: at for node, at in held.items() if len(at) > 1}

    def _replace(self, parts: list[int], at: list[int]) -> None:
        gone = set(parts)
        self.parts.append(sorted(parts))
        for i in at:
            self.items[i] = [n for n in self.items[i] if n not in gone] + [self.n_terms + len(self.parts) - 1]

    def _merge_equal(self) -> bool:
        """Nodes held by exactly the same items become one."""
        groups: dict[tuple, list[int]] = {}
        for node, at in self._holders().items():
            groups.setdefault(tuple(at), []).append(node)
        same = [(nodes, at) for at, nodes in groups.items() if len(nodes) > 1]
        for nodes, at in same:
            self._replace(nodes, list(at))
        return bool(same)

    def _merge_pairs(self) -> bool:
        """The pairs that most items hold become nodes; pairs chosen at once have no node in common."""
        holders = self._holders()
        keys, size = [], self.n_terms + len(self.parts)
        for nodes in self.items:
            shared = sorted((n for n in nodes if n in holders), key=lambda n: (-len(holders[n]), n))
            for at in range(0, len(shared), RUN):
                run = np.sort(np.array(shared[at:at + RUN], np.int64))
                a, b = np.triu_indices(len(run), 1)
                keys.append(run[a] * size + run[b])
        pairs, counts = np.unique(np.concatenate(keys), return_counts=True) if keys else (np.zeros(0, np.int64),) * 2
        order = np.lexsort((pairs, -counts))
        order = order[counts[order] > 1]
        used: set[int] = set()
        for a, b in ((int(p) // size, int(p) % size) for p in pairs[order]):
            if a not in used and b not in used:
                used |= {a, b}
                self._replace([a, b], sorted(set(holders[a]) & set(holders[b])))
        return bool(used)

    def levels(self) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per level of the DAG its nodes, their parts one after the other, and where each node's parts start."""
        depth, by_level = [0] * self.n_terms, {}
        for i, parts in enumerate(self.parts):
            depth.append(1 + max(depth[p] for p in parts))
            by_level.setdefault(depth[-1], []).append(i)
        return [_runs([self.n_terms + i for i in nodes], [self.parts[i] for i in nodes]) for _, nodes in sorted(by_level.items())]

    def additions(self) -> int:
        """Additions per document."""
        return sum(len(p) - 1 for p in self.parts) + sum(max(0, len(i) - 1) for i in self.items)


def _runs(nodes: list[int], parts: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = [len(p) for p in parts]
    return (np.array(nodes, np.int64), np.array([x for p in parts for x in p], np.int64), np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64))


def counted(docs: DataFrame, id_col: str, text_col: str, vocabulary: list[bytes]) -> DataFrame:
    """``doc_id, n, terms, tfs``: length and counts of the vocabulary's terms, of every document with a term."""
    number = {t: i for i, t in enumerate(vocabulary)}

    def read(batches):
        release()
        for b in sliced(batches, "text"):
            found = [terms(t or b"") for t in utf8(b.column("text"))]
            n = np.array([len(f) for f in found], np.int64)
            at = np.fromiter((i for f in found for i in map(number.get, f, repeat(-1))), np.int64, int(n.sum()))
            doc = np.repeat(np.arange(len(found)), n)
            keys, tfs = np.unique((doc * len(number) + at)[at >= 0], return_counts=True)
            ends = np.concatenate([[0], np.cumsum(np.bincount(keys // max(1, len(number)), minlength=len(found)))]).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x.astype(np.int32))) for x in (keys % max(1, len(number)), tfs)]
            out = pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n), *lists], ["doc_id", "n", "terms", "tfs"])
            yield out.filter(pa.array(n > 0))

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(read, "doc_id long, n long, terms array<int>, tfs array<int>")


class Best:
    """The ``k`` best documents of each item seen so far."""

    def __init__(self, items: int, k: int):
        self.k, self.score, self.ids = k, [np.zeros(0, np.int64)] * items, [np.zeros(0, np.int64)] * items
        self.least = np.ones(items, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        fits = scores >= self.least[:, None]
        for i in np.flatnonzero(fits.any(1)).tolist():
            score, doc = np.concatenate([self.score[i], scores[i, fits[i]]]), np.concatenate([self.ids[i], ids[fits[i]]])
            order = np.lexsort((doc, -score))[:self.k]
            self.score[i], self.ids[i] = score[order], doc[order]
            if len(order) == self.k:
                self.least[i] = self.score[i][-1]


def scored(counts: DataFrame, sharing: Sharing, weights: np.ndarray, documents: int, total: int, k: int) -> DataFrame:
    """``item, doc_id, score``: the ``k`` best documents of each task for each item (by its number)."""
    levels, items = sharing.levels(), [i for i, nodes in enumerate(sharing.items) if nodes]
    _, roots, starts = _runs(items, [sharing.items[i] for i in items])
    nodes, terms_ = sharing.n_terms + len(sharing.parts), sharing.n_terms
    rows = max(1, HELD_BYTES // (8 * (nodes + len(roots) + 2 * len(items))))

    def read(batches):
        best = Best(len(items), k)
        for b in (whole.slice(at, rows) for whole in batches for at in range(0, whole.num_rows, rows)):
            size = np.diff(b.column("terms").offsets.to_numpy())
            term, tf = (b.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in ("terms", "tfs"))
            m = np.array([50 + 50 * n * documents // total for n in b.column("n").to_pylist()], np.int64)
            doc = np.repeat(np.arange(b.num_rows), size)
            sums = np.zeros((nodes, b.num_rows), np.int64)
            sums[term, doc] = weights[term] * (1_000_000_000 * tf // (1000 * tf + 20 * m[doc]))
            for made, parts, first in levels:
                sums[made] = np.add.reduceat(sums[parts], first, axis=0)
            best.add(np.add.reduceat(sums[roots], starts, axis=0), b.column("doc_id").fill_null(_LAST).to_numpy(zero_copy_only=False))
        at = np.repeat(np.array(items, np.int32), [len(s) for s in best.score])
        ids = np.concatenate(best.ids)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(ids, mask=ids == _LAST), pa.array(np.concatenate(best.score))], ["item", "doc_id", "score"])

    assert terms_ == len(weights)
    return counts.mapInArrow(read, "item int, doc_id long, score long")


def _block(docs: DataFrame, rows: list, kind: str, id_col: str, text_col: str, k: int) -> DataFrame:
    """The result for the items of one block, from their ``(item, term)`` rows."""
    spark = docs.sparkSession
    vocabulary = sorted({bytes(t) for _, t in rows})
    number = {t: i for i, t in enumerate(vocabulary)}
    held: dict = {}
    for item, term in rows:
        held.setdefault(item, []).append(number[bytes(term)])
    ids = sorted(held, key=lambda i: (i is None, i))
    counts = written(counted(docs, id_col, text_col, vocabulary), "term-counts")
    documents, total = counts.agg(F.count("*"), F.sum("n")).first()
    weights = np.zeros(len(vocabulary), np.int64)
    for term, df in counts.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # at most one row per term of the block
        weights[term] = math.floor(1000 * math.log((2.0 * documents + 2) / (2.0 * df + 1)))
    lists = scored(counts, Sharing([held[i] for i in ids], len(vocabulary)), weights, documents, total or 1, k)
    lists = lists.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    some = lists.withColumn("rank", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))).where(F.col("rank") <= k)
    last = some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)
    names = spark.createDataFrame(list(enumerate(ids)), f"item int, item_id {kind}")
    return last.join(names, "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text", k: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``item_id, rank, doc_id, score`` of the ``k`` best documents for each item."""
    kind = items.schema[item_col].dataType.simpleString()
    asked, blocks = blocked(written(item_terms(items, item_col, item_text_col), "item-terms"), block_terms)
    out = docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for block in blocks:
        rows = [tuple(r) for r in asked.where(F.col("block") == block).select("item", "term").collect()]  # bounded by the block
        out = out.unionByName(_block(docs, rows, kind, id_col, text_col, k))
    return out


def op12_shared_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents for each benchmark item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_TERMS = rf"regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP12_SQL = f"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS ts FROM documents WHERE text IS NOT NULL),
c AS (SELECT count(*) AS docs, CAST(sum(len(ts)) AS BIGINT) AS total FROM d WHERE len(ts) > 0),
p AS MATERIALIZED (
  SELECT rid, doc_id, n, term, count(*) AS tf FROM (SELECT rid, doc_id, len(ts) AS n, unnest(ts) AS term FROM d) GROUP BY ALL),
w AS (
  SELECT term, CAST(floor(1000 * ln((2 * CAST(docs AS DOUBLE) + 2) / (2 * CAST(count(*) AS DOUBLE) + 1))) AS BIGINT) AS w
  FROM p, c GROUP BY term, docs),
i AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
s AS (
  SELECT item_id, rid, doc_id,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // total)))) AS BIGINT) AS score
  FROM i JOIN w USING (term) JOIN p USING (term), c GROUP BY item_id, rid, doc_id),
r AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM s WHERE score > 0)
SELECT * FROM r WHERE rank <= {TOP}
"""

"""Byte-level BPE as a monoid: spans are encoded on their own and joined up a tree.

A text is cut by the tokenizer's pattern; its matches never merge with each other, so joining across a
match's end is concatenation. Inside a match the merging follows the ranks (lowest first, leftmost of
equals), and its result is built by tree reduction:

* a span of at most ``LEAF`` bytes is merged directly;
* a longer one is cut in two (the left part a power of two of leaves, so that runs of one byte line up),
  both are encoded recursively, and the two token lists are joined by re-encoding a window around the cut,
  which grows on each side until the tokens outside provably stay.

*Why they stay.* Call two tokens a stable pair if merging their joint bytes gives those two tokens again. A
token list is the encoding of its bytes if and only if all its neighbours are stable pairs: the first
merge across some neighbours' border would also happen in those two alone, as up to then both runs do the
same merges inside them. Tokens inside the lists and inside the window are neighbours in a right encoding
already, so the two borders of the window decide. At worst the window is the whole span.

A match that is itself a token is that token, as in the ``tiktoken`` library. Decoding maps ids to bytes and
concatenates: the bytes of all tokens of a batch lie in one buffer, and every level of the tree is a range
of it.

Cases: null texts give null ids and null ids null bytes (the query takes null texts as empty); an empty text
gives an empty list; null entries in a list of ids add nothing; an id outside the file is an error; repeated
rows are encoded alike; an empty table gives no rows; all other columns are kept, whatever their names. Very
long texts are whole; a match of n bytes takes about n log n steps, more only where windows must grow far
(long runs of one byte after another one).
"""

from __future__ import annotations

import base64
import heapq
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from aerostat.llm.common import resident, sliced, table

#: bytes of a span that is merged directly
LEAF = 8
#: from this length on a window's merges are found with a heap
HEAP_BYTES = 64
#: matches, leaves, and stable or unstable pairs, kept in a Python worker
CACHE = 250_000
#: a longer match is not kept
CACHE_CHARS = 64
#: the rank of two parts that do not merge
_NONE = 1 << 40
#: ids that a task decodes at once
DECODE_IDS = 1 << 20


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN


class Pairs:
    """The ranks of one file and the encoding of single matches."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.rank = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
        self.bytes = dict(zip(self.rank.values(), self.rank))
        self.find = regex.compile(pattern).findall
        self.stable: dict[tuple[int, int], bool] = {}
        self.leaves: dict[bytes, list[int]] = {}
        self.matches: dict[str, bytes] = {}

    def merge(self, span: bytes) -> list[int]:
        """All merges of a span, lowest rank first, leftmost of equal ranks."""
        if len(span) >= HEAP_BYTES:
            return self._merge_long(span)
        rank = self.rank
        ends = list(range(len(span) + 1))
        ranks = [rank.get(span[i:i + 2], _NONE) for i in range(len(span) - 1)]
        while ranks and (least := min(ranks)) != _NONE:
            i = ranks.index(least)
            del ranks[i], ends[i + 1]
            if i:
                ranks[i - 1] = rank.get(span[ends[i - 1]:ends[i + 1]], _NONE)
            if i < len(ranks):
                ranks[i] = rank.get(span[ends[i]:ends[i + 2]], _NONE)
        return [rank[span[a:z]] for a, z in zip(ends, ends[1:])]

    def _merge_long(self, span: bytes) -> list[int]:
        """The same with a heap of (rank, place) over a linked list of parts."""
        rank, n = self.rank, len(span)
        end = list(range(1, n + 1))  # end of the part that starts here; 0 for a part that is gone
        before = list(range(-1, n - 1))
        heap = []

        def offer(i: int) -> None:
            j = end[i]
            if j < n:
                r = rank.get(span[i:end[j]])
                if r is not None:
                    heapq.heappush(heap, (r, i, j, end[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, j, z = heapq.heappop(heap)
            if end[i] != j or end[j] != z:
                continue  # one of the two parts has grown since
            end[i], end[j] = z, 0
            if z < n:
                before[z] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        out, i = [], 0
        while i < n:
            out.append(rank[span[i:end[i]]])
            i = end[i]
        return out

    def is_stable(self, a: int, b: int) -> bool:
        known = self.stable.get((a, b))
        if known is None:
            if len(self.stable) >= CACHE:
                self.stable.clear()
            known = self.stable[a, b] = self.merge(self.bytes[a] + self.bytes[b]) == [a, b]
        return known

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two neighbouring spans from theirs."""
        if not left or not right or self.is_stable(left[-1], right[0]):
            return left + right
        a = b = 1
        while True:
            i = len(left) - a
            window = self.merge(b"".join([self.bytes[t] for t in left[i:] + right[:b]]))
            holds_left = i == 0 or self.is_stable(left[i - 1], window[0])
            holds_right = b == len(right) or self.is_stable(window[-1], right[b])
            if holds_left and holds_right:
                return left[:i] + window + right[b:]
            if not holds_left:
                a = min(2 * a, len(left))
            if not holds_right:
                b = min(2 * b, len(right))

    def reduce(self, span: bytes) -> list[int]:
        """The encoding of a span by halves."""
        if len(span) <= LEAF:
            held = self.leaves.get(span)
            if held is None:
                if len(self.leaves) >= CACHE:
                    self.leaves.clear()
                held = self.leaves[span] = self.merge(span)
            return held
        cut = LEAF
        while 2 * cut < len(span):
            cut *= 2
        return self.join(self.reduce(span[:cut]), self.reduce(span[cut:]))

    def match(self, text: str) -> bytes:
        """A match's ids as 32-bit integers."""
        held = self.matches.get(text)
        if held is None:
            raw = text.encode()
            whole = self.rank.get(raw)
            held = array("i", [whole] if whole is not None else self.reduce(raw)).tobytes()
            if len(text) <= CACHE_CHARS:
                if len(self.matches) >= CACHE:
                    self.matches.clear()
                self.matches[text] = held
        return held

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.match, self.find(text)))


def worker_pairs(path: str, pattern: str) -> Pairs:
    return resident(("byte pairs", path, pattern), lambda: Pairs(path, pattern))


def worker_tokens(path: str) -> pa.Array:
    """The bytes of each id; null where the file has none."""
    def load():
        held = Pairs(path, "").bytes
        return pa.array([held.get(i) for i in range(max(held) + 1)], pa.binary())
    return resident(("byte tokens", path), load)


def encode(df: DataFrame, text_col: str, out_col: str = "ids", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``df`` with the ids of ``text_col`` as ``array<int>``, by a file of ranks and its pattern."""
    path, pattern, names = path or default_path(), pattern or default_pattern(), df.columns
    source = df.toDF(*[f"c{i}" for i in range(len(names))]).withColumn("text", F.col(f"c{names.index(text_col)}").cast("string"))

    def run(batches):
        live = worker_pairs(path, pattern)
        for b in sliced(batches, "text"):
            raw = [None if t is None else live.encode(t) for t in b.column("text").to_pylist()]
            ends = np.concatenate([[0], np.cumsum([len(r or b"") // 4 for r in raw])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join([r or b"" for r in raw]), np.int32)),
                                             mask=pa.array([r is None for r in raw]))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], lists], [*b.schema.names[:-1], "ids"])

    return source.mapInArrow(run, source.drop("text").schema.add("ids", T.ArrayType(T.IntegerType()))).toDF(*names, out_col)


def _joined(lists: pa.Array, tokens: pa.Array) -> pa.Array:
    """Each list's bytes: ranges of the one buffer that holds the bytes of all ids in order."""
    flat = lists.flatten()
    found = tokens.take(flat)
    if found.null_count != flat.null_count:
        raise ValueError("ids that the tokenizer's file does not have")
    starts = np.concatenate([[0], np.cumsum(pc.binary_length(found).fill_null(0).to_numpy(zero_copy_only=False))])
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False))])
    whole = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lists), [None, pa.py_buffer(starts[ends].astype(np.int64)), found.buffers()[2]])
    return pc.if_else(lists.is_valid(), whole, pa.scalar(None, pa.large_binary())).cast(pa.binary())


def decode(df: DataFrame, ids_col: str, out_col: str = "decoded", path: str | None = None) -> DataFrame:
    """``df`` with the bytes of the ids in ``ids_col``."""
    path, names = path or default_path(), df.columns
    at = names.index(ids_col)
    source = df.toDF(*[f"c{i}" for i in range(len(names))]).withColumn(f"c{at}", F.col(f"c{at}").cast("array<int>"))

    def run(batches):
        tokens = worker_tokens(path)
        for whole in batches:
            sizes = np.cumsum(pc.list_value_length(whole.column(at)).fill_null(0).to_numpy(zero_copy_only=False))
            start = 0
            while start < whole.num_rows:
                held = sizes[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(sizes, held + DECODE_IDS, "right")))
                b = whole.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays([*b.columns, _joined(b.column(at), tokens)], [*b.schema.names, "decoded"])
                start = stop

    return source.mapInArrow(run, T.StructType([*source.schema.fields, T.StructField("decoded", T.BinaryType())])).toDF(*names, out_col)


def op13_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's number of ids, and digests of its ids and of the bytes that they decode to."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    both = decode(encode(docs, "text").drop("text"), "ids")
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))

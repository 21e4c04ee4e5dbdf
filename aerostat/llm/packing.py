"""Vector bin packing of examples into training sequences.

Every example is a vector (tokens, segments, loss-bearing tokens); a sequence has a limit on
each. The open sequence takes, of a bounded pool of waiting examples, the one whose vector has the
largest dot product with the room that is left (both as fractions of the limits), among those that
fit whole. When none fits and cutting is allowed, the best one is cut to fill the room. The pool grows beyond its
size, up to the segment limit, while it holds too few tokens for a sequence.

Each input partition is packed where it lies: no shuffle, no state beyond the pool, and a task that
is run again gives the same rows. ``sequence_id`` is the partition's number above 40 bits of a counter,
so it is unique over the result; the padding is at most that of one last sequence per partition, and
with ``tail_powers`` that last rest is laid out in sequences of power-of-two lengths.

Cases: a null or empty text has only its end-of-text id; an example without tokens gets no piece; an
example over the limits is cut if cutting is allowed and else gets a sequence of its own with
``fits`` false; null ids and repeated rows are kept, one example per row; an empty table gives no rows.
Columns beside those named are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from aerostat.llm.common import sliced, table, utf8
from aerostat.llm.wordtok import default_path, worker_tokenizer

#: the query's production parameters
MAX_TOKENS, MAX_SEGMENTS, END_ID = 4096, 512, 2
#: examples that wait in a task for a sequence with room
POOL = 256


@dataclass(frozen=True)
class Limits:
    """Largest token count, number of pieces and number of loss-bearing tokens of a sequence."""
    tokens: int = MAX_TOKENS
    segments: int = MAX_SEGMENTS
    loss: int = MAX_TOKENS

    def __post_init__(self):
        if min(self.tokens, self.segments, self.loss) < 1:
            raise ValueError("limits must be positive")


class VectorPacker:
    """Packs a stream of (key, tokens, loss tokens); the loss-bearing tokens are an example's last ones.

    ``add`` and ``finish`` yield pieces ``(key, start, length, sequence number, offset, fits)``.
    """

    def __init__(self, limits: Limits, cut: bool, tail_powers: bool = False, pool: int = POOL):
        self.limits, self.cut, self.tail_powers, self.pool = limits, cut, cut and tail_powers, pool
        self.scale = np.array([limits.tokens, limits.segments, limits.loss], float)
        self.keys: list = []           # of the waiting examples, in order of arrival
        self.starts: list[int] = []    # tokens already placed
        self.sizes: list[int] = []     # whole token counts
        self.losses: list[int] = []    # whole loss counts
        self.need = np.empty((0, 3))   # what the rest of each needs
        self.next = 0

    def add(self, examples: list[tuple]) -> Iterator[tuple]:
        for at in range(0, len(examples), self.pool):
            part = [e for e in examples[at:at + self.pool] if e[1] > 0]
            self.keys += [e[0] for e in part]
            self.starts += [0] * len(part)
            self.sizes += [e[1] for e in part]
            self.losses += [min(e[1], max(0, e[2])) for e in part]
            new = np.array([[n, 1, min(n, max(0, m))] for _, n, m in part], float).reshape(-1, 3)
            self.need = np.concatenate([self.need, new])
            # a sequence is closed only from what can fill it: all its tokens, or all its segments
            while len(self.keys) > self.pool and (self.need[:, 0].sum() >= self.limits.tokens or len(self.keys) >= self.limits.segments):
                yield from self._sequence(self.limits.tokens)

    def finish(self) -> Iterator[tuple]:
        while self.keys:
            room, left = self.limits.tokens, int(self.need[:, 0].sum())
            if self.tail_powers and left < room:
                room = 1 << (left.bit_length() - 1)
            yield from self._sequence(room)

    def _loss(self, i: int, length: int) -> int:
        """Loss-bearing tokens among the next ``length`` of the i-th waiting example."""
        first = self.sizes[i] - self.losses[i]
        return max(0, self.starts[i] + length - max(self.starts[i], first))

    def _sequence(self, tokens: int) -> Iterator[tuple]:
        room = np.array([tokens, self.limits.segments, self.limits.loss], float)
        number, offset, used = self.next, 0, np.zeros(len(self.keys), bool)
        self.next += 1
        while room[0] > 0 and room[1] > 0 and not used.all():
            score = self.need @ (room / self.scale**2)
            fits = (self.need <= room).all(axis=1) & ~used
            if fits.any():
                i = int(np.argmax(np.where(fits, score, -1)))
                length, whole = int(self.need[i, 0]), True
            elif self.cut:
                i = int(np.argmax(np.where(used, -1, score)))
                first = max(0, self.sizes[i] - self.losses[i] - self.starts[i])  # tokens before the loss
                length, whole = int(min(room[0], self.need[i, 0], first + room[2])), False
                if length < 1:
                    break
            elif offset == 0:  # over a limit by itself and not to be cut
                i = int(np.flatnonzero(~used)[0])
                length, whole = int(self.need[i, 0]), True
                yield self.keys[i], self.starts[i], length, number, 0, False
                used[i] = True
                break
            else:
                break
            yield self.keys[i], self.starts[i], length, number, offset, True
            room -= (length, 1, self._loss(i, length))
            offset += length
            self.starts[i] += length
            if whole or self.starts[i] == self.sizes[i]:
                used[i] = True
            else:
                self.need[i] = (self.sizes[i] - self.starts[i], 1, self._loss(i, self.sizes[i] - self.starts[i]))
        if used.any():
            left = np.flatnonzero(~used).tolist()
            self.keys, self.starts = [self.keys[i] for i in left], [self.starts[i] for i in left]
            self.sizes, self.losses = [self.sizes[i] for i in left], [self.losses[i] for i in left]
            self.need = self.need[left]


def pack_examples(df: DataFrame, id_col: str, tokens_col: str, loss_col: str, limits: Limits = Limits(),
                  cut: bool = False, pool: int = POOL) -> DataFrame:
    """Place examples with known counts; null counts are 0. Returns ``id, start, length, sequence_id, offset, fits``."""
    spec = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(tokens_col).cast("long"), F.lit(0)).alias("n"),
                     F.coalesce(F.col(loss_col).cast("long"), F.lit(0)).alias("m"),
                     F.spark_partition_id().alias("part"))
    kind = spec.schema["id"].dataType.simpleString()

    def pack(batches):
        packer, base, arrow_kind = VectorPacker(limits, cut, pool=pool), 0, None

        def out(pieces):
            cols = list(zip(*pieces)) or [()] * 6
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], arrow_kind), *(pa.array(c, pa.int64()) for c in cols[1:3]),
                 pa.array([base + s for s in cols[3]], pa.int64()), pa.array(cols[4], pa.int64()),
                 pa.array(cols[5], pa.bool_())], ["id", "start", "length", "sequence_id", "offset", "fits"])
        for b in filter(len, batches):
            arrow_kind, base = b.schema.field("id").type, b.column("part")[0].as_py() << 40
            yield out(list(packer.add(list(zip(*(b.column(c).to_pylist() for c in ("id", "n", "m")))))))
        if arrow_kind is not None:
            yield out(list(packer.finish()))

    return spec.mapInArrow(pack, f"id {kind}, start long, length long, sequence_id long, offset long, fits boolean")


def pack_texts(df: DataFrame, id_col: str, text_col: str, tokenizer: str | None = None, end_id: int = END_ID,
               limits: Limits = Limits(), loss_share: Column | None = None, pool: int = POOL) -> DataFrame:
    """Tokenise whole texts, end each with ``end_id``, and pack them, cutting freely.

    Every token counts towards the loss unless ``loss_share`` gives the share (0 to 1) of a text's last
    tokens that does. Returns per piece ``id, start, length, ids`` (binary, little-endian unsigned 32-bit),
    ``total`` (tokens of the text with its end), ``sequence_id, offset``.
    """
    path = tokenizer or default_path()
    share = F.lit(1.0) if loss_share is None else F.coalesce(loss_share.cast("double"), F.lit(1.0))
    spec = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), share.alias("share"),
                     F.spark_partition_id().alias("part"))
    kind = spec.schema["id"].dataType.simpleString()
    end = int(end_id).to_bytes(2, "little")

    def pack(batches):
        packer, base, live, held, count = VectorPacker(limits, True, True, pool), 0, worker_tokenizer(path), {}, 0
        arrow_kind = None

        def out(pieces):
            cols = {k: [] for k in ("id", "start", "length", "ids", "total", "sequence_id", "offset")}
            for key, start, length, number, offset, _ in pieces:
                doc, ids = held[key]
                row = (doc, start, length, np.frombuffer(ids, "<u2", length, 2 * start).astype("<u4").tobytes(),
                       len(ids) // 2, base + number, offset)
                for c, v in zip(cols.values(), row):
                    c.append(v)
                if 2 * (start + length) == len(ids):
                    del held[key]
            kinds = [arrow_kind, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols.values(), kinds)], list(cols))
        for b in sliced(batches, "text"):
            arrow_kind, base, new = b.schema.field("id").type, b.column("part")[0].as_py() << 40, []
            for doc, ids, s in zip(b.column("id").to_pylist(), live.ids16(utf8(b.column("text"))), b.column("share").to_pylist()):
                ids += end
                held[count] = (doc, ids)
                new.append((count, len(ids) // 2, round(len(ids) // 2 * min(1.0, max(0.0, s)))))
                count += 1
            yield out(packer.add(new))
        if arrow_kind is not None:
            yield out(packer.finish())

    return spec.mapInArrow(pack, f"id {kind}, start long, length long, ids binary, total long, sequence_id long, offset long")


def digest(pieces: DataFrame) -> DataFrame:
    """The query's columns of :func:`pack_texts`' pieces."""
    return pieces.select(F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"),
                         F.col("total").alias("doc_tokens"), "sequence_id", "offset")


def op1_pack_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 tokens."""
    return digest(pack_texts(table(spark, sf_dir, "documents"), "doc_id", "text"))

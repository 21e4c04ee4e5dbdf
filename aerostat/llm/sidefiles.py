"""Rows sent back to the input partitions they came from, without shuffling the texts.

A small table with a column ``part`` (the input's partition number) is written below the shared folder, one folder
per partition; a later pass over the same input reads its own folder only.

A later pass must see the same rows at the same places. Spark deals files to partitions anew for each job, and
a changed setting or another number of cores changes the layout. So every pass is held against a *proof*: per
partition the number of rows and the exclusive-or of a hash of each row's place and id, taken in the pass that
named the places. :func:`send_back` puts the proof beside the rows, so each partition has a folder; :func:`received`
raises where there is none (an unseen or foreign folder never reads as "no rows"), and :meth:`Returned.check` where
the rows are not those of the proof. A failed check fails the job: no result instead of a wrong one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, functions as F

from aerostat.llm.common import new_folder

_SEQ_BITS = 33  # of the row's number within its partition in monotonically_increasing_id

MOVED = "the input gave other partitions on a later read; write it to files first, and keep its read settings as they are"


def seq() -> Column:
    """The row's number within its input partition; only beside the scan, before any filter."""
    return F.monotonically_increasing_id().bitwiseAND((1 << _SEQ_BITS) - 1)


def mark(number: Column, row_id: Column) -> Column:
    return F.xxhash64(number, row_id)


def proof(rows: DataFrame) -> DataFrame:
    """From ``part, seq, id`` of every input row: what a later pass over the input is held against."""
    return rows.groupBy("part").agg(F.count("*").alias("proof_n"), F.bit_xor(mark(F.col("seq"), F.col("id"))).alias("proof_mark"))


def send_back(rows: DataFrame, name: str, held: DataFrame) -> str:
    """Write ``rows`` by their column ``part``, with the :func:`proof` ``held``; each partition's rows make one file."""
    path = new_folder(rows.sparkSession, name)
    rows.unionByName(held, allowMissingColumns=True).repartition("part").write.partitionBy("part").parquet(path)
    return path


class Returned:
    """What came back for one partition; ``rows`` are those sent, the proof is kept for :meth:`check`."""

    def __init__(self, found: pa.Table, columns: list[str]):
        is_proof = found.column("proof_n").is_valid()
        held = found.filter(is_proof)
        if held.num_rows != 1:
            raise RuntimeError(MOVED)
        self.n, self.mark = held.column("proof_n")[0].as_py(), held.column("proof_mark")[0].as_py()
        self.rows = found.filter(pc.invert(is_proof)).select(columns)

    def seen(self, marks: pa.Array) -> None:
        """Take note of a batch's rows."""
        self.n -= len(marks)
        self.mark ^= int(np.bitwise_xor.reduce(marks.to_numpy(zero_copy_only=False)))

    def check(self) -> None:
        """At the partition's end: were these the rows that the places were named for?"""
        if self.n or self.mark:
            raise RuntimeError(MOVED)


def received(path: str, part: int, columns: list[str]) -> Returned:
    """In a task: what was sent to partition ``part``. Each partition with rows has something, or the pass is not the same."""
    store, place = fs.FileSystem.from_uri(path)
    files = store.get_file_info(fs.FileSelector(f"{place}/part={part}", allow_not_found=True))
    names = sorted(f.path for f in files if f.path.endswith(".parquet"))
    if not names:
        raise RuntimeError(f"nothing for partition {part} can be seen at {path}: {MOVED}")
    return Returned(pa.concat_tables([pq.ParquetFile(store.open_input_file(n)).read([*columns, "proof_n", "proof_mark"]) for n in names]), columns)

"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession

#: bytes of text that a task works on at once (a longer single text is a slice of its own)
SLICE_BYTES = 1 << 21


#: rows that Spark hands to a Python worker at once: texts are large, and a batch is held several times over
ARROW_ROWS = 1000


def settle(spark: SparkSession) -> None:
    """The session setting that the operators' memory rests on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    settle(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_RESIDENT: dict = {}


def resident(key, make):
    """What a Python worker keeps from task to task (a tokenizer, a model): only the last one asked for.

    Workers outlive a stage, so what an earlier operator kept would otherwise add up in the next one's.
    """
    if key not in _RESIDENT:
        release()
        _RESIDENT[key] = make()
    return _RESIDENT[key]


def release() -> None:
    """Drop what is kept and give the memory back to the system."""
    if _RESIDENT:
        _RESIDENT.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):
            ctypes.CDLL(None).malloc_trim(0)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; one of its own only in local mode where that is unset."""
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    base = base or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="llm-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        sc.setCheckpointDir(base)
    return _qualified(spark, base.rstrip("/"))


def _qualified(spark: SparkSession, path: str) -> str:
    """``path`` as Spark's file systems resolve it, so that tasks that open it themselves look in the same store."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    full = p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()
    return "file://" + full[5:] if full.startswith("file:/") and not full.startswith("file://") else full


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: cuts the lineage."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sliced(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in order, in slices of about ``limit`` bytes of ``column`` (one row at least)."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_pylist()
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if i > start and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        yield batch.slice(start, n - start)


def utf8(column: pa.Array) -> list[bytes | None]:
    """A string column's values as UTF-8 bytes."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()

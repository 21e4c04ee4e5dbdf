"""Parquet tables: keyed upsert, frozen snapshots, model-metrics registry, CSV in/out, views.

Tables are partitioned by a date column so that an upsert rewrites only the
days it touches. A path is never overwritten while it is being read: merged
partitions go to a staging folder first, and are swapped in with a dynamic
partition overwrite. Every step is a plain Spark write, so a lost executor only
re-runs tasks, and re-running the whole upsert gives the same table.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from aerostat.operators.incremental import dedup_keep_first, keep_latest, merge_by_order, upsert_latest
from aerostat.schemas import MODEL_METRICS_SCHEMA
from aerostat.session import shared_path


def table_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path).schema  # noqa: B018
        return True
    except AnalysisException:
        return False


def with_date_partition(df: DataFrame, ts: str, col: str = "date") -> DataFrame:
    return df.withColumn(col, F.to_date(ts))


def read_range(spark: SparkSession, path: str, ts: str, start=None, end=None,
               partition_col: str = "date") -> DataFrame:
    """Rows with ``start <= ts < end`` of a date-partitioned table.

    The matching filter on the partition column is added next to the time
    filter, so only the partitions in range are listed and read (partition
    pruning) and the time filter reaches the Parquet row groups (pushdown).
    """
    df = spark.read.parquet(path)
    cond = F.lit(True)
    if start is not None:
        s0 = F.lit(start).cast("timestamp")
        cond = cond & (F.col(ts) >= s0) & (F.col(partition_col) >= F.to_date(s0))
    if end is not None:
        e0 = F.lit(end).cast("timestamp")
        cond = cond & (F.col(ts) < e0) & (F.col(partition_col) <= F.to_date(e0))
    return df.filter(cond)


def create_if_absent(spark: SparkSession, path: str, schema: T.StructType, partition_by: Sequence[str] = ()) -> None:
    if not table_exists(spark, path):
        spark.createDataFrame([], schema).write.partitionBy(*partition_by).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path of ours through Spark's file system layer (a missing one is fine)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def upsert_table(spark: SparkSession, new: DataFrame, path: str, key: Sequence[str], order: Sequence[str] = (),
                 partition_col: str = "date", resolve: str = "new", ts: str | None = None) -> None:
    """Keyed insert into a date-partitioned Parquet table.

    ``resolve="new"``: rows of ``new`` replace stored rows with the same key
    (within ``new``, the largest ``order`` wins). ``resolve="first"`` / ``"last"``:
    the row with the smallest / largest ``order`` wins wherever it came from,
    which makes a stream of batches equal to one batch in any arrival order.

    Keys are resolved inside the dates that ``new`` touches, so the key has to fix
    the date: name the time column as ``ts`` to have that checked. An empty ``new`` changes nothing. Files
    per date follow the data (``REBALANCE``), and the staging folder goes when the swap is done.
    """
    if ts is not None and ts not in key:
        raise ValueError(f"the key {list(key)} does not fix the partition: it lacks {ts}")
    if new.isEmpty():
        return
    staging = shared_path(spark, "staging", f"upsert-{uuid.uuid4().hex}")
    if not table_exists(spark, path):
        if resolve == "first":
            merged = dedup_keep_first(new, key, order)
        else:
            merged = keep_latest(new, key, order) if order else new.dropDuplicates(list(key))
    else:
        existing = spark.read.parquet(path)
        touched = new.select(partition_col).distinct()
        # the semi join lets dynamic partition pruning read only the touched days
        old = existing.join(touched, on=partition_col, how="left_semi")
        incoming = new.select(*existing.columns)
        if resolve == "new":
            merged = upsert_latest(old, incoming, key, order)
        else:
            merged = merge_by_order(old, incoming, key, order, resolve)
    merged.hint("rebalance", partition_col).write.mode("overwrite").partitionBy(partition_col).parquet(staging)
    (spark.read.parquet(staging).hint("rebalance", partition_col).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(path))
    remove(spark, staging)


def snapshot(df: DataFrame, base: str, version: str) -> str:
    """Frozen training snapshot at ``base/v=<version>``; refuses to overwrite an existing one."""
    path = f"{base.rstrip('/')}/v={version}"
    df.write.mode("errorifexists").parquet(path)
    return path


def snapshot_or_live(df: DataFrame, base: str, version: str) -> tuple[DataFrame, str]:
    """Freeze ``df`` as a snapshot and read it back; where that version is frozen already, read that one.

    Only if no snapshot can be written or read does training fall back to the live frame. Returns (frame,
    label) where label is the snapshot version or "live".
    """
    spark = df.sparkSession
    try:
        return spark.read.parquet(snapshot(df, base, version)), version
    except AnalysisException:
        frozen = f"{base.rstrip('/')}/v={version}"
        return (spark.read.parquet(frozen), version) if table_exists(spark, frozen) else (df, "live")


def register_metrics(spark: SparkSession, registry: str, model: str, version: int, metrics: dict[str, float],
                     snapshot_version: str) -> None:
    rows = [(model, int(version), k, float(v), snapshot_version) for k, v in metrics.items()]
    spark.createDataFrame(rows, MODEL_METRICS_SCHEMA).write.mode("append").parquet(registry)


def latest_version(spark: SparkSession, registry: str, model: str) -> int | None:
    r = spark.read.parquet(registry).filter(F.col("model") == model).agg(F.max("version")).first()
    return None if r is None else r[0]


CSV_TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"  # keeps microseconds (the default drops them)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, ts_cols: Sequence[str] = ()) -> DataFrame:
    df = spark.read.schema(schema).option("header", True).csv(path)
    return df.withColumns({c: F.to_timestamp(c) for c in ts_cols}) if ts_cols else df


def write_csv_sorted(df: DataFrame, path: str, ts: str, partitions: int | None = None) -> None:
    """Time-sorted CSV with a header: range-partitioned on time, so part files concatenate in order."""
    n = partitions or max(df.sparkSession.sparkContext.defaultParallelism, 1)
    (df.repartitionByRange(n, ts).sortWithinPartitions(ts).write.mode("overwrite").option("header", True)
     .option("timestampFormat", CSV_TS_FORMAT).csv(path))


def register_view(df: DataFrame, name: str) -> DataFrame:
    """A named query for this session (re-creating an existing view is fine)."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def save_view(spark: SparkSession, name: str, sql: str) -> DataFrame:
    """A named query kept in the catalog: other sessions on the same catalog see it, and it reads the data of the day."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {sql}")
    return spark.table(name)

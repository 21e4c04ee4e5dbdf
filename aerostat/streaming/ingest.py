"""Structured Streaming forms of the hourly jobs.

* :func:`hourly_stream` - tumbling 1-hour aggregation with an event-time
  watermark, append mode: a window is emitted once, after it closes. The same
  aggregation function runs in batch.
* :func:`upsert_sink` - ``foreachBatch`` that resolves duplicate keys by data
  columns (never by arrival order) and upserts into a date-partitioned table,
  so any file order or batch split gives the batch answer.
* :func:`late_splitting_sink` - routes rows at or before the table watermark
  (minus a tolerance) to a side table *before* anything stateful sees them.
* :func:`alert_sink` - writes the alert table keyed by (entity, ts, level).
* :func:`feature_sink` - keeps a feature table current: per micro-batch only
  the touched entities are recomputed, from their earliest new row on, with the
  preceding ``context`` stored rows as lag/rolling context.

Per table an *entity index* (entity, first and last stored time) is kept, a
version per epoch: written beside the older ones and used only when complete,
so a crash never leaves a partial index, and an epoch that is delivered again
starts from the same version and gives the same result.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from aerostat.operators.alerts import alert_table
from aerostat.operators.asof import last_n
from aerostat.operators.incremental import split_incoming
from aerostat.operators.windows import join_on_keys, order_key
from aerostat.schemas import SeriesSpec
from aerostat.sources.store import read_range, remove, table_exists, upsert_table, with_date_partition

KEPT_VERSIONS = 3  # of the entity index


def read_event_files(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


def hourly_aggregate(df: DataFrame, entity: Sequence[str], ts: str, value: str) -> DataFrame:
    """Tumbling hourly count / mean / min / max per entity (batch or stream)."""
    return (df.groupBy(*entity, F.window(ts, "1 hour").alias("w"))
            .agg(F.count(F.lit(1)).alias("n_events"), F.avg(value).alias("avg_value"),
                 F.min(value).alias("min_value"), F.max(value).alias("max_value"))
            .select(*entity, F.col("w.start").alias("hour_ts"), "n_events", "avg_value", "min_value", "max_value"))


def hourly_stream(events: DataFrame, entity: Sequence[str], ts: str, value: str, delay: str = "2 hours") -> DataFrame:
    """Streaming hourly series; ``delay`` must cover the disorder of the feed."""
    return hourly_aggregate(events.withWatermark(ts, delay), entity, ts, value)


def index_path(table: str) -> str:
    return table.rstrip("/") + "_entity_index"


def index_versions(spark: SparkSession, table: str) -> list[int]:
    """Epochs whose index version is complete, in order."""
    p = spark._jvm.org.apache.hadoop.fs.Path(index_path(table))
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    found = [s.getPath() for s in fs.listStatus(p) if s.getPath().getName().startswith("v=")]
    done = [x for x in found if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(x, "_SUCCESS"))]
    return sorted(int(x.getName()[2:]) for x in done)


def entity_index(spark: SparkSession, table: str, before_epoch: int | None = None) -> DataFrame | None:
    """The newest version (older than ``before_epoch``): entity, first_ts, last_ts."""
    found = [v for v in index_versions(spark, table) if before_epoch is None or v < before_epoch]
    return spark.read.parquet(f"{index_path(table)}/v={found[-1]}") if found else None


def update_entity_index(spark: SparkSession, new_rows: DataFrame, spec: SeriesSpec, table: str, epoch: int) -> None:
    """Write the version of ``epoch``: the one before it, merged with the rows of this epoch; old versions go."""
    fresh = new_rows.groupBy(*spec.entity).agg(F.min(spec.ts).alias("first_ts"), F.max(spec.ts).alias("last_ts"))
    known = entity_index(spark, table, epoch)
    merged = fresh if known is None else (known.unionByName(fresh).groupBy(*spec.entity)
                                          .agg(F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts")))
    merged.write.mode("overwrite").parquet(f"{index_path(table)}/v={epoch}")
    for old in [v for v in index_versions(spark, table) if v <= epoch][:-KEPT_VERSIONS]:
        remove(spark, f"{index_path(table)}/v={old}")


def _with_batch(body: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch body whose micro-batch is read once, and that skips an empty one."""
    def run(batch: DataFrame, epoch: int) -> None:
        batch = batch.persist()
        try:
            if not batch.isEmpty():
                body(batch, epoch)
        finally:
            batch.unpersist()
    return run


def upsert_sink(table: str, key: Sequence[str], order: Sequence[str], ts: str, partition_col: str = "date",
                resolve: str = "first") -> Callable[[DataFrame, int], None]:
    """foreachBatch body: keyed upsert of each micro-batch, duplicates resolved by ``order``.

    Idempotent on replay; with ``resolve="first"`` the lowest ``order`` wins
    whatever batch it arrives in, so the table equals the batch answer.
    """
    def run(batch: DataFrame, _epoch: int) -> None:
        upsert_table(batch.sparkSession, with_date_partition(batch, ts, partition_col), table, key, order, partition_col, resolve, ts)
    return _with_batch(run)


def late_splitting_sink(table: str, late_table: str, spec: SeriesSpec, key: Sequence[str], order: Sequence[str],
                        tolerance: str | None = None, partition_col: str = "date",
                        as_of: Callable[[], Column] = F.current_timestamp) -> Callable[[DataFrame, int], None]:
    """foreachBatch body: rows at/before the stored watermark go to ``late_table``, the rest are upserted.

    The watermark is the entity index of the epoch before (never a scan of the table), clamped to the clock
    ``as_of()``. Both tables are keyed, so an epoch that is delivered again changes nothing.
    """
    def run(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        index = entity_index(spark, table, epoch)
        fresh, late = batch, batch.limit(0)
        if index is not None:
            fresh, late = split_incoming(batch, index.select(*spec.entity, "last_ts"), spec, tolerance, as_of())
        upsert_table(spark, with_date_partition(late, spec.ts, partition_col), late_table, [*key, *order], (), partition_col, ts=spec.ts)
        upsert_table(spark, with_date_partition(fresh, spec.ts, partition_col), table, key, order, partition_col, "first", spec.ts)
        update_entity_index(spark, fresh, spec, table, epoch)
    return _with_batch(run)


WIDEN_STEPS = 4  # bounded look-back windows (x4 each) before the rest of the history is read


def rows_before(spark: SparkSession, table: str, limits: DataFrame, spec: SeriesSpec, n: int, lookback: str,
                index: DataFrame | None = None, count_col: str | None = None) -> DataFrame:
    """Per entity of ``limits`` (entity, ``_from``) its last stored rows before ``_from``: ``n`` of them, or with ``count_col``
    so many that ``n`` have a value there (then a fill of that column looks back far enough).

    Rows are read from the date partitions starting ``lookback`` before the earliest ``_from``. Entities that
    find too few there, and that have older rows (per ``index``; without it, assumed), read further back in
    windows that grow four-fold per step; only after ``WIDEN_STEPS`` steps is the rest read.
    """
    counts = F.col(count_col).isNotNull() if count_col else F.lit(True)
    lo = limits.agg(F.min("_from")).first()[0]
    if lo is None:
        return spark.read.parquet(table).limit(0)

    def back(edge, steps: int):
        return spark.range(1).select((F.lit(edge).cast("timestamp") - F.expr(f"INTERVAL {lookback}") * steps).alias("s")).first()[0]

    def earlier(rows: DataFrame) -> DataFrame:
        return join_on_keys(rows, limits, spec.entity, "inner").filter(F.col(spec.ts) < F.col("_from")).drop("_from")
    edge = back(lo, 1)
    found = earlier(read_range(spark, table, spec.ts, start=edge))
    for step in range(WIDEN_STEPS + 1):
        have = found.filter(counts).groupBy(*spec.entity).agg(F.count(F.lit(1)).alias("_n"))
        short = join_on_keys(limits, have, spec.entity).filter(F.coalesce("_n", F.lit(0)) < n).drop("_n")
        if index is not None:
            short = join_on_keys(short, index.filter(F.col("first_ts") < F.lit(edge)).select(*spec.entity), spec.entity, "inner")
        if short.isEmpty():
            break
        lower = None if step == WIDEN_STEPS else back(edge, 4 ** (step + 1))
        older = read_range(spark, table, spec.ts, start=lower, end=edge)
        found = found.unionByName(join_on_keys(older, short, spec.entity, "inner").drop("_from"))
        edge = lower
    tail = last_n(found.filter(counts), spec, n).drop("rank_from_end")
    if count_col is None:
        return tail
    start = tail.groupBy(*spec.entity).agg(F.min(order_key(spec)).alias("_k"), F.count(F.lit(1)).alias("_n"))
    near = join_on_keys(found, start, spec.entity)
    return near.filter(F.col("_n").isNull() | (F.col("_n") < n) | (order_key(spec) >= F.col("_k"))).drop("_k", "_n")


def alert_sink(source_table: str, alerts_table: str, spec: SeriesSpec, col: str, as_of: Callable[[], Column],
               lookback: str = "7 days") -> Callable[[DataFrame, int], None]:
    """foreachBatch body: after new rows land, recompute alerts of the touched entities and upsert them.

    Only the last rows before the clock are read (see :func:`rows_before`), not the entities' history.
    """
    def run(batch: DataFrame, _epoch: int) -> None:
        spark = batch.sparkSession
        now = as_of()
        limits = batch.select(*spec.entity).distinct().withColumn("_from", now + F.expr("INTERVAL 1 MICROSECOND"))
        recent = rows_before(spark, source_table, limits, spec, 24, lookback, entity_index(spark, source_table))
        out = with_date_partition(alert_table(recent, spec, col, now), spec.ts)
        upsert_table(spark, out, alerts_table, [*spec.entity, spec.ts, "level"], ["message"], ts=spec.ts)
    return _with_batch(run)


def refresh_features(spark: SparkSession, raw_table: str, new_rows: DataFrame, spec: SeriesSpec,
                     build: Callable[[DataFrame], DataFrame], context: int = 24, lookback: str = "7 days",
                     index: DataFrame | None = None, fill_col: str | None = None) -> DataFrame:
    """Feature rows to (re)write after ``new_rows`` landed in ``raw_table``.

    For each touched entity: every stored row from its earliest new row on, plus the ``context`` stored rows
    before that, go through ``build``; context rows are dropped from the result. Exact for features looking
    back <= ``context`` rows; with ``fill_col`` also for those that pad or fill that column without bound.
    """
    limits = new_rows.groupBy(*spec.entity).agg(F.min(spec.ts).alias("_from"))
    lo = limits.agg(F.min("_from")).first()[0]
    if lo is None:
        return spark.read.parquet(raw_table).limit(0)
    recent = join_on_keys(read_range(spark, raw_table, spec.ts, start=lo), limits, spec.entity, "inner")
    affected = recent.filter(F.col(spec.ts) >= F.col("_from")).drop("_from")
    ctx = rows_before(spark, raw_table, limits, spec, context, lookback, index, fill_col)
    both = affected.withColumn("_ctx", F.lit(False)).unionByName(ctx.withColumn("_ctx", F.lit(True)))
    built = build(both)
    return built.filter(~F.col("_ctx")).drop("_ctx")


def feature_sink(raw_table: str, features_table: str, spec: SeriesSpec, key: Sequence[str],
                 order: Sequence[str], build: Callable[[DataFrame], DataFrame],
                 context: int = 24, lookback: str = "7 days", fill_col: str | None = None) -> Callable[[DataFrame, int], None]:
    """foreachBatch body: upsert the raw rows, refresh the features of the touched entities, update the index."""
    def run(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        known = entity_index(spark, raw_table, epoch)
        upsert_table(spark, with_date_partition(batch, spec.ts), raw_table, key, order, resolve="first", ts=spec.ts)
        feats = refresh_features(spark, raw_table, batch, spec, build, context, lookback, known, fill_col)
        upsert_table(spark, feats, features_table, key, order, resolve="new", ts=spec.ts)
        update_entity_index(spark, batch, spec, raw_table, epoch)
    return _with_batch(run)


def run_available(df: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Process everything available now (trigger availableNow) and stop; restarts resume from the checkpoint."""
    q = df.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()

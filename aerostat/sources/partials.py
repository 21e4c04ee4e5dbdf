"""Kept partial aggregates: one mergeable row per entity and day, in a versioned table.

Watermark, profile, daily rollup and history size are read from these rows alone, so their cost follows the
number of entities and days and not the number of readings. Two ways keep the table current:

* :func:`merge_batch` for feeds that only append: a batch is aggregated and merged into the days it touches. The
  commit record holds the last batch of each feed, so a batch that is repeated (a restarted stream) changes nothing.
* :func:`follow` for keyed tables, where a row may replace another one: the days whose files differ between the
  version followed last and the newest one are aggregated anew, and no others are read.

Cases: a NULL entity is an entity; rows without a time are counted in a day of their own (NULL) and have no first or
last time; NULL values count as rows but not in mean, highest and lowest; NaN values give NaN, as in a full scan;
a batch without rows changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from aerostat.operators.asof import not_after
from aerostat.schemas import SeriesSpec
from aerostat.sources import versioned as vt

DAY = "date"


def partials(rows: DataFrame, spec: SeriesSpec, col: str | None = None) -> DataFrame:
    """Per entity and day: rows, values, their sum, highest and lowest, first and last time."""
    v = F.col(col or spec.target)
    return rows.groupBy(*spec.entity, F.to_date(spec.ts).alias(DAY)).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(v).alias("n_values"), F.sum(v.cast("double")).alias("total"),
        F.max(v.cast("double")).alias("high"), F.min(v.cast("double")).alias("low"),
        F.min(spec.ts).alias("first_ts"), F.max(spec.ts).alias("last_ts"))


def merged(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Partials of the same ``by`` put together."""
    return parts.groupBy(*by).agg(
        *[F.sum(c).alias(c) for c in ("n_rows", "n_values", "total")], F.max("high").alias("high"), F.min("low").alias("low"),
        F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"))


def _of_days(days: Sequence) -> Column:
    here = F.col(DAY).isin([d for d in days if d is not None])
    return here | F.col(DAY).isNull() if None in days else here


def merge_batch(spark: SparkSession, path: str, batch: DataFrame, spec: SeriesSpec, batch_id: int, feed: str = "feed",
                col: str | None = None) -> int:
    """Merge one batch of a feed and return the version that holds it. Batch numbers of a feed must rise."""
    mark = f"batch:{feed}"
    new = partials(batch, spec, col).persist()  # small: a row per entity and day of the batch
    try:
        days = [r[0] for r in new.select(DAY).distinct().collect()]
        for _ in range(vt.TRIES):
            base = vt.record(spark, path)
            if not days or (base and base.get("meta", {}).get(mark, -1) >= batch_id):
                return base["version"] if base else 0
            rows = new
            if base:
                rows = vt.frame(spark, path, base).filter(_of_days(days)).unionByName(new)
            done = vt.commit(spark, path, merged(rows, [*spec.entity, DAY]), DAY, base, {mark: batch_id})
            if done is not None:
                return done
    finally:
        new.unpersist()
    raise RuntimeError(f"{path}: other writers committed {vt.TRIES} times in a row")


def partials_sink(path: str, spec: SeriesSpec, feed: str = "feed", col: str | None = None) -> Callable[[DataFrame, int], None]:
    """For ``writeStream.foreachBatch``: keeps the partials of a stream, each micro-batch once."""
    def write(batch: DataFrame, batch_id: int) -> None:
        merge_batch(batch.sparkSession, path, batch, spec, batch_id, feed, col)
    return write


def follow(spark: SparkSession, path: str, rows_path: str, spec: SeriesSpec, col: str | None = None) -> list[str]:
    """Bring the partials up to the newest version of a keyed table partitioned by day; returns the partitions read anew."""
    for _ in range(vt.TRIES):
        source, base = vt.record(spark, rows_path), vt.record(spark, path)
        if source is None:
            return []
        if source["partition"] != DAY:
            raise ValueError(f"{rows_path} is partitioned by {source['partition']}, not by {DAY}")
        seen = base.get("meta", {}).get("follows", {}) if base else {}
        changed = {name: made for name, made in source["parts"].items() if seen.get(name) != made}
        if not changed:
            return []
        rows = vt.frame(spark, rows_path, {**source, "parts": changed})
        if vt.commit(spark, path, partials(rows, spec, col), DAY, base, {"follows": source["parts"]}) is not None:
            return sorted(changed)
    raise RuntimeError(f"{path}: other writers committed {vt.TRIES} times in a row")


def watermark(parts: DataFrame, spec: SeriesSpec) -> DataFrame:
    return parts.groupBy(*spec.entity).agg(F.max("last_ts").alias("last_ts"))


def profile(parts: DataFrame, spec: SeriesSpec) -> DataFrame:
    return merged(parts, spec.entity).select(*spec.entity, "n_rows", "first_ts", "last_ts")


def daily_rollup(parts: DataFrame, spec: SeriesSpec, decimals: int = 0) -> DataFrame:
    mean = F.when(F.col("n_values") > 0, F.col("total") / F.col("n_values"))
    return parts.select(*spec.entity, DAY, F.bround(mean, decimals).alias("avg_value"),
                        F.bround("high", decimals).alias("max_value"), F.bround("low", decimals).alias("min_value"))


def history_size(parts: DataFrame, spec: SeriesSpec, min_rows: int, as_of: Column | None = None,
                 rows: DataFrame | None = None) -> DataFrame:
    """Row count per entity and whether it reaches ``min_rows``.

    With ``as_of``: whole days before its day come from the partials, and its own day from ``rows`` (the readings, of which
    only that day is read).
    """
    counts = parts.select(*spec.entity, "n_rows")
    if as_of is not None:
        if rows is None:
            raise ValueError("the day of as_of is counted from the rows")
        start = F.to_date(as_of).cast("timestamp")
        own = not_after(rows.filter(F.col(spec.ts) >= start), spec, as_of)
        counts = (parts.filter(F.col(DAY) < F.to_date(as_of)).select(*spec.entity, "n_rows")
                  .unionByName(own.groupBy(*spec.entity).agg(F.count(F.lit(1)).alias("n_rows"))))
    return counts.groupBy(*spec.entity).agg(F.sum("n_rows").alias("n_rows")).withColumn("eligible", F.col("n_rows") >= F.lit(min_rows))

"""Incremental loading: high watermark, fetch ranges, fresh/late split, keep-first union, keyed upsert.

Duplicate keys are resolved by data columns (source priority, then an id),
never by arrival order, so batch and streaming runs give the same table.
Resolution is an aggregate (``min_by``/``max_by`` of the whole row), which is
combined map-side: a key with a huge number of copies never lands whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from aerostat.operators.windows import join_on_keys
from aerostat.schemas import SeriesSpec

_SRC = "_src"


def high_watermark(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    return df.groupBy(*spec.entity).agg(F.max(spec.ts).alias("last_ts"))


def clamp_watermark(wm: DataFrame, as_of: Column, step: str = "INTERVAL 1 HOUR") -> DataFrame:
    """A watermark ahead of the clock is treated as one step before now."""
    return wm.withColumn("last_ts", F.when(F.col("last_ts") > as_of, as_of - F.expr(step))
                         .otherwise(F.col("last_ts")))


def fetch_ranges(wm: DataFrame, as_of: Column, step: str = "INTERVAL 1 HOUR", entities: DataFrame | None = None,
                 backfill: str = "INTERVAL 7 DAYS") -> DataFrame:
    """Per entity: the next slot after the (clamped) watermark, the date range to fetch, and whether it is due.

    ``entities`` (optional) lists every entity to load; those with no stored rows
    yet start ``backfill`` before ``as_of``.
    """
    c = clamp_watermark(wm, as_of, step)
    nxt = F.col("last_ts") + F.expr(step)
    out = c.select("*", nxt.alias("next_ts"), F.to_date(nxt).alias("from_date"), F.to_date(as_of).alias("to_date"),
                   (nxt <= as_of).alias("due"))
    if entities is not None:
        keys = [c for c in wm.columns if c != "last_ts"]
        fresh = join_on_keys(entities.select(*keys).distinct(), wm.select(*keys), keys, "left_anti")
        start = as_of - F.expr(backfill)
        out = out.unionByName(fresh.select(
            *keys, F.lit(None).cast("timestamp").alias("last_ts"), start.alias("next_ts"),
            F.to_date(start).alias("from_date"), F.to_date(as_of).alias("to_date"), F.lit(True).alias("due")))
    return out


def split_incoming(landed: DataFrame, wm: DataFrame, spec: SeriesSpec, tolerance: str | None = None,
                   as_of: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(fresh rows with ts > watermark, late rows at or before it) for a landed batch.

    Entities without a watermark are new: all their rows are fresh; a NULL entity is an entity like any other.
    Rows without a time are late where their entity has a watermark (no time puts them after it), so each
    landed row is on exactly one side. ``tolerance``
    (e.g. "INTERVAL 2 HOURS") lowers the cut so slightly late rows still count as fresh. With
    ``as_of`` (the load's clock) a watermark ahead of it is clamped first, so one row stamped
    in the future does not make every later row late.
    """
    if as_of is not None:
        wm = clamp_watermark(wm, as_of)
    j = join_on_keys(landed, wm.select(*spec.entity, F.col("last_ts").alias("_wm")), spec.entity).select(*landed.columns, "_wm")
    cut = F.col("_wm") - F.expr(tolerance) if tolerance else F.col("_wm")
    fresh = F.col("_wm").isNull() | F.coalesce(F.col(spec.ts) > cut, F.lit(False))
    return j.filter(fresh).drop("_wm"), j.filter(~fresh).drop("_wm")


def _resolve(df: DataFrame, key: Sequence[str], order: Sequence[Column], pick: str) -> DataFrame:
    rest = [c for c in df.columns if c not in set(key)]  # the grouping key is not carried twice
    row = F.struct(*[F.col(c) for c in rest])
    agg = F.min_by(row, F.struct(*order)) if pick == "first" else F.max_by(row, F.struct(*order))
    out = df.groupBy(*key).agg(agg.alias("_r"))
    return out.select(*[F.col(c) if c in set(key) else F.col("_r")[c].alias(c) for c in df.columns])


def dedup_keep_first(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one with the smallest ``order`` values."""
    return _resolve(df, key, [F.col(c) for c in order], "first")


def keep_latest(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one with the largest ``order`` values."""
    return _resolve(df, key, [F.col(c) for c in order], "last")


def union_keep_first(existing: DataFrame | None, new: DataFrame, key: Sequence[str],
                     order: Sequence[str] = ()) -> DataFrame:
    """Append ``new`` to ``existing`` (which may be absent) and keep the first row per key; existing rows win."""
    if existing is None:
        return dedup_keep_first(new, key, order) if order else new.dropDuplicates(list(key))
    both = (existing.withColumn(_SRC, F.lit(0))
            .unionByName(new.withColumn(_SRC, F.lit(1)), allowMissingColumns=True))
    return _resolve(both, key, [F.col(_SRC), *[F.col(c) for c in order]], "first").drop(_SRC)


def upsert_latest(existing: DataFrame, new: DataFrame, key: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Keyed insert: rows of ``new`` replace rows of ``existing`` with the same key."""
    both = (existing.withColumn(_SRC, F.lit(0))
            .unionByName(new.withColumn(_SRC, F.lit(1)), allowMissingColumns=True))
    return _resolve(both, key, [F.col(_SRC), *[F.col(c) for c in order]], "last").drop(_SRC)


def merge_by_order(existing: DataFrame, new: DataFrame, key: Sequence[str], order: Sequence[str],
                   pick: str = "first") -> DataFrame:
    """Union and keep, per key, the row with the smallest (``first``) or largest (``last``) ``order``.

    Which side a row came from does not matter, so the result is the same for
    any arrival order or batch split.
    """
    both = existing.unionByName(new, allowMissingColumns=True)
    return _resolve(both, key, [F.col(c) for c in order], pick)

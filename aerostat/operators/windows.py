"""Order-dependent series operators (lag, rolling, diff, percent change, fill, sequences).

Every window is partitioned by the series entity. When a series is split, its
windows are partitioned by ``(entity, bucket)`` instead, and each bucket
receives the last ``context_rows`` rows that precede it (from earlier buckets
of the same entity) as *context rows*. Context rows take part in the window
frames but are dropped from the output, so lags and rolling frames of up to
``context_rows`` rows are exact while one very large series is spread over many
tasks. Forward fill, which looks back without bound, gets an exact carry-in
value per bucket from the same small per-bucket table.

The per-bucket table holds at most ``context_rows`` rows per (entity, bucket);
context is gathered from the previous ``context_rows`` non-empty buckets, which
always hold at least that many rows, so nothing is capped. Frames that look
ahead (``lead``) get the first ``lead_rows`` rows of the following buckets the
same way.

Buckets come from the data: entities with at least ``hot_rows`` rows (exact
counts, any number of entities, NULL included) are cut at every ~``hot_rows``-th
row of their full row order (time and tie-break), found from a sample by a
hash of the row's key. So a burst within one second is cut like a long
history, and no bucket grows with the data. The cuts of all entities make one
sorted table of boundaries (at most ``MAX_CUTS``, held as one value); a row finds
its ordered partition there by a four-way search, a fixed number of comparisons
inside generated code, without a join. The rows are shuffled once, by (entity, bucket);
all that a bucket needs of its neighbours comes as rows of the small per-bucket
table in the same partition. With ``hot_rows`` 0 every entity is cut into time
buckets of the width ``bucket``. NULL times come last everywhere. The plain
one-shuffle window is used where nothing needs a cut; a table whose size rules
out a hot entity is not even counted. Both plans give the same rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from aerostat.schemas import SeriesSpec

_BK = "_bk"
_CTX = "_ctx"
_CARRY = "_carry__"

_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 7 * 86400}
_LAST_BUCKET = 2**62  # of rows without a time
_CUT_SAMPLE = 32  # sampled rows per bucket that place its cut
MAX_CUTS = 100_000  # boundaries held as one value; with more hot rows than that many buckets, buckets grow instead
ROW_BYTES = 4  # a stored row of a series (key, time and a value) is taken to have at least this size


def bucket_seconds(bucket: str) -> int:
    m = re.fullmatch(r"\s*(\d+)\s*(second|minute|hour|day|week)s?\s*", bucket)
    if not m:
        raise ValueError(f"bucket must look like '1 day' or '6 hours', got {bucket!r}")
    return int(m.group(1)) * _UNITS[m.group(2)]


def bucket_of(ts: Column, bucket: str) -> Column:
    """Integer bucket id, monotone in ``ts``; NULL times have the last one."""
    b = F.floor(F.unix_micros(ts) / F.lit(bucket_seconds(bucket) * 1_000_000)).cast("long")
    return F.coalesce(b, F.lit(_LAST_BUCKET))


def comparable(cols: Sequence[str]) -> Column:
    return F.struct(*[x for i, c in enumerate(cols) for x in (F.col(c).isNull().alias(f"n{i}"), F.col(c).alias(f"v{i}"))])


def order_key(spec: SeriesSpec) -> Column:
    """One comparable value in row order: NULLs last in every column."""
    return comparable(spec.order_cols)


def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join in which NULL keys meet; the keys come from the left side."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    out = left.join(renamed, cond, how)
    return out if how in ("left_semi", "left_anti") else out.drop(*[f"_r_{k}" for k in keys])


def entity_counts(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Entities with at least ``spec.hot_rows`` rows (a map-side combined count of the key column)."""
    return df.groupBy(*spec.entity).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= spec.hot_rows)


def may_be_hot(df: DataFrame, spec: SeriesSpec) -> bool:
    """False where the optimizer's size of ``df`` leaves no room for ``hot_rows`` rows; chooses a plan, never a result."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) >= spec.hot_rows * ROW_BYTES


def find_cuts(df: DataFrame, spec: SeriesSpec) -> pa.Table | None:
    """The boundaries ``at`` (entity and row key, comparable) and ``i`` (their number within the entity), or None.

    One job over the key columns. Where there would be more than ``MAX_CUTS``, buckets are made larger.
    """
    if spec.bucket is None or not spec.hot_rows or not may_be_hot(df, spec):
        return None
    wide = spec
    while True:
        points = cut_points(df, wide).select(comparable(spec.entity).alias("e"), F.posexplode("_cuts").alias("i", "k"))
        found = points.select(F.struct("e", "k").alias("at"), (F.col("i") + 1).cast("long").alias("i")).limit(MAX_CUTS + 1).toArrow()
        if found.num_rows <= MAX_CUTS:
            return found if found.num_rows else None
        wide = wide.with_(hot_rows=wide.hot_rows * 4)


def needs_cuts(df: DataFrame, spec: SeriesSpec) -> bool:
    """Whether any entity has to be split."""
    return spec.bucket is not None and (not spec.hot_rows or find_cuts(df, spec) is not None)


def cut_points(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Per hot entity the sorted row keys at which a new bucket starts (about one per ``hot_rows`` rows)."""
    share = min(1.0, _CUT_SAMPLE / spec.hot_rows)
    place = F.pmod(F.xxhash64(*spec.order_cols), F.lit(1 << 30))
    sample = df.select(*spec.entity, order_key(spec).alias("_k")).filter(place < F.lit(int(share * (1 << 30))))
    hot = join_on_keys(sample, entity_counts(df, spec), spec.entity, "inner").drop("_n")
    rank = F.row_number().over(Window.partitionBy(*spec.entity).orderBy("_k"))
    every = max(1, int(spec.hot_rows * share))
    cuts = hot.withColumn("_i", rank).filter(F.col("_i") % every == 0)
    return cuts.groupBy(*spec.entity).agg(F.array_sort(F.collect_list("_k")).alias("_cuts"))


def series_bucket(df: DataFrame, spec: SeriesSpec, cuts: pa.Table | None = None) -> DataFrame:
    """Add the bucket id: cuts of hot entities (time buckets of all when ``hot_rows`` is 0), 0 for the rest.

    The boundaries are one sorted array in a scalar subquery. Each step of the search is a column of
    its own that the next one reads several times, so the steps stay apart and run inside generated code.
    """
    if not spec.hot_rows:
        return df.withColumn(_BK, bucket_of(F.col(spec.ts), spec.bucket))
    cuts = cuts if cuts is not None else find_cuts(df, spec)
    if cuts is None:
        return df.withColumn(_BK, F.lit(0).cast("long"))
    names, n = df.columns, cuts.num_rows
    table = df.sparkSession.createDataFrame(cuts).agg(F.array_sort(F.collect_list(F.struct("at", "i"))).alias("b")).scalar()
    out = df.withColumn("_at", F.struct(comparable(spec.entity).alias("e"), order_key(spec).alias("k"))).withColumn("_p0", F.lit(0))
    steps = [1 << b for b in range((n.bit_length() - 1) // 2 * 2, -1, -2)]  # four ways at a time
    for i, step in enumerate(steps):
        here = F.col(f"_p{i}")
        passed = [F.get(table, here + (way * step - 1))["at"] < F.col("_at") for way in (1, 2, 3)]
        out = out.select(*names, "_at", F.when(passed[2], here + 3 * step).when(passed[1], here + 2 * step)
                         .when(passed[0], here + step).otherwise(here).alias(f"_p{i + 1}"))
    last = F.get(table, F.col(f"_p{len(steps)}") - 1)
    own = F.coalesce(last["at"]["e"] == F.col("_at")["e"], F.lit(False))
    return out.withColumn(_BK, F.when(own, last["i"]).otherwise(F.lit(0).cast("long"))).select(*names, _BK)


def ordered(spec: SeriesSpec, extra_partition: Sequence[str] = ()) -> WindowSpec:
    return Window.partitionBy(*spec.entity, *extra_partition).orderBy(*[F.col(c).asc_nulls_last() for c in spec.order_cols])


def trailing(w: WindowSpec, n: int) -> WindowSpec:
    """The current row and the n-1 rows before it."""
    return w.rowsBetween(-(n - 1), 0)


@dataclass
class WindowContext:
    """What a feature builder gets: the ordered window and exact fill helpers."""

    w: WindowSpec
    part: WindowSpec
    bucketed: bool
    ffill_cols: tuple[str, ...] = ()

    def lag(self, c: str | Column, k: int) -> Column:
        return F.lag(c, k).over(self.w)

    def guarded(self, fn: Callable[[Column], Column], c: str, n: int) -> Column:
        """``fn`` over the last n rows, NULL unless all n rows are present and non-null."""
        fr = trailing(self.w, n)
        col = F.col(c)
        return F.when(F.count(col).over(fr) == F.lit(n), fn(col).over(fr))

    def _carry(self, c: str) -> Column:
        return F.max(F.col(_CARRY + c)).over(self.part)

    def ffill(self, c: str) -> Column:
        """Last non-null value at or before the row."""
        if not self.bucketed:
            return F.last(F.col(c), ignorenulls=True).over(self.w.rowsBetween(Window.unboundedPreceding, 0))
        own = F.when(~F.col(_CTX), F.col(c))
        return F.coalesce(F.last(own, ignorenulls=True).over(self.w.rowsBetween(Window.unboundedPreceding, 0)),
                          self._carry(c))

    def padded_prev(self, c: str) -> Column:
        """Last non-null value strictly before the row."""
        if not self.bucketed:
            return F.last(F.col(c), ignorenulls=True).over(self.w.rowsBetween(Window.unboundedPreceding, -1))
        own = F.when(~F.col(_CTX), F.col(c))
        return F.coalesce(F.last(own, ignorenulls=True).over(self.w.rowsBetween(Window.unboundedPreceding, -1)),
                          self._carry(c))


Stage = Callable[[WindowContext], dict[str, Column]]


def windowed(df: DataFrame, spec: SeriesSpec, stages: Sequence[Stage], context_rows: int = 24,
             context_cols: Sequence[str] | None = None, ffill_cols: Sequence[str] = (),
             lead_rows: int = 0) -> DataFrame:
    """Apply window ``stages`` (each a dict of new columns) to every series.

    Later stages may read columns produced by earlier ones. ``context_cols`` are
    the input columns the stages read through lag/rolling frames; only they are
    shipped as context (default: all columns). ``ffill_cols`` are the columns
    the stages forward-fill or pad. ``lead_rows`` is how far frames look ahead
    (``lead``); the first rows of the following buckets are then shipped too.
    """
    ffill_cols = tuple(ffill_cols)
    cuts = find_cuts(df, spec)
    if spec.bucket is None or (spec.hot_rows and cuts is None):
        ctx = WindowContext(ordered(spec), Window.partitionBy(*spec.entity), False, ffill_cols)
        out = df
        for st in stages:
            out = out.withColumns(st(ctx))
        return out

    k = max(int(context_rows), 1)
    cols = df.columns
    key = [*spec.entity, _BK]
    shipped = list(dict.fromkeys([*spec.order_cols, *(context_cols if context_cols is not None else cols),
                                  *ffill_cols]))
    shipped = [c for c in shipped if c not in spec.entity]
    # One shuffle of the rows on (entity, bucket). The tail ranking below reads the same
    # exchange (reused), and the context rows are partitioned identically, so the union
    # keeps this partitioning and the final window needs no second shuffle of the rows.
    based = series_bucket(df, spec, cuts).repartition(*key)

    # Per (entity, bucket): its last k rows and the last non-null value of each filled column.
    desc = Window.partitionBy(*key).orderBy(*[F.col(c).desc_nulls_first() for c in spec.order_cols])
    need = set(key) | set(shipped)
    narrow = based.select(*[c for c in based.columns if c in need]).withColumn("_rd", F.row_number().over(desc))
    row = F.struct(order_key(spec).alias("_k"), *[F.col(c) for c in shipped])  # sorts in row order, NULL times last
    aggs = [F.collect_list(F.when(F.col("_rd") <= k, row)).alias("_tail")]
    if lead_rows:
        # position from the start = bucket size - position from the end + 1 (same partition, no new sort)
        narrow = narrow.withColumn("_ra", F.count(F.lit(1)).over(Window.partitionBy(*key)) - F.col("_rd") + 1)
        aggs.append(F.collect_list(F.when(F.col("_ra") <= lead_rows, row)).alias("_head"))
    for c in ffill_cols:
        aggs.append(F.max_by(F.col(c), F.when(F.col(c).isNotNull(), order_key(spec))).alias("_lnn_" + c))
    per_bucket = narrow.groupBy(*key).agg(*aggs)

    # Context for bucket b: last k rows of the previous k non-empty buckets; carry-in: last non-null before b.
    wb = Window.partitionBy(*spec.entity).orderBy(_BK)
    prev = F.flatten(F.collect_list("_tail").over(wb.rowsBetween(-k, -1)))
    sel = [*key, F.sort_array(prev).alias("_prev")]
    for c in ffill_cols:
        sel.append(F.last("_lnn_" + c, ignorenulls=True).over(wb.rowsBetween(Window.unboundedPreceding, -1))
                   .alias(_CARRY + c))
    if lead_rows:
        nxt = F.flatten(F.collect_list("_head").over(wb.rowsBetween(1, lead_rows)))
        sel.append(F.slice(F.sort_array(nxt), 1, lead_rows).alias("_next"))
    bt = per_bucket.select(*sel)
    bt = bt.withColumn("_prev", F.slice("_prev", F.greatest(F.size("_prev") - F.lit(k - 1), F.lit(1)), k))
    if lead_rows:
        bt = bt.withColumn("_prev", F.concat("_prev", "_next")).drop("_next")

    ctx_rows = bt.select(*key, *[F.col(_CARRY + c) for c in ffill_cols], F.explode("_prev").alias("_r"))
    ctx_rows = ctx_rows.select(
        *[F.col(c) for c in spec.entity],
        *[(F.col("_r")[c] if c in shipped else F.lit(None).cast(df.schema[c].dataType)).alias(c)
          for c in cols if c not in spec.entity],
        F.col(_BK), F.lit(True).alias(_CTX), *[F.col(_CARRY + c) for c in ffill_cols])

    ctx_rows = ctx_rows.repartition(*key)
    real = based.withColumn(_CTX, F.lit(False))
    for c in ffill_cols:
        real = real.withColumn(_CARRY + c, F.lit(None).cast(df.schema[c].dataType))
    both = real.unionByName(ctx_rows.select(*real.columns))

    ctx = WindowContext(ordered(spec, [_BK]), Window.partitionBy(*key), True, ffill_cols)
    out = both
    for st in stages:
        out = out.withColumns(st(ctx))
    return out.filter(~F.col(_CTX)).drop(_BK, _CTX, *[_CARRY + c for c in ffill_cols])


# --------------------------------------------------------------------------
# Feature stages
# --------------------------------------------------------------------------

def lag_stage(col: str, lags: Sequence[int], name: Callable[[int], str]) -> Stage:
    return lambda cx: {name(k): cx.lag(col, k) for k in lags}


def rolling_stage(col: str, fn: str, sizes: Sequence[int], name: Callable[[int], str]) -> Stage:
    fns = {"mean": F.avg, "std": F.stddev_samp, "max": F.max, "min": F.min, "sum": F.sum}
    return lambda cx: {name(n): cx.guarded(fns[fn], col, n) for n in sizes}


def change_stages(col: str, diff_name: str, pct_name: str) -> list[Stage]:
    """First difference (no padding) and percent change on forward-padded values.

    Percent change of a zero base is NULL (the reference yields infinity).
    """
    def first(cx: WindowContext):
        return {diff_name: F.col(col) - cx.lag(col, 1),
                "_pad_cur": cx.ffill(col), "_pad_prev": cx.padded_prev(col)}

    def second(cx: WindowContext):
        return {pct_name: F.lit(100.0) * F.try_divide(F.col("_pad_cur") - F.col("_pad_prev"), F.col("_pad_prev"))}

    return [first, second]


def sequence_stage(cols: Sequence[str], lookback: int, name: str = "x") -> Stage:
    """The ``lookback`` rows before the current one, as an ordered array of structs."""
    def st(cx: WindowContext):
        fr = cx.w.rowsBetween(-lookback, -1)
        return {name: F.collect_list(F.struct(*[F.col(c) for c in cols])).over(fr)}
    return st


def lag_features(df, spec: SeriesSpec, col: str, lags: Sequence[int], prefix: str) -> DataFrame:
    return windowed(df, spec, [lag_stage(col, lags, lambda k: f"{prefix}_lag_{k}")],
                    context_rows=max(lags), context_cols=[col])


def rolling_features(df, spec: SeriesSpec, col: str, fn: str, sizes: Sequence[int], prefix: str) -> DataFrame:
    return windowed(df, spec, [rolling_stage(col, fn, sizes, lambda n: f"{prefix}_rolling_{fn}_{n}")],
                    context_rows=max(sizes), context_cols=[col])


def change_features(df, spec: SeriesSpec, col: str, prefix: str) -> DataFrame:
    out = windowed(df, spec, change_stages(col, f"{prefix}_change", f"{prefix}_change_rate"),
                   context_rows=1, context_cols=[col], ffill_cols=[col])
    return out.drop("_pad_cur", "_pad_prev")


def forward_fill(df, spec: SeriesSpec, cols: Sequence[str], zero_fill: bool = True) -> DataFrame:
    """Forward fill each column within its series, then (optionally) zero-fill what is left."""
    def st(cx: WindowContext):
        out = {}
        for c in cols:
            v = cx.ffill(c)
            out[c] = F.coalesce(v, F.lit(0).cast(df.schema[c].dataType)) if zero_fill else v
        return out
    return windowed(df, spec, [st], context_rows=1, context_cols=[], ffill_cols=cols)


def lookback_sequences(df, spec: SeriesSpec, cols: Sequence[str], lookback: int, label: str) -> DataFrame:
    """One row per position with a full lookback: x = previous ``lookback`` rows, y = current label."""
    out = windowed(df, spec, [sequence_stage(cols, lookback)], context_rows=lookback, context_cols=cols)
    return out.filter(F.size("x") == lookback).select(*spec.entity, *spec.order_cols, "x", F.col(label).alias("y"))

"""As-of reads: latest row, last n rows, recent trend, staleness, minimum history, seeded sample.

One rule for rows without a time: they are neither first nor last. Every read
here prefers rows with a time; a row without one is taken (or ranked) only after
all that have one, from either end. ``first_row``, ``latest_row`` and
``last_n(1)`` agree on that, and likewise on a missing tie-break. With ``as_of``
rows without a time are not in the past; a NULL entity is a series like any other.

"Last n rows" never brings a hot entity to one task: a rank that is filtered to
its first n values is cut down to n rows per entity in every task before the
shuffle (Spark does so up to ``MAP_SIDE_ROWS``; above that, ranks are taken per
entity and salt first, which no hot entity's rows share).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from aerostat.functions.scalar import age_seconds, is_stale
from aerostat.operators.windows import order_key
from aerostat.schemas import SeriesSpec

MAP_SIDE_ROWS = 1000  # Spark's own limit of a rank that is cut down before the shuffle
SALTS = 256


def not_after(df: DataFrame, spec: SeriesSpec, as_of: Column | None) -> DataFrame:
    return df if as_of is None else df.filter(F.col(spec.ts) <= as_of)


def latest_row(df: DataFrame, spec: SeriesSpec, as_of: Column | None = None, fallback: bool = True) -> DataFrame:
    """Per entity, the last row at or before ``as_of``.

    With ``fallback`` an entity with no such row yields its last row overall.
    One aggregate (``max_by``), combined map-side.
    """
    cols = [c for c in df.columns if c not in spec.entity]
    row = F.struct(*[F.col(c) for c in cols])
    if as_of is None:
        order = F.struct(*[F.col(c) for c in spec.order_cols])
        src = df
    elif fallback:
        order = F.struct((F.col(spec.ts) <= as_of).alias("_past"), *[F.col(c) for c in spec.order_cols])
        src = df
    else:
        order = F.struct(*[F.col(c) for c in spec.order_cols])
        src = not_after(df, spec, as_of)
    return src.groupBy(*spec.entity).agg(F.max_by(row, order).alias("_r")).select(*spec.entity, "_r.*")


def first_row(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Per entity, its earliest row (e.g. the input example stored with a model)."""
    cols = [c for c in df.columns if c not in spec.entity]
    return (df.groupBy(*spec.entity).agg(F.min_by(F.struct(*[F.col(c) for c in cols]), order_key(spec)).alias("_r"))
            .select(*spec.entity, "_r.*"))


def last_n(df: DataFrame, spec: SeriesSpec, n: int, as_of: Column | None = None,
           rank_col: str = "rank_from_end") -> DataFrame:
    """The last ``n`` rows of each series (at or before ``as_of``), with their rank from the end (1 = last)."""
    past = not_after(df, spec, as_of)
    back = [F.col(c).desc_nulls_last() for c in spec.order_cols]

    def ranked(rows: DataFrame, *salt: str) -> DataFrame:
        w = Window.partitionBy(*spec.entity, *salt).orderBy(*back)
        return rows.withColumn(rank_col, F.row_number().over(w).cast("int")).filter(F.col(rank_col) <= n)

    if n > MAP_SIDE_ROWS:
        salted = past.withColumn("_salt", F.pmod(F.xxhash64(*spec.order_cols), F.lit(SALTS)))
        past = ranked(salted, "_salt").drop("_salt", rank_col)
    return ranked(past)


def recent_summary(df: DataFrame, spec: SeriesSpec, col: str, n: int = 24, back: int = 6,
                   as_of: Column | None = None) -> DataFrame:
    """Mean of the last ``n`` values and the trend: last value above the ``back``-th last -> increasing."""
    tail = last_n(df, spec, max(n, back), as_of)
    agg = tail.groupBy(*spec.entity).agg(
        F.avg(F.when(F.col("rank_from_end") <= n, F.col(col))).alias("recent_avg"),
        F.max(F.when(F.col("rank_from_end") == 1, F.col(spec.ts))).alias("last_ts"),
        F.max(F.when(F.col("rank_from_end") == 1, F.col(col))).alias("last_value"),
        F.max(F.when(F.col("rank_from_end") == back, F.col(col))).alias("back_value"),
        F.count(F.lit(1)).alias("n_recent"))
    trend = (F.when(F.col("back_value").isNull() | F.col("last_value").isNull(), F.lit(None).cast("string"))
             .when(F.col("last_value") > F.col("back_value"), F.lit("increasing")).otherwise(F.lit("decreasing")))
    return agg.withColumn("trend", trend)


def staleness(latest: DataFrame, ts: str, as_of: Column, max_age_seconds: int) -> DataFrame:
    return latest.withColumns({"age_seconds": age_seconds(F.col(ts), as_of),
                               "is_stale": is_stale(F.col(ts), as_of, max_age_seconds)})


def history_size(df: DataFrame, spec: SeriesSpec, min_rows: int, as_of: Column | None = None) -> DataFrame:
    """Per entity row count and whether it reaches ``min_rows`` (a plain grouped count)."""
    c = not_after(df, spec, as_of).groupBy(*spec.entity).agg(F.count(F.lit(1)).alias("n_rows"))
    return c.withColumn("eligible", F.col("n_rows") >= F.lit(min_rows))


def sample_hash(key_cols: Sequence[str], seed: int) -> Column:
    return F.md5(F.concat_ws(":", *[F.col(c).cast("string") for c in key_cols], F.lit(str(seed))))


def hash_sample(df: DataFrame, key_cols: Sequence[str], n: int, seed: int) -> DataFrame:
    """n rows chosen by a seeded hash of the key: the same rows under any partitioning.

    Planned as a per-partition top-n followed by one merge (TakeOrderedAndProject).
    """
    h = sample_hash(key_cols, seed)
    return df.withColumn("sample_key", h).orderBy("sample_key", *key_cols).limit(n)

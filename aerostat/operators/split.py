"""Time-ordered train/test split: the first floor(f * n) rows of each series train, the rest test.

Where an entity is big enough to need splitting (see ``SeriesSpec.hot_rows``),
the per-row rank is never computed over a whole series: rows are counted per
(entity, bucket), positions are prefix sums over that small table, and ranks
are computed inside each bucket only; the rows are shuffled once. Otherwise one window per entity does it in a single shuffle. NULL times
come last and a NULL entity is a series like any other, in both plans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType, TimestampType

from aerostat.operators.windows import comparable, find_cuts, order_key, ordered, series_bucket
from aerostat.schemas import SeriesSpec, TRAIN_FRACTION


def time_split(df: DataFrame, spec: SeriesSpec, fraction: float = TRAIN_FRACTION, bucket: str = "1 day",
               col: str = "split") -> DataFrame:
    bspec = spec if spec.bucket or not spec.hot_rows else spec.with_(bucket=bucket)
    we = Window.partitionBy(*spec.entity)
    cuts = find_cuts(df, bspec)
    if bspec.bucket is None or (bspec.hot_rows and cuts is None):
        # no entity is big enough to need splitting: one window per entity
        pos = F.row_number().over(ordered(spec))
        cut = F.floor(F.lit(fraction) * F.count(F.lit(1)).over(we))
        return df.withColumn(col, F.when(pos <= cut, F.lit("train")).otherwise(F.lit("test")))
    key, names = [*spec.entity, "_bk"], df.columns
    b = series_bucket(df, bspec, cuts).repartition(*key)
    counts = b.groupBy(*key).agg(F.count(F.lit(1)).alias("_m"))
    wb = we.orderBy("_bk")
    # per bucket one row with the number of rows before it and the series' cut; it travels with the bucket's rows
    marks = counts.select(
        *key, F.coalesce(F.sum("_m").over(wb.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.floor(F.lit(fraction) * F.sum("_m").over(we)).cast("long").alias("_cut")).repartition(*key)
    none = {c: F.lit(None).cast(df.schema[c].dataType) for c in names if c not in spec.entity}
    real = b.withColumns({"_before": F.lit(None).cast("long"), "_cut": F.lit(None).cast("long")})
    both = real.unionByName(marks.withColumns(none).select(*real.columns))
    part = Window.partitionBy(*key)
    own = F.sum(F.when(F.col("_cut").isNull(), 1).otherwise(0)).over(ordered(spec, ["_bk"]).rowsBetween(Window.unboundedPreceding, 0))
    train = F.max("_before").over(part) + own <= F.max("_cut").over(part)
    return (both.withColumn(col, F.when(train, F.lit("train")).otherwise(F.lit("test")))
            .filter(F.col("_cut").isNull()).drop("_bk", "_before", "_cut"))


# Items kept per level of the quantile sketch: its ranks are then within about 0.2 % of the rows with 99 % confidence.
SKETCH_K = 4096
SKETCH_MARGIN = 0.004    # half width of the bracket, as a fraction of the rows it is drawn from
SAMPLE_ROWS = 4096       # sampled rows that give the bracket on columns without an integer form
SAMPLE_MARGIN = 0.05
FINAL_BUCKET_ROWS = 200_000  # rows ranked directly (bounded top-k) once the bracket is this small


def _integer_form(df: DataFrame, name: str):
    """The column as a long in the same order and its way back, or None where it has no integer form."""
    kind = df.schema[name].dataType
    if isinstance(kind, TimestampType):
        return F.unix_micros(name), lambda v: F.timestamp_micros(F.lit(v))
    if isinstance(kind, (ByteType, ShortType, IntegerType, LongType)):
        return F.col(name).cast("long"), lambda v: F.lit(v).cast(kind)
    return None


def _quantiles(p: float, margin: float) -> tuple[float, float]:
    return max(0.0, p - margin), min(1.0, p + margin)


def _sampled_bracket(cand: DataFrame, name: str, p: float, narrow: bool):
    """Two values of the column around its quantile p, from a bounded sample ordered by Spark."""
    rows = cand.filter(F.col(name).isNotNull()).select(name).orderBy(F.rand(42)).limit(SAMPLE_ROWS).orderBy(name).collect()
    a, b = (p, p) if narrow else _quantiles(p, SAMPLE_MARGIN)
    at = [min(int(q * len(rows)), len(rows) - 1) for q in (a, b)]
    return tuple(F.lit(rows[i][0]).cast(cand.schema[name].dataType) for i in at)


def global_cut_key(df: DataFrame, spec: SeriesSpec, fraction: float = TRAIN_FRACTION) -> tuple | None:
    """The key (ts, order...) of the last training row of the whole table in row order, without a global sort.

    One pass counts the rows and makes a mergeable quantile sketch (KLL) of the time, which gives a bracket of two
    times around the cut. The next pass counts exactly the rows before and inside the bracket and sketches those inside,
    so the rank stays exact whatever the sketch says: a bracket that missed only leaves more rows to the next pass.
    Passes after that read the bracket only, as a filter on the column that reaches the files. A bracket of
    at most ``FINAL_BUCKET_ROWS`` rows is ranked directly. Where more rows than that share one time, or have none, the
    same goes on among them with the next order column, down to rows that are equal in all of them. The driver gets a
    row per pass (on a string column ``SAMPLE_ROWS`` values as well). Rows without a time come last.
    """
    cand, key = df.select(*spec.order_cols), []
    rank = None  # of the wanted row among ``cand``, from 1
    for name in spec.order_cols:
        c, form = F.col(name), _integer_form(df, name)
        sketch = F.kll_sketch_agg_bigint(form[0], F.lit(SKETCH_K)) if form else F.lit(None)
        first = cand.agg(F.count(F.lit(1)).alias("n"), F.count(c).alias("real"), sketch.alias("s")).select("n", "real", "s").first()
        n, real, kept = first["n"], first["real"], first["s"]
        if rank is None:
            rank = int(fraction * n)
            if rank <= 0:
                return None
        if n <= FINAL_BUCKET_ROWS:
            break
        if rank > real:  # the cut lies among the rows without a value
            rank, cand = rank - real, cand.filter(c.isNull())
            key.append(None)
            continue
        cand, n, narrow = cand.filter(c.isNotNull()), real, False
        while n > FINAL_BUCKET_ROWS:
            if form:
                p = rank / n
                a, b = (p, p) if narrow else _quantiles(p, SKETCH_MARGIN)
                lo, hi = (form[1](int(v)) for v in _sketch_values(df.sparkSession, kept, (a, b)))
            else:
                lo, hi = _sampled_bracket(cand, name, rank / n, narrow)
            side = F.when(c < lo, 0).when(c <= hi, 1).otherwise(2)
            parts = {r["side"]: r for r in cand.groupBy(side.alias("side")).agg(
                F.count(F.lit(1)).alias("n"), F.min(c).alias("lo"), F.max(c).alias("hi"), sketch.alias("s")).collect()}
            for i, inside in enumerate((c < lo, (c >= lo) & (c <= hi), c > hi)):
                m = parts[i]["n"] if i in parts else 0
                if rank <= m:
                    break
                rank -= m
            narrow = m == n  # nothing was cut off: next time at one value
            cand, n, kept = cand.filter(inside), m, parts[i]["s"]
            if parts[i]["lo"] == parts[i]["hi"]:
                break
        else:
            break
        key.append(parts[i]["lo"])  # one value left: go on with the next column
    else:
        return tuple(key)  # equal in all columns
    rest = spec.order_cols[len(key):]
    order = [F.col(c).asc_nulls_last() for c in rest]
    row = cand.select(*rest).orderBy(*order).limit(rank).agg(F.max(comparable(rest)).alias("m")).first()["m"]
    return (*key, *[row[2 * i + 1] for i in range(len(rest))])


def _sketch_values(spark, sketch: bytes, ranks: tuple[float, float]) -> list[int]:
    one = spark.range(1).select(F.kll_sketch_get_quantile_bigint(F.lit(bytearray(sketch)), F.array(*map(F.lit, ranks))).alias("q"))
    return one.first()["q"]


def global_time_split(df: DataFrame, spec: SeriesSpec, fraction: float = TRAIN_FRACTION,
                      col: str = "split") -> DataFrame:
    """First floor(f * n) rows of the whole table (all entities together, time order) train, the rest test."""
    key = global_cut_key(df, spec, fraction)
    if key is None:
        return df.withColumn(col, F.lit("test"))
    lit_key = F.struct(*[x for i, (c, v) in enumerate(zip(spec.order_cols, key))
                         for x in (F.lit(v is None).alias(f"n{i}"), F.lit(v).cast(df.schema[c].dataType).alias(f"v{i}"))])
    return df.withColumn(col, F.when(order_key(spec) <= lit_key, F.lit("train")).otherwise(F.lit("test")))

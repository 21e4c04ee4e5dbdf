"""Recursive multi-step forecasts, horizon-wise backtests and error tables.

The forecast model here is the autoregression on the trailing 3-row mean,
``y[t+1] = a + b * mean(y[t-2..t])``, fitted by least squares. Because it is
linear, the h-step recursive forecast is an affine function of the last three
values; its coefficients for every horizon come from folding the recursion
once over a tiny table, so a backtest over every origin row is a projection
plus one broadcast join against a table of (number of horizons) rows.
Tree models recurse through :func:`recursive_with_model` instead.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from aerostat.functions.scalar import fmt
from aerostat.operators.asof import history_size, last_n, not_after
from aerostat.operators.windows import forward_fill, join_on_keys, windowed
from aerostat.schemas import (DEFAULT_BASE_RMSE, FORECAST_HISTORY_ROWS, FORECAST_HOURS, FORECAST_MIN_ROWS,
                              HORIZON_ERROR_GROWTH, SeriesSpec)


def timed(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Rows without a time have no place on a grid: they take no part in forecasts."""
    return df.filter(F.col(spec.ts).isNotNull())


def ar3_training_rows(df: DataFrame, spec: SeriesSpec, target: str) -> DataFrame:
    """Rows with x = trailing 3-row mean (all three present) and y = next value."""
    def st(cx):
        fr = cx.w.rowsBetween(-2, 0)
        return {"_x": F.when(F.count(target).over(fr) == 3, F.avg(target).over(fr)),
                "_y": F.lead(target, 1).over(cx.w)}
    return windowed(timed(df, spec), spec, [st], context_rows=3, context_cols=[target], lead_rows=1)


def fit_ar3(rows: DataFrame) -> tuple[Column, Column]:
    """(intercept, slope) as lazy scalar subqueries (least squares of _y on _x)."""
    fit = rows.agg(F.struct(F.regr_intercept("_y", "_x").alias("a"), F.regr_slope("_y", "_x").alias("b")).alias("f"))
    f = fit.scalar()  # one subquery, referenced twice -> computed once (subquery reuse)
    return f["a"], f["b"]


def _fold_sql(hours: int, a: str, b: str) -> str:
    """SQL text of the recursion folded ``hours`` times over the state (w1, w2, w3, preds).

    One expression string, so the plan is built with one JVM call.
    """
    step = f"{a} + {b} * ((s.w1 + s.w2 + s.w3) / 3.0D)"
    return (f"aggregate(sequence(1, {hours}), "
            f"named_struct('w1', CAST(w1 AS DOUBLE), 'w2', CAST(w2 AS DOUBLE), 'w3', CAST(w3 AS DOUBLE), "
            f"'preds', CAST(array() AS ARRAY<DOUBLE>)), "
            f"(s, i) -> named_struct('w1', s.w2, 'w2', s.w3, 'w3', {step}, 'preds', concat(s.preds, array({step}))))")


def forecast_state(df: DataFrame, spec: SeriesSpec, target: str, as_of: Column | None = None,
                   history: int = FORECAST_HISTORY_ROWS, min_rows: int = FORECAST_MIN_ROWS) -> DataFrame:
    """Per entity with at least ``min_rows`` past rows: last timestamp and the last three values.

    ``df`` is a regular grid, a row per hour; hours without a value take the last one before them.
    """
    df = timed(df, spec)
    tail = last_n(forward_fill(not_after(df, spec, as_of), spec, [target], zero_fill=False), spec, history)
    st = tail.groupBy(*spec.entity).agg(
        F.count(F.lit(1)).alias("n_hist"),
        F.max(F.when(F.col("rank_from_end") == 1, F.col(spec.ts))).alias("last_ts"),
        F.max(F.when(F.col("rank_from_end") == 3, F.col(target))).alias("w1"),
        F.max(F.when(F.col("rank_from_end") == 2, F.col(target))).alias("w2"),
        F.max(F.when(F.col("rank_from_end") == 1, F.col(target))).alias("w3"))
    elig = history_size(df, spec, min_rows, as_of).filter("eligible").select(*spec.entity)
    return join_on_keys(st, elig, spec.entity, "left_semi")


def recursive_forecast(state: DataFrame, entity: Sequence[str], a: Column, b: Column,
                       hours: int = FORECAST_HOURS, step: str = "1 hour") -> DataFrame:
    """Fold the recursion ``hours`` times per entity (entities in parallel) and emit one row per step."""
    # the coefficients are projected first: lambdas cannot hold subqueries
    folded = F.expr(_fold_sql(hours, "_a", "_b"))
    out = state.withColumns({"_a": a, "_b": b}).select(
        *entity, "last_ts", F.posexplode(folded["preds"]).alias("pos", "predicted"))
    h = (F.col("pos") + 1).cast("int")
    return out.select(*entity, h.alias("horizon_h"),
                      (F.col("last_ts") + F.make_dt_interval(hours=h)).alias("timestamp"), "predicted")


def horizon_coefficients(a: str, b: str, horizons: Sequence[int]) -> Column:
    """array<struct<h, c: struct<k0..k3>>>: forecast_h = k0 + k1*y[t-2] + k2*y[t-1] + k3*y[t].

    Each of the three window slots is an affine form (const, on y[t-2], on y[t-1],
    on y[t]); folding the recursion h times over them gives the coefficients.
    ``a`` and ``b`` name the columns holding the fitted intercept and slope.
    """
    def form(c0, c1, c2, c3):
        return f"named_struct('k0', {c0}D, 'k1', {c1}D, 'k2', {c2}D, 'k3', {c3}D)"

    def comb(k):
        tot = f"(s.s1.{k} + s.s2.{k} + s.s3.{k})"
        return f"{a} + {b} * ({tot} / 3.0D)" if k == "k0" else f"{b} * ({tot} / 3.0D)"

    init = f"named_struct('s1', {form(0, 1, 0, 0)}, 's2', {form(0, 0, 1, 0)}, 's3', {form(0, 0, 0, 1)})"
    merge = ("(s, i) -> named_struct('s1', s.s2, 's2', s.s3, 's3', named_struct("
             + ", ".join(f"'{k}', {comb(k)}" for k in ("k0", "k1", "k2", "k3")) + "))")
    items = ", ".join(f"named_struct('h', {h}, 'c', aggregate(sequence(1, {h}), {init}, {merge}).s3)"
                      for h in horizons)
    return F.expr(f"array({items})")


def backtest_by_horizon(df: DataFrame, spec: SeriesSpec, target: str, a: Column, b: Column,
                        horizons: Sequence[int], after: Column | None = None) -> DataFrame:
    """Per horizon: RMSE / MAE / n of the h-step recursive forecast from every origin row.

    ``df`` is a regular grid, so h rows ahead are h hours ahead; rows without a value score nothing. Origins
    are those after ``after`` (the end of what the fit has seen), with the rows before it as their past.
    """
    def st(cx):
        out = {"_y2": F.lag(target, 2).over(cx.w), "_y1": F.lag(target, 1).over(cx.w)}
        for h in horizons:
            out[f"_a{h}"] = F.lead(target, h).over(cx.w)
        return out
    rows = windowed(timed(df, spec), spec, [st], context_rows=2, context_cols=[target], lead_rows=max(horizons))
    if after is not None:
        rows = rows.filter(F.col(spec.ts) > after)
    actual = F.array(*[F.struct(F.lit(h).alias("h"), F.col(f"_a{h}").alias("actual")) for h in horizons])
    long = rows.select("_y2", "_y1", F.col(target).alias("_y0"), F.explode(actual).alias("x")).select(
        "_y2", "_y1", "_y0", "x.h", "x.actual")
    coef = (long.sparkSession.range(1).select(a.alias("_a"), b.alias("_b"))
            .select(F.explode(horizon_coefficients("_a", "_b", horizons)).alias("r"))
            .select("r.h", "r.c.*"))
    j = long.join(F.broadcast(coef), on="h")  # coef has exactly len(horizons) rows
    pred = F.col("k0") + F.col("k1") * F.col("_y2") + F.col("k2") * F.col("_y1") + F.col("k3") * F.col("_y0")
    err = F.col("actual") - pred
    ok = j.filter(F.col("actual").isNotNull() & pred.isNotNull())
    return ok.groupBy(F.col("h").cast("int").alias("horizon_h")).agg(
        F.sqrt(F.avg(err * err)).alias("rmse"), F.avg(F.abs(err)).alias("mae"), F.count(F.lit(1)).alias("n"))


def forecast_error_rows(base: DataFrame, rmse_col: str = "base_rmse") -> DataFrame:
    """Expand a one-row frame holding ``rmse_col`` into the horizon error table."""
    rows = F.array(*[F.struct(F.lit(h).alias("horizon_h"), F.lit(m).alias("mult"), F.lit(lab).alias("label"),
                              F.lit(rel).alias("reliability")) for h, m, lab, rel in HORIZON_ERROR_GROWTH])
    t = base.select(F.col(rmse_col), F.explode(rows).alias("r")).select(
        F.col("r.horizon_h").cast("int").alias("horizon_h"), "r.label", "r.reliability",
        (F.col(rmse_col) * F.col("r.mult")).alias("rmse"))
    text = fmt(F.col("rmse"), 2)
    return t.withColumns({"expected_rmse": text, "error_range": F.concat(F.lit("±"), text)})


def assumed_error_table(spark, base_rmse: float = DEFAULT_BASE_RMSE) -> DataFrame:
    """The error table for a stated one-step RMSE (the reference's default when nothing is measured)."""
    return forecast_error_rows(spark.range(1).select(F.lit(float(base_rmse)).alias("base_rmse")))


def _advance(state: DataFrame, model, features: Callable[[Column, Column], dict[str, Column]], horizons: Sequence[int], keep: int,
             checkpoint_every: int) -> DataFrame:
    """Move all states (``_past`` values, newest last, ``_last`` time, ``_p`` predictions) on, an hour per ``transform``.

    ``_past`` slides over its newest ``keep`` values; ``_p`` takes the predictions of the ``horizons`` only, in order.
    """
    kept, wanted = state.columns, set(horizons)
    for i in range(1, max(wanted) + 1):
        at = F.col("_last") + F.make_dt_interval(hours=F.lit(i - 1))
        scored = model.transform(state.withColumn("_t", at).withColumns(features(F.col("_past"), F.col("_t"))))
        made = F.array(F.col("prediction").cast("double"))
        longer = F.concat("_past", made)
        new = {"_past": F.when(F.size(longer) > keep, F.slice(longer, -keep, keep)).otherwise(longer)}
        if i in wanted:
            new["_p"] = F.concat("_p", made)
        state = scored.select(*[new[c].alias(c) if c in new else F.col(c) for c in kept])
        if i % checkpoint_every == 0 and i < max(wanted):
            state = state.checkpoint()
    return state


def recursive_with_model(history: DataFrame, spec: SeriesSpec, target: str, model,
                         features: Callable[[Column, Column], dict[str, Column]], hours: int = FORECAST_HOURS,
                         carry: Sequence[str] = (), keep: int = 25, as_of: Column | None = None,
                         history_rows: int = FORECAST_HISTORY_ROWS, min_rows: int = FORECAST_MIN_ROWS,
                         checkpoint_every: int = 8) -> DataFrame:
    """Recursive forecast with any Spark ML model: one ``transform`` per step for all entities at once.

    The state is one row per entity: its last ``keep`` values as an array (newest last), its last time, the
    last row's ``carry`` columns and the predictions so far. ``features(values, ts)`` gives the model's inputs
    as expressions on the array and the time; each step appends its prediction, so the plan grows by the same
    few nodes per step, and is cut with ``checkpoint()`` every few steps. ``history`` is a regular grid, a
    row per hour; hours without a value take the last one before them. Entities with fewer than ``min_rows``
    rows get no forecast. Returns entity, horizon_h, timestamp, predicted.
    """
    past = forward_fill(not_after(timed(history, spec), spec, as_of), spec, [target], zero_fill=False)
    tail = last_n(past, spec, history_rows).filter(F.col(target).isNotNull())
    row = F.struct(F.col(spec.ts), *[F.col(c) for c in carry])
    recent = F.sort_array(F.collect_list(F.when(F.col("rank_from_end") <= keep, F.struct(F.col(spec.ts).alias("t"), F.col(target).cast("double").alias("v")))))
    state = (tail.groupBy(*spec.entity).agg(F.count(F.lit(1)).alias("_n"), recent.alias("_r"), F.max_by(row, F.col(spec.ts)).alias("_l"))
             .filter(F.col("_n") >= min_rows)
             .select(*spec.entity, F.transform("_r", lambda x: x["v"]).alias("_past"), F.col("_l")[spec.ts].alias("_last"),
                     *[F.col("_l")[c].alias(c) for c in carry], F.array().cast("array<double>").alias("_p"))).checkpoint()
    state = _advance(state, model, features, range(1, hours + 1), keep, checkpoint_every)
    h = (F.col("pos") + 1).cast("int")
    return state.select(*spec.entity, "_last", F.posexplode("_p").alias("pos", "predicted")).select(
        *spec.entity, h.alias("horizon_h"), (F.col("_last") + F.make_dt_interval(hours=h)).alias("timestamp"), "predicted")


def rolling_forecasts(history: DataFrame, spec: SeriesSpec, target: str, model,
                      features: Callable[[Column, Column], dict[str, Column]], horizons: Sequence[int], carry: Sequence[str] = (),
                      keep: int = 25, after: Column | None = None, checkpoint_every: int = 8) -> DataFrame:
    """The recursive forecast of any Spark ML model from every row of a grid: entity, origin, horizon_h, predicted, actual.

    One state row per (entity, origin); all origins advance together, by one ``transform`` per hour, as in
    :func:`recursive_with_model` (same ``features``, ``carry`` and ``keep``). Origins are the rows after ``after`` (the end of
    what the model has seen) that have ``keep`` values up to themselves, the rows before ``after`` among them, and
    at least one value to be held against. Hours without a value take the last one before them as
    past, and are no actual. A NULL entity is an entity; rows without a time take no part.
    """
    hs = sorted(set(horizons))
    rows = timed(history, spec).withColumn("_fill", F.col(target).cast("double"))
    rows = forward_fill(rows, spec, ["_fill"], zero_fill=False)

    def st(cx):
        ahead = F.array(*[F.lead(F.col(target).cast("double"), h).over(cx.w) for h in hs])
        return {"_past": F.collect_list("_fill").over(cx.w.rowsBetween(1 - keep, 0)), "_a": ahead}
    rows = windowed(rows, spec, [st], context_rows=keep, context_cols=["_fill", target], lead_rows=max(hs))
    if after is not None:
        rows = rows.filter(F.col(spec.ts) > after)
    state = rows.filter((F.size("_past") >= keep) & F.exists("_a", lambda x: x.isNotNull())).select(
        *spec.entity, F.col(spec.ts).alias("_last"), *carry, "_past", "_a", F.array().cast("array<double>").alias("_p"))
    state = _advance(state.checkpoint(), model, features, hs, keep, checkpoint_every)
    pairs = F.arrays_zip(F.array(*[F.lit(h) for h in hs]).alias("h"), F.col("_p").alias("p"), F.col("_a").alias("a"))
    return (state.select(*spec.entity, F.col("_last").alias("origin"), F.explode(pairs).alias("e"))
            .select(*spec.entity, "origin", F.col("e.h").alias("horizon_h"), F.col("e.p").alias("predicted"), F.col("e.a").alias("actual")))


def errors_by_horizon(forecasts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """RMSE / MAE / n per horizon (and ``by``, e.g. the entity) of rows with a prediction and an actual value."""
    err = F.col("actual") - F.col("predicted")
    return forecasts.filter(err.isNotNull()).groupBy(*by, "horizon_h").agg(
        F.sqrt(F.avg(err * err)).alias("rmse"), F.avg(F.abs(err)).alias("mae"), F.count(F.lit(1)).alias("n"))


def value_back(values: Column, k: int) -> Column:
    """The value ``k`` rows before the newest of an array of recent values; NULL beyond its start."""
    return F.try_element_at(values, F.lit(-1 - k))


def mean_back(values: Column, n: int) -> Column:
    """The mean of the newest ``n`` values; NULL unless there are ``n``."""
    total = F.aggregate(F.slice(values, -n, n), F.lit(0.0), lambda a, x: a + x)
    return F.when(F.size(values) >= n, total / n)

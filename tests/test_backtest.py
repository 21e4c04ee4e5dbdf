"""Rolling-origin backtests of any model: equal to a plain loop over every origin."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from aerostat.ml import train
from aerostat.operators import forecast as fc
from aerostat.schemas import SeriesSpec

T0 = dt.datetime(2024, 1, 1)
SPEC = SeriesSpec(entity=("city",), ts="timestamp", target="v")
INPUTS = ["lag1", "lag4", "mean3", "hour", "side"]


def inputs(values, ts):
    return {"lag1": fc.value_back(values, 0), "lag4": fc.value_back(values, 3), "mean3": fc.mean_back(values, 3), "hour": F.hour(ts).cast("double")}


def series():
    r = random.Random(3)
    rows = []
    for city, n in (("a", 60), (None, 45), ("short", 4)):
        for h in range(n):
            v = None if h % 11 == 5 or (city is None and h == 0) else 20 + 10 * math.sin(h / 4) + r.random() * 6
            rows.append((city, T0 + dt.timedelta(hours=h), v, float(h % 3)))
    return rows + [("a", None, 5.0, 0.0)]


@pytest.fixture(scope="module")
def forest(spark):
    r = random.Random(8)
    rows = [(*[r.random() * 40 for _ in range(3)], float(r.randrange(24)), float(r.randrange(3))) for _ in range(300)]
    data = spark.createDataFrame([(*x, 0.6 * x[0] + 0.3 * x[2] + x[4]) for x in rows], [*INPUTS, "label"])
    return train.fit(data, INPUTS, "label", "random_forest", numTrees=4, maxDepth=4)


def plain(spark, model, horizons, keep, after):
    """Origin by origin over plain lists; the model scores the rows of all origins of an hour in one call."""
    states = []
    for city in ("a", None, "short"):
        own = [r for r in series() if r[0] == city and r[1] is not None]
        last, filled = None, []
        for _, _, v, _ in own:
            last = v if v is not None else last
            filled.append(last)
        for i, (_, t, _, side) in enumerate(own):
            past = [x for x in filled[max(0, i - keep + 1):i + 1] if x is not None]
            actual = {h: own[i + h][2] if i + h < len(own) else None for h in horizons}
            if t > after and len(past) == keep and any(a is not None for a in actual.values()):
                states.append([city, t, side, past, actual])
    out = {}
    for h in range(1, max(horizons) + 1):
        rows = [(i, p[-1], p[-4], sum(p[-3:]) / 3, float((t + dt.timedelta(hours=h - 1)).hour), side) for i, (_, t, side, p, _) in enumerate(states)]
        scored = {r.i: r.prediction for r in model.transform(spark.createDataFrame(rows, ["i", *INPUTS])).collect()}
        for i, (city, t, _, p, actual) in enumerate(states):
            p.append(scored[i])
            if h in horizons:
                out[city, t, h] = (scored[i], actual[h])
    return out


@pytest.mark.parametrize("spec", [SPEC, SPEC.with_(bucket="5 hours")], ids=["whole", "cut"])
def test_a_forest_from_every_origin_equals_a_plain_loop(spark, forest, spec):
    g = spark.createDataFrame(series(), "city string, timestamp timestamp, v double, side double").repartition(5)
    after = T0 + dt.timedelta(hours=12)
    made = fc.rolling_forecasts(g, spec, "v", forest, inputs, [1, 6, 3], carry=["side"], keep=5, after=F.lit(after), checkpoint_every=4)
    rows = made.collect()
    want = plain(spark, forest, [1, 3, 6], 5, after)
    got = {(r.city, r.origin, r.horizon_h): (r.predicted, r.actual) for r in rows}
    assert len(got) == len(rows) and set(got) == set(want) and {k[0] for k in got} == {"a", None}
    for k, (p, a) in want.items():
        assert got[k][0] == pytest.approx(p, rel=1e-9) and got[k][1] == a
    errors = {r.horizon_h: r for r in fc.errors_by_horizon(made).collect()}
    for h in (1, 3, 6):
        e = [a - p for (_, _, x), (p, a) in want.items() if x == h and a is not None]
        assert errors[h].n == len(e) and errors[h].rmse == pytest.approx((sum(x * x for x in e) / len(e)) ** 0.5)
        assert errors[h].mae == pytest.approx(sum(map(abs, e)) / len(e))
    per_city = fc.errors_by_horizon(made, ["city"]).collect()
    assert {(r.city, r.horizon_h) for r in per_city} == {(c, h) for c in ("a", None) for h in (1, 3, 6)}
    assert sum(r.n for r in per_city) == sum(r.n for r in errors.values())


def test_the_last_origin_is_the_served_forecast(spark, forest):
    """From one origin the backtest gives what the forecast gave when that row was the newest."""
    rows = [r for r in series() if r[0] == "a" and r[1] is not None]
    g = spark.createDataFrame(rows, "city string, timestamp timestamp, v double, side double")
    origin = T0 + dt.timedelta(hours=40)
    served = fc.recursive_with_model(g, SPEC, "v", forest, inputs, hours=8, carry=["side"], keep=5, as_of=F.lit(origin), min_rows=5)
    tested = fc.rolling_forecasts(g, SPEC, "v", forest, inputs, range(1, 9), carry=["side"], keep=5, after=F.lit(origin - dt.timedelta(hours=1)))
    want = {r.horizon_h: r.predicted for r in served.collect()}
    assert {r.horizon_h: r.predicted for r in tested.filter(F.col("origin") == F.lit(origin)).collect()} == pytest.approx(want)


def test_the_plan_grows_by_a_constant_and_empty_input_gives_none(spark, forest):
    g = spark.createDataFrame(series(), "city string, timestamp timestamp, v double, side double")

    def nodes(h):
        df = fc.rolling_forecasts(g, SPEC, "v", forest, inputs, [h], carry=["side"], keep=5, checkpoint_every=100)
        return len(df._jdf.queryExecution().analyzed().toString().splitlines())
    sizes = [nodes(h) for h in (2, 4, 6, 8)]
    assert len({b - a for a, b in zip(sizes, sizes[1:])}) == 1
    assert fc.rolling_forecasts(g.limit(0), SPEC, "v", forest, inputs, [1], carry=["side"], keep=5).count() == 0

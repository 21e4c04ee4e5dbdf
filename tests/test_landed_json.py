"""A folder of landed JSON with broken, unequal and drifted payloads gives good rows plus counted quarantine rows."""

import json

from pyspark.sql import types as T

from aerostat.sources import payload as pl

SCHEMA = T.StructType([T.StructField("city", T.StringType()), T.StructField("hourly", T.StructType([
    T.StructField("time", T.ArrayType(T.StringType())), T.StructField("pm10", T.ArrayType(T.DoubleType()))]))])


def obj(city, times, pm10, **more):
    return json.dumps({"city": city, "hourly": {"time": times, "pm10": pm10, **more.pop("hourly", {})}, **more})


T2 = ["2025-01-01T00:00", "2025-01-01T01:00"]
LINES = [obj("good", T2, [1.0, None]), obj("good", T2, [3.0, 4.0])[:30], "not json at all", "[1, 2]", "42", '{"city": "none"}', obj("type", T2, ["x", "y"]),
         obj("short", T2, [1.0]), obj("time", ["2025-13-99T00:00"], [1.0]), obj("drift", T2, [5.0, 6.0], hourly={"uv_index": [1, 2]}, station={"id": 7}),
         obj("empty", [], []), '{"city": "nulls", "hourly": {"time": null, "pm10": null}}']


def sorted_out(spark, scratch, lines):
    with open(f"{scratch}/landed.json", "w") as f:
        f.write("\n".join(lines))
    return pl.sort_out(pl.read_landed_json(spark, f"{scratch}/landed.json", SCHEMA), ["time", "pm10"])


def test_every_line_is_exploded_or_set_aside(spark, scratch):
    good, bad = sorted_out(spark, scratch, LINES)
    rows = sorted((r.city, str(r.timestamp), r.pm10) for r in pl.explode_payload(good, ["pm10"]).collect())
    assert [(c, v) for c, _, v in rows] == [("drift", 5.0), ("drift", 6.0), ("good", 1.0), ("good", None)]
    counts = {r.reason: r["count"] for r in bad.groupBy("reason").count().collect()}
    assert counts == {"malformed": 6, "unequal arrays or bad times": 2, "unknown fields": 1}
    drift = bad.filter("reason = 'unknown fields'").first()
    assert json.loads(drift.unknown["hourly.uv_index"]) == [1, 2] and json.loads(drift.unknown["station"]) == {"id": 7}
    assert {r.raw for r in bad.filter("reason = 'malformed'").collect()} == {*LINES[1:7]}


def test_quarantine_table_keeps_reason_and_text(spark, scratch):
    _, bad = sorted_out(spark, scratch, LINES)
    pl.quarantine(bad, f"{scratch}/q", "air")
    kept = spark.read.parquet(f"{scratch}/q")
    assert kept.count() == 9 and {r.source for r in kept.collect()} == {"air"}
    assert {json.loads(r.payload)["raw"] for r in kept.collect()} == {*LINES[1:10]}


def test_an_empty_folder(spark, scratch):
    good, bad = sorted_out(spark, scratch, [])
    assert good.count() == bad.count() == 0

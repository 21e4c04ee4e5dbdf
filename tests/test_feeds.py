"""Two feeds joined as streams: partners in different batches, any file order, late partners, replays."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from aerostat.streaming import feeds
from aerostat.streaming.ingest import read_event_files

AIR = "city string, hour timestamp, pm10 double"
WEATHER = "city string, hour timestamp, temperature double"
T0 = dt.datetime(2024, 1, 1)


def at(h):
    return T0 + dt.timedelta(hours=h)


@pytest.fixture(autouse=True)
def few_partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", old)


class Landing:
    """Folders of two feeds; every call lands one file each and runs the join over what is new."""

    def __init__(self, spark, scratch, delay="4 hours"):
        self.spark, self.dir, self.delay, self.landed = spark, scratch, delay, {"air": [], "weather": []}
        for name, schema in (("air", AIR), ("weather", WEATHER)):
            spark.createDataFrame([], schema).coalesce(1).write.mode("append").parquet(f"{scratch}/{name}")

    def land(self, air=(), weather=()):
        for name, schema, rows in (("air", AIR, air), ("weather", WEATHER, weather)):
            self.landed[name] += list(rows)
            if rows:
                self.spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(f"{self.dir}/{name}")

    def run(self):
        left, right = (read_event_files(self.spark, f"{self.dir}/{n}", self.spark.createDataFrame([], s).schema) for n, s in (("air", AIR), ("weather", WEATHER)))
        feeds.run_joined(left, right, ["city"], "hour", self.delay, f"{self.dir}/table", f"{self.dir}/late", f"{self.dir}/ck")

    def table(self):
        return self.spark.read.parquet(f"{self.dir}/table")

    def late(self):
        from aerostat.sources.store import table_exists
        if not table_exists(self.spark, f"{self.dir}/late"):
            return []
        return sorted((r.feed, json.loads(r.row).get("city"), str(r.hour)) for r in self.spark.read.parquet(f"{self.dir}/late").collect())

    def pairs(self):
        return sorted((str(r.city), str(r.hour), r.pm10, r.temperature) for r in self.table().filter("has_left AND has_right").collect())


def test_partners_in_different_batches(spark, scratch):
    land = Landing(spark, scratch)
    land.land(air=[("a", at(0), 1.0), (None, at(1), 2.0)])
    land.run()
    land.land(weather=[("a", at(0), 10.0), (None, at(1), 20.0), ("a", at(2), 30.0)])
    land.run()
    assert land.pairs() == [("None", str(at(1)), 2.0, 20.0), ("a", str(at(0)), 1.0, 10.0)]
    land.land(air=[("a", at(2), 3.0)])
    land.run()
    assert len(land.pairs()) == 3 and land.late() == []


def test_any_file_order_gives_the_batch_answer(spark, scratch):
    r = random.Random(1)
    air = [(c, at(h), h + 0.5) for h in range(24) for c in ("a", "b", None) if r.random() < 0.8]
    weather = [(c, at(h), h + 0.25) for h in range(24) for c in ("a", "b", None) if r.random() < 0.8]
    land = Landing(spark, scratch, "12 hours")
    blocks = [(n, [x for x in rows if x[1] >= at(8 * i) and x[1] < at(8 * i + 8)]) for i in range(3) for n, rows in (("air", air), ("weather", weather))]
    for i in range(0, len(blocks), 2):  # neighbours in time come in any order, cut in two
        part = [(n, half) for n, rows in blocks[i:i + 2] for half in (rows[::2], rows[1::2])]
        r.shuffle(part)
        for n, rows in part:
            land.land(**{n: rows})
            if r.random() < 0.3:
                land.run()
    land.land(air=[("end", at(200), 0.0)], weather=[("end", at(200), 0.0)])
    land.run()
    land.land(air=[("end", at(201), 0.0)], weather=[("end", at(201), 0.0)])
    land.run()
    a, w = spark.createDataFrame(land.landed["air"], AIR), spark.createDataFrame(land.landed["weather"], WEATHER)
    batch = feeds.joined_feeds(a, w, ["city"], "hour", "12 hours").filter(F.coalesce("city", F.lit("")) != "end")
    got = land.table().drop("date").select(*batch.columns).filter(F.coalesce("city", F.lit("")) != "end")
    assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0
    assert land.late() == [] and batch.filter("has_left AND has_right").count() > 30 and batch.filter("NOT has_right").count() > 5


def test_late_partners_reach_the_side_table_and_nothing_is_lost(spark, scratch):
    land = Landing(spark, scratch)
    land.land(air=[("a", at(0), 1.0), ("a", at(1), 2.0)])
    land.run()
    land.land(air=[("a", at(50), 3.0)], weather=[("a", at(50), 30.0)])
    land.run()
    land.land(air=[("a", at(51), 4.0)], weather=[("a", at(51), 40.0)])
    land.run()
    land.land(weather=[("a", at(0), 10.0), ("a", None, 5.0), ("a", at(52), 41.0)])  # a partner two days late, and a row without a time
    land.run()
    land.run()  # nothing new
    assert land.late() == [("right", "a", str(at(0))), ("right", "a", "None")]
    alone = {(r.city, r.hour) for r in land.table().filter("has_left AND NOT has_right").collect()}
    assert ("a", at(0)) in alone and ("a", at(1)) in alone
    assert land.pairs() == [("a", str(at(50)), 3.0, 30.0), ("a", str(at(51)), 4.0, 40.0)]


def test_state_is_bounded_by_the_delay(spark, scratch):
    land, sizes = Landing(spark, scratch, "6 hours"), []
    for day in range(4):
        land.land(air=[("a", at(24 * day + h), 1.0) for h in range(24)], weather=[("a", at(24 * day + h), 2.0) for h in range(0, 24, 2)])
        left, right = (read_event_files(spark, f"{scratch}/{n}", spark.createDataFrame([], s).schema) for n, s in (("air", AIR), ("weather", WEATHER)))
        q = (feeds.joined_feeds(left, right, ["city"], "hour", "6 hours").writeStream.foreachBatch(lambda b, e: b.write.format("noop").mode("append").save())
             .option("checkpointLocation", f"{scratch}/state").trigger(availableNow=True).start())
        q.awaitTermination()
        sizes.append(sum(o["numRowsTotal"] for o in q.recentProgress[-1]["stateOperators"]))
    assert max(sizes) <= 2 * 24 and len(land.landed["air"]) == 96


def test_clashing_columns_are_refused(spark):
    a = spark.createDataFrame([], "city string, hour timestamp, v double")
    with pytest.raises(ValueError, match="v"):
        feeds.joined_feeds(a, a, ["city"], "hour", "1 hour")

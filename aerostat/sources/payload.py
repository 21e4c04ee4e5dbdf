"""Landed parallel-array payloads: derive, read, explode, and the regular time axis.

A payload is one object per entity and range: ``hourly{time[], m1[], m2[], ...}``
(JSON form) or ``start_epoch, interval_seconds, values[][]`` (interval form).
Exploding is a generator over each row, so it runs in the scan stage with no
shuffle. Payloads whose arrays differ in length are quarantined, not padded.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from aerostat.functions.scalar import parse_time
from aerostat.operators.windows import join_on_keys

PAYLOAD_BLOCK = 1024  # max rows per derived payload object
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def land_payloads(events: DataFrame, measures: Sequence[str] = ("value", "k")) -> DataFrame:
    """Group events into JSON-style payloads per (entity, day), arrays in time order.

    A day with more than ``PAYLOAD_BLOCK`` rows of one entity is dealt over several payloads by a hash of
    the id, so a payload stays near that size whatever the skew of an entity.
    """
    day = events.withColumn("day", F.to_date("ts"))
    full = (day.groupBy("user_id", "day").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > PAYLOAD_BLOCK)
            .withColumn("_blocks", F.ceil(F.col("_n") / PAYLOAD_BLOCK)).drop("_n"))
    dealt = join_on_keys(day, full, ["user_id", "day"])
    block = F.coalesce(F.pmod(F.xxhash64("event_id"), F.col("_blocks")), F.lit(0))
    rows = F.sort_array(F.collect_list(F.struct("ts", "event_id", *measures)))
    g = dealt.groupBy(F.col("user_id").alias("city"), "day", block.alias("block")).agg(rows.alias("r"))
    hourly = F.struct(
        F.transform("r", lambda x: F.date_format(x["ts"], TIME_FORMAT)).alias("time"),
        *[F.transform("r", _field(m)).alias(m) for m in measures])
    return g.select("city", hourly.alias("hourly"))


def _field(name: str):
    return lambda x: x[name]


def read_payload_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_landed_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Landed JSON lines, nothing dropped at the scan: see :func:`parse_landed`."""
    return parse_landed(spark.read.text(path), "value", schema)


def parse_landed(lines: DataFrame, raw: str, schema: T.StructType) -> DataFrame:
    """The fields of ``schema`` from the JSON text ``raw`` and, with the text, what does not fit them.

    ``raw`` the text, ``broken`` whether it does not parse into the schema (bad JSON, a value of another type, no
    object at all), ``unknown`` the top-level and ``hourly`` fields that the schema lacks, by name, as JSON text.
    """
    known, text = [f.name for f in schema.fields], F.col(raw)
    inner = [f.name for f in schema["hourly"].dataType.fields] if "hourly" in known else []
    whole = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    parsed = F.from_json(text, whole, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})

    def extra(part: Column, names: Sequence[str], prefix: str) -> Column:
        fields = F.coalesce(F.from_json(part, "map<string,string>"), F.create_map().cast("map<string,string>"))
        return F.transform_keys(F.map_filter(fields, lambda k, _: ~k.isin(*names)), lambda k, _: F.concat(F.lit(prefix), k))

    unknown = extra(text, known, "")
    if inner:
        unknown = F.map_concat(unknown, extra(F.get_json_object(text, "$.hourly"), inner, "hourly."))
    out = lines.select(text.alias("raw"), parsed.alias("_p"), unknown.alias("unknown"))
    broken = F.col("_p").isNull() | F.col("_p._corrupt").isNotNull() | (F.col("_p.hourly").isNull() if inner else F.lit(False))
    return out.select(*[F.col(f"_p.{f}").alias(f) for f in known], "raw", broken.alias("broken"),
                      F.when(~broken, F.col("unknown")).alias("unknown"))


def sort_out(landed: DataFrame, arrays: Sequence[str], time: str = "time") -> tuple[DataFrame, DataFrame]:
    """(payloads to explode, rows for quarantine) of :func:`parse_landed`'s frame.

    Quarantine rows have a ``reason``: ``malformed``, ``unequal arrays or bad times``, or ``unknown fields``. The
    last ones are usable as well: what the schema knows of them is exploded, the rest is kept for a later look.
    """
    good, uneven = split_unequal(landed.filter(~F.col("broken")), arrays, time)
    reasons = [(landed.filter("broken"), "malformed"), (uneven, "unequal arrays or bad times"), (good.filter(F.size("unknown") > 0), "unknown fields")]
    bad = [df.select(F.lit(reason).alias("reason"), "raw", "unknown") for df, reason in reasons]
    return good.drop("raw", "broken", "unknown"), bad[0].unionByName(bad[1]).unionByName(bad[2])


def split_unequal(payload: DataFrame, arrays: Sequence[str], time: str = "time") -> tuple[DataFrame, DataFrame]:
    """(payloads whose arrays all have the same length and whose times all parse, the rest for quarantine).

    A missing variable (NULL array) counts as length 0; a NULL time is a bad one.
    """
    sizes = [F.coalesce(F.size(F.col(f"hourly.{a}")), F.lit(0)) for a in arrays]
    same = F.lit(True)
    for s in sizes[1:]:
        same = same & (s == sizes[0])
    if time in arrays:
        same = same & ~F.coalesce(F.exists(F.col(f"hourly.{time}"), lambda t: parse_time(t).isNull()), F.lit(False))
    tagged = payload.withColumn("_same", same)
    return tagged.filter("_same").drop("_same"), tagged.filter(~F.col("_same")).drop("_same")


def quarantine(bad: DataFrame, path: str, source: str) -> None:
    """Append payloads that were set aside, as JSON text with their source, for a later look."""
    bad.select(F.lit(source).alias("source"), F.current_timestamp().alias("at"), F.to_json(F.struct("*")).alias("payload")) \
        .write.mode("append").parquet(path)


def explode_payload(payload: DataFrame, measures: Sequence[str], renames: dict[str, str] | None = None,
                    keep: Sequence[str] = ("city",)) -> DataFrame:
    """One row per time element: ``inline(arrays_zip(time, m1, ...))``, time parsed to TIMESTAMP (NULL if it cannot be)."""
    zipped = F.arrays_zip(*[F.col(f"hourly.{c}").alias(c) for c in ["time", *measures]])
    out = payload.select(*keep, F.inline(zipped))
    out = out.withColumn("timestamp", parse_time(F.col("time"))).drop("time")
    if renames:
        out = out.withColumnsRenamed({k: v for k, v in renames.items() if k in measures})
    return out.select(*keep, "timestamp", *[(renames or {}).get(m, m) for m in measures])


def interval_payloads(events: DataFrame, slot_seconds: int = 3600, slots: int = 24) -> DataFrame:
    """Interval-form payloads per (entity, day): start epoch, slot length, one value array per variable.

    Slots without events hold NULL. Each group is bounded by ``slots`` entries.
    """
    hourly = (events.groupBy("user_id", F.date_trunc("hour", "ts").alias("hr"))
              .agg(F.avg("value").alias("avg_value"), F.count(F.lit(1)).cast("double").alias("n_events")))
    day = F.date_trunc("day", "hr")
    slot = ((F.unix_seconds("hr") - F.unix_seconds(day)) / F.lit(slot_seconds)).cast("int")
    per_day = (hourly.groupBy(F.col("user_id").alias("city"), day.alias("day"))
               .agg(F.map_from_entries(F.collect_list(F.struct(slot, F.struct("avg_value", "n_events"))))
                    .alias("m")))
    idx = F.sequence(F.lit(0), F.lit(slots - 1))
    values = F.array(F.transform(idx, lambda i: F.col("m")[i]["avg_value"]),
                     F.transform(idx, lambda i: F.col("m")[i]["n_events"]))
    return per_day.select("city", F.unix_seconds("day").alias("start_epoch"),
                          F.lit(slot_seconds).alias("interval_seconds"),
                          F.array(F.lit("avg_value"), F.lit("n_events")).alias("names"), values.alias("values"))


def time_axis(payload: DataFrame, names: Sequence[str], keep: Sequence[str] = ("city",)) -> DataFrame:
    """Build ``start + pos * interval`` for every element and zip it with the value arrays.

    n elements in, n rows out (the range is left-closed with no end bound).
    """
    zipped = F.arrays_zip(*[F.col("values")[i].alias(n) for i, n in enumerate(names)])
    out = payload.select(*keep, "start_epoch", "interval_seconds", F.posexplode(zipped).alias("pos", "v"))
    ts = F.timestamp_seconds(F.col("start_epoch") + F.col("pos") * F.col("interval_seconds"))
    return out.select(*keep, ts.alias("timestamp"), *[F.col("v")[n].alias(n) for n in names])

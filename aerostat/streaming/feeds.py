"""Two feeds that do not land together, joined as streams.

:func:`joined_feeds` is a stream-stream full outer join on the entity and the event time. Both sides carry a
watermark and the time is a join key, so a row waits in the state for its partner until the watermark passes it and
is then emitted alone: the state holds the last ``delay`` of both feeds, whatever the history. On batch frames
the same function is the batch answer, so any file order whose disorder ``delay`` covers gives the same rows.

A row that lands after the watermark has passed it is dropped by the join. :func:`run_joined` accounts for every landed
row: after the join has run, new rows at or before its watermark that the table does not hold go to the side table
``late``, with the feed they came from (rows without a time too: no partner can be found for them). Only the new
rows and the days they touch are read. The table is keyed, so a batch that is delivered again changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from aerostat.operators.windows import join_on_keys
from aerostat.sources.store import table_exists, upsert_table, with_date_partition
from aerostat.sources.versioned import _names, create_once
from aerostat.streaming.ingest import _with_batch, run_available

LEFT, RIGHT = "has_left", "has_right"


def joined_feeds(left: DataFrame, right: DataFrame, entity: Sequence[str], ts: str, delay: str) -> DataFrame:
    """entity, ts, the left feed's columns, the right feed's, and which of them had a row. NULL entities meet; NULL times do not."""
    keys = [*entity, ts]
    values = [c for c in right.columns if c not in keys]
    clash = sorted(set(values) & set(left.columns))
    if clash:
        raise ValueError(f"columns of both feeds: {clash}; rename them before the join")
    a = left.filter(F.col(ts).isNotNull()).withColumn(LEFT, F.lit(True)).withWatermark(ts, delay)
    b = right.filter(F.col(ts).isNotNull()).withWatermark(ts, delay).select(
        *[F.col(k).alias(f"_r_{k}") for k in keys], *values, F.lit(True).alias(RIGHT))
    on = F.col(ts) == F.col(f"_r_{ts}")
    for e in entity:
        on = on & F.col(e).eqNullSafe(F.col(f"_r_{e}"))
    lefts = [c for c in left.columns if c not in keys]
    return a.join(b, on, "full_outer").select(
        *[F.coalesce(k, f"_r_{k}").alias(k) for k in keys], *lefts, *values,
        F.coalesce(LEFT, F.lit(False)).alias(LEFT), F.coalesce(RIGHT, F.lit(False)).alias(RIGHT))


def _sink(table: str, keys: Sequence[str], ts: str) -> Callable[[DataFrame, int], None]:
    def run(batch: DataFrame, _epoch: int) -> None:
        order = [LEFT, RIGHT, *[c for c in batch.columns if c not in {*keys, LEFT, RIGHT}]]
        upsert_table(batch.sparkSession, with_date_partition(batch, ts), table, keys, order, resolve="last", ts=ts)
    return _with_batch(run)


def _late_sink(table: str, late: str, feed: str, side: str, keys: Sequence[str], ts: str, watermark: str) -> Callable[[DataFrame, int], None]:
    """Rows of a batch that the join can no longer take and that ``table`` does not hold."""
    def run(batch: DataFrame, _epoch: int) -> None:
        spark = batch.sparkSession
        past = with_date_partition(batch.filter(F.col(ts).isNull() | (F.col(ts) <= F.lit(watermark).cast("timestamp"))), ts)
        if table_exists(spark, table):
            held = spark.read.parquet(table).filter(F.col(side)).select(*keys, "date")
            past = join_on_keys(past, held, [*keys, "date"], "left_anti")
        rows = past.select(*keys, "date", F.lit(feed).alias("feed"), F.to_json(F.struct(*batch.columns)).alias("row"))
        upsert_table(spark, rows, late, [*keys, "feed", "row"], ts=ts)
    return _with_batch(run)


def _watermark(spark: SparkSession, checkpoint: str) -> str | None:
    """The watermark that the last finished run of the join reached."""
    found = [n for n in _names(spark, f"{checkpoint}/watermarks") if not n.startswith(".")]
    return found[-1].replace("_", ":") if found else None


def run_joined(left: DataFrame, right: DataFrame, entity: Sequence[str], ts: str, delay: str, table: str, late: str,
               checkpoint: str) -> None:
    """Join all that has landed into ``table`` and account for the late rows; restarts resume from the checkpoints.

    The watermark that the join reached is kept as the name of an empty file before the late rows are looked for, so a
    run that stops in between finishes that work the next time.
    """
    spark, keys = left.sparkSession, [*entity, ts]
    q = (joined_feeds(left, right, entity, ts, delay).writeStream.foreachBatch(_sink(table, keys, ts))
         .option("checkpointLocation", f"{checkpoint}/join").trigger(availableNow=True).start())
    q.awaitTermination()
    reached = max((p["eventTime"]["watermark"] for p in q.recentProgress if "watermark" in p["eventTime"]), default=None)
    if reached is not None:
        create_once(spark, f"{checkpoint}/watermarks/{reached.replace(':', '_')}", "")
    watermark = _watermark(spark, checkpoint)
    if watermark is None:
        return
    for feed, rows, side in (("left", left, LEFT), ("right", right, RIGHT)):
        run_available(rows, _late_sink(table, late, feed, side, keys, ts, watermark), f"{checkpoint}/late-{feed}")

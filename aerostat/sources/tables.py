"""Table scans and the bindings of the driver tables to series.

Two bindings are used throughout:

* **user series** (event grain): entity ``user_id``, time ``ts`` (TIMESTAMP_NTZ in
  the files, cast to TIMESTAMP at the scan so event-time operators accept it),
  tie-break ``event_id``, target ``value``, second measure ``k`` from ``props``.
* **station series** (hourly grain): see :mod:`aerostat.operators.grid`.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from aerostat.schemas import SeriesSpec

# Users holding a million rows or more are split at about every millionth row; the rest stay whole.
USER_SPEC = SeriesSpec(entity=("user_id",), ts="ts", order=("event_id",), target="value", bucket="1 day",
                       hot_rows=1_000_000)
USER_SPEC_SPLIT_ALL = USER_SPEC.with_(hot_rows=0)
USER_SPEC_CUT = USER_SPEC.with_(hot_rows=20)  # the same plan as for a series of billions, on small tables
USER_SPEC_PLAIN = USER_SPEC.with_(bucket=None)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def nan_to_null(c: Column) -> Column:
    """A measurement that is not a number is a missing one."""
    return F.when(~F.isnan(c), c)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``ts`` as TIMESTAMP and the JSON measure ``k`` parsed."""
    df = read_table(spark, sf_dir, "events")
    return df.select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type",
        nan_to_null(F.col("value")).alias("value"),
        nan_to_null(F.get_json_object("props", "$.k").try_cast("double")).alias("k"))


def user_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select("user_id", "ts", "event_id", "event_type", "value", "k")


def order_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a second series source: entity = nation of the customer, value = order total."""
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"])
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    return (o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(F.col("n_name").alias("nation"), F.col("o_orderdate").cast("timestamp").alias("ts"),
                    "o_orderkey", F.col("o_totalprice").alias("value")))


def first_available(loaders: Sequence[tuple[str, Callable[[], DataFrame]]]) -> tuple[DataFrame, str]:
    """Return the first loader that resolves, with its label (source fallback chain).

    Each loader is resolved (schema only, no job) so a missing table or
    column falls through to the next source.
    """
    errors = []
    for label, load in loaders:
        try:
            df = load()
            df.schema  # noqa: B018 - forces analysis
            return df, label
        except (AnalysisException, FileNotFoundError) as e:  # missing path / table / column
            errors.append(f"{label}: {e}")
    raise LookupError("no source available: " + "; ".join(errors))

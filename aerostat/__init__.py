"""aerostat: hourly sensor-style time series on Spark.

Series are keyed DataFrames ``(entity..., ts, id)``; every order-dependent
operator is a window partitioned by entity (and a time bucket when a single
entity is large), so the work scales out across executors.
"""

from aerostat.schemas import SeriesSpec

__all__ = ["SeriesSpec"]

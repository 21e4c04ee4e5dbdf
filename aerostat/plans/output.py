"""Uniform output shape for query results compared against the SQL oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

DIGITS = 6


def finish(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round doubles to ``digits`` decimals and present TIMESTAMP columns as TIMESTAMP_NTZ.

    Both engines sum floating-point values in different orders; rounding keeps
    the comparison about semantics, not the last bits. Rounding goes through
    DECIMAL(38,12) (half-up) so ties are broken the same way in any engine.
    """
    exprs = []
    for f in df.schema.fields:
        q = f"`{f.name}`"
        if isinstance(f.dataType, T.DoubleType):
            exprs.append(f"CAST(round(CAST({q} AS DECIMAL(38,12)), {digits}) AS DOUBLE) AS {q}")
        elif isinstance(f.dataType, T.TimestampType):
            exprs.append(f"CAST({q} AS TIMESTAMP_NTZ) AS {q}")
        else:
            exprs.append(q)
    return df.selectExpr(*exprs)  # one call for the whole projection

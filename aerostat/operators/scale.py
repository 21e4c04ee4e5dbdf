"""Min-max scaling fitted on a subset of rows (by default the training rows), and its inverse.

The fit is a single global aggregate, one struct-valued scalar subquery however many columns are scaled: no join,
no driver round-trip. A constant column keeps its offset (range taken as 1), as in the reference's scaler.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

_FIT = "_fit"


@dataclass(frozen=True)
class MinMax:
    """The scaled columns and the lazily computed struct of their minima and maxima."""
    cols: tuple[str, ...]
    fit: Column

    def low(self, c: str) -> Column:
        return F.col(_FIT)[f"min_{c}"]

    def span(self, c: str) -> Column:
        d = F.col(_FIT)[f"max_{c}"] - self.low(c)
        return F.when(d == 0, F.lit(1.0)).otherwise(d)


def fit_minmax(fit_rows: DataFrame, cols: Sequence[str]) -> MinMax:
    return MinMax(tuple(cols), fit_rows.agg(F.struct(*[F.min(c).alias(f"min_{c}") for c in cols],
                                                     *[F.max(c).alias(f"max_{c}") for c in cols]).alias("f")).scalar())


def minmax_transform(df: DataFrame, fit: MinMax, suffix: str = "_scaled") -> DataFrame:
    return df.withColumn(_FIT, fit.fit).withColumns({c + suffix: (F.col(c) - fit.low(c)) / fit.span(c) for c in fit.cols}).drop(_FIT)


def minmax_inverse(df: DataFrame, fit: MinMax, suffix: str = "_scaled") -> DataFrame:
    return df.withColumn(_FIT, fit.fit).withColumns({c + "_restored": F.col(c + suffix) * fit.span(c) + fit.low(c) for c in fit.cols}).drop(_FIT)

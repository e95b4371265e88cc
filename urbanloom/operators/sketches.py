"""Medians and distinct counts that add up over days: sketches per day, merged to any period.

A day's sketch has a fixed size whatever the day's rows, and merging sketches gives what one
sketch over all rows would tell. So a month, a quarter or a running year is read from its days
and no row is read again. The error is the sketch's: for distinct counts the relative
standard error is about 1.04 / sqrt(2^k), for quantiles the rank is off by about 2.3 / k^0.9
of the rows, with high probability. The exact forms stay in ``plans``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

DISTINCT_BITS, QUANTILE_K = 14, 800


def daily_sketches(
    rows: DataFrame, keys: Sequence[str], distinct: Sequence[str] = (), quantiles: Sequence[str] = ()
) -> DataFrame:
    """One row per value of ``keys``: a row count, ``<column>__distinct`` and ``<column>__kll``
    sketches. Nulls count in neither sketch; a group without values has a null sketch."""
    made: list[Column] = [F.count("*").alias("rows")]
    for column in distinct:
        made.append(F.hll_sketch_agg(F.col(column).cast("string"), F.lit(DISTINCT_BITS)).alias(f"{column}__distinct"))
    for column in quantiles:
        values = F.col(column).cast("double")
        sketch = F.kll_sketch_agg_double(values, F.lit(QUANTILE_K))
        made.append(F.when(F.count(column) > 0, sketch).alias(f"{column}__kll"))
    return rows.groupBy(*keys).agg(*made)


def rolled_up(sketches: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Sketches of a coarser grain from finer ones."""
    made: list[Column] = [F.sum("rows").alias("rows")]
    for name in sketches.columns:
        if name.endswith("__distinct"):
            made.append(F.hll_union_agg(name).alias(name))
        elif name.endswith("__kll"):
            made.append(F.kll_merge_agg_double(name).alias(name))
    return sketches.groupBy(*keys).agg(*made)


def distinct_count(column: str) -> Column:
    """Estimated number of different values."""
    return F.hll_sketch_estimate(f"{column}__distinct")


def quantile(column: str, rank: float) -> Column:
    """Estimated value at a rank between 0 and 1; a value that occurs."""
    return F.when(F.col(f"{column}__kll").isNotNull(), F.kll_sketch_get_quantile_double(f"{column}__kll", F.lit(rank)))


def distinct_error() -> float:
    return 1.04 / (1 << DISTINCT_BITS) ** 0.5


def quantile_error() -> float:
    return 2.3 / QUANTILE_K**0.9

"""Global ranks by range partitions: no task sees more than its share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import OWN, named, stored

RANK = f"{OWN}rank"
TOTAL = f"{OWN}total"
_PLACE, _PART, _FIRST, _BEFORE, _N = (f"{OWN}{name}" for name in ("place", "part", "first", "before", "n"))


def ranked(rows: DataFrame, order: Sequence[Column], label: str, within: Sequence[str] = ()) -> DataFrame:
    """``rows`` with ``__ul_rank`` (0, 1, 2 ... in ``order``) and ``__ul_total``, over all rows
    or within each value of the columns ``within``, which are not null and lead the order.

    Rows are dealt by ranges of the whole order, sorted and stored with their place. Only the
    counts of each range are added up (one row per range and group), so a group of any size
    stays spread. ``order`` should end in a key that tells equal rows apart; else a range
    cannot be cut inside a run of equal rows. ``rows`` should be stored: it is read twice.
    """
    groups = [named(c) for c in within]
    keys = [*(c.asc() for c in groups), *order]
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(_PLACE, F.monotonically_increasing_id())
    placed = stored(placed, label).withColumn(_PART, F.shiftright(_PLACE, 33))
    counts = placed.groupBy(*groups, _PART).agg(F.count("*").alias(_N), F.min(_PLACE).alias(_FIRST))
    whole = Window.partitionBy(*groups)
    earlier = whole.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumns(
        {_BEFORE: F.coalesce(F.sum(_N).over(earlier), F.lit(0)), TOTAL: F.sum(_N).over(whole)}
    ).drop(_N)
    at = placed.join(starts, [*within, _PART])
    return at.withColumn(RANK, F.col(_PLACE) - F.col(_FIRST) + F.col(_BEFORE)).select(
        *(named(c) for c in rows.columns), RANK, TOTAL
    )

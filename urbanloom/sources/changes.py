"""Rebuild of the days of a model whose input has changed."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from .snapshots import NO_DAY, Snapshots
from .tables import PARTITION_DAY, clustered, settled

_NOTE = "day "


def day_fingerprints(rows: DataFrame, ts: str) -> dict[str, str]:
    """Rows and an order-free hash of all values per day: one row a day leaves the cluster. The
    hash is a sum of two row hashes, so neither order nor pairs of equal rows cancel out."""
    hashed = rows.select(F.to_date(ts).cast("string").alias("day"), *(F.xxhash64(F.lit(seed), *rows.columns).alias(f"h{seed}") for seed in (1, 2)))
    wide = [F.sum(F.col(h).cast("decimal(38,0)")).cast("string") for h in ("h1", "h2")]
    found = hashed.groupBy("day").agg(F.concat_ws(":", F.count("*").cast("string"), *wide).alias("print"))
    return {NO_DAY if r["day"] is None else r["day"]: r["print"] for r in found.collect()}


def rebuild_changed(
    inputs: Sequence[tuple[DataFrame, str]], table: Snapshots, derive: Callable[..., DataFrame], ts: str, cluster: Sequence[str] = ()
) -> list[str]:
    """Bring a day-partitioned model up to date by deriving only what changed; returns the days.

    ``inputs`` are rows with their time column; ``derive`` makes the model from the inputs of some
    days, and a day of the model follows from that day of the inputs alone. Each input's days
    are compared with the fingerprints kept in the table's manifest. Changed, new and vanished
    days are replaced in one published step, together with their fingerprints, so a run that
    dies leaves the old model and the old fingerprints, and the next run does the work.
    """
    head = table.manifest()
    prints: dict[str, str] = {}
    for number, (rows, column) in enumerate(inputs):
        for day, value in day_fingerprints(rows, column).items():
            prints[f"{_NOTE}{number} {day}"] = value
    known = {name: note for name, note in (head.notes if head else {}).items() if name.startswith(_NOTE)}
    changed = {name for name in prints.keys() | known.keys() if prints.get(name) != known.get(name)}
    days = sorted({name.rsplit(" ", 1)[1] for name in changed})
    if not days:
        return []
    dated = [d for d in days if d != NO_DAY]
    parts = []
    for rows, column in inputs:
        day = F.to_date(column)
        within = day.isin([F.lit(d).cast("date") for d in dated]) if dated else F.lit(False)
        parts.append(rows.filter(within | day.isNull() if NO_DAY in days else within))
    made = settled(clustered(derive(*parts), ts, cluster), "changed-days")
    staged = table.stage(made, head)
    table.publish(staged, days, {name: prints.get(name) for name in changed})
    return days


def read_model(table: Snapshots) -> DataFrame | None:
    found = table.read()
    return None if found is None else found.drop(PARTITION_DAY)

"""Mixing sources to target weights by fitting each source's word budget exactly.

1. One narrow table (row, id, source, size, text hash) is stored; sizes count whole texts.
2. A histogram counts documents by (source, exact size). It is combined on the map
   side, so a source with a third of all rows adds as many rows as it has sizes.
3. Targets: sources share the total by weight, none above ``max_repeats`` times its
   own size; what is cut off is shared among the rest by weight (water filling).
4. Every source takes its whole corpus ``target // size`` times. The rest of the
   budget is a bounded subset-sum problem over the histogram: a seeded systematic draw along
   the sizes, then bounded-knapsack dynamic programming over a rest of a few times the
   largest size, with documents in drawn order; never more than the last ``room`` words.
5. The chosen number of documents of each size is picked by a seeded hash of id, text and
   copy; the copies of rows with equal id, source and text are counted from 1. Groups are
   dealt into buckets of about ``BUCKET_ROWS`` rows, so no task ranks a whole group.

Null text counts as size 0, null source is a source of its own, the last one.
Documents of size 0 are never repeated (``taken`` 0). Rows that repeat an id, or have none,
are separate documents, each with repeats of its own. An empty table gives an empty result.
Other columns are ignored.
"""

from __future__ import annotations

import random
from bisect import bisect_right
from collections.abc import Sequence
from functools import reduce
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import OWN, ROW, WORD_PATTERN, named, numbered, stored

BUCKET_ROWS = 256
#: Documents that the knapsack takes one by one in drawn order; the others follow in chunks.
SINGLES = 4_096


def choose_counts(
    sizes: Sequence[int], counts: Sequence[int], budget: int, room: int = 65_536, seed: int | str = 0
) -> list[int]:
    """How many documents of each size to take so that their words come as near to
    ``budget`` as possible without passing it. The bulk is a systematic draw along the
    sizes, so each range of sizes gives its share; only a rest of a few times the largest
    size is left to a knapsack over documents in drawn order. Where that misses the budget,
    larger rests are tried, and at last the largest documents first."""
    order = sorted(range(len(sizes)), key=lambda i: int(sizes[i]))
    size = [int(sizes[i]) for i in order]
    have = [int(counts[i]) for i in order]
    budget = min(budget, sum(s * n for s, n in zip(size, have)))
    fitting = bisect_right(size, budget)
    largest = size[fitting - 1] if fitting else 0
    best, short = [0] * len(size), budget
    for rest in (4 * largest, 32 * largest, 256 * largest):
        taken = _drawn(size[:fitting], have[:fitting], budget, rest, room, random.Random(f"{seed}|{rest}"))
        left = budget - sum(s * n for s, n in zip(size, taken))
        if left < short:
            best, short = taken + [0] * (len(size) - fitting), left
        if not short or rest >= min(budget, room):
            break
    if short:
        taken = _largest_first(size, have, budget, room)
        if budget - sum(s * n for s, n in zip(size, taken)) < short:
            best = taken
    result = [0] * len(order)
    for place, n in zip(order, best):
        result[place] = n
    return result


def _drawn(
    size: Sequence[int], have: Sequence[int], budget: int, rest: int, room: int, draw: random.Random
) -> list[int]:
    """Ascending sizes, each at most ``budget``: a systematic draw of documents up to
    ``rest`` words below it, then single ones, the last ``room`` words by knapsack."""
    total = sum(s * n for s, n in zip(size, have))
    bulk = min(max(0, budget - rest), total)
    start, before, taken = draw.randrange(max(total, 1)), 0, []
    for n in have:
        # Equal steps along the documents in order of size miss the words by one largest size at most.
        taken.append(((before + n) * bulk + start) // total - (before * bulk + start) // total if total else 0)
        before += n
    left = budget - sum(s * n for s, n in zip(size, taken))
    free = [n - t for n, t in zip(have, taken)]
    ends = list(accumulate(free))
    number = ends[-1] if ends else 0
    singles = [bisect_right(ends, at) for at in draw.sample(range(number), min(number, SINGLES))]
    later = []
    for i in singles:
        if room < left and size[i] <= left:
            taken[i] += 1
            free[i] -= 1
            left -= size[i]
        else:
            later.append(i)
    if left > room:
        for i in reversed(range(len(size))):
            more = min(free[i], left // size[i] if size[i] else 0, max(0, -(-(left - room) // size[i])) if size[i] else 0)
            taken[i] += more
            free[i] -= more
            left -= more * size[i]
        later = []
    waiting = list(free)
    for i in later:
        waiting[i] -= 1
    chunks = [(i, 1) for i in later] + draw.sample(pieces := _pieces(size, waiting, min(left, room)), len(pieces))
    for i, more in _knapsack(size, chunks, min(left, room)).items():
        taken[i] += more
    return taken


def _largest_first(size: Sequence[int], have: Sequence[int], budget: int, room: int) -> list[int]:
    """A proportional share of each size, then the largest documents, the last ``room``
    words by knapsack."""
    total = sum(s * n for s, n in zip(size, have))
    bulk = max(0, budget - room)
    taken = [n * bulk // total if total else 0 for n in have]
    left = budget - sum(s * n for s, n in zip(size, taken))
    for i in reversed(range(len(size))):
        s = size[i]
        if left <= room:
            break
        more = min(have[i] - taken[i], left // s if s else 0, -(-(left - room) // s) if s else 0)
        taken[i] += more
        left -= more * s
    free = [n - t for n, t in zip(have, taken)]
    for i, more in _knapsack(size, _pieces(size, free, min(left, room))[::-1], min(left, room)).items():
        taken[i] += more
    return taken


def _pieces(size: Sequence[int], have: Sequence[int], budget: int) -> list[tuple[int, int]]:
    """Chunks (item, number) of 1, 2, 4, ... documents of each size: their subsets give
    every number that fits ``budget``."""
    chunks = []
    for i, s in enumerate(size):
        left, number = min(have[i], budget // s if s else 0), 1
        while left > 0:
            number = min(number, left)
            chunks.append((i, number))
            left -= number
            number *= 2
    return chunks


def _knapsack(size: Sequence[int], chunks: Sequence[tuple[int, int]], budget: int) -> dict[int, int]:
    """Subset sum over ``chunks`` (item, number) by dynamic programming, up to the first
    that reaches ``budget``. ``reached`` is the set of sums as bits; ``parent`` names the
    chunk that reached a sum first."""
    reached, mask = 1, (1 << (budget + 1)) - 1
    parent = np.full(budget + 1, -1, dtype=np.int32)
    for at, (i, number) in enumerate(chunks):
        if reached >> budget & 1:
            break
        fresh = (reached << (size[i] * number)) & mask & ~reached if size[i] * number <= budget else 0
        if fresh:
            raw = np.frombuffer(fresh.to_bytes(budget // 8 + 1, "little"), dtype=np.uint8)
            parent[np.flatnonzero(np.unpackbits(raw, bitorder="little"))] = at
            reached |= fresh
    used: dict[int, int] = {}
    total = reached.bit_length() - 1
    while total:
        i, number = chunks[parent[total]]
        used[i] = used.get(i, 0) + number
        total -= size[i] * number
    return used


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, max_repeats: float) -> DataFrame:
    """``sizes`` (source, source_size), one row per source, with ``target``. With sources
    sorted by cap / weight, those before the water level take their cap."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    place = (F.row_number().over(by_name) - 1) % len(weights) + 1
    ranked = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place.cast("int")))
    capped = ranked.withColumn("cap", F.col("source_size") * float(max_repeats)).withColumn(
        "ratio", F.col("cap") / F.col("weight")
    )
    levels = capped.withColumns(
        {
            "open_budget": F.sum("source_size").over(everything) * float(share)
            - F.coalesce(F.sum("cap").over(before), F.lit(0.0)),
            "open_weight": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
        }
    )
    # The level is that of the first source that does not reach its cap; if all do, none is open.
    is_open = F.col("cap") * F.col("open_weight") > F.col("weight") * F.col("open_budget")
    level = F.first(F.when(is_open, F.col("open_budget") / F.col("open_weight")), ignorenulls=True).over(
        by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    first = levels.withColumn("level", level)
    return first.select(
        "source",
        "source_size",
        F.coalesce(F.least("cap", F.col("weight") * F.col("level")), F.col("cap")).alias("target"),
    )


def _same(columns: Sequence[str], renamed: str) -> Column:
    """Null-safe equality of ``columns`` with those of the other side, named with ``renamed`` before."""
    return reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(renamed + c)) for c in columns])


def _ranked(rows: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``rows`` with ``rank``, from 1 in each ``group``: by ``bucket``, then by ``order``.
    A task ranks buckets; what lies before a bucket is a sum over buckets."""
    place = [*group, "bucket"]
    earlier = Window.partitionBy(*group).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(*place)
        .agg(F.count("*").alias("rows"))
        .select(*[F.col(c).alias(f"at_{c}") for c in place], F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"))
    )
    return (
        rows.repartition(*place)
        .withColumn("place", F.row_number().over(Window.partitionBy(*place).orderBy(*order)))
        .join(offsets, _same(place, "at_"))
        .withColumn("rank", F.col("before") + F.col("place"))
        .drop("bucket", "before", "place", *[f"at_{c}" for c in place])
    )


def _copies(narrow: DataFrame) -> DataFrame:
    """``narrow`` with ``copy``, from 1 among the rows of equal id, source and text."""
    key = ["id", "source", "hash"]
    repeated = stored(narrow.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1"), "mix-repeated")
    repeated = repeated.withColumnsRenamed({c: f"of_{c}" for c in key})
    many = narrow.join(repeated, _same(key, "of_")).withColumn(
        "bucket", F.pmod(F.xxhash64("row"), F.ceil(F.col("n") / BUCKET_ROWS))
    )
    single = narrow.join(repeated, _same(key, "of_"), "left_anti")
    return single.withColumn("copy", F.lit(1).cast("long")).unionByName(
        _ranked(many.drop("n", *[f"of_{c}" for c in key]), key, ["row"]).withColumnRenamed("rank", "copy")
    )


def _planned(
    docs: DataFrame,
    row: Column,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.0,
    max_repeats: int = 3,
    seed: int = 17,
    room: int = 65_536,
) -> DataFrame:
    """The rows of ``mix`` with ``row``, a number that no two rows share."""
    narrow = stored(
        docs.select(
            row.alias("row"),
            named(id_col).alias("id"),
            named(source_col).cast("string").alias("source"),
            F.coalesce(F.regexp_count(named(text_col), F.lit(WORD_PATTERN)), F.lit(0)).cast("long").alias("size"),
            F.xxhash64(F.coalesce(named(text_col), F.lit(""))).alias("hash"),
        ),
        "mix-sizes",
    )
    histogram = narrow.groupBy("source", "size").agg(F.count("*").alias("n"))
    sizes = histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = source_targets(sizes, weights, share, max_repeats).withColumnRenamed("source", "at")
    budgets = histogram.join(targets, F.col("source").eqNullSafe(F.col("at"))).drop("at")

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        whole, budget = int(group["source_size"].iloc[0]), int(round(group["target"].iloc[0]))
        base = budget // whole if whole else 0
        group["base"] = base
        name = f"{seed}|{group['source'].iloc[0]}"  # the draw is another one for each source
        group["extra"] = choose_counts(group["size"].tolist(), group["n"].tolist(), budget - base * whole, room, name)
        return group[["source", "size", "n", "source_size", "target", "base", "extra"]]

    # A group has one row for each size of a source, never one for each document.
    chosen = budgets.groupBy("source").applyInPandas(
        fit, "source string, size long, n long, source_size long, target double, base long, extra long"
    )
    plan = stored(chosen, "mix-plan").select(
        F.col("source").alias("at"), F.col("size").alias("of"), "n", "source_size", "target", "base", "extra"
    )
    draw = F.xxhash64(F.lit(seed), F.col("id"), F.col("hash"), F.col("copy"))
    placed = stored(
        _copies(narrow)
        .join(plan, F.col("source").eqNullSafe(F.col("at")) & (F.col("size") == F.col("of")))
        .withColumn("draw", draw)
        .withColumn("bucket", F.pmod(F.col("draw"), F.ceil(F.col("n") / BUCKET_ROWS)))
        .drop("at", "of"),
        "mix-placed",
    )
    whole = placed.filter((F.col("extra") == 0) | (F.col("extra") == F.col("n"))).withColumn(
        "more", F.when(F.col("extra") > 0, 1).otherwise(0)
    )
    partly = placed.filter((F.col("extra") > 0) & (F.col("extra") < F.col("n")))
    ranked = _ranked(partly, ["source", "size"], ["draw", "id", "hash", "copy"]).withColumn(
        "more", F.when(F.col("rank") <= F.col("extra"), 1).otherwise(0)
    )
    columns = ["row", "id", "source", "size", "source_size", "target", "base", "more"]
    repeats = (F.col("base") + F.col("more")).cast("long")
    return (
        whole.select(*columns)
        .unionByName(ranked.select(*columns))
        .select(
            "row",
            F.col("id").alias(id_col),
            "source",
            "size",
            "source_size",
            "target",
            F.when(F.col("size") > 0, repeats).otherwise(F.least(repeats, F.lit(1))).alias("repeats"),
            (F.col("size") * repeats).alias("taken"),
        )
    )


def mix(docs: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """One row per document: id, source, size, source_size, target, repeats, taken.
    ``weights`` go round the sources in code-point order; options as in ``_planned``."""
    return _planned(docs, F.monotonically_increasing_id(), id_col=id_col, **options).drop("row")


def mixed_documents(docs: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """The mix itself: every row as often as it is taken, with the columns of ``docs``.
    Rows that are not taken go. Repeats belong to the row, not to its id."""
    rows = numbered(docs, "mix-rows")
    wanted = _planned(rows, named(ROW), id_col=id_col, **options).filter("repeats > 0")
    wanted = wanted.select(F.col("row").alias(f"{OWN}at"), F.col("repeats").cast("int").alias(f"{OWN}repeats"))
    return (
        rows.join(wanted, named(ROW) == F.col(f"{OWN}at"))
        .withColumn(f"{OWN}copy", F.explode(F.sequence(F.lit(1), F.col(f"{OWN}repeats"))))
        .drop(ROW, f"{OWN}at", f"{OWN}repeats", f"{OWN}copy")
    )

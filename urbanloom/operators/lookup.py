"""Left lookup joins against dimensions and other small sides.

The large side must not move for a small one, so the small side is broadcast,
but only after its size in memory is known: from a closed form of its rows (calendar,
hours of a day) or from one aggregate over the side itself. A side that turns out too
large takes a plain join, in which AQE splits the partitions of hot keys.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F, types as T

BROADCAST_BYTES = 256 << 20
# Estimated bytes in memory: a row and its slot in the hash table, a column, a text of a side with a proven bound.
ROW_BYTES, COLUMN_BYTES, TEXT_BYTES = 32, 8, 64
SALTS = 16


def _texts(side: DataFrame) -> list[str]:
    """Columns without a fixed width."""
    varying = (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType)
    return [field.name for field in side.schema if isinstance(field.dataType, varying)]


def estimated_bytes(side: DataFrame) -> int:
    """Size of ``side`` in memory, from its rows and the content of its texts. A side that
    is costly to derive should be stored first (``sources.tables.settled``), so that it
    is not derived twice."""
    lengths = [F.coalesce(F.octet_length(side[name].cast("string")), F.lit(0)).cast("long") for name in _texts(side)]
    rows, content = side.agg(F.count("*"), F.sum(reduce(add, lengths, F.lit(0).cast("long")))).first()
    return rows * (ROW_BYTES + COLUMN_BYTES * len(side.columns)) + (content or 0)


def attach(
    facts: DataFrame,
    side: DataFrame,
    keys: Mapping[str, Column],
    columns: Mapping[str, str],
    row_bound: int | None = None,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``facts`` left-joined with ``side``.

    ``keys`` maps a column of ``side`` to the expression on ``facts`` it must
    equal; ``columns`` maps columns of ``side`` to their names in the result.
    ``row_bound`` is a proven size of ``side``; without one it is measured.
    """
    names = {key: f"__key_{key}" for key in keys}
    picked = side.select(
        *[side[key].alias(name) for key, name in names.items()],
        *[side[source].alias(target) for source, target in columns.items()],
    )
    width = ROW_BYTES + COLUMN_BYTES * len(picked.columns) + TEXT_BYTES * len(_texts(picked))
    size = estimated_bytes(picked) if row_bound is None else row_bound * width
    matches = [expression == picked[names[key]] for key, expression in keys.items()]
    joined = facts.join(F.broadcast(picked) if size <= max_bytes else picked, matches, "left")
    return joined.select(*[facts[name] for name in facts.columns], *columns.values())


def salted_left_join(facts: DataFrame, side: DataFrame, keys: Mapping[str, Column], salts: int = SALTS) -> DataFrame:
    """Left join that spreads every key over ``salts`` partitions.

    The salt comes from the row's own values, so a re-run task repeats it; exact
    copies of one row share a salt and are left to AQE's skew split.
    """
    salted = facts.withColumn("__salt", F.pmod(F.xxhash64(*[facts[name] for name in facts.columns]), F.lit(salts)))
    copies = side.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    matches = [expression == copies[key] for key, expression in keys.items()]
    return salted.join(copies, matches + [salted["__salt"] == copies["__copy"]], "left").drop("__salt", "__copy")

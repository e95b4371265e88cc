"""Helpers the operators share: stored tables, word pattern, row keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import new_folder

#: A word is a run of characters other than space, tab, line feed, vertical tab, form feed, carriage return.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
#: Prefix of working columns, so that a table's own columns never clash with them.
OWN = "__ul_"
ROW = f"{OWN}row"


def stored(df: DataFrame, label: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back. Lineage ends
    here: a lost executor costs no recomputation beyond this table."""
    spark = df.sparkSession
    folder = new_folder(spark, label)
    df.write.option("compression", codec).parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def numbered(df: DataFrame, label: str) -> DataFrame:
    """``df`` stored with a number of its own for each row in ``__ul_row``. Rows that repeat
    an id, or have none, stay apart by it; as it is stored, every later read gives the same."""
    return stored(df.withColumn(ROW, F.monotonically_increasing_id()), label)


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def named(column: str) -> Column:
    return F.col(f"`{column}`")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def row_key(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Add ``__ul_id`` and ``__ul_hash``: rows with equal id and text are one document,
    rows with equal id and different text are different documents."""
    return df.withColumns(
        {f"{OWN}id": named(id_col), f"{OWN}hash": F.xxhash64(F.coalesce(named(text_col), F.lit("")))}
    )

"""Scans of landed files. Schemas are given, never inferred from the data."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators.lookup import attach

Paths = str | Sequence[str]


def scan_json(spark: SparkSession, paths: Paths, schema: T.StructType, whole_file: bool = True) -> DataFrame:
    """JSON records. ``whole_file`` reads pretty-printed arrays: one file is then
    one task, which the hourly/daily slicing of the feeds keeps small. Files with
    one record or one array per line split freely with ``whole_file=False``."""
    return (
        spark.read.schema(schema)
        .option("multiLine", str(whole_file).lower())
        .option("mode", "FAILFAST")
        .json(_as_list(paths))
    )


def scan_json_arrays(spark: SparkSession, paths: Paths, schema: T.StructType, indent: int = 2) -> DataFrame:
    """Pretty-printed JSON arrays of objects, each file read by as many tasks as it has splits.

    A record of such an array begins with a line that holds its opening brace alone, at the
    array's indent; inside a record every line is indented deeper and text holds no raw line
    break. So that line is a record separator, by which files are cut like lines of text. What
    lies between two of them must be one whole object and nothing else, else the query fails:
    a file cut off inside a record, a compact array or another indent are no silent loss.
    ``unfinished_arrays`` finds files that end after a whole record without their bracket.
    """
    margin = " " * indent
    end = f"\n{margin}}}"
    cut = spark.read.option("lineSep", f"\n{margin}{{\n").text(_as_list(paths))
    text = F.col("value")
    head, tail = F.substring_index(text, end, 1), F.substring_index(text, end, -1)
    one = (F.length(head) + len(end) + F.length(tail) == F.length(text)) & F.trim(F.translate(tail, "\n\r", "")).isin(",", "]")
    broken = F.raise_error(F.concat(F.lit("not one record of a pretty-printed array: "), F.substring(text, 1, 200)))
    record = F.when(one, F.concat(F.lit("{"), head, F.lit("}"))).otherwise(broken.cast("string"))
    kept = cut.filter(~F.trim(F.translate("value", "\n\r", "")).isin("[", "[]", ""))
    return kept.select(F.from_json(record, schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def unfinished_arrays(spark: SparkSession, paths: Paths) -> DataFrame:
    """(file) of the arrays whose closing bracket is missing; one row per file moves."""
    lines = spark.read.text(_as_list(paths)).select("value", F.col("_metadata.file_path").alias("file"))
    closed = F.max(F.rtrim("value").endswith("]") & F.trim("value").isin("]", "[]"))
    return lines.groupBy("file").agg(closed.alias("closed")).filter(~F.col("closed")).select("file")


def scan_csv(spark: SparkSession, paths: Paths, schema: T.StructType) -> DataFrame:
    """CSV whose files each start with one header row."""
    return (
        spark.read.schema(schema)
        .option("header", "true")
        .option("enforceSchema", "false")
        .option("mode", "FAILFAST")
        .csv(_as_list(paths))
    )


def scan_parquet(spark: SparkSession, paths: Paths, schema: T.StructType | None = None) -> DataFrame:
    """Monthly Parquet files. A read schema avoids touching every footer and lets
    required fields become nullable; without one the footers are merged."""
    reader = spark.read.schema(schema) if schema else spark.read.option("mergeSchema", "true")
    return reader.parquet(*_as_list(paths))


def scan_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Static lookup shipped as CSV; literal ``N/A`` and ``Unknown`` stay text."""
    return spark.read.schema(schema).option("header", "true").option("nullValue", "").csv(path)


def scan_pages(spark: SparkSession, paths: Paths, schema: T.StructType, extra: str = "error") -> DataFrame:
    """The rows of all page files of a slice, aligned by the header each page has.

    Pages of one slice may differ in their columns and in their order. All are read in one
    scan: the headers first (one row per file moves, and the different headers, a handful,
    come to the driver), then the rows, each parsed by its file's header. So the plan grows with
    the number of different headers, not of pages. Columns a page lacks are null; columns that
    ``schema`` lacks fail the query, or are left out with ``extra="ignore"``. A line that
    repeats its file's header, as stitched pages do, is no row. Values hold no line breaks.
    Empty files have no rows.
    """
    if extra not in ("error", "ignore"):
        raise ValueError(f"unknown policy: {extra}")
    lines = spark.read.text(_as_list(paths)).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at")
    )
    ordered = lines.filter("at = 0").withColumn("nth", F.monotonically_increasing_id())  # a file's first block is read in order
    first = ordered.groupBy("file").agg(F.min_by("value", "nth").alias("header"))
    headers = sorted(r["header"] for r in first.select("header").distinct().collect())
    if not headers:
        return spark.createDataFrame([], schema)
    known = {f.name: f for f in schema.fields}
    parsed: Column | None = None
    for header in headers:
        names = next(csv.reader([header.removeprefix("\ufeff")]))
        unknown = [name for name in names if name not in known]
        if unknown and extra == "error":
            raise ValueError(f"columns {unknown} of a page are not in the schema")
        kinds = ", ".join(f"`{name}` {known[name].dataType.simpleString() if name in known else 'string'}" for name in names)
        row = F.from_csv("value", kinds, {"mode": "FAILFAST"})
        aligned = F.struct(
            *[(row[f.name] if f.name in names else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
        )
        parsed = F.when(F.col("header") == header, aligned) if parsed is None else parsed.when(F.col("header") == header, aligned)
    by_file = attach(lines, first, {"file": lines.file}, {"header": "header"})
    rows = by_file.filter((F.col("value") != F.col("header")) & (F.col("value") != ""))
    return rows.select(parsed.alias("r")).select("r.*")


def stitch_pages(pages: Sequence[DataFrame]) -> DataFrame:
    """One record set from the pages of a slice, aligned by column name. An empty
    page ends nothing and fails nothing: it simply adds no rows."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), pages)


def _as_list(paths: Paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)

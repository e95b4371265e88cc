"""Line dedup by winnowing, in DataFrame operations only.

A document is the sequence of its lines that hold a word; blank lines do not count. A
window is the shortest run of lines from a line on that has ``min_words`` words. The
smallest line hash of a window is its fingerprint: two copies of a run of ``min_words``
words or more hold the same windows, so they are guaranteed to share fingerprints.

1. One row per line (hash, words), then the windows of each document: those that begin at
   a line (they extend a match to the right) and those that end at it (to the left).
2. Windows of one fingerprint and content are joined with the earliest place of that
   content, found by a minimum that is combined on the map side. A line that a third of
   all documents share gives one row per place, never a pair of places.
3. Windows found earlier are merged into runs. Forward and backward windows together
   reach every line of a repeated run: a line goes exactly if it lies in a run of
   ``min_words`` words or more that also stands at an earlier place (documents by id, then
   lines by position; a run may overlap its earlier copy).
4. Runs are cut out of the texts; blank lines inside a run go with it.

Lines are compared by 64-bit hash, windows by a 64-bit hash over these. Null and empty
texts stay as they are; a text that loses all lines becomes empty. Rows of equal id and
text are one document and get one result; rows of equal id and different text are
different documents, ordered by a hash of the text. A null id comes first. All other
columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import OWN, WORD_PATTERN, named, row_key, stored

MIN_WORDS = 50
ID, HASH = f"{OWN}id", f"{OWN}hash"


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def windows(docs: DataFrame, *, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """(id, hash, first, last, mark, content): windows as line positions, with the
    fingerprint and a hash of all their lines."""
    lines = (
        row_key(docs, id_col, text_col)
        .select(ID, HASH, F.posexplode(_lines(named(text_col))).alias("pos", "line"))
        .select(ID, HASH, "pos", F.xxhash64("line").alias("h"), F.regexp_count("line", F.lit(WORD_PATTERN)).alias("words"))
        .filter(F.col("words") > 0)
        .repartition(ID, HASH)
        .dropDuplicates([ID, HASH, "pos"])
    )
    document = Window.partitionBy(ID, HASH)
    end = F.sum("words").over(document.orderBy("pos").rowsBetween(Window.unboundedPreceding, 0))
    counted = lines.withColumn("end", end).withColumn("start", F.col("end") - F.col("words"))
    # Lines have words, so "start" and "end" ascend with the position.
    ahead = document.orderBy("start").rangeBetween(0, min_words - 1)
    behind = document.orderBy("end").rangeBetween(-(min_words - 1), 0)

    def window(frame) -> Column:
        return F.struct(
            F.min("pos").over(frame).alias("first"),
            F.max("pos").over(frame).alias("last"),
            F.sum("words").over(frame).alias("words"),
            F.collect_list("h").over(frame).alias("hashes"),
        )

    return (
        counted.select(ID, HASH, window(ahead).alias("a"), window(behind).alias("b"))
        .select(ID, HASH, F.explode(F.array("a", "b")).alias("w"))
        .filter(F.col("w.words") >= min_words)
        .select(
            ID,
            HASH,
            F.col("w.first").alias("first"),
            F.col("w.last").alias("last"),
            F.array_min("w.hashes").alias("mark"),
            F.xxhash64("w.hashes").alias("content"),
        )
    )


def repeated_runs(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """(id, hash, first, last): line positions of the runs that repeat an earlier place,
    merged, so that the runs of a document are disjoint."""
    found = stored(windows(docs, id_col=id_col, text_col=text_col, min_words=min_words), "line-windows")
    place = F.struct(ID, HASH, "first")
    earliest = (
        found.groupBy("mark", "content").agg(F.min(place).alias("origin"), F.max(place).alias("final"))
        .filter(F.col("origin") != F.col("final"))
        .drop("final")
    )
    later = found.join(earliest, ["mark", "content"]).filter(place != F.col("origin")).select(ID, HASH, "first", "last")
    in_order = Window.partitionBy(ID, HASH).orderBy("first", "last")
    before = F.max("last").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(before.isNull() | (F.col("first") > before + 1), 1).otherwise(0)
    islands = later.withColumn("opens", opens).withColumn("run", F.sum("opens").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    return islands.groupBy(ID, HASH, "run").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("run")


def without_repeats(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = MIN_WORDS,
    counts: bool = False,
) -> DataFrame:
    """``docs`` with repeated runs cut out of the text. With ``counts``, the columns
    ``n_lines`` and ``n_removed`` replace any of these names."""
    runs = repeated_runs(docs, id_col=id_col, text_col=text_col, min_words=min_words)
    cuts = runs.groupBy(ID, HASH).agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias(f"{OWN}cuts"))
    cuts = cuts.withColumnsRenamed({ID: f"{OWN}at", HASH: f"{OWN}of"})
    cut = F.col(f"{OWN}cuts")
    lines = _lines(named(text_col))
    starts = F.concat(F.array(F.lit(0)), F.transform(cut, lambda c: c["last"] + 1))
    ends = F.concat(F.transform(cut, lambda c: c["first"]), F.array(F.size(F.col(f"{OWN}lines"))))
    kept = F.flatten(F.zip_with(starts, ends, lambda s, e: F.slice(F.col(f"{OWN}lines"), s + 1, F.greatest(e - s, F.lit(0)))))
    joined = (
        row_key(docs, id_col, text_col)
        .join(cuts, F.col(ID).eqNullSafe(F.col(f"{OWN}at")) & (F.col(HASH) == F.col(f"{OWN}of")), "left")
        .withColumn(f"{OWN}lines", F.when(cut.isNotNull(), lines))
    )
    removed = F.aggregate(cut, F.lit(0), lambda n, c: n + c["last"] - c["first"] + 1)
    text = F.when(cut.isNull(), named(text_col)).otherwise(F.array_join(kept, "\n"))
    out = [text.alias(c) if c == text_col else named(c) for c in docs.columns if not (counts and c in ("n_lines", "n_removed"))]
    if counts:
        total = F.coalesce(F.size(lines), F.lit(0))
        out += [
            F.when(named(text_col).isNull(), 0).otherwise(total).cast("long").alias("n_lines"),
            F.coalesce(removed, F.lit(0)).cast("long").alias("n_removed"),
        ]
    return joined.select(*out)

"""Importance resampling: documents are drawn by how like a target text their n-grams are.

Features are the runs of ``lengths`` consecutive words, hashed by CRC-32 into buckets. With
counts of all documents (S, s in a bucket) and of the target (T, t), a bucket gains
floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B)))); a document weighs the sum of its features'
gains. Seeded Gumbel noise is added and the highest scores are drawn, which samples without
replacement in proportion to the weights.

N-grams are interned per batch in an open-addressed table of NumPy columns: the slot of a gram
is found by its 64-bit xxHash with linear probing, a slot is shared only if the bytes
are equal, and each slot holds the gram's bucket and count. CRC-32 is taken once a slot; what
happens per occurrence is array work on slot ids. The first pass adds slot counts up to buckets,
one row per bucket and task; the second gathers gains by slot ids.

Only the counts of the buckets go through the driver (``buckets`` rows, whatever the input).
Texts are read in pieces cut between words, so a table's size is bounded by PIECE and not by
a text. Ranks come from range partitions.

Words are lower-cased in A-Z only and are runs of 0-9, a-z and characters beyond ASCII. Null and
empty texts have no feature and weigh 0. Rows that repeat an id are documents of their own;
among equal scores a smaller id goes first, a null id last. Empty tables count nothing:
without target all gains follow from the documents alone. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import OWN, named, stored, text_or_empty
from .ranks import RANK, ranked

#: Bytes of text that are split into words at a time.
PIECE = 1 << 20
#: Lower-case letters for A-Z, a space for every other ASCII byte that is no letter or digit.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256)
)


class GramTable:
    """An open-addressed table of the grams of one batch, as NumPy columns over the slots."""

    def __init__(self, grams: list[bytes], buckets: int):
        import xxhash

        n = len(grams)
        size = 1 << max(4, (2 * n - 1).bit_length()) if n else 16
        self.buckets = buckets
        self.first = np.full(size, -1, dtype=np.int64)
        self.key = np.zeros(size, dtype=np.uint64)
        self.slots = np.zeros(n, dtype=np.int64)
        keys = np.fromiter(map(xxhash.xxh64_intdigest, grams), dtype=np.uint64, count=n)
        held = np.empty(n, dtype=object)
        held[:] = grams
        place = (keys & np.uint64(size - 1)).astype(np.int64)
        waiting = np.arange(n)
        while len(waiting):
            at = place[waiting]
            free = self.first[at] < 0
            claims = waiting[free]
            self.first[at[free]] = claims  # one of the claims on a slot stays
            self.key[at] = keys[self.first[at]]
            owner = self.first[at]
            same = self.key[at] == keys[waiting]
            same[same] = held[owner[same]] == held[waiting[same]]  # equal hashes count only with equal bytes
            self.slots[waiting[same]] = at[same]
            waiting = waiting[~same]
            place[waiting] = (place[waiting] + 1) & (size - 1)
        self.used = np.flatnonzero(self.first >= 0)
        self.count = np.bincount(self.slots, minlength=size)
        self.bucket = np.zeros(size, dtype=np.int64)
        self.bucket[self.used] = [zlib.crc32(g) % buckets for g in held[self.first[self.used]]]

    def bucket_counts(self) -> np.ndarray:
        """Occurrences in each bucket."""
        total = np.zeros(self.buckets, dtype=np.int64)
        np.add.at(total, self.bucket[self.used], self.count[self.used])
        return total

    def gathered(self, gains: np.ndarray) -> np.ndarray:
        """The gain of each occurrence, in the order of the grams."""
        return gains[self.bucket][self.slots]


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, in lists of at most PIECE bytes; a longer word is one piece."""
    folded = text.translate(_FOLD)
    start = 0
    while start < len(folded):
        end = min(start + PIECE, len(folded))
        if end < len(folded) and folded[end] != 32:
            cut = folded.rfind(b" ", start, end)
            if cut <= start:
                cut = folded.find(b" ", end)
            end = len(folded) if cut < 0 else cut
        yield folded[start:end].split()
        start = end


def batched_grams(texts: Iterator[bytes], lengths: tuple[int, int]) -> Iterator[tuple[list[bytes], list[int], list[int]]]:
    """Batches of (grams, text of each run of grams, its length). Runs of words go on over
    the pieces of a text."""
    least, most = lengths
    grams, owners, sizes, room = [], [], [], 0
    for k, text in enumerate(texts):
        carried: list[bytes] = []
        for words in _pieces(text):
            before = len(grams)
            all_words = carried + words
            for n in range(least, most + 1):
                # a run is new here if its last word is
                own = all_words[max(0, len(carried) - n + 1) :]
                grams.extend(own if n == 1 else [b" ".join(own[i : i + n]) for i in range(len(own) - n + 1)])
            carried = all_words[len(all_words) - most + 1 :] if most > 1 else []
            owners.append(k)
            sizes.append(len(grams) - before)
            room += sum(map(len, words)) * (most - least + 1)
            if room >= PIECE:
                yield grams, owners, sizes
                grams, owners, sizes, room = [], [], [], 0
    if owners:
        yield grams, owners, sizes


def _bytes(column: pa.Array) -> Iterator[bytes]:
    return (value.as_buffer().to_pybytes() if value.is_valid else b"" for value in column)


def bucket_counts(docs: DataFrame, *, text_col: str, lengths: tuple[int, int], buckets: int) -> np.ndarray:
    """Occurrences of features in each bucket over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for grams, _, _ in batched_grams(_bytes(batch.column(0)), lengths):
                total += GramTable(grams, buckets).bucket_counts()
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["bucket", "n"])

    counted = docs.select(text_or_empty(text_col).cast("binary").alias("text")).mapInArrow(run, "bucket long, n long")
    total = np.zeros(buckets, dtype=np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).toLocalIterator():
        total[row["bucket"]] = row["n"]
    return total


def bucket_gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    buckets = len(documents)
    above = (target + 1).astype(np.float64) * float(documents.sum() + buckets)
    below = (documents + 1).astype(np.float64) * float(target.sum() + buckets)
    return np.floor(1000.0 * np.log(above / below)).astype(np.int64)


def weights(docs: DataFrame, gains: np.ndarray, *, id_col: str, text_col: str, lengths: tuple[int, int]) -> DataFrame:
    """(id, n_words, n_features, weight) of each document."""
    source = docs.select(named(id_col).alias("id"), text_or_empty(text_col).cast("binary").alias("text"))
    schema = T.StructType(
        [T.StructField("id", source.schema["id"].dataType)] + [T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight")]
    )
    least, most = lengths

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            features, weight = np.zeros(batch.num_rows, dtype=np.int64), np.zeros(batch.num_rows, dtype=np.int64)
            for grams, owners, sizes in batched_grams(_bytes(batch.column(1)), lengths):
                gained = np.concatenate([[0], np.cumsum(GramTable(grams, len(gains)).gathered(gains))])
                ends = np.cumsum(sizes)
                np.add.at(features, owners, sizes)
                np.add.at(weight, owners, gained[ends] - gained[ends - np.array(sizes)])
            if least == most == 1:
                words = features
            else:
                words = np.array([sum(map(len, _pieces(text))) for text in _bytes(batch.column(1))], dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(a) for a in (words, features, weight))], names=["id", "n_words", "n_features", "weight"]
            )

    return source.mapInArrow(run, schema)


def noise(id_: Column, seed: int) -> Column:
    """Seeded Gumbel noise of an id, in thousandths."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))), 256)
    drawn = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000.0 * F.log(-F.log((drawn + 0.5) / 4294967296.0)))


def resampled(
    docs: DataFrame,
    target: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text: str = "text",
    lengths: tuple[int, int] = (1, 2),
    buckets: int = 10_000,
    least_words: int = 20,
    percent: int = 10,
    seed: int = 2024,
) -> DataFrame:
    """One row per document: id, n_words, n_features, weight, score, rank (null if not drawn).
    Of the documents with ``least_words`` words, floor(``percent`` N / 100) are drawn."""
    options = {"lengths": lengths, "buckets": buckets}
    gains = bucket_gains(
        bucket_counts(docs, text_col=text_col, **options), bucket_counts(target, text_col=target_text, **options)
    )
    found = weights(docs, gains, id_col=id_col, text_col=text_col, lengths=lengths)
    scored = found.withColumns({"score": F.col("weight") + noise(F.col("id"), seed), f"{OWN}row": F.monotonically_increasing_id()})
    scored = stored(scored, "importance-scores")
    able = scored.filter(F.col("n_words") >= least_words)
    take = able.count() * percent // 100
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col(f"{OWN}row").asc()]
    drawn = ranked(able, order, "importance-order").withColumn("rank", F.when(F.col(RANK) < take, F.col(RANK) + 1)).drop(RANK)
    columns = ["id", "n_words", "n_features", "weight", "score", "rank"]
    rest = scored.filter(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return drawn.select(*columns).unionByName(rest.select(*columns))

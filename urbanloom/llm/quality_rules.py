"""Quality rules: word and repetition counts, and compression bands.

The method's verdict comes from zstandard: the ratio of raw to compressed bytes of the
whole text and of fixed chunks must lie in a band. Text that compresses too well repeats
itself; text that hardly compresses is noise. Short texts compress less for want of
context, so the band depends on the length. A text fails if its own ratio leaves its
band, or if more than ``chunk_share`` of its full chunks leave the band of chunks.

Every text is read whole, in Arrow batches, without a shuffle. Null text counts as empty:
no words, base_failed, not kept. Rows that repeat an id are judged one by one. Other
columns are ignored by ``judge`` and kept by ``kept_documents``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import named, text_or_empty

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
SPACES = b" \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Bands:
    """(bytes from, least ratio, greatest ratio); the last row that the length reaches counts.
    Chosen on documents of natural prose in four languages; texts under the first row's
    length are too short for a verdict and pass."""

    rows: tuple[tuple[int, float, float], ...] = (
        (150, 1.0, 1.87),
        (400, 1.2, 2.05),
        (800, 1.35, 2.17),
        (1_300, 1.5, 2.28),
        (2_500, 1.6, 2.4),
        (5_000, 1.7, 2.5),
        (10_000, 1.8, 2.62),
        (32_000, 1.85, 2.72),
    )
    chunk_bytes: int = 4_096
    chunk_band: tuple[float, float] = (1.45, 2.7)
    chunk_share: float = 0.5
    level: int = 3

    def of(self, size: int) -> tuple[float, float] | None:
        found = None
        for start, least, most in self.rows:
            if size >= start:
                found = (least, most)
        return found


@dataclass
class Judge:
    bands: Bands = field(default_factory=Bands)

    def __post_init__(self):
        import zstandard

        self.compress = zstandard.ZstdCompressor(level=self.bands.level).compress

    def ratios(self, raw: bytes) -> tuple[float, float, bool]:
        """Ratio of the whole text, share of full chunks outside their band, verdict."""
        if not raw:
            return 0.0, 0.0, True
        bands, size = self.bands, len(raw)
        whole = size / len(self.compress(raw))
        step, (low, high) = bands.chunk_bytes, bands.chunk_band
        full = size // step
        out = sum(not low <= step / len(self.compress(raw[k * step : (k + 1) * step])) <= high for k in range(full))
        share = out / full if full else 0.0
        band = bands.of(size)
        return whole, share, band is None or (band[0] <= whole <= band[1] and share <= bands.chunk_share)


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of WINDOW words found twice or more in the text."""
    n = len(words)
    if n <= WINDOW:
        return 0
    index: dict[bytes, int] = {}
    ids = np.array([index.setdefault(w, len(index)) for w in words], dtype=np.int64)
    if len(index) == n:
        return 0
    # Windows of 2, 4 and 8 words get a number each: equal numbers, equal windows.
    span = 1
    while span < WINDOW:
        pairs = ids[:-span] * (int(ids.max()) + 1) + ids[span:]
        found, ids, times = np.unique(pairs, return_inverse=True, return_counts=True)
        if len(found) == len(pairs):
            return 0
        span *= 2
    starts = np.flatnonzero(times[ids] > 1)
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + WINDOW, -1)
    return int((np.cumsum(edge)[:n] > 0).sum())


def measure(text: str) -> tuple[int, int, int, int, int, bytes]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the text's bytes."""
    raw = text.encode("utf-8", "replace")
    words = raw.split()  # bytes.split() cuts at exactly the six ASCII spaces
    word_chars = len(text) - sum(map(raw.count, (SPACES[k : k + 1] for k in range(6))))
    symbols = sum(map(raw.count, (SYMBOLS[k : k + 1] for k in range(8))))
    lines = [line for line in raw.split(b"\n") if line and not line.isspace()]
    return len(words), word_chars, symbols, len(lines) - len(set(lines)), repeated_words(words), raw


_FIELDS = [
    ("n_words", T.LongType(), pa.int64()),
    ("word_chars", T.LongType(), pa.int64()),
    ("n_symbols", T.LongType(), pa.int64()),
    ("n_dup_lines", T.LongType(), pa.int64()),
    ("n_repeat_words", T.LongType(), pa.int64()),
    ("base_failed", T.BooleanType(), pa.bool_()),
    ("ratio", T.DoubleType(), pa.float64()),
    ("chunks_out", T.DoubleType(), pa.float64()),
    ("kept", T.BooleanType(), pa.bool_()),
]


def _judged(text: str, judge: Judge) -> tuple:
    n_words, word_chars, symbols, dup_lines, repeat_words, raw = measure(text)
    failed = n_words < 20 or 100 * repeat_words > 30 * n_words
    ratio, out, passed = judge.ratios(raw)
    return n_words, word_chars, symbols, dup_lines, repeat_words, failed, ratio, out, not failed and passed


def judge(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", bands: Bands = Bands()) -> DataFrame:
    """One row per document: id, the counts, base_failed, ratio, chunks_out, kept."""
    source = docs.select(named(id_col).alias("id"), text_or_empty(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(bands)
        for batch in batches:
            rows = [_judged(text.as_py(), judge) for text in batch.column(1)]
            columns = zip(*rows) if rows else [[] for _ in _FIELDS]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(v, kind) for v, (_, _, kind) in zip(columns, _FIELDS))],
                names=["id", *(name for name, _, _ in _FIELDS)],
            )

    fields = [T.StructField("id", source.schema["id"].dataType), *(T.StructField(n, t) for n, t, _ in _FIELDS)]
    return source.mapInArrow(run, T.StructType(fields))


def kept_documents(docs: DataFrame, *, text_col: str = "text", bands: Bands = Bands()) -> DataFrame:
    """The documents that pass, with all their columns; one pass, no join."""
    schema, names = docs.schema, docs.columns
    place = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(bands)
        for batch in batches:
            keep = [_judged(text.as_py() or "", judge)[-1] for text in batch.column(place)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, schema)



"""Removal of byte runs that an earlier document holds, from merged suffix orders.

A byte goes if it is covered by a string of ``depth`` bytes that also starts in a document with
a smaller id. Matches never cross documents, overlaps count, and strings are judged on the
input. All occurrences of a string must meet, and no task may see the whole text:

0. Copies. Texts are cut where their content says so into chunks of some hundred bytes, each
   with all strings that start in it. A chunk that several documents hold is one text with the
   smallest id it occurs in: with a larger id all its strings go, and only that one text takes
   part in what follows. Thousands of copies of a document cost as much as one.
1. Routing. Among the ``GRAM``-byte grams of a string, the one with the smallest hash (the first
   of equal ones) is the string's anchor, so equal strings have one anchor wherever they stand.
   Neighbouring starts with one anchor form a segment, of at most twice ``depth`` bytes; the
   anchor's hash is its key. A string also holds the anchor with GRAM bytes more to its left or to
   its right. These longer grams are counted, once per document; where one occurs in a single
   document, the strings that hold it match nothing. Fingerprints of 32 bits are counted in
   buckets that follow the size of the text, packed per batch. Which grams repeat goes to all
   tasks as a filter in which each bucket has bits of its own, so it lets as few single ones
   pass from a large text as from a small one: 64 KB for 16 MB of text, 128 MB at most, which
   32 GB of text reach; beyond that more single ones pass, which costs time only.
2. Keys, without their bytes, get the smallest and the largest id and the smallest and the
   largest hash of a segment, by a map-side minimum. A key of one document matches nothing. A
   key with one segment is one interval by itself: there is nothing to merge. The bytes of the
   others alone move on (such a filter names their keys): equal segments of a key are one
   row. A key with many different segments is dealt anew by longer windows: strings with
   the anchor at nearly the same place share all bytes but a few. Most of what stands
   around a common phrase is alone with its window; only a window that still has many
   pieces is cut by the hash of the whole string, so no key is a large group.
3. Merging. Keys are dealt to groups of about GROUP bytes. In a group the segments are dealt to
   shards, each shard has its Burrows-Wheeler transform, and the transforms are merged
   by refining their interleave for ``depth`` rounds (see ``interleave``). The repeated
   intervals give the smallest id of each string.
4. Runs of starts whose smallest id is below the segment's largest go back to the segment's
   occurrences; each document joins its covered runs and is cut.

The first step carries about half a byte of fingerprints a byte of text, the others only what
repeats; texts are shuffled once, for the last step.

Null texts are empty. A null id stands after all others: its repeats of others go, others
never go for it. Rows that repeat an id are one document in this respect: none goes for the
other. Ids are integers. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import OWN, named, stored, text_or_empty
from .interleave import repeated

GRAM = 16
#: Bytes of text, and keys, of a bucket of a filter.
BUCKET, KEYS = 1 << 24, 1 << 16
#: Bits of a bucket for grams and keys and for chunks, and of a whole filter, as powers of two.
GRAM_BITS, CHUNK_BITS, MOST_BITS = 19, 16, 30
#: Bytes of segments of a group, and bytes of a shard.
GROUP, SHARD = 1 << 19, 1 << 16
#: Segments above which a key is cut: so many, or one of SHARE of all up to HEAVIEST.
HEAVY, SHARE, HEAVIEST = 2_048, 1_024, 16_384
#: Starts of a string whose anchors are near enough for one window.
NEAR = 9
#: One place in so many begins a chunk, of this many starts at most.
CHUNK, LONGEST = 256, 1 << 14
#: Starts that are worked on at a time; a place within them fits the bits of _PLACE.
BLOCK = 1 << 16
_PLACE = np.uint64((1 << 20) - 1)
_ONE, _TWO = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _words(text: bytes | memoryview) -> np.ndarray:
    """The eight bytes from each place on, as integers."""
    return np.ndarray((max(0, len(text) - 7),), dtype="<u8", buffer=text, strides=(1,)).copy()


def _gram_hashes(text: bytes | memoryview) -> np.ndarray:
    """Hash of the GRAM = 16 bytes from each place on."""
    words = _words(text)
    value = words[:-8] * _ONE + (words[8:] ^ (words[8:] >> np.uint64(29))) * _TWO
    value ^= value >> np.uint64(32)
    value *= _ONE
    value ^= value >> np.uint64(29)
    return value


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of ``width`` values from each place on."""
    seen = 1
    while seen * 2 <= width:
        values, seen = np.minimum(values[:-seen], values[seen:]), seen * 2
    return values if seen == width else np.minimum(values[: len(values) - (width - seen)], values[width - seen :])


class Segments(NamedTuple):
    """Segments of a text: ``count`` starts from ``start`` on have the anchor at ``anchor`` with
    hash ``key``. Starts up to ``turn`` hold the anchor's wider gram ``left``, later ones hold
    ``right``; a side without starts has no gram."""

    key: np.ndarray
    start: np.ndarray
    count: np.ndarray
    turn: np.ndarray
    left: np.ndarray
    right: np.ndarray

    def grams(self, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, gram), rows ascending for each side."""
        left, right = self.turn > self.start, self.turn < self.start + self.count
        rows, grams = np.concatenate([row[left], row[right]]), np.concatenate([self.left[left], self.right[right]])
        order = np.argsort(rows, kind="stable")
        return rows[order], grams[order]

    def kept(self, wanted: Callable[[np.ndarray], np.ndarray]) -> tuple[np.ndarray, ...]:
        """(number, key, start, count) of what holds a wanted gram."""
        end = self.start + self.count
        first = np.where(wanted(self.left), self.start, np.maximum(self.turn, self.start))
        last = np.where(wanted(self.right), end, np.minimum(self.turn, end))
        some = last > first
        return np.flatnonzero(some), self.key[some], first[some], (last - first)[some]


#: (row, text, first start, end of the starts) of a part of a text.
Piece = tuple[int, bytes, int, int]


def segments(pieces: Iterable[Piece], depth: int) -> Iterator[tuple[np.ndarray, Segments]]:
    """(row, segments) of the pieces. Short pieces are worked on together, long ones in blocks."""
    held: list[Piece] = []
    room = 0
    for row, text, first, end in pieces:
        for begin in range(first, end, BLOCK):
            held.append((row, text, begin, min(end, begin + BLOCK)))
            room += held[-1][3] - begin + depth
            if room >= BLOCK:
                yield _joined_segments(held, depth)
                held, room = [], 0
    if held:
        yield _joined_segments(held, depth)


def _joined_segments(pieces: list[Piece], depth: int) -> tuple[np.ndarray, Segments]:
    text = b"".join([t[a : b + depth - 1] for _, t, a, b in pieces])
    counts = np.array([b - a for *_, a, b in pieces])
    bases = np.cumsum(counts + depth - 1) - (counts + depth - 1)
    grams = _gram_hashes(text)
    # the low bits hold the place, so of equal hashes the first one is the least
    low = _least((grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64), depth - GRAM + 1)
    piece = np.repeat(np.arange(len(pieces)), counts)
    at = np.arange(len(piece)) + (bases - (np.cumsum(counts) - counts))[piece]  # strings that lie in one piece
    low = low[at]
    heads = np.flatnonzero(np.concatenate([[True], (low[1:] != low[:-1]) | (piece[1:] != piece[:-1])]))
    anchor = (low[heads] & _PLACE).astype(np.int64)
    key = grams[anchor]
    left, right = grams[np.maximum(anchor - GRAM, 0)], grams[np.minimum(anchor + GRAM, len(grams) - 1)]
    shift = np.array([a for *_, a, _ in pieces])[piece[heads]] - bases[piece[heads]]
    turn = anchor - GRAM + 1  # from here on the string no longer reaches GRAM bytes to the left
    found = Segments(
        key, at[heads] + shift, np.diff(np.append(heads, len(low))), turn + shift, (left * _ONE ^ key) * _TWO, (key * _ONE ^ right) * _TWO
    )
    return np.array([row for row, *_ in pieces])[piece[heads]], found


def chunks(texts: list[bytes], depth: int) -> list[tuple[list[int], np.ndarray]]:
    """For each text the bounds of the chunks among its starts, and the hash of all bytes that each
    chunk's strings cover. Some eight bytes, by their hash, begin a chunk."""
    import xxhash

    found: list[tuple[list[int], np.ndarray]] = []
    at = 0
    while at < len(texts):
        stop, room = at, 0
        while stop < len(texts) and (stop == at or room + len(texts[stop]) <= BLOCK):
            room, stop = room + len(texts[stop]), stop + 1
        words = _words(b"".join(texts[at:stop]))
        heads = np.flatnonzero(((words * _ONE) >> np.uint64(40)) & np.uint64(CHUNK - 1) == 0)
        base = 0
        for text in texts[at:stop]:
            n = len(text) - depth + 1
            if n > 0:
                inner = heads[np.searchsorted(heads, base + 1) : np.searchsorted(heads, base + n)] - base
                cuts = [0, *inner.tolist(), n]
                if n > LONGEST:
                    cuts = [c for a, b in zip(cuts, cuts[1:]) for c in range(a, b, LONGEST)] + [n]
                hashes = [xxhash.xxh64_intdigest(text[a : b + depth - 1]) for a, b in zip(cuts, cuts[1:])]
                found.append((cuts, np.array(hashes, dtype=np.uint64)))
            else:
                found.append(([], np.zeros(0, dtype=np.uint64)))
            base += len(text)
        at = stop
    return found


def _bytes(value: pa.Scalar) -> bytes:
    return value.as_buffer().to_pybytes() if value.is_valid else b""


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, own, hash, text): own orders the documents; id and hash name an occurrence."""
    text = text_or_empty(text_col).cast("binary")
    own = F.coalesce(named(id_col).cast("long"), F.lit(2**63 - 1))
    return docs.select(named(id_col).alias("id"), own.alias("own"), F.xxhash64(named(id_col), text).alias("hash"), text.alias("text"))


def _own_pieces(texts: list[bytes], is_chunk: list[bool], copied: Filter, depth: int) -> Iterator[Piece]:
    """The pieces of texts outside copied chunks; a chunk is one piece."""
    plain = [k for k, whole in enumerate(is_chunk) if not whole]
    cut = dict(zip(plain, chunks([texts[k] for k in plain], depth)))
    for k, text in enumerate(texts):
        if k not in cut:
            yield k, text, 0, len(text) - depth + 1
            continue
        cuts, hashes = cut[k]
        if not cuts:
            continue
        gone = np.concatenate([[True], copied(hashes), [True]])
        begins, ends = np.flatnonzero(gone[:-1] & ~gone[1:]), np.flatnonzero(~gone[:-1] & gone[1:])
        for a, b in zip(begins.tolist(), ends.tolist()):
            yield k, text, cuts[a], cuts[b]


def _place(gram: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and 32-bit fingerprint of hashes; buckets rise with the hashes."""
    return ((gram >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32), (gram & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _bits(mark: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of fingerprints among the 2 ** width of their bucket."""
    mark = mark.astype(np.uint64)
    return mark & np.uint64((1 << width) - 1), ((mark * np.uint64(0x9E3779B1)) & np.uint64(0xFFFFFFFF)) >> np.uint64(32 - width)


class Filter:
    """Hashes that were put in, and a few others: each sets two bits of its bucket's."""

    def __init__(self, bits: bytes, buckets: int, width: int):
        self.bits, self.buckets, self.width = bits, buckets, width

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        bucket, mark = _place(hashes, self.buckets)
        one, two = _bits(mark, self.width)
        base = bucket << np.uint64(self.width)
        found = self._set(base + one)
        able = np.flatnonzero(found)
        found[able] = self._set((base + two)[able])
        return found

    def _set(self, place: np.ndarray) -> np.ndarray:
        octets = np.frombuffer(self.bits, dtype=np.uint8)
        return (octets[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1


def _by_bucket(hashes: np.ndarray, buckets: int) -> pa.RecordBatch:
    """(bucket, marks): the fingerprints of ascending hashes, packed."""
    bucket, mark = _place(hashes, buckets)
    heads = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, dtype=np.int64)
    ends = np.append(heads[1:], len(bucket))
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[heads].astype(np.int64)), pa.array([mark[a:b].tobytes() for a, b in zip(heads, ends)], pa.binary())],
        names=["bucket", "marks"],
    )


def _filter(packed: DataFrame, buckets: int, width: int, *, twice: bool) -> Filter:
    """The filter of (bucket, marks): of marks that come ``twice`` or of all. Each bucket's bits are
    made by one task; all of them together have 2 ** MOST_BITS at most."""
    width = max(3, min(width, MOST_BITS - (buckets - 1).bit_length()))

    def fill(key: tuple, rows: pa.Table) -> pa.Table:
        marks = np.frombuffer(b"".join(rows.column("marks").to_pylist()), dtype=np.uint32)
        if twice:
            marks = np.sort(marks)
            marks = marks[1:][marks[1:] == marks[:-1]]
        bits = np.zeros(1 << width, dtype=bool)
        for place in _bits(marks, width):
            bits[place] = True
        return pa.table({"bucket": pa.array([key[0].as_py()], pa.int64()), "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})

    octets = np.zeros((buckets, 1 << (width - 3)), dtype=np.uint8)
    made = packed.groupBy("bucket").applyInArrow(fill, "bucket long, bits binary").toArrow()  # a row per bucket
    for bucket, bits in zip(made.column("bucket").to_pylist(), made.column("bits")):
        octets[bucket] = np.frombuffer(bits.as_buffer(), dtype=np.uint8)
    return Filter(octets.tobytes(), buckets, width)


def _once_a_row(row: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Values in order, once per row, rows ascending, and at most two of a kind."""
    order = np.argsort(value, kind="stable")
    row, value = row[order], value[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    value = value[new]
    return _two_of_a_kind(value)


def _two_of_a_kind(value: np.ndarray) -> np.ndarray:
    more = np.ones(len(value), dtype=bool)
    more[2:] = value[2:] != value[:-2]
    return value[more]


Hashes = Callable[[list[bytes], list[bool]], Iterator[tuple[np.ndarray, np.ndarray]]]


def repeated_hashes(source: DataFrame, hashes: Hashes, width: int) -> Filter:
    """What occurs in two rows or more of the 64-bit ``hashes`` (row, hash) of texts; ``source``
    has text and is_chunk. A value that a very long text holds far apart may count as repeated,
    which costs time only. A bucket has 2 ** ``width`` bits."""
    size = source.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    buckets = max(64, -(-size // BUCKET))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [_bytes(value) for value in batch.column(0)]
            found = [_once_a_row(*pair) for pair in hashes(texts, batch.column(1).to_pylist())]
            yield _by_bucket(_two_of_a_kind(np.sort(np.concatenate([np.zeros(0, dtype=np.uint64), *found]))), buckets)

    packed = source.select("text", "is_chunk").mapInArrow(pack, "bucket long, marks binary")
    return _filter(packed, buckets, width, twice=True)


def copied_chunks(source: DataFrame, depth: int) -> tuple[Filter, DataFrame]:
    """The chunks that occur in two rows or more, and their occurrences (chunk, own, hash, start,
    text)."""

    def own(texts: list[bytes], _: list[bool]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        cut = [hashes for _, hashes in chunks(texts, depth)]
        yield np.repeat(np.arange(len(cut)), [len(h) for h in cut]), np.concatenate([np.zeros(0, dtype=np.uint64), *cut])

    repeats = repeated_hashes(source, own, CHUNK_BITS)
    shared = source.sparkSession.sparkContext.broadcast(repeats)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found, starts, texts = [], [], [], []
            raw = [_bytes(value) for value in batch.column(2)]
            for k, (text, (cuts, hashes)) in enumerate(zip(raw, chunks(raw, depth))):
                for i in np.flatnonzero(shared.value(hashes)).tolist():
                    rows.append(k)
                    found.append(hashes[i])
                    starts.append(cuts[i])
                    texts.append(text[cuts[i] : cuts[i + 1] + depth - 1])
            of = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.array(found, dtype=np.uint64).view(np.int64)), batch.column(0).take(of), batch.column(1).take(of),
                    pa.array(starts, pa.int64()), pa.array(texts, pa.binary()),
                ],
                names=["chunk", "own", "hash", "start", "text"],
            )

    rows = source.select("own", "hash", "text").mapInArrow(run, "chunk long, own long, hash long, start long, text binary")
    return repeats, stored(rows, "suffix-copies")


def _wider_grams(copied: Filter, depth: int) -> Hashes:
    def own(texts: list[bytes], is_chunk: list[bool]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for row, part in segments(_own_pieces(texts, is_chunk, copied, depth), depth):
            yield part.grams(row)

    return own


def occurrences(source: DataFrame, repeats: Filter, copied: Filter, depth: int) -> DataFrame:
    """(is_chunk, own, hash, key, part, start, starts, segment) of the segments that hold repeated
    grams; ``part`` is the segment's own hash."""
    shared = source.sparkSession.sparkContext.broadcast((repeats, copied))
    schema = "is_chunk boolean, own long, hash long, key long, part long, start long, starts long, segment binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        wanted, gone = shared.value
        names = ["is_chunk", "own", "hash", "key", "part", "start", "starts", "segment"]
        for batch in batches:
            rows, keys, starts, counts, texts = [], [], [], [], []

            def out() -> pa.RecordBatch:
                of = pa.array(np.concatenate(rows).astype(np.int64))
                parts = np.fromiter(map(xxhash.xxh64_intdigest, texts), dtype=np.uint64, count=len(texts))
                columns = [
                    *[batch.column(c).take(of) for c in (3, 0, 1)], pa.array(np.concatenate(keys).view(np.int64)),
                    pa.array(parts.view(np.int64)), pa.array(np.concatenate(starts)), pa.array(np.concatenate(counts)),
                    pa.array(texts, pa.binary()),
                ]
                return pa.RecordBatch.from_arrays(columns, names=names)

            raw = [_bytes(value) for value in batch.column(2)]
            for row, part in segments(_own_pieces(raw, batch.column(3).to_pylist(), gone, depth), depth):
                number, key, start, count = part.kept(wanted)
                if len(key):
                    rows.append(row[number])
                    keys.append(key)
                    starts.append(start)
                    counts.append(count)
                    ends = (start + count + depth - 1).tolist()
                    texts.extend([raw[k][a:b] for k, a, b in zip(row[number].tolist(), start.tolist(), ends)])
                if len(texts) > 50_000:
                    yield out()
                    rows, keys, starts, counts, texts = [], [], [], [], []
            if texts:
                yield out()

    return source.select("own", "hash", "text", "is_chunk").mapInArrow(run, schema)


Cut = Callable[[pa.RecordBatch, list[bytes]], Iterator[list[tuple[int, int, int]]]]


def _in_pieces(rows: DataFrame, cut: Cut, depth: int) -> DataFrame:
    """Segments in pieces: for each row, ``cut`` gives (first start, end of the starts, sub)."""
    names = ["key", "sub", "part", "first", "last", "offset", "segment"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, subs, offsets, pieces = [], [], [], []
            texts = [_bytes(value) for value in batch.column("segment")]
            for k, (text, bounds) in enumerate(zip(texts, cut(batch, texts))):
                for a, b, sub in bounds:
                    of.append(k)
                    subs.append(sub)
                    offsets.append(a)
                    pieces.append(text[a : b + depth - 1])
            rows = pa.array(of, pa.int64())
            key, part, first, last, offset = (batch.column(c).take(rows) for c in ("key", "part", "first", "last", "offset"))
            shift = pa.array(offset.to_numpy() + np.array(offsets, dtype=np.int64))
            subs = pa.array(np.array(subs, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([key, subs, part, first, last, shift, pa.array(pieces, pa.binary())], names=names)

    return rows.mapInArrow(run, "key long, sub long, part long, first long, last long, offset long, segment binary")


def _anchors(key: np.ndarray, texts: list[bytes]) -> np.ndarray:
    """Where in each segment its anchor stands: the first gram whose hash is the key."""
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    begins = np.cumsum(lengths) - lengths
    row = np.repeat(np.arange(len(texts)), lengths)[: 1 - GRAM]
    place = np.flatnonzero(_gram_hashes(b"".join(texts)) == key[row])
    return place[np.searchsorted(row[place], np.arange(len(texts)))] - begins


def _by_window(depth: int) -> Cut:
    """Starts that lie up to NEAR places apart before the anchor, named by the bytes that all their strings hold."""

    def cut(batch: pa.RecordBatch, texts: list[bytes]) -> Iterator[list[tuple[int, int, int]]]:
        import xxhash

        if not texts:
            return
        for text, anchor in zip(texts, _anchors(batch.column("key").to_numpy().view(np.uint64), texts).tolist()):
            bounds = []
            for far in range(0, depth - GRAM + 1, NEAR):
                near = min(far + NEAR, depth - GRAM + 1) - 1
                a, b = max(0, anchor - near), min(len(text) - depth, anchor - far) + 1
                if a < b:
                    bounds.append((a, b, xxhash.xxh64_intdigest(text[anchor - far : anchor - near + depth], far)))
            yield bounds

    return cut


def _by_string(depth: int) -> Cut:
    """Starts that the hash of the whole string deals to one of ``cuts`` parts. Neighbours with
    one part stay together."""

    def cut(batch: pa.RecordBatch, texts: list[bytes]) -> Iterator[list[tuple[int, int, int]]]:
        import xxhash

        for text, sub, cuts in zip(texts, batch.column("sub").to_pylist(), batch.column("cuts").to_pylist()):
            dealt = [xxhash.xxh64_intdigest(text[i : i + depth]) % cuts for i in range(len(text) - depth + 1)]
            turns = [0, *(i for i in range(1, len(dealt)) if dealt[i] != dealt[i - 1]), len(dealt)]
            yield [(a, b, xxhash.xxh64_intdigest(b"%d %d" % (sub, dealt[a]))) for a, b in zip(turns, turns[1:])]

    return cut


def _over(rows: DataFrame, by: list[str], most: int, label: str) -> DataFrame:
    """What occurs more than ``most`` times, which is few, and into how many parts it is to be cut."""
    many = rows.groupBy(*by).agg(F.count("*").alias("n")).filter(F.col("n") > most)
    return stored(many.select(*by, F.ceil(F.col("n") / max(1, most // 2)).alias("cuts")), label)


def _runs_of_group(rows: pa.Table, depth: int) -> pa.Table:
    """(key, part, offset, starts, least): runs of starts of a segment with one smallest id,
    where that id is below the segment's largest."""
    key, sub, part, first, last, shift = (
        rows.column(c).to_numpy() for c in ("key", "sub", "part", "first", "last", "offset")
    )
    texts = rows.column("segment").to_pylist()
    size = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    order = np.lexsort((sub, key))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (key[order][1:] != key[order][:-1]) | (sub[order][1:] != sub[order][:-1])
    heads = np.flatnonzero(new)
    sizes = np.diff(np.append(heads, len(order)))
    open_ = np.minimum.reduceat(first[order], heads) < np.maximum.reduceat(last[order], heads)
    out: list[tuple[np.ndarray, ...]] = []
    single = order[heads[(sizes == 1) & open_]]
    out.append((single, shift[single], size[single] - depth + 1, first[single]))
    waiting: list[int] = []
    room = 0
    several = np.flatnonzero((sizes > 1) & open_).tolist()
    for k, g in enumerate(several):
        own = order[heads[g] : heads[g] + sizes[g]]
        waiting.extend(own.tolist())
        room += int(size[own].sum())
        if room >= GROUP or k == len(several) - 1:
            of = np.array(waiting)
            string, place, interval = repeated([texts[i] for i in waiting], depth, -(-room // SHARD))
            shared = np.full(interval.max(initial=-1) + 1, np.iinfo(np.int64).max, dtype=np.int64)
            np.minimum.at(shared, interval, first[of[string]])
            count = size[of] - depth + 1
            begin = np.cumsum(count) - count
            at, offset = np.repeat(of, count), np.arange(count.sum()) - np.repeat(begin, count)
            least = first[at]  # a string of one segment only has that segment's documents
            least[begin[string] + place] = shared[interval]
            keep = least < last[at]
            at, offset, least = at[keep], offset[keep], least[keep]
            apart = np.ones(len(at), dtype=bool)
            apart[1:] = (at[1:] != at[:-1]) | (least[1:] != least[:-1]) | (offset[1:] != offset[:-1] + 1)
            starts = np.flatnonzero(apart)
            out.append((at[starts], offset[starts] + shift[at[starts]], np.diff(np.append(starts, len(at))), least[starts]))
            waiting, room = [], 0
    at, offset, count, least = (np.concatenate(x) for x in zip(*out))
    return pa.table({"key": key[at], "part": part[at], "offset": offset, "starts": count, "least": least})


def _mixed(key: np.ndarray) -> np.ndarray:
    """Keys as evenly spread hashes: as they are the smallest ones, their high bits are small."""
    mixed = (key ^ (key >> np.uint64(32))) * _TWO
    return mixed ^ (mixed >> np.uint64(29))


def _of_keys(found: DataFrame, keys: DataFrame) -> DataFrame:
    """(key, part, own, segment) of ``keys``. The filter may let others pass, which costs time only."""
    buckets = max(64, -(-keys.count() // KEYS))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _by_bucket(np.sort(_mixed(batch.column(0).to_numpy().view(np.uint64))), buckets)

    wanted = _filter(keys.select("key").mapInArrow(pack, "bucket long, marks binary"), buckets, GRAM_BITS, twice=False)
    shared = found.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(shared.value(_mixed(batch.column(0).to_numpy().view(np.uint64)))))

    return found.select("key", "part", "own", "segment").mapInArrow(run, "key long, part long, own long, segment binary")


def repeated_runs(found: DataFrame, depth: int) -> DataFrame:
    """Runs of repeated starts of the different segments in ``found``; see ``_runs_of_group``."""
    bounds = [f(c).alias(name) for f, c, name in (
        (F.min, "own", "first"), (F.max, "own", "last"), (F.min, "part", "part"), (F.max, "part", "other"), (F.max, "starts", "starts")
    )]
    keys = stored(found.groupBy("key").agg(*bounds).filter(F.col("first") < F.col("last")), "suffix-keys")
    alone = F.col("part") == F.col("other")
    whole = keys.filter(alone).select("key", "part", F.lit(0).cast("long").alias("offset"), "starts", F.col("first").alias("least"))
    return whole.unionByName(merged_runs(_of_keys(found, keys.filter(~alone)), depth))


def merged_runs(found: DataFrame, depth: int) -> DataFrame:
    """As ``repeated_runs``, all from the merge."""
    # the bytes are part of the key, so segments with one hash stay apart
    distinct = found.groupBy("key", "part", "segment").agg(F.min("own").alias("first"), F.max("own").alias("last"))
    distinct = stored(distinct, "suffix-segments")
    size, n = distinct.agg(F.coalesce(F.sum(F.length("segment")), F.lit(0)), F.count("*")).first()
    groups, most = max(1, -(-size // GROUP)), max(HEAVY, min(n // SHARE, HEAVIEST))
    columns = ["key", "sub", "part", "first", "last", "offset", "segment"]
    none = F.lit(0).cast("long")
    rows = distinct.withColumns({"sub": none, "offset": none}).select(*columns)
    heavy = _over(distinct, ["key"], most, "suffix-heavy")
    if not heavy.isEmpty():
        near = stored(_in_pieces(rows.join(F.broadcast(heavy), "key"), _by_window(depth), depth), "suffix-windows")
        dense = _over(near, ["key", "sub"], most, "suffix-dense")
        rows = rows.join(F.broadcast(heavy), "key", "left_anti")
        if dense.isEmpty():
            rows = rows.unionByName(near)
        else:
            pieces = _in_pieces(near.join(F.broadcast(dense), ["key", "sub"]), _by_string(depth), depth)
            rows = rows.unionByName(near.join(F.broadcast(dense), ["key", "sub"], "left_anti")).unionByName(pieces)
    rows = rows.withColumn("group", F.pmod(F.xxhash64("key", "sub"), F.lit(groups)))
    runs = rows.groupBy("group").applyInArrow(
        lambda table: _runs_of_group(table, depth), "key long, part long, offset long, starts long, least long"
    )
    return stored(runs, "suffix-runs")


def _cut(text: bytes, runs: list[tuple[int, int]]) -> tuple[list[bytes], int, int]:
    kept, removed, spans, at = [], 0, 0, 0
    for start, end in sorted(runs):
        if start > at or not spans:
            kept.append(text[at:start])
            spans += 1
            removed += end - start
        elif end > at:
            removed += end - at
        at = max(at, end)
    kept.append(text[at:])
    return kept, removed, spans


def without_repeats(
    docs: DataFrame, *, depth: int = 50, id_col: str = "doc_id", text_col: str = "text", with_kept: bool = True
) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, kept_sha256 and, ``with_kept``,
    the remaining bytes (a cut may fall inside a character)."""
    if depth < 3 * GRAM:
        raise ValueError(f"depth is {3 * GRAM} at least")
    source = _keyed(docs, id_col, text_col)
    texts = source.select("own", "hash", "text", F.lit(False).alias("is_chunk"))
    copied, copies = copied_chunks(texts, depth)
    # the bytes are part of the key, so chunks with one hash stay apart; the second hash names them
    named_ = F.xxhash64("text", "chunk").alias("hash")
    distinct = stored(copies.groupBy("chunk", "text").agg(F.min("own").alias("own")), "suffix-chunks").select("own", named_, "text", F.lit(True).alias("is_chunk"))
    both = texts.unionByName(distinct)
    repeats = repeated_hashes(both, _wider_grams(copied, depth), GRAM_BITS)
    found = stored(occurrences(both, repeats, copied, depth), "suffix-occurrences")
    runs = repeated_runs(found, depth)
    at = F.col("start") + F.col("offset")
    cut = (
        found.select("key", "part", "is_chunk", "own", "hash", "start").join(runs, ["key", "part"]).filter(F.col("least") < F.col("own"))
        .select("is_chunk", "own", "hash", at.alias("a"), (at + F.col("starts") + (depth - 1)).alias("b"))
    )
    cut = stored(cut, "suffix-cut")
    # Spans of texts, spans of chunks where they occur first, and whole chunks wherever else.
    first = distinct.select(F.col("hash").alias("chunk"), F.col("own").alias("first"))
    placed = copies.select(F.xxhash64("text", "chunk").alias("chunk"), "own", "hash", "start", F.length("text").alias("n")).join(first, "chunk")
    again = placed.filter(F.col("own") > F.col("first")).select("own", "hash", F.col("start").alias("a"), (F.col("start") + F.col("n")).alias("b"))
    inner = cut.filter("is_chunk").select(F.col("own").alias("first"), F.col("hash").alias("chunk"), F.col("a").alias("x"), F.col("b").alias("y"))
    within = placed.filter(F.col("own") == F.col("first")).join(inner, ["chunk", "first"])
    within = within.select("own", "hash", (F.col("start") + F.col("x")).alias("a"), (F.col("start") + F.col("y")).alias("b"))
    covered = cut.filter("NOT is_chunk").drop("is_chunk").unionByName(again).unionByName(within).groupBy("own", "hash").agg(F.collect_list(F.struct("a", "b")).alias("runs"))
    schema = T.StructType([T.StructField("id", source.schema["id"].dataType)])
    for name, kind in (("n_bytes", T.LongType()), ("n_removed", T.LongType()), ("n_spans", T.LongType()), ("kept_sha256", T.StringType()), ("kept", T.BinaryType())):
        if with_kept or name != "kept":
            schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value, spans in zip(batch.column(1), batch.column(2)):
                text = _bytes(value)
                pairs = []
                if spans.is_valid:
                    inner = spans.values
                    pairs = list(zip(inner.field("a").to_pylist(), inner.field("b").to_pylist()))
                kept, removed, n = _cut(text, pairs)
                digest = hashlib.sha256()
                for part in kept:
                    digest.update(part)
                rows.append((len(text), removed, n, digest.hexdigest(), b"".join(kept) if with_kept else None))
            columns = [list(c) for c in zip(*rows)] or [[]] * 5
            arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays[: len(schema) - 1]], names=schema.names)

    return source.join(covered, ["own", "hash"], "left").select("id", "text", "runs").mapInArrow(run, schema)

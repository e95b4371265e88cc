"""Token-id files: canonical length-limited Huffman codes in independent blocks.

1. Texts become ids once (the tokenizers library, in Arrow batches) and are stored.
   The tokenizer drops white space and never merges across it, so each distinct run between
   white space of some megabytes of text is coded once and put where it stands by its index;
   what words become is remembered by the worker. A tokenizer file whose steps are others than
   these gets whole texts.
2. Ids are counted over all documents: per partition first, then summed. The table has
   at most one row per id of the vocabulary, which bounds what the driver reads.
3. Package-merge gives the optimal code lengths under ``max_bits``; codes are canonical,
   so the lengths alone describe them.
4. Every document is coded by itself from a byte boundary. Coded documents are sorted by
   id over ranges and packed into blocks of whole documents with a bit offset for every
   ``STEP`` ids (the checkpoints).
5. The decoder looks up ``max_bits`` bits in one table and advances all checkpoints of a
   batch of blocks side by side.

A folder holds ``codes`` (id, bits), ``blocks`` and ``parts`` (first position of each
range). Null text counts as empty: such a document has the end id alone. Null ids come
first; rows that repeat an id follow each other. Other columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from operator import attrgetter
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..scratch import new_folder
from .common import named, stored, text_or_empty
from .memory import LONGEST, Recent

STEP = 256
BLOCK_IDS = 262_144
#: Remembered words, and remembered runs that are no words.
ROOM, RUN_ROOM = 300_000, 100_000
#: Bytes of text whose distinct runs are found together.
SLICE = 6_000_000
_ARRAY = {"<u2": "H", "<u4": "I"}
_SPACES = re.compile(r"[ \t\n\r]+")
_ID = attrgetter("id")


class _Pieces(Recent):
    """Ids of one piece, a run of letters in lower case and composed form."""

    def __init__(self, model, kind: str):
        super().__init__(ROOM)
        self.tokenize, self.kind = model.tokenize, _ARRAY[kind]

    def compute(self, piece: str) -> bytes:
        if not piece.isascii():
            piece = "".join(map(_VISIBLE.__getitem__, piece.encode()))
        return array(self.kind, map(_ID, self.tokenize(piece))).tobytes()


class _Runs(Recent):
    """Ids of one run without ASCII white space. A word and the marks behind it are separate pieces for the
    tokenizer, and other visible ASCII is cut into its pieces here; any other run goes through all of its steps.
    Words are remembered as pieces, whatever their case and marks; the other runs are remembered here."""

    def __init__(self, path: str, kind: str):
        super().__init__(RUN_ROOM)
        from tokenizers import Tokenizer

        self.tokenizer, self.kind = Tokenizer.from_file(path), _ARRAY[kind]
        self.pieces = _Pieces(self.tokenizer.model, kind)
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]

    def ids(self, run: str) -> bytes:
        word = run.rstrip(".,:;!?#$%&*")
        if word.isalpha() and (word.isascii() or _plain(word)):
            found = self.pieces[word.lower()]
            return found if len(word) == len(run) else found + self[run[len(word) :]]
        return self[run]

    def compute(self, run: str) -> bytes:
        if run.isascii() and run.isprintable() and len(run) <= LONGEST and not any(token in run for token in self.added):
            pieces = self.pieces
            return b"".join([pieces[piece] for piece in _ASCII_PIECES.findall(run.lower())])
        parts = _split(run)
        return self.whole(run) if len(parts) == 1 else b"".join(map(self.ids, parts))

    def whole(self, run: str) -> bytes:
        return array(self.kind, self.tokenizer.encode(run, add_special_tokens=False).ids).tobytes()


#: The steps before the merges for which runs can be encoded one by one.
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
_ASCII_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _splits_at_white_space(steps: dict) -> bool:
    """Whether the tokenizer lower-cases, drops white space and splits letters, digits and marks,
    byte by byte below. Every other tokenizer gets whole texts."""
    normalizers = (steps.get("normalizer") or {}).get("normalizers") or [{}]
    split, *level = (steps.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    space = next((n for n in normalizers if n.get("type") == "Replace"), {})
    return (
        [n.get("type") for n in normalizers] == _NORMALIZERS
        and (space.get("pattern"), space.get("content")) == ({"Regex": r"\s+"}, " ")
        and split.get("pattern") == {"Regex": _SPLIT}
        and (split.get("behavior"), split.get("invert")) == ("Removed", True)
        and [(x.get("type"), x.get("add_prefix_space"), x.get("use_regex")) for x in level] == [("ByteLevel", False, False)]
        and not steps["model"].get("dropout")
        and not any(t["content"].isalpha() or _SPACES.search(t["content"]) for t in steps["added_tokens"])
    )


def _plain(word: str) -> bool:
    """Composed, and without the letters whose lower case depends on their place."""
    return "\u03a3" not in word and "\u0130" not in word and is_normalized("NFC", word)


#: How byte-level vocabularies write bytes, as visible characters in order.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_HIDDEN = [b for b in range(256) if b not in _SHOWN]
_VISIBLE = [chr(256 + _HIDDEN.index(b)) if b in _HIDDEN else chr(b) for b in range(256)]


@lru_cache(maxsize=2)
def _runs(path: str, kind: str, by_runs: bool = False) -> _Runs:
    runs = _Runs(path, kind)
    if by_runs and hasattr(runs.tokenizer.model, "_resize_cache"):
        runs.tokenizer.model._resize_cache(0)  # the memories here come before it, so it would only be filled
    return runs


def _split(text: str) -> list[str]:
    """Runs without white space. split() would also cut at four separators that are
    not white space for the tokenizer."""
    if "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text:
        return [run for run in _SPACES.split(text) if run]
    return text.split()


def encode_texts(texts: list[str] | pa.Array, path: str, end_id: int, kind: str, by_runs: bool) -> list[bytes]:
    """Ids of whole texts, each closed by ``end_id``; ``by_runs`` if the tokenizer allows it."""
    runs, end = _runs(path, kind, by_runs), np.array([end_id], dtype=kind).tobytes()
    texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
    if not by_runs:
        return [runs.whole(text) + end for text in texts.to_pylist()]
    coded: list[bytes] = []
    parts = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64) // SLICE
    cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(texts)]
    for i, j in zip(cuts, cuts[1:]):
        split = pc.ascii_split_whitespace(texts.slice(i, j - i))
        found = split.flatten().dictionary_encode()
        distinct = [runs.ids(run) for run in found.dictionary.to_numpy(zero_copy_only=False)]
        placed = pa.array(distinct, pa.large_binary()).take(found.indices)
        _, offsets, raw = placed.buffers()
        last = np.cumsum(split.value_lengths().to_numpy(), dtype=np.int64)  # every text has a run, if an empty one
        raw, ends = bytes(raw or b""), np.frombuffer(offsets or b"", dtype=np.int64)[last].tolist()
        coded += [raw[a:b] + end for a, b in zip([0, *ends], ends)]
    return coded


def code_lengths(counts: np.ndarray, max_bits: int) -> np.ndarray:
    """Optimal code lengths of at most ``max_bits`` for positive counts (package-merge)."""
    n = len(counts)
    if n > 1 << max_bits:
        raise ValueError(f"{n} ids do not fit codes of {max_bits} bits")
    if n <= 1:
        return np.ones(n, dtype=np.int64)
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.float64)
    is_leaf, row = [np.ones(n, dtype=bool)], leaves
    for _ in range(max_bits - 1):
        packages = row[: len(row) // 2 * 2].reshape(-1, 2).sum(axis=1)
        merged = np.concatenate([leaves, packages])
        place = np.argsort(merged, kind="stable")
        is_leaf.append(place < n)
        row = merged[place]
    lengths, need = np.zeros(n, dtype=np.int64), 2 * n - 2
    for level in reversed(is_leaf):
        k = int(level[:need].sum())
        lengths[:k] += 1
        need = 2 * (need - k)
    result = np.empty(n, dtype=np.int64)
    result[order] = lengths
    return result


class Codec:
    """Canonical codes of ids, given as two arrays: ids and their lengths."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, max_bits: int):
        order = np.lexsort((ids, lengths))
        ids, lengths = np.asarray(ids)[order].astype(np.int64), np.asarray(lengths)[order].astype(np.int64)
        spans = 1 << (max_bits - lengths)
        starts = np.concatenate([[0], np.cumsum(spans)[:-1]]) if len(ids) else np.zeros(0, dtype=np.int64)
        top = int(ids.max()) + 1 if len(ids) else 1
        self.max_bits = max_bits
        self.bits = np.zeros(top, dtype=np.int64)
        self.code = np.zeros(top, dtype=np.uint64)
        self.bits[ids] = lengths
        self.code[ids] = (starts >> (max_bits - lengths)).astype(np.uint64)
        self.symbol = np.zeros(1 << max_bits, dtype=np.uint32)
        self.length = np.zeros(1 << max_bits, dtype=np.uint8)
        self.symbol[: int(spans.sum())] = np.repeat(ids, spans)
        self.length[: int(spans.sum())] = np.repeat(lengths, spans)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bit stream, and the bit offset of every STEP-th id."""
        return self.encode_each(ids, np.array([len(ids)]))[0]

    def encode_each(self, ids: np.ndarray, numbers: np.ndarray) -> list[tuple[bytes, np.ndarray]]:
        """As ``encode``, for documents of ``numbers`` ids that follow each other in ``ids``. Each begins at a byte."""
        bits = self.bits[ids]
        sums = np.concatenate([[0], np.cumsum(bits)])
        last = np.cumsum(numbers)
        first_id = last - numbers
        sizes = (sums[last] - sums[first_id] + 7) // 8
        begin = np.cumsum(sizes) - sizes
        at = sums[:-1] + np.repeat(8 * begin - sums[first_id], numbers)
        out = np.zeros(int(sizes.sum()) + 4, dtype=np.uint8)
        if len(ids):
            # Each code lands in a 32-bit window that begins at its first byte; 7 + max_bits <= 32.
            window = self.code[ids] << (32 - (at & 7) - bits).astype(np.uint64)
            first = at >> 3
            heads = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]]))
            window, first = np.add.reduceat(window, heads), first[heads]
            for k in range(4):
                out[first + k] += ((window >> np.uint64(24 - 8 * k)) & np.uint64(255)).astype(np.uint8)
        data = out.tobytes()
        return [
            (data[x : x + size], at[i:j:STEP] - 8 * x)
            for x, size, i, j in zip(begin.tolist(), sizes.tolist(), first_id.tolist(), last.tolist())
        ]

    def decode(self, data: np.ndarray, starts: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """Ids of lanes that begin at bit ``starts`` and hold ``numbers`` ids, in lane order."""
        total = int(numbers.sum())
        out = np.zeros(total, dtype=np.uint32)
        if not total:
            return out
        raw = np.concatenate([data, np.zeros(8, dtype=np.uint8)]).astype(np.uint32)
        window = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
        order = np.argsort(-numbers, kind="stable")
        at, to = starts[order].astype(np.int64), (np.cumsum(numbers) - numbers)[order]
        left = np.sort(numbers)  # ascending: how many lanes hold more than k ids
        mask, shift = np.uint32((1 << self.max_bits) - 1), 32 - self.max_bits
        for k in range(int(numbers.max())):
            live = len(left) - int(np.searchsorted(left, k, side="right"))
            at, to = at[:live], to[:live]
            found = (window[at >> 3] >> (shift - (at & 7)).astype(np.uint32)) & mask
            out[to + k] = self.symbol[found]
            at += self.length[found]
        return out


def tokenized(docs: DataFrame, path: str, end_id: int, vocabulary: int, id_col: str, text_col: str) -> DataFrame:
    """(id, n, ids): whole texts as ids; ``ids`` holds little-endian integers."""
    kind = "<u2" if vocabulary <= 1 << 16 else "<u4"
    with open(path, encoding="utf-8") as file:
        by_runs = _splits_at_white_space(json.load(file))  # once, on the driver: the file is large when parsed
    source = docs.select(named(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    id_type = source.schema["id"].dataType

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = int(kind[-1])
        for batch in batches:
            coded = encode_texts(batch.column(1), path, end_id, kind, by_runs)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(x) // width for x in coded], pa.int64()), pa.array(coded, pa.binary())],
                names=["id", "n", "ids"],
            )

    schema = T.StructType([T.StructField("id", id_type), T.StructField("n", T.LongType()), T.StructField("ids", T.BinaryType())])
    return source.mapInArrow(encode, schema)


def id_counts(tokens: DataFrame, kind: str) -> DataFrame:
    """(id, n) over all documents: one array of counts per partition, then sums."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            found = np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype=kind))
            if len(found) > len(total):
                found[: len(total)] += total
                total = found
            else:
                total[: len(found)] += found
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], names=["id", "n"])

    partial = tokens.select("ids").mapInArrow(count, "id long, n long")
    return partial.groupBy("id").agg(F.sum("n").alias("n"))


def write_token_files(
    docs: DataFrame,
    folder: str,
    *,
    tokenizer: str,
    end_id: int,
    vocabulary: int = 49_408,
    max_bits: int = 18,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Encode every text of ``docs`` and write the files to ``folder``, which must be
    new and on storage all executors reach. ``max_bits`` is at most 25."""
    spark, kind = docs.sparkSession, "<u2" if vocabulary <= 1 << 16 else "<u4"
    tokens = stored(tokenized(docs, tokenizer, end_id, vocabulary, id_col, text_col), "token-ids")
    rows = id_counts(tokens, kind).toPandas()  # at most ``vocabulary`` rows
    rows = rows.sort_values("id")
    lengths = code_lengths(rows["n"].to_numpy(), max_bits)
    code_table = [(int(i), int(b)) for i, b in zip(rows["id"], lengths)]
    spark.createDataFrame(code_table, "id long, bits int").coalesce(1).write.parquet(f"{folder}/codes")
    ids, id_type = rows["id"].to_numpy(), tokens.schema["id"].dataType
    shared = spark.sparkContext.broadcast((ids, lengths))  # bounded by the vocabulary

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(*shared.value, max_bits)
        for batch in batches:
            coded, numbers = [], batch.column(1).to_numpy()
            parts = np.cumsum(numbers) // BLOCK_IDS  # short documents are coded together
            cuts = np.flatnonzero(np.diff(parts)) + 1
            for rows in np.split(np.arange(len(numbers)), cuts) if len(numbers) else ():
                raw = b"".join(batch.column(2).slice(rows[0], len(rows)).to_pylist())
                coded += codec.encode_each(np.frombuffer(raw, dtype=kind).astype(np.int64), numbers[rows])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([x for x, _ in coded], pa.binary()),
                    pa.array([x.astype("<i8").tobytes() for _, x in coded], pa.binary()),
                ],
                names=["id", "n", "bits", "marks"],
            )

    # Ranges are drawn from the stored ids and coding comes after the exchange, so it runs once.
    # The hash tells rows apart that repeat an id or have none.
    order = ("id", "n", F.xxhash64("ids"))
    ordered = tokens.repartitionByRange(*order).sortWithinPartitions(*order, "ids")
    arrow_id = to_arrow_type(id_type)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, position, size = TaskContext.get().partitionId(), 0, 0
        held: list[tuple] = []

        def block(first: int) -> pa.RecordBatch:
            base, marks = 0, []
            for _, _, bits, own in held:
                marks.append(np.frombuffer(own, dtype="<i8") + 8 * base)
                base += len(bits)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([first], pa.int64()),
                    pa.array([[x[0] for x in held]], pa.list_(arrow_id)),
                    pa.array([[x[1] for x in held]], pa.list_(pa.int64())),
                    pa.array([b"".join(x[2] for x in held)], pa.binary()),
                    pa.array([np.concatenate(marks).astype("<i8").tobytes()], pa.binary()),
                ],
                names=["part", "position", "ids", "numbers", "bits", "marks"],
            )

        for batch in batches:
            for row in zip(*[batch.column(k).to_pylist() for k in range(4)]):
                held.append(row)
                size += row[1]
                if size >= BLOCK_IDS:
                    yield block(position)
                    position, size, held = position + size, 0, []
        if held:
            yield block(position)

    block_schema = T.StructType(
        [
            T.StructField("part", T.IntegerType()),
            T.StructField("position", T.LongType()),
            T.StructField("ids", T.ArrayType(id_type)),
            T.StructField("numbers", T.ArrayType(T.LongType())),
            T.StructField("bits", T.BinaryType()),
            T.StructField("marks", T.BinaryType()),
        ]
    )
    # Coded bits do not shrink any further.
    # One Python worker a task does both steps.
    ordered.mapInArrow(lambda batches: pack(code(batches)), block_schema).write.option("compression", "uncompressed").parquet(f"{folder}/blocks")
    blocks = spark.read.parquet(f"{folder}/blocks")
    sizes = blocks.groupBy("part").agg(F.sum(F.aggregate("numbers", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per written range
    sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")).write.parquet(f"{folder}/parts")


def read_token_files(spark: SparkSession, folder: str, *, max_bits: int = 18, with_ids: bool = True) -> DataFrame:
    """(id, start, n_tokens, ids_crc32, ids) per document, decoded from the files; ``ids``
    holds little-endian unsigned 32-bit integers, or null unless ``with_ids``."""
    rows = spark.read.parquet(f"{folder}/codes").collect()  # at most one row per id of the vocabulary
    shared = spark.sparkContext.broadcast((np.array([r["id"] for r in rows]), np.array([r["bits"] for r in rows])))
    blocks = spark.read.parquet(f"{folder}/blocks")
    id_type = blocks.schema["ids"].dataType.elementType

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(*shared.value, max_bits)
        for batch in batches:
            for k in range(batch.num_rows):
                part, position = batch.column(0)[k].as_py(), batch.column(1)[k].as_py()
                numbers = np.array(batch.column(3)[k].values.to_numpy(zero_copy_only=False), dtype=np.int64)
                data = np.frombuffer(batch.column(4)[k].as_buffer(), dtype=np.uint8)
                starts = np.frombuffer(batch.column(5)[k].as_buffer(), dtype="<i8")
                lanes = -(-numbers // STEP)
                full = np.full(int(lanes.sum()), STEP, dtype=np.int64)
                full[np.cumsum(lanes) - 1] = numbers - (lanes - 1) * STEP
                found = codec.decode(data, starts, full).astype("<u4")
                ends = np.cumsum(numbers)
                raw = found.tobytes()
                pieces = [raw[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), numbers.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(2)[k].values,
                        pa.array(np.full(len(numbers), part), pa.int32()),
                        pa.array(position + ends - numbers),
                        pa.array(numbers),
                        pa.array([zlib.crc32(x) for x in pieces], pa.int64()),
                        pa.array(pieces if with_ids else [None] * len(pieces), pa.binary()),
                    ],
                    names=["id", "part", "position", "n_tokens", "ids_crc32", "ids"],
                )

    schema = T.StructType(
        [
            T.StructField("id", id_type),
            T.StructField("part", T.IntegerType()),
            T.StructField("position", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )
    parts = spark.read.parquet(f"{folder}/parts")
    found = blocks.select("part", "position", "ids", "numbers", "bits", "marks").mapInArrow(decode, schema)
    return found.join(parts, "part").select(
        "id", (F.col("start") + F.col("position")).alias("start"), "n_tokens", "ids_crc32", "ids"
    )


def token_files(docs: DataFrame, *, with_ids: bool = True, **options) -> DataFrame:
    """Write ``docs`` to token files in the shared folder and read them back."""
    folder = new_folder(docs.sparkSession, "token-files")
    write_token_files(docs, folder, **options)
    return read_token_files(docs.sparkSession, folder, max_bits=options.get("max_bits", 18), with_ids=with_ids)

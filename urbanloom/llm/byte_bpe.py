"""Byte-level BPE by backtracking over longest matches.

Bytes are mapped to Latin-1 characters, so that an Aho-Corasick automaton over the
vocabulary finds every token in a piece in one pass. The encoder takes the longest
token at each place and steps back to a shorter one when two neighbours are not
compatible, that is when the merge rules would have joined them otherwise. A place that
turned out to be a dead end is marked and never tried again, so the work is linear in
the piece. Compatibility of two neighbours is found by undoing merges from the latest
on, and remembered. The result equals that of the merge rules.

Pieces are the matches of the pattern. A text is cut before each single space that
follows a non-space, where the pattern always ends a match; each cut-out run is encoded
once per worker and remembered. Null text counts as empty (no ids). Null or repeated ids
are kept as rows of their own. Other columns are ignored. Nothing is shuffled.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import named, text_or_empty
from .memory import Recent

ROOM = 250_000
#: White space next to white space or at an end: such texts are split by the pattern alone.
_LOOSE = re.compile(r"\s\s|\A\s|\s\Z")


def load_ranks(path: str) -> dict[bytes, int]:
    """Lines of base64 token and rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class _Pieces(Recent):
    """Ids of one match of the pattern."""

    def __init__(self, encode):
        super().__init__(ROOM)
        self.encode = encode

    def compute(self, piece: str) -> bytes:
        return array("I", self.encode(piece.encode())).tobytes()


class _Runs(Recent):
    """Ids of a space and the run behind it, up to the next space."""

    def __init__(self, find, pieces: _Pieces):
        super().__init__(ROOM)
        self.find, self.pieces = find, pieces

    def compute(self, run: str) -> bytes:
        word = run.rstrip(".,:;!?#$%&*")
        if word.isalpha():  # letters, then marks: two matches of the pattern
            tail = run[len(word) :]
            return self.pieces[" " + word] + self.pieces[tail] if tail else self.pieces[" " + word]
        return self.split(" " + run)

    def split(self, text: str) -> bytes:
        pieces = self.pieces
        return b"".join([pieces[piece] for piece in self.find(text)])


class BytePairs:
    """Encoder and decoder for one vocabulary; ranks order the merges."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import ahocorasick
        import regex

        self.ranks, self.find = ranks, regex.compile(pattern).findall
        self.token = {rank: token for token, rank in ranks.items()}
        self.halves: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        for token, rank in ranks.items():
            if len(token) > 1:
                parts = self._merge(token, rank)
                if len(parts) == 2:
                    self.halves[rank] = parts
                    self.merged[parts] = rank
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), (len(token), rank))
        self.automaton.make_automaton()
        self.fits: dict[tuple[int, int], bool] = {}
        self.runs = _Runs(self.find, _Pieces(self.encode_piece))
        top = max(self.token, default=-1) + 1
        self.lengths = [len(self.token.get(rank, b"")) for rank in range(top)]
        #: The longest token that a token begins with, or -1.
        self.shorter = [-1] * top
        for token, rank in ranks.items():
            heads = (ranks.get(token[:n]) for n in range(len(token) - 1, 0, -1))
            self.shorter[rank] = next((head for head in heads if head is not None), -1)
        self.bytes = [self.token.get(rank, b"") for rank in range(top)]

    def _merge(self, token: bytes, below: int) -> tuple[int, ...]:
        """The merge rules on a short string, with ranks under ``below`` only."""
        parts = [token[i : i + 1] for i in range(len(token))]
        while True:
            found = [(r, i) for i in range(len(parts) - 1) if (r := self.ranks.get(parts[i] + parts[i + 1], below)) < below]
            if not found:
                return tuple(self.ranks[p] for p in parts)
            i = min(found)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def _apart(self, left: int, right: int) -> bool:
        """True if the merge rules keep these two tokens apart when they stand side by side."""
        bound = len(self.ranks) + 1
        while True:
            # A merge across the border wins if it comes before the one that consumed a side.
            if self.merged.get((left, right), bound) < bound:
                return False
            a = left if left in self.halves else -1
            b = right if right in self.halves else -1
            if a < 0 and b < 0:
                return True
            if a > b:
                bound, left = a, self.halves[a][1]
            else:  # of equal merges the left one comes first, so the border wins a tie with the right side
                bound, right = b + 1, self.halves[b][0]

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        size = len(piece)
        longest = [0] * size
        for last, (length, token) in self.automaton.iter(piece.decode("latin-1")):
            longest[last + 1 - length] = token  # ends ascend, so the longest token stays
        lengths, shorter, fits = self.lengths, self.shorter, self.fits
        open_at = bytearray(b"\x01") * (size + 1)
        taken: list[int] = []
        at, left, token = 0, -1, longest[0]
        while True:
            end = at + lengths[token]
            if open_at[end]:
                if left < 0:
                    fit = True
                elif (fit := fits.get((left, token))) is None:
                    fit = fits[left, token] = self._apart(left, token)
                if fit:
                    taken.append(token)
                    if end == size:
                        return taken
                    at, left, token = end, token, longest[end]
                    continue
            token = shorter[token]
            while token < 0:  # nothing fits here: take back the last token
                open_at[at] = 0
                token = taken.pop()
                at -= lengths[token]
                left = taken[-1] if taken else -1
                token = shorter[token]

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        if len(self.fits) > 4 * ROOM:
            self.fits.clear()
        if not text:
            return b""
        runs = self.runs
        if _LOOSE.search(text):
            return runs.split(text)
        first, *rest = text.split(" ")
        return runs.split(first) + b"".join([runs[run] for run in rest])

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


@lru_cache(maxsize=2)
def byte_pairs(path: str, pattern: str) -> BytePairs:
    return BytePairs(load_ranks(path), pattern)


def encode_documents(
    docs: DataFrame,
    *,
    ranks: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """One row per document: id, n_tokens, ids (binary, little-endian unsigned 32-bit;
    null unless ``with_ids``), ids_sha256, decoded_sha256 of the bytes decoded from the ids.
    ``ranks`` is the path of a rank file that every executor has."""
    source = docs.select(named(id_col).alias("id"), text_or_empty(text_col).alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = byte_pairs(ranks, pattern)
        for batch in batches:
            n, coded, sums, back = [], [], [], []
            for text in batch.column(1):
                ids = pairs.encode(text.as_py())
                n.append(len(ids) // 4)
                sums.append(hashlib.sha256(ids).hexdigest())
                back.append(hashlib.sha256(pairs.decode(ids)).hexdigest())
                coded.append(ids if with_ids else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(coded, pa.binary()), pa.array(sums, pa.string()), pa.array(back, pa.string())],
                names=["id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"],
            )

    schema = T.StructType(
        [
            T.StructField("id", source.schema["id"].dataType),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType()),
        ]
    )
    return source.mapInArrow(encode, schema)

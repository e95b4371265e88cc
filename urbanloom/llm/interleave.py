"""Merging Burrows-Wheeler transforms by refining their interleave.

A shard is a circular text: its strings, each closed by END. Sorting the rotations of a shard
gives its transform, the letter before each rotation, and the row to which a rotation moves
when that letter is put in front. The shards are merged without sorting again: the interleave
lists their rows in turn, first one shard after the other. A round deals the rows stably by the
letter before them and moves them there, which orders all rotations by one more letter. Rows
that come apart in round k share k - 1 letters with their neighbour, so common prefixes fall
out on the way; rows that never come apart in ``depth`` rounds are repeated intervals.

Rows with fewer than ``depth`` letters of their string before them never take part, as their
string begins before the last round; most rows of short strings are of this kind. Two kinds of
rows leave a round for good: those before which a string begins, as no longer match lies within
the string, and those that are alone with their k letters, as whatever stands before them is
alone too. So work shrinks to what does repeat.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

#: A byte that UTF-8 never holds.
END = 255


def rotation_order(letters: np.ndarray) -> np.ndarray:
    """Starts of the rotations of a circular text, in order. Prefix doubling from eight
    letters; only what is still tied is sorted again."""
    n = len(letters)
    key = np.zeros(n, dtype=np.uint64)
    wrapped = np.resize(letters, n + 7) if n else letters
    for k in range(8 if n else 0):
        key = (key << np.uint64(8)) | wrapped[k : k + n]
    order = np.argsort(key)
    key = key[order]
    apart = np.ones(n, dtype=bool)
    apart[1:] = key[1:] != key[:-1]
    rank = np.empty(n, dtype=np.int64)
    heads = np.flatnonzero(apart)
    rank[order] = np.repeat(heads, np.diff(np.append(heads, n)))
    seen = 8
    while seen < n:
        alone = apart & np.append(apart[1:], True)
        places = np.flatnonzero(~alone)
        if not len(places):
            break
        tied = order[places]
        pair = rank[tied] * n + rank[(tied + seen) % n]
        again = np.argsort(pair)
        tied, pair = tied[again], pair[again]
        order[places] = tied
        new = np.ones(len(places), dtype=bool)
        new[1:] = pair[1:] != pair[:-1]
        apart[places] = new
        heads = np.flatnonzero(new)
        rank[tied] = np.repeat(places[heads], np.diff(np.append(heads, len(places))))
        seen *= 2
    return order


def transform(letters: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The letter before each rotation, and the row of the rotation that starts with it."""
    before = letters[order - 1]
    moved = np.empty(len(order), dtype=np.int32)
    moved[np.argsort(before, kind="stable")] = np.arange(len(order), dtype=np.int32)
    return before, moved


def merged(shards: Sequence[tuple[np.ndarray, np.ndarray]], depth: int, able: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(row, interval) of the rotations whose first ``depth`` letters lie within one string and
    occur more than once, in merged order; rows count on over the shards. ``able`` tells for each
    row of a shard whether ``depth`` letters of its string stand before it."""
    base = np.cumsum([0, *(len(before) for before, _ in shards)])
    before = np.concatenate([b for b, _ in shards])
    moved = np.concatenate([m + np.int32(start) for (_, m), start in zip(shards, base)])
    row = np.flatnonzero(np.concatenate(able)).astype(np.int32)
    interval = np.zeros(len(row), dtype=np.int32)
    for _ in range(depth):
        letter = before[row]
        dealt = np.argsort(letter, kind="stable")
        dealt = dealt[: len(dealt) - np.count_nonzero(letter == END)]  # END comes last
        if not len(dealt):
            break
        letter, same = letter[dealt], interval[dealt]
        apart = np.ones(len(dealt) + 1, dtype=bool)
        apart[1:-1] = (letter[1:] != letter[:-1]) | (same[1:] != same[:-1])
        more = ~(apart[1:] & apart[:-1])
        row = moved[row[dealt[more]]]
        interval = np.cumsum(apart[:-1], dtype=np.int32)[more]
    else:
        return row, interval
    return row[:0], interval[:0]


def repeated(strings: Sequence[bytes], depth: int, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, offset, interval) of every place where ``depth`` letters begin that occur more
    than once in the strings; equal letters have one interval. The strings hold no END and
    are dealt to ``shards`` shards in turn."""
    shards = max(1, min(shards, len(strings)))
    parts, orders, begins, owners = [], [], [], []
    for s in range(shards):
        own = strings[s::shards]
        part = np.frombuffer(bytes([END]).join([*own, b""]), dtype=np.uint8)
        lengths = np.array([len(x) + 1 for x in own], dtype=np.int64)
        parts.append(part)
        orders.append(rotation_order(part))
        begins.append(np.repeat(np.cumsum(lengths) - lengths, lengths))
        owners.append(np.repeat(np.arange(s, len(strings), shards), lengths))
    able = [o - b[o] >= depth for o, b in zip(orders, begins)]
    row, interval = merged([transform(p, o) for p, o in zip(parts, orders)], depth, able)
    place, begin, owner = np.concatenate(orders)[row], np.concatenate(begins), np.concatenate(owners)
    base = np.cumsum([0, *(len(p) for p in parts)])
    shift = base[np.searchsorted(base, row, side="right") - 1]
    return owner[place + shift], place - begin[place + shift], interval

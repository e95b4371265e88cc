"""Near-duplicate classes by an LSH forest over MinHash signatures.

1. Each text becomes its set of distinct word shingles (64-bit hashes) and a signature of
   TREES x STEP minima. Documents with one set are one class; only its key goes on.
2. A tree orders the classes by the signature, rotated to the tree's place. Classes with a
   common prefix are a region. Regions begin at a prefix of FIRST minima. A region of at
   most LEAF classes gives its pairs; a larger one goes deeper, as deep as its own
   density asks for, until it falls apart or the signature ends. What a region holds is
   only counted, joined and compared with its centre, never gathered.
3. At each depth the classes are compared with the centres of their regions, a linear number
   of pairs, and confirmed before the next depth: of a large region only the centre and the
   classes that do not link with it go deeper, as long as that finds links, so a group of
   near copies is done with at the first depth. After that come the pairs of small regions whose classes are not
   connected yet. Large regions that overlap form a dense group; where a group is not one
   component by then, the classes outside its main component are compared with all others
   they are not connected with: these loose classes, in chunks of BLOCK, meet the group's
   blocks of BLOCK classes, and a task returns links only. So no link is lost to the size of a
   region. This last step grows with the loose classes times the group: the square of a dense
   group whose members are alike but mostly below the limit; a connected group costs nothing.
4. Rows of regions carry the set's size and one bit of each minimum. Pairs whose sizes rule
   the limit out, or whose bits agree in too few places (five standard deviations below the
   limit), are left out in the join; all others are confirmed on the full sets.
5. Components by alternating stars.

Similarity is intersection over union of full sets, limit ``percent`` of 100. Words are
lower-cased in A-Z only. A text with fewer words than a shingle is one shingle; null, empty
and blank texts have no set and link with nothing. Rows that repeat an id get the same
component if they share a text. A null id is linked like others; its component is the
smallest id that is not null. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ROW, named, numbered, stored, text_or_empty
from .components import components
from .memory import Recent

TREES, STEP, FIRST, LEAF, BLOCK = 16, 8, 3, 32, 256
WIDTH = TREES * STEP
#: Depths of regions: the first, and those at which what is left of large ones is counted again.
DEPTHS = (FIRST, 6, 12, 24, 48, 96)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_END = np.uint64(0xBF58476D1CE4E5B9)


class _WordHashes(Recent):
    def compute(self, word: bytes) -> int:
        import xxhash

        return xxhash.xxh64_intdigest(word)


@lru_cache(maxsize=1)
def _word_hashes() -> _WordHashes:
    return _WordHashes(300_000)


@lru_cache(maxsize=1)
def _permutations() -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20_240_501)
    shift = draw.integers(0, 1 << 63, WIDTH, dtype=np.uint64)
    factor = draw.integers(0, 1 << 63, WIDTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return shift, factor


def shingle_set(text: str, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of ``words`` words."""
    parts = text.encode("utf-8", "replace").lower().split()  # bytes: A-Z and ASCII spaces only
    if not parts:
        return np.zeros(0, dtype=np.uint64)
    known = _word_hashes()
    hashes = np.array([known[part] for part in parts], dtype=np.uint64)
    size = min(words, len(hashes))
    count = len(hashes) - size + 1
    total = np.full(count, np.uint64(size), dtype=np.uint64)
    for k in range(size):
        total = (total ^ hashes[k : k + count]) * _MIX
        total ^= total >> np.uint64(29)
    total *= _END
    return np.unique(total ^ (total >> np.uint64(32)))


def signature(shingles: np.ndarray) -> np.ndarray:
    """WIDTH minima of the set under different orders, as 32-bit integers."""
    shift, factor = _permutations()
    least = np.full(WIDTH, np.iinfo(np.uint64).max, dtype=np.uint64)
    for start in range(0, len(shingles), 2_048):
        block = shingles[start : start + 2_048]
        for k in range(0, WIDTH, 16):
            drawn = (block[None, :] ^ shift[k : k + 16, None]) * factor[k : k + 16, None]
            np.minimum(least[k : k + 16], drawn.min(axis=1), out=least[k : k + 16])
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


def signatures(docs: DataFrame, *, words: int, id_col: str, text_col: str) -> DataFrame:
    """(id, n_shingles, class, signature, b0, b1); class is a 128-bit digest of the set, null
    if empty; b0 and b1 hold the lowest bits of the signature."""
    source = docs.select(named(id_col).alias("id"), text_or_empty(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, rows, bits = [], [], [], np.zeros((batch.num_rows, 2), dtype=np.int64)
            for k, text in enumerate(batch.column(1)):
                found = shingle_set(text.as_py(), words)
                sizes.append(len(found))
                keys.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                rows.append(signature(found) if len(found) else None)
                if len(found):
                    bits[k] = np.packbits((rows[-1] & 1).astype(bool)).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(rows, pa.list_(pa.int32())), pa.array(bits[:, 0]), pa.array(bits[:, 1])],
                names=["id", "n_shingles", "class", "signature", "b0", "b1"],
            )

    schema = T.StructType(
        [
            T.StructField("id", source.schema["id"].dataType),
            T.StructField("n_shingles", T.LongType()),
            T.StructField("class", T.BinaryType()),
            T.StructField("signature", T.ArrayType(T.IntegerType())),
            T.StructField("b0", T.LongType()),
            T.StructField("b1", T.LongType()),
        ]
    )
    return source.mapInArrow(run, schema)


_SKETCH = ("size", "b0", "b1")


def _alike(x: str, y: str, percent: int) -> Column:
    """Sizes and bits of ``x`` and ``y`` allow the limit. A bit of two minima agrees with
    probability (1 + similarity) / 2."""
    size, other = F.col(f"{x}size"), F.col(f"{y}size")
    agree = (1 + percent / 100) / 2
    most = WIDTH * (1 - agree) + 5 * (WIDTH * agree * (1 - agree)) ** 0.5
    apart = F.bit_count(F.col(f"{x}b0").bitwiseXOR(F.col(f"{y}b0"))) + F.bit_count(F.col(f"{x}b1").bitwiseXOR(F.col(f"{y}b1")))
    return (100 * F.least(size, other) >= percent * F.greatest(size, other)) & (apart <= most)


def _regions(classes: DataFrame, depth: int, within: DataFrame | None, percent: int) -> DataFrame:
    """(region, tree, class, sketch, n, heart, centre): classes in regions of two or more at
    ``depth``; of all trees, or of the (tree, class) rows ``within``. The heart is drawn by
    hash; as centre it is null for itself and for classes that cannot be similar to it."""
    if within is None:
        placed = classes.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))))
    else:
        placed = within.join(classes, "class")
    start = F.col("tree") * STEP
    tail = F.slice("signature", start + 1, F.lit(depth))
    wrapped = F.slice("signature", F.lit(1), F.greatest(start + depth - WIDTH, F.lit(0)))
    keyed = placed.select("class", "tree", *_SKETCH, F.xxhash64("tree", F.concat(tail, wrapped)).alias("region"))
    draw = F.struct(F.xxhash64("class").alias("h"), F.col("class").alias("c"), *_SKETCH)
    counts = keyed.groupBy("region").agg(F.count("*").alias("n"), F.min(draw).alias("centre")).filter(F.col("n") > 1)
    close = (F.col("class") != F.col("centre.c")) & _alike("", "centre.", percent)
    return keyed.join(counts, "region").select(
        "region", "tree", "class", *_SKETCH, "n", F.col("centre.c").alias("heart"), F.when(close, F.col("centre.c")).alias("centre")
    )


def descended(
    regions: DataFrame, classes: DataFrame, sets: DataFrame, percent: int
) -> tuple[DataFrame, DataFrame]:
    """(links (a, b) with centres, rows (region, class) of small regions), from the regions at the
    first depth downwards."""
    tried, links, leaves = None, None, None
    for depth in [*DEPTHS[1:], None]:
        near = regions.filter(F.col("centre").isNotNull()).select(
            F.least("class", "centre").alias("a"), F.greatest("class", "centre").alias("b")
        ).distinct()
        near = stored(near if tried is None else near.join(tried, ["a", "b"], "left_anti"), "forest-centres")
        tried = near if tried is None else tried.unionByName(near)
        found = confirmed(near, sets, percent)
        done = links is not None and found.isEmpty()  # what is still apart is left to the blocks
        links = found if links is None else links.unionByName(found)
        leaf = regions.filter(F.col("n") <= LEAF).select("region", "class", *_SKETCH)
        leaves = leaf if leaves is None else leaves.unionByName(leaf)
        if done or depth is None:
            return links, leaves
        wide = regions.filter(F.col("n") > LEAF).select(
            "region", "tree", "class", "heart", F.least("class", "heart").alias("a"), F.greatest("class", "heart").alias("b")
        )
        within = stored(wide.join(links, ["a", "b"], "left_anti").select("region", "tree", "class", "heart"), "forest-open")
        more = within.filter(F.col("class") != F.col("heart")).select("region").distinct()
        within = within.join(more, "region", "left_semi").select("tree", "class")
        if within.isEmpty():
            return links, leaves
        regions = stored(_regions(classes, depth, within, percent), "forest-regions")


def _labelled(rows: DataFrame, joined: DataFrame) -> DataFrame:
    """``rows`` (region, class) with the component each class is in so far."""
    return rows.join(joined.withColumnRenamed("node", "class"), "class", "left").select(
        "region", "class", *_SKETCH, F.coalesce("component", "class").alias("in")
    )


def _apart(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) within a small region that may be similar and are not connected yet."""
    one = rows.select("region", F.col("class").alias("x"), "in", *(F.col(c).alias(f"x{c}") for c in _SKETCH))
    two = rows.select(F.col("region").alias("at"), F.col("class").alias("y"), F.col("in").alias("other"), *(F.col(c).alias(f"y{c}") for c in _SKETCH))
    open_ = (F.col("region") == F.col("at")) & (F.col("x") < F.col("y")) & (F.col("in") != F.col("other")) & _alike("x", "y", percent)
    pairs = one.join(two, open_)
    return pairs.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()


def _dense_groups(large: DataFrame) -> DataFrame:
    """(class, group) for classes in large regions; regions that share a class share a group."""
    heads = large.groupBy("region").agg(F.min("class").alias("head"))
    joined = components(large.join(heads, "region").select("class", "head"), "class", "head")
    known = large.select("class").distinct().join(joined.withColumnRenamed("node", "class"), "class", "left")
    return known.select("class", F.coalesce("component", "class").alias("group"))


def _block_links(large: DataFrame, joined: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of the classes outside the main component of their dense group."""
    groups = stored(_dense_groups(large), "forest-groups")
    rows = groups.join(joined.withColumnRenamed("node", "class"), "class", "left").withColumn("in", F.coalesce("component", "class"))
    sizes = rows.groupBy("group", "in").agg(F.count("*").alias("n"))
    main = (
        sizes.groupBy("group")
        .agg(F.max(F.struct("n", "in")).alias("most"), F.sum("n").alias("total"), F.count("*").alias("k"))
        .filter(F.col("k") > 1)
        .select("group", F.col("most.in").alias("main"), F.ceil(F.col("total") / BLOCK).cast("int").alias("blocks"))
    )
    sketches = large.select("class", *_SKETCH).dropDuplicates(["class"])
    placed = (
        rows.join(main, "group")
        .join(sketches, "class")
        .withColumns({"loose": F.col("in") != F.col("main"), "block": F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")})
    )
    placed = stored(placed.select("group", "class", "in", "loose", "block", "blocks", *_SKETCH), "forest-placed")
    chunks = placed.filter("loose").groupBy("group").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("chunks"))
    placed = placed.join(chunks, "group").join(sets, "class")
    rest = placed.select(
        "group", "block", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.lit(False).alias("moved"),
        "class", "in", "loose", *_SKETCH, "members",
    )
    moved = placed.filter("loose").select(
        "group", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.pmod(F.xxhash64("class", F.lit(1)), F.col("chunks")).cast("int").alias("chunk"), F.lit(True).alias("moved"),
        "class", "in", "loose", *_SKETCH, "members",
    )
    agree = (1 + percent / 100) / 2
    most = WIDTH * (1 - agree) + 5 * (WIDTH * agree * (1 - agree)) ** 0.5

    def compare(key: tuple, rows: pa.Table) -> pa.Table:
        classes, inside = rows.column("class").to_pylist(), rows.column("in").to_pylist()
        moved, loose, size = (rows.column(c).to_numpy() for c in ("moved", "loose", "size"))
        bits = np.stack([rows.column(c).to_numpy() for c in ("b0", "b1")], axis=1).view(np.uint64)
        members = [x.values.to_numpy() for x in rows.column("members")]
        names = {name: i for i, name in enumerate(dict.fromkeys(inside))}
        parent = list(range(len(names)))

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        own = [names[name] for name in inside]
        place = {name: i for i, name in enumerate(sorted(set(classes)))}
        order = np.array([place[c] for c in classes])
        found = []
        for i in np.flatnonzero(moved).tolist():
            fit = ~moved & (~loose | (order < order[i]))  # of two loose classes one leads
            fit &= (100 * np.minimum(size, size[i]) >= percent * np.maximum(size, size[i])) & (order != order[i])
            fit &= np.bitwise_count(bits ^ bits[i]).sum(axis=1) <= most
            for j in np.flatnonzero(fit).tolist():
                x, y = root(own[i]), root(own[j])
                if x != y:
                    both = len(np.intersect1d(members[i], members[j], assume_unique=True))
                    if 100 * both >= percent * (len(members[i]) + len(members[j]) - both):
                        parent[x] = y
                        found.append((min(classes[i], classes[j]), max(classes[i], classes[j])))
        return pa.table({"a": pa.array([a for a, _ in found], pa.binary()), "b": pa.array([b for _, b in found], pa.binary())})

    both = rest.unionByName(moved)
    return stored(both.groupBy("group", "block", "chunk").applyInArrow(compare, "a binary, b binary"), "forest-block-links")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough. Sets are compared row by row in the JVM, so
    no batch of them is ever held."""
    left = sets.select(F.col("class").alias("a"), F.col("members").alias("ma"))
    right = sets.select(F.col("class").alias("b"), F.col("members").alias("mb"))
    joined = pairs.join(left, "a").join(right, "b")
    both = F.size(F.array_intersect("ma", "mb"))
    alike = 100 * both >= percent * (F.size("ma") + F.size("mb") - both)
    return stored(joined.filter(alike).select("a", "b"), "forest-links")


def _extended(joined: DataFrame, links: DataFrame) -> DataFrame:
    """The components ``joined`` after ``links`` are added. A class and its component stand
    for all earlier links, so only what is new takes rounds."""
    if links.isEmpty():
        return joined
    known = joined.select(F.col("node").alias("a"), F.col("component").alias("b"))
    return components(links.unionByName(known), "a", "b")


def _sets(docs: DataFrame, wanted: DataFrame, *, words: int, id_col: str, text_col: str) -> DataFrame:
    """(class, members) of the documents in ``wanted`` (id, class): full sets, made anew, as
    ascending 64-bit integers."""
    texts = docs.select(named(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    source = texts.join(wanted.withColumnRenamed("id", "of"), F.col("id").eqNullSafe(F.col("of")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.int64())
        for batch in batches:
            keys, members, room = [], [], 0
            for text, key in zip(batch.column(0), batch.column(1).to_pylist()):
                found = shingle_set(text.as_py(), words)
                if hashlib.blake2b(found.tobytes(), digest_size=16).digest() == key:  # a repeated id may have another text
                    keys.append(key)
                    members.append(found.view(np.int64))
                    room += len(found)
                if room > 1 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(members, kind)], names=["class", "members"])
                    keys, members, room = [], [], 0
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(members, kind)], names=["class", "members"])

    return source.select("text", "class").mapInArrow(run, "class binary, members array<bigint>")


def near_duplicates(
    docs: DataFrame, *, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept (id = component_id)."""
    found = stored(signatures(docs, words=words, id_col=id_col, text_col=text_col), "forest-signatures")
    full = found.filter(F.col("class").isNotNull())
    owners = stored(full.groupBy("class").agg(F.min("id").alias("owner")), "forest-classes")
    signed = full.select("id", "class", "signature", F.col("n_shingles").alias("size"), "b0", "b1").join(
        owners.withColumnRenamed("class", "of"), (F.col("class") == F.col("of")) & F.col("id").eqNullSafe(F.col("owner"))
    )
    classes = stored(signed.select("class", "signature", *_SKETCH).dropDuplicates(["class"]), "forest-owners")
    regions = stored(_regions(classes, FIRST, None, percent), "forest-regions")
    large = regions.filter(F.col("n") > LEAF).select("region", "class", *_SKETCH)
    members = regions.select("class").distinct()
    wanted = owners.join(members, "class", "left_semi").select(F.col("owner").alias("id"), "class")
    sets = stored(
        _sets(docs, wanted, words=words, id_col=id_col, text_col=text_col).dropDuplicates(["class"]), "forest-sets"
    )
    links, leaves = descended(regions, classes, sets, percent)
    joined = components(links, "a", "b")
    joined = _extended(joined, confirmed(_apart(_labelled(leaves, joined), percent), sets, percent))
    joined = _extended(joined, _block_links(large, joined, sets, percent))
    joined = joined.withColumnRenamed("node", "class")
    owned = owners.join(joined, "class", "left").withColumn("component", F.coalesce("component", "class"))
    heads = owned.groupBy("component").agg(F.min("owner").alias("component_id"))
    labels = owned.join(heads, "component").select("class", "component_id")
    component = F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return found.select("id", "n_shingles", "class").join(labels, "class", "left").select(
        F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept")
    )


def kept_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: one row of each component stays, that
    with the smallest id, a null id last. Each row counts by itself, so of rows that repeat
    an id and a text one stays, and texts of one id or of no id are kept apart. Rows with
    null, empty or blank text have nothing in common with others and all stay."""
    rows = numbered(docs, "near-rows")
    found = near_duplicates(rows, id_col=ROW, text_col=text_col, **options).select(ROW, F.col("component_id").alias("component"))
    order = F.struct(
        named(id_col).isNull().alias("none"), named(id_col).alias("id"), F.xxhash64(text_or_empty(text_col)).alias("hash"), named(ROW).alias("row")
    )
    heads = rows.select(ROW, order.alias("order")).join(found, ROW).groupBy("component").agg(F.min("order").alias("head"))
    return rows.join(heads.select(F.col("head.row").alias(ROW)), ROW, "left_semi").drop(ROW)

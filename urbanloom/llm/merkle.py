"""Merkle manifest of a dataset: one root for all rows, a proof for each row.

A row's leaf is the SHA-256 of its fields. The leaves of one group (a language, say) ascend
by id and are one tree; the roots of the groups, in the order of their names, are the
leaves of the tree above. Every ``arity`` consecutive nodes have one parent, the digest of
their hex digests joined; a last run may be shorter, down to one.

1. A node is labelled with the interval [lo, hi) of leaf ranks that it covers, so the tree
   needs no pointers. Trees are built in storeys of a few levels: the leaves of one block of
   at most BLOCK become all nodes above them in one grouping, and the tops of the blocks are
   the leaves of the next storey. No group holds more than BLOCK digests, whatever the
   size of a tree; all trees of a forest climb together.
2. Within a parent's interval, what a node's own interval leaves over are its siblings:
   those that end before it stand left, those that begin after it right.
3. A leaf finds its ancestors by containment: it is joined with the nodes of each level whose
   bucket (rank divided by the level's width) is its own and whose interval holds its rank.
   A node is met by the leaves of its own block only, so high nodes are no hot keys.
4. Paths go down storey by storey: a leaf's path is that inside its block, then that of
   the block. All siblings from the leaf to the root, left to right, are the proof.

Null fields are ``-``, other fields ``<bytes>:<value>``. A null id stands before all others,
a null group is the first group. Rows that repeat an id are leaves of their own, ordered by
their digests. An empty table gives an empty manifest. Other columns do not matter, and
names may clash with those of the result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import OWN, named, stored
from .ranks import RANK, TOTAL, ranked

#: Most leaves of a block; the levels of a storey are the largest number whose width fits.
BLOCK = 256


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*(field(v) for v in values)), 256)


def _levels(arity: int) -> int:
    levels = 1
    while arity ** (levels + 1) <= BLOCK:
        levels += 1
    return levels


def _parents(digests: Column, arity: int) -> Column:
    """The digests of every ``arity`` consecutive ones, joined."""
    runs = F.sequence(F.lit(0), F.floor((F.size(digests) - 1) / arity).cast("int"))
    return F.transform(runs, lambda i: F.sha2(F.array_join(F.slice(digests, i * arity + 1, F.lit(arity)), ""), 256))


def _nodes(rows: DataFrame, arity: int, levels: int) -> DataFrame:
    """(tree, block, total, level, lo, hi, digest): the rows and all nodes above them inside
    their block. A tree that fits in one block ends at its root, others at the block's top."""
    width = arity**levels
    made = rows.groupBy("tree", F.floor(F.col("rank") / width).alias("block"), "total").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("rank", "digest"))), lambda x: x["digest"]).alias("l0")
    )
    for k in range(1, levels + 1):
        below = F.col(f"l{k - 1}")
        done = below.isNull() | ((F.size(below) == 1) & (F.col("total") <= arity ** (k - 1)))
        made = made.withColumn(f"l{k}", F.when(~done, _parents(below, arity)))
    each = F.array(
        *(F.struct(F.lit(k).alias("level"), F.lit(arity**k).cast("long").alias("width"), F.col(f"l{k}").alias("row")) for k in range(levels + 1))
    )
    level = made.select("tree", "block", "total", F.explode(F.filter(each, lambda x: x["row"].isNotNull())).alias("v"))
    cell = level.select("tree", "block", "total", "v.level", "v.width", F.posexplode("v.row").alias("i", "digest"))
    lo = F.col("block") * width + F.col("i") * F.col("width")
    return cell.select("tree", "block", "total", "level", lo.alias("lo"), F.least(lo + F.col("width"), "total").alias("hi"), "digest")


def _with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """(tree, level, bucket, lo, hi, left, right) of every node that has a parent: the digests
    of the rest of the parent's interval, before and after the node's own."""
    wide = F.pow(F.lit(float(arity)), F.col("level") + 1).cast("long")
    runs = nodes.groupBy("tree", "level", F.floor(F.col("lo") / wide).alias("parent")).agg(
        F.sort_array(F.collect_list(F.struct("lo", "hi", "digest"))).alias("run")
    )
    member = runs.select("tree", "level", "run", F.explode("run").alias("own"))
    left = F.filter("run", lambda x: x["hi"] <= F.col("own.lo"))
    right = F.filter("run", lambda x: x["lo"] >= F.col("own.hi"))
    width = F.pow(F.lit(float(arity)), F.col("level")).cast("long")
    return member.select(
        "tree", F.col("level").alias("depth"), F.floor(F.col("own.lo") / width).alias("bucket"), "own.lo", "own.hi",
        F.array_join(F.transform(left, lambda x: x["digest"]), "").alias("left"),
        F.array_join(F.transform(right, lambda x: x["digest"]), "").alias("right"),
    )


def _paths(rows: DataFrame, nodes: DataFrame, arity: int, levels: int) -> DataFrame:
    """(tree, rank, inner): each row's steps (level, left, right) inside its block."""
    top = F.when(F.col("total") > arity**levels, levels).otherwise(F.least(F.lit(levels), _height(F.col("total"), arity, levels)))
    climb = rows.select("tree", "rank", F.explode(F.filter(F.sequence(F.lit(0), F.lit(levels - 1)), lambda k: k < top)).alias("depth"))
    width = F.pow(F.lit(float(arity)), F.col("depth")).cast("long")
    climb = climb.withColumn("bucket", F.floor(F.col("rank") / width))
    met = climb.join(_with_siblings(nodes, arity), ["tree", "depth", "bucket"]).filter((F.col("lo") <= F.col("rank")) & (F.col("rank") < F.col("hi")))
    step = F.struct("depth", "left", "right")
    inner = met.groupBy("tree", "rank").agg(F.sort_array(F.collect_list(step)).alias("inner"))
    none = F.array().cast("array<struct<depth:int,left:string,right:string>>")
    return rows.join(inner, ["tree", "rank"], "left").select("tree", "rank", "total", F.coalesce("inner", none).alias("inner"))


def _height(total: Column, arity: int, levels: int) -> Column:
    """Levels above the leaves of a tree of at most arity^levels leaves."""
    height = F.lit(levels)
    for k in range(levels - 1, -1, -1):
        height = F.when(total <= arity**k, k).otherwise(height)
    return height


def _climb(rows: DataFrame, arity: int, label: str) -> tuple[list[tuple[DataFrame, DataFrame]], DataFrame]:
    """The storeys (rows, nodes) of a forest (tree, rank, total, digest), and (tree, digest)
    of its roots."""
    levels, storeys, roots = _levels(arity), [], None
    width = arity**levels
    while True:
        nodes = stored(_nodes(rows, arity, levels), f"{label}-nodes")
        storeys.append((rows, nodes))
        ended = nodes.filter((F.col("lo") == 0) & (F.col("hi") == F.col("total")))
        top = ended.filter(F.col("total") <= width).groupBy("tree").agg(F.max_by("digest", "level").alias("digest"))
        roots = top if roots is None else roots.unionByName(top)
        above = nodes.filter((F.col("total") > width) & (F.col("level") == levels))
        rows = stored(
            above.select("tree", F.col("block").alias("rank"), F.ceil(F.col("total") / width).alias("total"), "digest"), f"{label}-storey"
        )
        if rows.isEmpty():
            return storeys, stored(roots, f"{label}-roots")


def _descend(storeys: list[tuple[DataFrame, DataFrame]], known: DataFrame, arity: int, label: str) -> DataFrame:
    """(tree, rank, path, subroot, root) of the first storey's rows. ``known`` has (tree, path,
    subroot, root): what is above each tree."""
    levels, below = _levels(arity), None
    width = arity**levels
    for rows, nodes in reversed(storeys):
        found = _paths(rows, nodes, arity, levels)
        last = found.filter(F.col("total") <= width).join(known, "tree")
        parts = last
        if below is not None:
            block = below.withColumnRenamed("rank", "block")
            parts = parts.unionByName(
                found.filter(F.col("total") > width).withColumn("block", F.floor(F.col("rank") / width)).join(block, ["tree", "block"]).drop("block")
            )
        steps = F.concat(F.transform("inner", lambda x: F.struct(x["left"].alias("left"), x["right"].alias("right"))), F.col("path"))
        below = stored(parts.select("tree", "rank", steps.alias("path"), "subroot", "root"), f"{label}-paths")
    return below


def folded(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and the siblings of its path."""
    return F.aggregate(path, leaf, lambda node, x: F.sha2(F.concat(x["left"], node, x["right"]), 256))


def proof_digest(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda x: F.concat(x["left"], x["right"])), ""), 256)


def manifest(
    docs: DataFrame,
    *,
    columns: Sequence[str],
    id_col: str,
    group_col: str,
    arity: int = 2,
    claims: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: id, leaf, subroot, root, path (array of left and right
    siblings, from the leaf up), claimed_leaf. ``claims`` replaces columns of a copy whose
    rows are to be verified; without it claimed_leaf is the leaf."""
    if arity < 2:
        raise ValueError("a node has at least two children")
    claims = claims or {}
    own = [named(c) for c in columns]
    leaf = leaf_digest(own)
    changed = F.lit(False)
    for c, value in claims.items():
        changed = changed | ~named(c).eqNullSafe(value)
    claimed = leaf_digest([claims.get(c, named(c)) for c in columns])
    name = F.coalesce(F.concat(F.lit("="), named(group_col).cast("string")), F.lit(""))
    leaves = docs.select(
        named(id_col).alias("id"), name.alias("tree"), leaf.alias("leaf"), F.when(changed, claimed).alias("claimed")
    )
    leaves = stored(leaves.withColumn(f"{OWN}row", F.monotonically_increasing_id()), "merkle-leaves")
    order = [F.col("id").asc_nulls_first(), F.col("leaf").asc(), F.col(f"{OWN}row").asc()]
    placed = ranked(leaves, order, "merkle-order", within=["tree"])
    placed = stored(
        placed.select("id", "tree", F.col(RANK).alias("rank"), F.col(TOTAL).alias("total"), F.col("leaf").alias("digest"), "claimed"), "merkle-ranks"
    )
    storeys, subroots = _climb(placed.select("tree", "rank", "total", "digest"), arity, "merkle-group")
    above = ranked(subroots, [F.col("tree").asc()], "merkle-groups")
    above = stored(
        above.select(F.lit("").alias("tree"), F.col(RANK).alias("rank"), F.col(TOTAL).alias("total"), "digest", F.col("tree").alias("of")), "merkle-top"
    )
    storeys_above, root = _climb(above.drop("of"), arity, "merkle-top")
    nothing = F.array().cast("array<struct<left:string,right:string>>")
    seed = root.select("tree", nothing.alias("path"), F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"))
    top = _descend(storeys_above, seed, arity, "merkle-top")
    known = above.select("rank", F.col("of").alias("tree"), "digest").join(top.select("rank", "path", "root"), "rank")
    known = known.select("tree", "path", F.col("digest").alias("subroot"), "root")
    paths = _descend(storeys, known, arity, "merkle-group")
    whole = placed.join(paths, ["tree", "rank"])
    return whole.select(
        "id", F.col("digest").alias("leaf"), "subroot", "root", "path", F.coalesce("claimed", "digest").alias("claimed_leaf")
    )


def verified(rows: DataFrame) -> DataFrame:
    """Adds proof_sha256, folded_root (from the claimed leaf and the original siblings) and
    verified to a manifest."""
    return rows.withColumns(
        {"proof_sha256": proof_digest(F.col("path")), "folded_root": folded(F.col("claimed_leaf"), F.col("path"))}
    ).withColumn("verified", F.col("folded_root") == F.col("root"))

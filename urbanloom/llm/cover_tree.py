"""Exact near-duplicate vectors by cover trees and a dual traversal.

1. Equal vectors of a label are one point with a count, so copies cost nothing further.
2. A label with more than CELL points is split around pivots, a bounded sample of its
   points (at most PIVOTS over all labels, for the PIVOTS / 2 largest ones; further labels
   are one cell without bounds): each point goes to the cell of its nearest
   pivot, cells are split by hash into chunks of about CELL points. A cell is the top node
   of a cover tree: pivot and covering radius. Pairs of chunks survive if the distance of
   their pivots is within both radii and the limit; a point goes only to pairs whose other
   node it can reach. A task holds two chunks, never a label.
3. In a task each chunk becomes a cover tree: nested levels with halving radii, every node
   with its true covering radius. Node pairs are descended together and dropped when the
   distance of their centres exceeds the limit plus both radii. Pairs of points that
   remain are confirmed by the cosine in double precision.
4. A task returns, for each point, how many vectors it links with and the smallest point
   of its component within the task, not the pairs. Components over these by stars.

Vectors are compared within one label and length only. Null, empty or zero vectors, vectors
with null or non-finite parts and vectors with a null label link with nothing. Equal
vectors link with each other. Rows that repeat an id are vectors of their own, each with its
own links. A vector with a null id links like others; its component is the smallest id in it
that is not null, if there is one. Other columns are ignored.
In high dimensions without clusters no bound prunes: then all pairs of chunks are visited,
and time grows with the square of a label's distinct vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import named, stored
from .components import components

CELL = 8_192
PIVOTS = 4_096
_SLACK = 1e-7


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, without overflow on the way."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of unit vectors."""
    return np.sqrt(np.maximum(2.0 - 2.0 * (a @ b.T), 0.0))


class CoverTree:
    """``centre`` and ``radius`` per node; ``children`` of inner nodes; ``points`` of leaves."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.centre: list[int] = []
        self.radius: list[float] = []
        self.children: list[np.ndarray | None] = []
        self.points: list[np.ndarray | None] = []
        if len(vectors):
            self._build()

    def _node(self, centre: int, radius: float) -> int:
        self.centre.append(centre)
        self.radius.append(radius)
        self.children.append(None)
        self.points.append(None)
        return len(self.centre) - 1

    def _build(self) -> None:
        every = np.arange(len(self.vectors))
        far = distances(self.vectors[:1], self.vectors)[0]
        todo = [(self._node(0, float(far.max())), every, 2.0)]
        while todo:
            node, members, level = todo.pop()
            if len(members) == 1 or self.radius[node] <= _SLACK:
                self.points[node] = members
                continue
            while level > self.radius[node] / 2:
                level /= 2  # levels at which nothing would be split
            found = self._net(members, level)
            kids = []
            for centre, own, radius in found:
                kid = self._node(centre, radius)
                kids.append(kid)
                todo.append((kid, own, level))
            self.children[node] = np.array(kids)

    def _net(self, members: np.ndarray, level: float) -> list[tuple[int, np.ndarray, float]]:
        """Centres further apart than ``level`` with the members within it, the first
        member (the node's own centre) first."""
        found, left = [], members
        while len(left):
            block = left[:256]
            table = distances(self.vectors[block], self.vectors[left])
            open_ = np.ones(len(left), dtype=bool)
            for row in range(len(block)):
                if open_[row]:
                    near = open_ & (table[row] <= level)
                    near[row] = True
                    open_ &= ~near
                    own = np.flatnonzero(near)
                    radius = float(table[row, own].max()) if len(own) > 1 else 0.0
                    own = own[own != row]
                    found.append((int(block[row]), np.concatenate([block[row : row + 1], left[own]]), radius))
            left = left[open_]
        return found


def linked_pairs(one: CoverTree, two: CoverTree, limit: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of points within ``limit``, as index arrays, by a dual traversal. For one tree
    against itself every pair comes once."""
    same = one is two
    if not one.centre or not two.centre:
        return
    radius = (np.array(one.radius), np.array(two.radius))
    centre = (np.array(one.centre), np.array(two.centre))
    todo = [(0, 0)]
    while todo:
        a, b = todo.pop()
        if one.points[a] is not None and two.points[b] is not None:
            yield from _leaf_pairs(one, two, one.points[a], two.points[b], limit, same and a == b)
            continue
        left = one.children[a] if one.points[a] is None else np.array([a])
        right = two.children[b] if two.points[b] is None else np.array([b])
        for start in range(0, len(left), 512):
            rows = left[start : start + 512]
            gap = distances(one.vectors[centre[0][rows]], two.vectors[centre[1][right]])
            open_ = gap <= limit + radius[0][rows][:, None] + radius[1][right][None, :]
            if same and a == b:
                open_ &= rows[:, None] <= right[None, :]
            x, y = np.nonzero(open_)
            todo.extend(zip(rows[x].tolist(), right[y].tolist()))


def _leaf_pairs(one, two, left, right, limit, twice):
    for start in range(0, len(left), 512):
        rows = left[start : start + 512]
        near = distances(one.vectors[rows], two.vectors[right]) <= limit
        x, y = np.nonzero(near)
        if twice:
            keep = rows[x] < right[y]
            x, y = x[keep], y[keep]
        if len(x):
            yield rows[x], right[y]


def join_group(
    owners: np.ndarray, counts: np.ndarray, side: np.ndarray, raw: np.ndarray, cosine: float, alone: bool = True
) -> pd.DataFrame:
    """(owner, links, root) of the points that link with others; ``side`` 0 and 1 are the
    two chunks; ``alone`` says that it is one chunk with itself."""
    vectors = unit(raw)
    # by powers of two, so that products of very large or small components neither overflow nor vanish
    raw = np.ldexp(raw, -np.frexp(np.abs(raw).max(axis=1, initial=0.0))[1][:, None]) if raw.size else raw
    limit = float(np.sqrt(max(0.0, 2.0 - 2.0 * cosine))) + _SLACK
    where = [np.flatnonzero(side == 0), np.flatnonzero(side == 1)]
    trees = [CoverTree(vectors[w]) for w in where]
    links = np.zeros(len(owners), dtype=np.int64)
    parent = np.arange(len(owners))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for x, y in linked_pairs(trees[0], trees[0] if alone else trees[1], limit):
        x, y = where[0][x], where[0 if alone else 1][y]
        dot = np.einsum("ij,ij->i", raw[x], raw[y])
        size = np.sqrt(np.einsum("ij,ij->i", raw[x], raw[x])) * np.sqrt(np.einsum("ij,ij->i", raw[y], raw[y]))
        sure = dot / size >= cosine
        x, y = x[sure], y[sure]
        np.add.at(links, x, counts[y])
        np.add.at(links, y, counts[x])
        for i, j in zip(x.tolist(), y.tolist()):
            i, j = root(i), root(j)
            if i != j:
                low, high = (i, j) if owners[i] < owners[j] else (j, i)
                parent[high] = low
    used = np.flatnonzero(links)
    return pd.DataFrame({"owner": owners[used], "links": links[used], "root": owners[[root(i) for i in used.tolist()]]})


def _usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def near_vectors(
    vectors: DataFrame,
    *,
    cosine: float = 0.98,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """One row per vector: id, n_links, component_id, kept (id = component_id)."""
    rows = vectors.select(
        named(id_col).cast("long").alias("id"), named(label_col).alias("label"), named(vector_col).cast("array<double>").alias("v")
    )
    fine = F.coalesce(F.col("label").isNotNull() & _usable(F.col("v")), F.lit(False))
    usable = rows.filter(fine)
    # A point is a different vector of a label; its number, not an id, names it.
    points = usable.groupBy("label", "v").agg(F.min("id").alias("low"), F.count("*").alias("n"))
    points = stored(points.withColumn("owner", F.monotonically_increasing_id()), "tree-points")
    local = _local_links(points, cosine)
    joined = components(local.select("owner", "root"), "owner", "root")
    sums = local.groupBy("owner").agg(F.sum("links").alias("links"))
    grouped = stored(
        points.join(sums, "owner", "left")
        .join(joined.withColumnRenamed("node", "owner"), "owner", "left")
        .select("label", "v", "low", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "owner").alias("group")),
        "tree-groups",
    )
    heads = grouped.groupBy("group").agg(F.min("low").alias("component_id"))
    labelled = grouped.join(heads, "group").select("label", "v", "n_links", "component_id")
    found = usable.join(labelled, ["label", "v"]).select("id", "n_links", "component_id")
    others = rows.filter(~fine).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return found.unionByName(others).select(
        F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def _chunk(owner: int, parts: int) -> int:
    """One of the chunks of a cell, mixed so that neighbouring numbers fall apart."""
    return (owner * 0x9E3779B97F4A7C15 >> 29) % parts


def _copies(rows: pd.DataFrame, places: list[int], dealt_to: list[tuple[int, ...]]) -> pd.DataFrame:
    found = rows.iloc[places].copy()
    for name, values in zip(("c1", "h1", "c2", "h2", "side"), np.array(dealt_to, dtype=np.int64).reshape(-1, 5).T):
        found[name] = values
    return found[_DEALT]


def _local_links(points: DataFrame, cosine: float) -> DataFrame:
    spark = points.sparkSession
    limit = float(np.sqrt(max(0.0, 2.0 - 2.0 * cosine))) + _SLACK
    sized = points.withColumn("d", F.size("v"))
    sizes = sized.groupBy("label", "d").agg(F.count("*").alias("n")).withColumn("parts", F.ceil(F.col("n") / CELL).cast("int"))
    sizes = stored(sizes.filter(F.col("parts") > 1), "tree-labels")
    # The largest labels get pivots; any further one is dealt to chunks by hash alone.
    large = sizes.withColumnRenamed("parts", "k").orderBy(F.desc("n"), "label", "d").limit(PIVOTS // 2).collect()
    sized = sized.join(sizes.select("label", "d", "parts"), ["label", "d"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    total = sum(r["k"] for r in large)
    wanted = [(r["label"], r["d"], max(2, min(r["k"], r["k"] * PIVOTS // (2 * max(total, 1))))) for r in large]
    pivots: dict[tuple, np.ndarray] = {}
    if wanted:
        label_type = points.schema["label"].dataType.simpleString()
        need = F.broadcast(spark.createDataFrame(wanted, f"label {label_type}, d int, k int"))  # at most PIVOTS / 2 rows
        draw = Window.partitionBy("label", "d").orderBy("h", "owner")
        # A hash below k / n keeps about twice as many rows as are wanted, so the window is small.
        counts = F.broadcast(spark.createDataFrame([(r["label"], r["d"], r["n"]) for r in large], f"label {label_type}, d int, total long"))
        share = F.pmod(F.xxhash64("owner"), F.lit(1 << 30)) / float(1 << 30)
        drawn = (
            sized.join(need, ["label", "d"]).join(counts, ["label", "d"]).withColumn("h", share)
            .filter(F.col("h") * F.col("total") < 2 * F.col("k") + 16)
            .withColumn("place", F.row_number().over(draw)).filter(F.col("place") <= F.col("k"))
        )
        for r in drawn.select("label", "d", "v").collect():  # at most PIVOTS rows
            pivots.setdefault((r["label"], r["d"]), []).append(r["v"])
        pivots = {key: unit(np.array(rows)) for key, rows in pivots.items()}
    shared = spark.sparkContext.broadcast(pivots)

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, rows in batch.groupby(["label", "d"], sort=False):
                own = shared.value.get(key)
                rows = rows.assign(cell=0, gap=0.0)
                if own is not None:
                    gaps = distances(unit(np.stack(rows["v"].to_numpy())), own)
                    rows["cell"], rows["gap"] = gaps.argmin(axis=1), gaps.min(axis=1)
                yield rows[["label", "d", "parts", "cell", "gap", "owner", "n", "v"]]

    label_type = points.schema["label"].dataType.simpleString()
    placed = sized.select("label", "d", "parts", "owner", "n", "v").mapInPandas(
        nearest, f"label {label_type}, d int, parts int, cell int, gap double, owner long, n long, v array<double>"
    )
    if pivots:
        placed = stored(placed, "tree-cells")
        stats = placed.join(need.select("label", "d"), ["label", "d"]).groupBy("label", "d", "cell").agg(
            F.count("*").alias("n"), F.max("gap").alias("radius")
        ).collect()  # at most PIVOTS rows
    else:
        stats = []
    cells: dict[tuple, dict[int, tuple[int, float]]] = {}
    for r in stats:
        cells.setdefault((r["label"], r["d"]), {})[r["cell"]] = (-(-r["n"] // CELL), r["radius"])
    shared_cells = spark.sparkContext.broadcast(cells)

    def dealt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Each point once for every pair of chunks it may link in."""
        for batch in batches:
            for key, rows in batch.groupby(["label", "d"], sort=False):
                own, at = shared_cells.value.get(key), shared.value.get(key)
                if own is None:
                    own, gaps = {0: (int(rows["parts"].iloc[0]), float("inf"))}, np.zeros((len(rows), 1))
                else:
                    gaps = distances(unit(np.stack(rows["v"].to_numpy())), at)
                places, dealt_to = [], []
                for place, (cell, owner) in enumerate(zip(rows["cell"].tolist(), rows["owner"].tolist())):
                    mine = (cell, _chunk(owner, own[cell][0]))
                    for other, (parts, reach) in own.items():
                        apart = gaps[place, other] > reach + limit or gaps[place, other] > gaps[place, cell] + 2 * limit
                        if other != cell and apart:
                            continue
                        for part in range(parts):
                            low, high = sorted([mine, (other, part)])
                            places.append(place)
                            dealt_to.append((*low, *high, 0 if mine == low else 1))
                    if len(places) > 20_000 or place == len(rows) - 1:
                        yield _copies(rows, places, dealt_to)
                        places, dealt_to = [], []

    pairs = placed.mapInPandas(
        dealt, f"label {label_type}, d int, c1 int, h1 int, c2 int, h2 int, side int, owner long, n long, v array<double>"
    )

    def link(group: pd.DataFrame) -> pd.DataFrame:
        c1, h1, c2, h2 = group[["c1", "h1", "c2", "h2"]].iloc[0]
        raw = np.stack(group["v"].to_numpy())
        owner, n, side = (group[name].to_numpy() for name in ("owner", "n", "side"))
        return join_group(owner, n, side, raw, cosine, alone=(c1, h1) == (c2, h2))

    keys = ["label", "d", "c1", "h1", "c2", "h2"]
    return stored(pairs.groupBy(*keys).applyInPandas(link, "owner long, links long, root long"), "tree-links")


_DEALT = ["label", "d", "c1", "h1", "c2", "h2", "side", "owner", "n", "v"]

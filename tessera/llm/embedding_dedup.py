"""Embedding near-duplicates by an exact tiled comparison in PCA order.

Vectors are scaled to length one. Equal vectors (two 64-bit hashes agree) are merged and counted. Principal axes and a k-d tree
over the leading ones are fitted on a bounded sample: neither changes a result, the axes decide how early a comparison can
stop and the tree which vectors share a tile. Vectors are ordered by leaf and first coordinate and cut into tiles of equal size;
a table of the tiles' ranges of leading coordinates rules out pairs of tiles that lie too far apart. Each other pair of tiles is
one task's work, in sub-blocks that are held against their own ranges first: the leading coordinates' products are accumulated,
the product of the two suffix norms bounds what the rest can add, and only pairs whose bound reaches the threshold go on to
the next coordinates, a bounded number of pairs at a time. Survivors are decided by the product of the unit vectors themselves,
in double precision. A task returns for each of its vectors the number of its links and one link of a spanning forest, never
the pairs themselves.

Defined cases: a vector that is null, empty, zero or holds null or non-finite components links with nothing and is its own
component; vectors of different lengths do not link; repeated rows link with each other and share a component; null ids stay;
an empty table gives an empty result; columns other than the two named are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import drop_staged, map_rows, staged
from tessera.llm.components import components

THRESHOLD = 0.95
#: Rows on which the axes and the tree are fitted, at most; and numbers in that sample, at most.
AXES_ROWS, AXES_NUMBERS = 20_000, 4_000_000
#: Numbers in a tile of vectors at most, and tiles at least.
TILE_NUMBERS, LEAST_TILES = 2_000_000, 12
#: Rows of a sub-block, and numbers gathered at once for its surviving pairs.
SUB_ROWS, GATHERED = 512, 2_000_000
#: Coordinates accumulated before each test of the bound.
LEADING = (12, 24, 48, 96)
BOXES = 8
#: Rows of the sample in a leaf of the tree, about, and its depth at most.
LEAF_ROWS, DEPTH = 64, 12


def unit_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id, dim, v (array of doubles of length one, null where the vector cannot link) and two hashes of v, k1 and k2."""
    v = F.col(vec_col).cast("array<double>")
    sound = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    most = F.aggregate(v, F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x)))
    scaled = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.when(sound, v).alias("v"), F.when(sound, most).alias("most"))
    scaled = scaled.select("vec_id", F.when(F.col("most") > 0, F.transform("v", lambda x: x / F.col("most"))).alias("v"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    units = scaled.withColumn("norm", norm).select("vec_id", F.size("v").alias("dim"), F.transform("v", lambda x: x / F.col("norm") + 0.0).alias("v"))
    return units.select("*", F.xxhash64("v").alias("k1"), F.xxhash64(F.lit("second"), "v").alias("k2"))


def matrix(column, width: int) -> np.ndarray:
    """Arrow lists as rows of a matrix, shorter ones filled with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width))
    out[np.repeat(np.arange(len(sizes)), sizes), np.concatenate([np.arange(n) for n in sizes])] = flat
    return out


class Order:
    """Principal axes of a sample, strongest first, and a k-d tree over its leading coordinates."""

    def __init__(self, sample: np.ndarray) -> None:
        self.basis = np.linalg.eigh(sample.T @ sample)[1][:, ::-1][:, : LEADING[-1]]
        y = sample @ self.basis[:, :BOXES]
        self.depth = min(DEPTH, max(0, int(np.log2(max(1, len(y)) / LEAF_ROWS))))
        self.axis, self.cut = np.zeros((1 << self.depth) - 1, dtype="i8"), np.zeros((1 << self.depth) - 1)
        held = {0: y}
        for node in range(len(self.axis)):
            rows = held.pop(node)
            axis = int(np.argmax(rows.max(axis=0) - rows.min(axis=0))) if len(rows) else 0
            cut = float(np.median(rows[:, axis])) if len(rows) else 0.0
            self.axis[node], self.cut[node] = axis, cut
            held[2 * node + 1], held[2 * node + 2] = rows[rows[:, axis] <= cut], rows[rows[:, axis] > cut]

    def leading(self, v: np.ndarray) -> np.ndarray:
        return v @ self.basis

    def leaves(self, y: np.ndarray) -> np.ndarray:
        node, row = np.zeros(len(y), dtype="i8"), np.arange(len(y))
        for _ in range(self.depth):
            node = 2 * node + 1 + (y[row, self.axis[node]] > self.cut[node])
        return node


def fitted(classes: DataFrame, width: int) -> Order:
    rows = classes.select("v").coalesce(1).limit(max(1, min(AXES_ROWS, AXES_NUMBERS // width))).toArrow().column("v").combine_chunks()
    return Order(matrix(rows, width))


def placed_in_order(classes: DataFrame, order: Order, width: int) -> DataFrame:
    """The classes with leaf, y0 and box (the coordinates that tiles' ranges are made of)."""

    def rows(batches):
        for batch in batches:
            if batch.num_rows:
                y = order.leading(matrix(batch.column("v"), width))
                yield {c: batch.column(c) for c in ("first", "n", "dim", "k1", "k2", "v")} | {"leaf": order.leaves(y), "y0": y[:, 0], "box": list(y[:, :BOXES])}

    return map_rows(classes.select("first", "n", "dim", "k1", "k2", "v"), rows, "first long, n long, dim int, k1 long, k2 long, v array<double>, leaf long, y0 double, box array<double>")


def block(y1: np.ndarray, y2: np.ndarray, v1: np.ndarray, v2: np.ndarray, threshold: float):
    """Pairs (i, j) of rows whose product v1[i] @ v2[j] reaches the threshold, in parts of bounded size; y are leading coordinates."""
    stops = [k for k in LEADING if k < y1.shape[1]] or [y1.shape[1]]
    suffix = lambda a, k: np.sqrt(np.maximum(0.0, 1.0 - (a[:, :k] ** 2).sum(axis=1)))
    rest = {k: (suffix(y1, k), suffix(y2, k)) for k in stops}
    # products of the leading coordinates, and as one more coordinate the suffix norms: their sum is the bound
    left, right = (np.c_[a[:, : stops[0]], r].astype("f4") for a, r in ((y1, rest[stops[0]][0]), (y2, rest[stops[0]][1])))
    near = np.flatnonzero(left @ right.T >= threshold - 1e-4)
    most = max(1, GATHERED // v1.shape[1])
    for at in range(0, len(near), most):
        i, j = np.divmod(near[at : at + most], len(y2))
        done = np.einsum("ij,ij->i", y1[i, : stops[0]], y2[j, : stops[0]])
        for cut, stop in zip(stops, stops[1:]):
            done += np.einsum("ij,ij->i", y1[i, cut:stop], y2[j, cut:stop])
            alive = done + rest[stop][0][i] * rest[stop][1][j] >= threshold - 1e-9
            i, j, done = i[alive], j[alive], done[alive]
        alive = np.einsum("ij,ij->i", v1[i], v2[j]) >= threshold
        if alive.any():
            yield i[alive], j[alive]


def roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest node of each node's component, by vectorised label propagation."""
    label = np.arange(n)
    while len(i):
        least = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, label[i], least)
        np.minimum.at(label, label[j], least)
        label = label[label]
        if (label == before).all():
            break
    while (label != label[label]).any():
        label = label[label]
    return label


class Tile:
    """Vectors of one side with their leading coordinates and the ranges of these in each sub-block."""

    def __init__(self, order: Order, rows: np.ndarray, v: np.ndarray) -> None:
        self.rows, self.v, self.y = rows, v, order.leading(v)
        self.starts = range(0, len(rows), SUB_ROWS)
        boxes = [self.y[a : a + SUB_ROWS, :BOXES] for a in self.starts]
        self.low, self.high = (np.array([f(axis=0) for f in fs]) for fs in ([b.min for b in boxes], [b.max for b in boxes]))

    def near(self, other: Tile, a: int, threshold: float) -> np.ndarray:
        """Sub-blocks of other that may hold links with the a-th of this tile."""
        gap = np.maximum(0.0, np.maximum(self.low[a] - other.high, other.low - self.high[a]))
        return np.flatnonzero((gap**2).sum(axis=1) <= 2 * (1 - threshold) + 1e-9)


def tile_links(one: Tile, two: Tile, n: np.ndarray, dim: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Links of each row with the other tile's (or the same one's), counted with copies, and the row it hangs on."""
    links, label = np.zeros(len(n), dtype="i8"), np.arange(len(n))
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for a, start in enumerate(one.starts):
        x = slice(start, start + SUB_ROWS)
        for b in one.near(two, a, threshold):
            y = slice(two.starts[b], two.starts[b] + SUB_ROWS)
            if one is two and b < a:
                continue
            for i, j in block(one.y[x], two.y[y], one.v[x], two.v[y], threshold):
                i, j = one.rows[x][i], two.rows[y][j]
                keep = (dim[i] == dim[j]) & (i < j if one is two and a == b else i != j)
                i, j = i[keep], j[keep]
                np.add.at(links, i, n[j])
                np.add.at(links, j, n[i])
                held.append(spanning(i, j))
        if sum(len(i) for i, _ in held) > 1 << 18:
            held = [spanning(*map(np.concatenate, zip(*held)))]
    if held:
        label = roots(len(n), *map(np.concatenate, zip(*held)))
    return links, label


def spanning(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fewer links that connect the same rows: each row with its component's smallest."""
    nodes, place = np.unique(np.concatenate([i, j]), return_inverse=True)
    top = roots(len(nodes), place[: len(i)], place[len(i) :])
    other = np.flatnonzero(top != np.arange(len(nodes)))
    return nodes[other], nodes[top[other]]


def compared(dealt: DataFrame, order: Order, width: int, threshold: float) -> DataFrame:
    """node, links, root of every vector with links, for each pair of tiles in (pair, side, node, n, dim, v)."""

    def solve(parts: list):
        get = lambda c: np.concatenate([p.column(c).to_numpy() for p in parts])
        side, node, n, dim = get("side"), get("node"), get("n"), get("dim")
        v = np.concatenate([matrix(p.column("v"), width) for p in parts])
        by_node = np.argsort(node, kind="stable")
        side, node, n, dim, v = side[by_node], node[by_node], n[by_node], dim[by_node], v[by_node]
        a, b = np.flatnonzero(side <= 1), np.flatnonzero(side == 2)
        if not len(a):
            return
        one = Tile(order, a, v[a])
        links, label = tile_links(one, Tile(order, b, v[b]) if len(b) else one, n, dim, threshold)
        found = np.flatnonzero(links)
        if len(found):
            yield {"node": node[found], "links": links[found], "root": node[label[found]]}

    def rows(batches):
        held: list = []
        for batch in batches:
            pair = batch.column("pair").to_numpy()
            for a, b in zip(cuts := [0, *(np.flatnonzero(pair[1:] != pair[:-1]) + 1).tolist(), len(pair)], cuts[1:]):
                if b > a:
                    if held and held[0].column("pair")[0].as_py() != pair[a]:
                        yield from solve(held)
                        held = []
                    held.append(batch.slice(a, b - a))
        if held:
            yield from solve(held)

    return map_rows(dealt.repartition("pair").sortWithinPartitions("pair"), rows, "node long, links long, root long")


def tile_pairs(placed: DataFrame, n_tiles: int, threshold: float) -> DataFrame:
    """(pair, tile, side) for the pairs of tiles whose ranges of leading coordinates are near enough to hold a link."""
    ranges = staged(placed.groupBy("tile").agg(*[f(F.col("box")[k]).alias(f"{name}{k}") for k in range(BOXES) for f, name in ((F.min, "lo"), (F.max, "hi"))]), "tile-boxes")
    one = ranges.select(F.col("tile").alias("t1"), *[F.col(c).alias(f"a_{c}") for c in ranges.columns if c != "tile"], F.explode(F.sequence("tile", F.lit(n_tiles - 1).cast("long"))).alias("t2"))
    both = one.join(ranges.withColumnRenamed("tile", "t2"), "t2")
    gap = lambda k: F.greatest(F.lit(0.0), F.col(f"a_lo{k}") - F.col(f"hi{k}"), F.col(f"lo{k}") - F.col(f"a_hi{k}"))
    apart = sum((gap(k) * gap(k) for k in range(BOXES)), F.lit(0.0))
    near = both.filter(apart <= 2 * (1 - threshold) + 1e-9).withColumn("pair", F.col("t1") * n_tiles + F.col("t2"))
    left = near.select("pair", F.col("t1").alias("tile"), F.when(F.col("t1") == F.col("t2"), 0).otherwise(1).alias("side"))
    return left.unionAll(near.filter("t1 <> t2").select("pair", F.col("t2").alias("tile"), F.lit(2).alias("side")))


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vec_col: str = "embedding", tile: int | None = None) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per vector. tile: vectors in a tile at most."""
    units = staged(unit_vectors(vectors, id_col, vec_col), "unit-vectors")
    sound = units.filter("v is not null")
    shape = sound.agg(F.max("dim").alias("width")).first()
    if not shape["width"]:
        return units.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    width = max(shape["width"], BOXES)
    classes = staged(sound.groupBy("k1", "k2").agg(F.min("vec_id").alias("first"), F.count("*").alias("n"), F.first("dim").alias("dim"), F.first("v").alias("v")), "vector-classes")
    order = fitted(classes, width)
    turned = placed_in_order(classes, order, width)
    ordered = staged(turned.repartitionByRange("leaf", "y0").sortWithinPartitions("leaf", "y0", "k1", "k2").withColumn("place", F.monotonically_increasing_id()), "ordered-vectors")
    part = F.shiftright("place", 33)
    sizes = sorted((r["p"], r["n"]) for r in ordered.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect())  # one row a partition
    total = sum(n for _, n in sizes)
    starts, at = [], 0
    for p, n in sizes:
        starts.append((p, at))
        at += n
    rows_a_tile = max(1, min(tile or TILE_NUMBERS // width, -(-total // LEAST_TILES)))
    n_tiles = max(1, -(-total // rows_a_tile))
    base = vectors.sparkSession.createDataFrame(starts or [(0, 0)], "p long, base long")
    placed = ordered.join(F.broadcast(base), part == F.col("p")).withColumn("node", F.col("base") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1)))
    placed = placed.withColumn("tile", F.floor(F.col("node") / rows_a_tile))
    dealt = placed.select("node", "n", "dim", "v", "tile").join(tile_pairs(placed, n_tiles, threshold), "tile").select("pair", "side", "node", "n", "dim", "v")
    found = staged(compared(dealt, order, width, threshold), "tile-links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    groups = staged(components(found.filter("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))), "vector-groups").withColumnRenamed("root", "top")
    nodes = placed.select("node", "first", "n", "k1", "k2").join(links, "node", "left").join(groups, "node", "left")
    nodes = staged(nodes.select("first", "k1", "k2", F.coalesce("top", "node").alias("top"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links")), "vector-nodes")
    # stored, so that the join's sides are plain exchanges, which adaptive execution can split at a very large group
    least = staged(nodes.groupBy("top").agg(F.min("first").alias("component_id")), "vector-least")
    by_key = staged(nodes.join(least, "top").select("k1", "k2", "links", "component_id"), "vector-keys")
    for done in (classes, ordered, found, groups, nodes, least):
        drop_staged(done)
    linked = sound.select("vec_id", "k1", "k2").join(by_key, ["k1", "k2"]).select("vec_id", F.col("links").alias("n_links"), "component_id")
    other = units.filter("v is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionAll(other).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))

"""Centroid clustering by dual-tree Lloyd rounds over integer vectors (operator 12).

Vectors are dealt into blocks of BLOCK rows at most, near ones together, and each block gets a cover tree once: a
farthest-first order gives nested nets whose points lie more than BASE ** level apart and cover the block within as
much; a point hangs from the nearest point of the net above. Blocks with their trees are stored, so a round is one
pass over them. In each round the centroids get a tree too, split by their two farthest members, and both trees go down
together: a pair of nodes is dropped when the least distance between its members exceeds the most distance that
some other centroid node promises to every vector below. A vector node with one centroid left is settled as a whole;
what arrives at leaves is compared exactly. Blocks return sums and counts for each centroid, which Spark adds up;
only k centroids reach the driver.

Distances are those of integers: in double precision where every term is below 2 ** 53 and so exact, else in 64-bit
integers. Bounds carry a margin, so that ties always reach the exact comparison, where the smaller number wins.

Cases: vectors that are null, have another number of components, or hold null or non-finite ones take no part, nor do
those longer than REACH, whose squared distances need not fit a long; rows that repeat an id are vectors each, and
a null id is one more id, last in the order of starting centroids; fewer vectors than k give as many centroids; no
vector gives no row; equal vectors may start several centroids, of which the larger number stays empty; an empty
centroid keeps its place and takes part on; other columns are not read.
"""

from __future__ import annotations

import hashlib
import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.llm.common import bounded_batches, stored
from weft.llm.textbatch import lean

K, ROUNDS, SEED, COMPONENTS, SCALE = 40, 5, 2, 64, 256
#: Rows of a block and those put in order of nearness before they are cut into blocks; ratio of the net's levels.
BLOCK, GATHER, BASE = 1024, 16_384, 1.3
#: The longest vector: the square of any distance then fits a long.
REACH = 2.0**30
#: Vectors and centroids whose squared lengths are below this have all terms of a distance below 2 ** 53.
EXACT = 2.0**49


def kept(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """(vec_id, x): the vectors that take part, as integers."""
    e = F.col("embedding")
    number = lambda x: F.floor(x.cast("double") * F.lit(float(scale)))
    sound = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) * scale <= F.lit(REACH)))
    rows = vectors.filter(e.isNotNull() & (F.size(e) == components) & sound)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(e, number).alias("x"))
    return rows.filter(F.aggregate("x", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")) <= F.lit(REACH**2))


def starting(rows: DataFrame, k: int = K, seed: int = SEED) -> np.ndarray:
    """The k vectors of the smallest hashed ids, ties by components; k rows reach the driver."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.select(h.alias("h"), "x").orderBy(F.col("h").asc_nulls_last(), "x").limit(k).collect()
    return np.array([r["x"] for r in first], np.int64)


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of x to all of y."""
    if not len(x) or not len(y):
        return np.zeros((len(x), len(y)), np.int64)
    xf, yf = x.astype(np.float64), y.astype(np.float64)
    xx, yy = (xf * xf).sum(1), (yf * yf).sum(1)
    if max(xx.max(), yy.max()) < EXACT:
        return (xx[:, None] - 2.0 * (xf @ yf.T) + yy[None, :]).astype(np.int64)
    return np.stack([((x - c) ** 2).sum(1) for c in y], 1)


class CoverTree:
    """Nodes in order from the root: the point at the centre, how far its members are, its children, its members.

    Points are in an order in which the members of every node are one stretch.
    """

    def __init__(self, x: np.ndarray):
        n = len(x)
        apart = squared(x, x)  # BLOCK squared of them at most
        far = apart[0].copy()
        near, level, parent = np.zeros(n, np.int64), np.full(n, 1 << 30), np.full(n, -1)
        chosen, above, now = np.zeros(n, bool), near.copy(), None
        chosen[0] = True
        while (p := int(np.argmax(far))) >= 0 and far[p] > 0:
            at = int(np.ceil(np.log(float(far[p])) / (2 * np.log(BASE)))) - 1  # the net of points more than BASE ** at apart
            if at != now:
                now, above = at, near.copy()  # points of this net hang from the net above
            level[p], parent[p], chosen[p] = at, above[p], True
            closer = apart[p] < far
            far[closer], near[closer] = apart[p][closer], p
        same = np.flatnonzero(~chosen)
        parent[same], level[same] = near[same], -(1 << 30)  # copies hang from the point that they equal
        self._nodes(apart, level, parent)

    def _nodes(self, apart: np.ndarray, level: np.ndarray, parent: np.ndarray) -> None:
        n = len(apart)
        below: dict[int, dict[int, list[int]]] = {}
        for p in np.argsort(-level, kind="stable"):
            if parent[p] >= 0:
                below.setdefault(int(parent[p]), {}).setdefault(int(level[p]), []).append(int(p))
        # a node is a point with its levels from some level down; a list of its levels, the first is the next to open
        centre, child, kids, queue = [0], [0], [0], [(0, sorted(below.get(0, {}), reverse=True))]
        at = 0
        while at < len(queue):
            p, levels = queue[at]
            child[at] = len(queue)
            if levels:
                for q, rest in [(p, levels[1:]), *((q, sorted(below.get(q, {}), reverse=True)) for q in below[p][levels[0]])]:
                    queue.append((q, rest))
                    centre.append(q)
                    child.append(0)
                    kids.append(0)
            kids[at] = len(queue) - child[at]
            at += 1
        self.centre, self.child, self.kids = (np.array(v, np.int64) for v in (centre, child, kids))
        m = len(centre)
        size = np.where(self.kids == 0, 1, 0)
        for i in range(m - 1, -1, -1):
            if self.kids[i]:
                size[i] = size[self.child[i] : self.child[i] + self.kids[i]].sum()
        self.start, self.size = np.zeros(m, np.int64), size
        for i in range(m):
            if self.kids[i]:
                c = self.child[i]
                self.start[c : c + self.kids[i]] = self.start[i] + np.append(0, np.cumsum(size[c : c + self.kids[i]])[:-1])
        leaf = np.flatnonzero(self.kids == 0)
        self.points = np.zeros(n, np.int64)
        self.points[self.start[leaf]] = self.centre[leaf]
        radius = np.zeros(m)
        for i in np.flatnonzero(self.kids):
            radius[i] = np.sqrt(float(apart[self.centre[i], self.points[self.start[i] : self.start[i] + size[i]]].max()))
        self.radius = radius


class CentroidTree:
    """Centroids halved by their two farthest members: nodes with centre, radius, two children and, at leaves, the number."""

    def __init__(self, c: np.ndarray):
        self.centre, self.radius, self.child, self.number = [], [], [], []
        queue = [np.arange(len(c))]
        at = 0
        while at < len(queue):
            mine = queue[at]
            mean = np.rint(c[mine].astype(np.float64).mean(0)).astype(np.int64) if len(mine) > 1 else c[mine[0]]
            d = squared(c[mine], mean[None])[:, 0]
            self.centre.append(mean)
            self.radius.append(float(np.sqrt(float(d.max()))))
            self.child.append(len(queue))
            self.number.append(int(mine[0]) if len(mine) == 1 else -1)
            if len(mine) > 1:
                a = int(np.argmax(d))
                b = int(np.argmax(squared(c[mine], c[mine[a]][None])[:, 0]))
                two = squared(c[mine], c[mine[[a, b]]])
                left = two[:, 0] < two[:, 1]
                left[a], left[b] = True, False
                if a == b:  # all are equal
                    left = np.arange(len(mine)) < len(mine) // 2
                queue += [mine[left], mine[~left]]
            at += 1
        self.centre, self.radius = np.array(self.centre, np.int64), np.array(self.radius)
        self.child, self.number = np.array(self.child), np.array(self.number)


def assigned(x: np.ndarray, tree: CoverTree, cents: np.ndarray, goal: CentroidTree) -> tuple[np.ndarray, int]:
    """The nearest centroid of each row of x (the smaller number of equals), and how many distances were computed."""
    out = np.full(len(x), -1)
    node, other, work = np.zeros(1, np.int64), np.zeros(1, np.int64), 0
    # pairs at leaves of both trees wait here for the exact comparison
    last: list[tuple[np.ndarray, np.ndarray]] = []
    while len(node):
        d2 = np.zeros(len(node), np.int64)
        for c in np.unique(other):
            of = np.flatnonzero(other == c)
            d2[of] = squared(x[tree.centre[node[of]]], goal.centre[c][None])[:, 0]
        work += len(node)
        d = np.sqrt(d2.astype(np.float64))
        reach = tree.radius[node] + goal.radius[other]
        least = np.full(len(tree.centre), np.inf)
        np.minimum.at(least, node, d + reach)
        live = d - reach <= least[node] * (1 + 1e-9) + 1e-6
        node, other = node[live], other[live]
        single = goal.number[other] >= 0
        rivals = np.bincount(node, minlength=len(tree.centre))
        alone = single & (rivals[node] == 1)
        for i, c in zip(node[alone], goal.number[other[alone]]):
            out[tree.points[tree.start[i] : tree.start[i] + tree.size[i]]] = c
        leaf = tree.kids[node] == 0
        ends = leaf & single & ~alone
        # a vector whose pairs don't all end here goes on with all of them, so that its minimum is of all
        whole = np.bincount(node[ends], minlength=len(tree.centre)) == rivals
        ends &= whole[node]
        last.append((node[ends], goal.number[other[ends]]))
        go = ~alone & ~ends
        node, other, leaf, single = node[go], other[go], leaf[go], single[go]
        n_left, n_right = np.where(leaf, 1, tree.kids[node]), np.where(single, 1, 2)
        n = n_left * n_right
        at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        right = np.repeat(n_right, n)
        node, other = (
            np.repeat(np.where(leaf, node, tree.child[node]), n) + at // right,
            np.repeat(np.where(single, other, goal.child[other]), n) + at % right,
        )
    leaves, numbers = np.concatenate([a for a, _ in last]), np.concatenate([b for _, b in last])
    if len(leaves):
        d2 = np.zeros(len(leaves), np.int64)
        for c in np.unique(numbers):
            of = np.flatnonzero(numbers == c)
            d2[of] = squared(x[tree.centre[leaves[of]]], cents[c][None])[:, 0]
        work += len(leaves)
        order = np.lexsort((numbers, d2, leaves))
        first = np.append(True, leaves[order][1:] != leaves[order][:-1])
        out[tree.centre[leaves[order][first]]] = numbers[order][first]
    return out, work


def _packed(**arrays: np.ndarray) -> bytes:
    """Arrays as one value, each in the smallest integers that hold it."""
    out = io.BytesIO()
    for a in arrays.values():
        kind = next(k for k in (np.int8, np.int16, np.int32, np.int64) if not a.size or (np.iinfo(k).min <= a.min() and a.max() <= np.iinfo(k).max)) if a.dtype != np.float64 else np.float64
        np.save(out, a.astype(kind), allow_pickle=False)
    return out.getvalue()


def _unpacked(raw: bytes, n: int) -> list[np.ndarray]:
    file = io.BytesIO(raw)
    arrays = (np.load(file, allow_pickle=False) for _ in range(n))
    return [a if a.dtype == np.float64 else a.astype(np.int64) for a in arrays]


_PARTS = ("x", "centre", "child", "kids", "start", "size", "points", "radius")


def blocks(spark: SparkSession, rows: DataFrame, cents: np.ndarray) -> DataFrame:
    """(ids, block): vectors with their cover trees. Rows stay in their tasks, those near the same centroid together."""
    d = cents.shape[1]

    def cut(ids: pa.Array, x: np.ndarray) -> pa.RecordBatch:
        order = np.argsort(squared(x, cents).argmin(1), kind="stable")
        names, out = [], []
        for a in range(0, len(order), BLOCK):
            mine = order[a : a + BLOCK]
            tree = CoverTree(x[mine])
            names.append(ids.take(pa.array(mine)).to_pylist())
            out.append(_packed(x=x[mine], **{p: getattr(tree, p) for p in _PARTS[1:]}))
        return pa.RecordBatch.from_arrays([pa.array(names, pa.list_(pa.int64())), pa.array(out, pa.binary())], ["ids", "block"])

    @lean
    def run(batches):
        ids, xs, held = [], [], 0
        for b in batches:
            for a in range(0, b.num_rows, GATHER):
                part = b.slice(a, GATHER)
                ids.append(part.column(0))
                xs.append(part.column(1).flatten().to_numpy().reshape(-1, d))
                held += part.num_rows
                if held >= GATHER:
                    yield cut(pa.concat_arrays(ids), np.concatenate(xs))
                    ids, xs, held = [], [], 0
        if held:
            yield cut(pa.concat_arrays(ids), np.concatenate(xs))

    return stored(spark, rows.mapInArrow(run, "ids array<long>, block binary"), "blocks")


def _tree(raw: bytes) -> tuple[np.ndarray, CoverTree]:
    x, *arrays = _unpacked(raw, len(_PARTS))
    tree = CoverTree.__new__(CoverTree)
    for name, a in zip(_PARTS[1:], arrays):
        setattr(tree, name, a)
    return x, tree


def moved(spark: SparkSession, held: DataFrame, cents: np.ndarray) -> np.ndarray:
    """The centroids after one round: exact floors of the means, empty ones as they were."""
    k, d = cents.shape

    @lean
    def run(batches):
        goal, sums, counts = CentroidTree(cents), np.zeros((k, d), np.int64), np.zeros(k, np.int64)
        for b in batches:
            for raw in b.column(0):
                x, tree = _tree(raw.as_buffer().to_pybytes())
                to, _ = assigned(x, tree, cents, goal)
                np.add.at(sums, to, x)
                counts += np.bincount(to, minlength=k)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some]), pa.array(sums[some].tolist(), pa.list_(pa.int64()))], ["c", "n", "s"])

    parts = held.select("block").mapInArrow(run, "c long, n long, s array<long>")
    parts = parts.select("c", "n", F.posexplode("s").alias("i", "s")).groupBy("c", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    out = cents.copy()
    for r in parts.collect():  # k times the components at most
        out[r["c"], r["i"]] = r["s"] // r["n"]
    return out


def nearest(held: DataFrame, cents: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of every vector."""

    @lean
    def run(batches):
        goal = CentroidTree(cents)
        for b in batches:
            for ids, raw in zip(b.column(0), b.column(1)):
                x, tree = _tree(raw.as_buffer().to_pybytes())
                to, _ = assigned(x, tree, cents, goal)
                far = ((x - cents[to]) ** 2).sum(1)
                yield pa.RecordBatch.from_arrays([ids.values, pa.array(to.astype(np.int32)), pa.array(far)], ["vec_id", "cluster", "distance"])

    return held.mapInArrow(run, "vec_id long, cluster int, distance long")


def clusters(spark: SparkSession, vectors: DataFrame, k: int = K, rounds: int = ROUNDS, seed: int = SEED, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every vector that takes part."""
    bounded_batches(spark)
    rows = kept(vectors, components, scale)
    cents = starting(rows, k, seed)
    kind = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not len(cents):
        return spark.createDataFrame([], kind)
    held = blocks(spark, rows, cents)
    for _ in range(rounds):
        cents = moved(spark, held, cents)
    found = stored(spark, nearest(held, cents), "clusters")
    sums = {r["cluster"]: r["d"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}  # k rows
    names = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in cents]
    about = spark.createDataFrame([(c, d, sum(sums.values()), names[c]) for c, d in sums.items()], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")

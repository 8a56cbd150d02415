"""Approximate nearest neighbours: inverted file with product-quantised residuals (operator 8).

A bounded sample fits coarse centroids and the codebooks of their residuals; every vector is indexed
with its cell and code. A query visits its nearest cells, as many as a brute-force search within the
sample shows to be needed for the recall asked for. Within a cell, blocks of vectors and slices of
queries, both bounded in bytes, meet one pair at a time. A table of products of each query with all
codewords gives the asymmetric distance to every code of the block (less the code's own error); the
vectors whose estimate is within a margin of the block's k-th best, and of a distance within which the
sample rows of the visited cells already give twice the rows asked for, are ranked exactly in double
precision, however many they are; the block's best leave the task. The margin is measured in the sample
too. Both salts follow the counts of the cells, so a cell that holds a third of all vectors, or of all
queries, is many small groups; of equal vectors of a block only the k + 1 smallest ids can be asked for.

Cells are about the square root of the rows, MOST_CELLS at most (a parameter): beyond its square in rows
(16.8 million) cells grow in proportion to the rows.

Cases: vectors that are null, zero, hold null or non-finite components, or have another length than
most, and rows without vec_id take no part; equal distances go to the smaller vec_id; repeated rows
are candidates each; a query with fewer candidates returns all of them; empty tables give an empty
result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weft.llm.common import bounded_batches, stored
from weft.llm.textbatch import lean, trim

SAMPLE_ROWS = 20_000
#: So many sample rows fit the codebooks.
BOOK_ROWS = 8_192
MOST_CELLS = 4096
PARTS, CODES = 16, 256
#: Of the sample; misses gather where dense groups are split over many cells, so it is set above what is asked for.
RECALL = 0.99
#: The share of true neighbours that the margin of the estimates must leave in.
KEPT = 0.995
#: Vectors of a block and queries of a slice, at most; smaller blocks where there are few vectors.
BLOCK_BYTES = 32 << 20
QUERY_BYTES = 32 << 20
LEAST_BLOCK = 128
#: Estimates and exact components held at once.
HELD = 2_000_000


def kmeans(x: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    """Lloyd's centroids; empty ones move to the points farthest from theirs."""
    rng = np.random.default_rng(seed)
    k = min(k, len(x))
    c = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        d = distances(x, c)
        near = d.argmin(1)
        n = np.bincount(near, minlength=k)
        total = np.stack([np.bincount(near, x[:, j], k) for j in range(x.shape[1])], 1)
        c[n > 0] = total[n > 0] / n[n > 0, None]
        if (empty := np.flatnonzero(n == 0)).size:
            c[empty] = x[np.argsort(-d[np.arange(len(x)), near], kind="stable")[: len(empty)]]
    return c


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared Euclidean distances between rows."""
    return np.maximum((x**2).sum(1)[:, None] - 2 * x @ c.T + (c**2).sum(1)[None], 0)


class Index:
    """Centroids and codebooks, with the sample they come from."""

    def __init__(self, sample: np.ndarray, ids: np.ndarray, rows: int, most_cells: int = MOST_CELLS, seed: int = 7):
        self.dim, self.sample, self.sample_ids = sample.shape[1], sample, ids
        self.cells = kmeans(sample, int(np.clip(np.sqrt(rows), 1, most_cells)), 8, seed)
        self.sample_cells = distances(sample, self.cells).argmin(1)
        rest = (sample - self.cells[self.sample_cells])[:BOOK_ROWS]
        self.bounds = np.linspace(0, self.dim, min(PARTS, self.dim) + 1).astype(int)
        self.books = [kmeans(rest[:, a:b], CODES, 6, seed + i) for i, (a, b) in enumerate(zip(self.bounds, self.bounds[1:]))]

    def parts(self):
        return zip(self.books, self.bounds, self.bounds[1:])

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cell, code and offset of each vector; the offset is what the estimate adds whatever the query."""
        cells, codes, offsets = [np.zeros(0, int)], [np.zeros((0, len(self.books)), np.uint8)], [np.zeros(0)]
        for i in range(0, len(x), 4096):
            y = x[i : i + 4096]
            cell = distances(y, self.cells).argmin(1)
            rest = y - self.cells[cell]
            code = np.stack([distances(rest[:, a:b], book).argmin(1) for book, a, b in self.parts()], 1)
            near = np.concatenate([book[code[:, k]] for k, book in enumerate(self.books)], 1)
            cells.append(cell)
            codes.append(code.astype(np.uint8))
            offsets.append((2 * self.cells[cell] * near + near**2 - (rest - near) ** 2).sum(1))
        return np.concatenate(cells), np.concatenate(codes), np.concatenate(offsets)

    def estimates(self, q: np.ndarray, far: np.ndarray, codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Asymmetric squared distances of queries (rows) to codes (columns), less the squared errors of the codes.

        ``far``: squared distances of the queries to the centroids of the codes.
        """
        total = np.zeros((len(q), len(codes)))
        for k, (book, a, b) in enumerate(self.parts()):
            total += (q[:, a:b] @ book.T)[:, codes[:, k]]
        return far + offsets - 2 * total

    def probes(self, q: np.ndarray, counts: np.ndarray, probes: int, least: int) -> list[np.ndarray]:
        """Cells to visit: the nearest ``probes`` that hold vectors, and on until ``least`` vectors are met."""
        d = distances(q, self.cells)
        d[:, counts == 0] = np.inf
        order = np.argsort(d, axis=1, kind="stable")
        some = int((counts > 0).sum())
        out = []
        for row in order:
            enough = int(np.searchsorted(np.cumsum(counts[row]), least)) + 1
            out.append(row[: min(some, max(probes, enough))])
        return out

    def reach(self, q: np.ndarray, ids: np.ndarray, visit: list[np.ndarray], k: int) -> np.ndarray:
        """A distance within which the visited cells hold ``k`` rows for sure: that of the 2k-th nearest of their sample rows."""
        out, k = np.full(len(q), np.inf), 2 * k
        for i in range(0, len(q), 256):
            d = distances(q[i : i + 256], self.sample)
            d[ids[i : i + 256, None] == self.sample_ids[None]] = np.inf
            seen = np.zeros((len(d), len(self.cells)), bool)
            for row, cells in zip(seen, visit[i : i + 256]):
                row[cells] = True
            d[~seen[:, self.sample_cells]] = np.inf
            if d.shape[1] > k:
                best = np.argpartition(d, k - 1, axis=1)[:, :k]
                exact = np.sqrt(((self.sample[best] - q[i : i + 256, None]) ** 2).sum(2)).max(1) * (1 + 1e-12)
                out[i : i + 256] = np.where(np.isinf(np.take_along_axis(d, best, axis=1)).any(1), np.inf, exact)
        return out

    def tune(self, k: int, recall: float, queries: int = 256) -> tuple[int, float]:
        """Probes that meet the share ``recall`` of the ``k`` nearest sample vectors of some sample queries, and the
        margin over the k-th best estimate that leaves in the share KEPT of them.

        Neighbours among all vectors are nearer than those in a sample, so the probes err on the safe side.
        """
        own = np.linspace(0, len(self.sample) - 1, min(queries, len(self.sample))).astype(int)
        q, _, (_, codes, offsets) = self.sample[own], None, self.assign(self.sample)
        near = np.argsort(distances(q, self.sample), axis=1)[:, 1 : k + 1]
        if not near.size:
            return len(self.cells), 0.0
        far = distances(q, self.cells)
        order = np.argsort(np.argsort(far, axis=1), axis=1)
        ranks = np.take_along_axis(order, self.sample_cells[near], axis=1).ravel()
        excess = []
        for i in range(0, len(q), 32):
            guess = self.estimates(q[i : i + 32], far[i : i + 32][:, self.sample_cells], codes, offsets)
            guess[np.arange(len(guess)), own[i : i + 32]] = np.inf
            best = np.partition(guess, near.shape[1] - 1, axis=1)[:, near.shape[1] - 1]
            excess.append(np.take_along_axis(guess, near[i : i + 32], axis=1) - best[:, None])
        margin = float(np.quantile(np.concatenate(excess), KEPT, method="higher"))
        return int(np.quantile(ranks, recall, method="higher")) + 1, max(0.0, margin)


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) of the vectors that take part; floats stay floats."""
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    kind = "array<float>" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "array<double>"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("v")).filter("vec_id is not null and v is not null").filter(fine)
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.filter(F.size("v") == (sizes[0]["n"] if sizes else 0))


def _matrix(column, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.float64)


def best_of_block(index: Index, cell: int, mine: pa.Table, queries: pa.Table, margin: float, k: int) -> pa.Table:
    """query_id, vec_id and score of the ``k`` nearest vectors of a block to each query."""
    mine = mine.sort_by("vec_id")
    ids, x = mine["vec_id"].to_numpy(), _matrix(mine["v"], index.dim)
    # equal distances go to smaller ids: of equal vectors, one may be the query's own and k can be wanted
    same = np.unique(x, axis=0, return_inverse=True)[1].ravel()
    by = np.argsort(same, kind="stable")
    nth = np.arange(len(by)) - np.searchsorted(same[by], same[by])
    keep = np.sort(by[nth <= k])
    codes = np.frombuffer(mine["code"].combine_chunks().buffers()[2], np.uint8)[: len(ids) * len(index.books)].reshape(len(ids), -1)[keep]
    offsets, ids, x = mine["offset"].to_numpy()[keep], ids[keep], x[keep]
    asked, bounds, points = queries["query_id"].to_numpy(), queries["reach"].to_numpy(), _matrix(queries["q"], index.dim)
    got, step = [], max(1, HELD // len(ids))
    for lo in range(0, len(points), step):
        q, own, reach = points[lo : lo + step], asked[lo : lo + step], bounds[lo : lo + step]
        guess = index.estimates(q, ((q - index.cells[cell]) ** 2).sum(1)[:, None], codes, offsets)
        guess[ids[None] == own[:, None]] = np.inf
        limit = reach**2
        if len(ids) > k:
            limit = np.minimum(limit, np.partition(guess, k - 1, axis=1)[:, k - 1])
        row, col = np.nonzero(guess <= (limit + margin)[:, None])
        fine = np.isfinite(guess[row, col])
        row, col = row[fine], col[fine]
        exact = np.zeros(len(row))
        for i in range(0, len(row), max(1, HELD // index.dim)):
            part = slice(i, i + max(1, HELD // index.dim))
            exact[part] = np.sqrt(((x[col[part]] - q[row[part]]) ** 2).sum(1))
        fine = exact <= reach[row]
        row, col, exact = row[fine], col[fine], exact[fine]
        order = np.lexsort((col, exact, row))
        row, col, exact = row[order], col[order], exact[order]
        top = np.arange(len(row)) - np.searchsorted(row, row) < k
        got.append(pa.table({"query_id": own[row[top]], "vec_id": ids[col[top]], "score": exact[top]}))
    return pa.concat_tables(got)


def search(spark: SparkSession, vectors: DataFrame, k: int = 10, every: int = 100, recall: float = RECALL, sample_rows: int = SAMPLE_ROWS, most_cells: int = MOST_CELLS) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` nearest rows of each query (vec_id divisible by ``every``)."""
    bounded_batches(spark)
    rows = usable(vectors)
    n = rows.count()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).toArrow()
    dim = len(sample["v"][0])
    index = Index(_matrix(sample["v"], dim), sample["vec_id"].to_numpy(), n, most_cells)
    probes, margin = index.tune(k, recall)
    shared = spark.sparkContext.broadcast(index)
    kind = rows.schema["v"].dataType.simpleString()

    @lean
    def build(batches):
        for b in batches:
            cell, codes, offsets = shared.value.assign(_matrix(b.column(1), dim))
            packed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(codes.shape[1]), len(codes), [None, pa.py_buffer(np.ascontiguousarray(codes))]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(cell), b.column(0), packed, pa.array(offsets), b.column(1)], ["cell", "vec_id", "code", "offset", "v"])

    indexed = stored(spark, rows.mapInArrow(build, f"cell long, vec_id long, code binary, offset double, v {kind}"), "index")
    found = {r["cell"]: r["n"] for r in indexed.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    counts = np.array([found.get(c, 0) for c in range(len(index.cells))])
    blocks = -(-counts // int(max(1, min(max(LEAST_BLOCK, n // 512), BLOCK_BYTES // (8 * dim)))))

    @lean
    def plan(batches):
        for b in batches:
            q = _matrix(b.column(1), dim)
            visit = shared.value.probes(q, counts, probes, 4 * k)
            reach = pa.array(shared.value.reach(q, b.column(0).to_numpy(), visit, k))
            sizes = [len(v) for v in visit]
            at = pa.array(np.repeat(np.arange(len(sizes)), sizes))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(visit).astype(np.int64) if visit else np.zeros(0, np.int64)), b.column(0).take(at), b.column(1).take(at), reach.take(at)], ["cell", "query_id", "q", "reach"])

    asked = stored(spark, rows.filter(F.col("vec_id") % every == 0).mapInArrow(plan, f"cell long, query_id long, q {kind}, reach double"), "queries")
    asking = {r["cell"]: r["n"] for r in asked.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    slices = np.array([-(-asking.get(c, 0) // max(1, QUERY_BYTES // (8 * dim))) for c in range(len(index.cells))])

    # bounded by MOST_CELLS: how many blocks and slices each cell has
    salts = F.broadcast(spark.createDataFrame([(c, int(blocks[c]), int(slices[c])) for c in range(len(blocks)) if slices[c]], "cell long, blocks int, slices int"))
    salt = lambda c, m: F.pmod(F.xxhash64(c), F.col(m)).cast("int")
    left = indexed.join(salts, "cell").select("cell", salt("vec_id", "blocks").alias("block"), F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), "vec_id", "code", "offset", "v")
    right = asked.join(salts, "cell").select("cell", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), salt("query_id", "slices").alias("slice"), "query_id", "q", "reach")

    def meet(key: tuple, mine: pa.Table, queries: pa.Table) -> pa.Table:
        if not mine.num_rows or not queries.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        out = best_of_block(shared.value, key[0].as_py(), mine, queries, margin, k)
        if mine.num_rows > 50_000:
            trim()
        return out

    keys = ["cell", "block", "slice"]
    met = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return met.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

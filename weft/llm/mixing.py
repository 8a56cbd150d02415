"""Mixing sources to target weights by Pfair scheduling (operator 1).

The rows of each source form blocks of ``block_rows`` in a fixed pseudo-random order. The ideal mix hands
every slot out to all sources that still have blocks, in proportion to their target weights w. With W the
sum of these and F the blocks of the sources used up, the ideal start of block k of a source is
F + W k / w; it is released at the floor of that and due at the ceiling of its ideal end. All of this is
kept in exact rationals of the numbers given. Earliest deadline first over released blocks places one
block in each slot and meets every deadline, so every source stays within less than one block of its
ideal share at every prefix, also after other sources are used up; no row is dropped or repeated.

The driver schedules blocks, not rows: ``block_rows`` is 16, or as many as make about MOST_BLOCKS blocks
of all rows, so what it holds and broadcasts (8 bytes a block) is bounded. Blocks and weights count rows,
not bytes or tokens. More than MOST_SOURCES sources are refused.

Rows are numbered within a source without one task for a hot source: rows fall in hash buckets, each
numbered on its own, and bucket counts are summed up to offsets.

Cases: a null source is a source of its own; an empty table gives an empty result; repeated rows are
rows each, in an arbitrary but fixed order; a source without target weight takes part with weight
``default``; one of weight 0 follows when all others are used up; a weight that is negative, infinite or not a number is
refused, and finite ones may be as far apart as doubles are; rows without id come first in their bucket; other columns pass through, whatever their names.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_right
from fractions import Fraction

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from weft.llm.common import OWN, stored

BLOCK_ROWS = 16
MOST_BLOCKS = 1 << 20
MOST_SOURCES = 1 << 20
CHUNK_BLOCKS = 4096
BUCKET_ROWS = 100_000
LEAST_BUCKETS = 512


def integer_weights(targets: dict) -> dict:
    """Integers in exactly the proportions of ``targets``."""
    if wrong := [s for s, x in targets.items() if not (math.isfinite(x) and x >= 0)]:
        raise ValueError(f"weights must be finite and not negative: {wrong[:5]}")
    exact = {s: Fraction(x) for s, x in targets.items()}
    scale = math.lcm(*(x.denominator for x in exact.values()))
    whole = {s: int(x * scale) for s, x in exact.items()}
    shared = math.gcd(*whole.values()) or 1
    return {s: x // shared for s, x in whole.items()}


def windows(blocks: dict, weights: dict) -> dict:
    """(releases, deadlines) of the blocks of each source, all weights positive integers.

    k / w is the ideal progress at which block k starts; F and W change where a source is used up.
    """
    ends: dict = {}
    for s, n in blocks.items():
        gone = ends.setdefault(Fraction(n, weights[s]), [0, 0])
        gone[0] += n
        gone[1] += weights[s]
    turns = sorted(ends)
    spent, active = [0], [sum(weights[s] for s in blocks)]
    for v in turns:
        spent.append(spent[-1] + ends[v][0])
        active.append(active[-1] - ends[v][1])
    rough = np.array([float(v) for v in turns])
    out = {}
    for s, n in blocks.items():
        w = weights[s]
        at = np.arange(n + 1) * (1 / w)  # of integers of any size
        part = np.searchsorted(rough, at, side="right")
        # where doubles can't tell on which side of a turn a block starts, the rationals do
        close = np.isclose(rough[np.minimum(part, len(rough) - 1)], at, 1e-9) | np.isclose(rough[np.maximum(part - 1, 0)], at, 1e-9)
        for k in np.flatnonzero(close):
            part[k] = bisect_right(turns, Fraction(int(k), w))
        place = [(spent[j], active[j] * k) for k, j in enumerate(part.tolist())]
        out[s] = [f + x // w for f, x in place[:-1]], [f - (-x // w) for f, x in place[1:]]
    return out


def deadline_first(blocks: dict, weights: dict) -> dict:
    """Slots of each source's blocks: of the released ones the earliest deadline, ties to the later release, then to the order of sources."""
    plan = list(windows(blocks, weights).items())
    slots: list[list[int]] = [[] for _ in plan]
    waiting = [(releases[0], i) for i, (_, (releases, _)) in enumerate(plan)]
    heapq.heapify(waiting)
    due_first: list[tuple[int, int, int]] = []
    for slot in range(sum(blocks.values())):
        while waiting and waiting[0][0] <= slot:
            release, i = heapq.heappop(waiting)
            heapq.heappush(due_first, (plan[i][1][1][len(slots[i])], -release, i))
        i = heapq.heappop(due_first)[2]
        slots[i].append(slot)
        if len(slots[i]) < len(plan[i][1][0]):
            heapq.heappush(waiting, (plan[i][1][0][len(slots[i])], i))
    return {s: mine for (s, _), mine in zip(plan, slots)}


def placed_blocks(blocks: dict, weights: dict) -> dict:
    """The slot of each block of each source; sources of weight 0 come after all others, with equal weights."""
    out, start = {s: [] for s in blocks}, 0
    for some in ({s: weights[s] for s, n in blocks.items() if n and weights[s]}, {s: 1 for s, n in blocks.items() if n and not weights[s]}):
        if some:
            slots = deadline_first({s: blocks[s] for s in some}, some)
            out |= {s: [start + x for x in mine] for s, mine in slots.items()}
            start += sum(blocks[s] for s in some)
    return out


def scheduled(spark: SparkSession, docs: DataFrame, weights: dict | None = None, block_rows: int | None = None, default: float = 1.0, temperature: float = 0.5) -> DataFrame:
    """``docs`` with OWN+block, OWN+slot and OWN+position.

    ``weights`` are targets by source; without them a source of n rows has the target n ** temperature.
    """
    hashed = docs.withColumn(OWN + "h", F.xxhash64(F.lit(17), F.col("doc_id")))
    per_source = {r[0]: r[1] for r in docs.groupBy("source").count().limit(MOST_SOURCES + 1).collect()}
    if len(per_source) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources: group them first")
    rows = sum(per_source.values())
    block_rows = block_rows or max(BLOCK_ROWS, -(-rows // MOST_BLOCKS))
    names = sorted(per_source, key=lambda s: (s is not None, s))
    targets = {s: (weights.get(s, default) if weights else float(per_source[s]) ** temperature) for s in names}
    slots = placed_blocks({s: -(-per_source[s] // block_rows) for s in names}, integer_weights(targets)) if names else {}

    n_buckets = max(LEAST_BUCKETS, -(-rows // BUCKET_ROWS))
    # a source's name that is never null, so the rows lie for the join as they do for the numbering and move once
    name = F.when(F.col("source").isNull(), "-").otherwise(F.concat(F.lit("+"), F.col("source").cast("string"))).alias(OWN + "name")
    bucket = F.pmod(F.shiftright(OWN + "h", 8), F.lit(n_buckets)).alias(OWN + "bucket")
    hashed = hashed.select("*", name, bucket)
    counts = stored(spark, hashed.groupBy(OWN + "name", OWN + "bucket").agg(F.count("*").alias("n")), "buckets")
    before = F.sum("n").over(Window.partitionBy(OWN + "name").orderBy(OWN + "bucket").rowsBetween(Window.unboundedPreceding, -1))
    offsets = stored(spark, counts.select(OWN + "name", OWN + "bucket", F.coalesce(before, F.lit(0)).alias(OWN + "before")), "offsets")
    number = F.row_number().over(Window.partitionBy(OWN + "name", OWN + "bucket").orderBy(OWN + "h", "doc_id")) - 1
    ranked = hashed.withColumn(OWN + "number", number.cast("long"))
    ranked = ranked.join(offsets.hint("merge"), [OWN + "name", OWN + "bucket"])
    index = F.col(OWN + "before") + F.col(OWN + "number")
    ranked = ranked.withColumn(OWN + "index", index).withColumn(OWN + "block", F.floor(index / block_rows).cast("long"))

    kind = T.StructType([T.StructField(OWN + "ps", docs.schema["source"].dataType), T.StructField(OWN + "chunk", T.LongType()), T.StructField(OWN + "slots", T.ArrayType(T.LongType()))])
    plan = [(s, i // CHUNK_BLOCKS, mine[i : i + CHUNK_BLOCKS]) for s, mine in slots.items() for i in range(0, len(mine), CHUNK_BLOCKS)]
    # bounded by MOST_BLOCKS and MOST_SOURCES
    steps = F.broadcast(spark.createDataFrame(plan, kind))
    block, own = F.col(OWN + "block"), lambda c: F.col(OWN + c)
    placed = ranked.join(steps, F.col("source").eqNullSafe(own("ps")) & (F.floor(block / CHUNK_BLOCKS) == own("chunk")))
    slot = F.get(own("slots"), (block % CHUNK_BLOCKS).cast("int"))
    placed = placed.withColumn(OWN + "slot", slot)
    position = F.col(OWN + "slot") * block_rows + F.col(OWN + "index") % block_rows
    return placed.select(*docs.columns, OWN + "block", OWN + "slot", position.alias(OWN + "position"))


def mixed(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """``docs`` in mixed order: files and rows follow the schedule when written."""
    return scheduled(spark, docs, **options).sort(OWN + "position").select(*docs.columns)

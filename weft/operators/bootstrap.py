"""Bootstrap intervals by Poisson weights: each item has a weight in each round that only depends on both.

Drawing n of n items with replacement gives an item nearly a Poisson(1) number of copies, independent of the others for
many items. So a round's weights need no sequence of draws: a hash of (order, round) is the uniform number that
becomes the weight, any task can make it, and a round is two sums. Rounds of all names are summed in one pass
over the items and added up by partial aggregates; no name is a group of its items, however many they are.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

ROUNDS = 1000
#: A weight is how many of these a 32-bit number reaches: the Poisson(1) distribution function times 2**32.
STEPS = [math.floor(math.exp(-1) * sum(1 / math.factorial(j) for j in range(k + 1)) * 2**32) for k in range(13)]
#: Odd multipliers of the hash.
MULTIPLIERS = (0x45D9F3B, 0x2C1B3C6D)
#: Items whose weights are made at once (a round each: 8 MB).
AT_ONCE = 1024


def hashed(order: np.ndarray, rounds: np.ndarray) -> np.ndarray:
    """32-bit hashes of every order (0 to 2**32 - 1) with every round."""
    mask = np.uint64(0xFFFFFFFF)
    x = (order[:, None] ^ (rounds[None] * np.uint64(0x9E3779B1) & mask)) & mask
    for m in MULTIPLIERS:
        x = ((x ^ (x >> np.uint64(16))) * np.uint64(m)) & mask
    return x ^ (x >> np.uint64(16))


def weights(order: np.ndarray, rounds: int, seed: int) -> np.ndarray:
    """The weight of each item in each round."""
    h = hashed(order.astype(np.uint64), np.arange(seed * rounds, (seed + 1) * rounds, dtype=np.uint64))
    return np.searchsorted(np.array(STEPS, np.uint64), h.ravel(), side="right").reshape(h.shape)


def sums(items: DataFrame, value: str, rounds: int, seed: int) -> DataFrame:
    """(name, round, w, wv): the sum of weights and of weighted values; round -1 has those of the items as they are."""
    kind = items.schema["ord"].dataType
    if isinstance(kind, (ByteType, ShortType, IntegerType, LongType)):
        order = F.pmod(F.col("ord").cast("long"), F.lit(1 << 32))
    else:
        order = F.crc32(F.to_json(F.struct("ord")).cast("binary"))

    def run(batches):
        total: dict[str | None, np.ndarray] = {}
        for b in batches:
            for a in range(0, b.num_rows, AT_ONCE):
                part = b.slice(a, AT_ONCE)
                names, order, x = part.column(0).to_pylist(), part.column(1).to_numpy(), part.column(2).to_numpy()
                w = np.concatenate([np.ones((len(x), 1)), weights(order, rounds, seed)], 1)
                for name in dict.fromkeys(names):
                    mine = np.array([n == name for n in names])
                    held = total.setdefault(name, np.zeros((2, rounds + 1)))
                    held[0] += w[mine].sum(0)
                    held[1] += x[mine] @ w[mine]
        for name, held in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([name] * (rounds + 1), pa.string()), pa.array(range(-1, rounds), pa.int32()), pa.array(held[0]), pa.array(held[1])], ["name", "round", "w", "wv"])

    rows = items.select("name", F.coalesce(order, F.lit(0)).alias("o"), F.col(value).cast("double").alias("v")).filter("v is not null")
    return rows.mapInArrow(run, "name string, round int, w double, wv double").groupBy("name", "round").agg(F.sum("w").alias("w"), F.sum("wv").alias("wv"))


def intervals(items: DataFrame, value: str = "value", rounds: int = ROUNDS, seed: int = 0) -> DataFrame:
    """(name, n, mean, lo, hi) for each name of items (name, ord, value): order statistics at 2.5 and 97.5 per cent of its rounds' means.

    ``ord`` tells the items of a name apart: equal ones share their weights. Null values are no items, a name
    without any has n 0 and nulls, and a round in which every weight is 0 has no mean.
    """
    r = sums(items, value, rounds, seed)
    means = F.array_sort(F.collect_list(F.when((F.col("round") >= 0) & (F.col("w") > 0), F.col("wv") / F.col("w"))))  # as many as rounds
    own = lambda c: F.max(F.when(F.col("round") < 0, F.col(c)))
    at = lambda share: F.get("means", F.floor(F.lit(share) * F.size("means")).cast("int"))
    found = r.groupBy("name").agg(own("w").alias("n"), own("wv").alias("total"), means.alias("means"))
    found = found.select("name", F.col("n").cast("long").alias("n"), (F.col("total") / F.col("n")).alias("mean"), at(0.025).alias("lo"), at(0.975).alias("hi"))
    none = [F.lit(0).cast("long").alias("n"), *(F.lit(None).cast("double").alias(c) for c in ("mean", "lo", "hi"))]
    empty = items.groupBy("name").agg(F.count(value).alias("k")).filter("k = 0").select("name", *none)
    return found.union(empty)

"""The join behind exact set similarity: rows that share a token of their prefixes at places that leave enough overlap.

Two sets of n and m tokens with Jaccard similarity s have s / (1 + s) * (n + m) tokens in common, so a shared token that
is their first one, at places i and j of an order that all sets follow, leaves n - i and m - j of them at least. With
tokens ordered rare first, sets whose rare tokens are their own reach their common ones too late: most families of a
template meet no partner, if the sizes are known before they meet. So a token that few rows have is the key by itself,
and a frequent one is a key together with the bands of both sizes, BANDS_OF of them to each ratio of s; each row goes only
to those bands of the token's rows that its own place allows, as the smaller and as the larger side. Pairs that meet are
those of which both sides allow the other: bounded by FEW times the rows for rare tokens, and for frequent
ones by pairs within a band's width of the similarity.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.storage import stored

#: A token of so many prefixes at most is a key by itself; bands of sizes to each ratio of the similarity.
FEW, BANDS_OF = 32, 10


def pairs(spark: SparkSession, prefix: DataFrame, similar: float) -> DataFrame:
    """Distinct (a, b), a < b, that may have the similarity, from rows (v, n, i, t): a token t at place i of n, and how
    many prefixes have it (held). With a column c only pairs of different c are wanted.

    With prev and next, the row's tokens beside t (or what stands for next), prefixes are one token longer, and pairs are
    left out that share one token of them only, though more are needed. Two rows that share prev too have met there
    already, and sharing next too counts as another one, so a run of shared tokens makes one row of each pair.
    """
    across, twice = "c" in prefix.columns, "prev" in prefix.columns
    # of the first two shared tokens, the second leaves one less
    slack = 1.0 if twice else 0.0
    share, width = similar / (1 + similar), -math.log(similar) / BANDS_OF
    prefix = stored(spark, prefix, "prefix")

    def fits(x: str, y: str) -> Column:
        at = lambda side, c: F.col(f"{side}.{c}")
        out = F.least(at(x, "n") - at(x, "i"), at(y, "n") - at(y, "i")) >= F.lit(share) * (at(x, "n") + at(y, "n")) - (slack + 1e-9)
        out = out & (F.least(at(x, "n"), at(y, "n")) >= F.lit(similar) * F.greatest(at(x, "n"), at(y, "n")) - 1e-9)
        out = out & ~F.coalesce(at(x, "prev") == at(y, "prev"), F.lit(False)) if twice else out
        return out & (at(x, "c") != at(y, "c")) if across else out

    shared = 1 + F.coalesce(F.col("x.next") == F.col("y.next"), F.lit(False)).cast("int") if twice else F.lit(1)
    single = F.lit(share) * (F.col("x.n") + F.col("y.n")) <= 1 + 1e-9
    seen = [F.when(single, 2).otherwise(shared).alias("seen")] if twice else []
    ordered = lambda met: met.select(F.least("x.v", "y.v").alias("a"), F.greatest("x.v", "y.v").alias("b"), *seen)
    few = prefix.filter(F.col("held") <= FEW)
    x, y = few.alias("x"), few.alias("y")
    rare = ordered(x.join(y, (F.col("x.t") == F.col("y.t")) & (F.col("x.v") < F.col("y.v")) & fits("x", "y")))

    band = lambda size: F.floor(F.log(size) / F.lit(width))
    n = F.col("n").cast("double")
    own = band(n)
    # the largest partner that a place allows: beyond it the rest of the set is too short
    most = F.least((n - F.col("i") + slack) / F.lit(share) - n + 1e-6, n / F.lit(similar) + 1e-6)
    many = prefix.filter(F.col("held") > FEW).withColumn("own", own)
    # the bands that a token has at all: as many as there are sizes between the least and the most, in their logarithm
    there = many.groupBy("t").agg(F.collect_set("own").alias("there"))
    many = many.join(there.hint("merge"), "t").drop("held")
    least = F.greatest(n * F.lit(similar) - 1e-6, F.lit(1.0))
    # partners of the own size or more, and partners of it or less
    larger = F.when(most >= n - 1e-3, F.filter("there", lambda z: (z >= F.col("own")) & (z <= band(F.greatest(most, n)))))
    smaller = F.when(most >= least - 1e-6, F.filter("there", lambda z: (z >= band(least)) & (z <= F.least(band(F.greatest(most, least)), F.col("own")))))
    x = many.withColumn("z", F.explode(larger)).drop("there").alias("x")
    y = many.withColumn("z", F.explode(smaller)).drop("there").alias("y")
    size = (F.col("x.n") < F.col("y.n")) | ((F.col("x.n") == F.col("y.n")) & (F.col("x.v") < F.col("y.v")))
    met = (F.col("x.t") == F.col("y.t")) & (F.col("x.z") == F.col("y.own")) & (F.col("x.own") == F.col("y.z")) & size & fits("x", "y")
    met = rare.union(ordered(x.join(y, met)))
    return met.groupBy("a", "b").agg(F.sum("seen").alias("seen")).filter("seen > 1").select("a", "b") if twice else met.distinct()


def counted(prefix: DataFrame) -> DataFrame:
    """``prefix`` with held, without tokens of one row only (or, with a column c, of one c only)."""
    lone = [F.min("c").alias("lo"), F.max("c").alias("hi")] if "c" in prefix.columns else []
    held = prefix.groupBy("t").agg(F.count("*").alias("held"), *lone).filter("lo <> hi" if lone else "held > 1").drop("lo", "hi")
    return prefix.join(held.hint("merge"), "t")

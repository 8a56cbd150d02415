"""Scores of held-out items: accuracy, perplexity, chrF, confidence intervals, coverage, deltas, reviews.

Cases: null verdicts, values, losses and replies are left out of means and counts; without rows means are null,
counts 0 and chrF 0; ties of scores go to the lowest index; ratings that aren't numbers are no ratings.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.storage import bounded_batches, stored

#: Characters of pairs whose n-grams are counted at once (or one pair).
CHARS = 1 << 18


def accuracy(items: DataFrame, correct: str = "correct") -> DataFrame:
    return items.agg(F.avg(F.col(correct).cast("int")).alias("accuracy"), F.count(correct).alias("n"))


def best_choice(scores: DataFrame) -> DataFrame:
    """(item, idx, score) -> the choice with the largest score, the lowest index of equals."""
    return scores.groupBy("item").agg(F.max_by("idx", F.struct("score", (-F.col("idx")).alias("m"))).alias("choice"))


def perplexity(losses: DataFrame) -> DataFrame:
    """exp of the mean loss over predicted tokens, from (loss, n_tokens) of blocks; a block predicts n - 1."""
    n = F.col("n_tokens") - 1
    return losses.filter(n > 0).agg(F.exp(F.sum(F.col("loss") * n) / F.sum(n)).alias("perplexity"), F.sum(n).cast("long").alias("n"))


def _gram_counts(order: int):
    """A function over batches (id, hypothesis, reference) of texts without blanks that sums up, for each size of n-gram,
    those of the hypotheses, of the references, and the matches within a row (none without id)."""

    def counted(ids: pa.Array, sides: list[list[str]], total: np.ndarray) -> None:
        rows, own = len(ids), np.arange(len(ids))
        owner = np.concatenate([own, np.where(ids.is_valid().to_numpy(zero_copy_only=False), own, own + rows)])
        sizes = np.array([len(x) for side in sides for x in side], np.int64)
        code = np.frombuffer("".join(x for side in sides for x in side).encode("utf-32-le"), np.uint32).astype(np.int64)
        end, at = np.repeat(np.cumsum(sizes), sizes), np.arange(len(code))
        of_reference = int(sizes[:rows].sum())
        rank = np.repeat(owner, sizes)  # of the n-gram that begins at each place, told apart by row
        for n in range(1, order + 1):
            inside = at + n <= end[at]
            at, rank = at[inside], rank[inside]
            if not len(at):
                break
            known, rank = np.unique((rank << 21) | code[at + n - 1], return_inverse=True)
            cut = int(np.searchsorted(at, of_reference))
            h, r = np.bincount(rank[:cut], minlength=len(known)), np.bincount(rank[cut:], minlength=len(known))
            total[n - 1] += h.sum(), r.sum(), np.minimum(h, r).sum()

    def run(batches):
        total = np.zeros((order, 3), np.int64)
        for b in batches:
            h, r = (b.column(k).to_pylist() for k in (1, 2))
            cuts, size = [0], 0
            for i in range(len(h)):
                if size and size + len(h[i]) + len(r[i]) > CHARS:
                    cuts.append(i)
                    size = 0
                size += len(h[i]) + len(r[i])
            for x, y in zip(cuts, [*cuts[1:], len(h)]):
                counted(b.column(0)[x:y], [h[x:y], r[x:y]], total)
        yield pa.RecordBatch.from_arrays([pa.array(range(1, order + 1), pa.int32()), *(pa.array(total[:, k]) for k in range(3))], ["n", "h", "r", "m"])

    return run


def chrf(pairs: DataFrame, order: int = 6, beta: float = 2.0) -> DataFrame:
    """Corpus chrF (0..100) of (id, hypothesis, reference): character n-grams without blanks, averaged over orders
    that occur on both sides; counts are clipped per pair.

    A row's n-grams are counted where it is, and only sums leave a task. Rows that repeat an id are one pair: theirs are
    met by id and n-gram. Rows without id match nothing.
    """
    spark = pairs.sparkSession
    bounded_batches(spark)
    plain = lambda c: F.regexp_replace(F.coalesce(F.col(c), F.lit("")), "(?U)\\s+", "").alias(c)
    rows = stored(spark, pairs.select("id", plain("hypothesis"), plain("reference")), "pairs")
    again = stored(spark, rows.filter("id is not null").groupBy("id").count().filter("count > 1").select("id"), "again")
    lone = rows.join(again, "id", "left_anti").select("id", "hypothesis", "reference").mapInArrow(_gram_counts(order), "n int, h long, r long, m long")

    def grams(side: str) -> DataFrame:
        n = F.explode(F.sequence(F.lit(1), F.lit(order))).alias("n")
        long = rows.join(again, "id", "left_semi").select("id", F.col(side).alias("t"), n).filter(F.length("t") >= F.col("n"))
        grams_ = F.transform(F.sequence(F.lit(1), F.length("t") - F.col("n") + 1), lambda i: F.substring("t", i, F.col("n")))
        return long.select("id", "n", F.explode(grams_).alias("g")).groupBy("id", "n", "g").agg(F.count("*").alias(side))

    met = grams("hypothesis").join(grams("reference"), ["id", "n", "g"], "full")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    shared = met.select("n", zero("hypothesis").alias("h"), zero("reference").alias("r"), F.least(zero("hypothesis"), zero("reference")).alias("m"))
    by_order = lone.union(shared).groupBy("n").agg(*(F.sum(c).alias(c) for c in ("h", "r", "m")))
    both = by_order.filter("h > 0 and r > 0").agg(F.avg(F.col("m") / F.col("h")).alias("p"), F.avg(F.col("m") / F.col("r")).alias("q"))
    f = (1 + beta**2) * F.col("p") * F.col("q") / (beta**2 * F.col("p") + F.col("q"))
    return both.select(F.coalesce(F.when(F.col("p") + F.col("q") > 0, 100 * f), F.lit(0.0)).alias("chrf"))


def delta(scores: DataFrame) -> DataFrame:
    """(benchmark, bundle, value, lower_is_better) -> base, adapted and the signed gain; null if one is missing."""
    pick = lambda b: F.max(F.when(F.col("bundle") == b, F.col("value"))).alias(b)
    rows = scores.groupBy("benchmark", "lower_is_better").agg(pick("base"), pick("adapted"))
    gain = F.when(F.col("lower_is_better"), F.col("base") - F.col("adapted")).otherwise(F.col("adapted") - F.col("base"))
    return rows.withColumn("delta", gain)


def coverage(languages: DataFrame, configs: DataFrame) -> DataFrame:
    """(language, benchmark, code) against (benchmark, code, gated): available and why not."""
    known = configs.select("benchmark", "code", "gated", F.lit(True).alias("found"))
    met = languages.join(known, ["benchmark", "code"], "left")
    reason = F.when(F.col("code").isNull(), "no code").when(F.col("found").isNull(), "not covered").when(F.col("gated"), "gated").otherwise("covered")
    return met.select("language", "benchmark", "code", (reason == "covered").alias("available"), reason.alias("reason"))


def review_summary(reviews: DataFrame) -> DataFrame:
    done = F.col("status") == "reviewed"
    number = lambda c: F.col(c).try_cast("double")
    mean = lambda c: F.round(F.avg(F.when(done, number(c))), 3).alias(f"mean_{c}")
    return reviews.agg(F.count("*").alias("total"), F.count_if(done).alias("reviewed"), F.count_if(F.col("status") == "pending").alias("pending"), mean("fluency"), mean("correctness"))


def judge(replies: DataFrame) -> DataFrame:
    """The first digit 1-5 of each reply, averaged; replies without one are left out."""
    rating = F.nullif(F.regexp_extract("reply", "[1-5]", 0), F.lit("")).cast("int")
    return replies.select(rating.alias("r")).agg(F.avg("r").alias("mean_rating"), F.count("r").alias("n"), F.avg((F.col("r") > 3).cast("int")).alias("share_good"))


def parse_pairs(replies: DataFrame) -> DataFrame:
    """Pairs of a teacher's reply: the JSON array between the first [ and the last ], entries with both texts."""
    body = F.regexp_extract("reply", "(?s)\\[.*\\]", 0)
    rows = replies.select("id", F.posexplode(F.from_json(body, "array<struct<instruction string, response string>>")).alias("i", "x"))
    return rows.select("id", "i", "x.instruction", "x.response").filter("coalesce(instruction, '') <> '' and coalesce(response, '') <> ''")


def aligned(source: DataFrame, target: DataFrame, limit: int) -> DataFrame:
    """(id, source, target): rows of two translations that share an id, the first ``limit`` in order of id."""
    met = source.select("id", F.col("text").alias("source")).join(target.select("id", F.col("text").alias("target")), "id")
    return met.orderBy("id").limit(limit)


def letter_items(rows: DataFrame, options: tuple[str, ...] = ("option_a", "option_b", "option_c", "option_d")) -> DataFrame:
    """Items with prompt, options and gold index from an answer letter; rows without a valid letter go."""
    letter = F.upper(F.trim(F.col("answer").cast("string")))
    gold = F.array_position(F.array(*(F.lit(chr(65 + i)) for i in range(len(options)))), letter) - 1
    items = rows.select("id", F.concat("question", F.lit("\nAnswer:")).alias("prompt"), F.array(*options).alias("options"), gold.cast("int").alias("gold"))
    return items.filter("gold >= 0")


def passage_items(rows: DataFrame) -> DataFrame:
    """Items with prompt, options and gold index from a passage, a question and an answer number from 1."""
    prompt = F.concat("passage", F.lit("\nQuestion: "), "question", F.lit("\nAnswer:"))
    return rows.select("id", prompt.alias("prompt"), F.array(*(f"answer{i}" for i in range(1, 5))).alias("options"), (F.col("number").cast("int") - 1).alias("gold"))


def verdicts(scores: DataFrame, items: DataFrame) -> DataFrame:
    """Whether the best choice of each item is its gold index."""
    return best_choice(scores).join(items.select(F.col("id").alias("item"), "gold"), "item").select("item", (F.col("choice") == F.col("gold")).alias("correct"))

"""Benchmarks as item sources, and what a model's answers to them are worth.

A scorer stands for a model: ``continuations(rows)`` adds logprob and n_tokens to rows with prompt and
continuation, ``replies(rows)`` adds reply to rows with prompt, ``next_words(rows)`` adds predicted to rows with
prompt, and ``losses(blocks)`` adds loss (mean over predicted tokens) and n_tokens to rows with tokens. Each takes
and gives DataFrames, so it runs where the rows are. A result is value, n, lo and hi (null where none is stated).

Cases: items with a null prompt, options or gold answer are left out; an option of no tokens never wins; without
items the value is null and n is 0; ties go to the first option; ids must differ.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.functions import text as X
from weft.operators import bootstrap, evaluation, tokens

SHOTS, JUDGED_TOKENS = 3, 8


@dataclass(frozen=True)
class Benchmark:
    name: str
    lower_is_better: bool = False
    #: Whether the base model is measured too; scores that another vocabulary changes aren't comparable.
    compare_to_base: bool = True
    gated: bool = False
    caveat: str = ""


BENCHMARKS = {
    b.name: b
    for b in (
        Benchmark("native_cloze", caveat="Tells how well the model fits the corpus, whose last sentences it is asked for; not how useful it is."),
        Benchmark("perplexity", lower_is_better=True, compare_to_base=False, caveat="By token, so models with different vocabularies can't be compared; only the adapted one is measured."),
        Benchmark("belebele", caveat="A strong base model may know the passages; the gain over it says more than the score."),
        Benchmark("global_mmlu", caveat="Asks for world knowledge, which adaptation to a language hardly changes."),
        Benchmark("flores", gated=True, caveat="Asks for translations, which such models are not made for."),
        Benchmark("judge", caveat="A judge that hardly knows the language rates confidence, not correctness."),
    )
}


def benchmark(name: str) -> Benchmark:
    if name not in BENCHMARKS:
        raise ValueError(f"unknown benchmark {name!r}; known: {', '.join(sorted(BENCHMARKS))}")
    return BENCHMARKS[name]


def result(verdicts: DataFrame, value: str = "value") -> DataFrame:
    """value (mean), n, lo and hi of rows (ord, value)."""
    return bootstrap.intervals(verdicts.select(F.lit("all").alias("name"), "ord", F.col(value).cast("double").alias("value"))).select(F.col("mean").alias("value"), "n", "lo", "hi")


def choices(scorer, items: DataFrame, limit: int | None = None) -> DataFrame:
    """(id, correct) of items (id, prompt, options, gold): the option with the best log-probability for each of its tokens."""
    items = items.filter("prompt is not null and options is not null and gold is not null")
    items = items.orderBy("id").limit(limit) if limit is not None else items
    asked = items.select("id", "prompt", F.posexplode("options").alias("idx", "option")).withColumn("continuation", F.concat(F.lit(" "), X.strip(F.coalesce("option", F.lit("")))))
    rated = scorer.continuations(asked.select("id", "idx", "prompt", "continuation"))
    score = F.when(F.col("n_tokens") > 0, F.col("logprob") / F.col("n_tokens")).otherwise(F.lit(float("-inf")))
    return evaluation.verdicts(rated.select(F.col("id").alias("item"), "idx", score.alias("score")), items).withColumnRenamed("item", "id")


def multiple_choice(scorer, items: DataFrame, limit: int | None = None) -> DataFrame:
    return result(choices(scorer, items, limit).select(F.col("id").alias("ord"), F.col("correct").alias("value")))


def cloze(scorer, docs: DataFrame, limit: int) -> DataFrame:
    """Share of held-out last words that the model would say next, in any case."""
    prompts = tokens.sentences_tail(docs, limit).withColumn("ord", F.struct("doc_id", "i"))
    said = F.regexp_extract(F.coalesce("predicted", F.lit("")), X.WORD, 0)
    right = (said != "") & (F.lower(said) == F.lower("target"))
    return result(scorer.next_words(prompts).select("ord", right.alias("value")))


def perplexity(spark: SparkSession, scorer, docs: DataFrame, limit: int, tokenizer=None, seq_len: int = 256, most_blocks: int = 20) -> DataFrame:
    """Perplexity over at most ``most_blocks`` packed blocks of the first ``limit`` texts; short corpora get shorter blocks."""
    first = docs.filter("text <> ''").orderBy("doc_id").limit(limit)
    total = tokens.token_total(first, tokenizer)
    length = tokens.fitting_length(total, seq_len)
    if length is None:
        return first.sparkSession.createDataFrame([(None, 0, None, None)], "value double, n long, lo double, hi double")
    blocks = tokens.packed(spark, first, length, most_blocks, tokenizer)
    out = evaluation.perplexity(scorer.losses(blocks).select("loss", "n_tokens"))
    return out.select(F.col("perplexity").alias("value"), "n", F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"))


def few_shots(source: DataFrame, target: DataFrame, language: str, shots: int = SHOTS) -> str:
    """The first aligned pairs of a development set as examples."""
    rows = evaluation.aligned(source, target, shots).orderBy("id").collect()
    return "".join(f"English: {r['source']}\n{language}: {r['target']}\n\n" for r in rows)


def translation(scorer, dev: tuple[DataFrame, DataFrame], test: tuple[DataFrame, DataFrame], language: str, limit: int) -> DataFrame:
    """chrF of the first line of each reply to a prompt of examples and a sentence; development and test rows are (id, text)."""
    pairs = evaluation.aligned(*test, limit)
    prompt = F.concat(F.lit(few_shots(*dev, language)), F.lit("English: "), "source", F.lit(f"\n{language}:"))
    replies = scorer.replies(pairs.select("id", prompt.alias("prompt"), F.col("target").alias("reference")))
    hypothesis = X.strip(F.get(F.split(F.coalesce("reply", F.lit("")), "\n"), F.lit(0)))
    rows = replies.select("id", hypothesis.alias("hypothesis"), "reference")
    n = rows.agg(F.count("*").alias("n"))
    none = F.lit(None).cast("double")
    return evaluation.chrf(rows).join(n).select(F.when(F.col("n") > 0, F.col("chrf")).alias("value"), "n", none.alias("lo"), none.alias("hi"))


def judged(scorer, judge, prompts: DataFrame, language: str, limit: int) -> DataFrame:
    """Mean rating 1 to 5 that a judge (a scorer) gives the replies to prompts (id, instruction); the interval is that of the share of good ones, on the same scale."""
    asked = prompts.orderBy("id").limit(limit).select("id", F.col("instruction").alias("prompt"))
    replies = scorer.replies(asked).select("id", F.concat(F.lit(f"Rate 1 to 5 how helpful and fluent this reply in {language} is. Answer with the digit only.\nInstruction: "), "prompt", F.lit("\nReply: "), F.coalesce("reply", F.lit("")), F.lit("\nScore (1-5):")).alias("prompt"))
    rating = F.nullif(F.regexp_extract(F.coalesce("reply", F.lit("")), "[1-5]", 0), F.lit("")).cast("double")
    rows = judge.replies(replies).select(F.col("id").alias("ord"), rating.alias("rating")).filter("rating is not null")
    share = result(rows.select("ord", ((F.col("rating") - 1) / 4 > 0.5).alias("value")))
    mean = rows.agg(F.avg("rating").alias("mean"))
    return share.join(mean).select(F.col("mean").alias("value"), "n", (F.col("lo") * 4 + 1).alias("lo"), (F.col("hi") * 4 + 1).alias("hi"))


def gain(name: str, base: float | None, adapted: float | None) -> float | None:
    """How much better the adapted model is; None if it isn't compared."""
    b = benchmark(name)
    if base is None or adapted is None or not b.compare_to_base:
        return None
    return base - adapted if b.lower_is_better else adapted - base


def told(name: str, adapted: dict | None, delta: float | None) -> str:
    """One line for a report: value with its direction, interval, and gain over the base model."""
    if not adapted or adapted["value"] is None:
        return "not measured (no items)"
    line = f"adapted={adapted['value']:.3f}{'↓' if benchmark(name).lower_is_better else '↑'}"
    if adapted["lo"] is not None:
        line += f" (95% CI {adapted['lo']:.3f}–{adapted['hi']:.3f})"
    return line + (f", Δ vs base {delta:+.3f}" if delta is not None else "")

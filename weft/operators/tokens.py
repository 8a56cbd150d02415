"""Token counts, packing, vocabularies and embeddings of new tokens.

A tokenizer is an object with ``tokens(text column) -> array column`` and ``end``, the token that closes a text
(``weft.functions.tokenizers``); white-space words are the default.

Cases: null and empty texts have no tokens and are left out; documents are ordered by doc_id, a null one first,
and rows that repeat an id follow each other in any order; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weft.functions import text as X
from weft.functions.tokenizers import Words
from weft.operators.clean import running_total
from weft.storage import bounded_batches, stored

EOS = Words.end


def fertility(docs: DataFrame, tokenizer=None) -> DataFrame:
    """Tokens for each white-space word: sum of tokens over sum of words, texts without words left out.

    Without a tokenizer characters count as tokens.
    """
    bounded_batches(docs.sparkSession)
    tokens = F.size(tokenizer.tokens(F.col("text"))) if tokenizer else F.length("text")
    rows = docs.select(F.size(X.blank_words(F.col("text"))).cast("long").alias("w"), tokens.cast("long").alias("t")).filter("w > 0")
    sums = rows.agg(F.sum("t").alias("n_tokens"), F.sum("w").alias("n_words")).select(*(F.coalesce(c, F.lit(0)).alias(c) for c in ("n_tokens", "n_words")))
    return sums.withColumn("fertility", F.col("n_tokens") / F.greatest("n_words", F.lit(1)))


def block_budget(steps: int, batch: int, accumulate: int) -> int:
    return steps * batch * accumulate + batch * accumulate


def packed(spark: SparkSession, docs: DataFrame, seq_len: int, max_blocks: int | None = None, tokenizer=None) -> DataFrame:
    """(block, tokens): all texts' tokens, each text closed by the end token, in blocks of exactly ``seq_len``; the tail is left out.

    The place of a text in the stream is a distributed running total. Each text is cut where blocks end, one row
    for each block it reaches, and these pieces meet by block, so tokens are never rows of their own and no task
    holds more than one block at a time.
    """
    bounded_batches(spark)
    tokenizer = tokenizer or Words()
    words = isinstance(tokenizer, Words)  # cheap to cut again, and much smaller as text than as an array
    tokens = tokenizer.tokens(F.col("text"))
    if tokenizer.end is not None:
        tokens = F.concat(tokens, F.array(F.lit(tokenizer.end)))
    docs = docs.filter("text <> ''")
    # ids are stored before ranges are drawn from a sample of them, so no text is encoded twice
    rows = docs.select("doc_id", "text", F.size(tokens).cast("long").alias("n")) if words else stored(spark, docs.select("doc_id", tokens.alias("ts")), "ids").withColumn("n", F.size("ts").cast("long"))
    placed = running_total(spark, rows.filter("n > 0"), "doc_id", "n", "start")
    if words:
        placed = placed.withColumn("ts", tokens)
    last = F.floor((F.col("start") + F.col("n") - 1) / seq_len)
    reached = placed.select("start", "ts", F.explode(F.sequence(F.floor(F.col("start") / seq_len), last)).alias("block"))
    if max_blocks is not None:
        reached = reached.filter(F.col("block") < max_blocks)
    skip = F.greatest(F.col("block") * seq_len - F.col("start"), F.lit(0))
    room = (F.col("block") + 1) * seq_len - F.col("start") - skip
    part = F.slice("ts", (skip + 1).cast("int"), room.cast("int"))
    parts = reached.select("block", "start", (F.array_join(part, " ") if words else part).alias("part"))
    blocks = parts.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("start", "part"))).alias("parts"))
    part = lambda x: F.split(x["part"], " ") if words else x["part"]
    return blocks.select(F.col("block").cast("long").alias("block"), F.flatten(F.transform("parts", part)).alias("tokens")).filter(F.size("tokens") == seq_len)


def token_total(docs: DataFrame, tokenizer=None) -> int:
    """Tokens of all texts with their ends."""
    tokenizer = tokenizer or Words()
    bounded_batches(docs.sparkSession)
    n = F.size(tokenizer.tokens(F.col("text"))) + int(tokenizer.end is not None)
    return docs.filter("text <> ''").agg(F.coalesce(F.sum(n), F.lit(0)).alias("n")).first()["n"]


def fitting_length(total: int, seq_len: int, floor: int = 16) -> int | None:
    """``seq_len`` halved until one block can be filled; None below ``floor``."""
    while seq_len > total and seq_len // 2 >= floor:
        seq_len //= 2
    return seq_len if total >= seq_len else None


def vocabulary(docs: DataFrame) -> DataFrame:
    return docs.select(F.explode(X.blank_words(F.col("text"))).alias("token")).distinct()


def novel_tokens(trained: DataFrame, base: DataFrame, most: int | None = None) -> DataFrame:
    """Tokens of the trained vocabulary that the base one lacks; with ``most`` the first by id (column id) or, without ids, by token."""
    out = trained.join(base.select("token"), "token", "left_anti")
    if most is not None:
        out = out.orderBy(*(c for c in ("id", "token") if c in trained.columns)).limit(most)
    return out.select("token")


def extension(base: DataFrame, novel: DataFrame) -> DataFrame:
    """(token, id) of the base vocabulary and of the novel tokens, which get the ids after its largest, in order of token."""
    top = base.agg((F.coalesce(F.max("id"), F.lit(-1)) + 1).alias("top"))
    numbered = running_total(novel.sparkSession, novel.select("token", F.lit(1).alias("one")), "token", "one", "k").select("token", "k")
    return base.select("token", F.col("id").cast("long").alias("id")).union(numbered.join(F.broadcast(top)).select("token", (F.col("k") + F.col("top")).cast("long")))


def subword_mean(pieces: DataFrame, embeddings: DataFrame) -> DataFrame:
    """(token, pos, value): mean of the embeddings of a token's pieces, by position; rows of (token, piece_id)."""
    parts = embeddings.select(F.col("vec_id").alias("piece_id"), F.posexplode("embedding").alias("pos", "x"))
    return pieces.join(parts, "piece_id").groupBy("token", "pos").agg(F.avg(F.col("x").cast("double")).alias("value"))


def sentences_tail(docs: DataFrame, limit: int, least_words: int = 6) -> DataFrame:
    """Cloze prompts: of the last 3 * limit sentences with enough words, the first ``limit`` valid ones.

    The target is the first word of the last blank-separated token with a word; sentences are ordered by
    (doc_id, position) and cut by ordered limits, which Spark runs as distributed top-k.
    """
    rows = docs.select("doc_id", F.posexplode(X.sentences(F.col("text"))).alias("i", "s")).filter(X.words(F.col("s")) >= least_words)
    tail = rows.orderBy(F.desc("doc_id"), F.desc("i")).limit(3 * limit)
    parts = tail.withColumn("ws", X.blank_words(F.col("s")))
    spots = F.filter(F.transform("ws", lambda w, k: F.struct(k.alias("k"), w.rlike(X.WORD).alias("ok"))), lambda x: x["ok"])
    parts = parts.withColumn("k", F.get(spots, F.size(spots) - 1)["k"]).filter("k > 0")
    target = F.regexp_extract(F.get("ws", F.col("k")), X.WORD, 0)
    prompt = F.concat(F.array_join(F.slice("ws", F.lit(1), F.col("k")), " "), F.lit(" "))
    return parts.select("doc_id", F.col("i").cast("long").alias("i"), prompt.alias("prompt"), target.alias("target")).orderBy("doc_id", "i").limit(limit)


def positional(rows: DataFrame, order: str, most: int) -> DataFrame:
    """The first ``most`` rows in order, numbered from 0 as pos: Spark finds them as a distributed top-k, one task numbers those few."""
    first = rows.orderBy(order).limit(most)
    return first.withColumn("pos", (F.row_number().over(Window.orderBy(order)) - 1).cast("long"))

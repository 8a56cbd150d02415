"""Chat pairs: construction, selection, dedup, human review and deterministic mock providers.

Cases: null texts count as empty and pairs that lack a side are left out (in ``pair_status``: blank if the
instruction is); a message without text has empty content; equal places (ord) follow each other in any order; of
several prior reviews of an id each gives a row, so ids of reviews must differ; empty tables give empty results.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weft.functions import patterns
from weft.functions import text as X
from weft.operators.clean import running_total

#: Up to so many excluded texts are looked for one by one, more of them by one automaton.
FEW_PATTERNS = 16


def first_truthy(*names: str) -> Column:
    return F.coalesce(*(F.nullif(F.col(n), F.lit("")) for n in names), F.lit(""))


def messages(instruction: Column, response: Column, system: Column | None = None) -> Column:
    """An array of (role, content), the system message first if there is one."""
    part = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    plain = F.array(part("user", instruction), part("assistant", response))
    if system is None:
        return plain
    return F.when(F.coalesce(system, F.lit("")) == "", plain).otherwise(F.concat(F.array(part("system", system)), plain))


def content_of(column: str, role: str) -> Column:
    """The first message of a role, or the empty text."""
    return F.coalesce(F.get(F.filter(column, lambda m: m["role"] == role), F.lit(0))["content"], F.lit(""))


def chatml(column: str) -> Column:
    return F.array_join(F.transform(column, lambda m: F.concat(F.lit("<|im_start|>"), m["role"], F.lit("\n"), m["content"], F.lit("<|im_end|>\n"))), "")


def replies(turns: DataFrame, id: str = "message_id", parent: str = "parent_id", order: str = "ord") -> DataFrame:
    """Every assistant message with the root user message it directly answers, if that came before it."""
    ask = turns.filter((F.col("role") == "user") & F.col(parent).isNull()).select(F.col(id).alias("p_id"), F.col("text").alias("instruction"), F.col(order).alias("p_ord"))
    answer = turns.filter(F.col("role") == "assistant").select(F.col(id).alias("id"), F.col(parent).alias("p_id"), F.col("text").alias("response"), F.col(order).alias("ord"))
    return answer.join(ask, "p_id").filter("ord > p_ord and instruction <> '' and response <> ''").select("p_id", "id", "ord", "instruction", "response")


def turn_pairs(conversations: DataFrame) -> DataFrame:
    """Each user turn with the next turn if the assistant speaks it."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    rows = conversations.select("conv_id", "turn", "role", "text", F.lead("role").over(w).alias("next_role"), F.lead("text").over(w).alias("response"))
    return rows.filter("role = 'user' and next_role = 'assistant'").select("conv_id", "turn", F.col("text").alias("instruction"), "response")


def native_set(rows: DataFrame, instruction: str, response: str, source: str | None = None, exclude: tuple[str, ...] = (), select: tuple[str, str] | None = None, limit: int | None = None, order: str = "ord") -> DataFrame:
    """Project rows to pairs: drop sources that contain an excluded text, keep one value of a field, first ``limit``."""
    if source and exclude:
        low = F.lower(F.coalesce(F.col(source).cast("string"), F.lit("None")))
        if len(exclude) <= FEW_PATTERNS:
            rows = rows.filter(~F.exists(F.array(*map(F.lit, exclude)), lambda e: F.contains(low, F.lower(e))))
        else:
            marked = patterns.containing(rows.sparkSession, rows.withColumn("__low", low), "__low", [e.lower() for e in exclude], "__excluded")
            rows = marked.filter("not __excluded").drop("__low", "__excluded")
    if select:
        rows = rows.filter(F.coalesce(F.col(select[0]).cast("string"), F.lit("None")) == select[1])
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    out = rows.select(order, text(instruction).alias("instruction"), text(response).alias("response")).filter("instruction <> '' and response <> ''")
    return out.orderBy(order).limit(limit) if limit is not None else out


def instruction_set(rows: DataFrame, limit: int | None = None, order: str = "ord") -> DataFrame:
    """Pairs of a local instruction file: the first filled of each side's field names; rows lacking a side go."""
    have = lambda names: first_truthy(*(n for n in names if n in rows.columns))
    out = rows.select(order, have(("instruction", "prompt", "input")).alias("instruction"), have(("response", "output", "completion")).alias("response"))
    out = out.filter("instruction <> '' and response <> ''")
    return out.orderBy(order).limit(limit) if limit is not None else out


def branches(*parts: DataFrame, order: str = "ord") -> DataFrame:
    """All rows of the parts in their order: (branch, order) sorts them."""
    return reduce(DataFrame.unionByName, (p.withColumn("branch", F.lit(i)) for i, p in enumerate(parts)))


def pair_status(pairs: DataFrame, order: str = "ord") -> DataFrame:
    """Pairs with status accepted, degenerate, duplicate or blank, in order of arrival.

    A degenerate pair claims no key; it counts as degenerate only if no earlier good pair has its key.
    The first good id of each key comes from a partial aggregate.
    """
    key = F.lower(X.strip(F.coalesce(F.col("instruction"), F.lit(""))))
    rows = pairs.withColumn("key", key).withColumn("bad", X.degenerate(F.col("instruction")) | X.degenerate(F.col("response")))
    first = rows.filter("key <> '' and not bad").groupBy("key").agg(F.min(order).alias("first"))
    met = rows.join(first, "key", "left")
    earlier = F.col("first").isNotNull() & (F.col("first") < F.col(order))
    status = F.when(F.col("key") == "", "blank").when(earlier, "duplicate").when(F.col("bad"), "degenerate").otherwise("accepted")
    return met.withColumn("status", status).drop("bad", "first")


def review_queue(spark: SparkSession, pairs: DataFrame, order: str = "ord") -> DataFrame:
    """Positional ids from 0 in the given order, by a distributed running count, and status pending."""
    return running_total(spark, pairs.withColumn("one", F.lit(1)), order, "one", "id").drop("one").withColumn("status", F.lit("pending"))


def merge_reviews(queue: DataFrame, prior: DataFrame) -> DataFrame:
    """The queue with the status of an earlier review of the same id."""
    old = prior.select("id", F.col("status").alias("old"))
    return queue.join(old, "id", "left").withColumn("status", F.coalesce("old", "status")).drop("old")


def merge_output_reviews(queue: DataFrame, prior: DataFrame) -> DataFrame:
    """Ratings of an earlier review replace those of the same id unless it is still pending."""
    fields = ("status", "fluency", "correctness", "correction", "notes")
    old = prior.filter("status <> 'pending'").select("id", F.lit(True).alias("seen"), *(F.col(c).alias(f"old_{c}") for c in fields))
    met = queue.join(old, "id", "left")
    return met.withColumns({c: F.when(F.col("seen"), F.col(f"old_{c}")).otherwise(F.col(c)) for c in fields}).drop("seen", *(f"old_{c}" for c in fields))


OUTPUT_QUEUE = "id long, status string, instruction string, response string, fluency double, correctness double, correction string, notes string"


def output_queue(replies: DataFrame) -> DataFrame:
    """Replies (id, instruction, reply) as pending rows with room for ratings."""
    blank = {"fluency": "double", "correctness": "double", "correction": "string", "notes": "string"}
    return replies.select("id", F.lit("pending").alias("status"), "instruction", F.col("reply").alias("response"), *(F.lit(None).cast(k).alias(c) for c, k in blank.items()))


def accepted_pairs(queue: DataFrame, review: bool) -> DataFrame:
    rows = queue.filter("status = 'accepted'") if review else queue
    return rows.drop("id", "status")


def mock_translate(text: Column, language: str) -> Column:
    """A deterministic stand-in for a translator: the language's name before the text, blanks collapsed."""
    return F.concat(F.lit(f"[{language}] "), F.regexp_replace(X.strip(text), "(?U)\\s+", " "))


def mock_pairs(spark: SparkSession, n: int, language: str, contexts: DataFrame | None = None, n_contexts: int = 0) -> DataFrame:
    """A deterministic stand-in for a teacher: ``n`` numbered pairs (i, instruction, response).

    With contexts (i, context) pair i asks about the first four words of context i modulo their number.
    """
    rows = spark.range(n).withColumnRenamed("id", "i")
    topic = F.lit("")
    if contexts is not None and n_contexts:
        rows = with_context(rows, contexts, n_contexts)
        topic = F.concat(F.lit(" ("), F.array_join(F.slice(X.blank_words(F.coalesce("context", F.lit(""))), 1, 4), " "), F.lit(")"))
    number = (F.col("i") + 1).cast("string")
    tag = F.lit(f"[{language}] ")
    return rows.select("i", F.concat(tag, F.lit("Question "), number, topic, F.lit("?")).alias("instruction"), F.concat(tag, F.lit("Answer "), number, F.lit(".")).alias("response"))


def with_context(rows: DataFrame, contexts: DataFrame, n: int) -> DataFrame:
    """Row i with context i modulo ``n`` (columns i, context; n contexts numbered from 0)."""
    return rows.withColumn("c", F.pmod(F.col("i"), F.lit(n))).join(F.broadcast(contexts.select(F.col("i").alias("c"), "context")), "c").drop("c")


def context_windows(calls: DataFrame, contexts: DataFrame, n: int, width: int = 5) -> DataFrame:
    """For call i the ``width`` contexts from number i * ``width`` on, going round (fewer if there are fewer).

    ``contexts`` are the first few texts of a corpus (i, context), numbered from 0 to n - 1.
    """
    offsets = F.explode(F.sequence(F.lit(0), F.lit(min(width, n) - 1))).alias("slot")
    asked = calls.select("i", offsets).withColumn("c", F.pmod(F.col("i") * width + F.col("slot"), F.lit(n)))
    return asked.join(F.broadcast(contexts.select(F.col("i").alias("c"), "context")), "c").select("i", "slot", "context")

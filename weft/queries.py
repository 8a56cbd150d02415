"""The registered queries over the driver's tables, each with the SQL that DuckDB can run in its place."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.functions import langid, patterns, tables
from weft.functions import text as X
from weft.functions.tokenizers import FileTokenizer
from weft.operators import benchmarks, bootstrap, chat, clean, evaluation, licensing, similarity, tokens
from weft.operators.dedup_index import DedupIndex
from weft.sources import remote
from weft.sources.files import moses_pairs, smol_target
from weft.storage import fresh_path, spread, stored, table

#: Rows that a model of languages learns from.
LEARNT = "crc32(cast(cast(doc_id as string) as binary)) % 5 <> 0"
QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return spread(table(spark, d, "documents"))


def _values(rows: str, names: str) -> str:
    return f"(values {rows}) v({names})"


# ---- shared SQL
NORM = r"""norm as (select doc_id, source, lang, regexp_replace(regexp_replace(regexp_replace(regexp_replace(nfc_normalize(coalesce(text, '')),
  '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x{9f}]', '', 'g'), '[ \t]+', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g') as t from documents)"""
FEAT = (
    NORM
    + r""", raw as (select *, length(t) as n_chars, len(regexp_extract_all(t, '[\p{L}\p{N}_]+')) as n_words,
  len(regexp_extract_all(t, '[^\p{L}\p{N}_\s]')) / greatest(length(t), 1) as sym,
  list_filter(list_transform(string_split(t, chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') as ls from norm),
 feat as (select *, case when len(ls) <= 1 then 0.0 else 1 - len(list_distinct(ls)) / len(ls) end as rep from raw),
 scored as (select *, greatest(0.0, least(1.0, 0.5 * (1 - sym / 0.3) + 0.5 * (1 - rep))) as score from feat),
 judged as (select *, case when t = '' then 'empty_after_normalize' when n_chars < 200 then 'too_short_chars' when n_words < 20 then 'too_few_words'
  when sym > 0.3 then 'symbol_heavy' when rep > 0.5 then 'repetitive' when score < 0.5 then 'low_quality' end as why from scored)"""
)
CLEAN = (
    FEAT
    + r""", canon as (select *, regexp_replace(lower(t), '\s+', ' ', 'g') as c from judged),
 decided as (select *, case when why is not null then why when row_number() over (partition by why is null, c order by doc_id) > 1 then 'duplicate' end as reason from canon),
 kept as (select * from decided where reason is null)"""
)
PII = r"""pii as (select *, len(regexp_extract_all(t, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}')) as n_email,
  regexp_replace(t, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}', '[EMAIL]', 'g') as t1 from kept),
 pii2 as (select *, len(regexp_extract_all(t1, 'https?://\S+|www\.\S+')) as n_url, regexp_replace(t1, 'https?://\S+|www\.\S+', '[URL]', 'g') as t2 from pii),
 pii3 as (select *, len(regexp_extract_all(t2, '(^|[^\p{L}\p{N}_])\p{Nd}[\p{Nd}\s-]{6,}\p{Nd}($|[^\p{L}\p{N}_])')) as n_num,
  regexp_replace(t2, '(^|[^\p{L}\p{N}_])\p{Nd}[\p{Nd}\s-]{6,}\p{Nd}($|[^\p{L}\p{N}_])', '\1[NUM]\2', 'g') as t3 from pii2)"""
WS = r"list_filter(regexp_split_to_array(%s, '\s+'), lambda w: w <> '')"


# ---- cleaning
@query(f"with {NORM} select doc_id, t as text from norm")
def normalize_text(spark, d):
    return clean.normalized(_docs(spark, d)).select("doc_id", "text")


@query(f"with {FEAT} select doc_id, why as reason from judged")
def quality_reasons(spark, d):
    return clean.judged(_docs(spark, d)).select("doc_id", "reason")


@query(f"with {FEAT} select doc_id, n_chars, n_words, round(sym, 9) as symbol_ratio, round(rep, 9) as repetition, round(score, 9) as score from judged")
def quality_scores(spark, d):
    r = lambda c: F.round(c, 9).alias(c)
    return clean.judged(_docs(spark, d)).select("doc_id", "n_chars", "n_words", r("symbol_ratio"), r("repetition"), r("score"))


@query(f"with {FEAT} select doc_id, round(rep, 9) as repetition from feat")
def repetition_ratio(spark, d):
    return clean.features(clean.normalized(_docs(spark, d))).select("doc_id", F.round("repetition", 9).alias("repetition"))


@query(f"with {FEAT} select doc_id, case when t = '' then 'empty_after_normalize' when lang <> '' and lang <> 'en' then 'wrong_language' else why end as reason from judged")
def language_filter(spark, d):
    return clean.judged(_docs(spark, d).withColumn("prob", F.lit(0.5)), language="en").select("doc_id", "reason")


@query(f"with {CLEAN} select doc_id, reason from decided")
def exact_dedup(spark, d):
    return clean.with_duplicates(spark, clean.judged(_docs(spark, d)), ["doc_id"]).select("doc_id", "reason")


@query(f"with {CLEAN}, {PII} select doc_id, t3 as text, n_email, n_url, n_num from pii3")
def pii_scrub(spark, d):
    return clean.scrubbed(clean.cleaned(spark, _docs(spark, d))).select("doc_id", "text", "n_email", "n_url", "n_num")


@query(
    f"with {CLEAN}, {PII} select (select count(*) from decided) as docs_in, count(*) as docs_out, sum(len({WS % 't3'}))::bigint as tokens_out, sum(length(t3))::bigint as chars_out, sum(n_email + n_url + n_num)::bigint as pii_redactions, "
    + ", ".join(f"(select count(*) from decided where reason = '{r}') as {r}" for r in clean.REASONS)
    + " from pii3"
)
def clean_data_card(spark, d):
    return clean.data_card(spark, _docs(spark, d))


@query(f"with {CLEAN} select coalesce(reason, 'kept') as reason, count(*) as n from decided group by 1")
def drop_reason_counts(spark, d):
    rows = clean.with_duplicates(spark, clean.judged(_docs(spark, d)), ["doc_id"])
    return rows.groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


@query(f"with {CLEAN} select source, count(*) as n from kept group by 1")
def per_source_counts(spark, d):
    rows = clean.with_duplicates(spark, clean.judged(_docs(spark, d)), ["doc_id", "source"]).filter("reason is null")
    return rows.groupBy("source").agg(F.count("*").alias("n"))


@query("select source, count(*) as docs, sum(strlen(text))::bigint as bytes from documents group by 1")
def ingest_card(spark, d):
    return _docs(spark, d).groupBy("source").agg(F.count("*").alias("docs"), F.sum(F.octet_length("text")).cast("long").alias("bytes"))


@query("select doc_id, before + strlen(text) as bytes_after from (select *, coalesce(sum(strlen(text)) over (order by doc_id rows between unbounded preceding and 1 preceding), 0)::bigint as before from documents) where before < 1000000")
def byte_budget(spark, d):
    rows = clean.running_total(spark, _docs(spark, d).select("doc_id", F.octet_length("text").cast("long").alias("n")), "doc_id", "n")
    return rows.filter("before < 1000000").select("doc_id", (F.col("before") + F.col("n")).alias("bytes_after"))


@query("select doc_id, source from (select *, row_number() over (partition by source order by doc_id) as n from documents) where n <= 5")
def max_docs_per_source(spark, d):
    return clean.first_per_source(_docs(spark, d).select("doc_id", "source"), 5)


@query("select doc_id, source from documents where source in ('src1', 'src2', 'src3')")
def source_catalog_filter(spark, d):
    return _docs(spark, d).filter(F.col("source").isin("src1", "src2", "src3")).select("doc_id", "source")


PAIRS = rf""", ws as (select doc_id, list_distinct({WS % 'c'}) as ws from canon2),
 tok as (select doc_id, len(ws) as n, unnest(ws) as w from ws),
 hits as (select a.doc_id as a, b.doc_id as b, a.n as na, b.n as nb, count(*) as m from tok a join tok b on a.w = b.w and a.doc_id < b.doc_id group by all),
 pairs as (select a, b, m / (na + nb - m) as jaccard from hits where m / (na + nb - m) >= 0.85)"""
CANON2 = CLEAN + r", canon2 as (select doc_id, c from kept)"


@query(f"with {CANON2}{PAIRS} select a, b, round(jaccard, 9) as jaccard from pairs")
def near_dup_pairs(spark, d):
    sets = similarity.word_sets(clean.cleaned(spark, _docs(spark, d)))
    return similarity.similar_pairs(spark, sets).select("a", "b", F.round("jaccard", 9).alias("jaccard"))


@query(
    f"""with recursive {CANON2}{PAIRS}, later as (select b, list(a) as earlier, row_number() over (order by b) as i from pairs group by b),
 walk(i, dropped) as (select 0::bigint, []::bigint[] union all
  select l.i, case when len(list_filter(l.earlier, lambda x: not list_contains(w.dropped, x))) > 0 then list_append(w.dropped, l.b) else w.dropped end from walk w join later l on l.i = w.i + 1)
 select unnest(dropped) as doc_id from (select dropped from walk order by i desc limit 1)"""
)
def near_dedup_greedy(spark, d):
    return similarity.near_drops(spark, similarity.word_sets(clean.cleaned(spark, _docs(spark, d))))


@query()
def lsh_candidates(spark, d):
    return similarity.lsh_candidates(clean.cleaned(spark, _docs(spark, d)))


@query()
def dedup_increments(spark, d):
    """Why each document of a corpus that comes in four parts, in order of id, is dropped; earlier parts' texts aren't read again."""
    docs = _docs(spark, d).select("doc_id", "text")
    top = docs.agg(F.max("doc_id")).first()[0] or 0
    index, out = DedupIndex(spark, fresh_path(spark, "index")), []
    for k in range(4):
        part = docs.filter(F.floor(F.col("doc_id") * 4 / (top + 1)) == k)
        out.append(stored(spark, index.add(part, f"part-{k}"), "told"))
    return reduce(DataFrame.unionByName, out)


@query()
def lsh_drops(spark, d):
    return similarity.lsh_drops(spark, clean.cleaned(spark, _docs(spark, d)))


@query()
def language_filter_predicted(spark, d):
    """Reasons with the language that a model tells, which learnt from four of five documents."""
    docs = _docs(spark, d)
    model = langid.train(docs.filter(LEARNT))
    return clean.judged(docs.drop("lang"), language="en", model=model).select("doc_id", "lang", "reason")


@query()
def language_accuracy(spark, d):
    """How many documents of each language that the model didn't learn from it tells right."""
    docs = _docs(spark, d).filter("lang <> ''")
    return langid.accuracy(docs.filter(f"not ({LEARNT})"), langid.train(docs.filter(LEARNT)))


@query()
def language_predict(spark, d):
    """The language of every document by a model that learnt from four of five; held_out says of which it didn't."""
    docs = _docs(spark, d)
    rows = docs.select("doc_id", "text", F.expr(f"not ({LEARNT})").alias("held_out"))
    return langid.identified(rows, langid.train(docs.filter(LEARNT))).select("doc_id", "held_out", "lang", F.round("prob", 6).alias("prob"))


# ---- chat
TURNS = "turns as (select conv_id, turn, text as instruction, nr, response from (select *, lead(role) over w as nr, lead(text) over w as response from conversations window w as (partition by conv_id order by turn)) where role = 'user' and nr = 'assistant')"
TREE = "tree as (select conv_id * 1000 + turn as message_id, role, text, conv_id * 1000 + turn as ord, case when role = 'assistant' then conv_id * 1000 + (select min(u.turn) from conversations u where u.conv_id = c.conv_id and u.role = 'user') end as parent_id from conversations c)"


def _pairs(spark, d):
    return chat.turn_pairs(table(spark, d, "conversations")).withColumn("ord", F.col("conv_id") * 1000 + F.col("turn"))


@query(f"with {TURNS} select conv_id, turn, instruction, response from turns")
def chat_pairs(spark, d):
    return _pairs(spark, d).select("conv_id", "turn", "instruction", "response")


@query(f"with {TURNS} select conv_id, turn, '<|im_start|>user' || chr(10) || instruction || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) || response || '<|im_end|>' || chr(10) as chatml, instruction as first_user, response as first_assistant from turns")
def chat_messages(spark, d):
    rows = _pairs(spark, d).withColumn("messages", chat.messages(F.col("instruction"), F.col("response")))
    return rows.select("conv_id", "turn", chat.chatml("messages").alias("chatml"), chat.content_of("messages", "user").alias("first_user"), chat.content_of("messages", "assistant").alias("first_assistant"))


@query(f"with {TREE} select r.message_id as id, p.text as instruction, r.text as response from tree r join tree p on r.parent_id = p.message_id where r.role = 'assistant' and p.role = 'user' and r.ord > p.ord and p.text <> '' and r.text <> ''")
def oasst_pairing(spark, d):
    rows = table(spark, d, "conversations")
    first = rows.filter("role = 'user'").groupBy("conv_id").agg(F.min("turn").alias("first"))
    key = F.col("conv_id") * 1000
    tree = rows.join(first, "conv_id", "left").select((key + F.col("turn")).alias("message_id"), "role", "text", (key + F.col("turn")).alias("ord"), F.when(F.col("role") == "assistant", key + F.col("first")).alias("parent_id"))
    return chat.replies(tree).select("id", "instruction", "response")


# every third pair repeats the instruction of the pair before it in its conversation, in other case, so that keys collide
MADE = f"{TURNS}, made as (select ord, case when ord % 3 = 0 then translate(coalesce(prev, instruction), 'aei', 'AEI') || ' ' else instruction end as instruction, case when ord % 7 = 0 then 'no no no no no no no' else response end as response from (select *, lag(instruction) over (partition by ord // 1000 order by ord) as prev from (select conv_id * 1000 + turn as ord, instruction, response from turns)))"
STATUS = (
    MADE
    + r""", keyed as (select *, lower(regexp_replace(instruction, '^\s+|\s+$', '', 'g')) as key from made),
 runs as (select ord, max(n) as run from (select ord, side, w, i - r as g, count(*) as n from (select *, row_number() over (partition by ord, side, w order by i) as r from
   (select ord, side, unnest(ws) as w, generate_subscripts(ws, 1) as i from (select ord, 1 as side, list_filter(regexp_split_to_array(instruction, '\s+'), lambda w: w <> '') as ws from made union all select ord, 2, list_filter(regexp_split_to_array(response, '\s+'), lambda w: w <> '') from made))) group by all) group by ord),
 flagged as (select k.*, coalesce(run, 0) >= 6 as bad from keyed k left join runs using (ord)),
 status as (select *, case when key = '' then 'blank' when coalesce(min(ord) filter (where not bad) over (partition by key) < ord, false) then 'duplicate' when bad then 'degenerate' else 'accepted' end as status from flagged)"""
)


def _made(spark, d):
    from pyspark.sql.window import Window

    rows = _pairs(spark, d)
    prev = F.lag("instruction").over(Window.partitionBy(F.floor(F.col("ord") / 1000)).orderBy("ord"))
    rows = rows.withColumn("prev", prev)
    instruction = F.when(F.col("ord") % 3 == 0, F.concat(F.translate(F.coalesce("prev", "instruction"), "aei", "AEI"), F.lit(" "))).otherwise(F.col("instruction"))
    response = F.when(F.col("ord") % 7 == 0, F.lit("no no no no no no no")).otherwise(F.col("response"))
    return rows.select("ord", instruction.alias("instruction"), response.alias("response"))


@query(f"with {STATUS} select ord, status from status")
def pair_dedup(spark, d):
    return chat.pair_status(_made(spark, d)).select("ord", "status")


@query(f"with {STATUS} select count(*) as generated, count(*) filter (where status = 'degenerate') as degenerate_dropped, count(*) filter (where status = 'duplicate') as duplicate_dropped, count(*) filter (where status = 'accepted') as accepted from status")
def convdata_card(spark, d):
    n = lambda s: F.count_if(F.col("status") == s)
    return chat.pair_status(_made(spark, d)).agg(F.count("*").alias("generated"), n("degenerate").alias("degenerate_dropped"), n("duplicate").alias("duplicate_dropped"), n("accepted").alias("accepted"))


DEGENERATE = r"""select doc_id, coalesce(max(n), 0) >= 6 as degenerate from (select doc_id from documents) left join (select doc_id, w, i - r as g, count(*) as n from (select *, row_number() over (partition by doc_id, w order by i) as r from
 (select doc_id, unnest(ws) as w, generate_subscripts(ws, 1) as i from (select doc_id, list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '') as ws from documents))) group by all) using (doc_id) group by doc_id"""


@query(DEGENERATE)
def degenerate_texts(spark, d):
    return _docs(spark, d).select("doc_id", X.degenerate(F.col("text")).alias("degenerate"))


QUEUE = f"{TURNS}, queue as (select row_number() over (order by conv_id, turn) - 1 as id, 'pending' as status, instruction, response from turns), prior as (select id, case when id % 2 = 0 then 'accepted' else 'rejected' end as status from queue where id % 3 <> 0), merged as (select q.id, coalesce(p.status, q.status) as status, instruction, response from queue q left join prior p using (id))"


def _queue(spark, d):
    queue = chat.review_queue(spark, _pairs(spark, d).select("ord", "instruction", "response"))
    prior = queue.filter("id % 3 <> 0").select("id", F.when(F.col("id") % 2 == 0, "accepted").otherwise("rejected").alias("status"))
    return queue, prior


@query(f"with {QUEUE} select id, status, instruction from queue")
def review_queue(spark, d):
    return _queue(spark, d)[0].select("id", "status", "instruction")


@query(f"with {QUEUE} select id, status from merged")
def review_merge(spark, d):
    return chat.merge_reviews(*_queue(spark, d)).select("id", "status")


@query(f"with {QUEUE} select instruction, response from merged where status = 'accepted'")
def accepted_pairs(spark, d):
    return chat.accepted_pairs(chat.merge_reviews(*_queue(spark, d)), True).select("instruction", "response")


@query("select doc_id as ord, lang as instruction, text as response from documents where not contains(lower(source), 'src1') and lang = 'de' and text <> '' order by doc_id limit 50")
def native_set_select_exclude(spark, d):
    return chat.native_set(_docs(spark, d), "lang", "text", "source", ("SRC1",), ("lang", "de"), 50, "doc_id").withColumnRenamed("doc_id", "ord")


@query(f"with {TURNS} select conv_id, turn, '[Test] ' || regexp_replace(regexp_replace(instruction, '^\\s+|\\s+$', '', 'g'), '\\s+', ' ', 'g') as translated from turns")
def mock_translate(spark, d):
    return _pairs(spark, d).select("conv_id", "turn", chat.mock_translate(F.col("instruction"), "Test").alias("translated"))


@query(f"with first as (select row_number() over (order by doc_id) - 1 as c, {WS % "coalesce(text, '')"} as ws from (select * from documents order by doc_id limit 20)) select i, '[Test] Question ' || (i + 1) || ' (' || array_to_string(ws[1:4], ' ') || ')?' as instruction, '[Test] Answer ' || (i + 1) || '.' as response from range(45) r(i) join first on c = i % 20")
def mock_synth(spark, d):
    contexts = tokens.positional(_docs(spark, d).select("doc_id", "text"), "doc_id", 20).select(F.col("pos").alias("i"), F.col("text").alias("context"))
    return chat.mock_pairs(spark, 45, "Test", contexts, 20)


@query("select s.conv_id // 2 as corpus, s.turn as line, s.text as src, t.text as tgt from conversations s join conversations t on s.conv_id % 2 = 0 and t.conv_id = s.conv_id + 1 and s.turn = t.turn where trim(s.text) <> '' and trim(t.text) <> ''")
def moses_zip(spark, d):
    c = table(spark, d, "conversations")
    side = lambda k: c.filter(F.col("conv_id") % 2 == k).select(F.floor(F.col("conv_id") / 2).alias("corpus"), F.col("turn").alias("line"), "text")
    return moses_pairs(side(0), side(1), ["corpus", "line"]).select("corpus", "line", "src", "tgt")


# ---- tokens
@query(f"with {NORM}, w as (select len({WS % 't'}) as w, length(t) as n from norm) select sum(n)::bigint as n_tokens, sum(w)::bigint as n_words, sum(n) / sum(w) as fertility from w where w > 0")
def fertility(spark, d):
    return tokens.fertility(clean.normalized(_docs(spark, d)))


@query(
    f"""with {CLEAN}, tk as (select doc_id, unnest(list_append({WS % 't'}, '</s>')) as token, generate_subscripts(list_append({WS % 't'}, '</s>'), 1) as i from kept where t <> ''),
 placed as (select token, row_number() over (order by doc_id, i) - 1 as pos from tk)
 select pos // 512 as block, string_agg(token, ' ' order by pos) as tokens from placed group by 1 having count(*) = 512"""
)
def token_packing(spark, d):
    blocks = tokens.packed(spark, clean.cleaned(spark, _docs(spark, d)), 512)
    return blocks.select("block", F.array_join("tokens", " ").alias("tokens"))


#: A public tokenizer's file; any of its kind does.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"


@query()
def tokenizer_fertility(spark, d):
    return tokens.fertility(clean.normalized(_docs(spark, d)), FileTokenizer(TOKENIZER))


@query()
def tokenizer_packing(spark, d):
    blocks = tokens.packed(spark, clean.cleaned(spark, _docs(spark, d)), 512, tokenizer=FileTokenizer(TOKENIZER, end=50256))
    return blocks.select("block", F.array_join(F.transform("tokens", lambda x: x.cast("string")), " ").alias("tokens"))


@query(f"with {NORM}, w as (select lang, unnest({WS % 't'}) as token from norm) select distinct token from w where lang = 'de' and token not in (select token from w where lang = 'en')")
def vocab_novel_tokens(spark, d):
    docs = clean.normalized(_docs(spark, d))
    return tokens.novel_tokens(tokens.vocabulary(docs.filter("lang = 'de'")), tokens.vocabulary(docs.filter("lang = 'en'")))


@query("with e as (select vec_id % 50 as token, unnest(embedding)::double as x, generate_subscripts(embedding, 1) - 1 as pos from embeddings) select token, pos, round(avg(x), 6) as value from e group by all")
def subword_mean_embedding(spark, d):
    e = table(spark, d, "embeddings")
    pieces = e.select((F.col("vec_id") % 50).alias("token"), F.col("vec_id").alias("piece_id"))
    return tokens.subword_mean(pieces, e).select("token", F.col("pos").cast("long").alias("pos"), F.round("value", 6).alias("value"))


# ---- evaluation
CLOZE = rf"""sent as (select doc_id, i, s from (select doc_id, unnest(ss) as s, generate_subscripts(ss, 1) - 1 as i from (select doc_id, list_filter(list_transform(regexp_split_to_array(regexp_replace(t, '([.!?])\s+', '\1' || chr(10), 'g'), '\n+'), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') as ss from kept)) where len(regexp_extract_all(s, '[\p{{L}}\p{{N}}_]+')) >= 6),
 tail as (select * from sent order by doc_id desc, i desc limit 300),
 ws as (select doc_id, i, {WS % 's'} as ws from tail),
 spot as (select *, len(ws) - list_position(list_reverse(list_transform(ws, lambda w: regexp_matches(w, '[\p{{L}}\p{{N}}_]'))), true) as k from ws)
 select doc_id, i, array_to_string(ws[1:k], ' ') || ' ' as prompt, regexp_extract(ws[k + 1], '[\p{{L}}\p{{N}}_]+') as target from spot where k > 0 order by doc_id, i limit 100"""


@query(f"with {CLEAN}, {CLOZE}")
def cloze_prompts(spark, d):
    return tokens.sentences_tail(clean.cleaned(spark, _docs(spark, d)), 100)


@query("select doc_id % 100 as item, arg_max(idx, (score, -idx)) as choice from (select doc_id, doc_id % 4 as idx, (n_chars % 97)::double as score from documents) group by 1")
def mc_argmax(spark, d):
    rows = _docs(spark, d).select((F.col("doc_id") % 100).alias("item"), (F.col("doc_id") % 4).alias("idx"), (F.col("n_chars") % 97).cast("double").alias("score"))
    return evaluation.best_choice(rows)


@query("select avg(quality) as accuracy, count(quality) as n from labels")
def accuracy(spark, d):
    return evaluation.accuracy(table(spark, d, "labels").withColumn("correct", F.col("quality")))


@query("with s as (select 'quality' as benchmark, avg(quality) filter (where doc_id % 2 = 0) as base, avg(quality) filter (where doc_id % 2 = 1) as adapted from labels) select benchmark, base, adapted, adapted - base as delta from s")
def accuracy_delta(spark, d):
    bundle = F.when(F.col("doc_id") % 2 == 0, "base").otherwise("adapted").alias("bundle")
    s = table(spark, d, "labels").groupBy(bundle).agg(F.avg("quality").alias("value")).withColumns({"benchmark": F.lit("quality"), "lower_is_better": F.lit(False)})
    return evaluation.delta(s).select("benchmark", "base", "adapted", "delta")


@query("select round(exp(sum(loss * (n - 1)) / sum(n - 1)), 6) as perplexity, sum(n - 1)::bigint as n from (select (doc_id % 13) / 5.0 as loss, n_chars as n from documents) where n > 1")
def perplexity(spark, d):
    rows = _docs(spark, d).select(((F.col("doc_id") % 13) / 5.0).alias("loss"), F.col("n_chars").alias("n_tokens"))
    return evaluation.perplexity(rows).select(F.round("perplexity", 6).alias("perplexity"), "n")


@query(
    r"""with p as (select conv_id * 1000 + turn as id, regexp_replace(text, '\s+', '', 'g') as h, regexp_replace(nr, '\s+', '', 'g') as r from (select *, lead(text) over (partition by conv_id order by turn) as nr from conversations) where text is not null and nr is not null),
 gh as (select id, n, substr(h, i, n) as g, count(*) as c from p, range(1, 7) t(n), lateral (select unnest(range(1, length(h) - n + 2)) as i) group by all),
 gr as (select id, n, substr(r, i, n) as g, count(*) as c from p, range(1, 7) t(n), lateral (select unnest(range(1, length(r) - n + 2)) as i) group by all),
 m as (select coalesce(gh.n, gr.n) as n, sum(coalesce(gh.c, 0)) as h, sum(coalesce(gr.c, 0)) as r, sum(least(coalesce(gh.c, 0), coalesce(gr.c, 0))) as m from gh full join gr on gh.id = gr.id and gh.n = gr.n and gh.g = gr.g group by 1),
 a as (select avg(m / h) as p, avg(m / r) as q from m where h > 0 and r > 0)
 select round(coalesce(case when p + q > 0 then 100 * 5 * p * q / (4 * p + q) end, 0), 6) as chrf from a"""
)
def chrf(spark, d):
    from pyspark.sql.window import Window

    after = F.lead("text").over(Window.partitionBy("conv_id").orderBy("turn"))
    pairs = table(spark, d, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.col("text").alias("hypothesis"), after.alias("reference")).dropna()
    return evaluation.chrf(pairs).select(F.round("chrf", 6).alias("chrf"))


@query(
    """with l as (select distinct lang as language, source as benchmark, nullif(lang, '') || '_Latn' as code from documents),
 c as (select source as benchmark, lang || '_Latn' as code, bool_or(toxic = 1) as gated, true as found from documents join labels using (doc_id) where lang <> '' group by 1, 2)
 select language, benchmark, code, coalesce(found and not gated, false) as available, case when code is null then 'no code' when found is null then 'not covered' when gated then 'gated' else 'covered' end as reason from l left join c using (benchmark, code)"""
)
def coverage_matrix(spark, d):
    """Which pairs of source and language the labels cover, those with a toxic document as gated."""
    pairs = table(spark, d, "documents").select("doc_id", F.col("lang").alias("language"), F.col("source").alias("benchmark"), F.concat(F.nullif("lang", F.lit("")), F.lit("_Latn")).alias("code"))
    labelled = pairs.filter("code is not null").join(table(spark, d, "labels"), "doc_id")
    configs = labelled.groupBy("benchmark", "code").agg(F.bool_or(F.col("toxic") == 1).alias("gated"))
    return evaluation.coverage(pairs.select("language", "benchmark", "code").distinct(), configs)


@query("select count(*) as total, count(*) filter (where quality = 1) as reviewed, count(*) filter (where quality = 0) as pending, round(avg(doc_id % 5 + 1) filter (where quality = 1), 3) as mean_fluency, round(avg(doc_id % 4 + 1) filter (where quality = 1), 3) as mean_correctness from labels")
def review_summary(spark, d):
    rows = table(spark, d, "labels").select(F.when(F.col("quality") == 1, "reviewed").otherwise("pending").alias("status"), (F.col("doc_id") % 5 + 1).alias("fluency"), (F.col("doc_id") % 4 + 1).alias("correctness"))
    return evaluation.review_summary(rows)


@query("with r as (select nullif(regexp_extract(text, '[1-5]'), '')::int as r from documents) select avg(r) as mean_rating, count(r) as n, avg((r > 3)::int) as share_good from r")
def judge_parse(spark, d):
    return evaluation.judge(_docs(spark, d).select(F.col("text").alias("reply")))


_MIXED = "xor(x, x >> 16)"
_STEPS = " + ".join(f"(h >= {t})::int" for t in bootstrap.STEPS)


@query(
    f"""with items as (select 'quality' as name, doc_id as ord, quality as v from labels union all select 'toxic', doc_id, toxic from labels),
 h0 as (select name, v, i as round, xor(ord & 4294967295, (i * 2654435761) & 4294967295) as x from items, range({bootstrap.ROUNDS}) r(i) where v is not null),
 h1 as (select name, v, round, ({_MIXED} * {bootstrap.MULTIPLIERS[0]}) & 4294967295 as x from h0), h2 as (select name, v, round, ({_MIXED} * {bootstrap.MULTIPLIERS[1]}) & 4294967295 as x from h1),
 w as (select name, v, round, {_STEPS} as w from (select name, v, round, {_MIXED} as h from h2)),
 m as (select name, list(m order by m) as ms from (select name, sum(v * w)::double / sum(w) as m from w group by name, round having sum(w) > 0) group by name)
 select name, count(v) as n, sum(v)::double / count(v) as mean, ms[floor(0.025 * len(ms))::int + 1] as lo, ms[floor(0.975 * len(ms))::int + 1] as hi from items join m using (name) group by name, ms"""
)
def bootstrap_ci(spark, d):
    l = table(spark, d, "labels")
    rows = l.select(F.lit("quality").alias("name"), F.col("doc_id").alias("ord"), F.col("quality").alias("value")).union(l.select(F.lit("toxic"), F.col("doc_id"), F.col("toxic")))
    return bootstrap.intervals(rows)


@query(
    r"""with p as (select distinct lower(substr(text, 1 + (item_id * 7 % 40)::int, 12)) as p from benchmark union select distinct lower(text) from benchmark)
 select doc_id, coalesce(bool_or(contains(lower(text), p)), false) as excluded, count(*) filter (where contains(lower(text), p)) as n_patterns from documents, p group by doc_id"""
)
def excluded_by_patterns(spark, d):
    """Documents that contain any of the benchmark's items or a piece of each, whatever the case."""
    text = table(spark, d, "benchmark").select(F.lower("text").alias("t"), F.lower(F.expr("substring(text, cast(1 + item_id * 7 % 40 as int), 12)")).alias("s"))
    found = [x for r in text.collect() for x in r]  # patterns are given by whoever excludes
    rows = patterns.containing(spark, _docs(spark, d).select("doc_id", F.lower("text").alias("text")), "text", found, "found", listed=True)
    return rows.select("doc_id", (F.size("found") > 0).alias("excluded"), F.size("found").cast("long").alias("n_patterns"))


# three fields of each side, of which the first filled counts; every fifth row has no response
@query("select doc_id as ord, case when doc_id % 3 = 0 then lang else text end as instruction, text as response from documents where doc_id % 5 <> 0 and text <> '' and (doc_id % 3 <> 0 or lang <> '')")
def instruction_set(spark, d):
    c = F.col("doc_id")
    pick = lambda k, v: F.when(c % 3 == k, F.col(v)).otherwise("")
    rows = _docs(spark, d).select(c.alias("ord"), pick(0, "lang").alias("instruction"), pick(1, "text").alias("prompt"), pick(2, "text").alias("input"), F.when(c % 5 != 0, F.col("text")).alias("output"))
    return chat.instruction_set(rows)


@query(f"with {TURNS} select 0 as branch, conv_id * 1000 + turn as ord, '[Test] ' || regexp_replace(regexp_replace(instruction, '^\\s+|\\s+$', '', 'g'), '\\s+', ' ', 'g') as instruction from turns union all select 1, doc_id, lang from documents where text <> '' and lang <> '' union all select 2, i, 'pair ' || i from range(45) r(i)")
def convdata_branches(spark, d):
    first = _pairs(spark, d).select("ord", chat.mock_translate(F.col("instruction"), "Test").alias("instruction"))
    second = chat.native_set(_docs(spark, d), "lang", "text", order="doc_id").select(F.col("doc_id").alias("ord"), "instruction")
    third = spark.range(45).select(F.col("id").alias("ord"), F.concat(F.lit("pair "), F.col("id").cast("string")).alias("instruction"))
    return chat.branches(first, second, third)


@query("with c as (select row_number() over (order by doc_id) - 1 as c, text from (select * from documents order by doc_id limit 20)) select i, slot, text as context from range(9) r(i), range(5) s(slot) join c on c = (i * 5 + slot) % 20")
def rotating_contexts(spark, d):
    contexts = tokens.positional(_docs(spark, d).select("doc_id", "text"), "doc_id", 20).select(F.col("pos").alias("i"), F.col("text").alias("context"))
    return chat.context_windows(spark.range(9).withColumnRenamed("id", "i"), contexts, 20).withColumn("slot", F.col("slot").cast("long"))


@query("with j as (select id, unnest(from_json(body, '[{\"instruction\":\"VARCHAR\",\"response\":\"VARCHAR\"}]')) as x, generate_subscripts(from_json(body, '[{\"instruction\":\"VARCHAR\",\"response\":\"VARCHAR\"}]'), 1) - 1 as i from (select doc_id as id, '[{\"instruction\": \"' || lang || '\", \"response\": \"' || source || '\"}, {\"instruction\": \"\", \"response\": \"x\"}]' as body from documents)) select id, i, x.instruction as instruction, x.response as response from j where x.instruction <> '' and x.response <> ''")
def teacher_pair_parse(spark, d):
    reply = F.format_string('Here they are: [{"instruction": "%s", "response": "%s"}, {"instruction": "", "response": "x"}] Done.', F.col("lang"), F.col("source"))
    return evaluation.parse_pairs(_docs(spark, d).select(F.col("doc_id").alias("id"), reply.alias("reply"))).withColumn("i", F.col("i").cast("long"))


@query(f"with {QUEUE}, p as (select id, 'reviewed' as status, (id % 5 + 1)::int as fluency, (id % 3 + 1)::int as correctness, 'better ' || id as correction, 'note ' || id as notes from queue where id % 4 = 0 union all select id, 'pending', 9, 9, 'x', 'y' from queue where id % 4 = 1) select q.id, coalesce(p.status, q.status) as status, p.fluency, p.correctness, coalesce(p.correction, '') as correction, coalesce(p.notes, '') as notes from queue q left join p on p.id = q.id and p.status <> 'pending'")
def output_review_merge(spark, d):
    none = F.lit(None).cast("int")
    queue = _queue(spark, d)[0].withColumns({"fluency": none, "correctness": none, "correction": F.lit(""), "notes": F.lit("")})
    done = F.col("id") % 4 == 0
    said = lambda word: F.concat(F.lit(word), F.col("id").cast("string"))
    rated = {"status": F.when(done, "reviewed").otherwise("pending"), "fluency": F.when(done, F.col("id") % 5 + 1).otherwise(9).cast("int"), "correctness": F.when(done, F.col("id") % 3 + 1).otherwise(9).cast("int"), "correction": F.when(done, said("better ")).otherwise("x"), "notes": F.when(done, said("note ")).otherwise("y")}
    prior = queue.filter("id % 4 < 2").withColumns(rated)
    return chat.merge_output_reviews(queue, prior).select("id", "status", "fluency", "correctness", "correction", "notes")


@query("select s.turn + s.conv_id * 1000 as id, s.text as source, t.text as target from conversations s join conversations t on t.conv_id = s.conv_id and t.turn = s.turn + 1 where s.role = 'user' order by id limit 100")
def aligned_pairs(spark, d):
    rows = table(spark, d, "conversations")
    key = lambda k: (F.col("conv_id") * 1000 + F.col("turn") - k).alias("id")
    return evaluation.aligned(rows.filter("role = 'user'").select(key(0), "text"), rows.select(key(1), "text"), 100)


@query("select doc_id as id, lang || chr(10) || 'Answer:' as prompt, (doc_id % 6)::int as gold from documents where doc_id % 6 < 4")
def letter_items(spark, d):
    letter = F.concat(F.lit(" "), F.substring(F.lit("abcdxy"), (F.col("doc_id") % 6 + 1).cast("int"), F.lit(1)))
    rows = _docs(spark, d).select(F.col("doc_id").alias("id"), F.col("lang").alias("question"), letter.alias("answer"), *(F.lit(x).alias(f"option_{x}") for x in "abcd"))
    return evaluation.letter_items(rows).select("id", "prompt", "gold")


@query("select item_id as id, text || chr(10) || 'Question: which' || chr(10) || 'Answer:' as prompt, (item_id % 4)::int as gold from benchmark")
def passage_items(spark, d):
    rows = table(spark, d, "benchmark").select(F.col("item_id").alias("id"), F.col("text").alias("passage"), F.lit("which").alias("question"), (F.col("item_id") % 4 + 1).alias("number"), *(F.lit(str(i)).alias(f"answer{i}") for i in range(1, 5)))
    return evaluation.passage_items(rows).select("id", "prompt", "gold")


@query("with s as (select doc_id // 4 as item, doc_id % 4 as idx, (n_chars % 97)::double as score from documents), c as (select item, arg_max(idx, (score, -idx)) as choice from s group by 1) select item, choice = item % 4 as correct from c")
def choice_verdicts(spark, d):
    s = _docs(spark, d).select(F.floor(F.col("doc_id") / 4).cast("long").alias("item"), (F.col("doc_id") % 4).alias("idx"), (F.col("n_chars") % 97).cast("double").alias("score"))
    return evaluation.verdicts(s, s.select(F.col("item").alias("id")).distinct().withColumn("gold", F.col("id") % 4))


class _LengthScorer:
    """A stand-in for a model: what it says follows from lengths, so SQL can say the same."""

    def continuations(self, rows):
        c = F.col("continuation")
        return rows.withColumns({"logprob": -(F.length(c) * 1.0 + F.length("prompt") % 5), "n_tokens": F.size(X.blank_words(c)).cast("long")})


@query(
    rf"""with o as (select doc_id as id, lang || ':' as prompt, unnest([lang, source || ' ' || lang, '', coalesce(text, '')]) as option, unnest([0, 1, 2, 3]) as idx, doc_id % 4 as gold from documents where lang is not null and source is not null),
 c as (select *, ' ' || regexp_replace(option, '^\s+|\s+$', '', 'g') as k from o),
 r as (select id, gold, idx, case when len({WS % 'k'}) > 0 then -(length(k)::double + length(prompt) % 5) / len({WS % 'k'}) else '-infinity'::double end as score from c)
 select id, arg_max(idx, (score, -idx)) = any_value(gold) as correct from r group by id"""
)
def benchmark_choices(spark, d):
    none = F.coalesce("text", F.lit(""))
    options = F.array("lang", F.concat("source", F.lit(" "), "lang"), F.lit(""), none)
    items = _docs(spark, d).filter("lang is not null and source is not null").select(F.col("doc_id").alias("id"), F.concat("lang", F.lit(":")).alias("prompt"), options.alias("options"), (F.col("doc_id") % 4).alias("gold"))
    return benchmarks.choices(_LengthScorer(), items)


@query(
    f"""with {NORM}, w as (select lang, unnest({WS % 't'}) as token from norm), base as (select token, row_number() over (order by token) - 1 as id from (select distinct token from w where lang = 'en')),
 novel as (select token from (select distinct token from w where lang = 'de' and token not in (select token from base)) order by token limit 100)
 select token, id from base union all select token, row_number() over (order by token) - 1 + (select count(*) from base) from novel"""
)
def vocabulary_extension(spark, d):
    docs = clean.normalized(_docs(spark, d))
    words = tokens.vocabulary(docs.filter("lang = 'en'"))
    base = clean.running_total(spark, words.withColumn("one", F.lit(1)), "token", "one", "id").select("token", "id")
    return tokens.extension(base, tokens.novel_tokens(tokens.vocabulary(docs.filter("lang = 'de'")), base, 100))


@query("select html as text, 'fineweb2' as source, url from pages where html <> ''")
def hub_documents(spark, d):
    rows = table(spark, d, "pages").select(F.col("html").alias("text"), "url")
    return remote.hub_documents(rows, "fineweb2", {}).select("text", "source", F.try_element_at("meta", F.lit("url")).alias("url"))


@query("select id, target from (select conv_id * 1000 + turn as id, coalesce(nullif(case when role = 'assistant' then text when turn % 2 = 0 then '' end, ''), case turn % 3 when 0 then role when 1 then null else text end, '') as target from conversations) where target <> ''")
def smol_targets(spark, d):
    turn, text = F.col("turn"), F.col("text")
    many = F.when(turn % 3 == 0, F.array("role", "text")).when(turn % 3 == 1, F.array().cast("array<string>")).otherwise(F.array("text"))
    one = F.when(F.col("role") == "assistant", text).when(turn % 2 == 0, "")
    rows = table(spark, d, "conversations").select((F.col("conv_id") * 1000 + turn).alias("id"), one.alias("trg"), many.alias("trgs"))
    return rows.select("id", smol_target().alias("target")).filter("target <> ''")


@query(f"with {CLEAN}, tk as (select doc_id, unnest(list_append({WS % 't'}, '</s>')) as token, generate_subscripts(list_append({WS % 't'}, '</s>'), 1) as i from kept where t <> ''), placed as (select token, row_number() over (order by doc_id, i) - 1 as pos from tk) select pos // 128 as block, string_agg(token, ' ' order by pos) as tokens from placed where pos // 128 < 88 group by 1 having count(*) = 128")
def budgeted_packing(spark, d):
    blocks = tokens.packed(spark, clean.cleaned(spark, _docs(spark, d)), 128, tokens.block_budget(10, 2, 4))
    return blocks.select("block", F.array_join("tokens", " ").alias("tokens"))


@query("select doc_id, lang || 'یک' || source || '0123' || doc_id as text from documents")
def script_rules(spark, d):
    made = F.concat("lang", F.lit("يكـ"), "source", F.lit("٠١٢۳"), F.col("doc_id").cast("string"))
    return _docs(spark, d).select("doc_id", X.normalize(made, digits=True, rules=("persian_yeh_kaf",)).alias("text"))


# a tatweel and two non-joiners go, a presentation form becomes its letters, a control goes
@query("select doc_id, lang || 'کی' || chr(8204) || 'ی' || source || 'لا' || doc_id as text from documents")
def more_script_rules(spark, d):
    made = F.concat("lang", F.lit("ك\u0640ي\u200c\u200cي"), "source", F.lit("\ufefb\x07"), F.col("doc_id").cast("string"))
    rules = ("sorani_arabic", "arabic_presentation_forms", "kurdish_latin", "welsh_digraphs")
    return _docs(spark, d).select("doc_id", X.normalize(made, rules=rules).alias("text"))


@query(
    r"""with s as (select doc_id, list_filter(list_transform(regexp_split_to_array(regexp_replace(text, '([.!?])[ \t\n\x0B\f\r]+', '\1' || chr(1), 'g'), '[\x01\n]+'), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') as ss from documents)
 select doc_id, unnest(ss) as sentence, generate_subscripts(ss, 1)::int - 1 as place from s"""
)
def sentence_rows(spark, d):
    return tables.with_sentences(_docs(spark, d))


# ---- licences
#: Licences that the documents' corpora of two are said to have, by doc_id.
_LICENCES = ("CC-BY-4.0", "CC-BY-SA-4.0", "CC0-1.0", "pd", "CC-BY-SA-3.0", "CC-BY-NC-4.0", "mit", "mixed", "Apache-2.0", None, "unknown")
_PROV = f"(select doc_id // 2 as corpus, source, [{', '.join('null' if x is None else repr(x) for x in _LICENCES)}][1 + doc_id % {len(_LICENCES)}] as license from documents) v"


def _provenance(spark: SparkSession, d: str) -> DataFrame:
    license_ = F.get(F.array(*map(F.lit, _LICENCES)), (F.col("doc_id") % len(_LICENCES)).cast("int"))
    return table(spark, d, "documents").select(F.floor(F.col("doc_id") / 2).alias("corpus"), "source", license_.alias("license"))


_in = lambda xs: "('" + "', '".join(xs) + "')"


@query(
    f"""with p as (select corpus, license, lower(trim(license)) as id from {_PROV}),
 g as (select corpus, count(distinct id) filter (where license <> '') as n, count(*) filter (where id in {_in(licensing.BLOCKED)}) as blocked, count(distinct id) filter (where id in {_in(licensing.SHARE_ALIKE)}) as sa, min(license) filter (where id in {_in(licensing.SHARE_ALIKE)}) as alike,
  count(distinct id) filter (where id in {_in(licensing.PUBLIC_DOMAIN)}) as pd, count(distinct id) filter (where license <> '' and id not in {_in(licensing.BLOCKED + licensing.SHARE_ALIKE + licensing.PUBLIC_DOMAIN + licensing.PERMISSIVE)}) as rest, coalesce(array_to_string(list_sort(list(distinct license) filter (where license <> '')), ', '), '') as names from p group by 1),
 o as (select *, case when blocked > 0 then 'blocked' when sa > 1 then 'conflict' when rest > 0 then 'unclassified' when sa = 1 then 'share_alike' when n > 0 and pd = n then 'public_domain' else 'permissive' end as outcome from g)
 select corpus, outcome, case outcome when 'share_alike' then alike when 'public_domain' then 'CC0-1.0' when 'permissive' then 'Multiple permissive licenses (' || names || ')' end as license from o"""
)
def license_resolution(spark, d):
    return licensing.resolution(_provenance(spark, d), "corpus")


@query(f"select corpus, source from {_PROV} where lower(coalesce(license, '')) in ('', 'unknown', 'unresolved')")
def unresolved_licenses(spark, d):
    return licensing.unresolved(_provenance(spark, d)).select("corpus", "source")


@query()
def html_main_text(spark, d):
    from weft.sources.files import extract

    return table(spark, d, "pages").select("page_id", extract(F.col("html")).alias("text"))


@query(f"select corpus, source, source || ' (' || license || ')' as line from {_PROV} where coalesce(license, '') <> ''")
def attribution_lines(spark, d):
    return licensing.attributions(_provenance(spark, d).withColumn("url", F.lit(None).cast("string")), "corpus")

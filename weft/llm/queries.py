"""The queries of this package and, where SQL can say the same, their SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.llm import ann, decontaminate, kmeans, linededup, lm, mixing, neardup, quality, repair, tokens, toxicity, warc
from weft.llm.common import OWN, table


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.scheduled(spark, docs).select("doc_id", "source", F.col(OWN + "block").alias("block"), F.col(OWN + "slot").alias("slot"), F.col(OWN + "position").alias("position"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encoded(spark, table(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, table(spark, sf_dir, "pages"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(spark, table(spark, sf_dir, "documents"))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(spark, table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(spark, table(spark, sf_dir, "documents"))


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(spark, table(spark, sf_dir, "embeddings"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.dedup_lines(spark, docs).select("doc_id", "text", F.col(OWN + "removed").alias("removed_lines"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.reports(spark, repair.damaged(table(spark, sf_dir, "conversations")))


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmeans.clusters(spark, table(spark, sf_dir, "embeddings"))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP10_SQL = """
with numbered as (
  select doc_id, i - 1 as pos, line from (
    select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as i
    from documents)
), dense as (
  select *, row_number() over (partition by doc_id order by pos) as spot
  from numbered where regexp_matches(line, '[^\\x20\\x09-\\x0D]')
), win as (
  select doc_id, spot, line as l1, lead(line, 1) over w as l2, lead(line, 2) over w as l3
  from dense window w as (partition by doc_id order by spot)
), later as (
  select doc_id, spot from (
    select doc_id, spot, row_number() over (partition by l1, l2, l3 order by doc_id, spot) as nth
    from win where l3 is not null) where nth > 1
), gone as (
  select distinct d.doc_id, d.pos from later l join dense d on d.doc_id = l.doc_id and d.spot between l.spot and l.spot + 2
), kept as (
  select n.doc_id, string_agg(n.line, chr(10) order by n.pos) filter (where g.pos is null) as text, count(g.pos) as removed_lines
  from numbered n left join gone g on n.doc_id = g.doc_id and n.pos = g.pos group by n.doc_id
)
select d.doc_id, case when d.text is null then null else coalesce(k.text, '') end as text,
       coalesce(k.removed_lines, 0) as removed_lines
from documents d left join kept k using (doc_id)
"""

OP3_SQL = """
with p as (
  select page_id, coalesce(html, '') as body, sha1(coalesce(html, '')) as payload_digest, strlen(coalesce(html, '')) as payload_bytes from pages
), m as (
  select *, max(page_id) over (partition by body) as top from p
)
select page_id, payload_bytes, payload_digest,
       case when payload_bytes >= 1000 and page_id <> top then 'revisit' else 'response' end as record_type,
       case when payload_bytes >= 1000 and page_id <> top then top end as refers_to
from m
"""



def _op11_sql() -> str:
    """Edits from the last row back to the first; y0 to y3 have the least (cost, letters, turns) after none, s, u, a."""
    state, said = ["y0", "y1", "y2", "y3"], [None, None, "user:", "assistant:"]
    gives, keeps = [2, 2, 3, 2], {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
    arc = lambda cost, letter, line, to: f"{{'c': {cost} + {to}.c, 'a': '{letter}' || {to}.a, 'r': {f'[{line}] || ' if line else ''}{to}.r}}"
    least = lambda *xs: f"list_min([{', '.join(xs)}])"
    rows = []
    for q in range(4):
        drop = arc(4, "D", None, state[q])
        keep = "case " + " ".join(f"when x.fault < 2 and left(x.role, 1) = '{r}' then {arc('3 * x.fault', 'K', "x.role || ':' || x.text", state[to[q]])}" for r, to in keeps.items() if q in to) + " end"
        name = f"case when x.fault < 2 then {arc('3 + 3 * x.fault', 'R', f"'{said[gives[q]]}' || x.text", state[gives[q]])} end"
        rows.append(f"{least(drop, keep, name)} as z{q}")
    return f"""
with recursive crc(t) as materialized (
  select list(v order by i) from (
    select i, list_reduce([i] || [0::bigint for b in range(8)], lambda c, b: case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end) as v
    from range(256) r(i))
), marked as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         xor(4294967295, list_reduce([4294967295::bigint] || list_transform(string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''), lambda c: ord(c)::bigint),
             lambda h, b: xor(crc.t[(xor(h, b) & 255) + 1], h >> 8))) % 20 as mark
  from conversations, crc
), damaged as (
  select conv_id, turn, case when mark = 4 then 'user' else role end as role,
         case mark when 1 then '' when 2 then translate(text, '.!?', '') else text end as text
  from marked, range(2) r(copy) where mark <> 0 and (copy = 0 or mark = 3)
), numbered as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, md5(text)) as i,
         rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as core
  from damaged
), faulty as (
  select *, core = '' as blank, core <> '' and row_number() over (partition by conv_id, role, text order by i) > 1 as again,
         left(lag(role) over (partition by conv_id order by i), 1) || left(role, 1) as two
  from numbered
), told as (
  select *, case when blank or again then 2 when right(core, 1) in ('.', '!', '?') then 0 else 1 end as fault from faulty
), convs as (
  select conv_id, list({{'role': role, 'text': text, 'fault': fault}} order by i) as rows,
         coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count_if(blank) as blank, count_if(again) as duplicate,
         count_if(fault = 1) as truncated, count_if(two not in ('su', 'ua', 'au')) as illegal
  from told group by conv_id
), back as (
  select conv_id, rows, len(rows) as i, {{'c': 0::bigint, 'a': '', 'r': []::varchar[]}} as y0, {{'c': 6::bigint, 'a': 'II', 'r': ['user:', 'assistant:']}} as y1,
         {{'c': 3::bigint, 'a': 'I', 'r': ['assistant:']}} as y2, {{'c': 0::bigint, 'a': '', 'r': []::varchar[]}} as y3
  from convs
  union all
  select conv_id, rows, i, {least('z0', arc(3, 'I', "'user:'", 'u'))}, {least('z1', arc(3, 'I', "'user:'", 'u'))}, u, a from (
    select *, {least('z2', arc(3, 'I', "'assistant:'", 'z3'))} as u, {least('z3', arc(3, 'I', "'user:'", 'z2'))} as a from (
      select conv_id, rows, i - 1 as i, {', '.join(rows)} from (select *, rows[i] as x from back where i > 0)))
)
select o.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
       coalesce(illegal, 0) as illegal, coalesce(y0.c, 0) as cost, coalesce(y0.a, '') as audit, sha256(coalesce(array_to_string(y0.r, chr(10)), '')) as repaired_sha256
from (select distinct conv_id from conversations) o
left join convs c on c.conv_id is not distinct from o.conv_id
left join back b on b.conv_id is not distinct from o.conv_id and b.i = 0
"""


def _op12_sql() -> str:
    """Five rounds written out; vectors as lists of integers."""
    far = "list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint"
    steps = []
    for r in range(6):
        steps.append(f"a{r} as materialized (select i, arg_min(number, (d, number)) as number, min(d) as d from (select v.i, c.number, {far} as d from v, c{r} c) group by i)")
        if r < 5:
            means = f"select number, n, list(floor_div order by p) as x from (select number, p, count(*) as n, floor(sum(e)::decimal(38, 0) / count(*))::bigint as floor_div from (select number, unnest(x) as e, generate_subscripts(x, 1) as p from a{r} join v using (i)) group by number, p) group by number, n"
            steps.append(f"c{r + 1} as materialized (select c.number, coalesce(m.x, c.x) as x from c{r} c left join ({means}) m on m.number = c.number)")
    return f"""
with v as materialized (
  select row_number() over () as i, vec_id, list_transform(embedding, lambda e: floor(256 * e::double)::bigint) as x from embeddings
  where len(embedding) = 64 and len(list_filter(embedding, lambda e: e is not null and isfinite(e))) = 64
), c0 as materialized (
  select row_number() over (order by h, x) - 1 as number, x from (select sha256('2:' || vec_id) as h, x from v order by h nulls last, x limit 40)
), {", ".join(steps)}
select vec_id, number::int as cluster, d as distance, (sum(d) over (partition by number))::bigint as cluster_inertia, (sum(d) over ())::bigint as inertia,
       sha256(array_to_string(c.x, ',')) as centroid_sha256
from a5 join v using (i) join c5 c using (number)
"""


OP13_SQL = r"""
with docs as materialized (
  select row_number() over () as d, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws
  from documents
), items as materialized (
  select item_id::varchar as item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws
  from benchmark where text is not null
), wins as materialized (
  select distinct item, k, array_to_string(ws[i : i + k - 1], ' ') as w
  from (select *, least(10, len(ws)) as k, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) as i from items where len(ws) > 0)
), seen as (
  select d, k, i, array_to_string(ws[i : i + k - 1], ' ') as w
  from (select d, ws, k, unnest(range(1, len(ws) - k + 2)) as i from docs, (select distinct k from wins))
), hits as materialized (
  select d, k, i, item from seen join wins using (k, w)
), words as (
  select d, count(distinct p) as n_hit from (select d, unnest(range(i, i + k)) as p from (select distinct d, k, i from hits)) group by d
), found as (
  select d, count(*) as n_items, string_agg(item, ',' order by item) as names from (select distinct d, item from hits where item is not null) group by d
)
select doc_id, len(ws)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(names, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 as contaminated
from docs left join words using (d) left join found using (d)
"""

QUERIES = {
    "op1_mix_sources": op1_mix_sources,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_warc": op3_warc,
    "op4_token_counts": op4_token_counts,
    "op5_near_dedup": op5_near_dedup,
    "op6_quality_rules": op6_quality_rules,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_nearest_neighbours": op8_nearest_neighbours,
    "op9_toxicity": op9_toxicity,
    "op10_line_dedup": op10_line_dedup,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_centroid_clusters": op12_centroid_clusters,
    "op13_decontamination": op13_decontamination,
}
ORACLE_SQL = {"op3_warc": OP3_SQL, "op10_line_dedup": OP10_SQL, "op11_conversation_repair": _op11_sql(), "op12_centroid_clusters": _op12_sql(), "op13_decontamination": OP13_SQL}

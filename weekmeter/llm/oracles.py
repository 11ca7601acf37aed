"""SQL that gives the rows of those queries that SQL can express, written from their contracts."""

from __future__ import annotations

from weekmeter.llm.fim import ORACLE as FILL_IN_MIDDLE
from weekmeter.llm.line_dedup import ORACLE as LINES
from weekmeter.llm.mixing import ORACLE as MIXING

CHAT = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all
  select -7, * from (values (0, 'user', '\### Assistant: </turn> ok'), (1, 'assistant', '\### Assistant: </turn> ok'))),
measured as (
  select *, list_sum([0] || list_transform(regexp_extract_all(role, '\\|#{3,}|</turn>|:'),
                     lambda x: case when x[1] = '#' then length(x) else 1 end)) as role_escapes,
         list_sum([0] || list_transform(regexp_extract_all(text, '\\|#{3,}|</turn>'),
                  lambda x: case when x[1] = '#' then length(x) else 1 end)) as text_escapes
  from turns)
select conv_id::bigint as conv_id, count(*)::bigint as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role)) as turns_sha256,
       coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn) filter (role = 'assistant'), '')) as loss_sha256,
       sum(length(role) + length(text) + role_escapes + text_escapes + length('### : </turn>') + 1)::bigint as formatted_chars
from measured group by conv_id
"""

SUBSTRINGS = r"""
with word as (
  select doc_id, unnest(w) as word, generate_subscripts(w, 1) as place
  from (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents)),
spelled as (
  select doc_id, place,
         string_agg(word, ' ') over (partition by doc_id order by place rows between current row and 19 following) as words,
         count(*) over (partition by doc_id order by place rows between current row and 19 following) as n
  from word),
later as (
  select doc_id, place
  from (select doc_id, place, row_number() over (partition by words order by doc_id, place) as nth from spelled where n = 20)
  where nth > 1),
gone as (select distinct doc_id, unnest(range(place, place + 20)) as place from later),
judged as (
  select w.doc_id, w.place, w.word, g.place is not null as covered
  from word w left join gone g on g.doc_id = w.doc_id and g.place = w.place)
select d.doc_id, count(j.place)::bigint as n_words, (count(*) filter (covered))::bigint as n_removed,
       sha256(coalesce(string_agg(word, ' ' order by place) filter (not covered), '')) as kept_sha256
from documents d left join judged j using (doc_id) group by d.doc_id
"""

WARC = r"""
with page as (
  select page_id, coalesce(html, '') as html, strlen(coalesce(html, '')) as size from pages),
kept as (select html, max(page_id) as response from page where size >= 1000 group by html)
select page_id, size::bigint as payload_bytes, sha1(html) as payload_digest,
       case when response <> page_id then 'revisit' else 'response' end as record_type,
       case when response <> page_id then response end as refers_to
from page left join kept using (html)
"""

JACCARD = r"""
with recursive word as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents),
shingle as (
  select distinct doc_id, array_to_string(w[k : k + 4], ' ') as s
  from (select doc_id, w, unnest(range(1, greatest(length(w) - 3, 2))) as k from word where length(w) > 0)),
size as (select doc_id, count(*) as n from shingle group by doc_id),
met as (
  select a.doc_id as a, b.doc_id as b, count(*) as common
  from shingle a join shingle b on a.s = b.s and a.doc_id <> b.doc_id group by all),
link as (
  select a, b from met join size x on x.doc_id = a join size y on y.doc_id = b
  where 100 * common >= 80 * (x.n + y.n - common)),
reached as (
  select a, b from link
  union
  select r.a, l.b from reached r join link l on l.a = r.b)
select d.doc_id, coalesce(n, 0)::bigint as n_shingles, least(d.doc_id, m) as component_id
from documents d left join size using (doc_id)
left join (select a as doc_id, min(b) as m from reached group by a) using (doc_id)
"""

SQL = {
    "op1_chat": CHAT,
    "op4_substring_dedup": SUBSTRINGS,
    "op5_warc": WARC,
    "op7_mixing": MIXING,
    "op8_ngram_join": JACCARD,
    "op11_line_dedup": LINES,
    "op12_fill_in_middle": FILL_IN_MIDDLE,
}

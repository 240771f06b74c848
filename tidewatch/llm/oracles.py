"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from tidewatch.llm.line_rules import BOILERPLATE, MIN_KEPT

_BOILERPLATE = " or ".join(f"contains(lower(l), '{p}')" for p in BOILERPLATE)

ORACLE_SQL = {
    "op3_quality_rules": rf"""
with d as (
  select row_number() over () rid, doc_id, coalesce(text, '') t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') w,
         string_split(coalesce(text, ''), chr(10)) ls
  from documents),
lines as (
  select rid, i, l, len(list_filter(string_split_regex(l, '[\x20\x09-\x0D]+'), lambda x: x <> '')) n
  from (select rid, unnest(ls) l, generate_subscripts(ls, 1) i from d)),
judged as (
  select *, n > 0 and (
      (n >= 4 and not contains('.!?…。:;,', right(rtrim(l, '"''”’»)] '), 1)))
      or len(regexp_extract_all(l, '[#*$%&|<>]|!!')) > n * cast(0.1 as double)
      or len(regexp_extract_all(regexp_replace(l, '([\s])', '\1\1', 'g'), '(^|\s)[|>/](\s|$)')) > 2
      or {_BOILERPLATE}) bad
  from lines),
per_line as (
  select rid, count(*) filter (where n > 0) - count(distinct l) filter (where n > 0) n_dup,
         count(*) filter (where bad) removed,
         coalesce(string_agg(l, chr(10) order by i) filter (where not bad), '') cleaned
  from judged group by rid),
windows as (
  select rid, i, array_to_string(w[i:i+4], ' ') g from (select rid, w, unnest(generate_series(1, len(w) - 4)) i from d where len(w) >= 5)),
repeated as (select rid, i from (select rid, i, count(*) over (partition by rid, g) c from windows) where c > 1),
covered as (select rid, count(distinct i + k) n from repeated, (select unnest(range(5)) k) group by rid),
base as (
  select d.rid, doc_id, cast(len(w) as bigint) n_words, cast(length(array_to_string(w, '')) as bigint) word_chars,
         cast(len(regexp_extract_all(t, '[#*$%&|<>]')) as bigint) n_symbols, cast(n_dup as bigint) n_dup_lines,
         cast(coalesce(covered.n, 0) as bigint) n_repeat_words, cast(removed as bigint) n_lines_removed,
         cast(length(regexp_replace(cleaned, '[\x20\x09-\x0D]+', '', 'g')) as bigint) kept_chars, sha256(cleaned) cleaned_sha256
  from d join per_line using (rid) left join covered using (rid))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
       not (n_words < 10 or 100 * n_repeat_words > 20 * n_words) and kept_chars >= word_chars * cast({MIN_KEPT} as double) as kept,
       n_lines_removed, kept_chars, cleaned_sha256
from base
""",
    "op6_chat_format": r"""
with t as (
  select conv_id, turn, coalesce(role, '') r, coalesce(text, '') x from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e as (
  select *, replace(replace(x, '\', '\b'), '<', '\l') ex, replace(replace(replace(r, '\', '\b'), '<', '\l'), '>', '\g') er from t)
select conv_id, count(*) n_turns,
       sha256(string_agg(r || chr(10) || x || chr(10), '' order by turn, r, x)) turns_sha256,
       cast(coalesce(sum(length(x)) filter (where r = 'assistant'), 0) as bigint) loss_chars,
       sha256(coalesce(string_agg(x, '' order by turn, r, x) filter (where r = 'assistant'), '')) loss_sha256,
       cast(sum(length(er) + length(ex) + 15) as bigint) formatted_chars
from e group by conv_id
""",
    "op11_divergence": r"""
with d as (
  select row_number() over () rid, coalesce(lang, '') lang, coalesce(source, '') source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') ts
  from documents),
groups as (select distinct lang, source from d),
per_doc as (select rid, lang, source, t, count(*) n from (select rid, lang, source, unnest(ts) t from d) group by all),
kept as (select lang, t, sum(n) whole from per_doc group by lang, t having count(*) >= 30),
counts as (select lang, source, t, sum(n) n from per_doc semi join kept using (lang, t) group by all),
v as (select lang, count(*) v, sum(whole) total from kept group by lang),
totals as (
  select g.lang, g.source, coalesce(any_value(v.v), 0) v, coalesce(any_value(v.total), 0) lang_total, coalesce(sum(c.n), 0) total
  from groups g left join v on v.lang = g.lang left join counts c on c.lang = g.lang and c.source = g.source group by g.lang, g.source),
p as (
  select x.lang, x.source, k.t, coalesce(c.n, 0) n,
         1 + 1000000000::hugeint * (coalesce(c.n, 0) + 5) // (x.total + 5 * x.v) p,
         1 + 1000000000::hugeint * (k.whole + 5) // (x.lang_total + 5 * x.v) q
  from totals x join kept k on k.lang = x.lang left join counts c on c.lang = x.lang and c.source = x.source and c.t = k.t),
pairs as (
  select g.lang, g.source, 'pair' part, o.source item,
         coalesce((select sum(abs(a.p - b.p)) from p a join p b on a.lang = b.lang and a.t = b.t
                   where a.lang = g.lang and a.source = g.source and b.source = o.source), 0) as value
  from groups g join groups o on o.lang = g.lang and o.source <> g.source),
terms as (select lang, source, 'term' part, t item, p - q as value from p where n > 0 and p > q),
ranked as (
  select *, row_number() over (partition by lang, source, part order by value desc, encode(item)) r
  from (select * from pairs union all select * from terms))
select lang, source, part, item, cast(value as bigint) as value, cast(r as integer) as rank
from ranked where part = 'pair' or r <= 50
""",
}

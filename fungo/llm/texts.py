"""DuckDB texts of the corpus queries."""

from __future__ import annotations

HOST_RULES = r"""
with d as (
  select row_number() over () as r, doc_id, source, coalesce(text, '') as t from documents
), w as (
  select *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls
  from d
), starts as (
  select r, ws, unnest(range(0, len(ws) - 4)) as i from w where len(ws) >= 5
), grams as (
  select r, i, count(*) over (partition by r, ws[i + 1], ws[i + 2], ws[i + 3], ws[i + 4], ws[i + 5]) as c
  from starts
), covered as (
  select r, sum(step)::bigint as n from (
    select r, least(5, coalesce(lead(i) over (partition by r order by i) - i, 5)) as step
    from grams where c > 1
  ) group by r
), s as (
  select w.r, doc_id, source, len(ws) as n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) as word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as n_symbols,
    len(ls) as n_lines, len(ls) - len(list_distinct(ls)) as n_dup_lines,
    coalesce(covered.n, 0) as n_repeat_words
  from w left join covered on w.r = covered.r
), b as (
  select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from s
), hosts as (
  select source, rule, count(*) as n, sum(f::int)::double as f from (
    select source, unnest(['a', 'b', 'c', 'd']) as rule, unnest([n_words < 10,
      100 * n_repeat_words > 20 * n_words, 10 * n_symbols > word_chars, 10 * n_dup_lines > 3 * n_lines]) as f
    from b
  ) group by all
), m as (select rule, sum(f) / sum(n) as mean from hosts group by rule
), v as (
  select rule, any_value(mean) as mean, case when count(*) > 1 then
      count(*) * sum(n * (f / n - mean) ** 2) / ((count(*) - 1) * sum(n)) end as spread,
    any_value(mean) * (1 - any_value(mean)) * sum(1.0 / n) / count(*) as noise
  from hosts join m using (rule) group by rule
), bad as (
  select source, bool_or(case when spread > noise then
      (f + mean * greatest(mean * (1 - mean) - spread, 0) / (spread - noise))
      / (n + greatest(mean * (1 - mean) - spread, 0) / (spread - noise)) else mean end > 0.5) as host_failed
  from hosts join v using (rule) group by source
)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
  n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words, base_failed,
  not (base_failed or host_failed) as kept
from b join bad on b.source is not distinct from bad.source
"""

ORACLE = {"op6_host_rules": HOST_RULES}

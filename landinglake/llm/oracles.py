"""DuckDB SQL for the operators that SQL can express on small tables; another way each time."""

from __future__ import annotations

from landinglake.llm import quality_risk, secret_scan

_SPACES = r"[\x20\x09-\x0D]+"


def _words(text: str) -> str:
    return f"[x for x in string_split_regex(coalesce({text}, ''), '{_SPACES}') if x <> '']"


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NGRAM_JOIN = f"""
with recursive w as (select doc_id, {_words(_LOWER)} as words from documents),
sh as (select distinct doc_id, array_to_string(words[i:i+4], ' ') as s from (
    select doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) as i
    from w where len(words) > 0)),
n as (select doc_id, count(*) as n from sh group by doc_id),
pairs as (select a.doc_id as x, b.doc_id as y, count(*) as c
    from sh a join sh b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
links as (select x, y from pairs join n nx on nx.doc_id = x join n ny on ny.doc_id = y
    where 100 * c >= 75 * (nx.n + ny.n - c)),
edges as (select x, y from links union all select y, x from links),
reach(doc_id, node) as (select doc_id, doc_id from documents
    union select r.doc_id, e.y from reach r join edges e on e.x = r.node)
select doc_id, coalesce(any_value(n.n), 0) as n_shingles, min(node) as component_id
from reach left join n using (doc_id) group by doc_id"""

SUBSTRINGS = f"""
with w as (select doc_id, {_words('text')} as words from documents),
win as (select doc_id, i, array_to_string(words[i:i+49], ' ') as win from (
    select doc_id, words, unnest(range(1, len(words) - 48)) as i from w where len(words) >= 50)),
firsts as (select win, min(doc_id) as first_doc from win group by win),
covered as (select distinct doc_id, unnest(range(i, i + 50)) as pos
    from win join firsts using (win) where first_doc < doc_id),
each as (select doc_id, generate_subscripts(words, 1) as pos, unnest(words) as word from w),
kept as (select e.doc_id, string_agg(e.word, ' ' order by e.pos) as kept_text, count(*) as n
    from each e anti join covered c on c.doc_id = e.doc_id and c.pos = e.pos group by e.doc_id)
select w.doc_id, cast(len(words) as bigint) as n_words,
  cast(len(words) - coalesce(n, 0) as bigint) as n_removed,
  sha256(coalesce(kept_text, '')) as kept_sha256
from w left join kept using (doc_id)"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _kind(number: int) -> str:
    name, pattern, group, least = secret_scan.KINDS[number]
    pattern = _quoted(pattern)
    return f"""
    select doc_id, source, text, {number} as kind_no, '{name}' as kind,
      unnest(regexp_extract_all(text, {pattern}, 0)) as whole,
      unnest(regexp_extract_all(text, {pattern}, {group})) as value,
      unnest([length(x) for x in string_split_regex(text, {pattern})]) as gap,
      generate_subscripts(string_split_regex(text, {pattern}), 1) as nth, {least} as least
    from documents"""


SECRETS = f"""
with each as ({' union all '.join(map(_kind, range(len(secret_scan.KINDS))))}),
placed as (select *, cast(sum(gap + length(whole)) over (
      partition by doc_id, kind_no order by nth) as bigint) as stop from each where whole is not null),
around as (select *, substr(text, greatest(start - {secret_scan.CONTEXT}, prior) + 1,
      least(start - prior, {secret_scan.CONTEXT})) as before,
      substr(text, stop + 1, least({secret_scan.CONTEXT}, next_start - stop)) as after
    from (select *, lag(stop, 1, 0) over each_kind as prior,
      lead(stop - length(whole), 1, length(text)) over each_kind as next_start
      from (select *, cast(stop - length(whole) as bigint) as start from placed)
      window each_kind as (partition by doc_id, kind_no order by nth))
    where length(value) >= least),
owned as (select value, count(distinct coalesce(source, '')) as owners,
      count(distinct doc_id) as repositories, count(distinct (before, after)) as contexts
    from around group by value),
judged as (select doc_id, kind_no, start,
      kind || ':' || start || ':' || stop as span,
      owners || '/' || repositories || '/' || contexts as copies,
      length(value) >= {secret_scan.LEAST_LIVE} and regexp_matches(value, '[0-9]')
        and regexp_matches(value, '[A-Za-z]')
        and not regexp_matches(value, {_quoted(secret_scan.MADE_UP)}) as random,
      least(owners, repositories, contexts) >= {secret_scan.EXAMPLE_OWNERS} as copied
    from around join owned using (value)),
spans as (select * from judged where kind_no < {len(secret_scan.BASE)} or random or not copied),
lists as (select doc_id, count_if(kind_no = 0) as n_assign, count_if(kind_no = 1) as n_access,
      count_if(kind_no = 2) as n_hex,
      string_agg(span, ',' order by start, kind_no) filter (kind_no < {len(secret_scan.BASE)}) as base,
      string_agg(span, ',' order by start, kind_no) as spans,
      string_agg(span, ',' order by start, kind_no) filter (random and not copied) as live,
      string_agg(span, ',' order by start, kind_no) filter (random and copied) as shared,
      string_agg(span, ',' order by start, kind_no) filter (not random and copied) as examples,
      string_agg(copies, ',' order by start, kind_no) as copies
    from spans group by doc_id)
select doc_id, cast(coalesce(n_assign, 0) as bigint) as n_assign,
  cast(coalesce(n_access, 0) as bigint) as n_access, cast(coalesce(n_hex, 0) as bigint) as n_hex,
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans,
  coalesce(live, '') as live, coalesce(shared, '') as shared, coalesce(examples, '') as examples,
  coalesce(copies, '') as copies
from documents left join lists using (doc_id)"""

_U, _LEVELS, _RISK = quality_risk.UNITS, list(quality_risk.LEVELS), quality_risk.RISK

QUALITY = f"""
with w as (select doc_id, lang, coalesce(text, '') as text, {_words('text')} as words,
      [x for x in string_split(coalesce(text, ''), chr(10))
       if regexp_matches(x, '[^\\x20\\x09-\\x0D]')] as lines from documents),
win as (select doc_id, i, array_to_string(words[i:i+4], ' ') as win from (
    select doc_id, words, unnest(range(1, len(words) - 3)) as i from w where len(words) >= 5)),
again as (select doc_id, win from win group by doc_id, win having count(*) > 1),
covered as (select doc_id, count(distinct pos) as n from (
    select doc_id, unnest(range(i, i + 5)) as pos from win semi join again using (doc_id, win))
    group by doc_id),
counted as (select doc_id, lang, text, cast(len(words) as bigint) as n_words,
      cast(length(array_to_string(words, '')) as bigint) as word_chars,
      cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
      length(regexp_replace(text, '[^A-Z]', '', 'g')) as n_capitals,
      length(regexp_replace(text, '[^!]', '', 'g')) as n_marks, len(lines) as n_lines,
      cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
      cast(coalesce(n, 0) as bigint) as n_repeat_words,
      len([i for i in range(2, len(words) + 1) if words[i] = words[i - 1]]) as n_doubled
    from w left join covered using (doc_id)),
scored as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed, greatest(
      coalesce(n_symbols / nullif(word_chars, 0) / {_U['symbols']}, 0),
      coalesce(n_capitals / nullif(word_chars, 0) / {_U['capitals']}, 0),
      coalesce(n_marks / nullif(n_words, 0) / {_U['marks']}, 0),
      coalesce(n_dup_lines / nullif(n_lines, 0) / {_U['lines']}, 0),
      coalesce(n_repeat_words / nullif(n_words, 0) / {_U['windows']}, 0),
      coalesce(n_doubled / nullif(n_words, 0) / {_U['doubled']}, 0)) as severity from counted),
levels as (select unnest({_LEVELS}) as level, unnest(range({len(_LEVELS)})) as step),
labelled as (select lang, any_value(severity) as severity, any_value(base_failed) as base_failed,
      min(q) > 0 as good, substr(md5(cast(min(doc_id) as varchar)), 1, 1) < '8' as certifies
    from scored join (select doc_id, min(quality) as q from labels group by doc_id)
      using (doc_id) where q is not null group by lang, text),
at_level as (select lang, good, certifies, step, level,
      not (not base_failed and not severity > level) as dropped from labelled, levels),
tested as (select lang, step, level, count_if(good and certifies) as n,
      count_if(good and certifies and dropped) as lost,
      coalesce(count_if(not good and not certifies and dropped)
        / nullif(count_if(not good and not certifies), 0), 0)
      - coalesce(count_if(good and not certifies and dropped)
        / nullif(count_if(good and not certifies), 0), 0) as gain
    from at_level group by all),
judged as (select *, case when lost > n * {_RISK} then false else list_sum([exp(lgamma(n + 1)
        - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({_RISK}) + (n - i) * ln(1 - {_RISK}))
        for i in range(0, cast(lost as bigint) + 1)]) <= {quality_risk.ERROR} / (select count(distinct coalesce(lang, '-'))
        from labelled) end as passed from tested),
certified as (select * from (select *, bool_and(passed) over (partition by lang order by step) as ok
    from judged) where ok),
chosen as (select lang, arg_max(level, gain * 1000000 - step / 1000) as cutoff, max(gain) as gain
    from certified group by lang)
select s.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and not coalesce(severity > cutoff and gain > 0, false) as kept
from scored s left join chosen c on s.lang is not distinct from c.lang"""

COVER_PAIRS = """
with recursive v as (select row_number() over () as row, vec_id, embedding::double[] as e
    from embeddings where embedding is not null and len(embedding) > 0
      and len([x for x in embedding if x is null or not isfinite(x)]) = 0
      and len([x for x in embedding if x <> 0]) > 0),
links as (select a.row as x, b.row as y from v a join v b
    on a.row <> b.row and len(a.e) = len(b.e) and list_cosine_similarity(a.e, b.e) >= 0.9),
reach(row, node) as (select row, row from v
    union select r.row, l.y from reach r join links l on l.x = r.node),
found as (select r.row, min(n.vec_id) as component_id from reach r join v n on n.row = r.node
    group by r.row),
counted as (select x as row, count(*) as n from links group by x),
sound as (select v.vec_id, coalesce(n, 0) as n_links, component_id
    from v join found using (row) left join counted using (row)),
unsound as (select vec_id, 0 as n_links, vec_id as component_id from embeddings
    where embedding is null or len(embedding) = 0
      or len([x for x in embedding if x is null or not isfinite(x)]) > 0
      or len([x for x in embedding if x <> 0]) = 0)
select vec_id, cast(n_links as bigint) as n_links, component_id,
  coalesce(vec_id = component_id, false) as kept
from (select * from sound union all select * from unsound)"""

FILTER_AUDIT = f"""
with d as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text,
    {_words('text')} as words from documents),
failing as (select doc_id, part,
      case when len(words) < 100 then 'A' else '' end
      || case when 100 * len(list_distinct(words)) < 80 * len(words) then 'B' else '' end
      || case when 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text)
        then 'C' else '' end
      || case when regexp_matches(text, '[#$%&*|]') then 'D' else '' end
      || case when doc_id > min(doc_id) over (partition by text) then 'E' else '' end as fails
    from d),
marks as (select doc_id, max(quality) = 1 as good, max(toxic) = 1 as toxic from labels
    group by doc_id),
counted as (select part, fails, count(*) as n, count_if(good) as good, count_if(toxic) as toxic
    from failing left join marks using (doc_id) group by part, fails),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
orders as (select a.x || b.x || c.x || d.x || e.x as filter_order
    from letters a join letters b on b.x <> a.x join letters c on c.x not in (a.x, b.x)
    join letters d on d.x not in (a.x, b.x, c.x) join letters e on e.x not in (a.x, b.x, c.x, d.x)),
steps as (select filter_order, step, filter_order[step] as filter, left(filter_order, step - 1) as before,
    left(filter_order, step) as upto from orders, (select unnest(range(1, 6)) as step)),
figures as (select part, filter_order, step, filter,
      sum(n) filter (translate(fails, upto, '') = fails) as kept,
      sum(n) filter (contains(fails, filter) and translate(fails, before, '') = fails) as removed,
      sum(n) filter (contains(fails, filter) and translate(fails, before, '') <> fails) as redundant,
      sum(n) filter (fails = filter) as unique_fails,
      sum(good) filter (contains(fails, filter) and translate(fails, before, '') = fails) as good_lost,
      sum(toxic) filter (contains(fails, filter) and translate(fails, before, '') = fails) as toxic_lost
    from counted cross join steps group by all)
select part, filter_order, cast(step as int) as step, filter,
  cast(coalesce(kept, 0) as bigint) as kept, cast(coalesce(removed, 0) as bigint) as removed,
  cast(coalesce(redundant, 0) as bigint) as redundant,
  cast(coalesce(unique_fails, 0) as bigint) as unique_fails,
  cast(coalesce(good_lost, 0) as bigint) as good_lost,
  cast(coalesce(toxic_lost, 0) as bigint) as toxic_lost,
  cast(coalesce(sum(removed) over (partition by part, filter), 0) as bigint) as shapley
from figures"""

ORACLES = {"op4_ngram_jaccard_join": NGRAM_JOIN, "op5_substring_dedup": SUBSTRINGS,
           "op6_secret_ownership": SECRETS, "op8_quality_risk": QUALITY,
           "op11_cover_tree_pairs": COVER_PAIRS, "op12_filter_interaction": FILTER_AUDIT}

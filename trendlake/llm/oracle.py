"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from trendlake.llm import collocations as co
from trendlake.llm import license_scan as ls
from trendlake.llm import perspectives as pv
from trendlake.llm import quality as q
from trendlake.llm import url_filter as uf
from trendlake.llm import warc

WORD = r"[^\x20\x09-\x0D]+"


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(str(x) if isinstance(x, int) else _text(x) for x in r) + ")" for r in rows)


OP1 = rf"""
with d as (select row_number() over () as rid, doc_id, source, coalesce(text, '') as text from documents),
w as (select rid, regexp_extract_all(text, '{WORD}') as w from d),
ln as (select rid, source, doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as pos from d),
lw as (select rid, source, pos, line, len(regexp_extract_all(line, '{WORD}')) as n,
              regexp_replace(regexp_replace(trim(lower(line), chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)),
                             '[\x20\x09-\x0D]+', ' ', 'g'), '[0-9]', '0', 'g') as norm
       from ln where regexp_matches(line, '[^\x20\x09-\x0D]')),
body as (select rid, md5(text) as body from d),
freq as (select source, norm from lw join body using (rid) group by source, norm having count(distinct body) > {q.MAX_DOCS}),
gone as (select rid, count(*) as lines, sum(n) as words from lw
         where exists (select 1 from freq f where f.norm = lw.norm and f.source is not distinct from lw.source) group by rid),
win as (select rid, i, array_to_string(w[i:i+{q.WINDOW - 1}], ' ') as x
        from (select rid, w, unnest(range(1, len(w) - {q.WINDOW} + 2)) as i from w)),
again as (select rid, i from win qualify count(*) over (partition by rid, x) > 1),
cover as (select rid, count(distinct i + k) as n from again, range({q.WINDOW}) t(k) group by rid),
dup as (select rid, count(*) - count(distinct line) as n from lw group by rid),
r as (select d.rid, d.doc_id, len(w.w)::bigint as n_words,
             length(array_to_string(w.w, ''))::bigint as word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
             coalesce(dup.n, 0)::bigint as n_dup_lines, coalesce(cover.n, 0)::bigint as n_repeat_words,
             coalesce(gone.lines, 0)::bigint as n_removed_lines,
             (len(w.w) - coalesce(gone.words, 0))::bigint as words_left
      from d join w using (rid) left join dup using (rid) left join cover using (rid) left join gone using (rid))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {q.MIN_WORDS} or 100 * n_repeat_words > {q.MAX_REPEAT_PERCENT} * n_words as base_failed,
       n_removed_lines, words_left,
       not (n_words < {q.MIN_WORDS} or 100 * n_repeat_words > {q.MAX_REPEAT_PERCENT} * n_words)
         and words_left >= {q.MIN_LEFT} * n_words as kept
from r
"""


OP4 = rf"""
with d as (select distinct conv_id, turn::bigint as turn, coalesce(role, 'unknown') as speaker, coalesce(text, '') as text from conversations),
o as (select *, row_number() over (partition by conv_id order by turn nulls first) - 1 as place from d),
q as (select *, place // {pv.PART} as part from o),
f as (select *, -1 as ord from q where speaker = '{pv.SYSTEM}' qualify row_number() over (partition by conv_id order by place) = 1),
t as (select conv_id, part, place as ord, speaker, text from q
      union all select f.conv_id, p.part, f.ord, f.speaker, f.text
      from f join (select distinct conv_id, part from q) p on f.conv_id is not distinct from p.conv_id and p.part > f.part),
people as (select distinct conv_id, speaker as perspective from d where speaker <> '{pv.SYSTEM}'),
x as (select t.conv_id, perspective, part, ord,
             case when speaker = '{pv.SYSTEM}' then '<|system|>' || chr(10) when speaker = perspective then '<|assistant|>' || chr(10)
                  else '<|user name=' || regexp_replace(replace(replace(regexp_replace(speaker, '<(\\*)\|', '<\\\1|', 'g'), chr(10), '\n'), chr(13), '\r'),
                                                        '\|(\\*)>', '|\\\1>', 'g') || '|>' || chr(10) end as head,
             regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') || '<|end|>' || chr(10) as body, speaker = perspective as own
      from t join people p on t.conv_id is not distinct from p.conv_id),
y as (select *, sum(length(head) + length(body)) over (partition by conv_id, perspective, part order by ord) - length(body) as a from x)
select conv_id, perspective, part::bigint as part, (part * {pv.PART})::bigint as first_turn, count(*)::bigint as n_turns,
       count(*) filter (own)::bigint as n_own, string_agg(head || body, '' order by ord) as rendered,
       coalesce(string_agg(a::varchar || ':' || (a + length(body))::varchar, ',' order by ord) filter (own), '') as mask,
       coalesce(sum(length(body)) filter (own), 0)::bigint as mask_chars
from y group by conv_id, perspective, part
"""

OP6 = f"""
with p as (select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as digest, strlen(coalesce(html, ''))::bigint as n from pages),
f as (select digest, max(page_id) as first from p where n >= {warc.REVISIT_BYTES} group by digest),
j as (select p.*, case when first is not null and page_id is distinct from first then first end as refers_to from p left join f on p.digest = f.digest and n >= {warc.REVISIT_BYTES})
select page_id, n as payload_bytes, digest as payload_digest, case when refers_to is null then 'response' else 'revisit' end as record_type,
       refers_to::bigint as refers_to, true as intact
from j
"""


def op9() -> str:
    paths = _values(uf.PATH_RULES)
    patterns = _values([(i, name, regex) for i, (name, _, regex) in enumerate(uf.PATTERN_RULES)])
    return rf"""
with p as (select row_number() over () as rid, page_id, url, coalesce(instr(url, '://'), 0) as pos from pages),
h as (select rid, page_id, translate(coalesce(url, ''), '{ls.UPPER}', '{ls.LOWER}') as low,
             case when pos = 0 then '' else regexp_extract(substr(url, pos + 3), '^[^/?#]*') end as raw,
             case when pos = 0 then '' else substr(url, pos + 3) end as rest from p),
s as (select rid, page_id, low, translate(raw, '{ls.UPPER}', '{ls.LOWER}') as host,
             regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') as path from h),
rules(action, rhost, rpath) as (values {paths}),
fit as (select rid, arg_max(rhost || rpath, length(rhost || rpath)) as rule, arg_max(action, length(rhost || rpath)) as action
        from s join rules on (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath) group by rid),
patterns(i, name, regex) as (values {patterns}),
hit as (select rid, arg_min(name, i) as pattern from s join patterns on regexp_matches(low, regex) group by rid)
select page_id, host, path, rule, coalesce(action, case when pattern is null then 'allow' else 'block' end) as verdict, pattern
from s left join fit using (rid) left join hit using (rid)
"""


def op10() -> str:
    table = _values(ls.rules())
    phrases = " union all ".join(
        f"select rid, unnest(list_filter(range(1, len(w) + 1), lambda i: {' and '.join(f'w[i + {k}] = {_text(x)}' for k, x in enumerate(p.split()))})) - 1 as st, {_text(label)} as label from w"
        for p, label in ls.PHRASES)
    weight = "case min(level) " + " ".join(f"when {n} then {w}" for n, w in ls.LEVEL_WEIGHTS.items()) + " end"
    return rf"""
with d as (select row_number() over () as rid, doc_id, translate(coalesce(text, ''), '{ls.UPPER}', '{ls.LOWER}') as t from documents),
w as (select rid, doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from d),
base as ({phrases}),
b as (select rid, count(*) as n, min(st) as first_word, max(st) as last_word, list(distinct label) as labels from base group by rid),
s as (select rid, ' ' || array_to_string(w, '  ') || ' ' as s from w),
rules(rule, level, label, key, regex) as (values {table}),
run as (select rid, rule, level, label, regexp_extract_all(s, regex) as m, string_split_regex(s, regex) as p
        from s join rules on contains(s, key) where regexp_matches(s, regex)),
piece as (select rid, rule, level, label, unnest(range(1, len(m) + 1)) as i, m, p from run),
found as (select rid, rule, level, label,
                 (list_sum([len(x) - len(replace(x, ' ', '')) for x in p[1:i]])
                  + coalesce(list_sum([len(x) - len(replace(x, ' ', '')) for x in m[1:i-1]]), 0)) // 2 as a,
                 (len(m[i]) - len(replace(m[i], ' ', ''))) // 2 as n from piece),
kept as (select * from found f where not exists (
           select 1 from found g where g.rid = f.rid and g.level <= f.level and g.a <= f.a and g.a + g.n >= f.a + f.n
             and (g.a, f.n, g.level, g.rule) <> (f.a, g.n, f.level, f.rule)
             and ((g.a <> f.a or g.n <> f.n) or (g.level, g.rule) < (f.level, f.rule)))),
k as (select rid, list(distinct label) as labels, {weight} as weight from kept where level > 0 group by rid)
select doc_id, len(w.w)::bigint as n_words, coalesce(b.n, 0)::bigint as n_base, first_word::bigint as first_word,
       last_word::bigint as last_word, array_to_string(list_sort(coalesce(b.labels, [])), ',') as base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(k.labels, [])))), ',') as labels,
       greatest(coalesce(weight, 0), case when b.n > 0 then {ls.LEVEL_WEIGHTS[3]} else 0 end)::double as score
from w left join b using (rid) left join k using (rid)
"""


OP12 = rf"""
with p as (select coalesce(lang, 'und') as lang,
                  unnest(string_split_regex(translate(coalesce(text, ''), '{ls.UPPER}', '{ls.LOWER}'), '[.,;:!?\x0A-\x0D]')) as piece from documents),
w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from p),
total as (select lang, sum(len(w)) as n from w group by lang),
s as (select lang, w, unnest(range(1, len(w) + 1)) as i from w),
f as (select lang, array_to_string(w[i:i + m - 1], ' ') as phrase, m, count(*) as a
      from s, range(1, {co.MAX_WORDS + 1}) t(m) where i + m - 1 <= len(w) group by all having count(*) >= {co.MIN_COUNT}),
cut as (select f.lang, f.phrase, f.m, f.a, n, k, x.a as l, y.a as r, (1000::hugeint * f.a * n) // (x.a::hugeint * y.a) as score
        from f join total using (lang), range(1, {co.MAX_WORDS}) t(k), f x, f y
        where k < f.m and x.lang = f.lang and y.lang = f.lang and x.phrase = array_to_string(string_split(f.phrase, ' ')[1:k], ' ')
          and y.phrase = array_to_string(string_split(f.phrase, ' ')[k + 1:], ' ')),
low as (select * from cut qualify row_number() over (partition by lang, phrase order by score, k) = 1),
kept as (select * from low where not exists (select 1 from f g where g.lang = low.lang and g.m > low.m and 100 * g.a >= {co.SUBSUMED_PERCENT} * low.a
                                               and contains(' ' || g.phrase || ' ', ' ' || low.phrase || ' ')))
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n::bigint as n, score::bigint as score
from kept qualify rank <= {co.LIMIT}
"""


def sql() -> dict[str, str]:
    return {"op1_line_frequency": OP1, "op4_perspectives": OP4, "op6_warc": OP6, "op9_url_filter": op9(), "op10_license_scan": op10(),
            "op12_collocations": OP12}

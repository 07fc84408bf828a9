"""DuckDB SQL for the queries of this subpackage that SQL can express, over whole tables."""

from __future__ import annotations

from lexforge.llm import bagminhash, quality_rules, spotsigs

_ANCHORS = ", ".join(f"'{w}'" for w in dict.fromkeys(spotsigs.ANCHORS))

_SPOTSIGS = f"""
with docs as (select doc_id, coalesce(text, '') as t from documents),
following as (select doc_id, t, coalesce(lead(t) over (order by doc_id, t), first_value(t) over (order by doc_id, t)) as n from docs),
texts as (select doc_id, t, n, left(t, length(t) - length(t) // 2) || left(n, length(t) // 2) as e from following),
kinds as (select t from texts union select e from texts union select n from texts),
words as (select t, [w for w in string_split(regexp_replace(lower(t), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'), ' ') if w <> ''] as w from kinds),
spots as (
    select t, [{{'h': case when i > 1 and w[i - 1] in ({_ANCHORS}) then w[i - 1] || chr(1) || w[i] else w[i] end, 'p': w[i], 'a': i > 1 and w[i - 1] in ({_ANCHORS})}}
               for i in range(1, len(w) + 1) if w[i] not in ({_ANCHORS})] as s
    from words
),
chains as (
    select t, list_sort(list_distinct([md5(s[i].h || ' ' || coalesce(s[i + 1].p, '') || ' ' || coalesce(s[i + 2].p, ''))[1:8]
               for i in range(1, len(s) + 1) if s[i].a or not list_bool_or([x.a for x in s])])) as s
    from spots
),
sets as (select x.doc_id, x.t, x.e, x.n, a.s, b.s as se, c.s as sn from texts x join chains a on a.t = x.t join chains b on b.t = x.e join chains c on c.t = x.n),
shared as (select *, len(list_intersect(s, se)) as ve, len(list_intersect(s, sn)) as vn from sets)
select doc_id, length(t) as n_chars, sha256(e) as edited_sha256, array_to_string(s, '') as fingerprint, array_to_string(se, '') as edited_fingerprint,
    case when len(s) + len(se) > 0 then ve / (len(s) + len(se) - ve) when t = e then 1.0 else 0.0 end as near_edited,
    case when len(s) + len(sn) > 0 then vn / (len(s) + len(sn) - vn) when t = n then 1.0 else 0.0 end as near_next
from shared
"""

_RATIOS = {
    "r_symbols": "n_symbols / greatest(n_words, 1)",
    "r_upper": "upper / greatest(word_chars, 1)",
    "r_exclaim": "exclaim / greatest(n_words, 1)",
    "r_adjacent": "adjacent / greatest(n_words, 1)",
    "r_repeat": "n_repeat_words / greatest(n_words, 1)",
    "r_dup_lines": "n_dup_lines / greatest(lines, 1)",
}
_GAMMA = repr(quality_rules.GAMMA)

_QUALITY = f"""
with docs as (select doc_id, lang, source, coalesce(text, '') as t from documents),
cut as (
    select doc_id, lang, source, t, [x for x in string_split_regex(t, '[\\x20\\x09-\\x0D]+') if x <> ''] as w,
        [x for x in string_split(t, chr(10)) if regexp_matches(x, '[^\\x20\\x09-\\x0D]')] as l
    from docs
),
windows as (select doc_id, unnest([{{'i': i, 'h': array_to_string(w[i:i + 7], ' ')}} for i in range(1, len(w) - 6)], recursive := true) from cut where len(w) >= 8),
twice as (select doc_id, i, lead(i) over (partition by doc_id order by i) as n from (select doc_id, i, count(*) over (partition by doc_id, h) as c from windows) where c > 1),
repeats as (select doc_id, sum(least(8, coalesce(n - i, 8)))::BIGINT as n_repeat_words from twice group by doc_id),
counts as (
    select c.doc_id, lang, source, len(w) as n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) as word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as n_symbols, len(l) - len(list_distinct(l)) as n_dup_lines, len(l) as lines,
        coalesce(n_repeat_words, 0) as n_repeat_words, length(regexp_replace(t, '[^!]', '', 'g')) as exclaim,
        length(regexp_replace(t, '\\P{{Lu}}', '', 'g')) as upper, len([i for i in range(2, len(w) + 1) if w[i] = w[i - 1]]) as adjacent
    from cut c left join repeats r on r.doc_id = c.doc_id
),
judged as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from counts),
ratios as (
    select doc_id, lang, source, base_failed, r.rule, r.x, r.slack
    from judged, lateral (select unnest([{', '.join(f"{{'rule': '{k}', 'x': {v}, 'slack': {quality_rules.SLACK[k]}}}" for k, v in _RATIOS.items())}]) as r)
),
buckets as (select lang, source, rule, slack, case when x <= {quality_rules.TINY} then -1000000 else ceil(ln(x) / {_GAMMA})::INT end as bucket from ratios where not base_failed),
levels as (
    select 0 as level, lang, source, rule, slack, bucket from buckets
    union all select 1, lang, null, rule, slack, bucket from buckets
    union all select 2, null, null, rule, slack, bucket from buckets
),
sketch as (select level, lang, source, rule, slack, bucket, count(*) as n from levels group by all),
sums as (
    select *, sum(n) over (partition by level, lang, source, rule) as total, sum(n) over (partition by level, lang, source, rule order by bucket) as below,
        case when bucket = -1000000 then 0.0 else 2 * exp(bucket * {_GAMMA}) / (1 + exp({_GAMMA})) end as v
    from sketch
),
quartiles as (select level, lang, source, rule, slack, max(total) as docs, min(v) filter (below >= 0.25 * total) as q25, min(v) filter (below >= 0.75 * total) as q75 from sums group by all),
fences as (select level, lang, source, rule, docs, q75 + {quality_rules.SPREAD} * (q75 - q25) + slack as most from quartiles),
within as (
    select r.doc_id, bool_and(coalesce(r.x <= case when g.docs >= {quality_rules.MIN_DOCS} then g.most when l.docs >= {quality_rules.MIN_DOCS} then l.most when g.docs is not null then a.most end, false)) as fits
    from ratios r
    left join fences g on g.level = 0 and g.rule = r.rule and g.lang is not distinct from r.lang and g.source is not distinct from r.source
    left join fences l on l.level = 1 and l.rule = r.rule and l.lang is not distinct from r.lang
    left join fences a on a.level = 2 and a.rule = r.rule
    group by r.doc_id
)
select j.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and fits as kept from judged j join within w on w.doc_id = j.doc_id
"""

_NEAR = f"""
with recursive texts as (select coalesce(text, '') as t, min(doc_id) as d from documents group by 1),
words as (select d, [w for w in string_split_regex(lower(t), '\\s+') if w <> ''] as w from texts),
shingles as (select d, unnest([array_to_string(w[i:i + {bagminhash.SHINGLE - 1}], ' ') for i in range(1, greatest(len(w) - {bagminhash.SHINGLE - 2}, 2))]) as s from words where len(w) > 0),
bags as (select d, s, count(*) as n from shingles group by d, s),
sizes as (select d, sum(n) as size from bags group by d),
shared as (select a.d as x, b.d as y, sum(least(a.n, b.n)) as n from bags a join bags b on a.s = b.s and a.d < b.d group by 1, 2),
links as (select x, y from shared join sizes a on a.d = x join sizes b on b.d = y where n / (a.size + b.size - n) >= {bagminhash.THRESHOLD}),
edges as (select x, y from links union select y, x from links),
reach(d, r) as (select d, d from texts union select reach.d, edges.y from reach join edges on edges.x = reach.r),
classes as (select d, min(r) as class_id from reach group by d)
select doc_id, class_id from documents join texts on coalesce(text, '') = t join classes on classes.d = texts.d
"""

ORACLE: dict[str, str] = {"op2_adaptive_quality_rules": _QUALITY, "op8_bagminhash_near_dedup": _NEAR, "op10_spotsigs": _SPOTSIGS}

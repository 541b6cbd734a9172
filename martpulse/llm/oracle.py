"""SQL twins of the queries for text corpora, as DuckDB runs them over the same tables."""

from __future__ import annotations

SQL: dict[str, str] = {}

SQL["op5_mixing"] = r"""
with docs as (
    select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint size,
           ('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 4))::int % 256 block
    from documents
), classed as (
    select *, length(bin(size)) * 8 + (size >> greatest(length(bin(size)) - 3, 0))::int class from docs
), sources as (
    select source, sum(size)::bigint source_size from docs group by source
), caps as (
    select *, 2.0::double * source_size cap,
           [3.0::double, 1.0, 2.0][(row_number() over (order by source nulls last) - 1) % 3 + 1] weight
    from sources
), filled as (
    select *, cap / weight fill from caps
), levels as (
    select *, (1.5::double * sum(source_size) over ()
               - coalesce(sum(cap) over (order by fill, source nulls last rows between unbounded preceding and 1 preceding), 0))
              / sum(weight) over (order by fill, source nulls last rows between current row and unbounded following) as level
    from filled
), water as (
    select arg_min(level, (fill, source)) found from levels where level <= fill
), aims as (
    select source, source_size, coalesce(least(cap, found * weight), cap) target from levels, water
), ranked as (
    select d.*, row_number() over (partition by source order by class, block, size, doc_id) as place from classed d
), steps as (
    select r.doc_id, r.size, a.source_size, a.target, r.place,
           case when a.source_size = 0 then 0.0::double else a.target / a.source_size end rate,
           ('0x' || substr(md5('7:' || coalesce(r.source, chr(0))), 1, 4))::int / 65536.0::double u
    from ranked r join aims a on r.source is not distinct from a.source
)
select doc_id, size, source_size, target,
       (floor(rate * place + u) - floor(rate * (place - 1) + u))::bigint * size taken,
       (floor(rate * place + u) - floor(rate * (place - 1) + u))::bigint copies
from steps
"""

SQL["op6_warc"] = r"""
with hashed as (
    select page_id, encode(coalesce(html, '')) payload from pages
), sized as (
    select page_id, octet_length(payload)::bigint payload_bytes, sha1(payload) payload_digest from hashed
), firsts as (
    select *, max(page_id) over (partition by payload_digest) as first from sized
)
select page_id, payload_bytes, payload_digest,
       case when payload_bytes >= 1000 and page_id <> first then 'revisit' else 'response' end record_type,
       case when payload_bytes >= 1000 and page_id <> first then first end refers_to,
       true as intact
from firsts
"""

SQL["op7_line_dedup"] = r"""
with split as (
    select doc_id, text, string_split(text, chr(10)) parts from documents
), lines as (
    select doc_id, pos, parts[pos] line,
           string_split_regex(regexp_replace(parts[pos], '^\s+|\s+$', '', 'g'), '\s+') w
    from split, unnest(range(1, len(parts) + 1)) as p(pos)
), judged as (
    select *, case when w = [''] then 0 else len(w) end n, row_number() over (order by doc_id, pos) place from lines
), firsts as (
    select w, n, min(place) place from judged where n >= 1 group by w, n
), variants as (
    select place, n, w v, 0 gap from firsts where n >= 5
    union all
    select place, n, list_concat(w[:gap - 1], w[gap + 1:]) v, gap
    from firsts, unnest(range(1, n + 1)) as g(gap) where n >= 5
), near as (
    select b.place from variants a join variants b on a.v = b.v and a.place < b.place
    where (a.gap = b.gap and a.gap > 0) or (a.gap = 0) <> (b.gap = 0)
), kept as (
    select j.doc_id, j.pos, j.line from judged j
    where j.n = 0 or (j.place in (select place from firsts) and j.place not in (select place from near))
), built as (
    select doc_id, count(*) n, string_agg(line, chr(10) order by pos) as text from kept group by doc_id
)
select s.doc_id, len(s.parts)::bigint n_lines, (len(s.parts) - coalesce(b.n, 0))::bigint n_removed,
       coalesce(b.text, '') as text
from split s left join built b using (doc_id)
"""

SQL["op10_chat"] = r"""
with turns as (
    select conv_id, turn, case when coalesce(role, '') = '' then 'unknown'
               else regexp_replace(replace(role, '<|', '< |'), '[\x00-\x1F\x7F\x{85}\x{2028}\x{2029}]', ' ', 'g') end speaker,
           replace(coalesce(text, ''), '<|', '< |') said
    from conversations
), ranked as (
    select *, row_number() over (partition by conv_id order by turn nulls first, speaker, said) - 1 as place from turns
), led as (
    select *, place < 64 and bool_and(speaker = 'system') over (partition by conv_id order by place) as leads,
           max(place) over (partition by conv_id) // 64 as last_part
    from ranked
), parts as (
    select conv_id, place // 64 part, place, speaker, said, false as again from led
    union all
    select conv_id, unnest(range(1, last_part + 1)), place, speaker, said, true from led where leads
), people as (
    select distinct conv_id, speaker participant from turns where speaker <> 'system'
), pieces as (
    select r.conv_id, p.participant, r.part, r.place, r.again, r.speaker = p.participant own,
           case when r.speaker = p.participant then '<|im_start|>assistant' || chr(10)
                when r.speaker = 'system' then '<|im_start|>system' || chr(10)
                else '<|im_start|>user name=' || r.speaker || chr(10) end head,
           r.said || '<|im_end|>' || chr(10) body
    from parts r join people p on r.conv_id is not distinct from p.conv_id
), placed as (
    select *, sum(length(head) + length(body)) over (partition by conv_id, participant, part order by place) as ends
    from pieces
)
select conv_id, participant, part, (count(*) filter (where not again))::int turns, (count(*) filter (where again))::int carried,
       string_agg(head || body, '' order by place) as text,
       coalesce(string_agg((ends - length(body))::bigint || '-' || ends::bigint, ',' order by place) filter (where own), '') mask
from placed group by conv_id, participant, part
"""

SQL["op9_jaccard_join"] = r"""
with recursive docs as (
    select doc_id, [w for w in string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') if w <> ''] w
    from documents
), sets as (
    select doc_id, list_distinct([w[i:i + least(3, len(w)) - 1] for i in range(1, len(w) - least(3, len(w)) + 2)]) s
    from docs where len(w) > 0
), tokens as (
    select doc_id, len(s) n, unnest(s) t from sets
), pairs as (
    select a.doc_id a, b.doc_id b, count(*) both_have, any_value(a.n) + any_value(b.n) as total
    from tokens a join tokens b on a.t = b.t and a.doc_id <> b.doc_id group by 1, 2
), links as (
    select a, b from pairs where 100 * both_have >= 90 * (total - both_have)
), reach as (
    select doc_id node, doc_id root from documents
    union
    select l.b, r.root from reach r join links l on l.a = r.node
)
select d.doc_id, coalesce(s.n, 0)::bigint n_shingles, c.component_id
from documents d left join (select doc_id, len(s) n from sets) s using (doc_id)
join (select node, min(root) component_id from reach group by node) c on c.node = d.doc_id
"""

_SOUND = "embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0"

_NEAREST = r"""
    select vec_id, part, arg_min(entry, (dist, entry)) entry, min(dist)::bigint dist
    from (select k.vec_id, k.part, b.entry, sum((k.x - b.c) * (k.x - b.c)) dist
          from cells k join {books} b on k.part = b.part and k.d = b.d group by 1, 2, 3)
    group by 1, 2
"""

_MOVED = r"""
    select b.part, b.entry, b.d, coalesce(floor(s.total::double / s.n)::bigint, b.c) c
    from {books} b left join (
        select a.part, a.entry, k.d, sum(k.x) total, count(*) n
        from {near} a join cells k on a.vec_id = k.vec_id and a.part = k.part group by all
    ) s on b.part = s.part and b.entry = s.entry and b.d = s.d
"""

SQL["op11_vector_codes"] = f"""
with kept as materialized (
    select vec_id, label, [floor(256 * x::double)::bigint for x in embedding] v from embeddings where {_SOUND}
), size as (
    select (max(len(v)) + 15) // 16 width from kept
), cells as materialized (
    select vec_id, (i - 1) // width part, (i - 1) % width d, coalesce(v[i], 0) x
    from kept, size, unnest(range(1, width * 16 + 1)) p(i)
), books0 as materialized (
    select part, entry, d, x c from cells
    join (select vec_id, row_number() over (order by vec_id) - 1 entry from kept order by vec_id limit 64) using (vec_id)
), near0 as materialized ({_NEAREST.format(books="books0")}
), books1 as materialized ({_MOVED.format(books="books0", near="near0")}
), near1 as materialized ({_NEAREST.format(books="books1")}
), books2 as materialized ({_MOVED.format(books="books1", near="near1")}
), near2 as materialized ({_NEAREST.format(books="books2")}
), coded as (
    select vec_id, string_agg(format('{{:02x}}', entry), '' order by part) code, sum(dist)::bigint error from near2 group by vec_id
)
select vec_id, code, error, (sum(error) over (partition by label))::bigint label_error,
       (select sha256(string_agg(c::varchar, ',' order by part, entry, d)) from books2) codebooks_sha256
from coded join kept using (vec_id)
"""

SQL["op12_phrases"] = r"""
with pieces as (
    select coalesce(lang, 'und') lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) piece
    from documents
), worded as (
    select lang, [x for x in string_split_regex(piece, '[\x20\x09]+') if x <> ''] w from pieces
), grams as materialized (
    select lang, k words, array_to_string(w[i:i + k - 1], ' ') phrase, count(*) f
    from worded, unnest([1, 2, 3, 4]) s(k), unnest(range(1, len(w) - k + 2)) p(i) group by all having count(*) >= 30
), totals as (
    select lang, sum(len(w))::bigint n from worded group by lang
), found as materialized (
    select lang, words, phrase, f a, string_split(phrase, ' ') w from grams where words > 1
), halves as materialized (
    select lang, phrase, words, a, k, array_to_string(w[:k], ' ') lhs, array_to_string(w[k + 1:], ' ') rhs
    from found, unnest(range(1, words)) s(k)
), cut as (
    select h.lang, h.phrase, h.words, a, k, l.f l, r.f r, 2000000::hugeint * a // (l.f::hugeint + r.f) score
    from halves h join grams l on l.lang = h.lang and l.phrase = h.lhs join grams r on r.lang = h.lang and r.phrase = h.rhs
), best as (
    select * from cut qualify row_number() over (partition by lang, phrase order by score, k) = 1
), inside as (
    select lang, array_to_string(w[i:i + k - 1], ' ') phrase, max(a) longer
    from found, unnest(range(2, words)) s(k), unnest(range(1, words - k + 2)) p(i) group by all
), kept as (
    select b.* from best b left join inside i on b.lang = i.lang and b.phrase = i.phrase
    where i.longer is null or 100::hugeint * i.longer < 80::hugeint * b.a
)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n,
       score::bigint score
from kept join totals using (lang)
qualify rank <= 2000
"""

SQL["op13_search"] = f"""
with kept as (
    select vec_id, [floor(256 * x::double) for x in embedding] v from embeddings where {_SOUND}
), scored as (
    select q.vec_id query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint score
    from kept q join kept c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id
)
select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score
from scored qualify rank <= 5
"""

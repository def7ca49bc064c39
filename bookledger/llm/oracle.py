"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

OP1 = """
with rows as (
    select page_id, coalesce(html, '') as payload from pages
), tops as (
    select payload, max(page_id) as top from rows group by payload
), hashed as (
    select page_id, top, strlen(payload) as payload_bytes, sha1(payload) as hex from rows join tops using (payload)
)
select page_id,
       payload_bytes::bigint as payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           (((('0x' || substr(hex, (5 * (i // 4) + 1)::int, 5))::int) >> (15 - 5 * (i % 4))::int) & 31) + 1, 1)),
           'string_agg', '') as payload_digest,
       case when top is null or page_id is not distinct from top then 'response' else 'revisit' end as record_type,
       case when page_id is distinct from top and top is not null then top end as refers_to
from hashed
"""

_WORDS = (
    "list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    r"'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"
)

OP2 = f"""
with item_words as (
    select coalesce(item_id::varchar, 'null') as item, {_WORDS} as words from benchmark
), windows as (
    select distinct item, words[s:s + 12] as terms
    from item_words, unnest(range(1, greatest(len(words) - 12, 1) + 1)) as t(s)
    where len(words) > 0
), doc_words as (
    select doc_id, {_WORDS} as words from documents
), lengths as (
    select distinct len(terms) as n from windows
), grams as (
    select doc_id, s, n, words[s:s + n - 1] as terms
    from doc_words, lengths, unnest(range(1, len(words) - n + 2)) as t(s)
), found as (
    select doc_id, s, n, item from grams join windows using (terms)
), hits as (
    select doc_id, count(distinct p) as n_hit from found, unnest(range(s, s + n)) as t(p) group by doc_id
), named as (
    select doc_id, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as items
    from found group by doc_id
)
select doc_id,
       len(words)::bigint as n_words,
       coalesce(n_hit, 0)::bigint as n_hit,
       coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(items, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(words) as contaminated
from doc_words left join hits using (doc_id) left join named using (doc_id)
"""

def _later_units(name: str, ends: str) -> str:
    """Every unit between the characters ``ends``, with what it repeats."""
    return rf"""
{name}_pieces as (
    select doc, unnest(list) as piece, generate_subscripts(list, 1) as k from (
        select coalesce(doc_id, 9223372036854775807) as doc,
               regexp_extract_all(coalesce(text, ''), '[^{ends}]+|[{ends}]+') as list
        from documents)
), {name}_placed as (
    select doc, piece, k, sum(length(piece)) over (partition by doc order by k) - length(piece) as place from {name}_pieces
), {name}_units as (
    select doc, k,
           array_to_string(list_filter(string_split_regex(lower(piece), '\s+'), lambda w: w <> ''), ' ') as unit,
           (place + length(piece) - length(regexp_replace(piece, '^\s+', '')))::bigint as start,
           (place + length(regexp_replace(piece, '\s+$', '')))::bigint as stop
    from {name}_placed where regexp_matches(piece, '[^\s{ends}]')
), {name}_later as (
    select *, first <> doc or same > 1 as gone from (
        select *, len(string_split(unit, ' ')) as words, row_number() over (partition by doc order by k) as nth,
               row_number() over (partition by doc, unit order by k) as same,
               min(doc) over (partition by unit) as first
        from {name}_units)
)"""


PASSAGES = r"""
passages as (
    select doc, min(start) as start, max(stop) as stop, sum(words)::bigint as n_words, count(*)::bigint as n_units,
           nullif(arg_min(first, nth), 9223372036854775807) as first_doc_id
    from (select *, nth - row_number() over (partition by doc order by nth) as run from clause_later where gone)
    group by doc, run having sum(words) >= 20
)"""

OP3_PASSAGES = f"""
with {_later_units("clause", r"\n.,;:!?")}, {PASSAGES}
select nullif(doc, 9223372036854775807) as doc_id, start, stop as "end", n_words, n_units, first_doc_id from passages
"""

OP3 = f"""
with {_later_units("line", r"\n")}, {_later_units("clause", r"\n.,;:!?")}, {PASSAGES},
lines as (
    select doc, count(*) as n_units, count(*) filter (gone) as n_removed,
           string_agg(start || ':' || stop, ',' order by k) filter (gone) as removed,
           string_agg(md5(unit), '' order by k) filter (not gone) as staying
    from line_later group by doc
), runs as (
    select doc, string_agg(start || ':' || stop || ':' || coalesce(first_doc_id::varchar, '-'), ',' order by start) as passages
    from passages group by doc
)
select d.doc_id,
       coalesce(n_units, 0)::bigint as n_units,
       coalesce(n_removed, 0)::bigint as n_removed,
       coalesce(removed, '') as removed,
       sha256(coalesce(staying, '')) as kept_sha256,
       coalesce(passages, '') as passages,
       passages is not null as repeats_passage
from documents d
left join lines on lines.doc = coalesce(d.doc_id, 9223372036854775807)
left join runs on runs.doc = coalesce(d.doc_id, 9223372036854775807)
"""


def _kind(number: int, pattern: str, group: int, least: int) -> str:
    return f"""
    select doc_id, source, {number} as kind, stop - length(match) as start, stop, secret from (
        select doc_id, source, match, secret,
               sum(length(gap) + length(match)) over (partition by doc_id order by k) as stop
        from (
            select doc_id, source,
                   unnest(regexp_extract_all(text, {pattern}, 0)) as match,
                   unnest(regexp_extract_all(text, {pattern}, {group})) as secret,
                   unnest(string_split_regex(text, {pattern})[1:len(regexp_extract_all(text, {pattern}, 0))]) as gap,
                   generate_subscripts(regexp_extract_all(text, {pattern}, 0), 1) as k
            from texts where regexp_matches(text, {pattern})
        )
    ) where length(secret) >= {least}"""


_ASSIGN = (
    r"""'((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)'"""
)

OP4 = f"""
with texts as (
    select doc_id, coalesce(source, '') as source, coalesce(text, '') as text from documents
), base as (
    {_kind(0, _ASSIGN, 2, 12)}
    union all {_kind(1, "'AKIA[A-Z0-9]{14,}'", 0, 18)}
    union all {_kind(2, "'[0-9a-f]{16,}'", 0, 16)}
), owned as (
    select secret, count(distinct source) as owners, count(distinct (source, doc_id)) as repositories from base group by secret
), added as (
    select distinct doc_id, case when owners >= 3 then 4 else 3 end as kind, stop - length(secret) as start, stop,
           owners || ':' || repositories as ownership
    from base join owned using (secret)
    where owners >= 3
       or len(list_distinct(string_split(secret, ''))) >= 6
          and not regexp_matches(secret, '(?i)example|sample|dummy|changeme|placeholder|xxxx|your_|your-')
), named as (
    select doc_id, kind, start, ['assign', 'access', 'hex', 'live', 'copied'][kind + 1] || ':' || start || ':' || stop as span, ownership
    from (select doc_id, kind, start, stop, null as ownership from base union all select * from added)
), per_doc as (
    select doc_id,
           count(*) filter (kind = 0) as n_assign,
           count(*) filter (kind = 1) as n_access,
           count(*) filter (kind = 2) as n_hex,
           string_agg(span, ',' order by start, kind) filter (kind < 3) as base,
           string_agg(span, ',' order by start, kind) as spans,
           count(*) filter (kind = 3) as n_live,
           count(*) filter (kind = 4) as n_copied,
           string_agg(ownership, ',' order by start, kind) filter (kind = 3) as live_ownership
    from named group by doc_id
)
select doc_id,
       coalesce(n_assign, 0)::bigint as n_assign,
       coalesce(n_access, 0)::bigint as n_access,
       coalesce(n_hex, 0)::bigint as n_hex,
       sha256(coalesce(base, '')) as base_sha256,
       coalesce(spans, '') as spans,
       coalesce(n_live, 0)::bigint as n_live,
       coalesce(n_copied, 0)::bigint as n_copied,
       coalesce(live_ownership, '') as live_ownership
from documents left join per_doc using (doc_id)
"""

OP5 = r"""
with rows as (
    select doc_id, length(coalesce(text, '')) as n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as content
    from documents
), groups as (
    select content, count(*) as group_size, max(n) as most, min(doc_id) filter (n = m) as keep_id
    from (select *, max(n) over (partition by content) as m from rows) group by content
)
select doc_id, keep_id, group_size::bigint as group_size,
       doc_id is not distinct from keep_id and n = most as kept,
       sha256(content) as text_sha256
from rows join groups using (content)
"""

_ESCAPED = r"replace(replace(replace(replace({}, '\', '\\'), '<', '\l'), '[', '\b'), '|', '\p')"

OP8 = f"""
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all
    select -7, unnest([0, 1]), unnest(['user', 'assistant']), '</s>[INST] ok [/INST]'
), shown as (
    select *, {_ESCAPED.format("text")} as body,
           case role when 'system' then '<<SYS>>' || '<</SYS>>' when 'user' then '<s>[INST] ' || ' [/INST]'
                when 'assistant' then '</s>' else '<|' || {_ESCAPED.format("role")} || '|>' || '<|end|>' end as marks
    from turns
)
select conv_id,
       count(*)::bigint as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
       sum(length(body) + length(marks))::bigint as formatted_chars
from shown group by conv_id
"""



def _code(column: str) -> str:
    return f"coalesce(strlen({column}::varchar) || ':' || {column}::varchar, '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(_code(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"


# crc32 has no function here: bit by bit, eight steps for each digit of the id.
_CRC = (
    "list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)), "
    "lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(0, 8)), "
    "lambda v, step: case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end))"
)

OP11 = f"""
with recursive leaves as (
    select doc_id, source, {_leaf("text")} as leaf,
           case when doc_id is not null and xor({_CRC}, 4294967295) % 5 = 0
                then {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} end as other
    from documents
), ranked as (
    select *, row_number() over (order by source nulls first, doc_id nulls first, leaf) as nth,
           row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as place,
           count(*) over (partition by source) as n
    from leaves
), nodes as (
    select source, 0 as level, place, leaf as digest, n from ranked
    union all
    select source, level + 1, place // 16, sha256(string_agg(digest, '' order by place)), (n + 15) // 16
    from nodes where n > 1 group by source, level, place // 16, n
), subroots as (
    select source, digest as subroot, row_number() over (order by source nulls first) - 1 as place, count(*) over () as n
    from nodes where n = 1
), tops as (
    select 0 as level, place, subroot as digest, n from subroots
    union all
    select level + 1, place // 16, sha256(string_agg(digest, '' order by place)), (n + 15) // 16
    from tops where n > 1 group by level, place // 16, n
), beside as (
    select source, level, place, false as upper_tree,
           coalesce(string_agg(digest, '') over (partition by source, level, place // 16 order by place
               rows between unbounded preceding and 1 preceding), '') as before,
           coalesce(string_agg(digest, '') over (partition by source, level, place // 16 order by place
               rows between 1 following and unbounded following), '') as after
    from nodes where n > 1
    union all
    select null, level, place, true,
           coalesce(string_agg(digest, '') over (partition by level, place // 16 order by place
               rows between unbounded preceding and 1 preceding), ''),
           coalesce(string_agg(digest, '') over (partition by level, place // 16 order by place
               rows between 1 following and unbounded following), '')
    from tops where n > 1
), inside as (
    select nth, source, 0 as level, place, coalesce(other, leaf) as known, '' as proof from ranked
    union all
    select i.nth, i.source, i.level + 1, i.place // 16, sha256(before || known || after), proof || before || after
    from inside i join beside b on not b.upper_tree and b.source is not distinct from i.source and b.level = i.level and b.place = i.place
), climbed as (
    select nth, arg_max(known, level) as known, arg_max(proof, level) as proof from inside group by nth
), outside as (
    select nth, 0 as level, s.place, known, proof
    from climbed join ranked using (nth) join subroots s on s.source is not distinct from ranked.source
    union all
    select o.nth, o.level + 1, o.place // 16, sha256(before || known || after), proof || before || after
    from outside o join beside b on b.upper_tree and b.level = o.level and b.place = o.place
), folded as (
    select nth, arg_max(known, level) as folded_root, sha256(arg_max(proof, level)) as proof_sha256 from outside group by nth
)
select doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root as verified
from ranked join folded using (nth) join subroots s on s.source is not distinct from ranked.source,
     (select digest as root from tops where n = 1)
"""


def _codes(rounds: int = 4, entries: int = 256) -> str:
    """One assignment and one update a round, a last assignment, all by full search."""
    steps = [f"""
with kept as materialized (
    select vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as v from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), sized as (
    select *, row_number() over (order by vec_id nulls last, v) as row, len(v) // 4 as width from kept
), parts as materialized (
    select row, vec_id, label, p, v[p * width + 1:(p + 1) * width] as x from sized, range(0, 4) as t(p)
), book0 as materialized (
    select p, row - 1 as entry, x as e from parts where row <= {entries}
)"""]
    for n in range(rounds + 1):
        steps.append(f""", near{n} as materialized (
    select row, p, arg_min(entry, (d, entry)) as entry, min(d) as d from (
        select row, parts.p, entry, list_sum(list_transform(list_zip(x, e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint as d
        from parts join book{n} using (p)
    ) group by row, p
)""")
        if n < rounds:
            steps.append(f""", mean{n} as (
    select p, entry, list(m order by i) as e from (
        select p, entry, i, (s - ((s % c) + c) % c) // c as m from (
            select p, entry, i, sum(x[i])::bigint as s, count(*) as c
            from near{n} join parts using (row, p), unnest(range(1, len(x) + 1)) as t(i) group by p, entry, i
        )
    ) group by p, entry
), book{n + 1} as materialized (
    select p, entry, coalesce(mean{n}.e, book{n}.e) as e from book{n} left join mean{n} using (p, entry)
)""")
    return "".join(steps) + f""", coded as (
    select row, string_agg(printf('%02x', entry), '' order by p) as code, sum(d)::bigint as error from near{rounds} group by row
)
select vec_id, code, error, sum(error) over (partition by label)::bigint as label_error,
       (select sha256(string_agg(array_to_string(e, ','), ',' order by p, entry)) from book{rounds}) as codebooks_sha256
from sized join coded using (row)
"""


OP12 = _codes()

SQL = {
    "op1_warc": OP1,
    "op2_benchmark_decontamination": OP2,
    "op3_substring_dedup": OP3,
    "op3_passages": OP3_PASSAGES,
    "op4_secret_scan": OP4,
    "op5_exact_dedup": OP5,
    "op8_chat_format": OP8,
    "op11_merkle_manifest": OP11,
    "op12_vector_codes": OP12,
}

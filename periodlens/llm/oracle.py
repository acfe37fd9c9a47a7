"""DuckDB SQL for those queries of ``queries`` that SQL can express."""

ORACLE = {}

ORACLE["op8_url_filter"] = r"""
with rules(rule_host, rule_path, rule, verdict) as (values
    ('net', '/', 'net/', 'block'), ('example.net', '/en/', 'example.net/en/', 'allow'),
    ('example.com', '/de/', 'example.com/de/', 'block'), ('org', '/fr/', 'org/fr/', 'allow')),
parts as (
    select row_number() over () as rid, page_id,
        translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path
    from pages),
ranked as (
    select p.*, r.rule, r.verdict,
        row_number() over (partition by p.rid order by length(r.rule) desc, r.rule desc) as k
    from parts p left join rules r
        on (p.host = r.rule_host or ends_with(p.host, '.' || r.rule_host)) and starts_with(p.path, r.rule_path))
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from ranked where k = 1
"""

ORACLE["op2_document_fingerprints"] = r"""
with ordered as (
    select row_number() over (order by doc_id, coalesce(text, '')) as rid, doc_id, coalesce(text, '') as text,
        lead(coalesce(text, '')) over (order by doc_id, coalesce(text, '')) as follows,
        first_value(coalesce(text, '')) over (order by doc_id, coalesce(text, '')) as opening
    from documents),
edits as (
    select rid, doc_id, text, length(text) as n_chars,
        substr(text, 1, length(text) - length(text) // 2)
            || substr(coalesce(follows, opening), 1, length(text) // 2) as edited
    from ordered),
versions as (select rid, 0 as k, text as t from edits union all select rid, 1, edited from edits),
pieces as (
    select rid, k, unnest(string_split(regexp_replace(t, '([.!?])[ \t]+', '\1' || chr(10), 'g'), chr(10))) as p
    from versions),
hashes as (select rid, k, sha256(p) as h from pieces where p <> ''),
filled as (
    select v.rid, v.k, count(h) as n, [%LANES%]::bigint[] as v
    from versions v left join hashes using (rid, k) group by v.rid, v.k),
shown as (
    select *, lower(lpad(to_hex(n), 8, '0')) || array_to_string(
        list_transform(v, lambda x: lower(lpad(to_hex(x), 4, '0'))), '') as fp from filled),
paired as (
    select e.rid, e.doc_id, e.n_chars, sha256(e.edited) as edited_sha256, a.fp as fingerprint, b.fp as edited_fingerprint,
        a.n as n0, a.v as v0, b.n as n1, b.v as v1, c.n as n2, c.v as v2
    from edits e
    join shown a on a.rid = e.rid and a.k = 0
    join shown b on b.rid = e.rid and b.k = 1
    join shown c on c.rid = e.rid % (select count(*) from edits) + 1 and c.k = 0),
sides as (
    select rid, 1 as side, n0 as na, v0 as a, n1 as nb, v1 as b from paired
    union all select rid, 2, n0, v0, n2, v2 from paired),
spread as (
    select rid, side, na, nb, a = b and na = nb as same,
        list_sum(list_transform(range(1, 65), lambda i: pow(
            ((a[i] - b[i] + 32768 + 65536) % 65536) - 32768 - (na - nb) * 7.5, 2))) / (64 * 21.25) as s
    from sides),
common as (
    select rid, side, same, na + nb as total,
        (na + nb - least(greatest(s, abs(na - nb)), na + nb)) / 2.0 as c
    from spread),
likes as (
    select rid, side, case when same then 1.0::double
        else round((c / greatest(total - c, 1.0))::double, 6) end as likeness
    from common)
select p.doc_id, p.n_chars, p.edited_sha256, p.fingerprint, p.edited_fingerprint,
    x.likeness as near_edited, y.likeness as near_next
from paired p
join likes x on x.rid = p.rid and x.side = 1
join likes y on y.rid = p.rid and y.side = 2
""".replace("%LANES%", ", ".join(
    f"coalesce(sum(instr('0123456789abcdef', substr(h, {i}, 1)) - 1), 0) % 65536" for i in range(1, 65)))

ORACLE["op5_benchmark_decontamination"] = r"""
with texts as (
    select 0 as kind, doc_id as id, text from documents
    union all select 1, item_id, text from benchmark),
words as (
    select kind, id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') as w from texts),
shingles as (
    select distinct kind, id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) as s
    from words where len(w) >= 5),
sizes as (select id, count(*) as n from shingles where kind = 1 group by id),
shared as (
    select d.id as doc_id, i.id as item_id, count(*) as k
    from shingles d join shingles i on d.s = i.s and d.kind = 0 and i.kind = 1 group by d.id, i.id)
select doc_id, item_id, k::int as n_shared, n::int as n_shingles, round(k / n, 6) as containment
from shared join sizes on sizes.id = item_id where 100 * k >= 80 * n
"""

ORACLE["op12_exact_dedup"] = r"""
with texts as (
    select row_number() over () as rid, doc_id, length(coalesce(text, '')) as n,
        regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') as norm
    from documents),
ranked as (
    select *, row_number() over w as k, first_value(doc_id) over w as keep_id, count(*) over (partition by norm) as group_size
    from texts window w as (partition by norm order by n desc, doc_id nulls last, rid))
select doc_id, keep_id, group_size, k = 1 as kept, sha256(norm) as text_sha256 from ranked
"""

ORACLE["op13_source_divergence"] = r"""
with docs as (
    select row_number() over () as rid, coalesce(lang, '') as lang, coalesce(source, '') as source,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
    from documents),
words as (
    select rid, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from docs),
kept as (select lang, term from words group by lang, term having count(distinct rid) >= 30),
sizes as (select lang, count(*) as v from kept group by lang),
counts as (select lang, source, term, count(*) as n from words join kept using (lang, term) group by lang, source, term),
pairs as (select distinct lang, source from docs),
dense as (
    select p.lang, p.source, k.term, coalesce(c.n, 0) as n
    from pairs p join kept k using (lang) left join counts c on c.lang = p.lang and c.source = p.source and c.term = k.term),
totals as (select lang, source, sum(n) as total from dense group by lang, source),
shares as (
    select d.lang, d.source, d.term, d.n,
        1 + (1000000000::hugeint * (d.n + 5)) // (t.total + 5 * s.v)::hugeint as p
    from dense d join totals t using (lang, source) join sizes s using (lang)),
lang_shares as (
    select x.lang, x.term, 1 + (1000000000::hugeint * (x.n + 5)) // (y.total + 5 * s.v)::hugeint as q
    from (select lang, term, sum(n) as n from dense group by lang, term) x
    join (select lang, sum(n) as total from dense group by lang) y using (lang) join sizes s using (lang)),
between as (
    select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value
    from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source
    group by a.lang, a.source, b.source),
pair_rows as (
    select a.lang, a.source, 'pair' as part, b.source as item, coalesce(x.value, 0)::bigint as value
    from pairs a join pairs b on a.lang = b.lang and a.source <> b.source
    left join between x on x.lang = a.lang and x.source = a.source and x.item = b.source),
term_rows as (
    select s.lang, s.source, 'term' as part, s.term as item, (s.p - l.q)::bigint as value
    from shares s join lang_shares l using (lang, term) where s.n > 0 and s.p > l.q),
ranked as (
    select *, row_number() over (partition by lang, source, part order by value desc, item)::int as rank
    from (select * from pair_rows union all select * from term_rows))
select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= 50
"""

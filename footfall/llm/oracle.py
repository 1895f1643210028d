"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

from footfall.llm import license_scan

URL_FILTER = r"""
with located as (
    select page_id, url, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
           coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') as path
    from pages
),
rules(rule_host, rule_path, rule_verdict) as (
    values ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
           ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
),
fitting as (
    select l.url, rule_host || rule_path as rule, rule_verdict,
           row_number() over (partition by l.url order by length(rule_host || rule_path) desc, length(rule_host) desc) as place
    from (select distinct url, host, path from located) l
    join rules on (l.host = rule_host or ends_with(l.host, '.' || rule_host)) and starts_with(l.path, rule_path)
),
repeated as (select host, path from located where host <> '' group by all having count(*) > 1)
select l.page_id, l.host, l.path, f.rule,
       coalesce(f.rule_verdict, case when r.host is not null then 'block' else 'allow' end) as verdict
from located l
left join fitting f on f.url = l.url and f.place = 1
left join repeated r on r.host = l.host and r.path = l.path
"""


WARC = """
with payloads as (
    select page_id, coalesce(html, '') as html, strlen(coalesce(html, '')) as payload_bytes from pages
),
grouped as (
    select *, max(page_id) over (partition by html) as last_page from payloads
)
select page_id, payload_bytes, sha1(html) as payload_digest,
       case when payload_bytes >= 1000 and page_id <> last_page then 'revisit' else 'response' end as record_type,
       case when payload_bytes >= 1000 and page_id <> last_page then last_page end as refers_to
from grouped
"""


NGRAM_JOIN = r"""
with recursive words as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
    from documents
),
sets as (
    select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
           else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) end as s
    from words
),
members as (select doc_id, unnest(s) as shingle, len(s) as n from sets),
links as (
    select a.doc_id as x, b.doc_id as y
    from members a join members b on a.shingle = b.shingle and a.doc_id < b.doc_id
    group by a.doc_id, b.doc_id, a.n, b.n
    having 100 * count(*) >= 80 * (a.n + b.n - count(*))
),
edges as (select x, y from links union all select y, x from links),
reach(doc_id, other) as (
    select x, y from edges union select r.doc_id, e.y from reach r join edges e on e.x = r.other
)
select s.doc_id, len(s.s) as n_shingles, least(s.doc_id, coalesce(min(r.other), s.doc_id)) as component_id
from sets s left join reach r on r.doc_id = s.doc_id
group by s.doc_id, len(s.s)
"""

SUFFIX_DEDUP = """
with texts as (select row_number() over () as r, doc_id, hex(encode(coalesce(text, ''))) as h from documents),
starts as (select r, unnest(range(0, length(h) // 2 - 199)) as p, h from texts where length(h) >= 400),
prints as (select r, p, md5(substr(h, 2 * p + 1, 400)) as m from starts),
repeated as (select r, p from prints where m in (select m from prints group by m having count(*) > 1)),
marked as (select r, p, case when p - lag(p) over (partition by r order by p) <= 200 then 0 else 1 end as new_run from repeated),
runs as (select r, p, sum(new_run) over (partition by r order by p) as run from marked),
spans as (select r, run, min(p) as s, max(p) + 200 as e from runs group by r, run),
gaps as (
    select r, s, e, coalesce(lag(e) over (partition by r order by s), 0) as before,
           lead(s) over (partition by r order by s) as next_start from spans
),
kept as (
    select t.r, count(g.s) as n_spans, coalesce(sum(g.e - g.s), 0) as n_removed,
           case when count(g.s) = 0 then any_value(t.h)
                else string_agg(substr(t.h, 2 * g.before + 1, 2 * (g.s - g.before)), '' order by g.s)
                     || substr(any_value(t.h), 2 * max(g.e) + 1) end as rest
    from texts t left join gaps g on g.r = t.r group by t.r
)
select t.doc_id, length(t.h) // 2 as n_bytes, cast(k.n_removed as bigint) as n_removed, k.n_spans, sha256(unhex(k.rest)) as kept_sha256
from texts t join kept k on k.r = t.r
"""

NN_DESCENT = """
with recursive vectors as (
    select vec_id, cast(embedding as double[]) as v from embeddings
),
links as (
    select a.vec_id as x, b.vec_id as y from vectors a join vectors b on a.vec_id <> b.vec_id
    where list_cosine_similarity(a.v, b.v) >= 0.95
),
reach(vec_id, other) as (
    select x, y from links union select r.vec_id, l.y from reach r join links l on l.x = r.other
),
roots as (select vec_id, min(other) as other from reach group by vec_id),
degrees as (select x, count(*) as n from links group by x)
select v.vec_id, coalesce(d.n, 0) as n_links, least(v.vec_id, coalesce(r.other, v.vec_id)) as component_id,
       v.vec_id <= coalesce(r.other, v.vec_id) as kept
from vectors v left join roots r on r.vec_id = v.vec_id left join degrees d on d.x = v.vec_id
"""

FILL_MIDDLE = r"""
with texts as (select doc_id, coalesce(text, '') as t, sha256('42:' || coalesce(cast(doc_id as varchar), '')) as h from documents),
hashed as (
    select doc_id, t, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as units,
           cast('0x' || substr(h, 1, 8) as bigint) as h1, cast('0x' || substr(h, 9, 8) as bigint) as h2,
           cast('0x' || substr(h, 17, 8) as bigint) as h3, cast('0x' || substr(h, 25, 8) as bigint) as h4
    from texts
),
cut as (
    select *, len(units) as n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) as a, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) as b,
           case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 50 then 'plain'
                when h4 % 100 < 80 then 'spm' else 'psm' end as form
    from hashed
),
parts as (
    select *, array_to_string(units[1:a], '') as p, array_to_string(units[a + 1:b], '') as m, array_to_string(units[b + 1:], '') as s from cut
)
select doc_id, n, form, case when form <> 'plain' then length(p) end as prefix_chars, case when form <> 'plain' then length(m) end as middle_chars,
       sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
                        else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
       sha256(t) as restored_sha256
from parts
"""

LICENSE_SCAN = r"""
with templates(t, label, base, notice, phrases) as (values {templates}),
notices as (select *, string_split(notice, ' ') as nw from templates),
phrase_words as (select t, nw, string_split(unnest(phrases), ' ') as pw from notices),
placed as (
    select t, len(pw) as n, list_filter(range(1, len(nw) + 1), lambda i: nw[i:i + len(pw) - 1] = pw)[1] as first from phrase_words
),
musts as (
    select t, label, base, nw,
           coalesce((select flatten(list(range(first, first + n))) from placed p where p.t = notices.t), range(1, len(nw) + 1)) as must
    from notices
),
docs as (
    select row_number() over () as r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from documents
),
held as (select word, count(*) as n from (select unnest(list_distinct(w)) as word from docs) group by word),
idf as (
    select word, round(ln(((select count(*) from docs) + 1) / (coalesce(held.n, 0) + 1)), 6) + 1e-6 as weight
    from (select distinct unnest(nw) as word from notices) left join held using (word)
),
weights as (
    select t, list(weight order by k) as weight
    from (select t, unnest(nw) as word, unnest(range(1, len(nw) + 1)) as k from notices) join idf using (word) group by t
),
positions as (select r, unnest(w) as word, unnest(range(1, len(w) + 1)) as i from docs),
begun as (
    select d.r, m.*, d.w, weight, p.i - m.must[1] as s
    from musts m join positions p on p.word = m.nw[m.must[1]] join docs d on d.r = p.r join weights using (t)
),
places as (
    select r, label, base, s,
           round(list_sum(list_transform(range(1, len(nw) + 1), lambda k: case when s + k >= 1 and w[s + k] = nw[k] then weight[k] else 0 end))
                 / list_sum(weight), 6) as share
    from begun
    where len(list_filter(must, lambda k: s + k >= 1 and coalesce(w[s + k], '') = nw[k])) = len(must)
),
told as (
    select r, count(*) filter (base) as n_base, min(s) filter (base) as first_word, max(s) filter (base) as last_word,
           string_agg(distinct label, ',' order by label) filter (base) as base_labels,
           string_agg(distinct label, ',' order by label) as labels, max(share) as score
    from places where base or share >= 0.6 group by r
)
select doc_id, len(w) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word, coalesce(base_labels, '') as base_labels,
       coalesce(labels, '') as labels, coalesce(score, 0.0) as score
from docs left join told using (r)
"""

SPELLING_VARIANTS = r"""
with recursive crc_table as (
    select list(list_reduce(range(8), lambda c, k: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end, b) order by b) as crc
    from (select unnest(range(256)) as b)
),
runs as (
    select coalesce(cast(doc_id as varchar), '') as id,
           unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) as run
    from documents
),
counted as (select id, run, count(*) as n from runs group by id, run),
hashed as (
    select run, n, xor(list_reduce(
               list_transform(regexp_extract_all(hex(encode(id || ':' || run)), '..'), lambda x: cast('0x' || x as bigint)),
               lambda c, b: xor(c // 256, crc[xor(c % 256, b) + 1]), 4294967295), 4294967295) as h
    from counted, crc_table
),
written as (
    select case when h % 97 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end as word, n from hashed
),
words as (select word, cast(sum(n) as bigint) as n from written where length(word) >= 5 group by word having sum(n) >= 3),
shorter as (
    select word, n, length(word) as size, i, substr(word, 1, i - 1) || substr(word, i + 1) as rest
    from (select word, n, unnest(range(1, length(word) + 1)) as i from words)
),
near as (
    select a.word, b.word as other, b.n as other_n from shorter a join shorter b on a.rest = b.rest and a.i = b.i and a.size = b.size and a.word <> b.word
    union select a.word, b.word, b.n from shorter a join words b on b.word = a.rest
    union select b.word, a.word, a.n from shorter a join words b on b.word = a.rest
),
best as (
    select word, count(*) as n_near, first(other order by other_n desc, other) as other, max(other_n) as other_n from near group by word
),
formed as (
    select w.word, w.n, coalesce(b.n_near, 0) as n_near, case when b.other_n >= 2 * w.n then b.other end as form,
           case when b.other_n >= 2 * w.n then b.other_n end as form_n
    from words w left join best b on b.word = w.word
),
chains(word, root, form) as (
    select word, word, form from formed
    union all select c.word, f.word, f.form from chains c join formed f on f.word = c.form
)
select f.word, f.form, c.root, f.n, f.n_near, f.form_n from formed f join chains c on c.word = f.word and c.form is null
"""


def _template_values() -> str:
    both = [*((t, "true") for t in license_scan.BASE_PHRASES), *((t, "false") for t in license_scan.NOTICES)]
    rows = []
    for i, (template, base) in enumerate(both):
        phrases = ", ".join(f"'{p}'" for p in template.key_phrases)
        rows.append(f"({i}, '{template.label}', {base}, '{template.notice}', cast([{phrases}] as varchar[]))")
    return ",\n    ".join(rows)


def statements() -> dict[str, str]:
    return {
        "op1_ngram_join": NGRAM_JOIN,
        "op3_url_filter": URL_FILTER,
        "op5_suffix_dedup": SUFFIX_DEDUP,
        "op8_nn_descent": NN_DESCENT,
        "op10_warc": WARC,
        "op11_fill_middle": FILL_MIDDLE,
        "op12_spelling_variants": SPELLING_VARIANTS,
        "op13_license_scan": LICENSE_SCAN.replace("{templates}", _template_values()),
    }

"""The same results in DuckDB SQL, where SQL can express them and whole tables are not too slow."""

WORDS = "regexp_extract_all({}, '[^\\x20\\x09-\\x0D]+')"
LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2 = f"""
with words as (select doc_id, coalesce({WORDS.format("text")}, []) as w from documents),
places as (select doc_id, w, unnest(range(1, greatest(len(w) - 18, 1))) as start from words),
windows as (
  select doc_id, start,
    row_number() over (partition by array_to_string(w[start : start + 19], ' ') order by doc_id, start) as nth
  from places
),
gone as (
  select distinct doc_id, place
  from (select doc_id, unnest(range(start, start + 20)) as place from windows where nth > 1)
),
removed as (select doc_id, list(place) as places from gone group by doc_id)
select words.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(len(places), 0) as bigint) as n_removed,
  sha256(array_to_string(
    list_transform(list_filter(range(1, len(w) + 1), lambda i: places is null or not list_contains(places, i)), lambda i: w[i]),
    ' ')) as kept_sha256
from words left join removed on removed.doc_id = words.doc_id
"""

OP3 = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as e
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
scored as (
  select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.e, c.e) as bigint) as score
  from v q join v c on c.vec_id <> q.vec_id
  where q.vec_id % 50 = 0
)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as "rank", vec_id, score
from scored
qualify row_number() over (partition by query_id order by score desc, vec_id) <= 5
"""

OP4 = """
with recursive v as (
  select vec_id, label, cast(embedding as double[]) as e
  from embeddings
  where embedding is not null and label is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links as (
  select a.vec_id as a, b.vec_id as b
  from v a join v b on a.label = b.label and a.vec_id <> b.vec_id
  where list_cosine_similarity(a.e, b.e) >= 0.93
),
reached(vec_id, root) as (
  select a, a from links union select links.b, reached.root from reached join links on links.a = reached.vec_id
),
numbers as (select a as vec_id, count(*) as n from links group by a),
roots as (select vec_id, min(root) as root from reached group by vec_id)
select vec_id, cast(coalesce(n, 0) as bigint) as n_links, coalesce(root, vec_id) as component_id,
  coalesce(root, vec_id) = vec_id as kept
from (select vec_id from embeddings) left join numbers using (vec_id) left join roots using (vec_id)
"""

OP9 = f"""
with recursive words as (select doc_id, coalesce({WORDS.format(LOWER)}, []) as w from documents),
sets as (
  select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) end) as s
  from words
),
shingles as (select doc_id, unnest(s) as shingle from sets),
common as (
  select a.doc_id as a, b.doc_id as b, count(*) as n
  from shingles a join shingles b on a.shingle = b.shingle and a.doc_id < b.doc_id group by 1, 2
),
pairs as (
  select a, b from common join sets x on x.doc_id = a join sets y on y.doc_id = b
  where 100 * n >= 75 * (len(x.s) + len(y.s) - n)
),
links as (select a, b from pairs union all select b, a from pairs),
reached(doc_id, root) as (
  select a, a from links union select links.b, reached.root from reached join links on links.a = reached.doc_id
),
roots as (select doc_id, min(root) as root from reached group by doc_id)
select doc_id, cast(len(s) as bigint) as n_shingles, coalesce(root, doc_id) as component_id,
  coalesce(root, doc_id) = doc_id as kept
from sets left join roots using (doc_id)
"""

OP10 = """
with p as (select page_id, coalesce(html, '') as html from pages),
held as (
  select page_id, html, case when strlen(html) >= 1000 then max(page_id) over (partition by html) else page_id end as holder
  from p
)
select page_id, cast(strlen(html) as bigint) as payload_bytes, sha1(html) as payload_digest,
  case when holder = page_id then 'response' else 'revisit' end as record_type,
  case when holder = page_id then null else holder end as refers_to
from held
"""



def _coded(entries: int = 64, parts: int = 16, rounds: int = 2) -> str:
    """Assignment and averaging written out, round by round; the least distance and, of equal ones,
    the lowest entry as one number."""

    def assigned(k: int) -> str:
        gap = "list_transform(list_zip(x, c), lambda g: (g[1] - g[2]) * (g[1] - g[2]))"
        return f"""
a{k} as materialized (
  select vec_id, part, any_value(x) as x, min(cast(list_sum({gap}) as bigint) * {entries} + entry) as best
  from parts join b{k} using (part) group by vec_id, part
)"""

    def averaged(k: int) -> str:
        return f"""
b{k + 1} as materialized (
  select part, entry, coalesce(any_value(u.c), any_value(b{k}.c)) as c
  from b{k} left join (
    select part, entry, list(mean order by pos) as c
    from (
      select part, best % {entries} as entry, pos, cast(floor(cast(sum(x[pos]) as double) / count(*)) as bigint) as mean
      from (select part, best, x, unnest(range(1, len(x) + 1)) as pos from a{k}) group by 1, 2, 3
    ) group by 1, 2
  ) u using (part, entry) group by part, entry
)"""

    steps = [step for k in range(rounds) for step in (assigned(k), averaged(k))] + [assigned(rounds)]
    return f"""
with v as materialized (
  select vec_id, label, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as e
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
parts as materialized (
  select vec_id, part, e[part * len(e) // {parts} + 1 : (part + 1) * len(e) // {parts}] as x
  from (select vec_id, e, unnest(range({parts})) as part from v)
),
b0 as materialized (
  select part, entry, x as c
  from parts join (select vec_id, row_number() over (order by vec_id) - 1 as entry from v qualify entry < {entries}) using (vec_id)
),{",".join(steps)},
coded as (
  select vec_id, string_agg(printf('%02x', best % {entries}), '' order by part) as code, cast(sum(best // {entries}) as bigint) as error
  from a{rounds} group by vec_id
),
books as (select sha256(string_agg(array_to_string(c, ','), ',' order by part, entry)) as codebooks_sha256 from b{rounds})
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256
from coded join v using (vec_id) cross join books
"""


OP11 = _coded()

ITEM_WORDS = "regexp_extract_all(" + LOWER + ", '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

OP12 = f"""
with d as materialized (select row_number() over () as r, doc_id, coalesce({ITEM_WORDS}, []) as w from documents),
tested as materialized (
  select item_id, size, array_to_string(w[i : i + size - 1], ' ') as tested
  from (
    select item_id, w, size, unnest(range(1, len(w) - size + 2)) as i
    from (select item_id, w, least(len(w), 10) as size from (select item_id, coalesce({ITEM_WORDS}, []) as w from benchmark) where len(w) > 0)
  )
),
windows as (
  select r, size, i, array_to_string(w[i : i + size - 1], ' ') as found
  from (select r, w, size, unnest(range(1, len(w) - size + 2)) as i from d cross join (select distinct size from tested))
),
hits as materialized (select distinct r, i, windows.size, item_id from windows join tested on found = tested and windows.size = tested.size),
covered as (select r, count(distinct place) as n from (select r, unnest(range(i, i + size)) as place from hits) group by r),
named as (
  select r, count(*) as n, string_agg(item, ',' order by item) as items
  from (select distinct r, cast(item_id as varchar) as item from hits where item_id is not null) group by r
)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(covered.n, 0) as bigint) as n_hit,
  cast(coalesce(named.n, 0) as bigint) as n_items, sha256(coalesce(items, '')) as items_sha256, coalesce(covered.n, 0) > 0 as contaminated
from d left join covered using (r) left join named using (r)
"""

# The checksum is written out by its rule: a table of 256 entries from eight halvings each, then one
# look-up a byte. Letters beyond ASCII have two bytes.
OP13 = f"""
with crc as materialized (
  select list(v order by i) as t
  from (
    select i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda v, k: case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end) as v
    from (select unnest(range(256)) as i)
  )
),
occurring as materialized (
  select coalesce(cast(doc_id as varchar), '') as d, run, count(*) as n
  from (select doc_id, unnest(regexp_extract_all({LOWER}, '[A-Za-zÀ-ÿ]+')) as run from documents)
  group by 1, 2
),
hashed as (
  select run, n, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(
      list_transform(string_split(d || ':' || run, ''), lambda c: cast(unicode(c) as bigint)),
      lambda u: case when u < 128 then [u] else [192 + (u >> 6), 128 + (u & 63)] end))),
    lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) as h
  from occurring cross join crc
),
vocabulary as materialized (
  select word, cast(sum(n) as bigint) as n
  from (select n, case when h % 97 = 0 then left(run, h % length(run)) || substring(run, h % length(run) + 2) else run end as word from hashed)
  where length(word) >= 5 group by word having sum(n) >= 3
),
shortened as materialized (
  select word, length(word) as size, i, left(word, i) || substring(word, i + 2) as rest
  from (select word, unnest(range(length(word))) as i from vocabulary)
),
pairs as (
  select s.word as a, v.word as b from shortened s join vocabulary v on v.word = s.rest
  union select v.word, s.word from shortened s join vocabulary v on v.word = s.rest
  union select x.word, y.word from shortened x join shortened y on x.rest = y.rest and x.i = y.i and x.size = y.size and x.word <> y.word
),
near as materialized (
  select a as word, any_value(x.n) as n, count(*) as n_near, arg_min(b, (-y.n, b)) as form, max(y.n) as form_n
  from pairs join vocabulary x on x.word = a join vocabulary y on y.word = b group by a
),
formed as materialized (
  select word, n_near, case when form_n >= 2 * n then form end as form, case when form_n >= 2 * n then form_n end as form_n from near
),
chains as (
  with recursive steps(word, root, step) as (
    select word, form, 1 from formed where form is not null
    union all select steps.word, f.form, step + 1 from steps join formed f on f.word = steps.root where f.form is not null
  )
  select word, arg_max(root, step) as root from steps group by word
)
select v.word, v.n, cast(coalesce(n_near, 0) as bigint) as n_near, form, form_n, coalesce(root, v.word) as root
from vocabulary v left join formed using (word) left join chains using (word)
"""

ORACLE = {
    "op2_substring_dedup": OP2,
    "op3_topk": OP3,
    "op4_near_vectors": OP4,
    "op9_near_dup": OP9,
    "op10_warc": OP10,
    "op11_vector_codes": OP11,
    "op12_decontamination": OP12,
    "op13_spelling": OP13,
}

"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from ledgerlens.llm import fuzzy_lines as L
from ledgerlens.llm import secret_scan as S
from ledgerlens.llm.common import WORD


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _kind(order: int, pattern: str, keep: str) -> str:
    """Spans of one kind: a match starts after the stretches and matches before it."""
    return f"""
SELECT doc_id, owner, repo, {order} AS k, {_q(S.KINDS[order])} AS kind, found[i] AS m,
       list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0) AS s
FROM (SELECT doc_id, owner, repo, found, gaps, unnest(range(1, len(found) + 1)) AS i
      FROM (SELECT doc_id, owner, repo, regexp_extract_all(t, {_q(pattern)}) AS found, string_split_regex(t, {_q(pattern)}) AS gaps FROM d))
WHERE {keep.format(m="found[i]")}"""


def secret_scan() -> str:
    mixed = ("regexp_matches({m}, '[A-Z]') AND regexp_matches({m}, '[a-z]') AND regexp_matches({m}, '[0-9]') "
             f"AND len(list_distinct(string_split({{m}}, ''))) >= {S.OPAQUE_DISTINCT}")
    base = " UNION ALL ".join([_kind(0, S.ASSIGN, f"length(regexp_extract({{m}}, {_q(S.ASSIGN)}, 2)) >= 8"),
                               _kind(1, S.ACCESS, "true"), _kind(2, S.HEX, "true")])
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS owner, concat_ws('/', source, lang) AS repo FROM documents),
base AS (SELECT *, s + length(m) AS e FROM ({base})),
opaque AS (SELECT *, s + length(m) AS e FROM ({_kind(3, S.OPAQUE, mixed)})),
spans AS (SELECT * FROM base UNION ALL
          SELECT o.* FROM opaque o WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = o.doc_id AND o.s < b.e AND b.s < o.e)),
valued AS (SELECT *, CASE WHEN k = 0 THEN regexp_extract(m, {_q(S.ASSIGN)}, 2) ELSE m END AS value FROM spans),
freq AS (SELECT value, count(DISTINCT owner) AS n_owners, count(DISTINCT (owner, repo)) AS n_repos FROM valued GROUP BY value),
judged AS (SELECT v.*, CASE WHEN n_owners >= {S.COPIED_OWNERS} THEN 'copied'
                            WHEN n_owners = 1 AND n_repos <= {S.LIVE_REPOS} THEN 'live' ELSE 'shared' END AS verdict
           FROM valued v JOIN freq USING (value)),
each AS (SELECT doc_id, count(*) FILTER (WHERE k = 0) AS n_assign, count(*) FILTER (WHERE k = 1) AS n_access, count(*) FILTER (WHERE k = 2) AS n_hex,
                string_agg(concat(kind, ':', s, ':', e), ',' ORDER BY s, k) FILTER (WHERE k <= 2) AS base,
                string_agg(concat(kind, ':', s, ':', e), ',' ORDER BY s, k) FILTER (WHERE k <= 2 OR verdict = 'live') AS spans,
                count(*) FILTER (WHERE verdict = 'live') AS n_live, count(*) FILTER (WHERE verdict = 'copied') AS n_copied
         FROM judged GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied
FROM d LEFT JOIN each USING (doc_id)"""


def _reached(links: str) -> str:
    """(id, comp): the least id that links (a, b) reach, for every id with a link."""
    return f"""
both_ways AS (SELECT a, b FROM ({links}) UNION SELECT b, a FROM ({links})),
reach AS (SELECT DISTINCT a AS id, a AS other FROM both_ways UNION SELECT w.b, r.other FROM reach r JOIN both_ways w ON w.a = r.id),
comp AS (SELECT id, min(other) AS comp FROM reach GROUP BY id)"""


def ngram_join(size: int = 4, percent: int = 85) -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), {_q(WORD)}) AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) >= {size} THEN list_distinct(list_transform(range(1, len(w) - {size - 2}), lambda i: array_to_string(w[i:i + {size - 1}], ' ')))
                          WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM w),
g AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
link AS (SELECT x.doc_id AS a, y.doc_id AS b FROM g x JOIN g y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY x.doc_id, y.doc_id, x.n, y.n
         HAVING 100 * count(*) >= {percent} * (x.n + y.n - count(*))),
{_reached("SELECT a, b FROM link")}
SELECT s.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, coalesce(comp, s.doc_id) AS component_id FROM s LEFT JOIN comp ON comp.id = s.doc_id"""


def line_dedup() -> str:
    white = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '"
    size = L.SHINGLE
    return f"""
WITH RECURSIVE p AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS no
           FROM documents WHERE text IS NOT NULL),
e AS (SELECT doc_id, no, trim(raw, {white}) AS x FROM p WHERE length(trim(raw, {white})) >= {L.MIN_CHARS}),
node AS (SELECT x, row_number() OVER (ORDER BY x) AS id FROM (SELECT DISTINCT x FROM e)),
s AS (SELECT id, list_distinct(list_transform(range(1, length(x) - {size - 2}), lambda i: substr(x, i, {size}))) AS s FROM node),
g AS (SELECT id, len(s) AS n, unnest(s) AS g FROM s),
link AS (SELECT x.id AS a, y.id AS b FROM g x JOIN g y ON x.g = y.g AND x.id < y.id GROUP BY x.id, y.id, x.n, y.n
         HAVING 100 * count(*) >= {L.PERCENT} * (x.n + y.n - count(*))),
{_reached("SELECT a, b FROM link")},
gone AS (SELECT doc_id, no FROM (SELECT doc_id, no, row_number() OVER (PARTITION BY coalesce(comp, id) ORDER BY doc_id, no) AS k
                                 FROM e JOIN node USING (x) LEFT JOIN comp USING (id)) WHERE k > 1),
kept AS (SELECT p.doc_id, coalesce(string_agg(raw, chr(10) ORDER BY p.no) FILTER (WHERE g.no IS NULL), '') AS text,
                count(*) AS n_lines, count(g.no) AS n_dropped
         FROM p LEFT JOIN (SELECT doc_id AS gd, no FROM gone) g ON g.gd = p.doc_id AND g.no = p.no GROUP BY p.doc_id)
SELECT d.doc_id, k.text, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped FROM documents d LEFT JOIN kept k USING (doc_id)"""


def substring_dedup() -> str:
    """DuckDB SQL of ``substrings.dedup``: every window by its text, no anchors."""
    return r"""
with doc as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
word as (select doc_id, len(w) as n, unnest(range(1, len(w) + 1)) as i, unnest(w) as word, w from doc),
win as (select doc_id, i, word, case when i + 49 <= n then sha256(array_to_string(w[i:i + 49], ' ')) end as h from word),
least as (select h, min(doc_id) as least from win where h is not null group by h),
mark as (select win.doc_id, i, word, coalesce(least < win.doc_id, false) as hit from win left join least on win.h = least.h),
kept as (select doc_id, i, word, max(hit) over (partition by doc_id order by i rows between 49 preceding and current row) as gone from mark),
left_ as (select doc_id, count(*) filter (gone) as n_removed, string_agg(word, ' ' order by i) filter (not gone) as text from kept group by doc_id)
select doc.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(left_.text, '')) as kept_sha256
from doc left join left_ on doc.doc_id = left_.doc_id
"""


def vector_codes(rounds: int = 4) -> str:
    """DuckDB SQL of ``vector_codes``: every part against every entry, four rounds written out. Doubles hold the products exactly."""
    def assigned(k: int) -> str:
        return f"""a{k} as materialized (select vec_id, p, any_value(x) as x, min({{'d': list_inner_product(c, c) - 2 * list_inner_product(part.x, c), 'e': e}}) as best
from part join b{k} using (p) group by vec_id, p)"""

    def updated(k: int) -> str:
        return f"""s{k} as (select p, e, i, sum(v) as s, count(*) as n from (select p, best.e as e, unnest(range(1, len(x) + 1)) as i, unnest(x) as v from a{k}) group by p, e, i),
m{k} as (select p, e, list(cast((cast(s as hugeint) - ((cast(s as hugeint) % n) + n) % n) // n as double) order by i) as c from s{k} group by p, e),
b{k + 1} as materialized (select b{k}.p, b{k}.e, coalesce(m{k}.c, b{k}.c) as c from b{k} left join m{k} on b{k}.p = m{k}.p and b{k}.e = m{k}.e)"""
    steps = ",\n".join(f"{assigned(k)},\n{updated(k)}" for k in range(rounds))
    return f"""
with kept as (select vec_id, label, list_transform(embedding, lambda x: floor(1024 * cast(x as double))) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
part as materialized (select vec_id, p, v[p * len(v) // 4 + 1:(p + 1) * len(v) // 4] as x from (select vec_id, v, unnest(range(4)) as p from kept)),
b0 as materialized (select p, row_number() over (partition by p order by vec_id) - 1 as e, x as c from part qualify e < 256),
{steps},
{assigned(rounds)},
code as (select vec_id, string_agg(printf('%02x', best.e), '' order by p) as code, cast(sum(best.d + list_inner_product(x, x)) as bigint) as error
  from a{rounds} group by vec_id),
book as (select sha256(string_agg(array_to_string(list_transform(c, lambda x: cast(cast(x as bigint) as varchar)), ','), ',' order by p, e)) as digest from b{rounds})
select kept.vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, digest as codebooks_sha256
from kept join code using (vec_id) cross join book
"""


def prefix_trie() -> str:
    """DuckDB SQL of ``prefix_trie``: prefixes as lists of turns. crc32 is not a DuckDB function; its table is made by a recursion."""
    return r"""
with recursive step(i, k, v) as (select i, 0, i from range(256) t(i) union all
  select i, k + 1, case when v % 2 = 1 then xor(v // 2, 3988292384) else v // 2 end from step where k < 8),
crc_table as materialized (select list(v order by i) as t from step where k = 8),
turn as (select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
  row_number() over (partition by conv_id order by turn nulls first, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) as i
  from conversations where conv_id is not null),
own as (select conv_id, list({'role': role, 'text': text} order by i) as turns from turn group by conv_id),
head as (select conv_id, list_reduce(list_prepend(4294967295, list_transform(string_split(cast(conv_id as varchar), ''), lambda ch: cast(ord(ch) as bigint))),
  lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1])) as c from own cross join crc_table),
conv as materialized (select own.conv_id, list_concat(coalesce(first.turns[1:h], []), own.turns[h + 1:]) as turns
  from (select own.*, xor(c, 4294967295) % 4 as h from own join head using (conv_id)) own left join own first on first.conv_id = own.conv_id - own.conv_id % 20),
member as materialized (select conv_id, d, turns[1:d] as path, len(turns) as n from (select *, unnest(range(0, len(turns) + 1)) as d from conv)),
node as materialized (select path, d, min(conv_id) as conv_id, count(*) as n_convs,
  sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (n = d), '')) as ends_sha256,
  case when d = 0 then 0 else len(regexp_extract_all(path[d].text, '[^\x20\x09-\x0D]+')) end as words from member group by path, d),
above as (select node.d as d, node.conv_id as conv_id, up.d as up_d, up.conv_id as up_conv, node.n_convs, node.words
  from node join member on member.conv_id = node.conv_id and member.d <= node.d join node up on up.path = member.path and up.d = member.d),
kids as (select up_d, up_conv, count(*) as n from above where d = up_d + 1 group by up_d, up_conv),
below as (select above.up_d, up_conv, cast(sum((n_convs - 1) * words) as bigint) as saved_tokens, count(*) filter (has.n is null) as n_leaves
  from above left join (select up_d, up_conv as of, n from kids) has on has.up_d = above.d and has.of = above.conv_id group by above.up_d, up_conv),
parent as (select d, conv_id, up_conv from above where up_d = d - 1)
select node.conv_id, cast(node.d as bigint) as depth, parent.up_conv as parent_conv_id, n_convs, coalesce(kids.n, 0) as n_children,
  n_leaves, saved_tokens, ends_sha256
from node join below on below.up_d = node.d and below.up_conv = node.conv_id
left join kids on kids.up_d = node.d and kids.up_conv = node.conv_id
left join parent on parent.d = node.d and parent.conv_id = node.conv_id
"""

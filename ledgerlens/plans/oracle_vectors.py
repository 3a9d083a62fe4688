"""Oracle SQL for the vector queries: encoder, pooling, normalisation,
projection, ensemble, top-k search, cell prompts and cell embeddings.

Vectors are long ``(id, dim, value)`` relations here; every helper takes
and returns such a relation (SQL text) keyed by one ``id`` column.
"""

from __future__ import annotations

import math

from ledgerlens.operators import cells as ce
from ledgerlens.plans import oracle as O
from ledgerlens.plans import oracle_filings as OF
from ledgerlens.plans import sqltext as S

q = S.q


def ws_tokens(x: str) -> str:
    s = S.strip(x)
    return f"(CASE WHEN {s} = '' THEN []::VARCHAR[] ELSE regexp_split_to_array({s}, {q(S.WS + '+')}) END)"


def tokens(x: str, max_tokens: int = 1024) -> str:
    return f"list_slice({ws_tokens(f'lower({x})')}, 1, {max_tokens})"


def pooled(src: str, text: str, how: str = "mean", dim: int = 32, normalize: bool = True) -> str:
    """``(id, dim, value)`` token-vector pooling of ``text`` from ``src(id, text)``."""
    digit = "CAST(('0x' || substr(md5(tok), j + 1, 1)) AS INTEGER)"
    agg = {"mean": f"(sum({digit}) / count(*) - 7.5) / 7.5",
           "first": f"(arg_min({digit}, pos) - 7.5) / 7.5",
           "max": f"(max({digit}) - 7.5) / 7.5"}[how]
    base = f"""
SELECT id, CAST(j AS BIGINT) AS dim, {agg} AS value
FROM (SELECT id, unnest(toks) AS tok, generate_subscripts(toks, 1) AS pos
      FROM (SELECT id, {tokens(text)} AS toks FROM ({src}))) t, range(0, {dim}) r(j)
GROUP BY id, j"""
    return normalized(base) if normalize else base


def normalized(long: str) -> str:
    return (f"SELECT id, dim, value / greatest(sqrt(sum(value * value) OVER (PARTITION BY id)), 1e-9) AS value "
            f"FROM ({long})")


def weights(in_dim: int, out_dim: int, seed: int = 42) -> str:
    def layer(lid, fan_in, fan_out):
        bound = repr(1.0 / float(math.sqrt(fan_in)))
        h = f"md5(concat_ws('|', '{seed}', 'w{lid}', CAST(o AS VARCHAR), CAST(i AS VARCHAR)))"
        u = f"CAST(('0x' || substr({h}, 1, 8)) AS BIGINT) / 4294967296.0"
        return (f"SELECT {lid} AS layer, o AS out_i, i AS in_i, ({u} * 2.0 - 1.0) * {bound} AS w "
                f"FROM range(0, {fan_out}) a(o), range(-1, {fan_in}) b(i)")
    return f"{layer(1, in_dim, out_dim)} UNION ALL {layer(2, out_dim, out_dim)}"


def projected(long: str, in_dim: int, out_dim: int = 256) -> str:
    return normalized(f"""
WITH w AS ({weights(in_dim, out_dim)}),
x AS ({long}),
h AS (SELECT x.id, w.out_i AS o, sum(x.value * w.w) AS z FROM x JOIN w ON w.layer = 1 AND w.in_i = x.dim GROUP BY x.id, w.out_i),
h2 AS (SELECT h.id, h.o, greatest(h.z + w.w, 0) AS hv FROM h JOIN w ON w.layer = 1 AND w.in_i = -1 AND w.out_i = h.o),
y AS (SELECT h2.id, w.out_i AS o, sum(h2.hv * w.w) AS z FROM h2 JOIN w ON w.layer = 2 AND w.in_i = h2.o GROUP BY h2.id, w.out_i)
SELECT y.id, CAST(y.o AS BIGINT) AS dim, y.z + w.w AS value FROM y JOIN w ON w.layer = 2 AND w.in_i = -1 AND w.out_i = y.o""")


def embeddings_long() -> str:
    return ("SELECT vec_id AS id, CAST(generate_subscripts(embedding, 1) - 1 AS BIGINT) AS dim, "
            "CAST(unnest(embedding) AS DOUBLE) AS value FROM embeddings")


def topk(qlong: str, ilong: str, k: int, floor: float) -> str:
    return f"""
SELECT query_id, id, score, rank FROM (
  SELECT query_id, id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank
  FROM (SELECT a.id AS query_id, b.id AS id, sum(a.value * b.value) AS score
        FROM ({qlong}) a JOIN ({ilong}) b ON a.dim = b.dim GROUP BY a.id, b.id))
WHERE rank <= {k} AND score >= {floor}"""


def rounded(long: str, cols: str = "id, dim") -> str:
    return f"SELECT {cols}, round(value, 6) AS value FROM ({long})"


# ------------------------------------------------------------- cell plan --

DOC_SRC = O.column_documents_sql()


def column_index_src() -> str:
    return (f"SELECT row_number() OVER (ORDER BY table_name, column_name) - 1 AS id, table_name, "
            f"column_name AS name, doc FROM ({DOC_SRC})")


def cells_src() -> str:
    return (f"SELECT table_name || '|' || column_name || '|' || CAST(rank AS VARCHAR) AS cid, "
            f"table_name, column_name, rank, cell FROM ({O.normalized_cells_sql()})")


def cell_prompts(dim: int = 32, out_dim: int = 256, k: int = ce.PIPELINE_K, floor: float = 0.5) -> str:
    idx_vec = projected(pooled(f"SELECT id, doc FROM ({column_index_src()})", "doc", dim=dim), dim, out_dim)
    cell_vec = projected(pooled(f"SELECT cid AS id, cell FROM ({cells_src()})", "cell", dim=dim), dim, out_dim)
    hits = topk(cell_vec, idx_vec, k, floor)
    block = (f"{q(ce.RELATED_HEADER)} || string_agg('Column: ' || ix.name || chr(10) || {OF.shorten('ix.doc')} "
             f"|| chr(10) || chr(10), '' ORDER BY h.rank)")
    return f"""
WITH ix AS ({column_index_src()}),
c AS ({cells_src()}),
h AS ({hits}),
rel AS (SELECT h.query_id AS cid, {block} AS related FROM h JOIN ix ON ix.id = h.id GROUP BY h.query_id)
SELECT c.table_name, c.column_name, c.rank, c.cell,
       {q(ce.TARGET_PREFIX)} || c.column_name || chr(10) || t.doc || chr(10) || chr(10) || coalesce(rel.related, '')
       || {q(ce.CELL_PREFIX)} || c.cell || {q(ce.CELL_SUFFIX)} AS prompt
FROM c LEFT JOIN rel ON rel.cid = c.cid JOIN ix t ON t.table_name = c.table_name AND t.name = c.column_name"""


def cell_embeddings(dim: int = 32, out_dim: int = 256) -> str:
    p = cell_prompts(dim, out_dim)
    src = f"SELECT table_name || '|' || column_name || '|' || CAST(rank AS VARCHAR) AS id, prompt FROM ({p})"
    v = projected(pooled(src, "prompt", dim=dim), dim, out_dim)
    return (f"SELECT split_part(id, '|', 1) AS table_name, split_part(id, '|', 2) AS column_name, "
            f"CAST(split_part(id, '|', 3) AS BIGINT) AS rank, dim, round(value, 6) AS value FROM ({v})")


_SAVED = """SELECT vec_id, CAST(label * 5 + vec_id % 5 AS BIGINT) AS id, 'year/' || CAST(2000 + label AS VARCHAR) AS table_name,
  'k=' || CAST(vec_id % 5 AS VARCHAR) AS name, CASE WHEN label % 2 = 0 THEN embedding ELSE embedding[1:16] END AS vec FROM embeddings"""


def _saved_vectors() -> str:
    return f"""
SELECT 'column' AS type, id, table_name, name, id AS row_index, vec FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY vec_id) AS rn FROM ({_SAVED})) WHERE rn = 1 AND id % 7 <> 3
UNION ALL SELECT 'cell', id, table_name, name, row_number() OVER (PARTITION BY id ORDER BY vec_id) - 1, vec FROM ({_SAVED}) WHERE id % 11 <> 5"""


def merged_from_files(width: int) -> str:
    dims = ", ".join(f"round(CAST(vec[{i + 1}] AS DOUBLE), 6) AS dim_{i}" for i in range(width))
    return f"SELECT type, table_name, name, row_index, {dims} FROM ({_saved_vectors()})"


def saved_status() -> str:
    return f"""
WITH found AS (SELECT id, type, count(*) AS n, min(len(vec)) AS least_width, max(len(vec)) AS width FROM ({_saved_vectors()}) GROUP BY id, type),
asked AS (SELECT DISTINCT id, table_name, name, type FROM ({_SAVED}), (VALUES ('column'), ('cell')) t(type))
SELECT id, table_name, name, type, CASE WHEN n IS NULL THEN 'missing' WHEN least_width < width THEN 'ragged' ELSE 'ok' END AS status,
  coalesce(n, 0) AS n, least_width, width FROM asked LEFT JOIN found USING (id, type)"""

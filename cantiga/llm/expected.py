"""The results of the queries in SQL, where SQL can express them."""

_VECTORS = """
good AS (
  SELECT vec_id, label, [x::DOUBLE FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
)"""



def _assigned(turn: int) -> str:
    """The nearest entry of every part, ties to the lower one, and the distance."""
    return f"""near{turn} AS MATERIALIZED (
  SELECT vec_id, p, min(d * 64 + e) % 64 AS e, min(d * 64 + e) // 64 AS d, any_value(x) AS x FROM (
    SELECT vec_id, part.p, e, part.x AS x,
      list_sum([(z[1] - z[2]) * (z[1] - z[2]) FOR z IN list_zip(part.x, book{turn}.x)])::BIGINT AS d
    FROM part JOIN book{turn} ON part.p = book{turn}.p
  ) GROUP BY vec_id, p
)"""


def _moved(turn: int) -> str:
    """Every entry at the floor of the mean of its parts; an unused one stays."""
    return f"""mean{turn} AS (
  SELECT p, e, list(m ORDER BY i) AS x FROM (
    SELECT p, e, i, floor(sum(x[i])::DOUBLE / count(*))::BIGINT AS m FROM near{turn}, range(1, len(x) + 1) t(i) GROUP BY p, e, i
  ) GROUP BY p, e
),
book{turn + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(m.x, b.x) AS x FROM book{turn} b LEFT JOIN mean{turn} m USING (p, e)
)"""


def _words(name: str, table: str, key: str) -> str:
    """The words of each text: runs of letters, digits and characters beyond ASCII, A to Z lower-cased."""
    lowered = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""{name} AS MATERIALIZED (
  SELECT {key} AS id, regexp_extract_all({lowered}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM {table}
)"""


EXPECTED = {
    "op1_vector_dedup": f"""
WITH RECURSIVE {_VECTORS},
ok AS (
  SELECT vec_id, label, v FROM good
  WHERE label IS NOT NULL AND vec_id IS NOT NULL AND list_inner_product(v, v) > 0
),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_inner_product(a.v, b.v)
    / (sqrt(list_inner_product(a.v, a.v)) * sqrt(list_inner_product(b.v, b.v))) >= 0.98
),
reach(a, b) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION
  SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
),
component AS (SELECT a, min(b) AS least FROM reach GROUP BY a),
links AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT e.vec_id, coalesce(n, 0)::BIGINT AS n_links, least AS component_id, e.vec_id = least AS kept
FROM embeddings e JOIN component c ON e.vec_id = c.a LEFT JOIN links l ON e.vec_id = l.a
""",
    "op10_exact_top_k": f"""
WITH {_VECTORS},
whole AS (SELECT vec_id, [floor(64 * x) FOR x IN v] AS v FROM good WHERE vec_id IS NOT NULL),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored
)
SELECT query_id, place::INTEGER AS rank, vec_id, score FROM ranked WHERE place <= 20
""",
    "op11_vector_codes": f"""
WITH {_VECTORS},
whole AS (SELECT vec_id, label, [floor(256 * x)::BIGINT FOR x IN v] AS v FROM good),
part AS MATERIALIZED (
  SELECT vec_id, label, p, v[p * (len(v) // 16) + 1 : (p + 1) * (len(v) // 16)] AS x FROM whole, range(16) t(p)
),
book0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x FROM part QUALIFY e < 64
),
{_assigned(0)},
{_moved(0)},
{_assigned(1)},
{_moved(1)},
{_assigned(2)},
coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error
  FROM near2 JOIN whole USING (vec_id) GROUP BY vec_id, label
),
digest AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book2)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM coded, digest
""",
    "op12_decontamination": rf"""
WITH {_words("item", "benchmark", "item_id::VARCHAR")},
{_words("doc", "documents", "doc_id")},
gram AS MATERIALIZED (
  SELECT DISTINCT id AS item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS gram
  FROM item, range(1, greatest(len(w) - 10, 0) + 2) t(i) WHERE len(w) > 0
),
size AS (SELECT DISTINCT n FROM gram),
said AS (
  SELECT id, i, n, array_to_string(w[i : i + n - 1], ' ') AS gram
  FROM doc, size, range(1, len(w) - n + 2) t(i) WHERE len(w) >= n
),
hit AS MATERIALIZED (SELECT said.id, i, said.n, item_id FROM said JOIN gram ON said.n = gram.n AND said.gram = gram.gram),
place AS (SELECT id, count(DISTINCT i + k) AS n_hit FROM hit, range(10) t(k) WHERE k < n GROUP BY id),
owner AS (
  SELECT id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS items FROM hit GROUP BY id
)
SELECT id AS doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN place USING (id) LEFT JOIN owner USING (id)
""",
}

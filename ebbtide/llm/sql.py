"""DuckDB SQL for the operators that SQL can say, over the views of the test tables."""

from __future__ import annotations

# Exclusive or of the polynomial for the bits of a byte, and over the bytes of an id's digits.
_CRC_TABLE = (
    "crc_table AS (SELECT list(list_reduce([0, 1, 2, 3, 4, 5, 6, 7], LAMBDA c, k: CASE WHEN c & 1 = 1 "
    "THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, CAST(i AS BIGINT)) ORDER BY i) AS t FROM range(256) AS r(i))"
)
_CRC = (
    "xor(list_reduce([ascii(x) FOR x IN string_split(CAST(doc_id AS VARCHAR), '')], "
    "LAMBDA c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS INT) + 1]), CAST(4294967295 AS BIGINT)), 4294967295)"
)


def _leaf(n_chars: str) -> str:
    fields = [f"CAST({field} AS VARCHAR)" for field in ("doc_id", "source", "lang", n_chars, "text")]
    return f"sha256({' || '.join(f"COALESCE(strlen({f}) || ':' || {f}, '-')" for f in fields)})"


_STEP = "string_agg(node, '' ORDER BY pos)"

MERKLE = f"""
WITH RECURSIVE {_CRC_TABLE},
leaves AS (
  SELECT doc_id, COALESCE(':' || lang, '-') AS tree, {_leaf('n_chars')} AS leaf,
         CASE WHEN {_CRC} % 7 = 0 THEN {_leaf('n_chars + 1')} END AS given
  FROM documents, crc_table
),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, COUNT(*) OVER (PARTITION BY tree) AS n
  FROM leaves
),
nodes AS (
  SELECT tree, 0 AS depth, pos, n, leaf AS node FROM numbered
  UNION ALL
  SELECT tree, depth + 1, pos // 2, (n + 1) // 2, sha256({_STEP}) FROM nodes WHERE n > 1 GROUP BY tree, depth, pos // 2, n
),
subroots AS (
  SELECT tree, node AS subroot, row_number() OVER (ORDER BY tree) - 1 AS pos, COUNT(*) OVER () AS n FROM nodes WHERE n = 1
),
forest AS (
  SELECT 0 AS depth, pos, n, subroot AS node FROM subroots
  UNION ALL
  SELECT depth + 1, pos // 2, (n + 1) // 2, sha256({_STEP}) FROM forest WHERE n > 1 GROUP BY depth, pos // 2, n
),
-- What every leaf meets: inside its language, then among the languages. A missing sibling is an empty text.
heights AS (SELECT tree, MAX(depth) AS height FROM nodes GROUP BY tree),
met AS (
  SELECT l.tree, l.pos, a.depth, a.pos AS at, COALESCE(b.node, '') AS sibling
  FROM numbered AS l JOIN nodes AS a ON a.tree = l.tree AND a.pos = l.pos // CAST(pow(2, a.depth) AS BIGINT) AND a.n > 1
  LEFT JOIN nodes AS b ON b.tree = a.tree AND b.depth = a.depth AND b.pos = xor(a.pos, 1)
  UNION ALL
  SELECT l.tree, l.pos, h.height + a.depth, a.pos, COALESCE(b.node, '')
  FROM numbered AS l JOIN heights AS h USING (tree) JOIN subroots AS s USING (tree)
  JOIN forest AS a ON a.pos = s.pos // CAST(pow(2, a.depth) AS BIGINT) AND a.n > 1
  LEFT JOIN forest AS b ON b.depth = a.depth AND b.pos = xor(a.pos, 1)
),
proofs AS (
  SELECT tree, pos, sha256(string_agg(sibling, '' ORDER BY depth)) AS proof_sha256, COUNT(*) AS steps FROM met GROUP BY tree, pos
),
folds AS (
  SELECT tree, pos, 0 AS depth, COALESCE(given, leaf) AS node FROM numbered
  UNION ALL
  SELECT f.tree, f.pos, f.depth + 1, sha256(CASE WHEN m.at % 2 = 1 THEN m.sibling || f.node ELSE f.node || m.sibling END)
  FROM folds AS f JOIN met AS m ON m.tree = f.tree AND m.pos = f.pos AND m.depth = f.depth
)
SELECT l.doc_id, l.leaf, s.subroot, r.node AS root, COALESCE(p.proof_sha256, sha256('')) AS proof_sha256, f.node AS folded_root,
       f.node = r.node AS verified
FROM numbered AS l JOIN subroots AS s USING (tree) CROSS JOIN (SELECT node FROM forest WHERE n = 1) AS r
LEFT JOIN proofs AS p ON p.tree = l.tree AND p.pos = l.pos
JOIN folds AS f ON f.tree = l.tree AND f.pos = l.pos AND f.depth = COALESCE(p.steps, 0)
"""

_SIZE = "CAST(COALESCE(len(regexp_extract_all(text, '[^ \\t-\\r]+')), 0) AS BIGINT)"
_KEY = "substr(md5(COALESCE(CAST(doc_id AS VARCHAR), '-') || ':' || COALESCE(text, '')), 1, 16)"

MIXING = f"""
WITH RECURSIVE sized AS (SELECT doc_id, source, {_SIZE} AS size, {_KEY} AS key FROM documents),
sources AS (
  SELECT source, source_size, 2 * CAST(source_size AS DOUBLE) AS most,
         CAST([5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT) + 1] AS DOUBLE) AS weight
  FROM (SELECT source, CAST(SUM(size) AS BIGINT) AS source_size FROM sized GROUP BY source)
),
levels AS (
  SELECT 15E-1 * CAST(SUM(source_size) AS DOUBLE) AS wanted, 15E-1 * CAST(SUM(source_size) AS DOUBLE) / SUM(weight) AS level FROM sources
  UNION ALL
  SELECT wanted, risen FROM (
    SELECT wanted, level, (wanted - COALESCE((SELECT SUM(most) FROM sources WHERE most < level * weight), 0E0))
           / (SELECT SUM(weight) FROM sources WHERE most >= level * weight) AS risen
    FROM levels
  ) WHERE risen > level
),
targets AS (
  SELECT source, source_size, least(most, (SELECT MAX(level) FROM levels) * weight) AS target FROM sources
),
budgets AS (
  SELECT *, CAST(round(target) AS BIGINT) - epochs * source_size AS rest
  FROM (SELECT *, CASE WHEN source_size > 0 THEN least(CAST(floor(target / source_size) AS BIGINT), 2) ELSE 0 END AS epochs FROM targets)
),
ordered AS (
  SELECT *, CAST(COALESCE(SUM(size) OVER (PARTITION BY source ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
  FROM sized
)
SELECT o.doc_id, o.size, b.source_size, b.target,
       CAST(b.epochs * o.size + greatest(0, least(o.size, b.rest - o.before)) AS BIGINT) AS taken
FROM ordered AS o JOIN budgets AS b ON o.source IS NOT DISTINCT FROM b.source
"""

_SCORE = "CAST(CAST(a AS HUGEINT) * a * 1000000 // (CAST({l} AS HUGEINT) * {r}) AS BIGINT)"

PHRASES = f"""
WITH pieces AS (
  SELECT lang, text, row_number() OVER () AS piece FROM (
    SELECT COALESCE(lang, 'und') AS lang, unnest(regexp_split_to_array(
      translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\n-\\r]')) AS text
    FROM documents)
),
split AS MATERIALIZED (SELECT lang, piece, list_filter(regexp_split_to_array(text, '[ \\t]+'), LAMBDA w: w <> '') AS words FROM pieces),
occurrences AS MATERIALIZED (
  SELECT lang, w1, CASE WHEN piece = next_piece THEN w2 END AS w2, CASE WHEN piece = last_piece THEN w3 END AS w3 FROM (
    SELECT lang, piece, word AS w1, lead(word) OVER o AS w2, lead(piece) OVER o AS next_piece, lead(word, 2) OVER o AS w3,
           lead(piece, 2) OVER o AS last_piece
    FROM (SELECT lang, piece, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM split) WINDOW o AS (ORDER BY piece, pos))
),
f1 AS MATERIALIZED (SELECT lang, w1, COUNT(*) AS f FROM occurrences GROUP BY ALL),
f2 AS MATERIALIZED (SELECT lang, w1, w2, COUNT(*) AS f FROM occurrences WHERE w2 IS NOT NULL GROUP BY ALL HAVING COUNT(*) >= 10),
f3 AS MATERIALIZED (SELECT lang, w1, w2, w3, COUNT(*) AS f FROM occurrences WHERE w3 IS NOT NULL GROUP BY ALL HAVING COUNT(*) >= 10),
cuts AS (
  SELECT p.lang, p.w1 || ' ' || p.w2 AS phrase, p.f AS a, 1 AS k, x.f AS l, y.f AS r
  FROM f2 AS p JOIN f1 AS x ON x.lang = p.lang AND x.w1 = p.w1 JOIN f1 AS y ON y.lang = p.lang AND y.w1 = p.w2
  WHERE NOT EXISTS (SELECT 1 FROM f3 AS t WHERE t.lang = p.lang AND t.w1 = p.w1 AND t.w2 = p.w2 AND 100 * t.f >= 50 * p.f)
    AND NOT EXISTS (SELECT 1 FROM f3 AS t WHERE t.lang = p.lang AND t.w2 = p.w1 AND t.w3 = p.w2 AND 100 * t.f >= 50 * p.f)
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, 1, x.f, y.f
  FROM f3 AS t JOIN f1 AS x ON x.lang = t.lang AND x.w1 = t.w1 JOIN f2 AS y ON y.lang = t.lang AND y.w1 = t.w2 AND y.w2 = t.w3
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, 2, x.f, y.f
  FROM f3 AS t JOIN f2 AS x ON x.lang = t.lang AND x.w1 = t.w1 AND x.w2 = t.w2 JOIN f1 AS y ON y.lang = t.lang AND y.w1 = t.w3
),
scored AS (SELECT *, {_SCORE.format(l='l', r='r')} AS score FROM cuts),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM weakest)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score
FROM ranked JOIN (SELECT lang, SUM(f) AS n FROM f1 GROUP BY lang) USING (lang) WHERE rank <= 2000
"""

VECTORS = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, LAMBDA x: x IS NULL OR NOT isfinite(x))) = 0
),
measured AS (SELECT *, sqrt(list_inner_product(v, v)) AS norm FROM usable),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM measured AS a JOIN measured AS b
  ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id AND a.norm > 0 AND b.norm > 0
  WHERE list_inner_product(a.v, b.v) / (a.norm * b.norm) >= 98E-2
),
reached AS (
  SELECT vec_id, vec_id AS other FROM embeddings
  UNION
  SELECT links.b, reached.other FROM reached JOIN links ON links.a = reached.vec_id
),
least AS (SELECT vec_id, MIN(other) AS component_id FROM reached GROUP BY vec_id),
counts AS (SELECT a AS vec_id, COUNT(*) AS n_links FROM links GROUP BY a)
SELECT e.vec_id, COALESCE(n_links, 0) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings AS e JOIN least USING (vec_id) LEFT JOIN counts USING (vec_id)
"""

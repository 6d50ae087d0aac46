"""SQL for the numbered queries that SQL can express."""

from .lines import WHITE

_VALID = "embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR isnan(x) OR isinf(x)]) = 0"

#: Components of pairs (a, b): the smallest node that each node reaches.
_REACH = """
sym AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a AS node, b AS other FROM sym
          UNION SELECT r.node, s.b FROM reach r JOIN sym s ON r.other = s.a),
groups AS (SELECT node, min(other) AS low FROM reach GROUP BY node)"""

ORACLES = {
    "op2_pivot_topk": f"""
WITH v AS (SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS e
           FROM embeddings WHERE vec_id IS NOT NULL AND {_VALID}),
scored AS (SELECT q.vec_id AS query_id, c.vec_id,
                  CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
           FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank
           FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
    "op11_hard_negatives": f"""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS e
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND {_VALID}),
s AS (SELECT a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id,
             CAST(list_inner_product(a.e, c.e) AS BIGINT) AS score
      FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
             CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)
                  AS INT) AS rank
      FROM p JOIN s USING (anchor_id)
      WHERE NOT same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10""",
    "op12_chat_format": r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
           UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, length(regexp_replace(text, '([<\[])(\\*/?(?:s>|INST\]|ROLE\]))', '\1\\\2', 'g')) AS n,
             length(regexp_replace(role, '([<\[])(\\*/?(?:s>|INST\]|ROLE\]))', '\1\\\2', 'g')) AS m FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(n + CASE role WHEN 'user' THEN 13 WHEN 'assistant' THEN 4 ELSE 17 + m END) AS BIGINT)
         AS formatted_chars
FROM e GROUP BY conv_id""",
    "op4_vector_dedup": f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND {_VALID}),
n AS (SELECT * FROM v WHERE list_inner_product(e, e) > 0),
links AS (SELECT p.vec_id AS a, q.vec_id AS b FROM n p JOIN n q ON p.label = q.label AND p.vec_id <> q.vec_id
          WHERE list_cosine_similarity(p.e, q.e) >= 0.98),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a),{_REACH}
SELECT vec_id, CAST(coalesce(d.n, 0) AS BIGINT) AS n_links,
       least(vec_id, coalesce(g.low, vec_id)) AS component_id,
       vec_id <= coalesce(g.low, vec_id) AS kept
FROM embeddings LEFT JOIN degree d ON d.a = vec_id LEFT JOIN groups g ON g.node = vec_id""",
    "op5_shingle_join": f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
      ELSE list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]) END AS s
      FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
links AS (SELECT p.doc_id AS a, q.doc_id AS b FROM e p JOIN e q ON p.x = q.x AND p.doc_id < q.doc_id
          GROUP BY p.doc_id, q.doc_id, p.n, q.n HAVING 100 * count(*) >= 75 * (p.n + q.n - count(*))),{_REACH}
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(doc_id, coalesce(g.low, doc_id)) AS component_id
FROM s LEFT JOIN groups g ON g.node = doc_id""",
    "op8_line_spread": f"""
WITH l AS (SELECT doc_id, source, text, generate_subscripts(string_split(text, chr(10)), 1) AS nth,
                  unnest(string_split(text, chr(10))) AS part FROM documents),
c AS (SELECT *, trim(part, '{WHITE}') AS line FROM l),
m AS (SELECT *, CASE WHEN len(string_split_regex(line, '\\s+'))
                          + len(regexp_extract_all(line, '[\\p{{Han}}\\p{{Hiragana}}\\p{{Katakana}}\\p{{Thai}}]')) >= 5
                     THEN 5 ELSE 20 END AS need FROM c),
bad AS (SELECT line, min([doc_id, nth]) AS first FROM m WHERE line <> ''
        GROUP BY line, need HAVING count(DISTINCT source) >= need),
f AS (SELECT m.*, bad.line IS NOT NULL AND [doc_id, nth] <> first AS gone
      FROM m LEFT JOIN bad ON m.line = bad.line),
d AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
             coalesce(string_agg(part, chr(10) ORDER BY nth) FILTER (NOT gone), '') AS text
      FROM f GROUP BY doc_id)
SELECT doc_id, d.text, n_lines, n_removed, n_removed = 0 OR trim(d.text, '{WHITE}') <> '' AS kept FROM d""",
}

"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP1 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g
  FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 80 * (x.n + y.n - o)),
both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reached(doc_id, root) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT both_ways.b, root FROM reached JOIN both_ways ON both_ways.a = reached.doc_id
)
SELECT r.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(root) AS component_id
FROM reached r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""

OP6 = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), g AS (
  SELECT payload_digest, payload_bytes, max(page_id) AS last FROM p WHERE payload_bytes >= 1000 GROUP BY ALL
)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
  CASE WHEN last IS NULL OR page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> last THEN last END AS refers_to
FROM p LEFT JOIN g USING (payload_digest, payload_bytes)
"""

OP11 = rf"""
WITH t AS (
  SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents
), d AS (SELECT id, doc_id, ts, len(ts) AS n FROM t WHERE len(ts) > 0),
s AS (SELECT count(*) AS big_n, sum(n) AS big_l FROM d),
tf AS (SELECT id, term, count(*) AS tf FROM (SELECT id, unnest(ts) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, s GROUP BY term, big_n),
q AS (
  SELECT DISTINCT item, item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS item, item_id, text FROM benchmark)
), r AS (
  SELECT item, item_id, d.id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * big_n)::BIGINT // big_l::BIGINT))))::BIGINT AS score
  FROM q JOIN w USING (term) JOIN tf USING (term) JOIN d ON d.id = tf.id, s GROUP BY ALL
), o AS (SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM r WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM o WHERE rank <= 10
"""


def clustering(rounds: int = 3, k: int = 16) -> str:
    """Assignments and means as a chain of tables ``c0, a0, c1, a1, ...``; vectors and centroids as one row a component."""
    steps = [
        """kept AS (
  SELECT row_number() OVER () AS id, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)""",
        "p AS (SELECT id, unnest(range(64)) AS j, unnest(v) AS x FROM kept)",
        f"""c0 AS (
  SELECT row_number() OVER (ORDER BY h NULLS LAST, v) - 1 AS c, v FROM (SELECT sha256('1:' || vec_id) AS h, v FROM kept)
  QUALIFY row_number() OVER (ORDER BY h NULLS LAST, v) <= {k}
)""",
    ]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS (
  SELECT id, c, d FROM (
    SELECT id, c, sum((p.x - q.x) * (p.x - q.x))::BIGINT AS d
    FROM p JOIN (SELECT c, unnest(range(64)) AS j, unnest(v) AS x FROM c{r}) q USING (j) GROUP BY id, c
  ) QUALIFY row_number() OVER (PARTITION BY id ORDER BY d, c) = 1
)""")
        if r < rounds:
            steps.append(f"""c{r + 1} AS (
  SELECT c{r}.c, coalesce(m.v, c{r}.v) AS v FROM c{r} LEFT JOIN (
    SELECT c, list(((s - (s % n + n) % n) // n)::BIGINT ORDER BY j) AS v
    FROM (SELECT c, j, sum(x)::HUGEINT AS s, count(*) AS n FROM p JOIN a{r} USING (id) GROUP BY c, j) GROUP BY c
  ) m USING (c)
)""")
    return f"""WITH {", ".join(steps)}
SELECT vec_id, a.c::INTEGER AS cluster, d AS distance, sum(d) OVER (PARTITION BY a.c)::BIGINT AS cluster_inertia,
  sum(d) OVER ()::BIGINT AS inertia, sha256(array_to_string(z.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN kept USING (id) JOIN c{rounds} z ON z.c = a.c
"""


ORACLE: dict[str, str] = {"op1_ngram_jaccard_join": OP1, "op6_warc": OP6, "op11_ranked_search": OP11, "op12_centroid_clustering": clustering()}

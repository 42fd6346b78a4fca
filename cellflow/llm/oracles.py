"""The same results in SQL, where SQL can express an operator."""

LLM_ORACLES: dict[str, str] = {}

LLM_ORACLES["op6_exact_dedup"] = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
), g AS (
  SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
"""

LLM_ORACLES["op9_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, md5(coalesce(text, '')) AS key, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), hashed AS (
  SELECT *, ('0x' || substr(md5(line), 1, 8))::BIGINT AS h FROM lines
), rolled AS (
  SELECT *, h + 31 * coalesce(lag(h) OVER w, 0) + 961 * coalesce(lag(h, 2) OVER w, 0) AS r FROM hashed
  WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
), marked AS (
  SELECT *, (r % 1000003) % 3 = 0 AS mark FROM rolled
), ended AS (
  SELECT *, mark AND NOT coalesce(lag(mark) OVER (PARTITION BY doc_id ORDER BY pos), false) AS ends FROM marked
), numbered AS (
  SELECT *, coalesce(sum(CASE WHEN ends THEN 1 ELSE 0 END)
    OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS number
  FROM ended
), chunks AS (
  SELECT doc_id, key, number, count(*) AS n, string_agg(line, chr(10) ORDER BY pos) AS chunk
  FROM numbered GROUP BY doc_id, key, number HAVING count(*) >= 2
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY chunk ORDER BY doc_id, number) AS rank FROM chunks
), gone AS (
  SELECT doc_id, number FROM ranked WHERE rank > 1
), flagged AS (
  SELECT n.doc_id, n.pos, n.line, g.number IS NOT NULL AS removed
  FROM numbered n LEFT JOIN gone g ON n.doc_id = g.doc_id AND n.number = g.number
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (removed) AS n_removed,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT removed), '')) AS text_sha256
FROM flagged GROUP BY doc_id
"""

LLM_ORACLES["op3_jaccard_join"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE
    WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM words
), shingles AS (
  SELECT doc_id, unnest(s) AS shingle FROM sets
), common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
  FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id < y.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM common JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b
  WHERE 100 * n >= 75 * (len(x.s) + len(y.s) - n)
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reached r JOIN both_ways l ON r.other = l.a
)
SELECT doc_id, len(s) AS n_shingles, component_id
FROM sets JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) USING (doc_id)
"""

LLM_ORACLES["op11_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || chr(10) || coalesce(text, '')), 1, 15))::BIGINT AS hash
  FROM documents
), sources AS (
  SELECT source, sum(size) AS source_size, 3 * sum(size) AS cap, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM d GROUP BY source
), filling AS (
  SELECT *, sum(source_size) OVER () AS words,
    coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS after
  FROM sources
), ended AS (
  SELECT *, (words - before) * weight > cap * after AS ends FROM filling
), targets AS (
  SELECT source, source_size, cap, CASE WHEN ends THEN cap::DOUBLE ELSE
    ((words - sum(CASE WHEN ends THEN cap ELSE 0 END) OVER ()) * weight)::DOUBLE / sum(CASE WHEN ends THEN 0 ELSE weight END) OVER () END AS target
  FROM ended
), plans AS (
  SELECT source, source_size, target, least(floor(target + 0.5)::BIGINT, cap) AS whole FROM targets
), places AS (
  SELECT source, hash, sum(size) AS tied, sum(sum(size)) OVER (PARTITION BY source ORDER BY hash) - sum(size) AS before FROM d GROUP BY source, hash
)
SELECT doc_id, d.source, size, source_size::BIGINT AS source_size, target,
  CASE WHEN size = 0 THEN 0 ELSE
    (whole // source_size * size + CASE WHEN before + tied <= whole % source_size THEN size
      WHEN before < whole % source_size THEN (whole % source_size - before) * size // tied ELSE 0 END)::BIGINT END AS taken
FROM d JOIN plans p ON d.source IS NOT DISTINCT FROM p.source
JOIN places h ON d.source IS NOT DISTINCT FROM h.source AND d.hash = h.hash
"""

LLM_ORACLES["op12_hard_negatives"] = r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.x, b.x)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS n FROM scores WHERE same) WHERE n <= 5
), negatives AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
  FROM positives p JOIN scores s ON p.anchor_id = s.anchor_id
  WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 3
"""

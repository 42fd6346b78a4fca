"""The catalogue's queries as plain SQL over the same tables, for checking results in DuckDB."""

from __future__ import annotations

from datetime import datetime

# One row per cell: the last write of every (user, event type, version).
ACTIVITY = """
activity AS (
  SELECT user_id, event_type, epoch_us(ts) AS version, arg_max(value, event_id) AS value
  FROM events GROUP BY user_id, event_type, ts)"""
SPEND = """
spend AS (
  SELECT o_custkey AS custkey, o_orderpriority AS priority, epoch_us(o_orderdate) AS version,
         arg_max(o_totalprice, o_orderkey) AS value
  FROM orders GROUP BY o_custkey, o_orderpriority, o_orderdate)"""
BRANDS = """
order_brands AS (SELECT l_orderkey, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey),
counted AS (SELECT l_orderkey, p_brand, count(*) AS n FROM order_brands GROUP BY l_orderkey, p_brand)"""
# Sets as multisets: a repeated brand may fill a pair or triple twice.
PAIRS = BRANDS + """,
pairs AS (
  SELECT a.l_orderkey, a.p_brand || ',' || b.p_brand AS pair
  FROM counted a JOIN counted b ON a.l_orderkey = b.l_orderkey AND a.p_brand < b.p_brand
  UNION ALL SELECT l_orderkey, p_brand || ',' || p_brand FROM counted WHERE n >= 2)"""
TRIPLES = BRANDS + """,
copies AS (
  SELECT l_orderkey, p_brand, unnest(range(least(n, 3))) AS copy FROM counted),
triples AS (
  SELECT DISTINCT a.l_orderkey, a.p_brand || ',' || b.p_brand || ',' || c.p_brand AS triple
  FROM copies a
  JOIN copies b ON a.l_orderkey = b.l_orderkey AND (a.p_brand < b.p_brand OR (a.p_brand = b.p_brand AND a.copy < b.copy))
  JOIN copies c ON b.l_orderkey = c.l_orderkey AND (b.p_brand < c.p_brand OR (b.p_brand = c.p_brand AND b.copy < c.copy)))"""


def _micros(year: int, month: int, day: int) -> int:
    return int((datetime(year, month, day) - datetime(1970, 1, 1)).total_seconds()) * 1_000_000


def _newest_activity(n: int = 1, where: str = "true") -> str:
    return f"""
WITH {ACTIVITY},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY version DESC) AS rank
  FROM activity WHERE {where})
SELECT user_id, event_type, version, value FROM ranked WHERE rank <= {n}"""


def _slices(n: int, where: str = "true") -> str:
    """Bounded slices as ranked rows; ``pos`` numbers them in canonical order."""
    return f"""
WITH {ACTIVITY},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY version DESC) AS rank
  FROM activity WHERE {where}),
cells AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_type, version DESC) AS pos
  FROM ranked WHERE rank <= {n})"""


_STATS = """
count(*) AS size, round(sum(value), 4) AS sum, round(sum(value * value), 6) AS sum_squares,
round(avg(value), 9) AS avg, round(var_pop(value), 2) AS variance, round(stddev_pop(value), 6) AS stddev,
round(min(value), 4) AS min, round(max(value), 4) AS max"""
_CENTS = "CAST(round(value * 100) AS BIGINT)"


def _shown(order: str) -> str:
    return f"string_agg(CAST({_CENTS} AS VARCHAR), ',' ORDER BY {order})"




def _view_click(rank: str) -> str:
    return (
        _slices(3)
        + f""",
ends AS (
  SELECT user_id, event_type, {rank}(value, version) AS v FROM cells
  WHERE event_type IN ('view', 'click') GROUP BY user_id, event_type)
SELECT a.user_id, round(a.v - b.v, 4) AS score FROM ends a JOIN ends b ON a.user_id = b.user_id
WHERE a.event_type = 'view' AND b.event_type = 'click'"""
    )


_SCALED = """
scaled AS (
  SELECT (l_quantity - 25.5) / 14.43 AS quantity, (l_discount - 0.05) / 0.03 AS discount,
         l_extendedprice / 10000 AS price FROM lineitem)"""

ORACLES: dict[str, str] = {
    "latest_cell_family": _newest_activity(),
    "latest_n_versions": _newest_activity(3),
    "time_range_between": _newest_activity(1, f"version >= {_micros(2024, 1, 10)} AND version < {_micros(2024, 1, 12)}"),
    "time_range_after": _newest_activity(3, f"version >= {_micros(2024, 1, 28)}"),
    "time_range_before": _newest_activity(1, f"version < {_micros(2024, 1, 3)}"),
    "time_range_at": f"WITH {SPEND} SELECT custkey, priority, version, value FROM spend WHERE version = {_micros(1998, 2, 6)}",
    "entities_scan": "SELECT DISTINCT user_id FROM events",
    "missing_rows_dropped": """
SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id
WHERE d.lang IS NOT NULL AND l.quality IS NOT NULL AND l.toxic IS NOT NULL""",
    "missing_replaced": """
SELECT d.doc_id, d.lang, coalesce(l.quality, -1) AS quality
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE d.lang IS NOT NULL""",
    "all_missing_replaced": """
SELECT d.doc_id, coalesce(l.quality, -1) AS quality, coalesce(l.toxic, -2) AS toxic, CASE WHEN l.toxic IS NULL THEN 2 ELSE 1 END AS cells
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "multi_column_profile": """
SELECT c_custkey AS custkey, c_name AS name, c_nationkey AS nation, c_acctbal AS acctbal, c_mktsegment AS segment
FROM customer
WHERE c_name IS NOT NULL AND c_nationkey IS NOT NULL AND c_acctbal IS NOT NULL AND c_mktsegment IS NOT NULL""",
    "multi_view_scan": f"""
WITH {SPEND},
newest AS (SELECT custkey, priority, arg_max(value, version) AS v FROM spend GROUP BY custkey, priority)
SELECT c_custkey AS custkey, c_mktsegment AS segment, u.v AS urgent, coalesce(l.v, 0.0) AS low
FROM customer JOIN newest u ON u.custkey = c_custkey AND u.priority = '1-URGENT'
LEFT JOIN newest l ON l.custkey = c_custkey AND l.priority = '5-LOW'
WHERE c_mktsegment IS NOT NULL""",
    "regex_qualifier": _newest_activity(1, "regexp_full_match(event_type, '(pur|si).*')"),
    "range_qualifier": _newest_activity(1, "event_type >= 'error' AND event_type < 'signup'"),
    "and_or_qualifier": _newest_activity(1, "(event_type LIKE '%i%' AND event_type >= 's') OR event_type <= 'click'"),
    "data_request_scan": f"""
WITH {SPEND},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY custkey, priority ORDER BY version DESC) AS rank FROM spend
  WHERE version >= {_micros(1995, 1, 1)} AND version < {_micros(1997, 1, 1)} AND priority >= '2' AND priority < '5')
SELECT custkey, count(*) AS cells, round(sum(value), 2) AS total FROM ranked WHERE rank <= 2 GROUP BY custkey""",
    "text_round_trip": "SELECT c_custkey AS custkey, c_name AS name, CAST(c_nationkey AS INTEGER) AS nation, true AS placed FROM customer",
    "line_offsets": """
WITH lines AS (SELECT c_custkey, c_nationkey, concat_ws(chr(9), c_custkey, c_name, c_nationkey) AS line FROM customer)
SELECT c_custkey AS custkey, line, CAST(coalesce(sum(strlen(line) + 1) OVER (
  PARTITION BY c_nationkey ORDER BY c_custkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset" FROM lines""",
    "tsv_round_trip": "SELECT s_suppkey AS suppkey, s_name AS name, s_acctbal AS acctbal FROM supplier",
    "sequence_round_trip": "SELECT o_orderstatus AS status, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders GROUP BY o_orderstatus",
    "side_key_values": """
SELECT p_brand AS brand, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS orders
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand""",
    "side_records": "SELECT c_custkey, c_name AS name, c_acctbal AS acctbal FROM customer",
    "side_delimited": "SELECT s_suppkey, n_name AS name FROM supplier JOIN nation ON s_nationkey = n_nationkey",
    "map_family_write": f"""
WITH {SPEND},
ranked AS (SELECT *, row_number() OVER (PARTITION BY custkey, priority ORDER BY version DESC) AS r FROM spend)
SELECT custkey, priority, version, value FROM ranked WHERE r <= 2""",
    "colocated_scan": f"""
WITH {SPEND},
ranked AS (SELECT *, row_number() OVER (PARTITION BY custkey, priority ORDER BY version DESC) AS r FROM spend)
SELECT custkey, priority, version, value FROM ranked WHERE r <= 2""",
    "base_and_delta_scan": f"""
WITH {SPEND},
ranked AS (SELECT *, row_number() OVER (PARTITION BY custkey, priority ORDER BY version DESC) AS r FROM spend)
SELECT custkey, priority, version, value FROM ranked WHERE r <= 2""",
    "log_time_range": f"""
WITH {SPEND}
SELECT custkey, priority, version, value FROM spend WHERE version >= {_micros(1995, 2, 1)} AND version < {_micros(1995, 5, 1)}""",
    "inferred_schema_write": "SELECT s_suppkey AS suppkey, s_name, s_acctbal FROM supplier",
    "nulls_and_empties_write": """
SELECT doc_id, CASE WHEN quality = 1 THEN 'good' END AS name, CAST(CASE WHEN toxic = 1 THEN 1 ELSE 0 END AS BIGINT) AS words FROM labels""",
    "several_outputs": """
SELECT l_suppkey, count(*) AS lines, round(sum(l_quantity), 2) AS quantity,
       CASE WHEN count(*) >= 100 THEN 'many' ELSE 'few' END AS output FROM lineitem GROUP BY l_suppkey""",
    "strict_types": "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders",
    "random_ids": "SELECT count(*) AS rows, count(*) AS ids FROM events",
    "slice_function_forms": _slices(3) + """
SELECT user_id, round(sum(2 * value), 4) AS sum, round(sum(4 * value * value), 4) AS squares, round(avg(2 * value), 4) AS avg,
       round(var_pop(2 * value), 4) AS variance, round(stddev_pop(2 * value), 4) AS stddev, round(min(2 * value), 4) AS least,
       round(max(2 * value), 4) AS most FROM cells GROUP BY user_id""",
    "family_default": """
SELECT d.doc_id, coalesce('quality:1:' || l.quality || ',toxic:1:' || l.toxic, 'quality:7:-1,toxic:7:-2') AS labels
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "scan_counters": """
SELECT count(*) FILTER (d.lang IS NOT NULL AND l.quality IS NOT NULL) AS rows_kept,
       count(*) AS rows_read, count(*) FILTER (d.lang IS NULL OR l.quality IS NULL) AS rows_skipped
FROM documents d FULL JOIN labels l ON d.doc_id = l.doc_id""",
    "skipped_rows": """
SELECT coalesce(d.doc_id, l.doc_id) AS doc_id,
       concat_ws(',', CASE WHEN d.lang IS NULL THEN 'doc:lang' END, CASE WHEN l.quality IS NULL THEN 'label:quality' END) AS missing
FROM documents d FULL JOIN labels l ON d.doc_id = l.doc_id WHERE d.lang IS NULL OR l.quality IS NULL""",
    "paged_scan": f"""
WITH {ACTIVITY},
placed AS (SELECT *, (row_number() OVER (PARTITION BY user_id ORDER BY event_type, version DESC) - 1) // 20 AS page FROM activity)
SELECT user_id, page, count(*) AS cells, round(sum(value), 2) AS total, max(version) AS newest FROM placed GROUP BY user_id, page""",
    "paged_first_last": f"""
WITH {ACTIVITY},
placed AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_type, version DESC) AS r FROM activity)
SELECT user_id, arg_min(event_type, r) AS first_type, arg_min(version, r) AS first_version, arg_max(event_type, r) AS last_type,
       arg_max(version, r) AS last_version, count(*) AS n, round(sum(value), 4) AS sum, round(var_pop(value), 4) AS variance
FROM placed GROUP BY user_id""",
    "paged_groups": f"""
WITH {ACTIVITY} SELECT user_id, event_type, count(*) AS n, max(version) AS newest FROM activity GROUP BY user_id, event_type""",
    "paged_ordered_fold": f"""
WITH {ACTIVITY},
moves AS (SELECT user_id, abs(value - lag(value) OVER (PARTITION BY user_id ORDER BY event_type, version DESC)) AS moved FROM activity)
SELECT user_id, round(coalesce(sum(moved), 0), 4) AS moved FROM moves GROUP BY user_id""",
    "wide_time_range": """
SELECT o_orderkey AS orderkey, o_orderstatus AS status, o_totalprice AS price FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderstatus IS NOT NULL AND o_totalprice IS NOT NULL""",
    "reader_projection": "SELECT c_custkey AS custkey, c_acctbal AS acctbal FROM customer",
    "slice_stats": f"WITH {ACTIVITY} SELECT user_id, {_STATS} FROM activity GROUP BY user_id",
    "slice_stats_by_qualifier": f"WITH {ACTIVITY} SELECT event_type, {_STATS} FROM activity GROUP BY event_type",
    "slice_stats_of_newest": _slices(3) + f" SELECT user_id, {_STATS} FROM cells GROUP BY user_id",
    "slice_first_last": f"""
WITH {ACTIVITY} SELECT user_id, event_type, arg_max(value, version) AS newest, arg_min(value, version) AS oldest,
count(*) AS cells FROM activity GROUP BY user_id, event_type""",
    "slice_orders": _slices(2)
    + f"""
SELECT user_id, {_shown('pos')} AS canonical, {_shown('version, pos')} AS oldest_first,
       {_shown('version DESC, pos')} AS newest_first, {_shown('value, version, pos')} AS by_value,
       {_shown('event_type, version')} AS by_qualifier,
       arg_min({_CENTS}, pos) AS first, arg_max({_CENTS}, pos) AS last
FROM cells GROUP BY user_id""",
    "slice_groups": _slices(3)
    + f" SELECT user_id, event_type, count(*) AS cells, arg_max({_CENTS}, version) AS newest FROM cells GROUP BY user_id, event_type",
    "slice_groups_by_value": _slices(3)
    + " SELECT user_id, CAST(floor(value / 50) AS BIGINT) AS band, count(*) AS cells FROM cells GROUP BY user_id, band",
    "slice_fold": _slices(3, "event_type = 'purchase'")
    + """,
sized AS (SELECT *, count(*) OVER (PARTITION BY user_id) AS n FROM cells)
SELECT user_id, round(sum(value / power(2, n - pos)), 4) AS folded FROM sized GROUP BY user_id""",
    "slice_equality": f"""
WITH {ACTIVITY},
newest AS (
  SELECT user_id, max(version) AS v, arg_max(value, version) AS x,
         max(version) FILTER (version < {_micros(2024, 1, 25)}) AS ev,
         arg_max(value, version) FILTER (version < {_micros(2024, 1, 25)}) AS ex
  FROM activity WHERE event_type = 'purchase' GROUP BY user_id)
SELECT user_id, v = ev AND x = ex AS unchanged FROM newest WHERE ev IS NOT NULL""",
    "version_count_histogram": f"""
WITH {ACTIVITY}, sizes AS (SELECT user_id, event_type, count(*) AS versions FROM activity GROUP BY user_id, event_type)
SELECT versions, count(*) AS slices FROM sizes GROUP BY versions""",
    "word_count": r"""
SELECT word, count(*) AS n FROM (SELECT unnest(string_split_regex(lower(text), '\s+')) AS word FROM documents) GROUP BY word""",
    "row_shaping": """
SELECT o_orderkey, o_orderpriority AS priority, o_orderstatus, CAST(floor(o_totalprice / 1000) AS BIGINT) AS thousands,
'orders' AS source FROM orders WHERE o_totalprice > 100000""",
    "flat_map_rows": r"""
SELECT word, count(*) AS n, min(p_partkey) AS first_part
FROM (SELECT p_partkey, unnest(string_split_regex(p_name, '\s+')) AS word FROM part) GROUP BY word""",
    "scalar_functions": r"""
SELECT p_partkey, lower(p_brand) AS low, upper(p_name) AS up, trim('  ' || p_type || ' ') AS trimmed,
CAST(length(p_name) AS BIGINT) AS len, string_split_regex(p_name, '\s+')[1] AS token,
CAST(string_split(p_brand, '#')[2] AS BIGINT) AS brand_number, CAST(p_size AS VARCHAR) AS size_text,
p_brand || ',' || p_type AS joined FROM part""",
    "nested_values": r"""
SELECT p_partkey, p_name AS name, p_size AS size, p_brand AS brand, string_split_regex(p_name, '\s+')[1] AS head FROM part""",
    "group_sizes": """
SELECT l_returnflag, l_linestatus, count(*) AS size, count(l_shipdate) AS n, sum(l_quantity) AS reduced
FROM lineitem GROUP BY l_returnflag, l_linestatus""",
    "average_all": "SELECT count(*) AS size, round(avg(l_extendedprice), 2) AS average, 'AVERAGE' AS name FROM lineitem",
    "indexed_reduce": """
SELECT label, CAST(i AS BIGINT) AS index, round(sum(CAST(x AS DOUBLE)), 3) AS total
FROM (SELECT label, unnest(embedding) AS x, unnest(range(len(embedding))) AS i FROM embeddings) GROUP BY label, i""",
    "vector_products": """
SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))), 4) AS norm2,
round(2 * list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))), 4) AS twice FROM embeddings""",
    "user_fold": "SELECT round(max(abs(l_extendedprice - 2000 * l_quantity)), 2) AS farthest FROM lineitem",
    "pack_unpack": "SELECT c_custkey, c_name AS name, c_acctbal AS balance FROM customer",
    "writer_schema_projection": "SELECT p_partkey, p_brand, p_size FROM part",
    "join_entity": """
SELECT c_mktsegment AS segment, count(*) AS n, round(sum(o_totalprice), 2) AS total
FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment IS NOT NULL GROUP BY c_mktsegment""",
    "join_composite_entity": f"""
WITH {SPEND},
newest AS (SELECT custkey, priority, arg_max(value, version) AS value FROM spend GROUP BY custkey, priority),
counted AS (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY o_custkey, o_orderpriority)
SELECT custkey, priority, n, value FROM newest JOIN counted ON custkey = o_custkey AND priority = o_orderpriority""",
    "join_hashed_entity": """
SELECT md5(strlen(CAST(c_custkey AS VARCHAR)) || ':' || CAST(c_custkey AS VARCHAR)) AS eid, c_name, count(*) AS n
FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_name""",
    "entity_order": """
WITH ranked AS (
  SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_mktsegment, c_custkey) AS up,
         row_number() OVER (PARTITION BY c_nationkey ORDER BY c_mktsegment DESC, c_custkey DESC) AS down FROM customer)
SELECT a.c_nationkey, a.c_mktsegment AS lo0, a.c_custkey AS lo1, b.c_mktsegment AS hi0, b.c_custkey AS hi1
FROM ranked a JOIN ranked b ON a.c_nationkey = b.c_nationkey WHERE a.up = 1 AND b.down = 1""",
    "side_lookup": """
SELECT c_custkey, n_name AS nation, r_name AS region
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
    "side_lookup_table": """
SELECT o_orderkey, o_custkey, c_acctbal AS acctbal FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
    "side_contains": """
SELECT n_nationkey, n_name, n_nationkey IN (SELECT s_nationkey FROM supplier) AS has_supplier FROM nation""",
    "group_count_join": """
SELECT l_orderkey, l_partkey, l_suppkey, count(*) OVER (PARTITION BY l_suppkey) AS lines_of_supplier FROM lineitem""",
    "total_count_join": "SELECT o_orderkey, o_orderpriority, (SELECT count(*) FROM orders) AS n FROM orders",
    "cross_one_row": "SELECT o_orderkey, round(o_totalprice / (SELECT max(o_totalprice) FROM orders), 6) AS share FROM orders",
    "item_pairs": f"WITH {PAIRS} SELECT pair, count(*) AS n FROM pairs GROUP BY pair",
    "item_triples": f"WITH {TRIPLES} SELECT triple, count(*) AS n FROM triples GROUP BY triple",
    "item_sets_raw": """
WITH counted AS (
  SELECT l_orderkey, l_returnflag || l_linestatus AS state, count(*) AS n FROM lineitem GROUP BY l_orderkey, state)
SELECT a.state || ',' || b.state AS pair
FROM counted a JOIN counted b ON a.l_orderkey = b.l_orderkey AND a.state < b.state
UNION ALL SELECT state || ',' || state FROM counted WHERE n >= 2""",
    "support_constant": f"""
WITH {PAIRS} SELECT pair, count(*) AS frequency, 500.0::DOUBLE AS normalizer, round(count(*) / 500.0, 6) AS support
FROM pairs GROUP BY pair HAVING count(*) / 500.0 > 0.5""",
    "support_frame": f"""
WITH {PAIRS}, total AS (SELECT count(*) AS normalizer FROM orders)
SELECT pair, count(*) AS frequency, normalizer, round(count(*) / normalizer, 6) AS support
FROM pairs, total GROUP BY pair, normalizer HAVING count(*) / normalizer > 0.025""",
    "frequent_itemsets": f"""
WITH {PAIRS}, {TRIPLES.split(BRANDS + ',')[1]},
sets AS (SELECT pair AS itemset FROM pairs UNION ALL SELECT triple FROM triples),
total AS (SELECT count(DISTINCT l_orderkey) AS n FROM order_brands)
SELECT itemset, count(*) AS frequency, round(count(*) / n, 6) AS support
FROM sets, total GROUP BY itemset, n HAVING count(*) / n > 0.0285""",
    "upsert_latest_write": f"WITH {SPEND} SELECT custkey, priority, version, value FROM spend",
    "cell_log_round_trip": """
SELECT c_custkey AS custkey, c_name AS name, CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS acctbal,
c_nationkey AS nation FROM customer""",
    "extract_score": f"""
WITH {SPEND},
ranked AS (SELECT *, row_number() OVER (PARTITION BY custkey, priority ORDER BY version DESC) AS rank FROM spend),
mean AS (SELECT custkey, avg(value) AS m FROM ranked WHERE rank <= 2 GROUP BY custkey)
SELECT c_custkey AS custkey, round(0.7310585786 * (c_acctbal / 1000) + 0.4401234567 * (m / 1000) + n_regionkey, 6) AS score
FROM customer JOIN mean ON custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "score_no_extractor": f"""
WITH {SPEND},
newest AS (SELECT custkey, priority, arg_max(value, version) AS v FROM spend GROUP BY custkey, priority)
SELECT custkey, round(max(v) + custkey, 2) AS score FROM newest GROUP BY custkey""",
    "selector_first": _view_click("arg_max"),
    "selector_last": _view_click("arg_min"),
    "selector_all": _slices(3, "event_type = 'view'") + f" SELECT user_id, {_shown('pos')} AS score FROM cells GROUP BY user_id",
    "evaluate_distance": f"""
WITH {ACTIVITY},
newest AS (SELECT user_id, event_type, arg_max(value, version) AS v FROM activity GROUP BY user_id, event_type),
apart AS (
  SELECT abs(a.v - b.v) AS d FROM newest a JOIN newest b ON a.user_id = b.user_id
  WHERE a.event_type = 'view' AND b.event_type = 'click')
SELECT round(avg(d), 6) AS mean, round(max(d), 4) AS worst, count(*) AS n FROM apart""",
    "evaluate_rows_only": f"""
WITH {SPEND},
newest AS (SELECT custkey, priority, arg_max(value, version) AS v FROM spend GROUP BY custkey, priority)
SELECT a.custkey, round(abs(a.v - b.v), 2) AS apart, round(a.v / b.v, 6) AS ratio
FROM newest a JOIN newest b ON a.custkey = b.custkey WHERE a.priority = '1-URGENT' AND b.priority = '5-LOW'""",
    "prepare_train_score": """
WITH totals AS (SELECT o_custkey AS custkey, sum(o_totalprice) AS total FROM orders GROUP BY o_custkey),
mean AS (SELECT avg(total) AS m FROM totals)
SELECT custkey, round(total / m, 6) AS score FROM totals, mean""",
    "lm_one_step": f"""
WITH {_SCALED}
SELECT 0 :: BIGINT AS index, round(0.25 * sum(price), 2) AS theta, round(sum(price), 2) AS gradient FROM scaled
UNION ALL SELECT 1, round(0.25 * sum(price * quantity), 2), round(sum(price * quantity), 2) FROM scaled""",
    "lm_converged": f"""
WITH {_SCALED}
SELECT 0 :: BIGINT AS index, round(regr_intercept(price, quantity), 4) AS theta FROM scaled
UNION ALL SELECT 1, round(regr_slope(price, quantity), 4) FROM scaled""",
    "lm_wide": """
WITH lines AS (
  SELECT l_extendedprice / 10000 AS price, (l_quantity - 25.5) / 14.43 AS quantity, day(l_shipdate) AS day FROM lineitem)
SELECT 0 :: BIGINT AS index, round(0.001 * sum(price), 4) AS theta, 1 :: BIGINT AS iterations FROM lines
UNION ALL SELECT d.d, round(0.001 * coalesce(sum(price), 0), 4), 1 FROM range(1, 32) d(d) LEFT JOIN lines ON day = d.d GROUP BY d.d
UNION ALL SELECT 32, round(0.001 * sum(price * quantity), 4), 1 FROM lines""",
    "lm_two_features": f"""
WITH {_SCALED},
m AS (
  SELECT var_pop(quantity) AS qq, var_pop(discount) AS dd, covar_pop(quantity, discount) AS qd,
         covar_pop(price, quantity) AS pq, covar_pop(price, discount) AS pd,
         avg(price) AS p, avg(quantity) AS q, avg(discount) AS d FROM scaled),
slopes AS (
  SELECT (pq * dd - pd * qd) / (qq * dd - qd * qd) AS tq, (pd * qq - pq * qd) / (qq * dd - qd * qd) AS td, p, q, d FROM m)
SELECT 0 :: BIGINT AS index, round(p - tq * q - td * d, 4) AS theta FROM slopes
UNION ALL SELECT 1, round(tq, 4) FROM slopes UNION ALL SELECT 2, round(td, 4) FROM slopes""",
}

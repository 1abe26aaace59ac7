"""The queries of the registry as plain SQL for a second engine.

Each text states what the result must be in the simplest way, without the
measures against skew that the Spark side takes.
"""

from __future__ import annotations

from facetable.plans.acceptance import ACCEPTANCE
from facetable.plans.tables import TABLES

ORACLE: dict[str, str] = {
    "project_filter": """
        SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer
        WHERE c_acctbal > 5000
    """,
    "project_filter_multi": """
        SELECT c_custkey, c_nationkey, upper(c_mktsegment) AS segment FROM customer
        WHERE (c_acctbal < 0 OR c_acctbal > 9000) AND c_nationkey < 10
    """,
    "project_filter_lines": """
        SELECT l_orderkey, l_partkey, l_quantity, l_shipdate FROM lineitem
        WHERE l_quantity >= 45 AND l_returnflag = 'R'
    """,
    "preview": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 100",
    "document_query": """
        SELECT c_custkey, c_mktsegment, c_name, c_acctbal FROM customer
        WHERE c_acctbal > 5000 ORDER BY c_custkey LIMIT 10
    """,
    "document_query_filter": """
        SELECT c_name, c_custkey FROM customer
        WHERE (c_acctbal >= 9000 OR (c_acctbal < 0 AND c_nationkey IN (1, 2, 3)))
          AND c_name LIKE 'Customer%' AND c_name IS NOT NULL
          AND NOT c_mktsegment = 'BUILDING'
    """,
    "document_query_offset": """
        SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'P'
        ORDER BY o_totalprice DESC, o_orderkey LIMIT 30 OFFSET 20
    """,
    "event_envelope": """
        SELECT concat_ws(',', event_id, ts, user_id, event_type, value, props) AS text,
               'NOKEY' AS key
        FROM events
    """,
    "event_envelope_keyed": """
        SELECT concat_ws(',', l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
                         l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
                         l_shipdate) AS text,
               CAST(l_orderkey AS VARCHAR) AS key
        FROM lineitem
    """,
    "event_roundtrip": "SELECT * FROM events",
    "event_json_roundtrip": "SELECT * FROM documents",
    "stream_events": """
        SELECT concat_ws(',', event_id, ts, user_id, event_type, value, props) AS text,
               'NOKEY' AS key
        FROM events
    """,
    "stream_events_parsed": "SELECT * FROM conversations",
    "csv_roundtrip": "SELECT * FROM documents",
    "csv_default_roundtrip": "SELECT * FROM part",
    "csv_microseconds_roundtrip": "SELECT * FROM events",
    "csv_nested_roundtrip": """
        SELECT vec_id, label, place - 1 AS place, CAST(embedding[place] AS DOUBLE) AS value
        FROM (
          SELECT vec_id, label, embedding,
                 unnest(range(1, len(embedding) + 1)) AS place
          FROM embeddings
        )
        UNION ALL
        SELECT vec_id, label, NULL, NULL FROM embeddings WHERE coalesce(len(embedding), 0) = 0
    """,
    "staged_export": "SELECT * FROM lineitem",
    "staged_export_orc": "SELECT * FROM orders",
    "table_create_scan": "SELECT * FROM orders",
    "describe": """
        SELECT column_name AS col_name,
               CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
                                WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double'
                                ELSE column_type END AS data_type
               , CAST(NULL AS VARCHAR) AS comment
        FROM (DESCRIBE customer)
    """,
    "catalog_list": " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{table}' AS name, count(*) AS n_rows FROM {table}"
        for table in TABLES
    ),
    "expose_sql": """
        SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer
        WHERE c_acctbal > 5000
    """,
    "expose_csv": "SELECT * FROM pages",
    "expose_gql": """
        SELECT c_custkey, c_mktsegment, c_name, c_acctbal FROM customer
        WHERE c_acctbal > 5000
    """,
    "expose_event": """
        SELECT concat_ws(',', o_orderkey, o_custkey, o_orderstatus, o_totalprice,
                         o_orderdate, o_orderpriority) AS text,
               'NOKEY' AS key
        FROM orders
    """,
    "sql_ddl_dml": """
        SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus IN ('O', 'P')
    """,
    # Texts that both engines read alike.
    "sql_join_inner": ACCEPTANCE["sql_join_inner"][1],
    "sql_join_left": ACCEPTANCE["sql_join_left"][1],
    "sql_join_full": ACCEPTANCE["sql_join_full"][1],
    "sql_distinct_agg": ACCEPTANCE["sql_distinct_agg"][1],
    "sql_window_top": ACCEPTANCE["sql_window_top"][1],
    "sql_topk": ACCEPTANCE["sql_topk"][1],
    "sql_set_ops": ACCEPTANCE["sql_set_ops"][1],
    "sql_exists": ACCEPTANCE["sql_exists"][1],
    "sql_join_left_hot_right": """
        SELECT c_custkey, o_orderkey, o_totalprice
        FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_totalprice > 300000) AS large
          ON o_custkey = c_custkey
    """,
    "sql_join_semi": """
        SELECT c_custkey, c_name FROM customer WHERE EXISTS (
          SELECT 1 FROM orders
          WHERE o_custkey = c_custkey AND o_orderstatus = 'P' AND o_totalprice > 400000)
    """,
    "sql_join_anti": """
        SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (
          SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')
    """,
    "sql_join_range": """
        SELECT s_suppkey, s_acctbal, count(*) AS customers
        FROM supplier JOIN customer ON c_acctbal BETWEEN s_acctbal - 1 AND s_acctbal + 1
        GROUP BY s_suppkey, s_acctbal
    """,
    "sql_rollup": """
        SELECT l_returnflag, l_linestatus, count(*) AS lines FROM lineitem
        GROUP BY ROLLUP (l_returnflag, l_linestatus)
    """,
    "sql_cube": """
        SELECT l_returnflag, l_linestatus, count(*) AS lines,
               round(sum(l_quantity), 3) AS quantity
        FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)
    """,
    "sql_grouping_sets": """
        SELECT o_orderstatus, o_orderpriority, count(*) AS orders FROM orders
        GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())
    """,
    "sql_group_agg": """
        SELECT o_orderstatus, count(*) AS orders,
               round(sum(o_totalprice), 3) AS total, round(avg(o_totalprice), 3) AS mean
        FROM orders GROUP BY o_orderstatus
    """,
    "sql_cte_subquery": """
        WITH totals AS (
          SELECT o_custkey, sum(o_totalprice) AS total FROM orders GROUP BY o_custkey
        )
        SELECT o_custkey, round(total, 3) AS total FROM totals
        WHERE total > (SELECT avg(total) FROM totals)
    """,
    "stream_windows": """
        SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
               event_type, count(*) AS n_rows, round(sum(value), 3) AS total
        FROM events GROUP BY 1, 2, 3
        HAVING window_end <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 2 HOUR FROM events)
    """,
    "stream_sliding_windows": """
        SELECT start AS window_start, start + INTERVAL 6 HOUR AS window_end, count(*) AS n_rows
        FROM (
          SELECT unnest([time_bucket(INTERVAL 3 HOUR, ts, TIMESTAMP '1970-01-01'),
                         time_bucket(INTERVAL 3 HOUR, ts, TIMESTAMP '1970-01-01') - INTERVAL 3 HOUR]) AS start
          FROM events
        )
        GROUP BY start
        HAVING window_end <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 2 HOUR FROM events)
    """,
    "stream_sessions": """
        WITH steps AS (
          SELECT user_id, ts, value, CASE WHEN ts < lag(ts) OVER w + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS step
          FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)
        ), numbered AS (
          SELECT user_id, ts, value, sum(step) OVER (
                   PARTITION BY user_id ORDER BY ts RANGE UNBOUNDED PRECEDING) AS number
          FROM steps
        )
        SELECT min(ts) AS session_start, max(ts) AS session_end, user_id, count(*) AS n_rows, max(value) AS largest
        FROM numbered GROUP BY user_id, number
        HAVING max(ts) + INTERVAL 30 MINUTE
               <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 HOUR FROM events)
    """,
    "stream_first_seen": "SELECT * FROM events",
    "stream_interval_join": """
        SELECT p.event_id, p.user_id, p.ts, c.event_id AS click_id, c.ts AS clicked
        FROM events AS p JOIN events AS c
          ON p.user_id = c.user_id AND c.ts BETWEEN p.ts - INTERVAL 10 MINUTE AND p.ts
        WHERE p.event_type = 'purchase' AND c.event_type = 'click'
    """,
    "document_query_nested": """
        WITH placed AS (
          SELECT o_custkey, o_orderkey, o_totalprice,
                 row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) - 1 AS place
          FROM orders WHERE o_orderstatus <> 'F'
        )
        SELECT c_custkey, c_name, n_name AS nation, place, o_orderkey, o_totalprice
        FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey
        LEFT JOIN (SELECT * FROM placed WHERE place < 3) AS top ON o_custkey = c_custkey
        WHERE c_acctbal > 5000
    """,
    "overlap_sessions": """
        WITH steps AS (
          SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER w + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS step
          FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)
        ), numbered AS (
          SELECT user_id, ts, sum(step) OVER (
                   PARTITION BY user_id ORDER BY ts RANGE UNBOUNDED PRECEDING) AS number
          FROM steps
        ), sessions AS (
          SELECT user_id, min(ts) AS session_start, max(ts) AS session_end
          FROM numbered WHERE ts IS NOT NULL GROUP BY user_id, number
        )
        SELECT a.user_id, a.session_start, a.session_end, count(*) AS n_others
        FROM sessions AS a JOIN sessions AS b
          ON a.session_start <= b.session_end AND b.session_start <= a.session_end AND a.user_id <> b.user_id
        GROUP BY ALL
    """,
    "table_changes": """
        SELECT o_orderkey, o_custkey, o_orderpriority,
               CASE WHEN o_orderstatus = 'P' THEN o_totalprice * 2
                    WHEN o_orderstatus = 'F' AND o_orderpriority LIKE '1%' THEN o_totalprice + 1
                    ELSE o_totalprice END AS o_totalprice,
               CASE WHEN o_orderstatus = 'F' AND o_orderpriority LIKE '1%' THEN 'R'
                    ELSE o_orderstatus END AS o_orderstatus
        FROM orders WHERE NOT (o_orderstatus = 'O' AND o_totalprice < 50000)
    """,
    "asof_purchases": """
        WITH purchases AS (
          SELECT user_id, ts, max(event_id) AS purchase_id, arg_max(value, event_id) AS value
          FROM events WHERE event_type = 'purchase' GROUP BY user_id, ts
        )
        SELECT e.event_id, e.user_id, e.event_type, e.ts,
               p.purchase_id, p.ts AS purchased, p.value
        FROM events AS e ASOF LEFT JOIN purchases AS p ON e.user_id = p.user_id AND e.ts > p.ts
    """,
    "session_events": """
        WITH steps AS (
          SELECT user_id, ts, value, CASE WHEN ts < lag(ts) OVER w + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS step
          FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)
        ), numbered AS (
          SELECT user_id, ts, value, sum(step) OVER (
                   PARTITION BY user_id ORDER BY ts RANGE UNBOUNDED PRECEDING) AS number
          FROM steps
        )
        SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS n_rows,
               round(sum(value), 3) AS total, max(value) AS largest
        FROM numbered WHERE ts IS NOT NULL GROUP BY user_id, number
    """,
    "sql_window_rank": """
        SELECT o_custkey, o_orderkey, o_totalprice,
               row_number() OVER (
                 PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS place
        FROM orders
    """,
    "sql_window_frame": """
        SELECT event_id, user_id,
               round(sum(value) OVER (
                 PARTITION BY user_id ORDER BY ts NULLS FIRST, event_id
                 ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS sum3,
               lag(value) OVER (PARTITION BY user_id ORDER BY ts NULLS FIRST, event_id) AS previous
        FROM events
    """,
    "sql_scalar_funcs": """
        SELECT c_custkey, lower(c_mktsegment) AS segment, length(c_name) AS name_length,
               substring(c_name, 1, 4) AS head, round(abs(c_acctbal)) AS whole,
               concat_ws('-', c_mktsegment, c_nationkey) AS tag,
               CASE WHEN c_acctbal < 0 THEN 'owes' ELSE 'owed' END AS side
        FROM customer
    """,
    "sql_date_funcs": """
        SELECT o_orderkey, year(o_orderdate) AS year, month(o_orderdate) AS month,
               datediff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) AS days,
               day(last_day(o_orderdate)) AS month_days
        FROM orders
    """,
    "sql_array_funcs": """
        SELECT vec_id, len(embedding) AS dims, CAST(embedding[1] AS DOUBLE) AS first,
               CAST(list_max(embedding) AS DOUBLE) AS largest,
               len(list_filter(embedding, lambda x: x > 0)) AS positives
        FROM embeddings
    """,
    "sql_json_funcs": """
        SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
               CAST(json_extract_string(props, '$.k') AS INTEGER) + 1 AS next
        FROM events
    """,
    "sql_map_funcs": """
        SELECT event_id, CAST(len(json_keys(props)) AS BIGINT) AS entries,
               CAST(json_extract_string(props, '$.k') AS INTEGER) * 2 AS doubled, user_id
        FROM events
    """,
    "sql_parameters": """
        SELECT c_custkey, c_acctbal FROM customer
        WHERE c_acctbal >= 1000 AND c_mktsegment = 'BUILDING'
    """,
}

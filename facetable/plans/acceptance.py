"""Spark SQL for the kinds of query that reach a table only as SQL text.

The library adds no operator of its own for these; the texts show that the
passthrough carries them.  They are written for big, skewed tables: one key may
own a third of the rows, so

* sides of semi, anti and full joins are made unique first, which is a map-side
  aggregate, because adaptive execution cannot split a hot key there;
* inner and left joins keep the large table on the side adaptive execution can
  split;
* windows cut the groups of hot keys into slices and carry over what is before.

A hot key is one with more than 1/10000 of the rows.  There are fewer than 10000
of them however large the table is, which bounds the lists that are broadcast.

Sums add DOUBLE values as they are; only results are rounded, where the order of
addition would show in the last digits.
"""

from __future__ import annotations

# Which tables a text reads, and the text.
ACCEPTANCE: dict[str, tuple[tuple[str, ...], str]] = {}

ACCEPTANCE["sql_join_inner"] = (
    ("orders", "customer"),
    """
    SELECT o_orderkey, c_name, c_mktsegment, o_totalprice
    FROM orders JOIN customer ON o_custkey = c_custkey
    """,
)

ACCEPTANCE["sql_join_left"] = (
    ("orders", "customer"),
    """
    SELECT o_orderkey, o_custkey, c_name
    FROM orders LEFT JOIN (
      SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 5000
    ) AS rich ON o_custkey = c_custkey
    """,
)

# Customers with each of their large orders, and customers that have none.  As
# one outer join the hot customer's orders could not be split.
ACCEPTANCE["sql_join_left_hot_right"] = (
    ("customer", "orders"),
    """
    WITH large AS (
      SELECT o_custkey, o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 300000
    )
    SELECT c_custkey, o_orderkey, o_totalprice
    FROM large JOIN customer ON o_custkey = c_custkey
    UNION ALL
    SELECT c_custkey, CAST(NULL AS BIGINT), CAST(NULL AS DOUBLE)
    FROM customer LEFT ANTI JOIN (SELECT DISTINCT o_custkey FROM large) AS buyers
      ON o_custkey = c_custkey
    """,
)

ACCEPTANCE["sql_join_full"] = (
    ("customer", "supplier"),
    """
    SELECT coalesce(c_nationkey, s_nationkey) AS nationkey,
           coalesce(customers, 0) AS customers, coalesce(suppliers, 0) AS suppliers
    FROM (
      SELECT c_nationkey, count(*) AS customers FROM customer
      WHERE c_acctbal > 9500 GROUP BY c_nationkey
    ) AS c FULL OUTER JOIN (
      SELECT s_nationkey, count(*) AS suppliers FROM supplier
      WHERE s_acctbal > 7000 GROUP BY s_nationkey
    ) AS s ON c_nationkey = s_nationkey
    """,
)

ACCEPTANCE["sql_join_semi"] = (
    ("customer", "orders"),
    """
    SELECT c_custkey, c_name
    FROM customer LEFT SEMI JOIN (
      SELECT DISTINCT o_custkey FROM orders
      WHERE o_orderstatus = 'P' AND o_totalprice > 400000
    ) AS buyers ON o_custkey = c_custkey
    """,
)

ACCEPTANCE["sql_join_anti"] = (
    ("customer", "orders"),
    """
    SELECT c_custkey, c_name
    FROM customer LEFT ANTI JOIN (
      SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'P'
    ) AS buyers ON o_custkey = c_custkey
    """,
)

# How many customers have a balance within 1 of each supplier's.  Balances are
# counted first, so a balance that many share is one row; unit bands turn the
# range into an equi-join instead of a nested loop over both tables.
ACCEPTANCE["sql_join_range"] = (
    ("supplier", "customer"),
    """
    WITH balances AS (
      SELECT c_acctbal AS balance, count(*) AS customers FROM customer GROUP BY c_acctbal
    ), centres AS (
      SELECT DISTINCT s_acctbal AS centre FROM supplier
    ), bands AS (
      SELECT centre, explode(sequence(floor(centre - 1), floor(centre + 1))) AS band
      FROM centres
    ), near AS (
      SELECT centre, sum(customers) AS customers
      FROM bands JOIN balances
        ON band = floor(balance) AND balance BETWEEN centre - 1 AND centre + 1
      GROUP BY centre
    )
    SELECT s_suppkey, s_acctbal, customers
    FROM supplier JOIN near ON s_acctbal = centre
    """,
)

ACCEPTANCE["sql_group_agg"] = (
    ("orders",),
    """
    SELECT o_orderstatus, count(*) AS orders, round(sum(o_totalprice), 3) AS total,
           round(avg(o_totalprice), 3) AS mean
    FROM orders GROUP BY o_orderstatus
    """,
)

ACCEPTANCE["sql_distinct_agg"] = (
    ("events",),
    """
    SELECT event_type, count(*) AS events, count(DISTINCT user_id) AS users
    FROM events GROUP BY event_type
    """,
)

# Grouping sets copy every input row once per set, so the finest groups are
# counted before.
ACCEPTANCE["sql_rollup"] = (
    ("lineitem",),
    """
    SELECT l_returnflag, l_linestatus, CAST(sum(lines) AS BIGINT) AS lines
    FROM (
      SELECT l_returnflag, l_linestatus, count(*) AS lines
      FROM lineitem GROUP BY l_returnflag, l_linestatus
    ) AS finest
    GROUP BY ROLLUP (l_returnflag, l_linestatus)
    """,
)

ACCEPTANCE["sql_cube"] = (
    ("lineitem",),
    """
    SELECT l_returnflag, l_linestatus, CAST(sum(lines) AS BIGINT) AS lines,
           round(sum(quantity), 3) AS quantity
    FROM (
      SELECT l_returnflag, l_linestatus, count(*) AS lines, sum(l_quantity) AS quantity
      FROM lineitem GROUP BY l_returnflag, l_linestatus
    ) AS finest
    GROUP BY CUBE (l_returnflag, l_linestatus)
    """,
)

ACCEPTANCE["sql_grouping_sets"] = (
    ("orders",),
    """
    SELECT o_orderstatus, o_orderpriority, CAST(sum(orders) AS BIGINT) AS orders
    FROM (
      SELECT o_orderstatus, o_orderpriority, count(*) AS orders
      FROM orders GROUP BY o_orderstatus, o_orderpriority
    ) AS finest
    GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())
    """,
)

# Views of a table in slices of a total order (operators.slice_by_range), by text:
# the view, the table, its columns and the order.
SLICED = {
    "sql_window_rank": (
        "sliced_orders", "orders", ["o_custkey", "o_orderkey", "o_totalprice"],
        ["o_custkey", "o_totalprice DESC", "o_orderkey"],
    ),
    "sql_window_frame": (
        "sliced_events", "events", ["event_id", "user_id", "ts", "value"], ["user_id", "ts", "event_id"],
    ),
}

# The place of every order among its customer's, dearest first.  Rows are placed within
# their slice and moved down by the orders of that customer in the slices before, which
# is one row per slice at most: only one customer reaches into a slice from the one before.
ACCEPTANCE["sql_window_rank"] = (
    (),
    """
    WITH counts AS (
      SELECT o_custkey, slice, count(*) AS orders FROM sliced_orders GROUP BY o_custkey, slice
    ), before AS (
      SELECT o_custkey AS b_key, slice AS b_slice, sum(orders) OVER (
               PARTITION BY o_custkey ORDER BY slice
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ahead
      FROM counts
    ), reached AS (
      SELECT b_key, b_slice, ahead FROM before WHERE ahead IS NOT NULL
    ), placed AS (
      SELECT o_custkey, o_orderkey, o_totalprice, slice,
             row_number() OVER (
               PARTITION BY o_custkey, slice ORDER BY o_totalprice DESC, o_orderkey) AS place
      FROM sliced_orders
    )
    SELECT /*+ BROADCAST(reached) */ o_custkey, o_orderkey, o_totalprice,
           place + coalesce(ahead, 0) AS place
    FROM placed LEFT JOIN reached ON o_custkey <=> b_key AND slice = b_slice
    """,
)

# The three dearest orders of each customer.  Spark keeps three per key in every
# task before it shuffles.
ACCEPTANCE["sql_window_top"] = (
    ("orders",),
    """
    SELECT o_custkey, o_orderkey, o_totalprice, CAST(place AS BIGINT) AS place
    FROM (
      SELECT o_custkey, o_orderkey, o_totalprice,
             row_number() OVER (
               PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS place
      FROM orders
    ) AS placed
    WHERE place <= 3
    """,
)

# Per user, in order of time: the value before, and the sum of a value and the
# two before it.  Each slice is lent the two events before it, which are among the last
# two of its user's slices before.  Only users in several slices have such, fewer than
# there are slices.
ACCEPTANCE["sql_window_frame"] = (
    (),
    """
    WITH spans AS (
      SELECT user_id AS span_key FROM sliced_events
      GROUP BY user_id HAVING min(slice) < max(slice)
    ), tails AS (
      SELECT user_id, slice, event_id, ts, value
      FROM (
        SELECT /*+ BROADCAST(spans) */ user_id, slice, event_id, ts, value,
               row_number() OVER (
                 PARTITION BY user_id, slice ORDER BY ts DESC, event_id DESC) AS from_end
        FROM sliced_events JOIN spans ON user_id <=> span_key
      ) AS placed
      WHERE from_end <= 2
    ), looks AS (
      SELECT user_id, slice, lag(slice) OVER by_time AS slice_before,
             lag(struct(event_id, ts, value), 1) OVER by_time AS one_before,
             lag(struct(event_id, ts, value), 2) OVER by_time AS two_before
      FROM tails
      WINDOW by_time AS (PARTITION BY user_id ORDER BY slice, ts, event_id)
    ), lent AS (
      SELECT user_id, slice,
             inline(filter(array(one_before, two_before), event -> event IS NOT NULL))
      FROM looks WHERE slice_before < slice
    ), framed AS (
      SELECT event_id, user_id, is_lent,
             sum(value) OVER (
               PARTITION BY user_id, slice ORDER BY ts, event_id
               ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS sum3,
             lag(value) OVER (PARTITION BY user_id, slice ORDER BY ts, event_id) AS previous
      FROM (
        SELECT event_id, user_id, ts, value, slice, FALSE AS is_lent FROM sliced_events
        UNION ALL
        SELECT event_id, user_id, ts, value, slice, TRUE FROM lent
      ) AS extended
    )
    SELECT event_id, user_id, round(sum3, 4) AS sum3, previous FROM framed WHERE NOT is_lent
    """,
)

ACCEPTANCE["sql_topk"] = (
    ("orders",),
    """
    SELECT o_orderkey, o_totalprice FROM orders
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 10
    """,
)

# DISTINCT on each side is a map-side aggregate; the set operators alone would
# shuffle whole tables by 25 keys.
ACCEPTANCE["sql_set_ops"] = (
    ("customer", "supplier", "nation"),
    """
    (
      SELECT DISTINCT c_nationkey AS nationkey FROM customer
      INTERSECT SELECT DISTINCT s_nationkey FROM supplier
      EXCEPT SELECT n_nationkey FROM nation WHERE n_regionkey = 1
    )
    UNION SELECT n_nationkey FROM nation WHERE n_regionkey IN (1, 2)
    """,
)

# Customers who bought for more than the mean of all customers.
ACCEPTANCE["sql_cte_subquery"] = (
    ("orders",),
    """
    WITH totals AS (
      SELECT o_custkey, sum(o_totalprice) AS total FROM orders GROUP BY o_custkey
    )
    SELECT o_custkey, round(total, 3) AS total FROM totals
    WHERE total > (SELECT avg(total) FROM totals)
    """,
)

ACCEPTANCE["sql_exists"] = (
    ("supplier", "lineitem"),
    """
    SELECT s_suppkey, s_name FROM supplier
    WHERE s_suppkey IN (SELECT DISTINCT l_suppkey FROM lineitem WHERE l_quantity >= 50)
    """,
)

ACCEPTANCE["sql_scalar_funcs"] = (
    ("customer",),
    """
    SELECT c_custkey, lower(c_mktsegment) AS segment, CAST(length(c_name) AS BIGINT) AS name_length,
           substring(c_name, 1, 4) AS head, round(abs(c_acctbal)) AS whole,
           concat_ws('-', c_mktsegment, CAST(c_nationkey AS STRING)) AS tag,
           CASE WHEN c_acctbal < 0 THEN 'owes' ELSE 'owed' END AS side
    FROM customer
    """,
)

ACCEPTANCE["sql_date_funcs"] = (
    ("orders",),
    """
    SELECT o_orderkey, CAST(year(o_orderdate) AS BIGINT) AS year,
           CAST(month(o_orderdate) AS BIGINT) AS month,
           CAST(datediff(CAST(o_orderdate AS DATE), DATE '1992-01-01') AS BIGINT) AS days,
           CAST(day(last_day(CAST(o_orderdate AS DATE))) AS BIGINT) AS month_days
    FROM orders
    """,
)

ACCEPTANCE["sql_array_funcs"] = (
    ("embeddings",),
    """
    SELECT vec_id, CAST(size(embedding) AS BIGINT) AS dims,
           CAST(element_at(embedding, 1) AS DOUBLE) AS first,
           CAST(array_max(embedding) AS DOUBLE) AS largest,
           CAST(size(filter(embedding, x -> x > 0)) AS BIGINT) AS positives
    FROM embeddings
    """,
)

ACCEPTANCE["sql_json_funcs"] = (
    ("events",),
    """
    SELECT event_id, CAST(get_json_object(props, '$.k') AS INT) AS k,
           from_json(props, 'k INT').k + 1 AS next
    FROM events
    """,
)

ACCEPTANCE["sql_map_funcs"] = (
    ("events",),
    """
    SELECT event_id, CAST(size(numbers) AS BIGINT) AS entries,
           transform_values(numbers, (k, v) -> v * 2)['k'] AS doubled,
           map_from_entries(array(struct(event_type AS key, user_id AS value)))[event_type]
             AS user_id
    FROM (
      SELECT event_id, event_type, user_id, from_json(props, 'MAP<STRING, INT>') AS numbers
      FROM events
    ) AS parsed
    """,
)

# Values that go into a text by name.
ARGUMENTS = {"sql_parameters": {"low": 1000.0, "segment": "BUILDING"}}

ACCEPTANCE["sql_parameters"] = (
    ("customer",),
    """
    SELECT c_custkey, c_acctbal FROM customer
    WHERE c_acctbal >= :low AND c_mktsegment = :segment
    """,
)

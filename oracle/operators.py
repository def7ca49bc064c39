"""The generic operators in SQL, each over a whole test table."""

OPERATORS = {
    "keep_changes": """
SELECT * FROM (
  SELECT li AS line_item_id, upd AS updated, part AS price_point_id, ret AS l_returnflag, price,
    lag(ret) OVER versions AS previous_flag
  FROM {in_lines} WINDOW versions AS (PARTITION BY li ORDER BY upd NULLS LAST, part NULLS LAST))
WHERE previous_flag IS NULL OR previous_flag <> l_returnflag
""",
    "validity_intervals": """
SELECT li AS line_item_id, upd AS updated, part AS price_point_id, ret AS l_returnflag, price,
  upd AS started_at,
  lead(upd) OVER (PARTITION BY li ORDER BY upd NULLS LAST, part NULLS LAST) AS expires_at
FROM {in_lines}
""",
    "fill_nearest_non_null": """
SELECT event_id, user_id, ts, event_type,
  coalesce(spent, lag(spent IGNORE NULLS) OVER by_time, lead(spent IGNORE NULLS) OVER by_time)
    AS purchase_value
FROM (SELECT *, CASE WHEN event_type = 'purchase' THEN value END AS spent FROM events)
WINDOW by_time AS (PARTITION BY user_id ORDER BY ts NULLS LAST, event_id NULLS LAST)
""",
    "allocate_by_share": """
SELECT invoice_id, line_item_id, updated, price, takes_part, order_total, share,
  CAST(share * order_total AS DECIMAL(27,10)) AS allocated
FROM (
  SELECT ord AS invoice_id, li AS line_item_id, upd AS updated, price, ret <> 'R' AS takes_part,
    CAST(o_totalprice AS DECIMAL(18,2)) AS order_total,
    CAST(CASE WHEN ret = 'R' OR price <= 0 THEN 0
      ELSE CAST(price AS DOUBLE) / CAST(total AS DOUBLE) END AS DECIMAL(16,8)) AS share
  FROM {in_lines} LEFT JOIN orders ON o_orderkey = ord
  LEFT JOIN (SELECT ord AS ord2, sum(price) AS total FROM {in_lines}
             WHERE ret <> 'R' AND price > 0 GROUP BY 1) ON ord2 = ord)
""",
    "surrogate_key": """
SELECT o_orderkey, md5(concat(CAST(o_orderkey AS VARCHAR), '-',
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%g'), '-',
  CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END)) AS order_key
FROM orders
""",
}

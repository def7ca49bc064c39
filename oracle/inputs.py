"""Input relations from the test tables, as FIXTURES.md gives them."""

from bookledger import fixed_values as fv


def local(expression: str) -> str:
    return f"(({expression}) AT TIME ZONE '{fv.SOURCE_ZONE}' AT TIME ZONE '{fv.LOCAL_ZONE}')"


INPUTS = {
    "in_lines": """
SELECT l_orderkey AS ord, l_linenumber AS num, l_partkey AS part, l_suppkey AS supp,
  l_returnflag AS ret, l_linestatus AS stat, l_discount AS disc,
  CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS li,
  CAST(l_extendedprice AS DECIMAL(15,2)) AS price,
  l_shipdate + (l_partkey % 1440) * INTERVAL '1' MINUTE
    + (l_suppkey % 60) * INTERVAL '1' SECOND AS upd
FROM lineitem
""",
    "in_payment_hist": f"""
SELECT o_orderkey AS invoice_id,
  o_orderdate + (o_orderkey % 1440) * INTERVAL '1' MINUTE
    + (CASE WHEN k = 1 THEN 0 WHEN o_orderkey % 7 = 0 THEN -5 ELSE 30 END)
      * INTERVAL '1' DAY AS settled,
  CASE WHEN o_orderstatus = 'P' THEN 'Declined'
    ELSE '{fv.PAYMENT_STATUS_APPROVED}' END AS status,
  CASE WHEN k = 2 AND o_orderkey % 7 = 0 THEN 'Refund'
    ELSE '{fv.PAYMENT_TYPE_PAYMENT}' END AS kind
FROM orders, (VALUES (1), (2)) copies(k)
""",
    "in_line_item_hist": f"""
SELECT concat(li, ':', CAST(date_diff('second', TIMESTAMP '1970-01-01 00:00:00', upd) AS VARCHAR))
    AS hist_id,
  li AS line_item_id, ord AS invoice_id,
  CASE WHEN part % 11 <> 0 THEN o_custkey * 10 END AS workspace_id,
  CAST(ord * 10 + min(num) OVER (PARTITION BY ord) AS BIGINT) AS cart_line_item_id,
  CASE WHEN part % 3 = 0 THEN supp END AS subscription_id,
  CASE WHEN part % 20 <> 0 THEN ret = 'R' END AS raw_status,
  upd AS updated_utc, {local("upd")} AS updated_pt,
  min(upd) OVER (PARTITION BY ord, num) AS created_utc,
  {local("min(upd) OVER (PARTITION BY ord, num)")} AS created_pt,
  part AS price_point_id, o_custkey AS user_id,
  CASE WHEN ord % 37 = 0 THEN CAST(0 AS DECIMAL(15,2)) WHEN part % 41 <> 0 THEN price END
    AS raw_amount,
  upd = max(upd) OVER (PARTITION BY ord, num) AS is_current_record,
  CASE WHEN supp % 2 = 0 THEN 'CP1' ELSE 'CP2' END AS source_system,
  CAST(supp AS VARCHAR) AS source_subscription_id
FROM in_lines_ JOIN orders ON ord = o_orderkey
""".replace("in_lines_", "{in_lines}"),
    "in_price_point": """
SELECT p_partkey AS price_point_id, p_type = 'SMALL' AS is_filing_fee FROM part
""",
    "in_discount_hist": """
SELECT concat(li, ':', CAST(date_diff('second', TIMESTAMP '1970-01-01 00:00:00', upd) AS VARCHAR))
    AS hist_id,
  li AS discount_id, CASE WHEN num % 3 <> 0 THEN li END AS line_id, ord AS invoice_id,
  CAST(supp % 3 AS INTEGER) AS type_id,
  CASE WHEN supp % 3 = 0 THEN 'Coupon' ELSE 'Promotion' END AS type_name,
  CAST(1 + (ord + num) % 4 AS INTEGER) AS rule_id,
  CASE WHEN (ord + num) % 4 = 1 THEN 'Everything' ELSE 'Restricted' END AS rule_name,
  CAST(price * CAST(disc AS DECIMAL(4,2)) AS DECIMAL(15,2)) AS off,
  ret = 'A' AS is_cancelled,
  upd + INTERVAL '365' DAY AS expires_utc, upd AS updated_utc,
  min(upd) OVER (PARTITION BY ord, num) AS created_utc
FROM {in_lines} WHERE disc > 0
""",
    "in_hierarchy": """
SELECT li AS line_item_id, CAST(ord * 10 + root AS BIGINT) AS cart_line_item_id
FROM (SELECT ord, num, li, min(num) OVER (PARTITION BY ord) AS root
      FROM (SELECT DISTINCT ord, num, li FROM {in_lines}))
WHERE num % 5 <> 0
""",
    "in_product": f"""
SELECT p_partkey AS price_point_id,
  CASE WHEN p_partkey % 97 = 0 THEN NULL WHEN p_type = 'SMALL' THEN '{fv.PRODUCT_TYPE_FILING_FEE}'
    WHEN p_type = 'MEDIUM' THEN 'Shipping' ELSE '{fv.PRODUCT_TYPE_PRODUCT}' END AS product_type,
  CASE WHEN p_type = 'MEDIUM' AND p_partkey % 2 = 0
    THEN concat('Standard Shipping ', p_name) ELSE p_name END AS product_name,
  CASE WHEN p_partkey % 89 <> 0 THEN p_type = 'SMALL' END AS is_fee,
  CASE WHEN p_partkey % 50 = 0 THEN '{fv.FREE_PRODUCT_CODE}'
    ELSE concat('pp', CAST(p_partkey AS VARCHAR)) END AS code
FROM part
""",
    "in_store_credits": f"""
SELECT ord AS invoice_id, li AS line_item_id, upd + INTERVAL '2' DAY AS event_utc,
  CAST(price * CAST(0.10 AS DECIMAL(4,2)) AS DECIMAL(15,2)) AS amount,
  CASE WHEN stat = 'F' THEN '{fv.CREDIT_EVENT_ISSUED}' ELSE 'credit voided' END AS event_type,
  CASE WHEN supp % 2 = 1 THEN '{fv.CREDIT_SOURCE_ID}' ELSE 'other' END AS source_id
FROM {{in_lines}} WHERE ret = 'R'
""",
    "in_line_item": """
SELECT li AS line_item_id, CAST(ord * 10 + first_num AS BIGINT) AS cart_line_item_id,
  CASE WHEN part % 3 = 0 THEN supp END AS subscription_id, o_custkey AS user_id,
  CASE WHEN part % 11 <> 0 THEN o_custkey * 10 END AS workspace_id,
  part AS price_point_id, part AS cart_price_point_id, part AS root_price_point_id,
  CAST(supp AS VARCHAR) AS source_fulfillment_id,
  CAST(ord * 10 + first_num AS VARCHAR) AS source_cart_line_item_id,
  CAST(ord AS VARCHAR) AS source_invoice_id, CAST(li AS VARCHAR) AS source_line_item_id,
  CAST(supp AS VARCHAR) AS source_subscription_id,
  CAST(o_custkey AS VARCHAR) AS source_user_id,
  CAST(part AS VARCHAR) AS source_root_price_point_id,
  CAST(part AS VARCHAR) AS source_cart_price_point_id,
  CASE WHEN supp % 2 = 0 THEN 'CP1' ELSE 'CP2' END AS source_system
FROM (SELECT *, min(num) OVER (PARTITION BY ord) AS first_num,
        row_number() OVER (PARTITION BY ord, num ORDER BY upd DESC, part DESC, supp DESC) AS age
      FROM {in_lines})
JOIN orders ON ord = o_orderkey WHERE age = 1
""",
    "in_payment": f"""
SELECT CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey END AS order_id,
  CASE WHEN o_orderkey % 2 = 0 THEN -o_orderkey ELSE o_orderkey END AS invoice_id,
  CASE WHEN o_orderstatus = 'P' THEN 'Declined'
    ELSE '{fv.PAYMENT_STATUS_APPROVED}' END AS status,
  CASE WHEN o_orderkey % 13 <> 0 THEN o_orderkey % 4 < 2 END AS third_party
FROM orders
""",
    "in_freshness": f"SELECT {local('ts')} AS dtlastupdated FROM events",
}

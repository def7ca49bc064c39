"""The booking stages in SQL."""

from bookledger import fixed_values as fv
from oracle.inputs import local

OPEN = f"TIMESTAMP '{fv.OPEN_END}'"
MONEY = "DECIMAL(18,2)"
SHARE = "DECIMAL(16,8)"
PAID = "invoice_first_payment_approved_at_pt"
# NULLS LAST is DuckDB's default, spelled out.
BOOKING_TIES = ", ".join(
    f"{c} NULLS LAST"
    for c in (
        "booking_category_detail", "price_point_id", "cart_line_item_id", "subscription_id",
        "user_id", "workspace_id", "gb", "nb", "gbnf", "nbnf", "invoice_id", PAID,
        "booking_category",
    )
)
BOOKING = (
    "invoice_id, line_item_id, cart_line_item_id, subscription_id, user_id, workspace_id, "
    f"price_point_id, {PAID}, booking_at_pt, booking_category_detail, booking_category"
)
AMOUNTS = (
    "initial_gbnf, initial_gb, filing_fee, initial_discount_amount, "
    "additional_discount_amount, gbnf, nbnf, gb, nb"
)
ITEM = (
    "invoice_id, line_item_id, cart_line_item_id, subscription_id, user_id, workspace_id, "
    "price_point_id"
)


def total(value: str, condition: str | None = None) -> str:
    """Sum of a value where a condition holds, 0 for other rows."""
    if condition:
        value = f"CASE WHEN {condition} THEN {value} ELSE 0 END"
    return f"CAST(sum({value}) AS {MONEY})"


def share(part: str, whole: str) -> str:
    return (
        f"CASE WHEN {part} IS NULL OR {whole} IS NULL THEN NULL WHEN {whole} = 0 THEN 0 "
        f"ELSE CAST(CAST({part} AS DOUBLE) / CAST({whole} AS DOUBLE) AS {SHARE}) END"
    )


def nearest(column: str) -> str:
    return (
        f"coalesce({column}, lag({column} IGNORE NULLS) OVER by_time, "
        f"lead({column} IGNORE NULLS) OVER by_time) AS {column}"
    )


def perc(side: str, metric: str, fees: str) -> str:
    weight = (
        f"greatest(CASE WHEN {side}_rule = {fv.APPLY_TO_EVERYTHING} "
        f"THEN coalesce({side}_{fees}, 0) ELSE coalesce({side}_{metric}, 0) END, 0)"
    )
    return (
        f"CASE WHEN {side}_joins THEN "
        + share(weight, f"sum(CASE WHEN {side}_joins THEN {weight} END) OVER in_invoice")
        + f" ELSE 0 END AS {metric}_{side}_perc"
    )


def joins(side: str) -> str:
    return f"""coalesce(CASE {side}_rule
    WHEN {fv.APPLY_TO_PRODUCTS} THEN product_type = '{fv.PRODUCT_TYPE_PRODUCT}'
    WHEN {fv.APPLY_TO_EVERYTHING} THEN TRUE
    WHEN {fv.APPLY_TO_ALL_BUT_FILING_FEES} THEN product_type <> '{fv.PRODUCT_TYPE_FILING_FEE}'
    WHEN {fv.APPLY_TO_PRODUCTS_AND_STANDARD_SHIPPING} THEN product_type = '{fv.PRODUCT_TYPE_PRODUCT}'
      OR product_name LIKE '{fv.SHIPPING_NAME_PATTERN}'
    END, FALSE) AS {side}_joins"""


STAGES = {
    "first_payment_approved": f"""
SELECT *, CAST(invoice_first_payment_approved_at_utc AS DATE)
    AS invoice_first_payment_approved_date_utc,
  CAST({PAID} AS DATE) AS invoice_first_payment_approved_date_pt
FROM (SELECT invoice_id, min(settled) AS invoice_first_payment_approved_at_utc,
        min({local("settled")}) AS {PAID}
      FROM {{in_payment_hist}}
      WHERE status = '{fv.PAYMENT_STATUS_APPROVED}' AND kind = '{fv.PAYMENT_TYPE_PAYMENT}'
      GROUP BY invoice_id)
""",
    "invoice_facts": """
SELECT invoice_id, min(updated_pt) AS first_update, sum(raw_amount) AS amount_total
FROM {in_line_item_hist} GROUP BY invoice_id
""",
    "line_item_changes": f"""
SELECT * EXCLUDE (raw_status, raw_amount) FROM (
  SELECT h.hist_id AS line_item_hist_id, h.line_item_id, h.invoice_id, h.workspace_id,
    h.cart_line_item_id, h.subscription_id,
    p.invoice_first_payment_approved_at_utc, p.invoice_first_payment_approved_date_utc,
    p.{PAID}, p.invoice_first_payment_approved_date_pt,
    coalesce(h.raw_status, FALSE) AS is_cancelled,
    h.updated_utc AS line_item_updated_at_utc, h.updated_pt AS line_item_updated_at_pt,
    {local("coalesce(h.updated_utc, h.created_utc)")} AS record_updated_at_pt,
    CAST({local("coalesce(h.updated_utc, h.created_utc)")} AS DATE) AS record_updated_date_pt,
    CASE WHEN p.{PAID} IS NULL THEN {OPEN}
      WHEN p.{PAID} >= coalesce(f.first_update, TIMESTAMP '{fv.OPEN_START}') THEN p.{PAID}
      ELSE f.first_update END AS invoice_cutoff_at_pt,
    h.price_point_id, h.user_id, h.created_utc AS line_item_created_at_utc,
    h.created_pt AS line_item_created_at_pt,
    coalesce(h.raw_amount, CAST(0 AS DECIMAL(15,2))) AS amount,
    pp.is_filing_fee, NOT coalesce(f.amount_total > 0, FALSE) AS is_free_invoice,
    h.is_current_record, h.price_point_id AS cart_price_point_id,
    h.price_point_id AS root_price_point_id,
    CAST(h.cart_line_item_id AS VARCHAR) AS source_cart_line_item_id,
    CAST(h.invoice_id AS VARCHAR) AS source_invoice_id,
    CAST(h.line_item_id AS VARCHAR) AS source_line_item_id, h.source_subscription_id,
    CAST(h.user_id AS VARCHAR) AS source_user_id, h.source_system,
    h.raw_status, h.raw_amount,
    lag(h.raw_status) OVER versions AS previous_status,
    lag(h.raw_amount) OVER versions AS previous_price
  FROM {{in_line_item_hist}} h
  LEFT JOIN {{first_payment_approved}} p USING (invoice_id)
  LEFT JOIN {{in_price_point}} pp ON pp.price_point_id = h.price_point_id
  LEFT JOIN {{invoice_facts}} f ON f.invoice_id IS NOT DISTINCT FROM h.invoice_id
  WINDOW versions AS (PARTITION BY h.line_item_id
    ORDER BY {local("coalesce(h.updated_utc, h.created_utc)")} NULLS LAST, h.hist_id NULLS LAST)
)
WHERE previous_status IS NULL OR previous_price IS NULL
  OR NOT (is_cancelled = previous_status AND amount = previous_price)
""",
    "line_item_intervals": """
SELECT *, record_updated_at_pt AS record_started_at_pt,
  lead(record_updated_at_pt) OVER (PARTITION BY line_item_id
    ORDER BY record_updated_at_pt NULLS LAST, line_item_hist_id NULLS LAST)
    AS record_expires_at_pt
FROM {line_item_changes}
""",
    "classify_line_items": f"""
SELECT *, CAST(record_started_at_pt AS DATE) AS record_started_date_pt,
  CASE WHEN is_cancelled AND is_current_record THEN CAST(record_started_at_pt AS DATE)
    WHEN record_expires_at_pt IS NULL OR record_started_at_pt IS NULL THEN NULL
    WHEN CAST(record_expires_at_pt AS DATE) > CAST(record_started_at_pt AS DATE)
      THEN CAST(record_expires_at_pt AS DATE) - 1
    ELSE CAST(record_started_at_pt AS DATE) END AS record_expires_date_pt,
  CAST(amount * CASE WHEN is_filing_fee IS TRUE THEN 0 ELSE 1 END AS DECIMAL(15,2))
    AS extended_price_without_ff,
  coalesce(line_item_created_at_pt <= invoice_cutoff_at_pt, FALSE) AS is_initial_line_item,
  coalesce(record_started_at_pt <= invoice_cutoff_at_pt
    AND (record_expires_at_pt IS NULL OR record_expires_at_pt >= invoice_cutoff_at_pt), FALSE)
    AS is_counted_in_initial_gbnf,
  coalesce(record_started_at_pt > invoice_cutoff_at_pt, invoice_cutoff_at_pt < {OPEN})
    AS is_after_fpa_date
FROM {{line_item_intervals}}
""",
    "invoice_level_totals": f"""
SELECT invoice_id, {PAID}, record_updated_date_pt,
  {total("amount", "is_cancelled AND is_initial_line_item AND NOT is_counted_in_initial_gbnf AND is_after_fpa_date")}
    AS initial_invoice_cancelled_amount,
  {total("amount", "NOT is_cancelled AND is_initial_line_item AND is_counted_in_initial_gbnf AND NOT is_after_fpa_date")}
    AS initial_invoice_amount,
  {total("amount", "is_cancelled AND is_after_fpa_date")} AS cancelled_invoice_amount,
  {total("amount", "NOT is_cancelled AND is_after_fpa_date")} AS additional_invoice_amount
FROM {{classify_line_items}}
GROUP BY invoice_id, {PAID}, record_updated_date_pt
""",
    "initial_line_item_bookings": f"""
SELECT invoice_id, line_item_id, user_id, workspace_id, {PAID}, booking_at_pt,
  CASE WHEN is_cancelled THEN '{fv.CANCELLED_INITIAL_BOOKING_BEFORE}'
    ELSE '{fv.INITIAL_BOOKING}' END AS booking_category_detail,
  CASE WHEN is_cancelled THEN '{fv.CANCELLED_LINE_ITEM_BOOKING}'
    ELSE '{fv.LINE_ITEM_BOOKING}' END AS booking_category,
  is_after_fpa_date, cart_line_item_id, subscription_id, price_point_id,
  initial_invoice_cancelled_amount, initial_invoice_amount, filing_fee,
  CAST(0 AS {MONEY}) AS initial_discount_amount,
  CAST(0 AS {MONEY}) AS additional_discount_amount,
  no_fees AS initial_gbnf, with_fees AS initial_gb, no_fees AS gbnf, no_fees AS nbnf,
  with_fees AS gb, with_fees AS nb
FROM (
  SELECT c.invoice_id, line_item_id, user_id, workspace_id, c.{PAID},
    coalesce(c.{PAID}, record_updated_at_pt) AS booking_at_pt, is_cancelled,
    is_after_fpa_date, cart_line_item_id, subscription_id, price_point_id,
    {total("t.initial_invoice_cancelled_amount")} AS initial_invoice_cancelled_amount,
    {total("t.initial_invoice_amount")} AS initial_invoice_amount,
    {total("CASE WHEN is_cancelled THEN -amount ELSE amount END", "is_filing_fee")} AS filing_fee,
    {total("extended_price_without_ff", "is_counted_in_initial_gbnf AND NOT is_cancelled")} AS no_fees,
    {total("amount", "is_counted_in_initial_gbnf AND NOT is_cancelled")} AS with_fees
  FROM {{classify_line_items}} c LEFT JOIN {{invoice_level_totals}} t
    ON t.invoice_id = c.invoice_id AND t.record_updated_date_pt = c.record_updated_date_pt
  WHERE NOT is_after_fpa_date
  GROUP BY ALL)
""",
    "additional_line_item_bookings": f"""
SELECT invoice_id, line_item_id, user_id, workspace_id, {PAID}, booking_at_pt,
  CASE WHEN NOT is_cancelled THEN '{fv.ADDITIONAL_BOOKING}'
    WHEN is_initial_line_item THEN '{fv.CANCELLED_INITIAL_BOOKING_AFTER}'
    ELSE '{fv.CANCELLED_ADDITIONAL_BOOKING}' END AS booking_category_detail,
  CASE WHEN is_cancelled THEN '{fv.CANCELLED_LINE_ITEM_BOOKING}'
    ELSE '{fv.LINE_ITEM_BOOKING}' END AS booking_category,
  TRUE AS is_after_fpa_date, cart_line_item_id, subscription_id, price_point_id,
  cancelled_invoice_amount, additional_invoice_amount,
  CAST(0 AS {MONEY}) AS initial_gbnf, CAST(0 AS {MONEY}) AS initial_gb,
  {total("effect * amount", "is_filing_fee")} AS filing_fee,
  CAST(0 AS {MONEY}) AS initial_discount_amount,
  CAST(0 AS {MONEY}) AS additional_discount_amount,
  {total("counts * effect * extended_price_without_ff")} AS gbnf,
  {total("effect * extended_price_without_ff")} AS nbnf,
  {total("counts * effect * amount")} AS gb, {total("effect * amount")} AS nb
FROM (
  SELECT c.*, record_updated_at_pt AS booking_at_pt,
    t.cancelled_invoice_amount, t.additional_invoice_amount,
    CASE WHEN is_cancelled THEN -1 ELSE 1 END AS effect,
    CAST(t.additional_invoice_amount >= t.cancelled_invoice_amount AS INTEGER) AS counts
  FROM {{classify_line_items}} c LEFT JOIN {{invoice_level_totals}} t
    ON t.invoice_id = c.invoice_id AND t.record_updated_date_pt = c.record_updated_date_pt
  WHERE is_after_fpa_date AND NOT is_counted_in_initial_gbnf)
GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, cart_line_item_id, subscription_id, price_point_id,
  cancelled_invoice_amount, additional_invoice_amount
""",
    "discount_changes": f"""
SELECT * FROM (
  SELECT d.hist_id AS discount_hist_id, d.discount_id, d.line_id AS line_item_id, d.invoice_id,
    coalesce(k.cart_line_item_id, d.line_id) AS cart_line_item_id, p.{PAID} AS paid_at_pt,
    coalesce(p.{PAID}, {OPEN}) AS {PAID},
    d.type_id AS discount_type_id, d.type_name AS discount_type,
    d.rule_id AS discount_apply_type_id, d.rule_name AS discount_apply_type,
    d.off AS discount_amount, d.is_cancelled, d.expires_utc AS expires_at_utc,
    d.updated_utc AS discount_hist_updated_at_utc,
    {local("d.updated_utc")} AS discount_hist_updated_at_pt,
    CAST({local("d.updated_utc")} AS DATE) AS discount_hist_updated_date_pt,
    d.created_utc AS discount_created_at_utc,
    {local("d.created_utc")} AS discount_created_at_pt,
    CAST({local("d.created_utc")} AS DATE) AS discount_created_date_pt,
    lag(d.is_cancelled) OVER versions AS previous_is_cancelled,
    lag(d.off) OVER versions AS previous_discount_amount
  FROM {{in_discount_hist}} d
  LEFT JOIN {{first_payment_approved}} p ON p.invoice_id = d.invoice_id
  LEFT JOIN {{in_hierarchy}} k ON k.line_item_id = d.line_id
  WINDOW versions AS (PARTITION BY d.discount_id
    ORDER BY d.updated_utc NULLS LAST, d.hist_id NULLS LAST)
)
WHERE previous_is_cancelled IS NULL OR previous_discount_amount IS NULL
  OR previous_is_cancelled <> is_cancelled OR previous_discount_amount <> discount_amount
""",
    "discount_intervals": """
SELECT *, discount_hist_updated_at_pt AS record_started_at_pt,
  lead(discount_hist_updated_at_pt) OVER (PARTITION BY discount_id
    ORDER BY discount_hist_updated_at_pt NULLS LAST, discount_hist_id NULLS LAST)
    AS record_expires_at_pt
FROM {discount_changes}
""",
    "classify_discounts": f"""
SELECT *, coalesce(discount_created_at_pt <= {PAID}, FALSE) AS is_initial_discount,
  coalesce(discount_hist_updated_at_pt, {OPEN}) > {PAID} AS is_after_fpa_date
FROM {{discount_intervals}}
""",
    "initial_line_item_discounts": f"""
SELECT invoice_id, line_item_id, paid_at_pt AS {PAID},
  coalesce(paid_at_pt, discount_hist_updated_at_pt) AS booking_at_pt,
  CASE WHEN is_cancelled THEN '{fv.CANCELLED_INITIAL_DISCOUNT_BEFORE}'
    ELSE '{fv.INITIAL_DISCOUNT_BEFORE}' END AS booking_category_detail,
  CASE WHEN is_cancelled THEN '{fv.CANCELLED_LINE_ITEM_DISCOUNT}'
    ELSE '{fv.LINE_ITEM_DISCOUNT}' END AS booking_category,
  FALSE AS is_after_fpa_date, cart_line_item_id,
  CAST(NULL AS BIGINT) AS subscription_id, CAST(NULL AS BIGINT) AS user_id,
  CAST(NULL AS BIGINT) AS workspace_id, CAST(NULL AS BIGINT) AS price_point_id,
  CAST(0 AS {MONEY}) AS filing_fee,
  {total("CASE WHEN is_cancelled THEN discount_amount ELSE -discount_amount END")}
    AS initial_discount_amount,
  CAST(0 AS {MONEY}) AS additional_discount_amount,
  initial_discount_amount AS initial_gbnf, initial_discount_amount AS initial_gb,
  initial_discount_amount AS gbnf, initial_discount_amount AS nbnf,
  initial_discount_amount AS gb, initial_discount_amount AS nb
FROM {{classify_discounts}}
WHERE is_initial_discount AND NOT is_after_fpa_date AND line_item_id IS NOT NULL
GROUP BY 1, 2, 3, 4, 5, 6, 7, 8
""",
    "additional_line_item_discounts": f"""
SELECT invoice_id, line_item_id, paid_at_pt AS {PAID}, booking_at_pt,
  booking_category_detail, booking_category, TRUE AS is_after_fpa_date, cart_line_item_id,
  CAST(NULL AS BIGINT) AS subscription_id, CAST(NULL AS BIGINT) AS user_id,
  CAST(NULL AS BIGINT) AS workspace_id, CAST(NULL AS BIGINT) AS price_point_id,
  CAST(0 AS {MONEY}) AS filing_fee, CAST(0 AS {MONEY}) AS initial_discount_amount,
  net_sum AS additional_discount_amount, CAST(0 AS {MONEY}) AS initial_gbnf,
  CAST(0 AS {MONEY}) AS initial_gb, gross_sum AS gbnf, net_sum AS nbnf, gross_sum AS gb,
  net_sum AS nb
FROM (
  SELECT invoice_id, line_item_id, paid_at_pt, discount_hist_updated_at_pt AS booking_at_pt,
    CASE WHEN is_cancelled AND is_initial_discount THEN '{fv.CANCELLED_INITIAL_DISCOUNT_AFTER}'
      WHEN is_cancelled THEN '{fv.CANCELLED_ADDITIONAL_DISCOUNT}'
      WHEN is_cancelled IS NULL THEN NULL
      WHEN is_initial_discount THEN '{fv.INITIAL_DISCOUNT_AFTER}'
      ELSE '{fv.ADDITIONAL_DISCOUNT}' END AS booking_category_detail,
    CASE is_cancelled WHEN TRUE THEN '{fv.CANCELLED_LINE_ITEM_DISCOUNT}'
      WHEN FALSE THEN '{fv.LINE_ITEM_DISCOUNT}' END AS booking_category,
    cart_line_item_id,
    {total("CASE is_cancelled WHEN TRUE THEN discount_amount WHEN FALSE THEN -discount_amount ELSE 0 END")}
      AS net_sum,
    {total("discount_amount", "is_cancelled AND is_initial_discount")} AS gross_sum
  FROM {{classify_discounts}}
  WHERE is_after_fpa_date AND line_item_id IS NOT NULL
  GROUP BY 1, 2, 3, 4, 5, 6, 7)
""",
    "combined_bookings": "\nUNION ALL\n".join(
        f"SELECT {BOOKING}, is_after_fpa_date, {AMOUNTS} FROM {{{stage}}}"
        for stage in (
            "initial_line_item_bookings",
            "additional_line_item_bookings",
            "initial_line_item_discounts",
            "additional_line_item_discounts",
        )
    ),
    "fill_line_item_dimensions": f"""
SELECT invoice_id, line_item_id, cart_line_item_id,
  {nearest("subscription_id")}, {nearest("user_id")}, {nearest("workspace_id")},
  {nearest("price_point_id")},
  {PAID}, booking_at_pt, booking_category_detail, booking_category, is_after_fpa_date, {AMOUNTS}
FROM {{combined_bookings}} b
WINDOW by_time AS (PARTITION BY line_item_id
  ORDER BY booking_at_pt NULLS LAST, b.user_id IS NULL, {
      BOOKING_TIES.replace("subscription_id", "b.subscription_id")
      .replace("user_id", "b.user_id").replace("workspace_id", "b.workspace_id")
      .replace("price_point_id", "b.price_point_id")})
""",
    "initial_invoice_discounts": f"""
SELECT invoice_id, paid_at_pt AS {PAID}, discount_hist_updated_at_pt, discount_apply_type_id,
  {total("CASE WHEN is_cancelled THEN discount_amount ELSE -discount_amount END")}
    AS gbnf_discount_amount,
  gbnf_discount_amount AS nbnf_discount_amount
FROM {{classify_discounts}}
WHERE line_item_id IS NULL AND is_initial_discount AND NOT is_after_fpa_date
GROUP BY 1, 2, 3, 4
""",
    "additional_invoice_discounts": f"""
SELECT invoice_id, {PAID}, discount_hist_updated_at_pt, discount_apply_type_id,
  gbnf_discount_amount, nbnf_discount_amount,
  CAST({share("unsigned", "sum(unsigned) OVER (PARTITION BY invoice_id)")} AS {SHARE})
    AS share_of_additional
FROM (
  SELECT invoice_id, paid_at_pt AS {PAID}, discount_hist_updated_at_pt, discount_apply_type_id,
    {total("discount_amount", "is_cancelled AND is_initial_discount")} AS gbnf_discount_amount,
    {total("CASE WHEN is_cancelled THEN discount_amount ELSE -discount_amount END")}
      AS nbnf_discount_amount,
    sum(discount_amount) AS unsigned
  FROM {{classify_discounts}}
  WHERE line_item_id IS NULL AND is_after_fpa_date
  GROUP BY 1, 2, 3, 4)
""",
    "item_sums": f"""
SELECT {ITEM}, {", ".join(
    f"{total(m, 'NOT is_after_fpa_date')} AS initial_{m}, {total(m)} AS additional_{m}"
    for m in ("gbnf", "nbnf", "gb", "nb"))}
FROM {{fill_line_item_dimensions}} GROUP BY {ITEM}
""",
    "invoice_sums": f"""
SELECT invoice_id, i.rule AS initial_rule, a.rule AS additional_rule,
  i.gross AS invoice_initial_gbnf_discount, i.net AS invoice_initial_nbnf_discount,
  a.gross AS invoice_additional_gbnf_discount, a.net AS invoice_additional_nbnf_discount
FROM (SELECT invoice_id, max(discount_apply_type_id) AS rule,
        {total("gbnf_discount_amount")} AS gross, {total("nbnf_discount_amount")} AS net
      FROM {{initial_invoice_discounts}} GROUP BY 1) i
FULL JOIN (SELECT invoice_id, max(discount_apply_type_id) AS rule,
        {total("gbnf_discount_amount")} AS gross, {total("nbnf_discount_amount")} AS net
      FROM {{additional_invoice_discounts}} GROUP BY 1) a USING (invoice_id)
""",
    "item_shares": f"""
SELECT *,
  {perc("initial", "gbnf", "gb")}, {perc("initial", "nbnf", "nb")},
  {perc("additional", "gbnf", "gb")}, {perc("additional", "nbnf", "nb")}
FROM (SELECT s.*, q.product_type, q.product_name, v.* EXCLUDE (invoice_id),
        {joins("initial")}, {joins("additional")}
      FROM {{item_sums}} s
      LEFT JOIN {{invoice_sums}} v ON v.invoice_id = s.invoice_id
      LEFT JOIN {{in_product}} q ON q.price_point_id = s.price_point_id)
WINDOW in_invoice AS (PARTITION BY invoice_id)
""",
    "item_allocation_percentages": f"""
SELECT {ITEM}, product_type, product_name, initial_rule AS initial_discount_apply_type_id,
  additional_rule AS additional_discount_apply_type_id,
  {", ".join(f"{side}_{m} AS line_item_{side}_{m}"
             for side in ("initial", "additional") for m in ("gbnf", "nbnf", "gb", "nb"))},
  {", ".join(f"invoice_{side}_{m}_discount, CAST({m}_{side}_perc AS {SHARE}) AS {m}_{side}_perc, "
             f"CAST(CAST({m}_{side}_perc AS {SHARE}) * invoice_{side}_{m}_discount AS DECIMAL(27,10)) "
             f"AS {m}_{side}_discount_invoice_level"
             for side in ("initial", "additional") for m in ("gbnf", "nbnf"))}
FROM {{item_shares}}
""",
    # One line per item and discount row, added up per booking at the end.
    "allocate_initial_invoice_discounts": f"""
SELECT {ITEM}, {PAID}, booking_at_pt, booking_category_detail, booking_category,
  CAST(sum(gross) AS DECIMAL(38,18)) AS initial_gbnf, CAST(0 AS DECIMAL(38,18)) AS filing_fee,
  CAST(sum(gross) AS DECIMAL(38,18)) AS initial_discount_amount,
  CAST(0 AS DECIMAL(38,18)) AS additional_discount_amount,
  CAST(sum(gross) AS DECIMAL(38,18)) AS gbnf, CAST(sum(net) AS DECIMAL(38,18)) AS nbnf
FROM (
  SELECT {ITEM.replace("invoice_id", "i.invoice_id", 1)}, d.{PAID},
    coalesce(d.{PAID}, d.discount_hist_updated_at_pt) AS booking_at_pt,
    CASE WHEN least(gross, net) <= 0 THEN '{fv.INITIAL_INVOICE_DISCOUNT_BEFORE}'
      ELSE '{fv.CANCELLED_INITIAL_INVOICE_DISCOUNT_BEFORE}' END AS booking_category_detail,
    CASE WHEN least(gross, net) <= 0 THEN '{fv.INVOICE_LEVEL_DISCOUNT}'
      ELSE '{fv.CANCELLED_INVOICE_LEVEL_DISCOUNT}' END AS booking_category, gross, net
  FROM (SELECT {ITEM}, sum(gbnf_initial_discount_invoice_level) AS gross,
          sum(nbnf_initial_discount_invoice_level) AS net
        FROM {{item_allocation_percentages}} GROUP BY {ITEM}) i
  LEFT JOIN {{initial_invoice_discounts}} d ON d.invoice_id = i.invoice_id
  WHERE gross <> 0 OR net <> 0)
GROUP BY {ITEM}, {PAID}, booking_at_pt, booking_category_detail, booking_category
""",
    "allocate_additional_invoice_discounts": f"""
SELECT {ITEM}, {PAID}, booking_at_pt, booking_category_detail, booking_category,
  CAST(0 AS DECIMAL(38,18)) AS initial_gbnf, CAST(0 AS DECIMAL(38,18)) AS filing_fee,
  CAST(0 AS DECIMAL(38,18)) AS initial_discount_amount,
  CAST(sum(part * net) AS DECIMAL(38,18)) AS additional_discount_amount,
  CAST(sum(part * gross) AS DECIMAL(38,18)) AS gbnf,
  CAST(sum(part * net) AS DECIMAL(38,18)) AS nbnf
FROM (
  SELECT {ITEM.replace("invoice_id", "i.invoice_id", 1)}, d.{PAID},
    d.discount_hist_updated_at_pt AS booking_at_pt,
    CASE WHEN gross > 0 THEN '{fv.CANCELLED_INITIAL_INVOICE_DISCOUNT_AFTER}'
      WHEN gross = 0 AND net > 0 THEN '{fv.CANCELLED_ADDITIONAL_INVOICE_DISCOUNT}'
      WHEN net < 0 THEN '{fv.ADDITIONAL_INVOICE_DISCOUNT}' END AS booking_category_detail,
    CASE WHEN greatest(gross, net) > 0 THEN '{fv.CANCELLED_INVOICE_LEVEL_DISCOUNT}'
      WHEN net < 0 THEN '{fv.INVOICE_LEVEL_DISCOUNT}' END AS booking_category,
    CAST(share_of_additional AS {SHARE}) AS part,
    CAST(gross AS DECIMAL(21,10)) AS gross, CAST(net AS DECIMAL(21,10)) AS net
  FROM (SELECT {ITEM}, sum(gbnf_additional_discount_invoice_level) AS gross,
          sum(nbnf_additional_discount_invoice_level) AS net
        FROM {{item_allocation_percentages}} GROUP BY {ITEM}) i
  JOIN {{additional_invoice_discounts}} d ON d.invoice_id = i.invoice_id)
WHERE part * gross <> 0 OR part * net <> 0
GROUP BY {ITEM}, {PAID}, booking_at_pt, booking_category_detail, booking_category
""",
    "store_credit_bookings": f"""
SELECT invoice_id, line_item_id, cart_line_item_id, subscription_id, user_id, workspace_id,
  price_point_id, {PAID}, event_occurred_at_pt,
  CASE WHEN early THEN {PAID} ELSE event_occurred_at_pt END AS booking_at_pt,
  CASE WHEN early THEN '{fv.CREDIT_BEFORE}' ELSE '{fv.CREDIT_AFTER}' END
    AS booking_category_detail,
  '{fv.LINE_ITEM_CREDIT}' AS booking_category,
  {total("-amount", "early AND is_fee = FALSE")} AS initial_gbnf,
  {total("-amount", "early AND is_fee")} AS initial_gb,
  CAST(0 AS {MONEY}) AS filing_fee, CAST(0 AS {MONEY}) AS initial_discount_amount,
  CAST(0 AS {MONEY}) AS additional_discount_amount,
  {total("-amount", "early AND is_fee = FALSE")} AS gbnf,
  {total("-amount", "is_fee = FALSE")} AS nbnf,
  {total("-amount", "early AND is_fee")} AS gb, {total("-amount")} AS nb
FROM (
  SELECT c.invoice_id, c.line_item_id, c.amount, {local("c.event_utc")} AS event_occurred_at_pt,
    l.* EXCLUDE (line_item_id), p.{PAID}, q.is_fee,
    coalesce({local("c.event_utc")} <= p.{PAID}, FALSE) AS early
  FROM {{in_store_credits}} c
  LEFT JOIN {{in_line_item}} l ON l.line_item_id = c.line_item_id
  LEFT JOIN {{in_product}} q ON q.price_point_id = l.price_point_id
  LEFT JOIN {{first_payment_approved}} p ON p.invoice_id = c.invoice_id
  WHERE c.event_type = '{fv.CREDIT_EVENT_ISSUED}' AND c.source_id = '{fv.CREDIT_SOURCE_ID}')
GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11
""",
    "all_bookings": "\nUNION ALL\n".join(
        f"SELECT {BOOKING}, "
        + ", ".join(f"CAST({a} AS DECIMAL(38,18)) AS {n}" for n, a in columns.items())
        + f" FROM {{{stage}}}"
        for stage, columns in {
            "fill_line_item_dimensions": {c: c for c in AMOUNTS.split(", ")},
            "allocate_initial_invoice_discounts": {
                c: {"initial_gb": "initial_gbnf", "gb": "gbnf", "nb": "nbnf"}.get(c, c)
                for c in AMOUNTS.split(", ")
            },
            "allocate_additional_invoice_discounts": {
                c: {"initial_gb": "initial_gbnf", "gb": "gbnf", "nb": "nbnf"}.get(c, c)
                for c in AMOUNTS.split(", ")
            },
            "store_credit_bookings": {c: c for c in AMOUNTS.split(", ")},
        }.items()
    ),
    "bookings_grouped": f"""
SELECT {BOOKING},
  coalesce(booking_category = '{fv.CANCELLED_LINE_ITEM_BOOKING}', FALSE) AS is_cancelled_booking,
  coalesce(booking_category ILIKE '{fv.CANCELLED_PATTERN}', FALSE) AS is_cancelled,
  coalesce(booking_at_pt >= {PAID}, FALSE) AS is_booking_after_fpa_date,
  {", ".join(f"CAST(coalesce(sum({a}), 0) AS DECIMAL(15,2)) AS {a}" for a in AMOUNTS.split(", "))}
FROM {{all_bookings}} GROUP BY {BOOKING}
""",
    "volume_eligibility": f"""
SELECT g.*,
  last_value(is_cancelled_booking) OVER (
    PARTITION BY line_item_id, is_booking_after_fpa_date
    ORDER BY booking_at_pt NULLS LAST, {BOOKING_TIES.replace("price_point_id", "g.price_point_id").replace("invoice_id", "g.invoice_id")}
    ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_booking_is_cancelled,
  CASE WHEN is_cancelled THEN FALSE
    WHEN {PAID} IS NULL THEN coalesce(q.code = '{fv.FREE_PRODUCT_CODE}' AND s.invoice_gb = 0, FALSE)
    WHEN NOT is_booking_after_fpa_date AND last_booking_is_cancelled THEN FALSE
    ELSE gb > 0 OR coalesce(q.code = '{fv.FREE_PRODUCT_CODE}' AND s.invoice_gb > 0, FALSE)
    END AS counts_as_order_item,
  coalesce(booking_category = '{fv.LINE_ITEM_BOOKING}' AND line_item_id = cart_line_item_id, FALSE)
    AS counts_as_order
FROM {{bookings_grouped}} g
LEFT JOIN {{in_product}} q ON q.price_point_id = g.price_point_id
LEFT JOIN (SELECT invoice_id, sum(gb) AS invoice_gb FROM {{bookings_grouped}} GROUP BY 1) s
  ON s.invoice_id IS NOT DISTINCT FROM g.invoice_id
""",
    "gross_order_item_volume": f"""
SELECT *, CAST(counts_as_order_item AND 1 = row_number() OVER (
    PARTITION BY line_item_id, counts_as_order_item
    ORDER BY booking_at_pt NULLS LAST, {BOOKING_TIES}) AS INTEGER) AS gross_order_item_volume
FROM {{volume_eligibility}}
""",
    "gross_order_volume": f"""
SELECT *, CAST(counts_as_order AND
  1 = row_number() OVER (PARTITION BY line_item_id, counts_as_order
    ORDER BY booking_at_pt NULLS LAST, {BOOKING_TIES})
  AND 1 = max(gross_order_item_volume) OVER (PARTITION BY invoice_id) AS INTEGER)
  AS gross_order_volume
FROM {{gross_order_item_volume}}
""",
    "third_party_payment_invoices": f"""
SELECT coalesce(order_id, invoice_id) AS invoice_id,
  count(*) FILTER (WHERE third_party) AS third_party_payments,
  coalesce(bool_or(third_party), FALSE) AS invoice_has_third_party_gateway_payment
FROM {{in_payment}} WHERE status = '{fv.PAYMENT_STATUS_APPROVED}'
GROUP BY coalesce(order_id, invoice_id)
""",
    "line_item_bookings": f"""
SELECT md5(concat(coalesce(CAST(v.line_item_id AS VARCHAR), ''), '-',
    coalesce(strftime(booking_at_pt, '%Y-%m-%d %H:%M:%S.%g'), ''), '-',
    coalesce(booking_category_detail, ''), '-', coalesce(booking_category, ''), '-',
    coalesce(CAST(v.price_point_id AS VARCHAR), ''))) AS booking_id,
  v.invoice_id, v.line_item_id, v.cart_line_item_id, v.subscription_id, v.user_id,
  v.workspace_id, v.price_point_id, {PAID}, booking_at_pt, booking_category_detail,
  booking_category, gross_order_volume, gross_order_item_volume, {AMOUNTS},
  coalesce(t.invoice_has_third_party_gateway_payment, FALSE)
    AS invoice_has_third_party_gateway_payment,
  l.cart_price_point_id, l.root_price_point_id, l.source_fulfillment_id,
  l.source_cart_line_item_id, l.source_invoice_id, l.source_line_item_id,
  l.source_subscription_id, l.source_user_id, l.source_root_price_point_id,
  l.source_cart_price_point_id, l.source_system
FROM {{gross_order_volume}} v
LEFT JOIN {{third_party_payment_invoices}} t ON t.invoice_id = v.invoice_id
LEFT JOIN {{in_line_item}} l ON l.line_item_id = v.line_item_id
""",
    "data_ready_check": f"""
SELECT CAST(CAST(max(dtlastupdated) AS DATE)
  >= CAST({local("TIMESTAMP '2024-01-30 08:15:00'")} AS DATE) AS INTEGER) AS has_today
FROM {{in_freshness}}
""",
    "bookings_quality": "\nUNION ALL\n".join(
        f"SELECT 'unique_{name}' AS check_name, count(*) AS failures FROM "
        f"(SELECT {key} FROM {{{table}}} WHERE {key} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"
        for name, table, key in (
            ("price_point", "in_price_point", "price_point_id"),
            ("line_item_hierarchy", "in_hierarchy", "line_item_id"),
            ("product_price_point", "in_product", "price_point_id"),
            ("line_item", "in_line_item", "line_item_id"),
            ("line_item_hist", "in_line_item_hist", "hist_id"),
            ("discount_hist", "in_discount_hist", "hist_id"),
            ("booking_id", "line_item_bookings", "booking_id"),
        )
    )
    + """
UNION ALL
SELECT 'initial_discounts_allocated', count(*) FROM (
  SELECT invoice_id, CAST(sum(nbnf_discount_amount) AS DOUBLE) * count(*) AS given
  FROM {initial_invoice_discounts} GROUP BY 1)
LEFT JOIN (SELECT invoice_id, CAST(sum(nbnf) AS DOUBLE) AS booked, count(*) AS n
           FROM {allocate_initial_invoice_discounts} GROUP BY 1) USING (invoice_id)
WHERE abs(coalesce(booked, 0) - given) > 0.01 + abs(given) * coalesce(n, 0) * 1e-8
UNION ALL
SELECT 'additional_discounts_allocated', count(*) FROM (
  SELECT invoice_id, CAST(sum(nbnf_discount_amount) AS DOUBLE) AS given
  FROM {additional_invoice_discounts} GROUP BY 1)
LEFT JOIN (SELECT invoice_id, CAST(sum(nbnf) AS DOUBLE) AS booked, count(*) AS n
           FROM {allocate_additional_invoice_discounts} GROUP BY 1) USING (invoice_id)
WHERE abs(coalesce(booked, 0) - given) > 0.01 + abs(given) * coalesce(n, 0) * 1e-8
""",
}

"""The registered queries once more, as DuckDB SQL over the same trade tables.

Each statement is put together from named CTEs, written independently of the Spark plans: native
``date_diff`` where Spark counts hours, filtered distinct counts where Spark groups twice, row joins
where Spark counts first.
"""

from __future__ import annotations

from shopmarts.plans import contract

LOADED = "1788961669.673802"
FIRST, SECOND, THIRD = "1788900000.1", "1788930000.2", "1788960000.3"

ORACLE: dict[str, str] = {}


# Source tables ---------------------------------------------------------------------------------

ORIGINS = "['ethiopia','colombia','brazil','kenya','guatemala','honduras','peru','rwanda']"

SOURCE = {
    "src_customers": """
        SELECT c_custkey AS id, 'Customer' AS first_name, substr(c_name, 10) AS last_name,
               'CUST' || substr(c_name, 10) || '@Example.org' AS email,
               CASE WHEN c_custkey % 10 < 3 THEN NULL ELSE '+32' || substr(c_name, 10) END AS phone,
               n_name AS city, r_name AS country,
               CASE c_custkey % 9 WHEN 0 THEN 'business' ELSE 'consumer' END AS segment,
               c_custkey % 20 < 9 AS is_marketing_opt_in,
               TIMESTAMP '1994-06-01' AS created_at, TIMESTAMP '1994-06-01' AS updated_at
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
                      LEFT JOIN region ON n_regionkey = r_regionkey""",
    "src_products": f"""
        SELECT p_partkey AS id, lpad(p_partkey::VARCHAR, 13, '0') AS sku,
               ({ORIGINS})[p_partkey % 8 + 1] AS origin,
               CASE WHEN p_size % 7 IN (0, 1, 2) THEN 'medium'
                    WHEN p_size % 7 IN (3, 4) THEN 'light' ELSE 'dark' END AS roast,
               CASE WHEN p_type IN ('ECONOMY', 'STANDARD', 'SMALL') THEN 'beans'
                    WHEN p_type = 'MEDIUM' THEN 'ground' WHEN p_type = 'LARGE' THEN 'capsules'
                    WHEN p_type = 'PROMO' THEN 'equipment' END AS category,
               250 + 15 * p_size AS weight_grams,
               round(p_retailprice * 100)::BIGINT AS unit_price_cents,
               round(p_retailprice * 45)::BIGINT AS cost_cents,
               p_partkey % 20 < 17 AS is_active,
               TIMESTAMP '1994-06-01' AS created_at, TIMESTAMP '1994-06-01' AS updated_at
        FROM part""",
    "timed_orders": """
        SELECT o_orderkey AS k, o_custkey AS c,
               o_orderdate + to_hours(o_orderkey % 24) + to_minutes(o_orderkey % 60) AS ordered,
               CASE WHEN o_orderkey % 5 > 0
                    THEN o_orderdate + to_hours(o_orderkey % 24 + o_orderkey % 97)
                         + to_minutes(60 + o_orderkey * 13 % 60) END AS shipped
        FROM orders""",
    "src_orders": """
        SELECT k AS id, c - (c % 8 = 7)::INT AS customer_id,
               (['delivered', 'shipped', 'paid', 'pending', 'cancelled'])
                 [1 + (k % 21 >= 14)::INT + (k % 21 >= 17)::INT + (k % 21 >= 19)::INT
                    + (k % 21 >= 20)::INT] AS status,
               (['web', 'mobile_app', 'marketplace', 'store'])
                 [1 + ((k * 7 + c) % 12 >= 6)::INT + ((k * 7 + c) % 12 >= 9)::INT
                    + ((k * 7 + c) % 12 >= 11)::INT] AS channel,
               ordered AS ordered_at, shipped AS shipped_at, delivered AS delivered_at,
               'City ' || (c % 25) AS shipping_city, 'Country ' || (c % 5) AS shipping_country,
               ordered AS created_at, coalesce(delivered, shipped, ordered) AS updated_at
        FROM (SELECT *, CASE WHEN k % 10 >= 3 THEN shipped + to_hours(k % 72) END AS delivered
              FROM timed_orders)""",
    "src_lines": """
        SELECT (l_orderkey::VARCHAR || lpad(l_linenumber::VARCHAR, 2, '0')
                || lpad(l_partkey::VARCHAR, 11, '0') || lpad(l_suppkey::VARCHAR, 10, '0')
                || lpad(l_quantity::BIGINT::VARCHAR, 2, '0'))::DECIMAL(38,0) AS id,
               l_orderkey AS order_id, l_partkey AS product_id, l_quantity::INT AS quantity,
               round(l_extendedprice * 100 / l_quantity)::BIGINT AS unit_price_cents,
               round(l_discount * 100)::BIGINT * 60 AS discount_cents
        FROM lineitem""",
}

# The same four tables with values spoiled and rows doubled.
BROKEN = {
    "bad_customers": """
        SELECT * REPLACE (CASE WHEN id % 50 <> 1 THEN email END AS email,
                          CASE WHEN id % 40 = 2 THEN 'vip' ELSE segment END AS segment)
        FROM src_customers, (VALUES (1), (2)) copies(n) WHERE n = 1 OR id % 60 = 3""",
    "bad_products": """
        SELECT * REPLACE (CASE WHEN id % 70 <> 5 THEN sku END AS sku,
                          CASE WHEN id % 45 = 4 THEN 'tea' ELSE category END AS category)
        FROM src_products, (VALUES (1), (2)) copies(n) WHERE n = 1 OR id % 80 = 6""",
    "bad_orders": """
        SELECT * REPLACE (CASE WHEN id % 34 = 7 THEN NULL WHEN id % 33 = 6 THEN -id - 1
                               ELSE customer_id END AS customer_id,
                          CASE WHEN id % 35 = 8 THEN 'lost' ELSE status END AS status,
                          CASE WHEN id % 36 <> 9 THEN ordered_at END AS ordered_at,
                          CASE WHEN id % 38 = 11 THEN 'kiosk' ELSE channel END AS channel)
        FROM src_orders, (VALUES (1), (2)) copies(n) WHERE n = 1 OR id % 37 = 10""",
    # Spark spoils column after column, so a later test sees the values of an earlier one.
    "bad_lines": """
        SELECT * EXCLUDE (p, o, n)
               REPLACE (CASE WHEN p % 64 = 3 THEN -p - 1 ELSE p END AS product_id,
                        CASE WHEN p % 62 = 1 THEN -(CASE WHEN p % 61 <> 0 THEN o END) - 1
                             WHEN p % 61 <> 0 THEN o END AS order_id,
                        CASE WHEN o % 63 <> 2 THEN quantity END AS quantity)
        FROM (SELECT *, product_id AS p, order_id AS o FROM src_lines),
             (VALUES (1), (2)) copies(n)
        WHERE n = 1 OR (CASE WHEN p % 64 = 3 THEN -p - 1 ELSE p END) % 65 = 4""",
}


# Models ----------------------------------------------------------------------------------------


def eur(cents: str) -> str:
    """Exact euros; the brackets around the argument matter."""
    return f"((({cents})::DECIMAL(30,0) * 0.01)::DECIMAL(18,2))"


def label(code: str) -> str:
    text = f"translate(lower({code}), '_', ' ')"
    return f"upper(left({text}, 1)) || substr({text}, 2)"


def model_ctes(customers: str, products: str, orders: str, lines: str) -> dict[str, str]:
    gross = "l.quantity::BIGINT * l.unit_price_cents"
    net = f"{gross} - l.discount_cents"
    return {
        "stg_customers": f"""
            SELECT id AS customer_id, first_name, last_name, lower(email) AS email, phone, city,
                   country, segment AS customer_segment, is_marketing_opt_in, created_at,
                   updated_at, '{LOADED}' AS dlt_load_id FROM {customers}""",
        "stg_products": f"""
            SELECT id AS product_id, sku, origin AS coffee_origin, roast AS roast_level,
                   category AS product_category, weight_grams, unit_price_cents, cost_cents,
                   is_active, created_at, updated_at, '{LOADED}' AS dlt_load_id FROM {products}""",
        "stg_orders": f"""
            SELECT id AS order_id, customer_id, status AS order_status, channel AS sales_channel,
                   ordered_at, shipped_at, delivered_at, shipping_city, shipping_country,
                   created_at, updated_at, '{LOADED}' AS dlt_load_id FROM {orders}""",
        "stg_lines": f"""
            SELECT id AS order_item_id, order_id, product_id, quantity, unit_price_cents,
                   discount_cents, '{LOADED}' AS dlt_load_id FROM {lines}""",
        "money": f"""
            SELECT l.order_id, count(*) AS line_item_count, sum(l.quantity)::BIGINT AS units,
                   sum({gross})::BIGINT AS gross_amount_cents,
                   sum(l.discount_cents)::BIGINT AS discount_cents,
                   sum({net})::BIGINT AS net_amount_cents
            FROM stg_lines l GROUP BY ALL""",
        "fct_orders": f"""
            SELECT o.order_id, o.customer_id, o.ordered_at, o.ordered_at::DATE AS order_date,
                   o.order_status, o.sales_channel,
                   {label("o.order_status")} AS order_status_label,
                   {label("o.sales_channel")} AS channel_label,
                   o.shipping_city, o.shipping_country, o.shipped_at, o.delivered_at,
                   ifnull(m.line_item_count, 0) AS line_item_count, ifnull(m.units, 0) AS units,
                   {eur("ifnull(m.gross_amount_cents, 0)")} AS gross_amount_eur,
                   {eur("ifnull(m.discount_cents, 0)")} AS discount_eur,
                   {eur("ifnull(m.net_amount_cents, 0)")} AS net_amount_eur,
                   CASE WHEN o.order_status = 'cancelled' THEN 0
                        ELSE {eur("ifnull(m.net_amount_cents, 0)")} END::DECIMAL(18,2)
                     AS realised_net_amount_eur,
                   o.order_status = 'cancelled' AS is_cancelled,
                   o.order_status = 'delivered' AS is_delivered,
                   date_diff('hour', o.ordered_at, o.shipped_at) / 24.0 AS days_to_ship
            FROM stg_orders o LEFT JOIN money m USING (order_id)""",
        "fct_lines": f"""
            SELECT l.order_item_id, l.order_id, l.product_id, o.customer_id, o.ordered_at,
                   o.order_status, o.sales_channel,
                   {label("o.order_status")} AS order_status_label,
                   {label("o.sales_channel")} AS channel_label, l.quantity,
                   {eur("l.unit_price_cents")} AS unit_price_eur, {eur(gross)} AS gross_amount_eur,
                   {eur("l.discount_cents")} AS discount_eur, {eur(net)} AS net_amount_eur,
                   CASE WHEN o.order_status = 'cancelled' THEN 0
                        ELSE {eur(net)} END::DECIMAL(18,2) AS realised_net_amount_eur,
                   o.order_status = 'cancelled' AS is_cancelled
            FROM stg_lines l, stg_orders o WHERE l.order_id = o.order_id""",
        "dim_customers": f"""
            SELECT c.customer_id, c.first_name || ' ' || c.last_name AS full_name, c.email, c.phone,
                   c.city, c.country, c.customer_segment,
                   {label("c.customer_segment")} AS segment_label, c.is_marketing_opt_in,
                   c.created_at AS customer_since_at, t.first_order_at, t.last_order_at,
                   ifnull(t.orders, 0) AS lifetime_order_count,
                   {eur("ifnull(t.cents, 0)")} AS lifetime_realised_net_revenue_eur,
                   t.orders IS NOT NULL AS has_ordered
            FROM stg_customers c LEFT JOIN (
                SELECT o.customer_id, count(*) AS orders, min(o.ordered_at) AS first_order_at,
                       max(o.ordered_at) AS last_order_at, sum(m.net_amount_cents) AS cents
                FROM stg_orders o LEFT JOIN money m USING (order_id)
                WHERE o.order_status <> 'cancelled' GROUP BY o.customer_id
            ) t ON t.customer_id = c.customer_id""",
        "dim_products": f"""
            SELECT product_id, sku,
                   origin_label || ' · ' || roast_label || ' roast · ' || category_label || ' '
                     || weight_grams || 'g' AS product_name,
                   coffee_origin, roast_level, product_category, origin_label, roast_label,
                   category_label, weight_grams, {eur("unit_price_cents")} AS unit_price_eur,
                   {eur("cost_cents")} AS unit_cost_eur,
                   {eur("unit_price_cents - cost_cents")} AS unit_margin_eur,
                   is_active, created_at AS listed_at
            FROM (SELECT *, {label("coffee_origin")} AS origin_label,
                         {label("roast_level")} AS roast_label,
                         {label("product_category")} AS category_label FROM stg_products)""",
    }


MODELS = model_ctes("src_customers", "src_products", "src_orders", "src_lines")
BAD_MODELS = model_ctes("bad_customers", "bad_products", "bad_orders", "bad_lines")


def over(ctes: dict[str, str], body: str) -> str:
    listed = ",\n".join(f"{name} AS ({text}\n)" for name, text in ctes.items())
    return f"WITH {listed}\n{body}"


def on_source(body: str) -> str:
    return over(SOURCE, body)


def on_marts(body: str) -> str:
    return over(SOURCE | MODELS, body)


def on_bad_marts(body: str) -> str:
    return over(SOURCE | BROKEN | BAD_MODELS, body)


for key, cte in {
    "stg_customers": "stg_customers",
    "stg_products": "stg_products",
    "stg_orders": "stg_orders",
    "stg_order_items": "stg_lines",
    "int_order_money": "money",
    "fct_orders": "fct_orders",
    "fct_order_items": "fct_lines",
    "dim_customers": "dim_customers",
    "dim_products": "dim_products",
}.items():
    ORACLE[key] = on_marts(f"SELECT * FROM {cte}")


# Reports ---------------------------------------------------------------------------------------

NET = "sum(realised_net_amount_eur)::DECIMAL(38,2)"
BOOKED = "sum(net_amount_eur)::DECIMAL(38,2)"
LOST = f"({BOOKED} - {NET})::DECIMAL(38,2)"
N = "count(DISTINCT order_id)"
GONE = "count(DISTINCT CASE WHEN is_cancelled THEN order_id END)"
KEPT = "count(DISTINCT CASE WHEN NOT is_cancelled THEN order_id END)"
RATE = f"{GONE}::DOUBLE / nullif({N}, 0)"
MONTH = "date_trunc('month', ordered_at)::TIMESTAMP"
PRODUCT_LINES = "fct_lines JOIN dim_products USING (product_id)"

REPORTS = {
    "headline": f"""
        SELECT {NET} AS net_revenue_eur, {BOOKED} AS booked_revenue_eur,
               {LOST} AS revenue_lost_eur, {N} AS order_count,
               {NET}::DOUBLE / nullif({KEPT}, 0) AS average_order_value_eur,
               {RATE} AS cancellation_rate FROM fct_orders""",
    "revenue_by_month": f"""
        SELECT {MONTH} AS month, {NET} AS net_revenue_eur, {BOOKED} AS booked_revenue_eur,
               {N} AS order_count FROM fct_orders GROUP BY ALL ORDER BY month""",
    "revenue_by_channel": f"""
        SELECT channel_label, {NET} AS net_revenue_eur, {N} AS order_count
        FROM fct_orders GROUP BY ALL ORDER BY net_revenue_eur DESC, channel_label""",
    "order_status_mix": f"""
        SELECT order_status_label, {N} AS order_count
        FROM fct_orders GROUP BY ALL ORDER BY order_count DESC, order_status_label""",
    # Days are whole hours over 24, so their exact mean needs one division.
    "fulfilment_speed": f"""
        SELECT {MONTH} AS month,
               sum(date_diff('hour', ordered_at, shipped_at))::DOUBLE
                 / (count(days_to_ship) * 24.0)::DOUBLE AS avg_days_to_ship
        FROM fct_orders WHERE days_to_ship IS NOT NULL GROUP BY ALL ORDER BY month""",
    "top_products": f"""
        SELECT product_name, origin_label, roast_label, {NET} AS net_revenue_eur,
               sum(CASE WHEN NOT is_cancelled THEN quantity END)::BIGINT AS units
        FROM {PRODUCT_LINES} GROUP BY ALL
        ORDER BY net_revenue_eur DESC, product_name, origin_label, roast_label LIMIT 10""",
    "top_customers": """
        SELECT full_name, city, segment_label, lifetime_order_count,
               lifetime_realised_net_revenue_eur
        FROM dim_customers WHERE has_ordered
        ORDER BY lifetime_realised_net_revenue_eur DESC, customer_id LIMIT 20""",
    "revenue_by_segment": """
        SELECT segment_label, count(*) AS customers,
               sum(lifetime_realised_net_revenue_eur)::DECIMAL(38,2) AS net_revenue_eur
        FROM dim_customers WHERE has_ordered GROUP BY ALL ORDER BY net_revenue_eur DESC""",
    "cancel_summary": f"""
        SELECT {GONE} AS cancelled_orders, {N} AS order_count, {RATE} AS cancellation_rate,
               {LOST} AS revenue_lost_eur,
               {LOST}::DOUBLE / nullif({BOOKED}, 0)::DOUBLE AS revenue_lost_share
        FROM fct_orders""",
    "cancel_by_month": f"""
        SELECT {MONTH} AS month, {RATE} AS cancellation_rate, {LOST} AS revenue_lost_eur
        FROM fct_orders GROUP BY ALL ORDER BY month""",
    "cancel_by_channel": f"""
        SELECT channel_label, {N} AS order_count, {RATE} AS cancellation_rate,
               {LOST} AS revenue_lost_eur
        FROM fct_orders GROUP BY ALL ORDER BY cancellation_rate DESC, channel_label""",
    "cancel_by_product": f"""
        SELECT product_name, {LOST} AS revenue_lost_eur, {NET} AS realised_revenue_eur
        FROM {PRODUCT_LINES} GROUP BY product_name HAVING {LOST} > 0
        ORDER BY revenue_lost_eur DESC, product_name LIMIT 10""",
    "shape": f"""
        SELECT count(*) AS orders, count(DISTINCT customer_id) AS customers, {NET} AS revenue_eur,
               {BOOKED} AS booked_eur,
               count_if(is_cancelled)::DOUBLE / nullif(count(*), 0) AS cancellation_rate,
               min(order_date) AS from_date, max(order_date) AS to_date FROM fct_orders""",
}
for key, body in REPORTS.items():
    ORACLE[f"rpt_{key}"] = on_marts(body)
ORACLE["run_headline"] = ORACLE["rpt_headline"]

ORACLE["stored_marts"] = on_marts(
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count, "
        f"sum({column})::DECIMAL(38,2) AS money_eur FROM {cte}"
        for name, cte, column in (
            ("fct_orders", "fct_orders", "net_amount_eur"),
            ("fct_order_items", "fct_lines", "net_amount_eur"),
            ("dim_customers", "dim_customers", "lifetime_realised_net_revenue_eur"),
            ("dim_products", "dim_products", "unit_price_eur"),
        )
    )
)


# Functions -------------------------------------------------------------------------------------

ORACLE["fn_cents_to_eur"] = on_source(f"""
    SELECT id, {eur("unit_price_cents")} AS price_eur,
           {eur("unit_price_cents - cost_cents")} AS margin_eur,
           {eur("cost_cents - unit_price_cents * 3")} AS below_zero_eur FROM src_products""")
ORACLE["fn_sentence_case"] = on_source(f"""
    SELECT id, {label("channel")} AS channel_label, {label("upper(status)")} AS status_label,
           {label("substr(status, 20)")} AS empty_label,
           {label("CASE WHEN id % 2 = 0 THEN status END")} AS optional_label FROM src_orders""")
ORACLE["fn_time"] = on_source(f"""
    SELECT id, date_diff('hour', ordered_at, shipped_at) AS hours_to_ship,
           date_diff('hour', shipped_at, ordered_at) AS hours_back, {MONTH} AS month,
           epoch(to_timestamp(split_part('{LOADED}', '.', 1)::BIGINT))::BIGINT AS load_second
    FROM src_orders""")


# Checks ----------------------------------------------------------------------------------------

CTE_OF = {
    "stg_webshop__customers": "stg_customers",
    "stg_webshop__products": "stg_products",
    "stg_webshop__orders": "stg_orders",
    "stg_webshop__order_items": "stg_lines",
    "int_orders__items_aggregated": "money",
    "fct_orders": "fct_orders",
    "fct_order_items": "fct_lines",
    "dim_customers": "dim_customers",
    "dim_products": "dim_products",
}


def unique_checks() -> str:
    return " UNION ALL ".join(
        f"""SELECT 'unique {model}.{column}' AS check_name, count({column}) AS rows_checked,
            (SELECT count(*) FROM (SELECT {column} FROM {CTE_OF[model]} WHERE {column} IS NOT NULL
                                   GROUP BY 1 HAVING count(*) > 1)) AS failures
            FROM {CTE_OF[model]}"""
        for model, columns in contract.UNIQUE.items()
        for column in columns
    )


def not_null_checks() -> str:
    return " UNION ALL ".join(
        f"""SELECT 'not_null {model}.{column}' AS check_name, count(*) AS rows_checked,
            count(*) - count({column}) AS failures FROM {CTE_OF[model]}"""
        for model, columns in contract.NOT_NULL.items()
        for column in columns
    )


def accepted_checks() -> str:
    return " UNION ALL ".join(
        f"""SELECT 'accepted_values {model}.{column}' AS check_name, count(*) AS rows_checked,
            count(*) FILTER (WHERE {column} NOT IN ({", ".join(f"'{v}'" for v in values)}))
              AS failures FROM {CTE_OF[model]}"""
        for model, columns in contract.ACCEPTED.items()
        for column, values in columns.items()
    )


def relationship_checks() -> str:
    return " UNION ALL ".join(
        f"""SELECT 'relationships {child}.{column}' AS check_name, count({column}) AS rows_checked,
            count({column}) FILTER (WHERE {column} NOT IN
              (SELECT {key} FROM {CTE_OF[parent]} WHERE {key} IS NOT NULL)) AS failures
            FROM {CTE_OF[child]}"""
        for child, column, parent, key in contract.RELATIONSHIPS
    )


def compared(lines: str) -> str:
    return f"""
        SELECT 'fct_orders vs fct_order_items (booked)' AS check_name,
               o.order_id::VARCHAR AS row_key, o.net_amount_eur::DECIMAL(30,2) AS left_value,
               ifnull(i.booked, 0)::DECIMAL(30,2) AS right_value
        FROM fct_orders o LEFT JOIN
          (SELECT order_id, sum(net_amount_eur) AS booked FROM {lines} GROUP BY 1) i
          USING (order_id)
        UNION ALL
        SELECT 'fct_orders vs fct_order_items (realised)', o.order_id::VARCHAR,
               o.realised_net_amount_eur::DECIMAL(30,2), ifnull(i.realised, 0)::DECIMAL(30,2)
        FROM fct_orders o LEFT JOIN
          (SELECT order_id, sum(realised_net_amount_eur) AS realised FROM {lines} GROUP BY 1) i
          USING (order_id)
        UNION ALL
        SELECT 'dim_customers vs fct_orders (realised)', c.customer_id::VARCHAR,
               c.lifetime_realised_net_revenue_eur::DECIMAL(30,2),
               ifnull(o.realised, 0)::DECIMAL(30,2)
        FROM dim_customers c LEFT JOIN
          (SELECT customer_id, sum(realised_net_amount_eur) AS realised FROM fct_orders GROUP BY 1) o
          USING (customer_id)"""


def realised_rows(orders: str, lines: str) -> str:
    return f"""
        SELECT 'fct_orders' AS model, order_id::VARCHAR AS row_key, net_amount_eur,
               realised_net_amount_eur, is_cancelled FROM {orders}
        UNION ALL
        SELECT 'fct_order_items', order_item_id::VARCHAR, net_amount_eur,
               realised_net_amount_eur, is_cancelled FROM {lines}"""


BREAKS = "realised_net_amount_eur <> CASE WHEN is_cancelled THEN 0 ELSE net_amount_eur END"

for key, body in {
    "unique": unique_checks(),
    "not_null": not_null_checks(),
    "accepted_values": accepted_checks(),
    "relationships": relationship_checks(),
}.items():
    ORACLE[f"chk_{key}"] = on_marts(body)
    ORACLE[f"chk_{key}_broken"] = on_bad_marts(body)

ORACLE["chk_reconcile"] = on_marts(f"""
    SELECT check_name, count(*) AS rows_checked,
           count_if(abs(left_value - right_value) > 0.005)::BIGINT AS failures
    FROM ({compared("fct_lines")}) GROUP BY 1""")
ORACLE["chk_reconcile_broken"] = on_marts(f"""
    SELECT *, (left_value - right_value)::DECIMAL(30,2) AS difference
    FROM ({compared('''(SELECT * REPLACE ((gross_amount_eur * 100 - discount_eur)::DECIMAL(18,2)
                        AS net_amount_eur) FROM fct_lines)''')})
    WHERE abs(left_value - right_value) > 0.005""")
ORACLE["chk_realised"] = on_marts(f"""
    SELECT 'realised ' || model AS check_name, count(*) AS rows_checked,
           count_if({BREAKS})::BIGINT AS failures
    FROM ({realised_rows("fct_orders", "fct_lines")}) GROUP BY 1""")
FORGETFUL = "(SELECT * REPLACE (net_amount_eur AS realised_net_amount_eur) FROM {})"
ORACLE["chk_realised_broken"] = on_marts(f"""
    SELECT * FROM ({realised_rows(FORGETFUL.format("fct_orders"), FORGETFUL.format("fct_lines"))})
    WHERE {BREAKS}""")

MONEY_COLUMNS = [
    ("fct_orders", "gross_amount_eur"),
    ("fct_orders", "discount_eur"),
    ("fct_orders", "net_amount_eur"),
    ("fct_orders", "realised_net_amount_eur"),
    ("fct_order_items", "unit_price_eur"),
    ("fct_order_items", "gross_amount_eur"),
    ("fct_order_items", "discount_eur"),
    ("fct_order_items", "net_amount_eur"),
    ("fct_order_items", "realised_net_amount_eur"),
    ("dim_customers", "lifetime_realised_net_revenue_eur"),
    ("dim_products", "unit_price_eur"),
    ("dim_products", "unit_cost_eur"),
    ("dim_products", "unit_margin_eur"),
]


def money_checks(floating: set[tuple[str, str]]) -> str:
    parts = []
    for model, column in MONEY_COLUMNS:
        value = f"{column}::DOUBLE" if (model, column) in floating else column
        parts.append(
            f"""SELECT '{model}' AS table_name, '{column}' AS column_name,
                min(typeof({value})) AS data_type, count(*) AS rows_checked,
                count_if(typeof({value}) NOT LIKE 'DECIMAL%')::BIGINT AS failures,
                min(typeof({value})) LIKE 'DECIMAL%' AS is_exact FROM {CTE_OF[model]}"""
        )
    return " UNION ALL ".join(parts)


ORACLE["chk_money_exact"] = on_marts(money_checks(set()))
ORACLE["chk_money_exact_broken"] = on_marts(
    money_checks({("fct_orders", "net_amount_eur"), ("dim_products", "unit_margin_eur")})
)
ORACLE["chk_freshness"] = on_source(
    " UNION ALL ".join(
        f"""SELECT '{table}' AS table_name, max(loaded)::BIGINT AS loaded_second,
            (1788961669 - max(loaded))::BIGINT AS age_seconds, '{status}' AS status
            FROM (SELECT {1788961669 - hours * 3600} AS loaded FROM src_{table})"""
        for table, hours, status in (
            ("customers", 35, "pass"),
            ("products", 37, "warn"),
            ("orders", 73, "error"),
        )
    )
)


# Loads -----------------------------------------------------------------------------------------


def lineage(load_id: str) -> str:
    return f"'{load_id}' AS _dlt_load_id, md5(id::VARCHAR || '|{load_id}') AS _dlt_id"


ORACLE["load_full"] = on_source(
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, id::VARCHAR AS id, {lineage(FIRST)} FROM {cte}"
        for name, cte in (
            ("customers", "src_customers"),
            ("products", "src_products"),
            ("orders", "src_orders"),
            ("order_items", "src_lines"),
        )
    )
)
for _name, _cte in (("customers", "src_customers"), ("products", "src_products"), ("order_items", "src_lines")):
    ORACLE[f"load_{_name}"] = on_source(f"SELECT *, {lineage(FIRST)} FROM {_cte}")
ORACLE["load_rerun"] = on_source(f"SELECT *, {lineage(FIRST)} FROM src_orders")
ORACLE["load_stream"] = on_source(f"SELECT *, {lineage('1788900000.000000')} FROM src_orders")
ORACLE["load_incremental"] = on_source(f"""
    SELECT *,
           CASE WHEN order_id <= (SELECT max(order_id) // 2 FROM src_lines) THEN '{FIRST}'
                ELSE '{SECOND}' END AS _dlt_load_id FROM src_lines""")

THREE_LOADS = {
    "one": "SELECT * FROM src_orders WHERE ordered_at < TIMESTAMP '1998-01-01'",
    "two": """
        SELECT * FROM src_orders s
        WHERE updated_at >= (SELECT max(updated_at) FROM one)
          AND NOT EXISTS (FROM one WHERE one.id = s.id AND one.updated_at = s.updated_at
                          AND s.updated_at = (SELECT max(updated_at) FROM one))""",
    "held": f"""
        SELECT *, {lineage(SECOND)} FROM two UNION ALL
        SELECT *, {lineage(FIRST)} FROM one WHERE id NOT IN (SELECT id FROM two)""",
    "offered": """
        SELECT * REPLACE ('cancelled' AS status, TIMESTAMP '2002-01-02' AS updated_at)
        FROM src_orders WHERE id % 10 = 0 UNION ALL
        SELECT * REPLACE ('shipped' AS status, TIMESTAMP '2002-01-01' AS updated_at)
        FROM src_orders WHERE id % 20 = 0 UNION ALL
        SELECT * REPLACE ('paid' AS status) FROM src_orders WHERE id % 10 = 1 UNION ALL
        SELECT * FROM src_orders WHERE id % 10 > 2""",
    "three": """
        SELECT * FROM offered s
        WHERE updated_at >= (SELECT max(updated_at) FROM two)
          AND NOT EXISTS (FROM held WHERE held.id = s.id AND held.updated_at = s.updated_at)
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY updated_at DESC) = 1""",
    "landed": f"""
        SELECT *, {lineage(THIRD)} FROM three UNION ALL
        SELECT * FROM held WHERE id NOT IN (SELECT id FROM three)""",
}
ORACLE["load_merge"] = over(SOURCE | THREE_LOADS, "SELECT * FROM landed")
ORACLE["load_lineage"] = over(
    SOURCE | THREE_LOADS, 'SELECT _dlt_load_id, count(*) AS row_count FROM landed GROUP BY 1'
)
ORACLE["load_evolve"] = on_source(f"""
    SELECT * REPLACE (TIMESTAMP '2002-01-01' AS updated_at), {lineage(SECOND)}
    FROM src_customers WHERE id % 3 = 0 UNION ALL
    SELECT * REPLACE (NULL AS phone), {lineage(FIRST)} FROM src_customers WHERE id % 3 <> 0""")


# Comparison of two builds ----------------------------------------------------------------------

LATER = {
    "later": """
        SELECT * EXCLUDE shipping_city
               REPLACE (line_item_count::INT AS line_item_count,
                        CASE WHEN order_id % 13 = 0 THEN 0 ELSE realised_net_amount_eur END
                          ::DECIMAL(18,2) AS realised_net_amount_eur),
               units > 100 AS is_large FROM fct_orders WHERE order_id % 97 <> 0
        UNION ALL
        SELECT * EXCLUDE shipping_city
               REPLACE (line_item_count::INT AS line_item_count, -order_id - 1 AS order_id),
               units > 100 FROM fct_orders WHERE order_id % 89 = 0"""
}
WITH_LATER = SOURCE | MODELS | LATER
ORDER_COLUMNS = [
    "order_id",
    "customer_id",
    "ordered_at",
    "order_date",
    "order_status",
    "sales_channel",
    "order_status_label",
    "channel_label",
    "shipping_city",
    "shipping_country",
    "shipped_at",
    "delivered_at",
    "line_item_count",
    "units",
    "gross_amount_eur",
    "discount_eur",
    "net_amount_eur",
    "realised_net_amount_eur",
    "is_cancelled",
    "is_delivered",
    "days_to_ship",
]
CHANGES = {"shipping_city": "removed", "is_large": "added", "line_item_count": "retyped"}
ORACLE["diff_schema"] = over(
    WITH_LATER,
    " UNION ALL ".join(
        f"""SELECT '{name}' AS column_name, '{CHANGES.get(name, "same")}' AS change,
            {f"(SELECT count({name}) FROM fct_orders)" if name in ORDER_COLUMNS else "NULL::BIGINT"}
              AS filled_before,
            {f"(SELECT count({name}) FROM later)" if name != "shipping_city" else "NULL::BIGINT"}
              AS filled_after"""
        for name in [*ORDER_COLUMNS, "is_large"]
    ),
)
SHARED = "* EXCLUDE shipping_city REPLACE (line_item_count::BIGINT AS line_item_count)"
DIFFED = WITH_LATER | {
    "old_rows": f"SELECT {SHARED} FROM fct_orders",
    "new_rows": "SELECT * EXCLUDE is_large"
    " REPLACE (line_item_count::BIGINT AS line_item_count) FROM later",
    "gone": "SELECT order_id FROM (FROM old_rows EXCEPT ALL FROM new_rows)",
    "come": "SELECT order_id FROM (FROM new_rows EXCEPT ALL FROM old_rows)",
}
COUNTS = """(SELECT count(*) FROM fct_orders) AS rows_before,
            (SELECT count(*) FROM later) AS rows_after"""
ORACLE["diff_rows"] = over(
    DIFFED,
    f"""SELECT {COUNTS},
        (SELECT count(*) FROM gone WHERE order_id IN (FROM come)) AS rows_changed,
        (SELECT count(*) FROM gone WHERE order_id NOT IN (FROM come)) AS rows_removed,
        (SELECT count(*) FROM come WHERE order_id NOT IN (FROM gone)) AS rows_added""",
)
ORACLE["diff_rows_keyless"] = over(
    DIFFED,
    f"""SELECT {COUNTS}, 0::BIGINT AS rows_changed,
        (SELECT count(*) FROM gone) AS rows_removed, (SELECT count(*) FROM come) AS rows_added""",
)
METRICS = {
    "orders": "count(*)",
    "booked revenue": "sum(net_amount_eur)",
    "realised revenue": "sum(realised_net_amount_eur)",
}
ORACLE["diff_metrics"] = over(
    WITH_LATER,
    f"""SELECT metric, value_before, value_after,
        (value_after - value_before)::DECIMAL(38,6) AS shift,
        (value_after - value_before)::DOUBLE / nullif(value_before, 0)::DOUBLE * 100 AS shift_pct
        FROM ({
        " UNION ALL ".join(
            f"SELECT '{name}' AS metric, "
            f"(SELECT {agg} FROM fct_orders)::DECIMAL(38,6) AS value_before, "
            f"(SELECT {agg} FROM later)::DECIMAL(38,6) AS value_after"
            for name, agg in METRICS.items()
        )
    })""",
)


# The production path: what a whole run has exported, every column of it.

for _report in [name.removeprefix("rpt_") for name in list(ORACLE) if name.startswith("rpt_")]:
    ORACLE[f"exported_{_report}"] = ORACLE[f"rpt_{_report}"]
for _mart in ("fct_orders", "fct_order_items", "dim_customers", "dim_products"):
    ORACLE[f"exported_{_mart}"] = ORACLE[_mart]

"""SQL counterparts of the registered queries, for an independent check in DuckDB.

Written from the definitions, not from the Spark plans: money is kept in whole
cents, and divisions are rounded half away from zero in integers, because ``/``
on decimals yields an approximate number there. Every statement covers its whole
tables.
"""

from __future__ import annotations

import re

AS_OF = "DATE '2001-08-01'"
FIRST_DAY = "DATE '2001-07-22'"
OPEN_END = "DATE '9999-12-31'"


def div_round(n: str, d: str) -> str:
    """Integer quotient rounded half away from zero; NULL for a zero divisor."""
    n, d = f"CAST({n} AS HUGEINT)", f"CAST({d} AS HUGEINT)"
    size = f"(2 * abs({n}) + abs({d})) // (2 * abs({d}))"
    return f"(CASE WHEN {d} <> 0 THEN (CASE WHEN ({n} < 0) <> ({d} < 0) THEN -1 ELSE 1 END) * ({size}) END)"


def cents(n: str) -> str:
    return f"CAST({n} AS DOUBLE) / CAST(100 AS DOUBLE)"


def pct(part: str, whole: str) -> str:
    """Percentage with two digits, from two integers of the same unit."""
    return cents(div_round(f"10000 * CAST({part} AS HUGEINT)", whole))


def big(n: str) -> str:
    return f"CAST({n} AS BIGINT)"


def text_cents(n: str) -> str:
    return (
        f"(CASE WHEN {n} < 0 THEN '-' ELSE '' END || CAST(abs({n}) // 100 AS VARCHAR) || '.' || "
        f"lpad(CAST(abs({n}) % 100 AS VARCHAR), 2, '0'))"
    )


def one_of(index: str, *values: str) -> str:
    cases = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {index} {cases} END"


def tier_of(price: str) -> str:
    return f"CASE WHEN {price} < 5000 THEN 'Budget' WHEN {price} <= 20000 THEN 'Mid-range' ELSE 'Premium' END"


def stamp(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S')"


TIERS = ("Bronze", "Silver", "Gold", "Platinum")
TIER_INDEX = "CASE WHEN c_acctbal < 2500 THEN 0 WHEN c_acctbal < 5000 THEN 1 WHEN c_acctbal < 8000 THEN 2 ELSE 3 END"
SPEND = "CAST(round(c_acctbal * 100) AS BIGINT) * 10"
EMAIL = "'^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{2,}$'"

FEEDS = {
    "part_c": """
        SELECT p_partkey AS pk, p_name, p_brand, p_type, p_size,
               (CAST(round(p_retailprice * 100) AS BIGINT) - 90000) * 5 AS list_c
        FROM part""",
    "products_1": """
        SELECT pk AS product_id, CASE WHEN pk % 17 = 4 THEN '' ELSE p_name END AS title,
               CASE WHEN pk % 19 = 18 THEN 0 ELSE list_c END AS price_c, CAST(DATE '2001-07-22' AS TIMESTAMP) AS ingested,
               'load-1' AS run_id, p_name, p_type, p_size
        FROM part_c""",
    "products_2": """
        SELECT pk AS product_id, CASE WHEN pk % 34 = 4 THEN '' ELSE p_name END AS title,
               CASE WHEN pk % 13 = 0 THEN (list_c * 110 + 50) // 100 WHEN pk % 31 = 7 THEN 0
                    ELSE list_c END AS price_c,
               CAST(DATE '2001-08-01' AS TIMESTAMP) AS ingested, 'load-2' AS run_id, p_name, p_type, p_size
        FROM part_c""",
    "bronze_products": "SELECT * FROM products_1 UNION ALL SELECT * FROM products_2",
    "product_attrs": """
        SELECT pk AS product_id,
               CASE WHEN pk % 10 <> 3 THEN p_type || ' ' || p_name END AS description, p_type AS category,
               CASE WHEN pk % 7 <> 2 THEN 'https://img.example.com/' || pk END AS image_url,
               CASE WHEN pk % 11 = 5 THEN 0 ELSE (p_size % 41) * 10 + 100 END AS rating_c,
               p_size * 7 AS rating_count
        FROM part_c""",
    "bronze_customers": f"""
        SELECT c_custkey AS ck, 'CUST' || c_custkey AS customer_id, 'Customer' AS first_name,
               CAST(c_custkey AS VARCHAR) AS last_name, c_mktsegment, c_acctbal,
               CASE WHEN c_custkey % 50 = 7 THEN c_name WHEN c_custkey % 50 = 9 THEN NULL
                    ELSE replace(c_name, '#', '.') || '@' || c_mktsegment || '.Example.com' END AS email,
               '+91-' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS phone, n_name AS city, r_name AS state,
               CASE WHEN c_custkey % 40 = 7 THEN CAST({AS_OF} - CAST(c_custkey % 29 AS INTEGER) AS DATE)
                    ELSE CAST(DATE '1998-08-01' + CAST(c_custkey * 37 % 1060 AS INTEGER) AS DATE) END AS signup_date,
               {one_of(TIER_INDEX, *TIERS)} AS loyalty_tier, {SPEND} AS spend_c, c_custkey % 20 <> 0 AS is_active
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
        LEFT JOIN region ON n_regionkey = r_regionkey""",
    "later_customers": f"""
        SELECT * REPLACE (
            CASE WHEN ck % 23 = 1 THEN {one_of(f"least(({TIER_INDEX}) + 1, 3)", *TIERS)} ELSE loyalty_tier END AS loyalty_tier,
            spend_c + CASE WHEN ck % 23 = 2 THEN 50000 ELSE 0 END AS spend_c,
            is_active AND ck % 29 <> 5 AS is_active)
        FROM bronze_customers""",
    "order_feed": f"""
        SELECT *, total_c - discount_c AS final_c FROM (
          SELECT *, (total_c * CASE promo_code WHEN 'SAVE10' THEN 10 WHEN 'FLASH20' THEN 20 WHEN 'NEW50' THEN 50
                               WHEN 'WEEK15' THEN 15 ELSE 0 END + 50) // 100 AS discount_c
          FROM (
            SELECT 'ORD' || l_orderkey || '-' || l_linenumber AS order_id,
                   CASE WHEN o_custkey % 97 = 96 THEN 'GUEST' ELSE 'CUST' END || o_custkey AS customer_id,
                   CASE WHEN l_suppkey % 89 = 88 THEN -l_partkey - 1 ELSE l_partkey END AS product_id,
                   CASE WHEN l_partkey % 101 = 100 THEN 0 ELSE CAST(l_quantity AS BIGINT) END AS quantity,
                   list_c AS unit_c,
                   list_c * CASE WHEN l_partkey % 101 = 100 THEN 0 ELSE CAST(l_quantity AS BIGINT) END AS total_c,
                   o_orderdate + to_hours(CAST(l_orderkey % 24 AS INTEGER))
                     + to_minutes(CAST(l_linenumber * 7 AS INTEGER)) AS order_ts,
                   CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND l_linenumber = 7 THEN 'on_hold'
                        WHEN o_custkey % 25 = 24 THEN 'pending'
                        WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'cancelled'
                        WHEN o_orderstatus = 'P' AND l_returnflag = 'N' THEN 'pending'
                        ELSE 'completed' END AS status,
                   lower(o_orderpriority) AS payment_method,
                   CASE WHEN round(l_discount * 100) < 5 THEN NULL WHEN round(l_discount * 100) < 7 THEN 'SAVE10'
                        WHEN round(l_discount * 100) = 7 THEN 'FLASH20' WHEN round(l_discount * 100) = 8 THEN 'NEW50'
                        ELSE 'WEEK15' END AS promo_code,
                   l_returnflag, l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part_c ON l_partkey = pk))""",
    "bronze_orders": """
        SELECT * FROM order_feed QUALIFY row_number() OVER (
            PARTITION BY order_id ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity) = 1""",
    "bronze_inventory": f"""
        SELECT pk AS product_id,
               CASE WHEN pk % 97 = 13 OR (pk % 41 = 5 AND d = 0) THEN -1 WHEN pk % 50 = 0 THEN 0
                    ELSE (pk * 31 + d * 17) % 500 END AS stock_quantity,
               56 - p_size AS reorder_point, ((56 - p_size) // 6 + 1) * 6 + length(p_type) AS reorder_quantity,
               CASE WHEN pk % 43 <> 11 THEN list_c - list_c * (15 + 2 * length(p_type) + p_size // 5) // 100 END AS cost_c,
               'Depot ' || p_brand AS warehouse_location,
               CAST({AS_OF} - CAST(d AS INTEGER) AS DATE) AS inventory_date
        FROM part_c, (VALUES (0), (7), (30)) AS days(d)""",
    "bronze_campaigns": f"""
        SELECT 'CAMP' || k AS campaign_id, n_name || ' ' || s_name AS campaign_name, r_name AS channel,
               coalesce(code, 'OWN' || k) AS promo_code, p AS discount_percentage, start_date,
               CAST(start_date + CAST(3 + (k * 7 + p) % 28 AS INTEGER) AS DATE) AS end_date,
               budget_c, budget_c * 9 // 10 AS spend_c
        FROM (SELECT s_suppkey AS k, s_name, n_name, r_name, code, p,
                     CAST({AS_OF} - CAST(60 - (s_suppkey * 11 + p) % 50 AS INTEGER) AS DATE) AS start_date,
                     CASE WHEN s_suppkey % 29 = 15 THEN 0
                          ELSE 100 * (1000 * (4 ** (s_suppkey % 7))::BIGINT + p * 10)::BIGINT END AS budget_c
              FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
              JOIN (VALUES (0, 'SAVE10', 10), (1, 'FLASH20', 20), (2, 'NEW50', 50), (3, 'WEEK15', 15), (4, NULL, 25))
                AS t(slot, code, p) ON s_suppkey % 5 = slot)""",
    "campaigns_again": """
        SELECT c.* REPLACE (c.campaign_id || s.suffix AS campaign_id, c.campaign_name || ' (renamed)' AS campaign_name,
                            (c.spend_c * 110 + 50) // 100 AS spend_c)
        FROM bronze_campaigns c JOIN (VALUES ('', FALSE), ('-B', TRUE)) AS s(suffix, extra)
          ON NOT s.extra OR c.promo_code = 'WEEK15'""",
    "customer_records": f"""
        SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN customer_id ELSE 'CUSTN' || ck END AS customer_id,
               'Customer' || arrival AS first_name, last_name, email, signup_date,
               {one_of(f"least(({TIER_INDEX}) + arrival, 3)", *TIERS)} AS loyalty_tier,
               spend_c + arrival * 10000 AS spend_c, arrival = 1 AS is_active, arrival
        FROM bronze_customers JOIN (VALUES (1), (2)) AS a(arrival) ON arrival = 1 OR c_acctbal < 2500
        WHERE c_mktsegment IN ('BUILDING', 'FURNITURE')""",
    "customers_merged": """
        SELECT coalesce(c.customer_id, f.customer_id) AS customer_id, coalesce(c.first_name, f.first_name) AS first_name,
               coalesce(c.last_name, f.last_name) AS last_name,
               CASE WHEN c.customer_id IS NOT NULL THEN c.email ELSE f.email END AS email,
               coalesce(c.signup_date, f.signup_date) AS signup_date,
               coalesce(l.loyalty_tier, c.loyalty_tier) AS loyalty_tier, coalesce(l.spend_c, c.spend_c) AS spend_c,
               coalesce(l.is_active, c.is_active) AS is_active,
               c.customer_id IS NOT NULL AND l.customer_id IS NOT NULL AS modified
        FROM bronze_customers c
        FULL JOIN (SELECT * FROM customer_records WHERE arrival = 1) f ON c.customer_id = f.customer_id
        LEFT JOIN (SELECT * FROM customer_records
                   QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY arrival DESC) = 1) l
          ON l.customer_id = f.customer_id""",
}


def _clean_products(source: str) -> str:
    return f"""
        SELECT l.product_id, l.title AS product_name, l.price_c, a.description, a.category, a.image_url, a.rating_c,
               a.rating_count, {tier_of("l.price_c")} AS price_tier,
               100 - CASE WHEN l.title IS NULL OR l.title = '' THEN 20 ELSE 0 END
                   - CASE WHEN a.description IS NULL OR a.description = '' THEN 20 ELSE 0 END
                   - CASE WHEN a.image_url IS NULL OR a.image_url = '' THEN 10 ELSE 0 END
                   - CASE WHEN a.rating_c IS NULL OR a.rating_c = 0 THEN 10 ELSE 0 END AS score
        FROM (SELECT * FROM {source} WHERE price_c > 0
              QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY ingested DESC NULLS FIRST) = 1) l
        JOIN product_attrs a ON a.product_id = l.product_id"""


def _clean_customers(source: str, as_of: str) -> str:
    return f"""
        SELECT customer_id, trim(first_name || ' ' || last_name) AS full_name, lower(email) AS email, phone, city, state,
               signup_date, loyalty_tier, spend_c, is_active, date_diff('day', signup_date, {as_of}) AS age,
               CASE WHEN NOT is_active AND date_diff('day', signup_date, {as_of}) > 180 THEN 'Churned'
                    WHEN date_diff('day', signup_date, {as_of}) < 30 THEN 'New'
                    WHEN spend_c > 5000000 THEN 'VIP'
                    WHEN date_diff('day', signup_date, {as_of}) > 365 THEN 'Loyal'
                    ELSE 'Regular' END AS segment
        FROM {source} WHERE email IS NOT NULL AND regexp_matches(email, {EMAIL})"""


def _clean_orders(source: str) -> str:
    return f"""
        SELECT *, CAST(order_ts AS DATE) AS order_date FROM {source} o
        WHERE quantity > 0 AND unit_c > 0 AND status IN ('completed', 'pending', 'cancelled', 'refunded')
          AND EXISTS (SELECT 1 FROM bronze_customers c WHERE c.customer_id = o.customer_id)
          AND EXISTS (SELECT 1 FROM bronze_products p WHERE p.product_id = o.product_id)"""


CLEAN = {
    "clean_products": _clean_products("bronze_products"),
    "clean_products_1": _clean_products("products_1"),
    "clean_products_2": _clean_products("products_2"),
    "clean_customers": _clean_customers("bronze_customers", AS_OF),
    "clean_customers_1": _clean_customers("bronze_customers", FIRST_DAY),
    "clean_customers_2": _clean_customers("later_customers", AS_OF),
    "clean_orders": _clean_orders("bronze_orders"),
    "returned": """
        SELECT * REPLACE ('refunded' AS status, 0 AS final_c) FROM order_feed WHERE l_returnflag = 'R'
        QUALIFY row_number() OVER (
            PARTITION BY order_id ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity) = 1""",
    "clean_returned": _clean_orders("returned"),
    "latest_stock": """
        SELECT * FROM bronze_inventory WHERE stock_quantity >= 0
        QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY inventory_date DESC) = 1""",
    "clean_inventory": """
        SELECT *, CASE WHEN stock_quantity = 0 THEN 'Out of Stock' WHEN stock_quantity < reorder_point THEN 'Low Stock'
                       WHEN stock_quantity > reorder_point * 5 THEN 'Overstock' ELSE 'In Stock' END AS stock_status,
               coalesce(stock_quantity * cost_c, 0) AS value_c
        FROM latest_stock WHERE cost_c IS NULL OR cost_c > 0""",
    "done": "SELECT * FROM clean_orders WHERE status = 'completed'",
    "recent": f"SELECT * FROM done WHERE order_date >= CAST({AS_OF} - 30 AS DATE)",
}

MARTS = {
    "daily": """
        SELECT order_date AS d, sum(CASE WHEN status = 'completed' THEN final_c ELSE 0 END) AS revenue_c,
               count(*) AS n, sum(quantity) AS items, count(CASE WHEN status = 'completed' THEN 1 END) AS n_done,
               count(CASE WHEN status = 'pending' THEN 1 END) AS n_pending,
               count(CASE WHEN status = 'cancelled' THEN 1 END) AS n_cancelled,
               count(DISTINCT customer_id) AS customers, sum(discount_c) AS discount_c, count(promo_code) AS n_promo
        FROM clean_orders GROUP BY order_date""",
    "growth": """
        SELECT a.*, a.revenue_c - b.revenue_c AS change_c, b.revenue_c AS before_c
        FROM daily a LEFT JOIN daily b ON b.d = CAST(a.d - 1 AS DATE)""",
    "sales": """
        SELECT product_id, sum(quantity) AS units, sum(final_c) AS revenue_c, sum(unit_c * quantity) AS listed_c,
               count(DISTINCT customer_id) AS buyers FROM recent GROUP BY product_id""",
    "performance": """
        SELECT p.*, coalesce(s.units, 0) AS units, s.revenue_c AS sum_c, coalesce(s.revenue_c, 0) AS revenue_c,
               s.listed_c - i.cost_c * s.units AS profit_c, coalesce(s.buyers, 0) AS buyers
        FROM clean_products p LEFT JOIN sales s ON s.product_id = p.product_id
        LEFT JOIN clean_inventory i ON i.product_id = p.product_id""",
    "customer_totals": f"""
        SELECT c.customer_id, c.full_name, c.email, c.signup_date, count(o.order_id) AS n, sum(o.final_c) AS value_c,
               min(o.order_date) AS first_date, max(o.order_date) AS last_date,
               date_diff('day', max(o.order_date), {AS_OF}) AS days
        FROM clean_customers c LEFT JOIN done o ON o.customer_id = c.customer_id
        GROUP BY c.customer_id, c.full_name, c.email, c.signup_date""",
    "scores": """
        SELECT *, ntile(5) OVER (ORDER BY days ASC NULLS LAST, customer_id) AS r,
               ntile(5) OVER (ORDER BY n DESC, customer_id) AS f,
               ntile(5) OVER (ORDER BY value_c DESC NULLS FIRST, customer_id) AS m
        FROM customer_totals""",
    "rfm": """
        SELECT *, CASE WHEN r >= 4 AND f >= 4 AND m >= 4 THEN 'Champions'
                       WHEN r >= 3 AND f >= 3 AND m >= 3 THEN 'Loyal Customers'
                       WHEN r >= 4 AND f <= 2 THEN 'Potential Loyalists' WHEN r <= 2 AND f >= 3 THEN 'At Risk'
                       WHEN r <= 2 AND f <= 2 THEN 'Lost' WHEN n = 0 THEN 'New (No Orders)'
                       ELSE 'Regular' END AS segment,
               CASE WHEN coalesce(days, 9999) > 180 THEN 'High' WHEN coalesce(days, 9999) > 90 THEN 'Medium'
                    ELSE 'Low' END AS risk
        FROM scores""",
    "campaign_match": """
        SELECT c.campaign_id, o.* FROM bronze_campaigns c JOIN clean_orders o
          ON o.promo_code = c.promo_code AND o.order_date BETWEEN c.start_date AND c.end_date""",
    "campaign_sums": """
        SELECT c.*, coalesce(m.n, 0) AS n, m.revenue_c FROM bronze_campaigns c
        LEFT JOIN (SELECT campaign_id, count(*) AS n, sum(final_c) AS revenue_c FROM campaign_match
                   WHERE status = 'completed' GROUP BY campaign_id) m ON m.campaign_id = c.campaign_id""",
    "roi": f"""
        SELECT *, CASE WHEN spend_c > 0 THEN {pct("revenue_c - spend_c", "spend_c")} ELSE 0 END AS roi,
               CASE WHEN spend_c > 0 THEN {cents(div_round("100 * revenue_c", "spend_c"))} ELSE 0 END AS roas,
               CASE WHEN n > 0 THEN {cents(div_round("spend_c", "n"))} ELSE 0 END AS cost_per_order
        FROM campaign_sums""",
    "price_history_1": f"""
        SELECT product_id, product_name, category, price_c, price_tier, {FIRST_DAY} AS valid_from,
               {OPEN_END} AS valid_to, TRUE AS is_current, 'Initial record' AS change_reason
        FROM clean_products_1""",
    "price_actions": """
        SELECT h.product_id AS old_id, n.product_id AS new_id,
               CASE WHEN h.product_id IS NULL THEN 'new' WHEN n.product_id IS NULL THEN 'missing'
                    WHEN h.price_c IS DISTINCT FROM n.price_c OR h.price_tier IS DISTINCT FROM n.price_tier THEN 'updated'
                    ELSE 'unchanged' END AS action
        FROM price_history_1 h FULL JOIN clean_products n ON n.product_id = h.product_id""",
    "price_history": f"""
        SELECT h.* FROM price_history_1 h JOIN price_actions a ON a.old_id = h.product_id
        WHERE a.action IN ('missing', 'unchanged')
        UNION ALL
        SELECT h.* REPLACE (CAST({AS_OF} - 1 AS DATE) AS valid_to, FALSE AS is_current)
        FROM price_history_1 h JOIN price_actions a ON a.old_id = h.product_id WHERE a.action = 'updated'
        UNION ALL
        SELECT n.product_id, n.product_name, n.category, n.price_c, n.price_tier, {AS_OF}, {OPEN_END}, TRUE,
               CASE WHEN a.action = 'new' THEN 'Initial record' ELSE concat_ws('; ',
                 CASE WHEN h.price_c <> n.price_c THEN
                   'Price change: ₹' || {text_cents("h.price_c")} || ' → ₹' || {text_cents("n.price_c")} END,
                 CASE WHEN h.price_tier <> n.price_tier THEN 'Tier change: ' || h.price_tier || ' → ' || n.price_tier END)
               END
        FROM clean_products n JOIN price_actions a ON a.new_id = n.product_id
        LEFT JOIN price_history_1 h ON h.product_id = n.product_id WHERE a.action IN ('new', 'updated')""",
    "tier_history_1": f"""
        SELECT customer_id, full_name, email, loyalty_tier, spend_c, {FIRST_DAY} AS valid_from, {OPEN_END} AS valid_to,
               TRUE AS is_current, 'Initial record' AS change_reason FROM clean_customers_1 WHERE is_active""",
    "tier_now": "SELECT * FROM clean_customers_2 WHERE is_active",
    "tier_actions": """
        SELECT h.customer_id AS old_id, n.customer_id AS new_id,
               CASE WHEN h.customer_id IS NULL THEN 'new' WHEN n.customer_id IS NULL THEN 'missing'
                    WHEN h.loyalty_tier IS DISTINCT FROM n.loyalty_tier THEN 'updated' ELSE 'unchanged' END AS action
        FROM tier_history_1 h FULL JOIN tier_now n ON n.customer_id = h.customer_id""",
    "tier_history": f"""
        SELECT h.* FROM tier_history_1 h JOIN tier_actions a ON a.old_id = h.customer_id
        WHERE a.action IN ('missing', 'unchanged')
        UNION ALL
        SELECT h.* REPLACE (CAST({AS_OF} - 1 AS DATE) AS valid_to, FALSE AS is_current)
        FROM tier_history_1 h JOIN tier_actions a ON a.old_id = h.customer_id WHERE a.action = 'updated'
        UNION ALL
        SELECT n.customer_id, n.full_name, n.email, n.loyalty_tier, n.spend_c, {AS_OF}, {OPEN_END}, TRUE,
               CASE WHEN a.action = 'new' THEN 'Initial record' ELSE
                 'Tier upgrade: ' || h.loyalty_tier || ' → ' || n.loyalty_tier || ' (LTV: ₹' ||
                 {text_cents("h.spend_c")} || ' → ₹' || {text_cents("n.spend_c")} || ')' END
        FROM tier_now n JOIN tier_actions a ON a.new_id = n.customer_id
        LEFT JOIN tier_history_1 h ON h.customer_id = n.customer_id WHERE a.action IN ('new', 'updated')""",
    "order_reasons": """
        SELECT order_id, concat_ws(',',
                 CASE WHEN c.customer_id IS NULL THEN 'customer_known' END,
                 CASE WHEN p.product_id IS NULL THEN 'product_known' END,
                 CASE WHEN o.quantity <= 0 THEN 'quantity_positive' END,
                 CASE WHEN o.status = 'on_hold' THEN 'status_allowed' END,
                 CASE WHEN o.unit_c <= 0 THEN 'unit_price_positive' END) AS reasons
        FROM bronze_orders o LEFT JOIN bronze_customers c ON c.customer_id = o.customer_id
        LEFT JOIN products_1 p ON p.product_id = o.product_id""",
}

DEFINITIONS = FEEDS | CLEAN | MARTS

DAILY_COLUMNS = f"""
    d AS revenue_date, CAST(year(d) AS BIGINT) AS year, CAST(month(d) AS BIGINT) AS month,
    CAST(quarter(d) AS BIGINT) AS quarter, dayname(d) AS day_of_week, isodow(d) >= 6 AS is_weekend,
    {cents("revenue_c")} AS total_revenue, {big("n")} AS total_orders, {big("items")} AS total_items_sold,
    {cents(div_round("revenue_c", "n_done"))} AS average_order_value, {big("n_done")} AS completed_orders,
    {big("n_pending")} AS pending_orders, {big("n_cancelled")} AS cancelled_orders,
    {pct("n_cancelled", "n")} AS cancellation_rate, {big("customers")} AS unique_customers,
    {cents("discount_c")} AS total_discount_given, {big("n_promo")} AS orders_with_promo,
    {pct("n_promo", "n")} AS promo_usage_rate"""
GROWTH_COLUMNS = f"{cents('change_c')} AS revenue_vs_previous_day, {pct('change_c', 'before_c')} AS revenue_growth_pct"

PRODUCT_COLUMNS = f"""
    {big("product_id")} AS product_id, product_name, {cents("price_c")} AS price, description, category, image_url,
    {cents("rating_c")} AS average_rating, {big("rating_count")} AS review_count, price_tier, TRUE AS is_active,
    {big("score")} AS data_quality_score"""
ORDER_AMOUNTS = f"""
    {cents("unit_c")} AS unit_price, {cents("total_c")} AS total_amount, {cents("discount_c")} AS discount_amount,
    {cents("final_c")} AS final_amount"""
TIME_COLUMNS = f"""
    order_date, strftime(order_ts, '%H:%M:%S') AS order_time, {big("hour(order_ts)")} AS order_hour,
    dayname(order_ts) AS order_day_of_week, isodow(order_ts) >= 6 AS is_weekend, discount_c > 0 AS is_discounted"""
CAMPAIGN_COLUMNS = f"""
    campaign_id, campaign_name, channel, promo_code, {big("discount_percentage")} AS discount_percentage, start_date,
    end_date, {cents("budget_c")} AS budget, {cents("spend_c")} AS actual_spend"""
BRONZE_ORDER_COLUMNS = f"""
    order_id, customer_id, {big("product_id")} AS product_id, {big("quantity")} AS quantity, {ORDER_AMOUNTS}, status,
    promo_code"""
RFM_COLUMNS = f"""
    customer_id, full_name, email, signup_date, {big("r")} AS recency_score, {big("f")} AS frequency_score,
    {big("m")} AS monetary_score, CAST(r AS VARCHAR) || CAST(f AS VARCHAR) || CAST(m AS VARCHAR) AS rfm_combined_score,
    {big("coalesce(days, 9999)")} AS days_since_last_order, {big("n")} AS total_orders,
    {cents("coalesce(value_c, 0)")} AS total_lifetime_value,
    {cents(f"coalesce({div_round('value_c', 'n')}, 0)")} AS average_order_value, segment AS customer_segment,
    risk AS churn_risk, first_date AS first_order_date, last_date AS last_order_date"""
HISTORY_COLUMNS = "valid_from, valid_to, is_current, change_reason"
PRICE_HISTORY_COLUMNS = (
    f"{big('product_id')} AS product_id, product_name, category, {cents('price_c')} AS price, price_tier, {HISTORY_COLUMNS}"
)
STATUS_IN = "status IN ('completed', 'pending', 'cancelled', 'refunded')"

STATEMENTS: dict[str, str] = {
    "bronze_products_flatten": f"""
        SELECT {big("b.product_id")} AS product_id, b.title, {cents("b.price_c")} AS price, a.description, a.category,
               a.image_url, {cents("a.rating_c")} AS rating_rate, {big("a.rating_count")} AS rating_count,
               'product_feed' AS source, {stamp("b.ingested")} AS ingestion_timestamp, b.run_id AS pipeline_run_id
        FROM bronze_products b JOIN product_attrs a ON a.product_id = b.product_id""",
    "product_lookup": f"SELECT {PRODUCT_COLUMNS} FROM clean_products WHERE product_id = 42",
    "product_categories": "SELECT DISTINCT category FROM product_attrs",
    "raw_json_extract": f"""
        SELECT {big("b.product_id")} AS product_id, b.title, {cents("b.price_c")} AS price,
               {cents("a.rating_c")} AS rating_rate, {big("a.rating_count")} AS rating_count
        FROM products_1 b JOIN product_attrs a ON a.product_id = b.product_id""",
    "product_feed_json": f"""
        SELECT {big("b.product_id")} AS product_id, b.title, {cents("b.price_c")} AS price, a.description, a.category,
               a.image_url, {cents("a.rating_c")} AS rating_rate, {big("a.rating_count")} AS rating_count
        FROM products_1 b JOIN product_attrs a ON a.product_id = b.product_id""",
    "customer_feed_csv": f"""
        SELECT customer_id, last_name, email, city, signup_date, loyalty_tier,
               {cents("spend_c")} AS total_lifetime_spend, is_active FROM bronze_customers""",
    "order_feed_json": f"""
        SELECT order_id, customer_id, {big("product_id")} AS product_id, {big("quantity")} AS quantity,
               {cents("final_c")} AS final_amount, {stamp("order_ts")} AS order_timestamp, status, promo_code
        FROM bronze_orders""",
    "feed_rescued_lines": f"""
        SELECT {big("product_id")} AS product_id, inventory_date, {big("stock_quantity")} AS stock_quantity,
               CAST(NULL AS VARCHAR) AS line, CAST(NULL AS VARCHAR) AS reason
        FROM bronze_inventory WHERE product_id % 50 <> 7
        UNION ALL SELECT NULL, NULL, NULL, product_id || ',' || stock_quantity, 'malformed_record'
        FROM bronze_inventory WHERE product_id % 50 = 7""",
    "inventory_feed_csv": f"""
        SELECT {big("product_id")} AS product_id, {big("stock_quantity")} AS stock_quantity, warehouse_location,
               {big("reorder_point")} AS reorder_point, {big("reorder_quantity")} AS reorder_quantity,
               {cents("cost_c")} AS cost_price, inventory_date FROM bronze_inventory""",
    "campaign_feed_orc": f"SELECT {CAMPAIGN_COLUMNS} FROM bronze_campaigns",
    "user_feed_json": f"""
        SELECT {big("c_custkey")} AS id, CASE WHEN c_custkey % 50 <> 9 THEN replace(c_name, '#', '.') || '@example.com' END AS email,
               'user' || c_custkey AS username, c_mktsegment AS firstname, c_name AS lastname,
               CASE WHEN c_custkey % 10 <> 3 THEN '+' || (c_custkey * 7) END AS phone, n_name AS city,
               {big("c_custkey % 200")} AS number, CAST(c_custkey % 90000 + 10000 AS VARCHAR) AS zipcode
        FROM customer JOIN nation ON n_nationkey = c_nationkey""",
    "source_filename": f"SELECT 'lineitem.parquet' AS source_filename, {big('count(*)')} AS n FROM lineitem",
    "products_insert_ignore": f"""
        SELECT {big("product_id")} AS product_id, title, {cents("price_c")} AS price, {stamp("ingested")} AS ingestion_timestamp,
               {big("1")} AS load FROM products_1
        UNION ALL SELECT {big("product_id")}, title, {cents("price_c")}, {stamp("ingested")}, {big("2")} FROM products_2""",
    "surrogate_keys": f"""
        SELECT valid_from, {big("count(*)")} AS n, {big("count(DISTINCT product_id)")} AS n_ids
        FROM price_history GROUP BY valid_from""",
    "order_text_parse": f"""
        SELECT order_id, CASE WHEN status <> 'on_hold' THEN {stamp("order_ts")} END AS order_timestamp
        FROM bronze_orders""",
    "inventory_append": f"""
        SELECT inventory_date, {big("count(*)")} AS n, {big("sum(stock_quantity)")} AS stock, {big("1")} AS loads
        FROM bronze_inventory GROUP BY inventory_date""",
    "products_full_refresh": f"""
        SELECT price_tier, {big("count(*)")} AS n, {cents("sum(price_c)")} AS price_sum
        FROM clean_products GROUP BY price_tier""",
    "load_counts": f"""
        SELECT 'silver_products' AS table_name, 'accepted' AS outcome, {big("count(*)")} AS n FROM clean_products
        UNION ALL SELECT 'silver_products', 'rejected', {big("count(*)")} FROM bronze_products WHERE price_c <= 0
        UNION ALL SELECT 'silver_customers', 'accepted', {big("count(*)")} FROM clean_customers
        UNION ALL SELECT 'silver_customers', 'rejected', {big("count(*)")} FROM bronze_customers
          WHERE email IS NULL OR NOT regexp_matches(email, {EMAIL})
        UNION ALL SELECT 'silver_orders', 'accepted', {big("count(*)")} FROM clean_orders
        UNION ALL SELECT 'silver_orders', 'rejected', {big("count(*)")} FROM order_reasons WHERE reasons <> ''
        UNION ALL SELECT 'silver_inventory', 'accepted', {big("count(*)")} FROM clean_inventory
        UNION ALL SELECT 'silver_inventory', 'rejected', {big("count(*)")} FROM (
          SELECT 1 FROM bronze_inventory WHERE stock_quantity < 0
          UNION ALL SELECT 1 FROM latest_stock WHERE cost_c <= 0)
        UNION ALL SELECT 'silver_campaigns', 'accepted', {big("count(*)")} FROM bronze_campaigns""",
    "orders_insert_ignore": f"""
        SELECT {BRONZE_ORDER_COLUMNS} FROM (
          SELECT * FROM order_feed
          QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY
            CASE WHEN l_returnflag <> 'N' THEN 0 ELSE 1 END,
            l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity) = 1)""",
    "customers_upsert": f"""
        SELECT customer_id, first_name, last_name, email, signup_date, loyalty_tier,
               {cents("spend_c")} AS total_lifetime_spend, is_active, modified FROM customers_merged""",
    "campaigns_upsert": f"""
        SELECT a.campaign_id, coalesce(c.campaign_name, a.campaign_name) AS campaign_name,
               {cents("a.spend_c")} AS actual_spend, '2001-08-01 00:00:00' AS ingestion_timestamp,
               CASE WHEN c.campaign_id IS NULL THEN 'load-2' ELSE 'load-1' END AS pipeline_run_id
        FROM campaigns_again a LEFT JOIN bronze_campaigns c ON c.campaign_id = a.campaign_id""",
    "products_upsert": f"""
        SELECT {PRODUCT_COLUMNS} FROM (
          SELECT n.* REPLACE (coalesce(o.score, n.score) AS score)
          FROM clean_products_2 n LEFT JOIN clean_products_1 o ON o.product_id = n.product_id
          UNION ALL
          SELECT o.* FROM clean_products_1 o
          WHERE NOT EXISTS (SELECT 1 FROM clean_products_2 n WHERE n.product_id = o.product_id))""",
    "clean_customers_upsert": f"""
        SELECT customer_id, full_name, loyalty_tier, {cents("spend_c")} AS total_lifetime_spend, is_active,
               {big("age")} AS customer_age_days, segment AS customer_segment, '2001-07-22 00:00:00' AS created_at,
               '2001-08-01 00:00:00' AS updated_at, 'bronze_customers' AS source_table FROM clean_customers_2""",
    "clean_campaigns_upsert": f"""
        SELECT {CAMPAIGN_COLUMNS}, {AS_OF} BETWEEN start_date AND end_date AS is_active FROM campaigns_again""",
    "orders_status_upsert": f"""
        SELECT coalesce(o.order_id, r.order_id) AS order_id, coalesce(r.status, o.status) AS status,
               {big("coalesce(o.quantity, r.quantity)")} AS quantity,
               {cents("coalesce(o.total_c, r.total_c)")} AS total_amount,
               {cents("coalesce(o.final_c, r.final_c)")} AS final_amount
        FROM clean_orders o FULL JOIN clean_returned r ON r.order_id = o.order_id""",
    "dq_products_price": f"""
        SELECT {big("product_id")} AS product_id, {cents("price_c")} AS price,
               {stamp("ingested")} AS ingestion_timestamp, 'price_positive' AS reasons
        FROM bronze_products WHERE price_c <= 0""",
    "dq_customers_email": f"""
        SELECT customer_id, email, 'email_valid' AS reasons FROM bronze_customers
        WHERE email IS NULL OR NOT regexp_matches(email, {EMAIL})""",
    "dq_orders_positive": f"""
        SELECT order_id, {big("quantity")} AS quantity, {cents("unit_c")} AS unit_price,
               concat_ws(',', CASE WHEN quantity <= 0 THEN 'quantity_positive' END,
                         CASE WHEN unit_c <= 0 THEN 'unit_price_positive' END) AS reasons
        FROM bronze_orders WHERE quantity <= 0 OR unit_c <= 0""",
    "dq_orders_referential": f"""
        SELECT order_id, customer_id, {big("product_id")} AS product_id,
               CASE WHEN customer_id NOT IN (SELECT customer_id FROM bronze_customers) THEN 'customer_unknown'
                    WHEN product_id NOT IN (SELECT product_id FROM bronze_products) THEN 'product_unknown'
                    ELSE 'known' END AS outcome FROM bronze_orders""",
    "dq_orders_status": f"SELECT order_id, status FROM bronze_orders WHERE NOT {STATUS_IN}",
    "dq_inventory_stock": f"""
        SELECT {big("product_id")} AS product_id, inventory_date, {big("stock_quantity")} AS stock_quantity
        FROM bronze_inventory WHERE stock_quantity < 0""",
    "dq_schema_rules": f"""
        SELECT 'cost_positive' AS rule, {big("count(*)")} AS n FROM latest_stock WHERE cost_c <= 0 HAVING count(*) > 0""",
    "dq_customers_duplicate_email": """
        SELECT customer_id, lower(email) AS email FROM customers_merged WHERE email IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY lower(email) ORDER BY customer_id) > 1""",
    "dq_order_rejects": "SELECT order_id AS record_key, reasons FROM order_reasons WHERE reasons <> ''",
    "dq_customer_rejects": f"""
        SELECT customer_id AS record_key,
               CASE WHEN email IS NULL THEN 'email_required,email_valid' ELSE 'email_valid' END AS reasons
        FROM bronze_customers WHERE email IS NULL OR NOT regexp_matches(email, {EMAIL})""",
    "ri_coverage": f"""
        SELECT {big("count(CASE WHEN c.customer_id IS NULL THEN 1 END)")} AS orphans,
               {big("count(CASE WHEN c.customer_id IS NOT NULL AND o.customer_id IS NOT NULL THEN 1 END)")} AS referenced,
               {big("count(c.customer_id)")} AS total
        FROM (SELECT DISTINCT customer_id FROM bronze_orders) o
        FULL JOIN bronze_customers c ON c.customer_id = o.customer_id""",
    "latest_products": f"""
        SELECT {big("product_id")} AS product_id, title, {cents("price_c")} AS price,
               {stamp("ingested")} AS ingestion_timestamp
        FROM bronze_products WHERE price_c > 0
        QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY ingested DESC NULLS FIRST) = 1""",
    "latest_inventory": f"""
        SELECT {big("product_id")} AS product_id, {big("stock_quantity")} AS stock_quantity, inventory_date
        FROM latest_stock""",
    "silver_products": f"SELECT {PRODUCT_COLUMNS} FROM clean_products",
    "silver_customers": f"""
        SELECT customer_id, full_name, email, phone, city, state, 'India' AS country, signup_date, loyalty_tier,
               {cents("spend_c")} AS total_lifetime_spend, is_active, {big("age")} AS customer_age_days,
               segment AS customer_segment FROM clean_customers""",
    "silver_orders": f"""
        SELECT order_id, customer_id, {big("product_id")} AS product_id, {big("quantity")} AS quantity, {ORDER_AMOUNTS},
               {stamp("order_ts")} AS order_timestamp, status, payment_method, promo_code, {TIME_COLUMNS}
        FROM clean_orders""",
    "silver_inventory": f"""
        SELECT {big("product_id")} AS product_id, {big("stock_quantity")} AS stock_quantity, warehouse_location,
               {big("reorder_point")} AS reorder_point, {cents("cost_c")} AS cost_price, stock_status,
               {cents("value_c")} AS inventory_value, inventory_date FROM clean_inventory""",
    "silver_campaigns": f"""
        SELECT {CAMPAIGN_COLUMNS}, {AS_OF} BETWEEN start_date AND end_date AS is_active FROM bronze_campaigns""",
    "product_price_tier": f"""
        SELECT price_tier, {big("count(*)")} AS n, {cents("min(price_c)")} AS min_price,
               {cents("max(price_c)")} AS max_price FROM clean_products GROUP BY price_tier""",
    "product_quality_score": f"""
        SELECT {big("product_id")} AS product_id, {big("score")} AS data_quality_score FROM clean_products""",
    "customer_lifecycle_segment": f"""
        SELECT customer_id, full_name, {big("age")} AS customer_age_days, segment AS customer_segment
        FROM clean_customers""",
    "order_time_parts": f"SELECT order_id, {TIME_COLUMNS} FROM clean_orders",
    "order_amounts": f"""
        SELECT promo_code, {big("count(*)")} AS n, {cents("sum(total_c)")} AS total, {cents("sum(discount_c)")} AS discount,
               {cents("sum(final_c)")} AS final FROM order_feed GROUP BY promo_code""",
    "inventory_stock_status": f"""
        SELECT {big("product_id")} AS product_id, stock_status, {cents("value_c")} AS inventory_value
        FROM clean_inventory""",
    "campaign_active_flag": f"""
        SELECT campaign_id, {AS_OF} BETWEEN start_date AND end_date AS is_active FROM bronze_campaigns""",
    "daily_revenue": f"SELECT {DAILY_COLUMNS}, {GROWTH_COLUMNS} FROM growth",
    "revenue_growth": f"SELECT d AS revenue_date, {cents('revenue_c')} AS total_revenue, {GROWTH_COLUMNS} FROM growth",
    "order_status_counts": f"""
        SELECT d AS revenue_date, {big("n_done")} AS completed_orders, {big("n_pending")} AS pending_orders,
               {big("n_cancelled")} AS cancelled_orders, {pct("n_cancelled", "n")} AS cancellation_rate,
               {pct("n_promo", "n")} AS promo_usage_rate FROM daily""",
    "unique_customers_per_day": f"""
        SELECT d AS revenue_date, {big("customers")} AS unique_customers, {big("n")} AS total_orders FROM daily""",
    "unique_customers_by_period": f"""
        SELECT period, CAST(period_start AS DATE) AS period_start, {big("count(DISTINCT customer_id)")} AS unique_customers FROM (
          SELECT 'day' AS period, order_date AS period_start, customer_id FROM clean_orders
          UNION ALL SELECT 'month', date_trunc('month', order_date), customer_id FROM clean_orders
          UNION ALL SELECT 'quarter', date_trunc('quarter', order_date), customer_id FROM clean_orders)
        GROUP BY period, period_start""",
    "product_performance": f"""
        SELECT {big("product_id")} AS product_id, 'last_30_days' AS analysis_period,
               CAST({AS_OF} - 30 AS DATE) AS period_start_date, {AS_OF} AS period_end_date, product_name, category,
               {cents("price_c")} AS current_price, {big("units")} AS units_sold, {cents("revenue_c")} AS total_revenue,
               {cents("coalesce(profit_c, 0)")} AS total_profit,
               CASE WHEN sum_c > 0 THEN {pct("profit_c", "sum_c")} ELSE 0 END AS profit_margin,
               {big("buyers")} AS unique_customers, {cents("rating_c")} AS average_rating,
               {big("rank() OVER (ORDER BY revenue_c DESC)")} AS overall_rank,
               {big("rank() OVER (PARTITION BY category ORDER BY revenue_c DESC)")} AS category_rank
        FROM performance""",
    "product_overall_rank": f"""
        SELECT {big("product_id")} AS product_id, {cents("revenue_c")} AS total_revenue,
               {big("rank() OVER (ORDER BY revenue_c DESC)")} AS overall_rank FROM performance""",
    "product_category_rank": f"""
        SELECT {big("product_id")} AS product_id, category, {cents("revenue_c")} AS total_revenue,
               {big("rank() OVER (PARTITION BY category ORDER BY revenue_c DESC)")} AS category_rank FROM performance""",
    "customer_order_totals": f"""
        SELECT customer_id, {big("n")} AS total_orders, {cents("value_c")} AS total_lifetime_value,
               {cents(div_round("value_c", "n"))} AS average_order_value, first_date AS first_order_date,
               last_date AS last_order_date FROM customer_totals""",
    "rfm_scores": f"""
        SELECT customer_id, {big("days")} AS days_since_last_order, {big("n")} AS total_orders,
               {cents("value_c")} AS total_lifetime_value, {big("r")} AS recency_score, {big("f")} AS frequency_score,
               {big("m")} AS monetary_score FROM scores""",
    "customer_rfm": f"SELECT {RFM_COLUMNS} FROM rfm",
    "customer_rfm_conventional": """
        SELECT customer_id, CAST(r AS VARCHAR) || CAST(f AS VARCHAR) || CAST(m AS VARCHAR) AS rfm_combined_score,
               CASE WHEN r >= 4 AND f >= 4 AND m >= 4 THEN 'Champions'
                    WHEN r >= 3 AND f >= 3 AND m >= 3 THEN 'Loyal Customers'
                    WHEN r >= 4 AND f <= 2 THEN 'Potential Loyalists' WHEN r <= 2 AND f >= 3 THEN 'At Risk'
                    WHEN r <= 2 AND f <= 2 THEN 'Lost' WHEN n = 0 THEN 'New (No Orders)'
                    ELSE 'Regular' END AS customer_segment
        FROM (SELECT customer_id, n, 6 - r AS r, 6 - f AS f, 6 - m AS m FROM scores)""",
    "customer_segment_counts": f"""
        SELECT segment AS customer_segment, {big("count(*)")} AS n,
               {cents("sum(coalesce(value_c, 0))")} AS total_lifetime_value FROM rfm GROUP BY segment""",
    "churn_risk": f"""
        SELECT risk AS churn_risk, {big("count(*)")} AS n, {big("min(coalesce(days, 9999))")} AS min_days,
               {big("max(coalesce(days, 9999))")} AS max_days FROM rfm GROUP BY risk""",
    "inventory_health": f"""
        SELECT i.inventory_date AS snapshot_date, {big("p.product_id")} AS product_id, p.product_name, p.category,
               {big("i.stock_quantity")} AS current_stock, i.stock_status, i.warehouse_location,
               {cents("i.value_c")} AS inventory_value, {cents("i.cost_c")} AS cost_price,
               {cents("p.price_c")} AS selling_price,
               {cents("(p.price_c - i.cost_c) * i.stock_quantity")} AS potential_profit,
               i.stock_status = 'Low Stock' AS is_low_stock, i.stock_status = 'Overstock' AS is_overstock,
               i.stock_quantity > 0 AND i.product_id NOT IN (SELECT product_id FROM recent) AS is_dead_stock
        FROM clean_inventory i JOIN clean_products p ON p.product_id = i.product_id""",
    "dead_stock": f"""
        SELECT {big("product_id")} AS product_id, {big("stock_quantity")} AS stock_quantity FROM clean_inventory
        WHERE stock_quantity > 0 AND product_id NOT IN (SELECT product_id FROM recent)""",
    "campaign_order_match": f"""
        SELECT c.campaign_id, m.order_date, {big("m.n")} AS n_orders, {cents("m.revenue_c")} AS revenue
        FROM bronze_campaigns c
        LEFT JOIN (SELECT campaign_id, order_date, count(*) AS n, sum(final_c) AS revenue_c FROM campaign_match
                   WHERE status = 'completed' GROUP BY campaign_id, order_date) m ON m.campaign_id = c.campaign_id""",
    "campaign_interval_join": "SELECT campaign_id, order_id, order_date, status FROM campaign_match",
    "campaign_roi": f"""
        SELECT campaign_id, campaign_name, channel, promo_code, start_date, end_date, {cents("budget_c")} AS budget,
               {cents("spend_c")} AS actual_spend, {big("n")} AS total_orders,
               {cents("coalesce(revenue_c, 0)")} AS total_revenue, {big("n")} AS promo_code_usage_count, roi, roas,
               cost_per_order,
               CASE WHEN roi > 200 THEN 'Excellent' WHEN roi > 100 THEN 'Good' WHEN roi > 0 THEN 'Average'
                    ELSE 'Poor' END AS performance_rating,
               CASE WHEN end_date >= {AS_OF} THEN 'Active' ELSE 'Completed' END AS campaign_status,
               {big("rank() OVER (ORDER BY roi DESC NULLS FIRST)")} AS campaign_rank FROM roi""",
    "campaign_rank": f"""
        SELECT campaign_id, roi, {big("rank() OVER (ORDER BY roi DESC NULLS FIRST)")} AS campaign_rank FROM roi""",
    "scd_product_initial": f"SELECT {PRICE_HISTORY_COLUMNS} FROM price_history_1",
    "scd_product_apply": f"SELECT {PRICE_HISTORY_COLUMNS} FROM price_history",
    "scd_customer_apply": f"""
        SELECT customer_id, full_name, email, loyalty_tier, {cents("spend_c")} AS total_lifetime_spend, {HISTORY_COLUMNS}
        FROM tier_history""",
    "scd_change_counts": f"""
        SELECT 'product' AS dimension, action, {big("count(*)")} AS n FROM price_actions WHERE action <> 'missing'
        GROUP BY action
        UNION ALL SELECT 'customer', action, {big("count(*)")} FROM tier_actions WHERE action <> 'missing'
        GROUP BY action""",
    "price_as_of": f"""
        SELECT {big("i.product_id")} AS product_id, i.inventory_date, {big("i.stock_quantity")} AS stock_quantity,
               {cents("h.price_c")} AS price, h.price_tier, h.valid_from, h.valid_to
        FROM bronze_inventory i LEFT JOIN price_history h
          ON h.product_id = i.product_id AND i.inventory_date BETWEEN h.valid_from AND h.valid_to""",
    "tier_as_of": """
        SELECT o.order_id, o.customer_id, o.order_date, h.loyalty_tier FROM clean_orders o LEFT JOIN tier_history h
          ON h.customer_id = o.customer_id AND o.order_date BETWEEN h.valid_from AND h.valid_to""",
    "daily_new_returning": f"""
        SELECT order_date AS revenue_date, {big("count(DISTINCT o.customer_id)")} AS unique_customers,
               {big("count(DISTINCT CASE WHEN f.first_date = o.order_date THEN o.customer_id END)")} AS new_customers,
               {big("count(DISTINCT CASE WHEN f.first_date < o.order_date THEN o.customer_id END)")} AS returning_customers
        FROM clean_orders o JOIN (SELECT customer_id, min(order_date) AS first_date FROM clean_orders GROUP BY customer_id) f
          ON f.customer_id = o.customer_id GROUP BY order_date""",
    "product_stock_stats": f"""
        SELECT {big("s.product_id")} AS product_id, {big(div_round("stock", "n"))} AS avg_stock_level,
               {big("empty_days")} AS stockout_days,
               {cents(div_round("100 * coalesce(u.units, 0) * n", "stock"))} AS inventory_turnover
        FROM (SELECT product_id, sum(stock_quantity) AS stock, count(*) AS n,
                     count(DISTINCT CASE WHEN stock_quantity = 0 THEN inventory_date END) AS empty_days
              FROM bronze_inventory WHERE stock_quantity >= 0 AND inventory_date >= CAST({AS_OF} - 30 AS DATE)
              GROUP BY product_id) s LEFT JOIN sales u ON u.product_id = s.product_id""",
    "repeat_purchase_rate": f"""
        SELECT {big("product_id")} AS product_id, {big("count(*)")} AS buyers,
               {pct("count(CASE WHEN n >= 2 THEN 1 END)", "count(*)")} AS repeat_purchase_rate
        FROM (SELECT product_id, customer_id, count(*) AS n FROM done GROUP BY product_id, customer_id)
        GROUP BY product_id""",
    "product_period_growth": f"""
        SELECT {big("product_id")} AS product_id, {cents("now_c")} AS current_revenue,
               {cents("then_c")} AS previous_revenue, {pct("now_c - then_c", "then_c")} AS revenue_growth_vs_previous
        FROM (SELECT product_id, sum(CASE WHEN order_date >= CAST({AS_OF} - 30 AS DATE) THEN final_c ELSE 0 END) AS now_c,
                     sum(CASE WHEN order_date < CAST({AS_OF} - 30 AS DATE) THEN final_c ELSE 0 END) AS then_c
              FROM done WHERE order_date >= CAST({AS_OF} - 60 AS DATE) GROUP BY product_id)""",
    "segment_advice": """
        SELECT customer_id, segment AS customer_segment, segment_description, recommended_action
        FROM rfm LEFT JOIN (VALUES
          ('Champions', 'High in all three scores', 'Offer early access and referral rewards'),
          ('Loyal Customers', 'Upper range in all three scores', 'Offer a loyalty upgrade'),
          ('Potential Loyalists', 'High recency score, low frequency score', 'Suggest a membership or a bundle'),
          ('At Risk', 'Low recency score, higher frequency score', 'Send a personal win-back offer'),
          ('Lost', 'Low recency and frequency scores', 'Run a low-cost reactivation campaign'),
          ('New (No Orders)', 'Signed up, no completed order', 'Send a first-purchase incentive'),
          ('Regular', 'Everyone else', 'Keep informed about new products'))
          AS t(name, segment_description, recommended_action) ON name = segment""",
    "next_purchase_days": f"""
        SELECT customer_id, CASE WHEN n > 1 THEN {big(f"greatest({div_round('span', 'n - 1')} - since, 0)")} END
                 AS predicted_next_purchase_days
        FROM (SELECT customer_id, count(DISTINCT order_date) AS n,
                     date_diff('day', min(order_date), max(order_date)) AS span,
                     date_diff('day', max(order_date), {AS_OF}) AS since
              FROM done GROUP BY customer_id)""",
    "inventory_cover": f"""
        SELECT {big("i.product_id")} AS product_id,
               {cents(div_round("100 * coalesce(s.units, 0)", "30"))} AS avg_daily_sales,
               {big("i.stock_quantity * 30 // s.units")} AS days_of_inventory_remaining,
               {cents(div_round("100 * coalesce(s.units, 0) * i.cost_c", "i.value_c"))} AS inventory_turnover_rate
        FROM clean_inventory i LEFT JOIN sales s ON s.product_id = i.product_id""",
    "reorder_advice": f"""
        SELECT {big("product_id")} AS product_id, stock_quantity <= reorder_point AS reorder_recommended,
               {big("CASE WHEN stock_quantity <= reorder_point THEN reorder_quantity ELSE 0 END")}
                 AS recommended_reorder_quantity FROM latest_stock""",
    "stock_change": f"""
        SELECT {big("l.product_id")} AS product_id,
               {big("l.stock_quantity - max_by(b.stock_quantity, CASE WHEN b.inventory_date <= CAST(l.inventory_date - 7 AS DATE) THEN b.inventory_date END)")}
                 AS stock_change_7days,
               {big("l.stock_quantity - max_by(b.stock_quantity, CASE WHEN b.inventory_date <= CAST(l.inventory_date - 30 AS DATE) THEN b.inventory_date END)")}
                 AS stock_change_30days
        FROM latest_stock l JOIN bronze_inventory b ON b.product_id = l.product_id AND b.stock_quantity >= 0
        GROUP BY l.product_id, l.stock_quantity, l.inventory_date""",
    "campaign_acquisition": f"""
        SELECT c.campaign_id, {cents("coalesce(m.profit_c, 0)")} AS total_profit,
               {big("coalesce(f.n, 0)")} AS new_customers_acquired,
               {cents(div_round("c.spend_c", "coalesce(f.n, 0)"))} AS cost_per_acquisition,
               {pct("m.n_done", "m.n")} AS conversion_rate
        FROM bronze_campaigns c
        LEFT JOIN (SELECT campaign_id, count(*) AS n, count(CASE WHEN status = 'completed' THEN 1 END) AS n_done,
                          sum(CASE WHEN status = 'completed' THEN final_c - i.cost_c * quantity END) AS profit_c
                   FROM campaign_match m LEFT JOIN clean_inventory i ON i.product_id = m.product_id
                   GROUP BY campaign_id) m ON m.campaign_id = c.campaign_id
        LEFT JOIN (SELECT k.campaign_id, count(*) AS n
                   FROM (SELECT * FROM done
                         QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY order_ts, order_id) = 1) o
                   JOIN bronze_campaigns k ON k.promo_code = o.promo_code
                     AND o.order_date BETWEEN k.start_date AND k.end_date
                   GROUP BY k.campaign_id) f ON f.campaign_id = c.campaign_id""",
    "revenue_yoy": f"""
        SELECT a.d AS revenue_date, {cents("a.revenue_c")} AS total_revenue, {cents("b.revenue_c")} AS revenue_last_year,
               {pct("a.revenue_c - b.revenue_c", "b.revenue_c")} AS revenue_yoy_pct
        FROM daily a LEFT JOIN daily b ON b.d = CAST(a.d - INTERVAL 1 YEAR AS DATE)""",
    "weekend_pattern": f"""
        SELECT isodow(order_date) >= 6 AS is_weekend, {big("count(*)")} AS completed_orders,
               {cents("sum(final_c)")} AS total_revenue, {cents(div_round("sum(final_c)", "count(*)"))} AS average_order_value,
               {big("count(DISTINCT order_date)")} AS n_days FROM done GROUP BY 1""",
    "mart_row_counts": f"""
        SELECT 'gold_daily_revenue' AS mart, {big("count(*)")} AS n, {big("count(*)")} AS n_known FROM daily
        UNION ALL SELECT 'gold_product_performance', {big("count(*)")},
          {big("count(CASE WHEN product_id IN (SELECT product_id FROM done) THEN 1 END)")} FROM clean_products
        UNION ALL SELECT 'gold_customer_segments', {big("count(*)")},
          {big("count(CASE WHEN last_date > first_date THEN 1 END)")} FROM customer_totals
        UNION ALL SELECT 'gold_inventory_health', {big("count(*)")},
          {big("count(CASE WHEN old.product_id IS NOT NULL THEN 1 END)")}
          FROM clean_inventory i JOIN clean_products p ON p.product_id = i.product_id
          LEFT JOIN bronze_inventory old ON old.product_id = i.product_id AND old.stock_quantity >= 0
            AND old.inventory_date <= CAST(i.inventory_date - 30 AS DATE)
        UNION ALL SELECT 'gold_campaign_roi', {big("count(*)")},
          {big("count(CASE WHEN campaign_id IN (SELECT campaign_id FROM campaign_match) THEN 1 END)")}
          FROM bronze_campaigns""",
    "orders_incremental": f"SELECT {BRONZE_ORDER_COLUMNS} FROM bronze_orders",
    "customers_incremental": f"""
        SELECT customer_id, first_name, last_name, email, signup_date, loyalty_tier,
               {cents("spend_c")} AS total_lifetime_spend, is_active FROM customers_merged""",
    "stream_daily_revenue": f"SELECT {DAILY_COLUMNS}, {GROWTH_COLUMNS} FROM growth",
}


def _needed(sql: str, found: list[str]) -> list[str]:
    """Definitions ``sql`` refers to, dependencies first."""
    for name, body in DEFINITIONS.items():
        if name not in found and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", sql):
            _needed(body, found)
            if name not in found:
                found.append(name)
    return found


# The daily run ends where the single steps do.
STATEMENTS |= {
    "refresh_silver_customers": STATEMENTS["clean_customers_upsert"],
    "refresh_silver_orders": STATEMENTS["silver_orders"],
    "refresh_price_history": STATEMENTS["scd_product_apply"],
    "refresh_counts": f"""
        SELECT run_id, name, {big("n")} AS n FROM (
          SELECT 'day-1' AS run_id, 'bronze_customers_inserted' AS name, count(*) AS n FROM bronze_customers
          UNION ALL SELECT 'day-2', 'bronze_customers_inserted', 0
          UNION ALL SELECT 'day-1', 'bronze_orders', count(*) FROM bronze_orders
          UNION ALL SELECT 'day-2', 'bronze_orders', 0
          UNION ALL SELECT d, 'silver_customers', n FROM (SELECT count(*) AS n FROM clean_customers), (SELECT unnest(['day-1', 'day-2']) AS d)
          UNION ALL SELECT d, 'silver_customers_rejected', n FROM
            (SELECT count(*) AS n FROM bronze_customers WHERE email IS NULL OR NOT regexp_matches(email, {EMAIL})),
            (SELECT unnest(['day-1', 'day-2']) AS d)
          UNION ALL SELECT d, 'silver_orders', n FROM (SELECT count(*) AS n FROM clean_orders), (SELECT unnest(['day-1', 'day-2']) AS d)
          UNION ALL SELECT 'day-1', 'silver_orders_inserted', count(*) FROM clean_orders
          UNION ALL SELECT 'day-2', 'silver_orders_inserted', 0
          UNION ALL SELECT 'day-1', 'silver_orders_rejected', count(*) FROM order_reasons WHERE reasons <> ''
          UNION ALL SELECT 'day-2', 'silver_orders_rejected', count(*) FROM order_reasons
            WHERE reasons IN ('customer_known', 'product_known', 'customer_known,product_known')
          UNION ALL SELECT 'day-1', 'product_price_history_new', count(*) FROM price_history_1
          UNION ALL SELECT 'day-1', 'product_price_history_updated', 0
          UNION ALL SELECT 'day-1', 'product_price_history_unchanged', 0
          UNION ALL SELECT 'day-2', 'product_price_history_' || a, (SELECT count(*) FROM price_actions WHERE action = a)
            FROM (SELECT unnest(['new', 'updated', 'unchanged']) AS a))""",
}


def oracle_sql() -> dict[str, str]:
    statements = {}
    for name, sql in STATEMENTS.items():
        needed = _needed(sql, [])
        shared = ", ".join(f"{n} AS ({DEFINITIONS[n]})" for n in needed)
        statements[name] = f"WITH {shared} {sql}" if needed else sql
    return statements

"""SQL oracles for DuckDB, composed from common table expressions.

`{name}` in a fragment or query refers to another fragment; what it needs is
placed in front. The SQL is the plain form of each operator (global windows,
cross joins, exact distinct counts), written independently of the Spark plans.
"""

from __future__ import annotations

import re

# Spelled out here, not taken from the package under test.
RAW_COLUMNS = {
    "users": ["id", "first_name", "last_name", "email", "age", "gender", "country", "state", "city", "created_at"],
    "orders": ["order_id", "user_id", "status", "created_at", "num_of_item"],
    "order_items": ["id", "order_id", "user_id", "product_id", "status", "created_at", "sale_price"],
    "products": ["id", "name", "category", "brand", "department", "cost", "retail_price"],
    "events": ["id", "user_id", "event_type", "created_at"],
    "inventory_items": ["id", "product_id", "created_at", "sold_at", "cost"],
    "distribution_centers": ["id", "name", "latitude", "longitude"],
}
OUTPUTS = ["customer_rfm", "customer_segments", "churn_predictions", "churn_feature_importance", "monthly_kpis", "cohort_retention", "category_analytics", "recommendations", "clv"]
CHURN_FEATURES = ["recency", "frequency", "monetary", "avg_order_value", "n_unique_products", "tenure_days", "is_male", "age"]
CLUSTER_LABELS = ["High Value", "Loyal Active", "Moderate Buyers", "Occasional Buyers", "Low Engagement", "Inactive"]

DONE = "('complete', 'shipped', 'processing')"
DAY = 86_400_000_000

FRAGMENTS: dict[str, str] = {
    # --- model tables -------------------------------------------------------
    "users": """
        SELECT c_custkey AS id, split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
               'c' || c_custkey || '@example.com' AS email, 18 + c_custkey % 60 AS age,
               CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
               n_name AS country, r_name AS state, c_mktsegment AS city, TIMESTAMP '1992-01-01' AS created_at
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
    "m_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS user_id,
               CASE o_orderstatus WHEN 'F' THEN 'complete' WHEN 'O' THEN 'processing' WHEN 'P' THEN 'cancelled' END AS status,
               o_orderdate AS created_at, 1 + o_orderkey % 7 AS num_of_item
        FROM orders""",
    "items": """
        SELECT l_orderkey * 8 + l_linenumber AS id, l_orderkey AS order_id, o_custkey AS user_id, l_partkey AS product_id,
               CASE l_returnflag WHEN 'A' THEN 'complete' WHEN 'N' THEN 'shipped' WHEN 'R' THEN 'returned' END AS status,
               o_orderdate AS created_at, l_extendedprice AS sale_price,
               CAST(round(l_extendedprice * 100) AS BIGINT) AS cents
        FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey""",
    "products": """
        SELECT p_partkey AS id, p_name AS name, p_type AS category, p_brand AS brand,
               CASE WHEN p_size <= 25 THEN 'Small' ELSE 'Large' END AS department,
               p_retailprice - 100 AS cost, p_retailprice AS retail_price
        FROM part""",
    "m_events": "SELECT event_id AS id, user_id, event_type, ts AS created_at FROM events",
    "inventory": """
        SELECT l_orderkey * 8 + l_linenumber AS id, l_partkey AS product_id, l_shipdate AS created_at,
               CASE WHEN l_linestatus = 'F' THEN l_shipdate END AS sold_at, l_extendedprice AS cost
        FROM lineitem""",
    "centers": """
        SELECT s_suppkey AS id, s_name AS name, CAST(s_suppkey % 180 - 90 AS DOUBLE) AS latitude,
               CAST(s_nationkey * 14 - 180 AS DOUBLE) AS longitude
        FROM supplier""",
    # --- dirty tables -------------------------------------------------------
    "d_users_once": """
        SELECT id AS _k, CASE WHEN id % 97 <> 0 THEN CAST(id AS VARCHAR) END AS id, first_name, last_name, email,
               CASE WHEN _k % 43 = 0 THEN 'n/a' WHEN _k % 47 = 0 THEN '130' WHEN _k % 53 = 0 THEN '-5'
                    ELSE CAST(age AS VARCHAR) END AS age,
               ' ' || gender || ' ' AS gender, '  ' || country AS country, state || '  ' AS state, city,
               CASE WHEN _k % 89 = 0 THEN 'not a date' ELSE strftime(created_at, '%Y-%m-%d %H:%M:%S') END AS created_at
        FROM {users}""",
    "d_users": """
        SELECT * FROM {d_users_once} UNION ALL
        SELECT * REPLACE (CASE WHEN _k % 142 = 0 THEN '99' ELSE age END AS age) FROM {d_users_once} WHERE _k % 71 = 0""",
    "d_orders_once": """
        SELECT order_id AS _k, CAST(order_id AS VARCHAR) AS order_id,
               CASE WHEN _k % 97 <> 0
                    THEN CAST(user_id + CASE WHEN _k % 67 = 0 THEN 1000000000 ELSE 0 END AS VARCHAR) END AS user_id,
               '  ' || upper(status) || ' ' AS status,
               CASE WHEN _k % 89 = 0 THEN 'not a date' ELSE strftime(created_at, '%Y-%m-%d %H:%M:%S') END AS created_at,
               CASE WHEN _k % 59 = 0 THEN '-1' ELSE CAST(num_of_item AS VARCHAR) END AS num_of_item
        FROM {m_orders}""",
    "d_orders": """
        SELECT * FROM {d_orders_once} UNION ALL
        SELECT * REPLACE (CASE WHEN _k % 142 = 0 THEN '9' ELSE num_of_item END AS num_of_item)
        FROM {d_orders_once} WHERE _k % 71 = 0""",
    "d_items": """
        SELECT CAST(id AS VARCHAR) AS id,
               CAST(order_id + CASE WHEN order_id % 73 = 0 THEN 1000000000 ELSE 0 END AS VARCHAR) AS order_id,
               CASE WHEN product_id % 97 <> 0
                    THEN CAST(user_id + CASE WHEN order_id % 61 = 0 THEN 1 ELSE 0 END AS VARCHAR) END AS user_id,
               CASE WHEN product_id % 101 <> 0 THEN CAST(product_id AS VARCHAR) END AS product_id,
               '  ' || upper(status) || ' ' AS status, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at,
               CASE WHEN product_id % 79 = 0 THEN 'abc'
                    WHEN product_id % 83 = 0 THEN CAST(-CAST(sale_price AS DECIMAL(18,2)) AS VARCHAR)
                    ELSE CAST(CAST(sale_price AS DECIMAL(18,2)) AS VARCHAR) END AS sale_price
        FROM {items}""",
    "d_products_once": """
        SELECT id AS _k, CASE WHEN id % 97 <> 0 THEN CAST(id AS VARCHAR) END AS id, ' ' || name || ' ' AS name,
               CASE WHEN _k % 103 <> 0 THEN ' ' || category END AS category, brand, department,
               CASE WHEN _k % 79 = 0 THEN 'abc' WHEN _k % 83 = 0 THEN CAST(-CAST(cost AS DECIMAL(18,2)) AS VARCHAR)
                    ELSE CAST(CAST(cost AS DECIMAL(18,2)) AS VARCHAR) END AS cost,
               CAST(CAST(retail_price AS DECIMAL(18,2)) AS VARCHAR) AS retail_price
        FROM {products}""",
    "d_products": """
        SELECT * FROM {d_products_once} UNION ALL
        SELECT * REPLACE (CASE WHEN _k % 142 = 0 THEN 'Brand#0' ELSE brand END AS brand)
        FROM {d_products_once} WHERE _k % 71 = 0""",
    "d_events": """
        SELECT CAST(id AS VARCHAR) AS id, CASE WHEN id % 97 <> 0 THEN CAST(user_id AS VARCHAR) END AS user_id,
               CASE WHEN id % 101 <> 0 THEN '  ' || upper(event_type) || ' ' END AS event_type,
               CASE WHEN id % 89 = 0 THEN 'not a date' ELSE strftime(created_at, '%Y-%m-%d %H:%M:%S') END AS created_at
        FROM {m_events}""",
    "d_inventory": """
        SELECT CAST(id AS VARCHAR) AS id, CAST(product_id AS VARCHAR) AS product_id,
               strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at,
               CASE WHEN product_id % 89 = 0 THEN 'not a date' ELSE strftime(sold_at, '%Y-%m-%d %H:%M:%S') END AS sold_at,
               CASE WHEN product_id % 79 = 0 THEN 'abc'
                    WHEN product_id % 83 = 0 THEN CAST(-CAST(cost AS DECIMAL(18,2)) AS VARCHAR)
                    ELSE CAST(CAST(cost AS DECIMAL(18,2)) AS VARCHAR) END AS cost
        FROM {inventory}""",
    "d_centers": """
        SELECT CAST(id AS VARCHAR) AS id, CASE WHEN id <> 0 THEN name END AS name, latitude, longitude
        FROM {centers}""",
    # --- cleaned tables -----------------------------------------------------
    "c_users": """
        SELECT * EXCLUDE (n) FROM (
            SELECT *, row_number() OVER (PARTITION BY id ORDER BY created_at NULLS LAST, age NULLS LAST) AS n FROM (
                SELECT TRY_CAST(id AS BIGINT) AS id, first_name, last_name, email,
                       CASE WHEN TRY_CAST(age AS DOUBLE) BETWEEN 0 AND 120 THEN TRY_CAST(age AS DOUBLE) END AS age,
                       trim(gender) AS gender, trim(country) AS country, trim(state) AS state, trim(city) AS city,
                       TRY_CAST(created_at AS TIMESTAMP) AS created_at
                FROM {d_users}) WHERE id IS NOT NULL) WHERE n = 1""",
    "c_orders": """
        SELECT * EXCLUDE (n) FROM (
            SELECT *, row_number() OVER (PARTITION BY order_id
                      ORDER BY created_at NULLS LAST, user_id, status, num_of_item NULLS LAST) AS n FROM (
                SELECT TRY_CAST(order_id AS BIGINT) AS order_id, TRY_CAST(user_id AS BIGINT) AS user_id,
                       lower(trim(status)) AS status, TRY_CAST(created_at AS TIMESTAMP) AS created_at,
                       TRY_CAST(num_of_item AS BIGINT) AS num_of_item
                FROM {d_orders}) WHERE order_id IS NOT NULL AND user_id IS NOT NULL)
        WHERE n = 1 AND created_at IS NOT NULL""",
    # --- purchases ----------------------------------------------------------
    "co": f"SELECT order_id, user_id, created_at FROM {{m_orders}} WHERE status IN {DONE}",
    "ci": f"""
        SELECT i.order_id, o.user_id, i.product_id, i.sale_price, i.cents, o.created_at
        FROM {{items}} i JOIN {{co}} o ON o.order_id = i.order_id WHERE i.status IN {DONE}""",
    "sold": f"SELECT * FROM {{items}} WHERE status IN {DONE}",
    "latest": "SELECT max(created_at) AS moment FROM {co}",
    "spent": "SELECT user_id, sum(cents) AS cents FROM {ci} GROUP BY user_id",
    "rfm": f"""
        SELECT o.user_id AS customer_id, max(o.created_at) AS last_purchase_date,
               (20 * (epoch_us((SELECT moment FROM {{latest}})) - epoch_us(max(o.created_at))) + {DAY}) // {2 * DAY}
                   / 10::DOUBLE AS recency,
               count(DISTINCT o.order_id) AS frequency,
               coalesce(max(s.cents), 0) / 100::DOUBLE AS monetary
        FROM {{co}} o LEFT JOIN {{spent}} s ON s.user_id = o.user_id GROUP BY o.user_id""",
    "ranked": """
        SELECT *, rank() OVER (ORDER BY recency DESC) + (count(*) OVER (PARTITION BY recency) - 1) / 2::DOUBLE AS r,
               rank() OVER (ORDER BY frequency) + (count(*) OVER (PARTITION BY frequency) - 1) / 2::DOUBLE AS f,
               rank() OVER (ORDER BY monetary) + (count(*) OVER (PARTITION BY monetary) - 1) / 2::DOUBLE AS m,
               count(*) OVER () AS n
        FROM {rfm}""",
    "scored": """
        SELECT customer_id, last_purchase_date, recency, frequency, monetary,
               CASE WHEN n <= 1 THEN 3 ELSE CAST(least(greatest(floor((r - 1) / (n - 1) * 4) + 1, 1), 5) AS BIGINT) END AS r_score,
               CASE WHEN n <= 1 THEN 3 ELSE CAST(least(greatest(floor((f - 1) / (n - 1) * 4) + 1, 1), 5) AS BIGINT) END AS f_score,
               CASE WHEN n <= 1 THEN 3 ELSE CAST(least(greatest(floor((m - 1) / (n - 1) * 4) + 1, 1), 5) AS BIGINT) END AS m_score
        FROM {ranked}""",
    "segmented": """
        SELECT *, r_score + f_score + m_score AS rfm_score,
               CASE WHEN r_score >= 4 AND frequency = 1 THEN 'New Customers'
                    WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champions'
                    WHEN r_score >= 3 AND f_score >= 4 THEN 'Loyal Customers'
                    WHEN r_score >= 4 AND f_score IN (2, 3) THEN 'Potential Loyalists'
                    WHEN r_score = 3 AND f_score <= 3 THEN 'Promising'
                    WHEN r_score = 2 AND f_score >= 3 THEN 'At Risk'
                    WHEN r_score = 1 AND f_score >= 4 THEN 'Cannot Lose Them'
                    WHEN r_score = 2 AND f_score <= 2 THEN 'Hibernating'
                    WHEN r_score = 1 AND f_score <= 2 THEN 'Lost Customers'
                    ELSE 'Other' END AS segment
        FROM {scored}""",
    "order_stats": f"""
        SELECT user_id AS customer_id, count(DISTINCT order_id) AS total_orders,
               min(created_at) AS first_order_date, max(created_at) AS last_order_date,
               (20 * (epoch_us((SELECT moment FROM {{latest}})) - epoch_us(max(created_at))) + {DAY}) // {2 * DAY}
                   / 10::DOUBLE AS recency,
               (20 * (epoch_us(max(created_at)) - epoch_us(min(created_at))) + {DAY}) // {2 * DAY}
                   / 10::DOUBLE AS tenure_days
        FROM {{co}} GROUP BY user_id""",
    "item_stats": """
        SELECT user_id AS customer_id, sum(cents) / 100::DOUBLE AS total_revenue,
               count(DISTINCT product_id) AS n_unique_products,
               (2 * sum(cents) + count(DISTINCT order_id)) // (2 * count(DISTINCT order_id)) / 100::DOUBLE AS avg_order_value
        FROM {ci} GROUP BY user_id""",
    "aggregates": """
        SELECT o.customer_id, total_orders, first_order_date, last_order_date,
               coalesce(total_revenue, 0) AS total_revenue, n_unique_products,
               coalesce(avg_order_value, 0) AS avg_order_value, recency, tenure_days
        FROM {order_stats} o LEFT JOIN {item_stats} i ON i.customer_id = o.customer_id""",
    "rated": """
        SELECT *, total_orders / greatest(tenure_days / 365::DOUBLE, 0.0833::DOUBLE) AS raw_frequency FROM {aggregates}""",
    "typical": """
        SELECT (min(raw_frequency) + max(raw_frequency)) / 2 AS moment FROM (
            SELECT raw_frequency, row_number() OVER (ORDER BY raw_frequency) AS n, count(*) OVER () AS total FROM {rated})
        WHERE n IN ((total + 1) // 2, (total + 2) // 2)""",
    "replaced": """
        SELECT * EXCLUDE (raw_frequency),
               CASE WHEN tenure_days < 30 THEN (SELECT moment FROM {typical}) ELSE raw_frequency END AS annual_frequency
        FROM {rated}""",
    "clv": """
        SELECT *, floor(avg_order_value * annual_frequency * 2::DOUBLE * 100 + 0.5::DOUBLE) / 100 AS estimated_clv
        FROM {replaced}""",
    "people": """
        SELECT id AS customer_id, first_name, last_name, email, age, gender, country, state, city, created_at FROM {users}""",
    "profile": """
        SELECT c.* EXCLUDE (recency), p.* EXCLUDE (customer_id),
               s.segment, s.r_score, s.f_score, s.m_score, s.rfm_score, s.recency, s.frequency, s.monetary
        FROM {clv} c LEFT JOIN {people} p ON p.customer_id = c.customer_id
        LEFT JOIN {segmented} s ON s.customer_id = c.customer_id""",
    # --- churn --------------------------------------------------------------
    "bounds": """
        SELECT max(created_at) - INTERVAL 90 DAY AS cutoff, max(created_at) AS ends FROM {co}""",
    "history": "SELECT * FROM {co} WHERE created_at < (SELECT cutoff FROM {bounds})",
    "future": """
        SELECT DISTINCT user_id FROM {co}
        WHERE created_at BETWEEN (SELECT cutoff FROM {bounds}) AND (SELECT ends FROM {bounds})""",
    "history_items": """
        SELECT user_id, sum(cents) / 100::DOUBLE AS monetary, count(DISTINCT order_id) AS paid,
               count(DISTINCT product_id) AS n_unique_products
        FROM {ci} WHERE created_at < (SELECT cutoff FROM {bounds}) GROUP BY user_id""",
    "churn": f"""
        SELECT h.user_id, frequency, last_order_date, first_order_date, coalesce(monetary, 0) AS monetary,
               coalesce(monetary / paid, 0) AS avg_order_value, coalesce(n_unique_products, 0) AS n_unique_products,
               (epoch_us((SELECT cutoff FROM {{bounds}})) - epoch_us(last_order_date)) / {DAY}::DOUBLE AS recency,
               (epoch_us(last_order_date) - epoch_us(first_order_date)) / {DAY}::DOUBLE AS tenure_days,
               CAST(coalesce(u.age, 0) AS DOUBLE) AS age, u.gender, u.country,
               CASE WHEN lower(u.gender) = 'm' THEN 1 ELSE 0 END AS is_male,
               CASE WHEN f.user_id IS NULL THEN 1 ELSE 0 END AS churned
        FROM (SELECT user_id, count(DISTINCT order_id) AS frequency, max(created_at) AS last_order_date,
                     min(created_at) AS first_order_date FROM {{history}} GROUP BY user_id) h
        LEFT JOIN {{history_items}} i ON i.user_id = h.user_id
        LEFT JOIN {{users}} u ON u.id = h.user_id
        LEFT JOIN {{future}} f ON f.user_id = h.user_id""",
    "scores": """
        SELECT customer_id, p AS churn_probability, CASE WHEN p >= 0.5 THEN 1 ELSE 0 END::BIGINT AS churn_prediction,
               CASE WHEN p < 0.3::DOUBLE THEN 'Low Risk' WHEN p < 0.6::DOUBLE THEN 'Medium Risk' ELSE 'High Risk' END AS risk_level
        FROM (SELECT customer_id, recency / (recency + 90::DOUBLE) AS p FROM {rfm})""",
    # --- recommendations ----------------------------------------------------
    "bought": "SELECT user_id AS customer_id, product_id FROM {sold}",
    "seg_pop": """
        SELECT s.segment, b.product_id, count(*) AS purchase_count
        FROM {bought} b JOIN {segmented} s ON s.customer_id = b.customer_id GROUP BY ALL""",
    "all_pop": "SELECT product_id, count(*) AS purchase_count FROM {bought} GROUP BY ALL",
    "seg_place": """
        SELECT *, row_number() OVER (PARTITION BY segment ORDER BY purchase_count DESC, product_id) AS place FROM {seg_pop}""",
    "all_pool": "SELECT * FROM {all_pop} ORDER BY purchase_count DESC, product_id LIMIT 50",
    **{
        f"{name}{suffix}": sql.replace("@", suffix).replace("#", str(pool))
        for suffix, pool in (("_std", 50), ("_short", 5))
        for name, sql in {
            "primary": """
                SELECT customer_id, product_id, purchase_count, place AS rank, segment FROM (
                    SELECT s.customer_id, c.product_id, c.purchase_count, s.segment,
                           row_number() OVER (PARTITION BY s.customer_id ORDER BY c.purchase_count DESC, c.product_id) AS place
                    FROM {segmented} s JOIN {seg_place} c ON c.segment = s.segment AND c.place <= #
                    ANTI JOIN {bought} b ON b.customer_id = s.customer_id AND b.product_id = c.product_id)
                WHERE place <= 5""",
            "have": """
                SELECT s.customer_id, s.segment, count(p.product_id) AS existing
                FROM {segmented} s LEFT JOIN {primary@} p ON p.customer_id = s.customer_id GROUP BY ALL""",
            "backfill": """
                SELECT customer_id, product_id, purchase_count, existing + seq AS rank, segment FROM (
                    SELECT h.customer_id, h.segment, h.existing, c.product_id, c.purchase_count,
                           row_number() OVER (PARTITION BY h.customer_id ORDER BY c.purchase_count DESC, c.product_id) AS seq
                    FROM {have@} h CROSS JOIN {all_pool} c
                    ANTI JOIN {bought} b ON b.customer_id = h.customer_id AND b.product_id = c.product_id
                    ANTI JOIN {primary@} p ON p.customer_id = h.customer_id AND p.product_id = c.product_id
                    WHERE h.existing < 5)
                WHERE existing + seq <= 5""",
            "chosen": """
                SELECT *, 'segment' AS source FROM {primary@} UNION ALL SELECT *, 'overall' AS source FROM {backfill@}""",
            "recs": """
                SELECT c.customer_id, c.product_id, p.name AS product_name, p.category, p.brand,
                       (20000 * c.purchase_count + max(c.purchase_count) OVER w)
                           // (2 * max(c.purchase_count) OVER w) / 10000::DOUBLE AS affinity_score,
                       CASE WHEN c.source = 'overall' THEN 'Trending product: popular across all customers in our platform.'
                            WHEN k.customer_id IS NOT NULL THEN 'Recommended because you''ve purchased from ''' || p.category
                                || ''' before, and this product is popular among ' || c.segment || ' customers like you.'
                            ELSE 'Recommended because customers in the ''' || c.segment
                                || ''' segment frequently purchase from the ''' || p.category || ''' category.' END AS explanation,
                       c.rank
                FROM {chosen@} c JOIN {products} p ON p.id = c.product_id
                LEFT JOIN {bought_categories} k ON k.customer_id = c.customer_id AND k.category = p.category
                WINDOW w AS (PARTITION BY c.customer_id)""",
        }.items()
    },
    "bought_categories": """
        SELECT DISTINCT b.customer_id, p.category FROM {bought} b JOIN {products} p ON p.id = b.product_id""",
    # --- KPIs ---------------------------------------------------------------
    "paid_orders": f"""
        SELECT o.order_id, o.user_id, date_trunc('month', o.created_at) AS month, coalesce(sum(i.cents), 0) AS cents
        FROM {{co}} o LEFT JOIN (SELECT * FROM {{items}} WHERE status IN {DONE}) i ON i.order_id = o.order_id GROUP BY ALL""",
    "first_months": "SELECT user_id, min(month) AS first_month FROM {paid_orders} GROUP BY user_id",
    "kpis": """
        SELECT strftime(month, '%Y-%m') AS year_month, sum(cents) / 100::DOUBLE AS total_revenue,
               count(DISTINCT order_id) AS total_orders, count(DISTINCT p.user_id) AS unique_customers,
               (2 * sum(cents) + count(DISTINCT order_id)) // (2 * count(DISTINCT order_id)) / 100::DOUBLE AS avg_order_value,
               count(DISTINCT CASE WHEN month = first_month THEN p.user_id END) AS new_customers,
               count(DISTINCT CASE WHEN month <> first_month THEN p.user_id END) AS repeat_customers,
               (20000 * count(DISTINCT CASE WHEN month <> first_month THEN p.user_id END) + count(DISTINCT p.user_id))
                   // (2 * count(DISTINCT p.user_id)) / 10000::DOUBLE AS repeat_customer_rate
        FROM {paid_orders} p JOIN {first_months} f ON f.user_id = p.user_id GROUP BY month""",
    "cohorts": """
        SELECT strftime(first_month, '%Y-%m') AS cohort_month, date_diff('month', first_month, month) AS months_since,
               count(DISTINCT p.user_id) AS active_customers, any_value(size) AS cohort_size,
               (20000 * count(DISTINCT p.user_id) + any_value(size)) // (2 * any_value(size)) / 10000::DOUBLE AS retention_rate
        FROM {paid_orders} p JOIN {first_months} f ON f.user_id = p.user_id
        JOIN (SELECT first_month AS fm, count(*) AS size FROM {first_months} GROUP BY 1) s ON s.fm = f.first_month
        GROUP BY first_month, month""",
    "categories": """
        SELECT p.category, sum(s.cents) / 100::DOUBLE AS total_revenue, count(DISTINCT s.order_id) AS order_count,
               count(DISTINCT s.user_id) AS unique_customers,
               (2 * sum(s.cents) + count(*)) // (2 * count(*)) / 100::DOUBLE AS avg_selling_price,
               count(DISTINCT s.product_id) AS product_count
        FROM {sold} s JOIN {products} p ON p.id = s.product_id WHERE p.category IS NOT NULL GROUP BY p.category""",
    # --- reports ------------------------------------------------------------
    "filtered": """
        SELECT * FROM {profile}
        WHERE segment IN ('Champions', 'Loyal Customers', 'At Risk', 'Hibernating') AND gender = 'M'
          AND recency BETWEEN 0 AND 900 AND frequency BETWEEN 2 AND 12 AND monetary BETWEEN 1000 AND 2000000""",
}

DIRTY = {
    "users": "d_users",
    "orders": "d_orders",
    "order_items": "d_items",
    "products": "d_products",
    "events": "d_events",
    "inventory_items": "d_inventory",
    "distribution_centers": "d_centers",
}
CLEAN = {
    "users": "users",
    "orders": "m_orders",
    "order_items": "items",
    "products": "products",
    "events": "m_events",
    "inventory_items": "inventory",
    "distribution_centers": "centers",
}
KEYS = {t: "order_id" if t == "orders" else "id" for t in DIRTY}
NOT_NULL = {
    "users": ["id", "created_at"],
    "orders": ["order_id", "user_id", "status", "created_at"],
    "order_items": ["id", "order_id", "user_id", "product_id", "status", "sale_price"],
    "products": ["id", "name", "category"],
    "events": ["id", "user_id", "event_type", "created_at"],
    "inventory_items": ["id", "product_id"],
    "distribution_centers": ["id", "name"],
}
DATES = {
    "users": ["created_at"],
    "orders": ["created_at"],
    "order_items": ["created_at"],
    "events": ["created_at"],
    "inventory_items": ["created_at", "sold_at"],
}
NUMBERS = {
    "orders": ["num_of_item"],
    "order_items": ["sale_price"],
    "products": ["cost", "retail_price"],
    "inventory_items": ["cost"],
}


def _check(table: str, check: str, column: str | None, severity: str, bad: str, source: str) -> str:
    label = f"'{column}'" if column else "NULL"
    return f"""SELECT '{table}' AS table_name, '{check}' AS check_name, {label}::VARCHAR AS column_name,
        '{severity}' AS severity, CAST(bad AS BIGINT) AS n_bad,
        CASE WHEN n > 0 THEN ((2000 * CAST(bad AS BIGINT) + n) // (2 * n)) / 1000::DOUBLE * 100 END AS pct
        FROM (SELECT {bad} AS bad, count(*) AS n FROM {source})"""


def _per_column(check: str, columns: dict[str, list[str]], condition: str, tables: list[str]) -> list[str]:
    return [
        _check(t, check, c, "warning", f"count(*) FILTER (WHERE {condition.format(c=c)})", "{" + DIRTY[t] + "}")
        for t in tables
        for c in columns.get(t, [])
    ]


def _nulls(tables: list[str]) -> list[str]:
    return _per_column("null_key", NOT_NULL, "{c} IS NULL", tables)


def _bad_dates(tables: list[str]) -> list[str]:
    return _per_column("bad_date", DATES, "{c} IS NOT NULL AND TRY_CAST({c} AS TIMESTAMP) IS NULL", tables)


def _negatives(tables: list[str]) -> list[str]:
    return _per_column("negative_value", NUMBERS, "TRY_CAST({c} AS DOUBLE) < 0", tables)


def _duplicates(tables: list[str]) -> list[str]:
    return [
        _check(
            t, "duplicate_key", KEYS[t], "warning",
            f"count(*) - count(DISTINCT {KEYS[t]}) - CASE WHEN count(*) > count({KEYS[t]}) THEN 1 ELSE 0 END",
            "{" + DIRTY[t] + "}",
        )
        for t in tables
    ]


def _conflicts(tables: list[str]) -> list[str]:
    checks = []
    for t in tables:
        others = ", ".join(f"coalesce(CAST({c} AS VARCHAR), chr(1))" for c in RAW_COLUMNS[t] if c != KEYS[t])
        bad = f"""(SELECT count(*) FROM (SELECT {KEYS[t]} FROM {{{DIRTY[t]}}} GROUP BY {KEYS[t]}
                   HAVING count(DISTINCT concat_ws(chr(2), {others})) > 1))"""
        checks.append(_check(t, "conflicting_key", KEYS[t], "issue", bad, "{" + DIRTY[t] + "}"))
    return checks


def _empty(tables: list[str]) -> list[str]:
    return [
        _check(t, "empty_table", None, "issue", "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END", "{" + DIRTY[t] + "}")
        for t in tables
    ]


def _orphans() -> list[str]:
    links = [
        ("order_items", "order_id", "orders", "order_id"),
        ("order_items", "product_id", "products", "id"),
        ("orders", "user_id", "users", "id"),
    ]
    return [
        _check(
            "references", "orphan_key", f"{c}.{cc}", "issue",
            f"count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM {{{DIRTY[p]}}} p WHERE p.{pc} IS NOT DISTINCT FROM ch.{cc}))",
            f"{{{DIRTY[c]}}} ch",
        )
        for c, cc, p, pc in links
    ]


def _mismatch() -> str:
    return _check(
        "references", "owner_mismatch", "order_items.user_id", "issue",
        "count(*) FILTER (WHERE o.owner <> i.user_id)",
        """{d_items} i LEFT JOIN (SELECT order_id, user_id AS owner FROM (
               SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY created_at NULLS LAST, user_id NULLS LAST) AS n
               FROM {d_orders}) WHERE n = 1) o ON o.order_id = i.order_id""",
    )


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


ALL = list(DIRTY)
REPORT = _union(
    _empty(ALL) + _nulls(ALL) + _bad_dates(ALL) + _negatives(ALL) + _duplicates(ALL) + _conflicts(ALL)
    + _orphans() + [_mismatch()]
)


def _counts(tables: dict[str, str], extra: str = "") -> str:
    return _union([f"SELECT '{t}' AS table_name, count(*) AS row_count{extra} FROM {{{f}}}" for t, f in tables.items()])


def _inventory() -> str:
    csv = ("users", "events")
    return _union(
        [
            f"SELECT '{t}' AS table_name, '{'csv' if t in csv else 'parquet'}' AS format, count(*) AS row_count,"
            f" true AS complete FROM {{{f}}}"
            for t, f in CLEAN.items()
        ]
    )


def _audit() -> str:
    zero = "CAST(0 AS BIGINT)"

    def row(t: str, null: str, dup: str, price: str, date: str, out: str, source: str) -> str:
        return (
            f"SELECT '{t}' AS table_name, count(*) AS rows_in, {null} AS dropped_null_key, {dup} AS dropped_duplicate,"
            f" {price} AS dropped_bad_price, {date} AS dropped_bad_date, {out} AS rows_out FROM {source}"
        )

    good = "coalesce(TRY_CAST(sale_price AS DOUBLE) >= 0, false)"
    ids = "order_id IS NOT NULL AND user_id IS NOT NULL AND product_id IS NOT NULL"
    return _union(
        [
            row(t, "count(*) - count(id)", "count(id) - count(DISTINCT id)", zero, zero, "count(DISTINCT id)", f"{{{DIRTY[t]}}}")
            for t in ("users", "products")
        ]
        + [
            row(
                "orders",
                "count(*) - count(k)",
                "count(k) - count(DISTINCT k)",
                zero,
                "count(DISTINCT k) - (SELECT count(*) FROM {c_orders})",
                "(SELECT count(*) FROM {c_orders})",
                "(SELECT CASE WHEN user_id IS NOT NULL THEN order_id END AS k FROM {d_orders})",
            ),
            row(
                "order_items",
                f"count(*) FILTER (WHERE {good} AND NOT ({ids}))",
                zero,
                f"count(*) FILTER (WHERE NOT {good})",
                zero,
                f"count(*) FILTER (WHERE {good} AND {ids})",
                "{d_items}",
            ),
            row("events", "count(*) - count(user_id)", zero, zero, zero, "count(user_id)", "{d_events}"),
            row("inventory_items", zero, zero, zero, zero, "count(*)", "{d_inventory}"),
            row("distribution_centers", zero, zero, zero, zero, "count(*)", "{d_centers}"),
        ]
    )


def _summary() -> str:
    sizes = _union(
        [
            f"SELECT '{t}' AS table_name, count(*) AS row_count, CAST({len(RAW_COLUMNS[t])} AS BIGINT) AS column_count FROM {{{f}}}"
            for t, f in DIRTY.items()
        ]
    )
    return f"""
        SELECT r.table_name, coalesce(any_value(row_count), 0) AS row_count, coalesce(any_value(column_count), 0) AS column_count,
               count(*) FILTER (WHERE n_bad > 0 AND severity = 'issue') AS issues,
               count(*) FILTER (WHERE n_bad > 0 AND severity = 'warning'
                   AND NOT (check_name = 'duplicate_key' AND r.table_name IN (
                       SELECT table_name FROM ({REPORT}) WHERE check_name = 'conflicting_key' AND n_bad > 0))) AS warnings,
               CASE WHEN count(*) FILTER (WHERE n_bad > 0 AND severity = 'issue') = 0 THEN 'PASS' ELSE 'FAIL' END AS status
        FROM ({REPORT}) r LEFT JOIN ({sizes}) s ON s.table_name = r.table_name GROUP BY r.table_name"""


def _contract_status() -> str:
    known = {
        "monthly_kpis": ("ready", "(SELECT count(*) FROM {kpis})"),
        "category_analytics": ("ready", "(SELECT count(*) FROM {categories})"),
        "customer_rfm": ("schema_mismatch", "(SELECT count(*) FROM {rfm})"),
        "clv": ("empty", "0"),
    }
    return _union(
        [
            f"SELECT '{name}' AS output, '{known.get(name, ('missing', 'NULL'))[0]}' AS status,"
            f" CAST({known.get(name, ('missing', 'NULL'))[1]} AS BIGINT) AS row_count"
            for name in OUTPUTS
        ]
    )


SEGMENT_TOTALS = "sum(CAST(round(monetary * 100) AS BIGINT))"

ORACLES: dict[str, str] = {
    "src_parquet_scan": "SELECT * FROM {products}",
    "src_csv_scan": "SELECT order_id, user_id, status, created_at FROM {m_orders}",
    "src_load_all": _counts(CLEAN),
    "src_input_inventory": _inventory(),
    "cat_register": "SELECT status, count(*) AS orders FROM {m_orders} WHERE created_at >= TIMESTAMP '1998-01-01' GROUP BY status",
    "cat_row_counts": _counts(CLEAN),
    "src_malformed_records": """
        SELECT 'orders' AS table_name, 'malformed_record' AS check_name, NULL::VARCHAR AS column_name, 'warning' AS severity,
               n_bad, round(n_bad * 1000 / n_rows) / 1000 * 100 AS pct
        FROM (SELECT count(*) FILTER (order_id % 50 = 0 OR order_id % 70 = 0) AS n_bad, count(*) AS n_rows FROM {m_orders})""",
    "sink_parquet_roundtrip": "SELECT * FROM {users}",
    "sink_contract_status": _contract_status(),
    "sink_regenerate": """SELECT 'monthly_kpis' AS output, 'ready' AS status, count(*) AS row_count FROM {kpis}
        UNION ALL SELECT 'category_analytics', 'ready', count(*) FROM {categories}""",
    "sink_csv_export": """SELECT customer_id, first_name, last_name, segment, monetary, rfm_score, country, gender FROM {filtered}""",
    "dq_report": REPORT,
    "dq_required_columns": """SELECT 'users' AS table_name, 'email' AS column_name, count(*) AS row_count FROM {d_users}
        UNION ALL SELECT 'products', unnest(['brand', 'cost']), row_count FROM (SELECT count(*) AS row_count FROM {d_products})""",
    "dq_row_counts": _counts(DIRTY, ", count(*) = 0 AS is_empty"),
    "dq_duplicate_keys": _union(_duplicates(ALL)),
    "dq_conflicting_keys": _union(_conflicts(ALL)),
    "dq_null_rates": _union(_nulls(ALL)),
    "dq_bad_dates": _union(_bad_dates(ALL)),
    "dq_negative_values": _union(_negatives(ALL)),
    "dq_orphan_keys": _union(_orphans()),
    "dq_missing_tables": _union(
        _empty([t for t in ALL if t not in ("events", "inventory_items")]) + _orphans()
        + [f"SELECT '{t}', 'missing_table', NULL, 'issue', 1::BIGINT, NULL::DOUBLE" for t in ("events", "inventory_items")]
    ),
    "dq_owner_mismatch": _mismatch(),
    "dq_summary": _summary(),
    "clean_users": "SELECT * EXCLUDE (_k) FROM (SELECT *, NULL AS _k FROM {c_users})",
    "clean_orders": "SELECT * FROM {c_orders}",
    "clean_order_items": """
        SELECT * FROM (
            SELECT TRY_CAST(id AS BIGINT) AS id, TRY_CAST(order_id AS BIGINT) AS order_id, TRY_CAST(user_id AS BIGINT) AS user_id,
                   TRY_CAST(product_id AS BIGINT) AS product_id, lower(trim(status)) AS status,
                   TRY_CAST(created_at AS TIMESTAMP) AS created_at, TRY_CAST(sale_price AS DOUBLE) AS sale_price
            FROM {d_items})
        WHERE sale_price >= 0 AND order_id IS NOT NULL AND user_id IS NOT NULL AND product_id IS NOT NULL""",
    "clean_products": """
        SELECT * EXCLUDE (n) FROM (
            SELECT *, row_number() OVER (PARTITION BY id ORDER BY brand) AS n FROM (
                SELECT TRY_CAST(id AS BIGINT) AS id, trim(name) AS name, trim(category) AS category, trim(brand) AS brand,
                       trim(department) AS department, TRY_CAST(cost AS DOUBLE) AS cost,
                       TRY_CAST(retail_price AS DOUBLE) AS retail_price
                FROM {d_products}) WHERE id IS NOT NULL) WHERE n = 1""",
    "clean_events": """
        SELECT TRY_CAST(id AS BIGINT) AS id, TRY_CAST(user_id AS BIGINT) AS user_id, lower(trim(event_type)) AS event_type,
               TRY_CAST(created_at AS TIMESTAMP) AS created_at
        FROM {d_events} WHERE user_id IS NOT NULL""",
    "clean_inventory": """
        SELECT TRY_CAST(id AS BIGINT) AS id, TRY_CAST(product_id AS BIGINT) AS product_id,
               TRY_CAST(created_at AS TIMESTAMP) AS created_at, TRY_CAST(sold_at AS TIMESTAMP) AS sold_at,
               TRY_CAST(cost AS DOUBLE) AS cost
        FROM {d_inventory}""",
    "clean_centers": "SELECT TRY_CAST(id AS BIGINT) AS id, name, latitude, longitude FROM {d_centers}",
    "clean_dedupe_first": """
        SELECT order_id, id, product_id, sale_price FROM (
            SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY sale_price, product_id, id) AS n FROM {items})
        WHERE n = 1""",
    "clean_audit": _audit(),
    "feat_completed_items": "SELECT order_id, user_id, product_id, sale_price FROM {ci}",
    "rfm_features": "SELECT * FROM {rfm}",
    "sql_rfm": """
        SELECT customer_id, last_purchase_date,
               date_diff('day', last_purchase_date, (SELECT moment FROM {latest})) AS recency, frequency, monetary
        FROM {rfm}""",
    "rfm_avg_rank": "SELECT customer_id, r AS recency_rank, f AS frequency_rank, m AS monetary_rank FROM {ranked}",
    "rfm_scores": "SELECT * EXCLUDE (segment) FROM {segmented}",
    "rfm_segments": "SELECT * FROM {segmented}",
    "segment_counts": "SELECT segment, count(*) AS customers FROM {segmented} GROUP BY segment",
    "customer_aggregates": """
        SELECT a.*, p.* EXCLUDE (customer_id) FROM {aggregates} a LEFT JOIN {people} p ON p.customer_id = a.customer_id""",
    "customer_clv": "SELECT * FROM {clv}",
    "customer_full": "SELECT * FROM {profile}",
    "clv_output": "SELECT customer_id, estimated_clv, annual_frequency FROM {clv}",
    "churn_windows": """
        SELECT CASE WHEN created_at < cutoff THEN 'history' WHEN created_at <= ends THEN 'label' END AS period,
               count(*) AS orders, count(DISTINCT user_id) AS customers,
               min(created_at) AS first_order, max(created_at) AS last_order
        FROM {co}, {bounds} GROUP BY 1""",
    "churn_features": "SELECT * FROM {churn}",
    "churn_rate": """
        SELECT count(*) AS customers, CAST(sum(churned) AS BIGINT) AS churned,
               CAST(sum(1 - churned) AS BIGINT) AS active,
               (20000 * CAST(sum(churned) AS BIGINT) + count(*)) // (2 * count(*)) / 10000::DOUBLE AS churn_rate
        FROM {churn}""",
    "churn_split_counts": """
        SELECT part, churned, CASE WHEN part = 'test' THEN test ELSE n - test END AS customers
        FROM (SELECT CAST(churned AS BIGINT) AS churned, count(*) AS n,
                     CAST(floor(count(*) * 0.2::DOUBLE + 0.5::DOUBLE) AS BIGINT) AS test
              FROM {churn} GROUP BY churned), (VALUES ('train'), ('test')) AS parts(part)""",
    "churn_risk_bands": "SELECT * FROM {scores}",
    "churn_risk_counts": "SELECT risk_level, count(*) AS customers FROM {scores} GROUP BY risk_level",
    "rec_purchases": "SELECT * FROM {bought}",
    "rec_segment_popularity": "SELECT * FROM {seg_pop}",
    "rec_overall_popularity": "SELECT * FROM {all_pop}",
    "rec_candidate_pool": """
        SELECT segment, product_id, purchase_count FROM {seg_place} WHERE place <= 50
        UNION ALL SELECT NULL, product_id, purchase_count FROM {all_pool}""",
    "rec_primary": "SELECT customer_id, product_id, purchase_count, rank FROM {primary_std}",
    "rec_backfill": "SELECT customer_id, product_id, purchase_count, rank FROM {backfill_short}",
    "rec_explanations": """
        SELECT 'default' AS pool, customer_id, product_id, rank, explanation FROM {recs_std}
        UNION ALL SELECT 'small', customer_id, product_id, rank, explanation FROM {recs_short}""",
    "recommendations": "SELECT * FROM {recs_std}",
    "rec_for_customer": "SELECT * FROM {recs_std} WHERE customer_id = 42 ORDER BY rank LIMIT 3",
    "kpi_monthly": "SELECT * FROM {kpis}",
    "sql_monthly_kpis": "SELECT * FROM {kpis}",
    "sink_rebuild_later": "SELECT * FROM {kpis}",
    "cohort_long": "SELECT * FROM {cohorts}",
    "sql_cohort": "SELECT * FROM {cohorts}",
    "cohort_wide": """
        SELECT * FROM (PIVOT (SELECT cohort_month, months_since, retention_rate FROM {cohorts})
                       ON months_since IN (""" + ", ".join(map(str, range(79))) + """)
                       USING first(retention_rate) GROUP BY cohort_month)""",
    "cohort_wide_cells": """
        SELECT m.cohort_month, o.months_since, c.retention_rate
        FROM (SELECT DISTINCT cohort_month FROM {cohorts}) m CROSS JOIN (SELECT DISTINCT months_since FROM {cohorts}) o
        LEFT JOIN {cohorts} c ON c.cohort_month = m.cohort_month AND c.months_since = o.months_since""",
    "category_analytics": "SELECT * FROM {categories}",
    "sql_category_analytics": "SELECT * FROM {categories}",
    "product_top_n": """
        SELECT s.product_id, p.name, p.category, p.brand, sum(cents) / 100::DOUBLE AS total_revenue,
               count(DISTINCT order_id) AS order_count, count(DISTINCT user_id) AS unique_customers,
               (2 * sum(cents) + count(*)) // (2 * count(*)) / 100::DOUBLE AS avg_selling_price
        FROM {sold} s LEFT JOIN {products} p ON p.id = s.product_id GROUP BY ALL
        ORDER BY sum(cents) DESC, s.product_id LIMIT 50""",
    "dash_overview": """
        SELECT (SELECT count(*) FROM {segmented}) AS total_customers,
               sum(cents) / 100::DOUBLE AS total_revenue, CAST(sum(total_orders) AS BIGINT) AS total_orders,
               (2 * sum(cents) + sum(total_orders)) // (2 * sum(total_orders)) / 100::DOUBLE AS avg_order_value,
               (SELECT CAST(sum(CAST(round(repeat_customer_rate * 10000) AS BIGINT)) AS DOUBLE) / count(*) / 100 FROM {kpis})
                   AS repeat_rate_pct,
               (SELECT count(*) FROM {scores} WHERE risk_level = 'High Risk') AS high_risk_customers
        FROM (SELECT total_orders, CAST(round(total_revenue * 100) AS BIGINT) AS cents FROM {profile})""",
    "dash_monthly_series": "SELECT year_month, total_revenue, total_orders, new_customers, repeat_customers FROM {kpis}",
    "dash_segment_base": """
        SELECT customer_id, segment, recency, frequency, total_revenue AS monetary, country FROM {profile}""",
    "dash_filter_options": _union(
        [
            f"SELECT DISTINCT '{c}' AS field, {c} AS option, CAST(NULL AS DOUBLE) AS low, CAST(NULL AS DOUBLE) AS high FROM {{profile}}"
            for c in ("segment", "country", "gender")
        ]
        + [
            f"SELECT '{c}', NULL, CAST(min({c}) AS DOUBLE), CAST(max({c}) AS DOUBLE) FROM {{profile}}"
            for c in ("recency", "frequency", "monetary")
        ]
    ),
    "dash_filtered_customers": """
        SELECT customer_id, last_name, segment, recency, frequency, monetary, gender FROM {filtered}
        WHERE contains(CAST(customer_id AS VARCHAR), '00000012') OR contains(lower(first_name), '00000012')
           OR contains(lower(last_name), '00000012')""",
    "dash_filter_summary": f"""
        SELECT n AS customers, ((2000 * n + all_n) // (2 * all_n)) / 10::DOUBLE AS customer_share_pct,
               c / 100::DOUBLE AS revenue, ((2000 * c + all_c) // (2 * all_c)) / 10::DOUBLE AS revenue_share_pct,
               ((2 * c + n) // (2 * n)) / 100::DOUBLE AS avg_spend, ((20 * f + n) // (2 * n)) / 10::DOUBLE AS avg_orders,
               (SELECT segment FROM {{filtered}} GROUP BY segment ORDER BY count(*) DESC, segment LIMIT 1) AS dominant_segment
        FROM (SELECT count(*) AS n, {SEGMENT_TOTALS} AS c, sum(frequency) AS f FROM {{filtered}}),
             (SELECT count(*) AS all_n, {SEGMENT_TOTALS} AS all_c FROM {{profile}})""",
    "dash_segment_revenue": f"SELECT segment, {SEGMENT_TOTALS} / 100::DOUBLE AS revenue FROM {{profile}} GROUP BY segment",
    "dash_segment_matrix": f"""
        SELECT segment, n AS customer_count, c / 100::DOUBLE AS total_revenue, ((2 * c + n) // (2 * n)) / 100::DOUBLE AS avg_revenue,
               ((2 * r + n) // (2 * n)) / 10::DOUBLE AS avg_recency, ((20 * f + n) // (2 * n)) / 10::DOUBLE AS avg_frequency,
               ((2000 * c + all_c) // (2 * all_c)) / 10::DOUBLE AS revenue_share
        FROM (SELECT segment, count(*) AS n, {SEGMENT_TOTALS} AS c, sum(CAST(round(recency * 10) AS BIGINT)) AS r,
                     sum(frequency) AS f FROM {{filtered}} GROUP BY segment),
             (SELECT {SEGMENT_TOTALS} AS all_c FROM {{profile}})""",
    "dash_scatter": """
        SELECT recency, monetary, frequency, segment, customer_id, r_score, f_score, m_score, estimated_clv FROM {filtered}""",
    "dash_detail_table": """
        SELECT customer_id, first_name, last_name, segment, recency, frequency, monetary, r_score, f_score, m_score,
               rfm_score, estimated_clv, country, age, gender FROM {profile} ORDER BY customer_id LIMIT 300""",
    "customer_360": """
        SELECT p.customer_id, first_name, last_name, country, segment, rfm_score, monetary, total_orders,
               risk_level, churn_probability, estimated_clv, recommendation_count, recommended_products
        FROM {profile} p JOIN {scores} s ON s.customer_id = p.customer_id
        LEFT JOIN (SELECT customer_id, count(*) AS recommendation_count,
                          string_agg(product_name, ' | ' ORDER BY rank) AS recommended_products
                   FROM {recs_std} GROUP BY customer_id) r ON r.customer_id = p.customer_id""",
    "dash_probability_histogram": """
        SELECT bin, bin / 40::DOUBLE AS bin_start, count(*) AS customers
        FROM (SELECT CAST(least(floor(churn_probability * 40), 39) AS BIGINT) AS bin FROM {scores}) GROUP BY bin""",
    "dash_high_risk_top": """
        SELECT customer_id, churn_probability, risk_level FROM {scores} WHERE risk_level = 'High Risk'
        ORDER BY churn_probability DESC, customer_id LIMIT 100""",
    "dash_rec_categories": """
        SELECT category, count(*) AS recommendations FROM {recs_std} GROUP BY category
        ORDER BY recommendations DESC, category LIMIT 15""",
    "dash_category_totals": """
        SELECT count(*) AS categories, sum(CAST(round(total_revenue * 100) AS BIGINT)) / 100::DOUBLE AS total_revenue,
               CAST(sum(order_count) AS BIGINT) AS order_count_total FROM {categories}""",
    "dash_category_top": """
        SELECT category, total_revenue, unique_customers FROM {categories} ORDER BY total_revenue DESC, category LIMIT 15""",
    "dash_cohort_heatmap": "SELECT cohort_month, "
    + ", ".join(f'max(CASE WHEN months_since = {k} THEN retention_rate END) * 100 AS "{k}"' for k in range(12))
    + " FROM {cohorts} GROUP BY cohort_month",
    "diag_score_counts": _union(
        [
            f"SELECT '{s}' AS score_name, {s} AS score, count(*) AS customers FROM {{segmented}} GROUP BY {s}"
            for s in ("r_score", "f_score", "m_score")
        ]
    ),
    "diag_frequency_share": """
        SELECT frequency, count(*) AS customers, count(*) / CAST((SELECT count(*) FROM {segmented}) AS DOUBLE) AS share
        FROM {segmented} GROUP BY frequency ORDER BY customers DESC, frequency LIMIT 5""",
    "diag_crosstab": "SELECT frequency, "
    + ", ".join(f"count(*) FILTER (WHERE f_score = {k}) AS f_score_{k}" for k in range(1, 6))
    + " FROM {segmented} GROUP BY frequency",
    "diag_other_pairs": """
        SELECT r_score, f_score, count(*) AS customers FROM {segmented} WHERE segment = 'Other' GROUP BY ALL""",
    "diag_segment_share": f"""
        SELECT 'Champions' AS segment, n AS customers, ((20000 * n + all_n) // (2 * all_n)) / 10000::DOUBLE * 100 AS customer_share_pct,
               c / 100::DOUBLE AS revenue, ((20000 * c + all_c) // (2 * all_c)) / 10000::DOUBLE * 100 AS revenue_share_pct
        FROM (SELECT count(*) AS n, {SEGMENT_TOTALS} AS c FROM {{segmented}} WHERE segment = 'Champions'),
             (SELECT count(*) AS all_n, {SEGMENT_TOTALS} AS all_c FROM {{segmented}})""",
}

# Facts that hold for any fitted model.
_test_rows = "SELECT CAST(sum(test) AS BIGINT) FROM (SELECT CAST(floor(count(*) * 0.2::DOUBLE + 0.5::DOUBLE) AS BIGINT) AS test FROM {churn} GROUP BY churned)"
for _name in ("churn_train_lr", "churn_train_rf", "churn_predictions", "churn_model_roundtrip"):
    ORACLES[f"{_name}_facts"] = """
        SELECT user_id AS customer_id, true AS probability_in_range, true AS prediction_fits, true AS level_fits FROM {churn}"""
ORACLES["churn_reload_differences"] = "SELECT CAST(0 AS BIGINT) AS different, count(*) AS customers FROM {churn}"
ORACLES["churn_metrics_facts"] = _union(
    [
        f"""SELECT '{m}' AS model, ({_test_rows}) AS test_rows,
            (SELECT CAST(sum(CASE WHEN churned = 1 THEN t ELSE 0 END) AS BIGINT) FROM (
                SELECT churned, CAST(floor(count(*) * 0.2::DOUBLE + 0.5::DOUBLE) AS BIGINT) AS t FROM {{churn}} GROUP BY churned))
                AS churned_rows, true AS rates_fit, true AS area_in_range, true AS one_best"""
        for m in ("Logistic Regression", "Random Forest")
    ]
)
_features = ", ".join(f"('{f}')" for f in CHURN_FEATURES)
ORACLES["churn_feature_importance_facts"] = f"""
    SELECT feature, true AS in_range, true AS adds_up FROM (VALUES {_features}) AS f(feature)"""
ORACLES["dash_top_features_facts"] = """
    SELECT CAST(least(%d, 10) AS BIGINT) AS features, true AS known, true AS in_order""" % len(CHURN_FEATURES)
ORACLES["customer_kmeans_facts"] = """
    SELECT customer_id, true AS label_known, true AS one_label_per_cluster FROM {segmented}"""
ORACLES["sink_publish"] = _union(
    [
        f"SELECT '{name}' AS output, 'ready' AS status, CAST(({rows}) AS BIGINT) AS row_count"
        for name, rows in {
            "customer_rfm": "SELECT count(*) FROM {rfm}",
            "customer_segments": "SELECT count(*) FROM {rfm}",
            "churn_predictions": "SELECT count(*) FROM {churn}",
            "churn_feature_importance": str(len(CHURN_FEATURES)),
            "monthly_kpis": "SELECT count(*) FROM {kpis}",
            "cohort_retention": "SELECT count(DISTINCT cohort_month) FROM {cohorts}",
            "clv": "SELECT count(*) FROM {clv}",
            "category_analytics": "SELECT count(*) FROM {categories}",
            "recommendations": "SELECT count(*) FROM {recs_std}",
        }.items()
    ]
)

# Repeated order rows change nothing.
for _name in (
    "feat_completed_items", "rfm_features", "customer_aggregates", "churn_features", "kpi_monthly", "sql_rfm",
    "sql_monthly_kpis",
):
    ORACLES[f"{_name}_repeated"] = ORACLES[_name]

_REFERENCE = re.compile(r"\{(\w+)\}")


def _needed(sql: str, found: dict[str, None]) -> None:
    """Collect the fragments `sql` refers to, dependencies first."""
    for name in _REFERENCE.findall(sql):
        if name not in found:
            _needed(FRAGMENTS[name], found)
            found[name] = None


def compose(name: str) -> str:
    sql = ORACLES[name]
    found: dict[str, None] = {}
    _needed(sql, found)
    ctes = [f"t_{f} AS MATERIALIZED ({_REFERENCE.sub(r't_\1', FRAGMENTS[f])})" for f in found]
    body = _REFERENCE.sub(r"t_\1", sql)
    return f"WITH {', '.join(ctes)}\n{body}" if ctes else body

-- KPIs per calendar month, from one row per customer and active month.
WITH revenue AS (
    SELECT order_id, SUM(CAST(FLOOR(sale_price * 1000000D + 0.5D) AS BIGINT)) AS micros
    FROM order_items
    WHERE status IN ('complete', 'shipped', 'processing')
    GROUP BY order_id
),
heads AS (
    SELECT order_id, user_id, created_at
    FROM (SELECT order_id, user_id, created_at,
                 ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY created_at NULLS LAST, user_id NULLS LAST) AS n
          FROM orders
          WHERE status IN ('complete', 'shipped', 'processing'))
    WHERE n = 1
),
active_months AS (
    SELECT o.user_id,
           TRUNC(o.created_at, 'MM') AS month,
           COUNT(*) AS orders,
           COALESCE(SUM(r.micros), 0) AS micros
    FROM heads o
    LEFT JOIN revenue r ON r.order_id = o.order_id
    GROUP BY o.user_id, TRUNC(o.created_at, 'MM')
),
dated AS (
    SELECT month, orders, micros, month = MIN(month) OVER (PARTITION BY user_id) AS is_new
    FROM active_months
),
months AS (
    SELECT month,
           SUM(CAST(micros AS DECIMAL(20, 0))) AS micros,
           SUM(orders) AS orders,
           COUNT(*) AS customers,
           COUNT_IF(is_new) AS new_customers,
           COUNT_IF(NOT is_new) AS repeat_customers
    FROM dated
    GROUP BY month
)
SELECT DATE_FORMAT(month, 'yyyy-MM') AS year_month,
       ((micros * 2 + 10000) DIV 20000) / 100D AS total_revenue,
       orders AS total_orders,
       customers AS unique_customers,
       ((micros * 2 + orders * 10000) DIV (orders * 20000)) / 100D AS avg_order_value,
       new_customers,
       repeat_customers,
       ((repeat_customers * 20000 + customers) DIV (customers * 2)) / 10000D AS repeat_customer_rate
FROM months
ORDER BY year_month

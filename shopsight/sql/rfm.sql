-- RFM per customer. Recency counts calendar-day boundaries to the latest
-- completed order. Revenue is summed per order before it meets the orders; of
-- repeated order rows the earliest counts.
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
purchases AS (
    SELECT o.user_id, o.created_at, r.micros
    FROM heads o
    LEFT JOIN revenue r ON r.order_id = o.order_id
),
customers AS (
    SELECT user_id AS customer_id,
           MAX(created_at) AS last_purchase_date,
           COUNT(*) AS frequency,
           COALESCE(SUM(micros), 0) AS micros
    FROM purchases
    GROUP BY user_id
)
SELECT customer_id,
       last_purchase_date,
       CAST(DATEDIFF(
           TO_DATE((SELECT MAX(created_at) FROM orders WHERE status IN ('complete', 'shipped', 'processing'))),
           TO_DATE(last_purchase_date)) AS BIGINT) AS recency,
       frequency,
       ((micros + 5000) DIV 10000) / 100D AS monetary
FROM customers
ORDER BY monetary DESC, customer_id

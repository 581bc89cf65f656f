-- Revenue, reach and mean price per product category.
WITH sold AS (
    SELECT product_id, order_id, user_id, CAST(FLOOR(sale_price * 1000000D + 0.5D) AS BIGINT) AS micros
    FROM order_items
    WHERE status IN ('complete', 'shipped', 'processing')
),
per_product AS (
    SELECT product_id, SUM(micros) AS micros, COUNT(micros) AS priced_items
    FROM sold
    GROUP BY product_id
),
sales AS (
    SELECT p.category,
           SUM(CAST(s.micros AS DECIMAL(20, 0))) AS micros,
           SUM(s.priced_items) AS priced_items,
           COUNT(*) AS product_count
    FROM per_product s
    JOIN products p ON p.id = s.product_id
    WHERE p.category IS NOT NULL
    GROUP BY p.category
),
found AS (
    SELECT p.category, s.order_id, s.user_id
    FROM sold s
    JOIN products p ON p.id = s.product_id
    WHERE p.category IS NOT NULL
),
per_order AS (
    -- The one shuffle of items.
    SELECT category, order_id FROM found GROUP BY category, order_id
),
orders_of AS (
    SELECT category, COUNT(order_id) AS order_count FROM per_order GROUP BY category
),
per_run AS (
    SELECT category, BITMAP_CONSTRUCT_AGG(BITMAP_BIT_POSITION(user_id)) AS customers
    FROM found
    WHERE user_id IS NOT NULL
    GROUP BY category, BITMAP_BUCKET_NUMBER(user_id)
),
customers_of AS (
    SELECT category, SUM(BITMAP_COUNT(customers)) AS unique_customers FROM per_run GROUP BY category
),
reach AS (
    SELECT o.category, order_count, COALESCE(unique_customers, 0) AS unique_customers
    FROM orders_of o
    LEFT JOIN customers_of c ON c.category = o.category
)
SELECT sales.category,
       ((micros * 2 + 10000) DIV 20000) / 100D AS total_revenue,
       order_count,
       unique_customers,
       ((micros * 2 + priced_items * 10000) DIV (priced_items * 20000)) / 100D AS avg_selling_price,
       product_count
FROM sales
JOIN reach ON reach.category = sales.category
ORDER BY total_revenue DESC, category

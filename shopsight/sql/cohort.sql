-- Retention per cohort and months since the first order.
WITH active_months AS (
    SELECT DISTINCT user_id, TRUNC(created_at, 'MM') AS month
    FROM orders
    WHERE status IN ('complete', 'shipped', 'processing')
),
aged AS (
    SELECT month, MIN(month) OVER (PARTITION BY user_id) AS cohort
    FROM active_months
),
activity AS (
    SELECT cohort,
           CAST((YEAR(month) - YEAR(cohort)) * 12 + MONTH(month) - MONTH(cohort) AS BIGINT) AS months_since,
           COUNT(*) AS active_customers
    FROM aged
    GROUP BY ALL
),
sized AS (
    SELECT *, MAX(CASE WHEN months_since = 0 THEN active_customers END) OVER (PARTITION BY cohort) AS cohort_size
    FROM activity
)
SELECT DATE_FORMAT(cohort, 'yyyy-MM') AS cohort_month,
       months_since,
       active_customers,
       cohort_size,
       ((active_customers * 20000 + cohort_size) DIV (cohort_size * 2)) / 10000D AS retention_rate
FROM sized
ORDER BY cohort_month, months_since

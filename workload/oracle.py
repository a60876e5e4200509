"""The SQL twin of each registered query, for DuckDB on the same tables."""

from __future__ import annotations

import re

PROFILE = "Recency Frequency Monetary avg_order_value unique_products avg_unit_price".split()

# Named subqueries, each written over the tables and the ones before it.
PARTS: dict[str, str] = {
    "tx": """
SELECT CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS CustomerID,
       concat(CASE WHEN l_returnflag = 'R' THEN 'C' ELSE '' END, CAST(o_orderkey AS VARCHAR)) AS InvoiceNo,
       CASE WHEN p_partkey % 50 = 7 THEN 'POST'
            ELSE concat(substring(p_type, 1, 2), CAST(p_partkey AS VARCHAR)) END AS StockCode,
       p_name AS Description,
       CASE WHEN l_linenumber = 7 AND l_quantity > 48 THEN -CAST(l_quantity AS INT)
            ELSE CAST(l_quantity AS INT) END AS Quantity,
       o_orderdate AS InvoiceDate,
       CAST(p_retailprice AS DECIMAL(12,2)) AS UnitPrice,
       n_name AS Country,
       o_orderpriority AS Channel,
       CASE WHEN l_discount > 0 THEN 'Discounted' ELSE 'Full price' END AS Offer
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
              JOIN part ON l_partkey = p_partkey
              JOIN supplier ON l_suppkey = s_suppkey
              JOIN nation ON s_nationkey = n_nationkey""",
    "tx_events": """
SELECT CAST(user_id AS VARCHAR) AS CustomerID, CAST(event_id AS VARCHAR) AS InvoiceNo, event_type AS StockCode,
       1 AS Quantity, ts AS InvoiceDate, CAST(value AS DECIMAL(12,2)) AS UnitPrice,
       CAST(value AS DECIMAL(12,2)) AS Revenue
FROM events WHERE event_type = 'purchase'""",
    "clean": """
SELECT tx.*, Quantity * UnitPrice AS Revenue FROM tx
WHERE NOT coalesce(starts_with(InvoiceNo, 'C'), false) AND CustomerID IS NOT NULL
  AND Quantity > 0 AND UnitPrice > 0
  AND NOT coalesce(StockCode IN ('POST', 'D', 'M', 'BANK CHARGES', 'PADS', 'DOT'), false)""",
    "bounds": "SELECT max(InvoiceDate) AS last_date, max(InvoiceDate) + INTERVAL 1 DAY AS snapshot FROM clean",
    "rfm": """
SELECT CustomerID, datesub('day', max(InvoiceDate), (SELECT snapshot FROM bounds)) AS Recency,
       count(DISTINCT InvoiceNo) AS Frequency, CAST(sum(Revenue) AS DOUBLE) AS Monetary
FROM clean GROUP BY CustomerID""",
    "edges": "SELECT quantile_cont(Recency, [0.2, 0.4, 0.6, 0.8]) AS e FROM rfm",
    "ranked": """
SELECT *, row_number() OVER (ORDER BY Frequency, CustomerID) AS F_Rank,
       row_number() OVER (ORDER BY Monetary, CustomerID) AS M_Rank, count(*) OVER () AS n
FROM rfm""",
    "scored": """
SELECT CustomerID, Recency, Frequency, Monetary, R_Score, F_Score, M_Score,
       R_Score + F_Score + M_Score AS RFM_Score, concat(R_Score, F_Score, M_Score) AS RFM_String
FROM (SELECT *,
        CAST(5 - ((Recency > e[1])::INT + (Recency > e[2])::INT + (Recency > e[3])::INT + (Recency > e[4])::INT) AS INT)
          AS R_Score,
        CAST(greatest(1, ((F_Rank - 1) * 5 + n - 2) // (n - 1)) AS INT) AS F_Score,
        CAST(greatest(1, ((M_Rank - 1) * 5 + n - 2) // (n - 1)) AS INT) AS M_Score
      FROM ranked, edges)""",
    "segmented": """
SELECT *, CASE
  WHEN (R_Score, F_Score) IN ((5,5),(5,4),(4,5)) THEN 'Champions'
  WHEN (R_Score, F_Score) IN ((4,4),(3,5)) THEN 'Loyal Customers'
  WHEN (R_Score, F_Score) IN ((5,3),(4,3),(5,2)) THEN 'Potential Loyalists'
  WHEN (R_Score, F_Score) IN ((3,2)) THEN 'About to Sleep'
  WHEN (R_Score, F_Score) IN ((2,3),(2,4),(2,5)) THEN 'At Risk'
  WHEN (R_Score, F_Score) IN ((1,5),(1,4)) THEN 'Can''t Lose Them'
  WHEN (R_Score, F_Score) IN ((1,3),(1,2),(2,2)) THEN 'Hibernating'
  WHEN (R_Score, F_Score) IN ((1,1),(2,1),(3,1)) THEN 'Lost'
  ELSE 'Need Attention' END AS Segment
FROM scored""",
    "order_sums": """
SELECT CustomerID, InvoiceNo, sum(Revenue) AS exact, CAST(sum(Revenue) AS DOUBLE) AS revenue,
       sum(Quantity)::BIGINT AS items, count(*) AS lines
FROM clean GROUP BY CustomerID, InvoiceNo""",
    "order_stats": """
SELECT CustomerID, CAST(sum(exact) AS DOUBLE) / count(*) AS avg_order_value, coalesce(stddev_samp(revenue), 0) AS std_order_value
FROM order_sums GROUP BY CustomerID""",
    "base": """
SELECT CustomerID, CAST(sum(Revenue) AS DOUBLE) AS total_revenue, count(DISTINCT InvoiceNo) AS total_orders,
       sum(Quantity)::BIGINT AS total_items, count(DISTINCT StockCode) AS unique_products,
       count(DISTINCT substring(StockCode, 1, 2)) AS unique_categories,
       CAST(sum(UnitPrice) AS DOUBLE) / count(UnitPrice) AS avg_unit_price,
       CAST(max(UnitPrice) AS DOUBLE) AS max_unit_price, count(DISTINCT Country) AS total_countries,
       min(InvoiceDate) AS first_purchase, max(InvoiceDate) AS last_purchase
FROM clean GROUP BY CustomerID""",
    "spans": """
SELECT base.*, avg_order_value, std_order_value,
       datesub('day', first_purchase, snapshot) AS customer_age_days,
       datesub('day', last_purchase, snapshot) AS recency_days,
       datesub('day', first_purchase, last_purchase) AS purchase_span_days
FROM base JOIN order_stats USING (CustomerID), bounds""",
    "features": """
SELECT CustomerID, recency_days AS Recency, total_orders AS Frequency, total_revenue AS Monetary,
       total_revenue, total_orders, total_items, avg_order_value, std_order_value, unique_products,
       unique_categories, avg_unit_price, max_unit_price, total_countries, customer_age_days, recency_days,
       purchase_span_days, purchase_span_days / greatest(total_orders - 1, 1) AS avg_days_between_orders,
       total_orders / greatest(customer_age_days / 30, 1e-1) AS purchase_frequency_per_month,
       total_revenue / greatest(total_items, 1) AS revenue_per_item,
       unique_products / greatest(total_items, 1) AS product_diversity_ratio,
       CAST(total_countries > 1 AS INT) AS is_multi_country,
       ln(1 + total_revenue) AS log_total_revenue, ln(1 + avg_order_value) AS log_avg_order_value,
       ln(1 + total_items) AS log_total_items
FROM spans""",
    "labels_90": """
SELECT CustomerID, CAST(max(InvoiceDate) < (SELECT last_date FROM bounds) - INTERVAL 90 DAY AS INT) AS Churned
FROM clean GROUP BY CustomerID""",
    "rules": """
SELECT *, floor((7e-1 * Recency::DOUBLE / (Recency::DOUBLE + 150e0) + 3e-1 / (Frequency::DOUBLE + 1e0)) * 1000e0)
            / 1000e0 AS Churn_Probability,
       floor(Monetary * 365e0 / (Recency::DOUBLE + 365e0) * 100e0) / 100e0 AS Predicted_LTV
FROM segmented""",
    "ltv_edges": "SELECT quantile_cont(Predicted_LTV, [0.25, 0.5, 0.75]) AS q FROM rules",
    "tiers": """
SELECT rules.*, CAST(Churn_Probability >= 5e-1 AS INT) AS Churn_Predicted,
       CASE WHEN Churn_Probability <= 0 THEN NULL WHEN Churn_Probability <= 3e-1 THEN 'Low'
            WHEN Churn_Probability <= 6e-1 THEN 'Medium' WHEN Churn_Probability <= 8e-1 THEN 'High'
            WHEN Churn_Probability <= 1 THEN 'Critical' END AS Churn_Risk_Tier,
       CASE WHEN Predicted_LTV <= q[1] THEN 'Bronze' WHEN Predicted_LTV <= q[2] THEN 'Silver'
            WHEN Predicted_LTV <= q[3] THEN 'Gold' ELSE 'Platinum' END AS LTV_Tier
FROM rules, ltv_edges""",
    "country_lines": "SELECT CustomerID, Country, count(*) AS c FROM clean GROUP BY CustomerID, Country",
    "homes": """
SELECT CustomerID, Country FROM country_lines
QUALIFY row_number() OVER (PARTITION BY CustomerID ORDER BY c DESC, Country) = 1""",
    "joins": "SELECT CustomerID, min(InvoiceDate) AS JoinDate FROM clean GROUP BY CustomerID",
    "customers": """
SELECT CustomerID, Recency, Frequency, Monetary, Segment, LTV_Tier, Predicted_LTV, Churn_Probability,
       Churn_Risk_Tier, Country, JoinDate
FROM tiers JOIN homes USING (CustomerID) JOIN joins USING (CustomerID)""",
    "scores": """
SELECT CustomerID, Churned AS label, Churn_Probability AS probability, CAST(Churn_Probability >= 5e-1 AS INT) AS prediction
FROM rules JOIN labels_90 USING (CustomerID)""",
    "curve_rows": """
SELECT probability AS threshold, sum(label)::BIGINT AS pos, sum(1 - label)::BIGINT AS neg
FROM scores GROUP BY probability""",
    "curve": """
SELECT threshold, pos, neg, (sum(pos) OVER w)::BIGINT AS tp, (sum(neg) OVER w)::BIGINT AS fp,
       (sum(pos) OVER ())::BIGINT AS all_pos, (sum(neg) OVER ())::BIGINT AS all_neg
FROM curve_rows WINDOW w AS (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "pr": """
SELECT CAST(tp AS DOUBLE) / (tp + fp) AS precision, CAST(tp AS DOUBLE) / all_pos AS recall, threshold FROM curve""",
    "value_scores": "SELECT ln(1 + Monetary) AS y, ln(1 + Predicted_LTV) AS prediction FROM rules",
    "months": """
SELECT CustomerID, date_trunc('month', InvoiceDate)::DATE AS m, sum(Revenue) AS revenue,
       count(DISTINCT InvoiceNo) AS orders
FROM clean GROUP BY CustomerID, m""",
    "placed": """
SELECT *, min(m) OVER (PARTITION BY CustomerID) AS CohortMonth,
       CAST(datediff('month', min(m) OVER (PARTITION BY CustomerID), m) AS INT) AS Period
FROM months""",
    "sizes": "SELECT CohortMonth, count(*) AS CohortSize FROM placed WHERE Period = 0 GROUP BY CohortMonth",
    "grid": """
SELECT CohortMonth, CohortSize, CAST(p AS INT) AS Period
FROM sizes, range(0, 12) r(p)
WHERE p <= datediff('month', CohortMonth, (SELECT max(m) FROM months))""",
    "activity": """
SELECT CohortMonth, Period, count(*) AS a, sum(revenue) AS r, sum(orders)::BIGINT AS o
FROM placed GROUP BY CohortMonth, Period""",
    "cohorts": """
SELECT CohortMonth, Period, CohortSize, coalesce(a, 0) AS Active, coalesce(r, 0) AS Revenue, coalesce(o, 0) AS Orders
FROM grid LEFT JOIN activity USING (CohortMonth, Period)""",
    "scaled": """
SELECT CustomerID, (Recency - avg(Recency) OVER ()) / stddev_pop(Recency) OVER () AS Recency,
       (Frequency - avg(Frequency) OVER ()) / stddev_pop(Frequency) OVER () AS Frequency,
       (Monetary - avg(Monetary) OVER ()) / stddev_pop(Monetary) OVER () AS Monetary
FROM rfm""",
    "pairs": """
SELECT p.CustomerID AS u, q.CustomerID AS v FROM scaled p JOIN scaled q
ON (p.Recency - q.Recency) * (p.Recency - q.Recency) + (p.Frequency - q.Frequency) * (p.Frequency - q.Frequency)
   + (p.Monetary - q.Monetary) * (p.Monetary - q.Monetary) <= 25e-2""",
    "cores": "SELECT u AS id FROM pairs GROUP BY u HAVING count(*) >= 5",
    "core_edges": """
SELECT u, v FROM pairs WHERE u IN (SELECT id FROM cores) AND v IN (SELECT id FROM cores) AND u <> v""",
    "profile": "SELECT CustomerID, "
    + ", ".join(f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS x{i}" for i, c in enumerate(PROFILE))
    + " FROM features",
    "profile_pairs": "SELECT p.CustomerID AS u, q.CustomerID AS v FROM profile p JOIN profile q ON "
    + " + ".join(f"(p.x{i} - q.x{i}) * (p.x{i} - q.x{i})" for i in range(len(PROFILE)))
    + " <= 25e-2",
    "profile_cores": "SELECT u AS id FROM profile_pairs GROUP BY u HAVING count(*) >= 5",
    "profile_edges": """
SELECT u, v FROM profile_pairs
WHERE u IN (SELECT id FROM profile_cores) AND v IN (SELECT id FROM profile_cores) AND u <> v""",
    "clustered": "SELECT *, CAST(Frequency % 5 AS INT) AS KMeans_Cluster, CAST(Frequency % 7 - 1 AS INT) AS DBSCAN_Cluster FROM rfm",
    "day_sums": """
SELECT CustomerID, InvoiceDate::DATE AS d, sum(Revenue) AS spent FROM clean GROUP BY CustomerID, d""",
    "summary": """
SELECT CustomerID, count(*) - 1 AS frequency, datediff('day', min(d), max(d)) AS recency,
       datediff('day', min(d), (SELECT max(d) FROM day_sums)) AS T,
       CASE WHEN count(*) > 1 THEN CAST(sum(spent) - arg_min(spent, d) AS DOUBLE) / (count(*) - 1) ELSE 0 END
         AS monetary_value
FROM day_sums GROUP BY CustomerID""",
    # The series in logarithms, by lgamma; all arguments are positive.
    "horizons": """
SELECT CustomerID, frequency::DOUBLE AS x, recency::DOUBLE AS t_x, T::DOUBLE AS age, monetary_value, h::DOUBLE AS h
FROM summary, (SELECT unnest([30, 60, 90, 120, 150, 180, 210, 240, 270, 300, 330, 360, 365]) AS h)""",
    "until": """
SELECT CustomerID, x, monetary_value, h,
  (8e-1 + 3 + x - 1) / (8e-1 - 1)
  * (1 - exp((12e-1 + x) * ln((200 + age) / (200 + age + h)))
       * list_sum(list_transform(range(0, 600), lambda j: exp(
           lgamma(12e-1 + x + j) - lgamma(12e-1 + x) + lgamma(3 + x + j) - lgamma(3 + x)
           - lgamma(8e-1 + 3 + x - 1 + j) + lgamma(8e-1 + 3 + x - 1) - lgamma(j + 1)
           + j * ln(h / (200 + age + h))))))
  / (1 + CASE WHEN x > 0 THEN 8e-1 / (3 + x - 1) * exp((12e-1 + x) * ln((200 + age) / (200 + t_x))) ELSE 0 END)
  AS purchases
FROM horizons""",
    "baskets": "SELECT * FROM order_sums WHERE InvoiceNo IS NOT NULL",
    "days": "SELECT DISTINCT CustomerID, InvoiceDate::DATE AS d FROM clean",
    "gaps": "SELECT CustomerID, datediff('day', lag(d) OVER (PARTITION BY CustomerID ORDER BY d), d) AS g FROM days",
    "categories": """
SELECT CustomerID, substring(StockCode, 1, 2) AS category, sum(Revenue) AS r FROM clean GROUP BY CustomerID, category""",
}


def query(body: str) -> str:
    """``body`` preceded by the named subqueries it uses, directly or not."""
    names = list(PARTS)
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in names:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(PARTS[name])

    visit(body)
    listed = [f"{name} AS ({PARTS[name].strip()})" for name in names if name in needed]
    return f"WITH {', '.join(listed)} {body.strip()}" if listed else body.strip()


def rounded(columns: str, digits: int = 6) -> str:
    """Select list that rounds each of the named columns."""
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in columns.split())


# Clusters of core rows numbered by their smallest id; other rows join the lowest-numbered one in reach.
DENSITY = """
WITH RECURSIVE component(id, label) USING KEY (id) AS (
  SELECT id, id FROM {cores}
  UNION
  SELECT e.v, min(c.label) FROM component c JOIN {edges} e ON e.u = c.id
  JOIN recurring.component old ON old.id = e.v WHERE c.label < old.label GROUP BY e.v),
numbered AS (SELECT id, dense_rank() OVER (ORDER BY label) - 1 AS n FROM component),
reached AS (SELECT v AS id, min(n) AS n FROM {pairs} JOIN numbered ON u = id GROUP BY v)
SELECT CustomerID, CAST(coalesce(m.n, r.n, -1) AS INT) AS DBSCAN_Cluster
FROM {table} LEFT JOIN numbered m ON m.id = CustomerID LEFT JOIN reached r ON r.id = CustomerID"""

# Shapley values of the two fixed trees by all eight subsets of known inputs.
SHAPLEY = """
WITH known AS (SELECT i, i & 1 > 0 AS r, i & 2 > 0 AS f, i & 4 > 0 AS m, bit_count(i) AS size FROM range(8) AS t(i)),
inner_nodes AS (SELECT CustomerID, Recency, Frequency, Monetary, known.*,
    CASE WHEN NOT f THEN (25 * 0.3::DOUBLE + 15 * 0.1::DOUBLE) / 40 WHEN Frequency <= 3 THEN 0.3::DOUBLE ELSE 0.1::DOUBLE END AS near,
    CASE WHEN NOT r THEN (9 * 0.4::DOUBLE + 6 * 0.8::DOUBLE) / 15 WHEN Recency <= 200 THEN 0.4::DOUBLE ELSE 0.8::DOUBLE END AS rich,
    CASE WHEN NOT f THEN (60 * 0.25::DOUBLE - 20 * 0.5::DOUBLE) / 80 WHEN Frequency <= 5 THEN 0.25::DOUBLE ELSE -0.5::DOUBLE END AS other
  FROM rfm, known),
far AS (SELECT *, CASE WHEN NOT m THEN (45 * 0.9::DOUBLE + 15 * rich) / 60 WHEN Monetary <= 500000 THEN 0.9::DOUBLE ELSE rich END AS far FROM inner_nodes),
tree AS (SELECT *, other + CASE WHEN NOT r THEN (40 * near + 60 * far) / 100 WHEN Recency <= 60 THEN near ELSE far END AS v FROM far),
weighed AS (SELECT *, CASE WHEN size IN (0, 2) THEN 1 / 3::DOUBLE WHEN size = 1 THEN 1 / 6::DOUBLE END AS without,
                   CASE WHEN size IN (1, 3) THEN 1 / 3::DOUBLE WHEN size = 2 THEN 1 / 6::DOUBLE END AS within FROM tree)
"""

DESCRIBE = """
SELECT count(*) AS count, round_even(avg(v) * 100e0, 0) / 100e0 AS mean, round_even(stddev_samp(v) * 100e0, 0) / 100e0 AS std,
       round_even(min(v) * 100e0, 0) / 100e0 AS min, round_even(quantile_cont(v, 0.25) * 100e0, 0) / 100e0 AS p25,
       round_even(quantile_cont(v, 0.5) * 100e0, 0) / 100e0 AS p50,
       round_even(quantile_cont(v, 0.75) * 100e0, 0) / 100e0 AS p75, round_even(max(v) * 100e0, 0) / 100e0 AS max
FROM (SELECT {value} AS v FROM {table})"""

# Expected profit of twelve discounted months at fixed parameters.
LTV_12M = """
SELECT CustomerID, round(sum(step * 101e-2 ** (-h / 30)) * any_value(6 * (15000 + x * monetary_value) / (6 * x + 3)), 4)
         AS LTV_12m
FROM (SELECT *, purchases - lag(purchases, 1, 0) OVER (PARTITION BY CustomerID ORDER BY h) AS step FROM until WHERE h < 365)
GROUP BY CustomerID"""

TX_COLUMNS = "CustomerID, InvoiceNo, StockCode, Quantity, InvoiceDate, CAST(UnitPrice AS DOUBLE) AS UnitPrice, Country"
CLEAN_COLUMNS = TX_COLUMNS + ", CAST(Revenue AS DOUBLE) AS Revenue"
NOT_CANCELLED = "NOT coalesce(starts_with(InvoiceNo, 'C'), false)"

LARGE_FEATURES = "total_revenue avg_order_value std_order_value avg_unit_price max_unit_price revenue_per_item"
SMALL_FEATURES = (
    "avg_days_between_orders purchase_frequency_per_month product_diversity_ratio log_total_revenue "
    "log_avg_order_value log_total_items"
)
COUNT_FEATURES = (
    "total_orders, total_items, unique_products, unique_categories, total_countries, customer_age_days, "
    "recency_days, purchase_span_days, is_multi_country"
)


def segment_table(digits: int, count: str, share: str) -> str:
    def even(x: str, d: int) -> str:
        return f"round_even({x} * {10**d}e0, 0) / {10**d}e0"

    return f"""
SELECT *, {even('Total_Revenue / sum(Total_Revenue) OVER () * 100', 1)} AS "{share}"
FROM (SELECT Segment, count(*) AS {count}, {even('avg(Recency)', digits)} AS Avg_Recency,
             {even('avg(Frequency)', digits)} AS Avg_Frequency, {even('avg(Monetary)', digits)} AS Avg_Monetary,
             {even('sum(Monetary)', digits)} AS Total_Revenue
      FROM segmented GROUP BY Segment)"""


def mix(column: str) -> str:
    return f"""
SELECT CustomerID, {column}, round(r / sum(r) OVER w, 6) AS revenue_share, round(o / sum(o) OVER w, 6) AS order_share
FROM (SELECT CustomerID, {column}, CAST(sum(Revenue) AS DOUBLE) AS r, count(DISTINCT InvoiceNo) AS o
      FROM clean GROUP BY CustomerID, {column})
WINDOW w AS (PARTITION BY CustomerID)"""


def differences(params: dict[str, float], loglik: str, rows: str, step: float = 1e-2) -> str:
    """First and second derivatives of the mean of ``loglik`` over ``rows``, by differences of fourth order."""
    points = [
        "(" + ", ".join([f"'{name}'", str(k), *[f"{v * (1 + step * k if n == name else 1)!r}::DOUBLE" for n, v in params.items()]]) + ")"
        for name in params
        for k in range(-2, 3)
    ]
    size = "(CASE name " + " ".join(f"WHEN '{n}' THEN {v * step!r}::DOUBLE" for n, v in params.items()) + " END)"
    slope = "CASE k WHEN -2 THEN 1 WHEN -1 THEN -8 WHEN 1 THEN 8 WHEN 2 THEN -1 ELSE 0 END"
    bend = "CASE k WHEN 0 THEN -30 WHEN -1 THEN 16 WHEN 1 THEN 16 ELSE -1 END"
    return f"""
WITH points(name, k, {', '.join(params)}) AS (VALUES {', '.join(points)}),
means AS (SELECT name, k, avg({loglik}) AS f FROM ({rows}) AS x, points GROUP BY name, k)
SELECT concat('g_', name) AS name, round(sum(f * {slope}) / (12 * any_value({size})), 4) AS value FROM means GROUP BY name
UNION ALL SELECT concat('h_', name, '_', name), round(sum(f * {bend}) / (12 * any_value({size}) ** 2), 4) FROM means GROUP BY name"""


BODIES: dict[str, str] = {
    "S1_load_transactions": f"SELECT {TX_COLUMNS.replace('Quantity', 'Quantity::BIGINT AS Quantity')}, Description FROM tx",
    "S1_load_messy": """
SELECT CASE o_custkey % 4 WHEN 1 THEN concat(o_custkey, 'E2') WHEN 3 THEN concat(o_custkey, 'C') ELSE o_custkey::VARCHAR END AS CustomerID,
       o_orderkey::VARCHAR AS InvoiceNo, l_linenumber::VARCHAR AS StockCode,
       CASE l_linenumber % 4 WHEN 2 THEN l_quantity::BIGINT * 1000000000 WHEN 3 THEN NULL ELSE l_quantity::BIGINT END AS Quantity,
       CASE WHEN l_linenumber % 3 < 2 THEN o_orderdate END AS InvoiceDate,
       CAST(concat(trunc(l_extendedprice)::BIGINT, '.00', l_linenumber) AS DOUBLE) AS UnitPrice
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "S1_load_quoted": """
SELECT l_orderkey::VARCHAR AS InvoiceNo, l_linenumber::VARCHAR AS StockCode,
       CASE l_partkey % 5 WHEN 0 THEN concat('SET OF ', l_linenumber, ' "PINK", HEARTS') WHEN 1 THEN concat('two', chr(10), 'lines, "', chr(10))
            WHEN 2 THEN concat('5" PIPE ', l_suppkey) WHEN 3 THEN concat(' ', chr(92), '" ') ELSE concat('"', l_returnflag, '"') END AS Description,
       l_quantity::BIGINT AS Quantity,
       CASE l_suppkey % 2 WHEN 0 THEN concat('Korea, "South"', chr(10)) ELSE 'Peru' END AS Country
FROM lineitem""",
    "S1_unreadable_cells": """
SELECT 'Quantity' AS "column", count(*) AS filled, count(*) FILTER (l_linenumber % 4 = 3) AS unreadable FROM lineitem
UNION ALL SELECT 'InvoiceDate', count(*), count(*) FILTER (l_linenumber % 3 = 2) FROM lineitem
UNION ALL SELECT 'UnitPrice', count(*), 0 FROM lineitem""",
    "S2_write_transactions": """
SELECT Country, count(*) AS lines, count(CustomerID) AS known, sum(Quantity)::BIGINT AS items,
       CAST(sum(Quantity * UnitPrice) AS DOUBLE) AS amount FROM tx GROUP BY Country""",
    "S3_dataset_profile": """
SELECT 'transactions' AS dataset, count(*) AS rows, CAST(8 AS INT) AS cols, count(DISTINCT CustomerID) AS unique_customers
FROM tx""",
    "F1_drop_cancellations": f"SELECT {TX_COLUMNS} FROM tx WHERE {NOT_CANCELLED}",
    "F2_drop_null_customers": f"SELECT {TX_COLUMNS} FROM tx WHERE CustomerID IS NOT NULL",
    "F3_normalize_customer_id": """
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS CustomerID FROM orders
UNION ALL SELECT c_custkey, c_name FROM customer""",
    "F4_positive_lines": f"SELECT {TX_COLUMNS} FROM tx WHERE Quantity > 0 AND UnitPrice > 0",
    "F5_drop_non_product": f"SELECT {TX_COLUMNS} FROM tx WHERE StockCode <> 'POST'",
    "F6_line_revenue": "SELECT InvoiceNo, StockCode, Quantity, CAST(Quantity * UnitPrice AS DOUBLE) AS Revenue FROM tx",
    "F7_clean_transactions": f"SELECT {CLEAN_COLUMNS} FROM clean",
    "F8_cleaning_audit": """
SELECT count(*) AS rows_in, count(*) FILTER (c) AS removed_cancelled,
       count(*) FILTER (NOT c AND CustomerID IS NULL) AS removed_no_customer,
       count(*) FILTER (NOT c AND CustomerID IS NOT NULL AND NOT p) AS removed_not_positive,
       count(*) FILTER (NOT c AND CustomerID IS NOT NULL AND p AND StockCode = 'POST') AS removed_non_product,
       (SELECT count(*) FROM clean) AS rows_kept, count(*) - (SELECT count(*) FROM clean) AS rows_removed
FROM (SELECT *, starts_with(InvoiceNo, 'C') AS c, Quantity > 0 AND UnitPrice > 0 AS p FROM tx)""",
    "F9_segment_country_filter": """
SELECT CustomerID, Segment, Country FROM segmented JOIN homes USING (CustomerID)
WHERE Segment IN ('Champions', 'At Risk', 'Lost') AND Country IN ('NATION_0', 'NATION_7', 'NATION_12', 'NATION_23')""",
    "F10_feature_matrix": f"""
SELECT CustomerID, {rounded('total_orders unique_products customer_age_days product_diversity_ratio', 6)}
FROM (SELECT CustomerID, total_orders::DOUBLE AS total_orders, unique_products::DOUBLE AS unique_products,
             customer_age_days::DOUBLE AS customer_age_days, product_diversity_ratio FROM features)""",
    "F11_label_segment": "SELECT CustomerID, R_Score, F_Score, Segment FROM segmented",
    "J1_features_with_labels": """
SELECT CustomerID, Recency, Frequency, round(Monetary, 2) AS Monetary, Churned FROM rfm JOIN labels_90 USING (CustomerID)""",
    "J3_customer_features": f"""
SELECT CustomerID, Recency, Frequency, round(Monetary, 2) AS Monetary, {rounded(LARGE_FEATURES, 4)},
       {rounded(SMALL_FEATURES, 6)}, {COUNT_FEATURES} FROM features""",
    "J5_customer_360": """
SELECT CustomerID, Recency, Frequency, round(Monetary, 2) AS Monetary, Segment, LTV_Tier, Predicted_LTV,
       Churn_Probability, Churn_Risk_Tier, Country, JoinDate FROM customers""",
    "A1_compute_rfm": "SELECT CustomerID, Recency, Frequency, round(Monetary, 2) AS Monetary FROM rfm",
    "A1_compute_rfm_hours": """
SELECT CustomerID, datesub('day', max(InvoiceDate), TIMESTAMP '2024-02-15 00:00:00') AS Recency,
       count(DISTINCT InvoiceNo) AS Frequency, round(CAST(sum(Revenue) AS DOUBLE), 2) AS Monetary
FROM tx_events GROUP BY CustomerID""",
    "A2_order_values": f"SELECT CustomerID, {rounded('avg_order_value std_order_value', 4)} FROM order_stats",
    "A3_behavioral_features": f"""
SELECT CustomerID, {rounded(LARGE_FEATURES, 4)}, {rounded(SMALL_FEATURES, 6)}, {COUNT_FEATURES} FROM features""",
    "A4_summarize_segments": segment_table(2, "Customer_Count", "Revenue_Share_%"),
    "A5_dashboard_segment_table": segment_table(1, "Customers", "Revenue_Share"),
    "A6_segment_counts": "SELECT Segment, count(*) AS Count FROM segmented GROUP BY Segment",
    "A7_segment_revenue": "SELECT Segment, round(sum(Monetary), 2) AS Monetary FROM segmented GROUP BY Segment",
    "A8_ltv_by_segment": """
SELECT Segment, round_even(avg(Predicted_LTV) * 100e0, 0) / 100e0 AS Avg_LTV,
       round_even(quantile_cont(Predicted_LTV, 0.5) * 100e0, 0) / 100e0 AS Median_LTV,
       round_even(sum(Predicted_LTV) * 100e0, 0) / 100e0 AS Total_LTV
FROM rules GROUP BY Segment""",
    "A9_ltv_tier_summary": """
SELECT LTV_Tier, count(*) AS count, round_even(avg(Predicted_LTV) * 100e0, 0) / 100e0 AS mean,
       round_even(sum(Predicted_LTV) * 100e0, 0) / 100e0 AS sum,
       CASE LTV_Tier WHEN 'Bronze' THEN 0 WHEN 'Silver' THEN 1 WHEN 'Gold' THEN 2 ELSE 3 END AS tier_order
FROM tiers GROUP BY LTV_Tier""",
    "A10_overview_kpis": """
SELECT count(*) AS total_customers, round(sum(Monetary), 2) AS total_revenue, round(avg(Predicted_LTV), 4) AS avg_ltv,
       round(avg(Churn_Probability), 6) AS avg_churn, count(*) FILTER (Segment = 'Champions') AS champions
FROM rules""",
    "A11_rfm_heatmap": """
SELECT R_Score, round(avg(Monetary) FILTER (F_Score = 1), 4) AS F1, round(avg(Monetary) FILTER (F_Score = 2), 4) AS F2,
       round(avg(Monetary) FILTER (F_Score = 3), 4) AS F3, round(avg(Monetary) FILTER (F_Score = 4), 4) AS F4,
       round(avg(Monetary) FILTER (F_Score = 5), 4) AS F5
FROM scored GROUP BY R_Score""",
    "A12_ltv_describe": DESCRIBE.format(value="Predicted_LTV", table="rules"),
    "A12_ltv_describe_12m": DESCRIBE.format(value="LTV_12m", table=f"({LTV_12M})"),
    "A13_churn_rate": """
SELECT round(avg(Churned), 6) AS churn_rate, sum(Churned)::BIGINT AS churned, count(*) AS customers FROM labels_90""",
    "A14_churn_labels": "SELECT CustomerID, Churned FROM labels_90",
    "A15_churn_tier_counts": """
SELECT t AS Churn_Risk_Tier, CAST(i AS INT) AS tier_order, count(CustomerID) AS Customers
FROM (VALUES ('Critical', 0), ('High', 1), ('Medium', 2), ('Low', 3)) v(t, i) LEFT JOIN tiers ON Churn_Risk_Tier = t
GROUP BY t, i""",
    "A16_ltv_tier_counts": """
SELECT t AS LTV_Tier, CAST(i AS INT) AS tier_order, nullif(count(CustomerID), 0) AS Customers
FROM (VALUES ('Platinum', 0), ('Gold', 1), ('Silver', 2), ('Bronze', 3)) v(t, i) LEFT JOIN tiers ON LTV_Tier = t
GROUP BY t, i""",
    "A17_cluster_summary": """
SELECT KMeans_Cluster, round(avg(Recency), 4) AS Recency, round(avg(Frequency), 4) AS Frequency,
       round(avg(Monetary), 4) AS Monetary FROM clustered GROUP BY KMeans_Cluster""",
    "A18_dbscan_counts": """
SELECT count(DISTINCT DBSCAN_Cluster) FILTER (DBSCAN_Cluster <> -1) AS clusters,
       count(*) FILTER (DBSCAN_Cluster = -1) AS noise FROM clustered""",
    "A19_ltv_histogram": """
SELECT bin, round(low + bin * ((high - low) / 40), 4) AS bin_start, count(*) AS customers
FROM (SELECT CAST(least(floor((Predicted_LTV - low) * 40 / (high - low)), 39) AS INT) AS bin, low, high
      FROM rules, (SELECT min(Predicted_LTV) AS low, max(Predicted_LTV) AS high FROM rules))
GROUP BY bin, low, high""",
    "A19_churn_histogram": """
SELECT Churn_Risk_Tier, bin, round(low + bin * ((high - low) / 50), 6) AS bin_start, count(*) AS customers
FROM (SELECT Churn_Risk_Tier, CAST(least(floor((Churn_Probability - low) * 50 / (high - low)), 49) AS INT) AS bin, low, high
      FROM tiers, (SELECT min(Churn_Probability) AS low, max(Churn_Probability) AS high FROM tiers))
GROUP BY Churn_Risk_Tier, bin, low, high""",
    "W1_global_rank": "SELECT CustomerID, F_Rank, M_Rank FROM ranked",
    "W2_quantile_bin_rank": """
SELECT CustomerID, Frequency, CAST(greatest(1, ((F_Rank - 1) * 7 + n - 2) // (n - 1)) AS INT) AS F_Score FROM ranked""",
    "W3_quantile_bin_value": "SELECT CustomerID, Recency, R_Score FROM scored",
    "W4_score_rfm": """
SELECT CustomerID, Recency, Frequency, round(Monetary, 2) AS Monetary, R_Score, F_Score, M_Score, RFM_Score, RFM_String
FROM scored""",
    "W5_cluster_rank": """
SELECT KMeans_Cluster, CAST(floor(r + (ties - 1) / 2) AS INT) AS Cluster_Rank
FROM (SELECT *, count(*) OVER (PARTITION BY m) AS ties
      FROM (SELECT KMeans_Cluster, m, rank() OVER (ORDER BY m DESC) AS r
            FROM (SELECT KMeans_Cluster, floor(avg(Monetary) / 20000) AS m FROM clustered GROUP BY KMeans_Cluster)))""",
    "J2_cluster_rank_lookup": """
SELECT CustomerID, KMeans_Cluster, CAST(Cluster_Rank AS INT) AS Cluster_Rank
FROM clustered LEFT JOIN (SELECT KMeans_Cluster, rank() OVER (ORDER BY avg(Monetary) DESC) AS Cluster_Rank
                          FROM clustered GROUP BY KMeans_Cluster) AS ranks USING (KMeans_Cluster)
WHERE KMeans_Cluster <> 3 UNION ALL SELECT CustomerID, KMeans_Cluster, NULL FROM clustered WHERE KMeans_Cluster = 3""",
    "W8_fixed_bins": "SELECT CustomerID, Churn_Probability, Churn_Risk_Tier FROM tiers",
    "W9_quantile_tiers": "SELECT CustomerID, Predicted_LTV, LTV_Tier FROM tiers",
    "W10_share_of_total": """
SELECT Segment, round(sum(Monetary) / (SELECT sum(Monetary) FROM segmented) * 100, 6) AS share
FROM segmented GROUP BY Segment""",
    "W11_threshold_flag": "SELECT CustomerID, Churn_Probability, Churn_Predicted FROM tiers",
    "T1_top_at_risk": """
SELECT CustomerID, Segment, round(Monetary, 2) AS Monetary, Predicted_LTV, Churn_Probability, Churn_Risk_Tier
FROM tiers WHERE Churn_Risk_Tier IN ('Critical', 'High') ORDER BY Churn_Probability DESC, CustomerID LIMIT 20""",
    "T5_best_model": """
SELECT model, round(auc_roc, 6) AS auc_roc
FROM (SELECT Country AS model, avg(CAST(Churned AS DOUBLE)) AS auc_roc, row_number() OVER (ORDER BY Country) AS position
      FROM homes JOIN labels_90 USING (CustomerID) GROUP BY Country)
WHERE auc_roc > 0 ORDER BY auc_roc DESC, position LIMIT 1""",
    "C1_standardize": f"SELECT CustomerID, {rounded('Recency Frequency Monetary', 6)} FROM scaled",
    "C3_silhouette_given": """
WITH apart AS (
  SELECT p.CustomerID AS id, r.KMeans_Cluster AS own, t.KMeans_Cluster AS other,
         sum(sqrt((p.Recency - q.Recency) * (p.Recency - q.Recency) + (p.Frequency - q.Frequency) * (p.Frequency - q.Frequency)
                  + (p.Monetary - q.Monetary) * (p.Monetary - q.Monetary))) AS d, count(*) AS n
  FROM scaled p JOIN clustered r USING (CustomerID), scaled q JOIN clustered t USING (CustomerID) GROUP BY ALL),
sides AS (
  SELECT id, max(n) FILTER (own = other) AS n, max(d / greatest(n - 1, 1)) FILTER (own = other) AS a,
         min(d / n) FILTER (own <> other) AS b FROM apart GROUP BY id)
SELECT round(avg(CASE WHEN n < 2 OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette,
       CAST(0 AS DOUBLE) AS error FROM sides""",
    "C4_dbscan_core": "SELECT CustomerID, CustomerID IN (SELECT id FROM cores) AS Is_Core FROM rfm",
    "C4_dbscan_outliers": DENSITY.format(table="rfm", pairs="pairs", cores="cores", edges="core_edges"),
    "C4_dbscan_profile": DENSITY.format(
        table="features", pairs="profile_pairs", cores="profile_cores", edges="profile_edges"
    ),
    "R1_cohort_assign": """
SELECT CustomerID, CohortMonth, Period, round(CAST(revenue AS DOUBLE), 2) AS Revenue, orders AS Orders FROM placed WHERE Period < 12""",
    "R2_cohort_retention": """
SELECT CohortMonth, Period, CohortSize, Active, round(Active / CohortSize, 6) AS Retention FROM cohorts""",
    "R3_retention_matrix": "SELECT strftime(CohortMonth, '%b %Y') AS Cohort, CohortMonth, "
    + ", ".join(f"round(max(Active / CohortSize) FILTER (Period = {p}), 6) AS Month_{p}" for p in range(12))
    + " FROM cohorts GROUP BY CohortMonth",
    "R4_cohort_revenue": """
SELECT CohortMonth, Period, CohortSize, round(CAST(Revenue AS DOUBLE), 2) AS Revenue, round(c, 2) AS CumulativeRevenue,
       round(c / CohortSize, 4) AS CumulativePerCustomer
FROM (SELECT *, CAST(sum(Revenue) OVER (PARTITION BY CohortMonth ORDER BY Period) AS DOUBLE) AS c FROM cohorts)""",
    "R5_engagement_curve": """
SELECT Period, count(*) AS Cohorts, sum(CohortSize)::BIGINT AS Customers, sum(Active)::BIGINT AS Active,
       round(sum(Active) / sum(CohortSize), 6) AS Retention, round(sum(Orders) / sum(Active), 6) AS OrdersPerActive
FROM cohorts GROUP BY Period""",
    "M1_ltv_dataset": "SELECT CustomerID, round(ln(1 + total_revenue), 6) AS y, "
    + rounded("avg_order_value std_order_value avg_unit_price max_unit_price revenue_per_item", 4)
    + ", "
    + rounded(SMALL_FEATURES, 6)
    + ", "
    + ", ".join(
        f"{c}::DOUBLE AS {c}"
        for c in "total_orders total_items unique_products unique_categories customer_age_days recency_days "
        "purchase_span_days is_multi_country".split()
    )
    + " FROM features",
    "M2_churn_dataset": "SELECT CustomerID, Churned, "
    + rounded("Monetary avg_order_value std_order_value", 4)
    + ", "
    + rounded("avg_days_between_orders purchase_frequency_per_month product_diversity_ratio", 6)
    + ", "
    + ", ".join(
        f"{c}::DOUBLE AS {c}"
        for c in "Recency Frequency total_orders unique_products unique_categories customer_age_days "
        "purchase_span_days is_multi_country".split()
    )
    + " FROM features JOIN labels_90 USING (CustomerID)",
    "M5_regression_metrics": """
SELECT round(sqrt(avg((y - prediction) ** 2)), 6) AS rmse, round(avg(abs(y - prediction)), 6) AS mae,
       round(1 - sum((y - prediction) ** 2) / (var_pop(y) * count(*)), 6) AS r2 FROM value_scores""",
    "M7_classification_report": """
WITH c AS (SELECT count(*) FILTER (label = 0 AND prediction = 0)::DOUBLE AS tn, count(*) FILTER (label = 0 AND prediction = 1)::DOUBLE AS fp,
                  count(*) FILTER (label = 1 AND prediction = 0)::DOUBLE AS fn, count(*) FILTER (label = 1 AND prediction = 1)::DOUBLE AS tp FROM scores),
r AS (SELECT 'Active' AS class, coalesce(tn / nullif(tn + fn, 0), 0) AS p, coalesce(tn / nullif(tn + fp, 0), 0) AS r, tn + fp AS s FROM c
      UNION ALL SELECT 'Churned', coalesce(tp / nullif(tp + fp, 0), 0), coalesce(tp / nullif(tp + fn, 0), 0), tp + fn FROM c),
f AS (SELECT *, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f1 FROM r)
SELECT class, round(p, 6) AS precision, round(r, 6) AS recall, round(f1, 6) AS f1_score, s::BIGINT AS support FROM f
UNION ALL SELECT 'accuracy', round((tn + tp) / (tn + fp + fn + tp), 6), round((tn + tp) / (tn + fp + fn + tp), 6),
                 round((tn + tp) / (tn + fp + fn + tp), 6), (tn + fp + fn + tp)::BIGINT FROM c
UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f1), 6), sum(s)::BIGINT FROM f
UNION ALL SELECT 'weighted avg', round(sum(p * s) / sum(s), 6), round(sum(r * s) / sum(s), 6), round(sum(f1 * s) / sum(s), 6), sum(s)::BIGINT FROM f""",
    "M8_roc_auc": """
SELECT round(sum(pos * (all_neg - fp + neg / 2)) / (max(all_pos) * max(all_neg)), 6) AS roc_auc FROM curve""",
    "M9_average_precision": """
SELECT round(sum(CAST(pos AS DOUBLE) / all_pos * (CAST(tp AS DOUBLE) / (tp + fp))), 6) AS avg_precision FROM curve""",
    "M10_roc_points": """
SELECT round(CAST(fp AS DOUBLE) / all_neg, 6) AS fpr, round(CAST(tp AS DOUBLE) / all_pos, 6) AS tpr, threshold FROM curve
UNION ALL SELECT 0e0, 0e0, CAST('Infinity' AS DOUBLE)""",
    "M11_pr_points": """
SELECT round(precision, 6) AS precision, round(recall, 6) AS recall, threshold FROM pr
UNION ALL SELECT 1e0, 0e0, CAST(NULL AS DOUBLE)""",
    "M12_tune_threshold": """
SELECT threshold, round(precision, 6) AS precision, round(recall, 6) AS recall
FROM pr WHERE recall >= 75e-2 ORDER BY precision DESC, threshold LIMIT 1""",
    "M13_score_churn": """
SELECT CustomerID, Churn_Probability, Churn_Predicted, Churn_Risk_Tier FROM tiers""",
    "M14_score_ltv": """
SELECT CustomerID, round(ln(1 + Predicted_LTV), 6) AS Predicted_LTV_Log, round(Predicted_LTV, 4) AS Predicted_LTV, LTV_Tier
FROM tiers""",
    "M16_shap_fixed_trees": SHAPLEY
    + """SELECT CustomerID, round(max(CASE WHEN i = 0 THEN v END), 6) AS base_value, round(max(CASE WHEN i = 7 THEN v END), 6) AS margin,
       round(sum(CASE WHEN r THEN within * v ELSE -without * v END), 6) AS "shap_Recency",
       round(sum(CASE WHEN f THEN within * v ELSE -without * v END), 6) AS "shap_Frequency",
       round(sum(CASE WHEN m THEN within * v ELSE -without * v END), 6) AS "shap_Monetary"
FROM weighed GROUP BY CustomerID""",
    "T2_top_features_given": SHAPLEY
    + """, each AS (
  SELECT sum(CASE WHEN r THEN within * v ELSE -without * v END) AS a, sum(CASE WHEN f THEN within * v ELSE -without * v END) AS b,
         sum(CASE WHEN m THEN within * v ELSE -without * v END) AS c FROM weighed GROUP BY CustomerID),
means AS (SELECT 'Recency' AS feature, avg(abs(a)) AS s FROM each UNION ALL SELECT 'Frequency', avg(abs(b)) FROM each
          UNION ALL SELECT 'Monetary', avg(abs(c)) FROM each)
SELECT feature, round(s, 4) AS mean_abs_shap FROM means ORDER BY s DESC, feature LIMIT 2""",
    "L1_rfm_t_summary": "SELECT CustomerID, frequency, recency, T, round(monetary_value, 4) AS monetary_value FROM summary",
    "L2_returning_customers": """
SELECT CustomerID, frequency, recency, T, round(monetary_value, 4) AS monetary_value FROM summary WHERE frequency > 0""",
    "L3_bgnbd_loglik": """
SELECT round(sum(lgamma(12e-1 + x) - lgamma(12e-1) + 12e-1 * ln(200) + lgamma(38e-1) + lgamma(3 + x) - lgamma(3)
             - lgamma(38e-1 + x)
             + CASE WHEN x > 0 THEN greatest(l, g) + ln(1 + exp(least(l, g) - greatest(l, g))) ELSE l END), 4) AS loglik,
       count(*) AS customers
FROM (SELECT frequency::DOUBLE AS x, -(12e-1 + frequency) * ln(200 + T) AS l,
             ln(8e-1) - ln(3e0 + greatest(frequency, 1) - 1) - (12e-1 + frequency) * ln(200 + recency) AS g FROM summary)""",
    "L4_bgnbd_derivatives": differences(
        {"r": 1.2, "alpha": 0.2, "a": 0.8, "b": 3.0},
        "lgamma(r + x) - lgamma(r) + r * ln(alpha) + lgamma(a + b) + lgamma(b + x) - lgamma(b) - lgamma(a + b + x)"
        " + ln((alpha + age) ** (-r - x) + CASE WHEN x > 0 THEN a / (b + x - 1) * (alpha + t_x) ** (-r - x) ELSE 0 END)",
        "SELECT frequency::DOUBLE AS x, recency * 0.001::DOUBLE AS t_x, T * 0.001::DOUBLE AS age FROM summary",
    ),
    "L5_gamma_gamma_derivatives": differences(
        {"p": 6.0, "q": 4.0, "v": 0.15},
        "lgamma(p * x + q) - lgamma(p * x) - lgamma(q) + q * ln(v) + (p * x - 1) * ln(m) + p * x * ln(x) - (p * x + q) * ln(v + x * m)",
        "SELECT frequency::DOUBLE AS x, monetary_value / 100000 AS m FROM summary WHERE frequency > 0 AND monetary_value > 0",
    ),
    "L5_gamma_gamma_loglik": """
SELECT round(sum(lgamma(6 * x + 4) - lgamma(6 * x) - lgamma(4) + 4 * ln(15000) + (6 * x - 1) * ln(m) + 6 * x * ln(x)
             - (6 * x + 4) * ln(15000 + x * m)), 4) AS loglik, count(*) AS customers
FROM (SELECT frequency::DOUBLE AS x, monetary_value AS m FROM summary WHERE frequency > 0 AND monetary_value > 0)""",
    "L6_expected_purchases": """
SELECT CustomerID, round(purchases, 6) AS predicted_purchases_12m FROM until WHERE h = 365""",
    "L7_expected_avg_profit": """
SELECT CustomerID, round(6 * (15000 + frequency * monetary_value) / (6 * frequency + 4 - 1), 4) AS expected_avg_profit
FROM summary""",
    "L8_ltv_12m": LTV_12M,
    "W6_random_split": """
SELECT CustomerID, CAST(row_number() OVER (ORDER BY md5(concat(CustomerID, ':42')), CustomerID)
                        <= ceil(CAST(0.2 AS DOUBLE) * count(*) OVER ()) AS INT) AS is_test FROM rfm""",
    "W7_stratified_split": """
SELECT CustomerID, CAST(r <= quota AS INT) AS is_test
FROM (SELECT *, row_number() OVER (PARTITION BY Churned ORDER BY md5(concat(CustomerID, ':42')), CustomerID) AS r FROM labels_90)
JOIN (SELECT Churned, floor(share) + CAST(row_number() OVER (ORDER BY share - floor(share) DESC, Churned)
                                          <= wanted - sum(floor(share)) OVER () AS INT) AS quota
      FROM (SELECT Churned, ceil(CAST(0.2 AS DOUBLE) * sum(count(*)) OVER ()) AS wanted,
                   ceil(CAST(0.2 AS DOUBLE) * sum(count(*)) OVER ()) * count(*) / sum(count(*)) OVER () AS share
            FROM labels_90 GROUP BY Churned)) USING (Churned)""",
    "S4_run_log": """
SELECT 'Customer_Segmentation' AS experiment, 'profile' AS run, 'param' AS kind, k AS key, v AS value
FROM (SELECT count(*) AS n, count(DISTINCT CustomerID) AS u FROM tx),
     LATERAL (VALUES ('dataset', 'transactions'), ('rows', n::VARCHAR), ('cols', '8'), ('unique_customers', u::VARCHAR)) t(k, v)
UNION ALL
SELECT 'Churn_Modeling', 'rule', 'metric', k, v
FROM (SELECT round(sum(pos * (all_neg - fp + neg / 2)) / (max(all_pos) * max(all_neg)), 4) AS auc,
             round(sum(CAST(pos AS DOUBLE) / all_pos * (CAST(tp AS DOUBLE) / (tp + fp))), 4) AS ap FROM curve),
     LATERAL (VALUES ('auc_roc', auc::VARCHAR), ('avg_precision', ap::VARCHAR)) t(k, v)""",
    "B1_interpurchase_variance": """
SELECT CustomerID, count(*) AS purchase_days, round(avg(g), 6) AS mean_gap_days, round(var_samp(g), 4) AS var_gap_days,
       round(sqrt(var_samp(g)) / avg(g), 6) AS cv_gap_days FROM gaps GROUP BY CustomerID""",
    "B2_basket_stats": """
SELECT CustomerID, count(*) AS baskets, """
    + ", ".join(
        f"round(avg({c}), 6) AS avg_{c}, round(coalesce(stddev_samp({c}), 0), 6) AS std_{c}, min({c}) AS min_{c}, "
        f"median({c}) AS median_{c}, max({c}) AS max_{c}"
        for c in ("items", "lines")
    )
    + " FROM baskets GROUP BY CustomerID",
    "B3_category_affinity": """
SELECT CustomerID, count(*) AS categories, first(category ORDER BY r DESC, category) AS top_category,
       round(max(r)::DOUBLE / sum(r)::DOUBLE, 6) AS top_share,
       round(ln(sum(r)::DOUBLE) - sum(r::DOUBLE * ln(r::DOUBLE)) / sum(r)::DOUBLE, 6) AS category_entropy
FROM categories GROUP BY CustomerID""",
    "B4_channel_mix": mix("Channel"),
    "B5_promo_sensitivity": mix("Offer"),
}


def oracles() -> dict[str, str]:
    made = {}
    for name, body in BODIES.items():
        made[name] = merge_with(body)
    return made


def merge_with(body: str) -> str:
    """A body that starts with its own WITH list joins it to the shared one."""
    text = body.strip()
    for opening in ("WITH RECURSIVE ", "WITH "):
        if text.startswith(opening):
            shared = query(text).removesuffix(text).strip().removeprefix("WITH ")
            return f"{opening}{shared}, {text.removeprefix(opening)}" if shared else text
    return query(text)

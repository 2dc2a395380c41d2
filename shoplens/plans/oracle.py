"""Independent SQL for the registered queries, run by DuckDB on the same tables.

Each query is a SELECT over shared CTEs; unused CTEs cost nothing. ``model_sql`` repeats the fits of the
churn models. Queries without SQL (other fits) have a check query beside them, whose SQL gives the
rows and what must hold of them.
"""

from shoplens.plans import model_sql

RAW_COLUMNS = (
    "InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice, CustomerID, Country"
)

SHARED = f"""
kept AS (
  SELECT o_orderkey, o_custkey, o_orderdate,
    CASE WHEN o_custkey % 5 = 0 THEN 1000000000000 + o_orderkey ELSE o_custkey END AS buyer
  FROM orders),
single AS (
  SELECT
    CASE WHEN l_returnflag = 'R' AND o_orderkey % 7 = 0 THEN 'C'
         WHEN o_orderkey % 211 = 0 THEN 'A' ELSE '' END || CAST(o_orderkey AS VARCHAR) AS InvoiceNo,
    CASE WHEN l_partkey % 97 = 0 THEN 'post' WHEN l_partkey % 89 = 0 THEN 'D'
         ELSE CAST(l_partkey AS VARCHAR) END AS StockCode,
    CASE WHEN l_partkey % 43 = 0 THEN NULL ELSE p_name END AS Description,
    CASE WHEN (o_orderkey + l_linenumber) % 53 = 0 THEN -1 ELSE 1 END
      * CAST(l_quantity AS INTEGER) AS Quantity,
    o_orderdate + to_seconds((o_orderkey * 7919) % 86400) AS InvoiceDate,
    CASE WHEN (l_partkey + l_suppkey) % 61 = 0 THEN CAST(0 AS DECIMAL(12,2))
         ELSE CAST(p_retailprice AS DECIMAL(12,2)) END AS UnitPrice,
    CASE WHEN o_custkey % 41 = 0 THEN NULL ELSE buyer END AS CustomerID,
    n_name AS Country,
    (o_orderkey + l_linenumber) % 67 = 0 AS twice
  FROM lineitem JOIN kept ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
retail_raw AS (
  SELECT {RAW_COLUMNS} FROM single UNION ALL SELECT {RAW_COLUMNS} FROM single WHERE twice),
identified AS (SELECT * FROM retail_raw WHERE CustomerID IS NOT NULL),
clean AS (
  SELECT *, CAST(CAST(Quantity AS DECIMAL(11,0)) * UnitPrice AS DECIMAL(23,2)) AS TotalPrice
  FROM (SELECT DISTINCT * FROM identified
        WHERE NOT (InvoiceNo LIKE 'C%' OR InvoiceNo LIKE 'A%')
          AND upper(StockCode) NOT IN ('POST', 'D', 'M', 'BANK CHARGES', 'PADS', 'DOT', 'CRUK')
          AND Quantity > 0 AND UnitPrice > 0)),
dates AS (
  SELECT max(InvoiceDate) AS last_date, max(InvoiceDate) + INTERVAL 1 DAY AS today,
         max(InvoiceDate) - INTERVAL 90 DAY AS cutoff FROM clean),
rfm AS (
  SELECT CustomerID, date_sub('day', max(InvoiceDate), (SELECT today FROM dates)) AS Recency,
         count(DISTINCT InvoiceNo) AS Frequency, sum(TotalPrice) AS Monetary
  FROM clean GROUP BY CustomerID),
rfm_edges AS (
  SELECT quantile_cont(Recency::DOUBLE, 0.2) AS r1, quantile_cont(Recency::DOUBLE, 0.4) AS r2,
         quantile_cont(Recency::DOUBLE, 0.6) AS r3, quantile_cont(Recency::DOUBLE, 0.8) AS r4,
         quantile_cont(Monetary::DOUBLE, 0.2) AS m1, quantile_cont(Monetary::DOUBLE, 0.4) AS m2,
         quantile_cont(Monetary::DOUBLE, 0.6) AS m3, quantile_cont(Monetary::DOUBLE, 0.8) AS m4,
         count(*) AS n
  FROM rfm),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY Frequency, CustomerID) AS FrequencyRank FROM rfm),
scored AS (
  SELECT CustomerID, Recency, Frequency, Monetary,
    5 - (Recency > r1)::INT - (Recency > r2)::INT - (Recency > r3)::INT - (Recency > r4)::INT
      AS R_Score,
    CAST(greatest(1, (5 * (FrequencyRank - 1) + n - 2) // greatest(n - 1, 1)) AS INT) AS F_Score,
    1 + (Monetary::DOUBLE > m1)::INT + (Monetary::DOUBLE > m2)::INT
      + (Monetary::DOUBLE > m3)::INT + (Monetary::DOUBLE > m4)::INT AS M_Score
  FROM ranked, rfm_edges),
segments AS (
  SELECT *, R_Score::VARCHAR || F_Score::VARCHAR || M_Score::VARCHAR AS RFM_Score,
    R_Score + F_Score + M_Score AS RFM_Sum,
    CASE WHEN R_Score >= 4 AND F_Score >= 4 AND M_Score >= 4 THEN 'Champions'
         WHEN R_Score >= 3 AND F_Score >= 3 AND M_Score >= 3 THEN 'Loyal Customers'
         WHEN R_Score >= 4 AND F_Score <= 2 THEN 'New Customers'
         WHEN R_Score >= 3 AND F_Score <= 2 AND M_Score <= 2 THEN 'Promising'
         WHEN R_Score <= 2 AND F_Score >= 4 AND M_Score >= 4 THEN 'Can''t Lose Them'
         WHEN R_Score <= 2 AND F_Score >= 3 AND M_Score >= 3 THEN 'At Risk'
         WHEN R_Score <= 2 AND F_Score <= 2 AND M_Score <= 2 THEN 'Lost'
         WHEN R_Score = 3 AND F_Score = 3 THEN 'Need Attention'
         ELSE 'Others' END AS Segment
  FROM scored),
live_base AS (
  SELECT CustomerID, date_sub('day', max(InvoiceDate), (SELECT today FROM dates)) AS Recency,
    count(DISTINCT InvoiceNo) AS Frequency, sum(TotalPrice) AS Monetary,
    count(DISTINCT StockCode) AS UniqueProducts, avg(Quantity) AS AvgQuantity,
    date_sub('day', min(InvoiceDate), (SELECT today FROM dates)) AS Tenure
  FROM clean GROUP BY CustomerID),
live AS (
  SELECT *, Monetary::DOUBLE / Frequency AS AvgOrderValue,
    CASE WHEN Frequency > 1 THEN Tenure / Frequency::DOUBLE ELSE Tenure::DOUBLE END
      AS AvgDaysBetweenPurchases,
    Recency / (Tenure + 1.0::DOUBLE) AS ChurnProbability
  FROM live_base),
observed AS (SELECT * FROM clean WHERE InvoiceDate <= (SELECT cutoff FROM dates)),
holdout AS (SELECT * FROM clean WHERE InvoiceDate > (SELECT cutoff FROM dates)),
feature_base AS (
  SELECT CustomerID, date_sub('day', max(InvoiceDate), (SELECT cutoff FROM dates)) AS Recency,
    count(DISTINCT InvoiceNo) AS Frequency, sum(TotalPrice) AS Monetary,
    count(DISTINCT StockCode) AS UniqueProducts, avg(Quantity) AS AvgQuantity,
    date_sub('day', min(InvoiceDate), (SELECT cutoff FROM dates)) AS Tenure
  FROM observed GROUP BY CustomerID),
features AS (
  SELECT *, Monetary::DOUBLE / Frequency AS AvgOrderValue,
    CASE WHEN Frequency > 1 THEN Tenure / Frequency::DOUBLE ELSE Tenure::DOUBLE END
      AS AvgDaysBetweenPurchases
  FROM feature_base),
labelled AS (
  SELECT f.*, CASE WHEN h.CustomerID IS NULL THEN 1 ELSE 0 END AS Churned,
    f.Recency / (f.Tenure + 1.0::DOUBLE) AS ChurnProbability
  FROM features f LEFT JOIN (SELECT DISTINCT CustomerID FROM holdout) h USING (CustomerID)),
valued_edges AS (
  SELECT quantile_cont(Monetary::DOUBLE, 0.5) AS v1, quantile_cont(Monetary::DOUBLE, 0.8) AS v2,
    quantile_cont(Monetary::DOUBLE, 0.97) AS v97, quantile_cont(Monetary::DOUBLE, 0.95) AS v95,
    quantile_cont(ChurnProbability, 1.0::DOUBLE / 3) AS p1,
    quantile_cont(ChurnProbability, 2.0::DOUBLE / 3) AS p2
  FROM live),
valued AS (
  SELECT CustomerID, Monetary::DOUBLE AS CLV_12m,
    CASE WHEN Monetary::DOUBLE > v2 THEN 'High Value' WHEN Monetary::DOUBLE > v1 THEN 'Mid Value'
         ELSE 'Low Value' END AS CLV_Tier
  FROM live, valued_edges),
clustered AS (
  SELECT *, CAST(CustomerID % 4 AS INT) AS Cluster FROM segments),
known_clustered AS (SELECT * FROM clustered WHERE CustomerID % 29 <> 0),
merged AS (
  SELECT l.CustomerID, l.ChurnProbability, l.Recency, l.Frequency, l.Monetary,
    CASE WHEN l.ChurnProbability > p2 THEN 'High Risk' WHEN l.ChurnProbability > p1
         THEN 'Medium Risk' ELSE 'Low Risk' END AS ChurnRiskTier,
    s.Segment, s.Cluster, v.CLV_12m, v.CLV_Tier
  FROM live l CROSS JOIN valued_edges
  LEFT JOIN known_clustered s USING (CustomerID)
  LEFT JOIN (SELECT * FROM valued WHERE CustomerID % 29 <> 0) v USING (CustomerID)),
matrix(CLV_Tier, ChurnRiskTier, Recommendation, Priority, Action) AS (VALUES
  ('High Value', 'High Risk', 'URGENT: VIP Win-back', 1,
   'Personal outreach + exclusive offer; highest priority, do not lose'),
  ('High Value', 'Medium Risk', 'Proactive Loyalty', 2,
   'Early access, loyalty rewards, relationship check-in'),
  ('High Value', 'Low Risk', 'Nurture & Upsell', 3,
   'Cross-sell premium items, referral incentives'),
  ('Mid Value', 'High Risk', 'Automated Win-back', 4,
   'Targeted email campaign with moderate discount'),
  ('Mid Value', 'Medium Risk', 'Engagement Campaign', 5,
   'Personalized product recommendations'),
  ('Mid Value', 'Low Risk', 'Standard Loyalty', 6, 'Newsletter, seasonal offers'),
  ('Low Value', 'High Risk', 'Low-cost Automation Only', 7,
   'Generic re-engagement email; retention spend not justified by CLV'),
  ('Low Value', 'Medium Risk', 'Monitor', 8, 'No proactive action; track for tier changes'),
  ('Low Value', 'Low Risk', 'Minimal Spend', 9, 'Standard mass marketing only')),
business AS (
  SELECT m.*, coalesce(x.Recommendation, 'Unknown') AS Recommendation,
    coalesce(x.Priority, 99) AS Priority,
    coalesce(x.Action, 'Review customer manually') AS Action
  FROM merged m LEFT JOIN matrix x USING (CLV_Tier, ChurnRiskTier)),
customer_days AS (
  SELECT CustomerID, CAST(InvoiceDate AS DATE) AS Day, sum(TotalPrice) AS Spend
  FROM clean GROUP BY ALL),
summary AS (
  SELECT CustomerID, count(*) - 1 AS frequency, date_diff('day', min(Day), max(Day)) AS recency,
    date_diff('day', min(Day), (SELECT CAST(last_date AS DATE) FROM dates)) AS T,
    CASE WHEN count(*) > 1
         THEN CAST(sum(Spend) - arg_min(Spend, Day) AS DOUBLE) / (count(*) - 1)
         ELSE 0.0::DOUBLE END AS monetary_value
  FROM customer_days GROUP BY CustomerID),
invoices AS (
  SELECT InvoiceNo, sum(TotalPrice) AS InvoiceValue FROM clean GROUP BY InvoiceNo),
purchases AS (
  SELECT CustomerID, count(DISTINCT InvoiceNo) AS Invoices FROM clean GROUP BY CustomerID),
countries AS (SELECT Country, sum(TotalPrice) AS Revenue FROM clean GROUP BY Country),
logged AS (
  SELECT CustomerID, ln(1 + Recency::DOUBLE) AS r, ln(1 + Frequency::DOUBLE) AS f,
    ln(1 + Monetary::DOUBLE) AS m FROM rfm),
log_stats AS (
  SELECT avg(r) AS ra, stddev_pop(r) AS rs, avg(f) AS fa, stddev_pop(f) AS fs,
    avg(m) AS ma, stddev_pop(m) AS ms FROM logged),
scaled AS MATERIALIZED (
  SELECT CustomerID, (r - ra) / rs AS Recency, (f - fa) / fs AS Frequency, (m - ma) / ms AS Monetary
  FROM logged, log_stats),
centers(Cluster, cr, cf, cm) AS (VALUES
  (0, -1.0::DOUBLE, 1.0::DOUBLE, 1.0::DOUBLE), (1, -0.5::DOUBLE, -0.5::DOUBLE, -0.5::DOUBLE),
  (2, 0.5::DOUBLE, 0.5::DOUBLE, 0.0::DOUBLE), (3, 1.0::DOUBLE, -1.0::DOUBLE, -1.0::DOUBLE)),
assigned AS MATERIALIZED (
  SELECT CustomerID, Recency, Frequency, Monetary, Cluster, d2
  FROM (SELECT s.*, c.Cluster,
          (Recency - cr) * (Recency - cr) + (Frequency - cf) * (Frequency - cf)
            + (Monetary - cm) * (Monetary - cm) AS d2
        FROM scaled s CROSS JOIN centers c)
  QUALIFY row_number() OVER (PARTITION BY CustomerID ORDER BY d2, Cluster) = 1),
correlations AS (
  SELECT corr(Recency, Frequency) AS c12, corr(Recency, Monetary) AS c13,
    corr(Frequency, Monetary) AS c23 FROM scaled),
spread AS (SELECT *, sqrt((c12 * c12 + c13 * c13 + c23 * c23) / 3) AS s FROM correlations),
eigen AS (
  SELECT *, 1 + 2 * s * cos(acos(c12 * c13 * c23 / (s * s * s)) / 3) AS e1,
    1 + 2 * s * cos(acos(c12 * c13 * c23 / (s * s * s)) / 3 - 2 * pi() / 3) AS e2 FROM spread),
directions AS (
  SELECT k, x / len AS x, y / len AS y, z / len AS z FROM (
    SELECT *, CASE WHEN (CASE WHEN abs(x) >= abs(y) AND abs(x) >= abs(z) THEN x
                              WHEN abs(y) >= abs(z) THEN y ELSE z END) >= 0 THEN 1 ELSE -1 END
              * sqrt(x * x + y * y + z * z) AS len
    FROM (SELECT k, c12 * c23 - c13 * (1 - e) AS x, c12 * c13 - c23 * (1 - e) AS y,
            (1 - e) * (1 - e) - c12 * c12 AS z
          FROM (SELECT 1 AS k, c12, c13, c23, e1 AS e FROM eigen
                UNION ALL SELECT 2, c12, c13, c23, e2 FROM eigen)))),
class_rows AS (SELECT Churned, count(*) AS n FROM labelled GROUP BY Churned),
split_sizes AS (
  SELECT Churned, n, want, n * want // total AS base, n * want % total AS rest, total
  FROM (SELECT *, CAST(ceil(0.25 * total) AS BIGINT) AS want
        FROM (SELECT *, sum(n) OVER () AS total FROM class_rows))),
test_sizes AS (
  SELECT Churned,
    base + CASE WHEN row_number() OVER (ORDER BY rest DESC, Churned)
                     <= want - sum(base) OVER () THEN 1 ELSE 0 END AS size
  FROM split_sizes),
cells AS (
  SELECT count(*) FILTER (Churned = 0 AND ChurnProbability <= 0.5) AS tn,
    count(*) FILTER (Churned = 0 AND ChurnProbability > 0.5) AS fp,
    count(*) FILTER (Churned = 1 AND ChurnProbability <= 0.5) AS fn,
    count(*) FILTER (Churned = 1 AND ChurnProbability > 0.5) AS tp
  FROM labelled),
models AS (
  SELECT 'Recency over tenure' AS Model, 0 AS pos, Churned, Recency / (Tenure + 1.0::DOUBLE) AS p
  FROM labelled
  UNION ALL SELECT 'Inverse frequency', 1, Churned, 1.0::DOUBLE / Frequency FROM labelled
  UNION ALL SELECT 'Few products', 2, Churned, 10.0::DOUBLE / (UniqueProducts + 9.0::DOUBLE)
  FROM labelled),
model_steps AS (
  SELECT Model, pos, p, sum(Churned) AS plus, sum(1 - Churned) AS minus
  FROM models GROUP BY ALL),
model_auc AS (
  SELECT Model, sum(plus * (below + minus / 2.0::DOUBLE)) / (sum(plus) * sum(minus)) AS auc
  FROM (SELECT *, coalesce(sum(minus) OVER (PARTITION BY Model ORDER BY p
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
        FROM model_steps)
  GROUP BY Model),
model_metrics AS (
  SELECT Model, pos, round_even((tp + tn) / total, 4) AS Accuracy,
    round_even(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END, 4) AS "Precision",
    round_even(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END, 4) AS Recall,
    round_even(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END, 4)
      AS F1,
    round_even(auc, 4) AS "ROC-AUC"
  FROM (SELECT Model, pos, count(*)::DOUBLE AS total,
          count(*) FILTER (Churned = 0 AND p <= 0.5)::DOUBLE AS tn,
          count(*) FILTER (Churned = 0 AND p > 0.5)::DOUBLE AS fp,
          count(*) FILTER (Churned = 1 AND p <= 0.5)::DOUBLE AS fn,
          count(*) FILTER (Churned = 1 AND p > 0.5)::DOUBLE AS tp
        FROM models GROUP BY Model, pos) JOIN model_auc USING (Model)),
score_steps AS (
  SELECT ChurnProbability AS score, sum(Churned) AS plus, sum(1 - Churned) AS minus
  FROM labelled GROUP BY ALL),
alive AS (
  SELECT *, CASE WHEN frequency = 0 THEN 1.0::DOUBLE ELSE
      1 / (1 + 1.6::DOUBLE / (4 + frequency - 1)
             * power((20.0::DOUBLE + T) / (20.0::DOUBLE + recency), 0.9::DOUBLE + frequency)) END
      AS ProbAlive,
    CASE WHEN frequency = 0 THEN 6 * 15 / 3.0::DOUBLE ELSE
      3 / (6.0::DOUBLE * frequency + 3) * 30
      + 6.0::DOUBLE * frequency / (6.0::DOUBLE * frequency + 3) * monetary_value END
      AS ExpectedSpend
  FROM summary)
"""

def _raw_rows(source: str, customer: str = "CustomerID") -> str:
    return f"""SELECT InvoiceNo, StockCode, Description, Quantity,
      strftime(InvoiceDate, '%Y-%m-%d %H:%M:%S') AS InvoiceDate, UnitPrice::DOUBLE AS UnitPrice,
      {customer} AS CustomerID, Country FROM {source}"""


def _clean_rows(source: str) -> str:
    return f"""SELECT InvoiceNo, StockCode, Description, Quantity,
      strftime(InvoiceDate, '%Y-%m-%d %H:%M:%S') AS InvoiceDate, UnitPrice::DOUBLE AS UnitPrice,
      CustomerID, Country, TotalPrice::DOUBLE AS TotalPrice FROM {source}"""


SEGMENT_ROWS = """SELECT CustomerID, Recency, Frequency, Monetary::DOUBLE AS Monetary, R_Score,
  F_Score, M_Score, RFM_Score, RFM_Sum, Segment FROM segments"""

FEATURE_COLUMNS = """CustomerID, Recency, Frequency, Monetary::DOUBLE AS Monetary, UniqueProducts,
  AvgQuantity, Tenure, AvgOrderValue, AvgDaysBetweenPurchases"""

BUSINESS_COLUMNS = """CustomerID, ChurnProbability, Recency, Frequency,
  Monetary::DOUBLE AS Monetary, ChurnRiskTier, Segment, Cluster::VARCHAR AS Cluster, CLV_12m,
  CLV_Tier, Recommendation, Priority, Action"""

PROFILE = """SELECT Cluster, Customers, AvgRecency, AvgFrequency, AvgMonetary, TotalRevenue,
    round_even(Customers / sum(Customers) OVER ()::DOUBLE * 100, 2) AS PctOfCustomers,
    round_even(TotalRevenue / sum(TotalRevenue) OVER () * 100, 2) AS PctOfRevenue
  FROM (SELECT Cluster, count(*) AS Customers, round_even(avg(Recency), 2) AS AvgRecency,
          round_even(avg(Frequency), 2) AS AvgFrequency,
          round_even(avg(Monetary::DOUBLE), 2) AS AvgMonetary,
          round_even(sum(Monetary)::DOUBLE, 2) AS TotalRevenue
        FROM clustered GROUP BY Cluster)"""


def _describe(column: str) -> str:
    value = f"{column}::DOUBLE"
    return f"""SELECT '{column}' AS "Column", count({value}) AS "Count",
      round(avg({value}), 4) AS Mean, round(stddev_samp({value}), 4) AS Std,
      min({value}) AS "Min", round(quantile_cont({value}, 0.25), 4) AS P25,
      round(quantile_cont({value}, 0.5), 4) AS P50, round(quantile_cont({value}, 0.75), 4) AS P75,
      max({value}) AS "Max" FROM rfm"""


def _quantiles(column: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{column}' AS "Column", {p}::DOUBLE AS Share,
        round(quantile_cont({column}::DOUBLE, {p}), 4) AS Quantile FROM rfm"""
        for p in (0.5, 0.95, 0.97)
    )


def _bins(source: str, column: str, bins: int) -> str:
    """Histogram of the values below the 95th percentile, as a subquery with all bins."""
    return f"""(SELECT i::INT AS Bin, low + i * ((high - low) / {bins}) AS BinStart,
        low + (i + 1) * ((high - low) / {bins}) AS BinEnd,
        (SELECT count(*) FROM {source} t
         WHERE t.{column}::DOUBLE < bound AND least(floor((t.{column}::DOUBLE - low)
           / (high - low) * {bins}), {bins} - 1) = i) AS "Rows"
      FROM (SELECT min({column}::DOUBLE) AS low, max({column}::DOUBLE) AS high, any_value(b) AS bound
            FROM {source}, (SELECT quantile_cont({column}::DOUBLE, 0.95) AS b FROM {source})
            WHERE {column}::DOUBLE < b),
           (SELECT unnest(range({bins})) AS i))"""


def _null_rows() -> str:
    kinds = {
        "InvoiceNo": "string", "StockCode": "string", "Description": "string", "Quantity": "int",
        "InvoiceDate": "timestamp_ntz", "UnitPrice": "decimal(14,4)", "CustomerID": "bigint",
        "Country": "string",
    }
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "Column", '{kind}' AS "Type", count(*) AS "Rows",
        count(*) - count({c}) AS "Nulls" FROM retail_raw"""
        for c, kind in kinds.items()
    )


FUNNEL = """SELECT StepNo, Step, RowsBefore, RowsBefore - RowsAfter AS RowsRemoved, RowsAfter FROM (
  SELECT *, lag(RowsAfter) OVER (ORDER BY StepNo) AS RowsBefore FROM (
    SELECT 0 AS StepNo, '' AS Step, count(*) AS RowsAfter FROM retail_raw
    UNION ALL SELECT 1, 'missing customer', count(*) FROM identified
    UNION ALL SELECT 2, 'cancelled or adjusted', count(*) FROM identified
      WHERE left(InvoiceNo, 1) NOT IN ('C', 'A')
    UNION ALL SELECT 3, 'non-product code', count(*) FROM identified
      WHERE left(InvoiceNo, 1) NOT IN ('C', 'A') AND upper(StockCode) NOT IN ('POST', 'D')
    UNION ALL SELECT 4, 'non-positive quantity or price', count(*) FROM identified
      WHERE left(InvoiceNo, 1) NOT IN ('C', 'A') AND upper(StockCode) NOT IN ('POST', 'D')
        AND Quantity > 0 AND UnitPrice > 0
    UNION ALL SELECT 5, 'duplicate row', count(*) FROM clean))
  WHERE StepNo > 0"""

MONTHS = """SELECT CAST(MonthEnd AS VARCHAR) AS MonthEnd, Revenue FROM (
  SELECT last_day(m::DATE) AS MonthEnd, coalesce(Revenue, 0)::DOUBLE AS Revenue
  FROM (SELECT unnest(generate_series(date_trunc('month', min(InvoiceDate))::TIMESTAMP,
          date_trunc('month', max(InvoiceDate))::TIMESTAMP, INTERVAL 1 MONTH)) AS m FROM clean)
  LEFT JOIN (SELECT last_day(InvoiceDate::DATE) AS e, sum(TotalPrice) AS Revenue
             FROM clean GROUP BY 1) ON e = last_day(m::DATE))"""

# Rows of the hypergeometric series of the purchase forecast, for a horizon column h.
ALIVE_PURCHASES = """(SELECT CustomerID, h, (4.6::DOUBLE + frequency) / 0.6::DOUBLE
    * (1 - power(1 - z, 0.6::DOUBLE) * sum(exp(
        lgamma(3.7::DOUBLE + n) - lgamma(3.7::DOUBLE) + lgamma(0.6::DOUBLE + n) - lgamma(0.6::DOUBLE)
        - lgamma(4.6::DOUBLE + frequency + n) + lgamma(4.6::DOUBLE + frequency)
        - lgamma(1.0::DOUBLE + n) + n * ln(z)))) AS purchases
  FROM (SELECT CustomerID, frequency, h, h / (20.0::DOUBLE + T + h) AS z
        FROM summary, (SELECT unnest({horizons})::DOUBLE AS h)),
       (SELECT unnest(range(900))::DOUBLE AS n)
  GROUP BY CustomerID, frequency, h, z)"""

CLV = f"""(SELECT a.CustomerID, any_value(a.frequency) AS frequency,
    any_value(a.ProbAlive) * any_value(a.ExpectedSpend)
      * sum((e.purchases - coalesce(b.purchases, 0)) / power(1.01::DOUBLE, e.h / 30)) AS CLV_12m
  FROM alive a
  JOIN {ALIVE_PURCHASES.format(horizons="generate_series(30, 360, 30)")} e
    ON a.CustomerID = e.CustomerID
  LEFT JOIN {ALIVE_PURCHASES.format(horizons="generate_series(30, 330, 30)")} b
    ON a.CustomerID = b.CustomerID AND b.h = e.h - 30
  GROUP BY a.CustomerID)"""

ROC_POINTS = """SELECT 0.0::DOUBLE AS Fpr, 0.0::DOUBLE AS Tpr, -1.0::DOUBLE AS Threshold
  UNION ALL
  SELECT fp / (sum(minus) OVER ())::DOUBLE, tp / (sum(plus) OVER ())::DOUBLE, round(score, 10)
  FROM (SELECT *, sum(plus) OVER down AS tp, sum(minus) OVER down AS fp,
          lead(plus) OVER down AS next_plus, lead(minus) OVER down AS next_minus,
          row_number() OVER down AS step
        FROM score_steps WINDOW down AS (ORDER BY score DESC))
  QUALIFY step = 1 OR next_plus IS NULL OR next_plus <> plus OR next_minus <> minus"""

REPORT = """WITH c AS (SELECT tn::DOUBLE AS tn, fp::DOUBLE AS fp, fn::DOUBLE AS fn,
    tp::DOUBLE AS tp FROM cells),
  per AS (SELECT *, CASE WHEN tn + fn = 0 THEN 0 ELSE tn / (tn + fn) END AS p0,
    CASE WHEN tn + fp = 0 THEN 0 ELSE tn / (tn + fp) END AS r0,
    CASE WHEN 2 * tn + fp + fn = 0 THEN 0 ELSE 2 * tn / (2 * tn + fp + fn) END AS f0,
    CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS p1,
    CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS r1,
    CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1,
    tn + fp AS n0, tp + fn AS n1, (tp + tn) / (tp + tn + fp + fn) AS acc FROM c)
  SELECT "Class", round("Precision", 8) AS "Precision", round(Recall, 8) AS Recall,
    round(F1, 8) AS F1, Support::BIGINT AS Support FROM (
    SELECT 'Active' AS "Class", p0 AS "Precision", r0 AS Recall, f0 AS F1, n0 AS Support FROM per
    UNION ALL SELECT 'Churned', p1, r1, f1, n1 FROM per
    UNION ALL SELECT 'accuracy', acc, acc, acc, n0 + n1 FROM per
    UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n0 + n1 FROM per
    UNION ALL SELECT 'weighted avg', (p0 * n0 + p1 * n1) / (n0 + n1),
      (r0 * n0 + r1 * n1) / (n0 + n1), (f0 * n0 + f1 * n1) / (n0 + n1), n0 + n1 FROM per)"""


def _silhouette(distance: str) -> str:
    return f"""SELECT round(avg(CASE WHEN own_n = 1 THEN 0 ELSE (b - a) / greatest(a, b) END), 6)
        AS Silhouette
      FROM (SELECT CustomerID, any_value(own_n) AS own_n,
              max(CASE WHEN same THEN total / greatest(n - 1, 1) END) AS a,
              min(CASE WHEN NOT same THEN total / n END) AS b
            FROM (SELECT p.CustomerID, q.Cluster = p.Cluster AS same, count(*) AS n,
                    sum({distance}) AS total,
                    count(*) FILTER (q.Cluster = p.Cluster) AS same_n,
                    any_value(w.n) AS own_n
                  FROM assigned p JOIN (SELECT Cluster, count(*) AS n FROM assigned GROUP BY 1) w
                    ON w.Cluster = p.Cluster, assigned q
                  GROUP BY p.CustomerID, p.Cluster, q.Cluster)
            GROUP BY CustomerID)"""


SQUARED = """((p.Recency - q.Recency) * (p.Recency - q.Recency)
  + (p.Frequency - q.Frequency) * (p.Frequency - q.Frequency)
  + (p.Monetary - q.Monetary) * (p.Monetary - q.Monetary))"""

PCA_POINTS = """SELECT CustomerID,
        round(Recency * a.x + Frequency * a.y + Monetary * a.z, 6) AS PCA1,
        round(Recency * b.x + Frequency * b.y + Monetary * b.z, 6) AS PCA2
        FROM scaled, (SELECT * FROM directions WHERE k = 1) a,
          (SELECT * FROM directions WHERE k = 2) b"""

# The names of the churn features, as columns of the table they come from.
FEATURE_NAMES = """SELECT name AS Term FROM (UNPIVOT (SELECT Recency::DOUBLE AS Recency,
          Frequency::DOUBLE AS Frequency, Monetary::DOUBLE AS Monetary,
          UniqueProducts::DOUBLE AS UniqueProducts, AvgQuantity::DOUBLE AS AvgQuantity,
          Tenure::DOUBLE AS Tenure, AvgOrderValue::DOUBLE AS AvgOrderValue,
          AvgDaysBetweenPurchases::DOUBLE AS AvgDaysBetweenPurchases FROM labelled LIMIT 1)
          ON COLUMNS(*))"""

SPLIT = """SELECT l.CustomerID, l.Churned, CASE WHEN row_number() OVER (
          PARTITION BY l.Churned
          ORDER BY substr(md5(l.CustomerID::VARCHAR || ':42'), 1, 15), l.CustomerID) <= size
        THEN 1 ELSE 0 END AS IsTest FROM labelled l JOIN test_sizes t USING (Churned)"""

SELECTS = {
    # sources and sinks
    "read_raw": _raw_rows("retail_raw", "CustomerID::VARCHAR"),
    "read_clean": _clean_rows("clean"),
    "read_stage_tables": SEGMENT_ROWS,
    "write_csv": SEGMENT_ROWS,
    "write_profile_csv": PROFILE,
    # filters, cleaning and data quality
    "drop_missing_customer": _raw_rows("identified"),
    "drop_cancellations": _raw_rows(
        "retail_raw WHERE left(InvoiceNo, 1) <> 'C' AND left(InvoiceNo, 1) <> 'A'",
        "CustomerID::VARCHAR",
    ),
    "drop_non_product": _raw_rows(
        "retail_raw WHERE upper(StockCode) NOT IN"
        " ('POST', 'D', 'M', 'BANK CHARGES', 'PADS', 'DOT', 'CRUK')",
        "CustomerID::VARCHAR",
    ),
    "drop_nonpositive": _raw_rows(
        "retail_raw WHERE Quantity > 0 AND UnitPrice > 0", "CustomerID::VARCHAR"
    ),
    "dedup_rows": _raw_rows("(SELECT DISTINCT * FROM retail_raw)", "CustomerID::VARCHAR"),
    "clean_transactions": _clean_rows("clean"),
    "cleaning_funnel": FUNNEL,
    "null_profile": _null_rows(),
    "clean_profile": """SELECT count(*) AS "Rows",
        strftime(min(InvoiceDate), '%Y-%m-%d %H:%M:%S') AS FirstDate,
        strftime(max(InvoiceDate), '%Y-%m-%d %H:%M:%S') AS LastDate,
        count(DISTINCT CustomerID) AS Customers, count(DISTINCT InvoiceNo) AS Invoices,
        count(DISTINCT StockCode) AS Products, count(DISTINCT Country) AS Countries,
        sum(TotalPrice)::DOUBLE AS TotalRevenue FROM clean""",
    "merge_missing_counts": """SELECT count(*) - count(Segment) AS MissingSegment,
        count(*) - count(CLV_12m) AS MissingCLV FROM merged""",
    "observation_window": _clean_rows("observed"),
    "holdout_window": _clean_rows("holdout"),
    "trim_below_quantile": """SELECT InvoiceNo, InvoiceValue::DOUBLE AS InvoiceValue FROM invoices
        WHERE InvoiceValue::DOUBLE < (SELECT quantile_cont(InvoiceValue::DOUBLE, 0.95)
                                      FROM invoices)""",
    "repeat_buyers": "SELECT * FROM summary WHERE frequency > 0",
    "repeat_buyer_counts": """SELECT count(*) FILTER (frequency = 0) AS OneTime,
        avg((frequency = 0)::INT) AS OneTimeShare, count(*) FILTER (frequency > 0) AS Repeat,
        avg((frequency > 0)::INT) AS RepeatShare FROM summary""",
    "urgent_customers": f"""SELECT {BUSINESS_COLUMNS} FROM business
        WHERE Recommendation = 'URGENT: VIP Win-back'""",
    "low_priority_customers": f"""SELECT {BUSINESS_COLUMNS} FROM business
        WHERE Recommendation IN ('Low-cost Automation Only', 'Minimal Spend')""",
    "low_priority_share": """SELECT
        count(*) FILTER (Recommendation IN ('Low-cost Automation Only', 'Minimal Spend'))
          AS LowPriority,
        avg((Recommendation IN ('Low-cost Automation Only', 'Minimal Spend'))::INT)
          AS LowPriorityShare FROM business""",
    # projections
    "total_price": """SELECT InvoiceNo, StockCode,
        (Quantity::DECIMAL(11,0) * UnitPrice)::DOUBLE AS TotalPrice FROM retail_raw""",
    "cast_types": _raw_rows("retail_raw", "CustomerID::VARCHAR"),
    "cast_losses": """SELECT c AS "Column", CASE WHEN c = 'Quantity' THEN n ELSE 0 END AS Lost FROM
        (SELECT count(*) FILTER (StockCode IN ('post', 'D')) AS n FROM retail_raw),
        (SELECT unnest(['InvoiceNo', 'StockCode', 'Description', 'Quantity', 'InvoiceDate',
          'UnitPrice', 'CustomerID', 'Country']) AS c)""",
    "reference_date": """SELECT strftime(today, '%Y-%m-%d %H:%M:%S') AS ReferenceDate,
        strftime(cutoff, '%Y-%m-%d %H:%M:%S') AS Cutoff FROM dates""",
    "whole_days_between": "SELECT CustomerID, Recency FROM rfm",
    "safe_ratio_features": """SELECT CustomerID, AvgOrderValue, AvgDaysBetweenPurchases
        FROM live""",
    "log1p_features": """SELECT CustomerID, round(r, 8) AS Recency, round(f, 8) AS Frequency,
        round(m, 8) AS Monetary FROM logged""",
    "rfm_score_string": "SELECT CustomerID, RFM_Score FROM segments",
    "rfm_sum": "SELECT CustomerID, RFM_Sum FROM segments",
    "rfm_segment": SEGMENT_ROWS,
    "recommendation": """SELECT CustomerID, CLV_Tier, ChurnRiskTier, Recommendation, Priority,
        Action FROM business""",
    "clip_lower": """SELECT InvoiceNo, StockCode, Quantity,
        greatest(Quantity::DOUBLE, 0.0::DOUBLE) AS Clipped FROM retail_raw""",
    "cap_at_quantile": """SELECT CustomerID, round(least(CLV_12m, v97), 4) AS CLV_capped
        FROM valued, valued_edges""",
    "fill_missing": """SELECT CustomerID, coalesce(CLV_12m, 0) AS monetary_value FROM business""",
    "round2": """SELECT CustomerID, round_even(Recency / 8.0::DOUBLE, 2) AS RecencyEighths,
        round_even(Recency / 16.0::DOUBLE, 0) AS RecencySixteenths,
        Monetary::DOUBLE AS Monetary FROM live""",
    "percent_of_total": """SELECT Country, Revenue::DOUBLE AS Revenue,
        round(Revenue::DOUBLE / (sum(Revenue) OVER ())::DOUBLE * 100, 8) AS SharePct
        FROM countries""",
    "segment_label_text": """SELECT Segment, Segment || chr(10) || Customers || ' Customers'
        || chr(10) || '£' || printf('%.2f', Revenue::DOUBLE / 1e6) || 'M' AS Label
        FROM (SELECT Segment, count(*) AS Customers, sum(Monetary) AS Revenue
              FROM segments GROUP BY Segment)""",
    "select_rename_drop": """SELECT CustomerID AS Customer, Recency, Frequency,
        Monetary::DOUBLE AS Monetary FROM live""",
    "log10_axes": """SELECT CustomerID, round(log10(Frequency::DOUBLE), 8) AS LogFrequency,
        round(log10(Monetary::DOUBLE), 8) AS LogMonetary FROM segments""",
    # joins
    "join_segment": """SELECT l.CustomerID, ChurnProbability, Segment,
        Cluster::VARCHAR AS Cluster FROM live l LEFT JOIN known_clustered c USING (CustomerID)""",
    "join_clv": """SELECT l.CustomerID, ChurnProbability, CLV_12m, CLV_Tier FROM live l
        LEFT JOIN (SELECT * FROM valued WHERE CustomerID % 29 <> 0) v USING (CustomerID)""",
    "churn_label": "SELECT CustomerID, Churned FROM labelled",
    "window_customer_counts": """SELECT
        (SELECT count(DISTINCT CustomerID) FROM observed) AS ObservationCustomers,
        (SELECT count(DISTINCT CustomerID) FROM holdout) AS HoldoutCustomers""",
    "actual_spend_lookup": """SELECT CustomerID, Monetary::DOUBLE AS ActualSpend
        FROM summary JOIN rfm USING (CustomerID) WHERE summary.frequency = 0""",
    "broadcast_scalar": """SELECT InvoiceNo, StockCode, Quantity,
        date_sub('day', InvoiceDate, today) AS AgeDays FROM clean, dates""",
    # aggregations
    "rfm_table": """SELECT CustomerID, Recency, Frequency, Monetary::DOUBLE AS Monetary
        FROM rfm""",
    "churn_dataset": f"SELECT {FEATURE_COLUMNS}, Churned FROM labelled",
    "churn_features": f"SELECT {FEATURE_COLUMNS} FROM features",
    "live_features": f"SELECT {FEATURE_COLUMNS} FROM live",
    "segment_summary": """SELECT Segment, count(*) AS Customers,
        round(avg(Recency), 8) AS AvgRecency, round(avg(Frequency), 8) AS AvgFrequency,
        round(avg(Monetary::DOUBLE), 4) AS AvgMonetary, sum(Monetary)::DOUBLE AS TotalRevenue
        FROM segments GROUP BY Segment""",
    "segment_revenue": """SELECT Segment, count(*) AS Customers,
        sum(Monetary)::DOUBLE AS Revenue FROM segments GROUP BY Segment""",
    "cluster_profile": PROFILE,
    "country_revenue": "SELECT Country, Revenue::DOUBLE AS Revenue FROM countries",
    "invoice_value": "SELECT InvoiceNo, InvoiceValue::DOUBLE AS InvoiceValue FROM invoices",
    "purchase_frequency": "SELECT CustomerID, Invoices FROM purchases",
    "monthly_revenue": MONTHS,
    "eda_key_stats": """SELECT round(MeanInvoiceValue, 4) AS MeanInvoiceValue,
        round(MedianInvoiceValue, 4) AS MedianInvoiceValue,
        round(MeanPurchases, 8) AS MeanPurchases, MedianPurchases
        FROM (SELECT avg(InvoiceValue::DOUBLE) AS MeanInvoiceValue,
                quantile_cont(InvoiceValue::DOUBLE, 0.5) AS MedianInvoiceValue FROM invoices),
             (SELECT avg(Invoices) AS MeanPurchases,
                quantile_cont(Invoices::DOUBLE, 0.5) AS MedianPurchases FROM purchases)""",
    "home_country_share": """SELECT round(coalesce(sum(Revenue) FILTER (Country = 'NATION_0'), 0)
        ::DOUBLE / sum(Revenue)::DOUBLE * 100, 8) AS HomeSharePct FROM countries""",
    "describe_table": " UNION ALL ".join(map(_describe, ("Recency", "Frequency", "Monetary"))),
    "segment_counts": "SELECT Segment, count(*) AS Customers FROM segments GROUP BY Segment",
    "churn_rate": "SELECT round(avg(Churned), 8) AS ChurnRate FROM labelled",
    "clv_tier_summary": """SELECT CLV_Tier, count(*) AS Customers,
        round(avg(CLV_12m), 4) AS AvgCLV, round(sum(CLV_12m), 2) AS TotalCLV
        FROM valued GROUP BY CLV_Tier""",
    "tier_risk_crosstab": """SELECT CLV_Tier,
        count(*) FILTER (ChurnRiskTier = 'Low Risk') AS "Low Risk",
        count(*) FILTER (ChurnRiskTier = 'Medium Risk') AS "Medium Risk",
        count(*) FILTER (ChurnRiskTier = 'High Risk') AS "High Risk"
        FROM business WHERE CLV_Tier IS NOT NULL GROUP BY CLV_Tier""",
    "recommendation_summary": """SELECT Priority, Recommendation, count(*) AS Customers,
        round_even(coalesce(sum(CLV_12m), 0), 2) AS TotalCLV,
        round_even(avg(ChurnProbability), 2) AS AvgChurnProb
        FROM business GROUP BY Priority, Recommendation""",
    "revenue_at_risk": """SELECT count(*) AS UrgentCustomers,
        round(coalesce(sum(CLV_12m), 0), 2) AS RevenueAtRisk
        FROM business WHERE Recommendation = 'URGENT: VIP Win-back'""",
    "kpi_row": """SELECT count(*) AS TotalCustomers, round(sum(CLV_12m), 2) AS TotalCLV,
        round(avg(ChurnProbability), 8) AS AvgChurn,
        round(coalesce(sum(CLV_12m) FILTER (Recommendation = 'URGENT: VIP Win-back'), 0), 2)
          AS RevenueAtRisk,
        round(avg((Recommendation IN ('Low-cost Automation Only', 'Minimal Spend'))::INT), 8)
          AS LowPriorityShare FROM business""",
    "freq_monetary_corr": """SELECT round(corr(frequency::DOUBLE, monetary_value), 8)
        AS Correlation FROM summary WHERE frequency > 0""",
    "unstable_clv_count": f"""SELECT count(*) FILTER (CLV_12m IS NULL OR CLV_12m < 0) AS Unstable,
        count(*) AS OneTime FROM {CLV} WHERE frequency = 0""",
    "clv_summary_input": "SELECT * FROM summary",
    # quantile bins and ranks
    "recency_score": "SELECT CustomerID, R_Score FROM scored",
    "frequency_score": "SELECT CustomerID, F_Score FROM scored",
    "monetary_score": "SELECT CustomerID, M_Score FROM scored",
    "clv_tier": "SELECT CustomerID, CLV_12m, CLV_Tier FROM valued",
    "churn_risk_tier": "SELECT CustomerID, ChurnProbability, ChurnRiskTier FROM merged",
    "first_rank": "SELECT CustomerID, Frequency, FrequencyRank FROM ranked",
    "quantile_value": " UNION ALL ".join(map(_quantiles, ("Recency", "Frequency", "Monetary"))),
    "histogram": f"""SELECT Bin, round(BinStart, 6) AS BinStart, round(BinEnd, 6) AS BinEnd,
        "Rows" FROM {_bins("purchases", "Invoices", 40)}""",
    # sorts, limits, distinct
    "sort_recommendations": f"SELECT {BUSINESS_COLUMNS} FROM business",
    "top_countries": """SELECT Country, Revenue::DOUBLE AS Revenue FROM countries
        ORDER BY countries.Revenue DESC, Country LIMIT 10""",
    "top_five_countries": """SELECT Country, Revenue::DOUBLE AS Revenue FROM countries
        ORDER BY countries.Revenue DESC, Country LIMIT 5""",
    "top_urgent": """SELECT CustomerID, Segment, round_even(ChurnProbability, 2) AS ChurnProb,
        round_even(business.CLV_12m, 0) AS CLV_12m, Recency FROM business
        WHERE Recommendation = 'URGENT: VIP Win-back' OR NOT EXISTS
          (SELECT 1 FROM business WHERE Recommendation = 'URGENT: VIP Win-back')
        ORDER BY business.CLV_12m DESC NULLS LAST, CustomerID LIMIT 20""",
    "sorted_group_tables": """SELECT Segment, count(*) AS Customers,
        sum(Monetary)::DOUBLE AS Revenue FROM segments GROUP BY Segment""",
    "distinct_values": "SELECT DISTINCT Segment FROM segments",
    "argmax_row": """SELECT Model, "ROC-AUC" FROM model_metrics
        ORDER BY "ROC-AUC" DESC, pos LIMIT 1""",
    # clustering
    "standardize": """SELECT CustomerID, round(Recency, 6) AS Recency,
        round(Frequency, 6) AS Frequency, round(Monetary, 6) AS Monetary FROM scaled""",
    "kmeans_check": """SELECT count(*) AS Customers, 4 AS Clusters, true AS NotAboveFixed, 9 AS Ks,
        true AS Falling, true AS SweepAgrees, true AS SilhouettesInRange FROM scaled""",
    "kmeans_assign_fixed": "SELECT CustomerID, Cluster FROM assigned",
    "silhouette": _silhouette(f"sqrt({SQUARED})"),
    "silhouette_tree": f"""SELECT round(Silhouette, 4) AS Silhouette, true AS SmallBound
        FROM ({_silhouette(f"sqrt({SQUARED})")})""",
    "silhouette_squared": _silhouette(SQUARED),
    "pca_2d": PCA_POINTS,
    "chart_pca_check": PCA_POINTS,
    "pca_variance": """SELECT 1 AS Component, round(e1 / 3, 8) AS Ratio FROM eigen
        UNION ALL SELECT 2, round(e2 / 3, 8) FROM eigen""",
    "inertia": "SELECT round(sum(d2), 4) AS Inertia FROM assigned",
    # churn models and evaluation
    "stratified_split": SPLIT,
    # Properties of fits: the rows and labels are computed, what must hold is stated.
    "churn_models_check": f"""SELECT Model, CustomerID, Churned, true AS InRange, true AS Learned
        FROM ({SPLIT}), (VALUES ('Logistic Regression'), ('Random Forest'), ('Boosted Trees'))
          AS m(Model) WHERE IsTest = 1""",
    "logreg_gradient_check": f"""SELECT Term, true AS Flat FROM ({FEATURE_NAMES})
        UNION ALL SELECT 'Intercept', true""",
    "churn_scores_check": f"""SELECT 'live' AS "Rows", CustomerID, true AS InRange FROM live
        UNION ALL SELECT 'observed', CustomerID, true FROM labelled
        UNION ALL SELECT 'importance ' || Term, 0, true FROM ({FEATURE_NAMES})""",
    "class_weights": """SELECT Churned, n AS "Rows",
        round(sum(n) OVER ()::DOUBLE / (count(*) OVER () * n), 8) AS Weight FROM class_rows""",
    "scale_pos_weight": """SELECT round(count(*) FILTER (Churned = 0)::DOUBLE
        / count(*) FILTER (Churned = 1), 8) AS ScalePosWeight FROM labelled""",
    "logreg_score_fixed": """SELECT CustomerID, round(1 / (1 + exp(-(-0.5::DOUBLE
        + 0.004::DOUBLE * Recency + -0.15::DOUBLE * Frequency
        + -0.0000005::DOUBLE * Monetary::DOUBLE + 0.01::DOUBLE * UniqueProducts
        + 0.02::DOUBLE * AvgQuantity + 0.0005::DOUBLE * Tenure
        + 0.000002::DOUBLE * AvgOrderValue + 0.001::DOUBLE * AvgDaysBetweenPurchases))), 8)
        AS ChurnProbability FROM labelled""",
    "classification_metrics": """SELECT Accuracy, "Precision", Recall, F1, "ROC-AUC"
        FROM model_metrics WHERE pos = 0""",
    "roc_auc": "SELECT round(auc, 10) AS RocAuc FROM model_auc WHERE Model LIKE 'Recency%'",
    "roc_curve": ROC_POINTS,
    "confusion_matrix": """SELECT 0 AS Truth, 0 AS Prediction, tn AS Customers FROM cells
        UNION ALL SELECT 0, 1, fp FROM cells UNION ALL SELECT 1, 0, fn FROM cells
        UNION ALL SELECT 1, 1, tp FROM cells""",
    "classification_report": REPORT,
    "model_comparison": """SELECT Model, Accuracy, "Precision", Recall, F1, "ROC-AUC"
        FROM model_metrics""",
    # customer lifetime value
    "bgnbd_loglik": """SELECT count(*) AS Customers, round(sum(
        lgamma(0.9::DOUBLE + frequency) - lgamma(0.9::DOUBLE) + 0.9::DOUBLE * ln(20.0::DOUBLE)
        + lgamma(5.6::DOUBLE) + lgamma(4.0::DOUBLE + frequency) - lgamma(4.0::DOUBLE)
        - lgamma(5.6::DOUBLE + frequency)
        - (0.9::DOUBLE + frequency) * ln(20.0::DOUBLE + T)
        + ln(1 + CASE WHEN frequency = 0 THEN 0 ELSE 1.6::DOUBLE / (3.0::DOUBLE + frequency)
            * exp((0.9::DOUBLE + frequency) * (ln(20.0::DOUBLE + T) - ln(20.0::DOUBLE + recency)))
          END)), 4) AS LogLikelihood FROM summary""",
    "lifetime_fit_check": """SELECT 'purchases' AS Model, count(*) AS Customers, true AS AtBest
        FROM summary UNION ALL SELECT 'spend', count(*), true FROM summary
        WHERE frequency > 0 AND monetary_value > 0""",
    "clv_rows_check": """SELECT CustomerID, CASE WHEN summary.frequency = 0
          THEN round(Monetary::DOUBLE, 4) END AS OneTimeValue, true AS InRange
        FROM summary JOIN rfm USING (CustomerID)""",
    "expected_purchases": f"""SELECT CustomerID, round(ProbAlive * purchases, 8)
        AS PredictedPurchases_90d FROM alive
        JOIN {ALIVE_PURCHASES.format(horizons="[90]")} USING (CustomerID)""",
    "prob_alive": "SELECT CustomerID, round(ProbAlive, 8) AS ProbAlive FROM alive",
    "gamma_gamma_loglik": """SELECT count(*) AS Customers, round(sum(
        lgamma(6.0::DOUBLE * frequency + 4) - lgamma(6.0::DOUBLE * frequency) - lgamma(4.0::DOUBLE)
        + 4 * ln(15.0::DOUBLE) + (6.0::DOUBLE * frequency - 1) * ln(monetary_value)
        + 6.0::DOUBLE * frequency * ln(frequency::DOUBLE)
        - (6.0::DOUBLE * frequency + 4) * ln(frequency * monetary_value + 15)), 4)
        AS LogLikelihood FROM summary WHERE frequency > 0 AND monetary_value > 0""",
    "expected_avg_spend": """SELECT CustomerID, round(ExpectedSpend, 4) AS ExpectedSpend
        FROM alive""",
    "clv_12m": f"SELECT CustomerID, round(CLV_12m, 4) AS CLV_12m FROM {CLV}",
    "one_time_fallback": """SELECT CustomerID, summary.frequency AS frequency,
        round(CASE WHEN summary.frequency = 0 THEN Monetary::DOUBLE
                   ELSE greatest(monetary_value - 500000, 0) END, 4) AS CLV_12m
        FROM summary JOIN rfm USING (CustomerID)""",
    # chart and report tables
    "chart_eda": f"""SELECT 'monthly_revenue' AS Chart, MonthEnd AS Point, Revenue AS "Value"
        FROM ({MONTHS})
        UNION ALL SELECT 'top_countries', Country, Revenue::DOUBLE FROM
          (SELECT * FROM countries ORDER BY Revenue DESC, Country LIMIT 10)
        UNION ALL SELECT 'invoice_histogram', Bin::VARCHAR, "Rows"::DOUBLE
          FROM {_bins("invoices", "InvoiceValue", 50)}
        UNION ALL SELECT 'order_histogram', Bin::VARCHAR, "Rows"::DOUBLE
          FROM {_bins("purchases", "Invoices", 40)}""",
    "chart_treemap_shares": """SELECT Segment, Customers, Revenue::DOUBLE AS Revenue,
        round(Revenue::DOUBLE / (sum(Revenue) OVER ())::DOUBLE * 100, 8) AS SharePct,
        Segment || chr(10) || Customers || ' Customers'
        || chr(10) || '£' || printf('%.2f', Revenue::DOUBLE / 1e6) || 'M' AS Label
        FROM (SELECT Segment, count(*) AS Customers, sum(Monetary) AS Revenue
              FROM segments GROUP BY Segment)""",
    "chart_rfm_scatter": """SELECT CustomerID, Segment, Frequency, Monetary::DOUBLE AS Monetary,
        round(log10(Frequency::DOUBLE), 8) AS LogFrequency,
        round(log10(segments.Monetary::DOUBLE), 8) AS LogMonetary FROM segments""",
    "chart_clv": f"""SELECT 'clv_histogram' AS Chart, Bin::VARCHAR AS Point,
        "Rows"::DOUBLE AS "Value" FROM {_bins("valued", "CLV_12m", 50)}
        UNION ALL SELECT 'clv_by_tier', CLV_Tier, round(sum(CLV_12m), 2)
        FROM valued GROUP BY CLV_Tier""",
    "chart_priority_map": """SELECT CustomerID, ChurnProbability,
        round(CASE WHEN CLV_12m > cap THEN cap ELSE CLV_12m END, 4) AS CLV_capped, Segment, CLV_12m, Recommendation, Recency,
        Frequency, Monetary::DOUBLE AS Monetary
        FROM business, (SELECT quantile_cont(CLV_12m, 0.97) AS cap FROM business)""",
    "chart_segment_bar": """SELECT Segment, count(*) AS Customers,
        sum(Monetary)::DOUBLE AS Revenue FROM clustered GROUP BY Segment""",
    "chart_clv_pie": """SELECT CLV_Tier, count(*) AS Customers, round(sum(CLV_12m), 2) AS TotalCLV
        FROM business WHERE CLV_Tier IS NOT NULL GROUP BY CLV_Tier""",
    "chart_risk_bar": """SELECT ChurnRiskTier, count(*) AS Customers FROM business
        GROUP BY ChurnRiskTier""",
    "dashboard_contents": f"""WITH urgent AS (
          SELECT * FROM business WHERE Recommendation = 'URGENT: VIP Win-back' OR NOT EXISTS
            (SELECT 1 FROM business WHERE Recommendation = 'URGENT: VIP Win-back')
          ORDER BY CLV_12m DESC NULLS LAST, CustomerID LIMIT 20),
        urgent_rows AS (SELECT *, row_number() OVER (ORDER BY CLV_12m DESC NULLS LAST, CustomerID)::INT AS pos FROM urgent),
        bars AS (SELECT *, row_number() OVER (ORDER BY Revenue, Segment)::INT AS pos FROM (
          SELECT Segment, count(*)::DOUBLE AS Customers, sum(Monetary)::DOUBLE AS Revenue FROM clustered GROUP BY Segment)),
        risks AS (SELECT *, row_number() OVER (ORDER BY list_position(
            ['Low Risk', 'Medium Risk', 'High Risk', 'Unknown'], ChurnRiskTier))::INT AS pos
          FROM (SELECT ChurnRiskTier, count(*)::DOUBLE AS Customers FROM business GROUP BY ChurnRiskTier)),
        pies AS (SELECT CLV_Tier, count(*)::DOUBLE AS Customers, sum(CLV_12m) AS TotalCLV FROM business
          WHERE CLV_Tier IS NOT NULL GROUP BY CLV_Tier),
        totals AS (SELECT count(*)::DOUBLE AS a, coalesce(sum(CLV_12m), 0) AS b, avg(ChurnProbability) AS c,
          coalesce(sum(CLV_12m) FILTER (Recommendation = 'URGENT: VIP Win-back'), 0) AS d,
          avg((Recommendation IN ('Low-cost Automation Only', 'Minimal Spend'))::INT) AS e FROM business),
        shown AS (SELECT business.*, CASE WHEN CLV_12m > cap THEN cap ELSE CLV_12m END AS capped
          FROM business, (SELECT quantile_cont(CLV_12m, 0.97) AS cap FROM business)),
        shown_cells(t, r, p, c, n, x) AS (
          SELECT 'kpis', 'all', NULL::INT, c, n, NULL::VARCHAR FROM (SELECT unnest(['TotalCustomers', 'TotalCLV', 'AvgChurn',
            'RevenueAtRisk', 'LowPriorityShare']) AS c, unnest([a, b, c, d, e]) AS n FROM totals)
          UNION ALL SELECT 'segment_bar', Segment, pos, unnest(['Segment', 'Customers', 'Revenue']),
            unnest([NULL, Customers, Revenue]), unnest([Segment, NULL, NULL]) FROM bars
          UNION ALL SELECT 'clv_pie', CLV_Tier, NULL, unnest(['CLV_Tier', 'Customers', 'TotalCLV']),
            unnest([NULL, Customers, TotalCLV]), unnest([CLV_Tier, NULL, NULL]) FROM pies
          UNION ALL SELECT 'risk_bar', ChurnRiskTier, pos, unnest(['ChurnRiskTier', 'Customers']),
            unnest([NULL, Customers]), unnest([ChurnRiskTier, NULL]) FROM risks
          UNION ALL SELECT 'priority_map', CustomerID::VARCHAR, NULL, unnest(['CustomerID', 'ChurnProbability', 'CLV_capped', 'Segment',
            'CLV_12m', 'Recommendation', 'Recency', 'Frequency', 'Monetary']),
            unnest([CustomerID::DOUBLE, ChurnProbability, capped, NULL, CLV_12m, NULL, Recency::DOUBLE, Frequency::DOUBLE, Monetary::DOUBLE]),
            unnest([NULL, NULL, NULL, Segment, NULL, Recommendation, NULL, NULL, NULL]) FROM shown
          UNION ALL SELECT 'top_urgent', CustomerID::VARCHAR, pos, unnest(['CustomerID', 'Segment', 'ChurnProb', 'CLV_12m', 'Recency']),
            unnest([CustomerID::DOUBLE, NULL, round_even(ChurnProbability, 2), round_even(CLV_12m, 0), Recency::DOUBLE]),
            unnest([NULL, Segment, NULL, NULL, NULL]) FROM urgent_rows)
        SELECT t AS "Table", r AS "Row", p AS "Position", c AS "Column", round(n, 2) AS "Number", x AS "Text" FROM shown_cells""",
    "dashboard_tables": """SELECT 'kpis' AS "Table", 1 AS "Rows"
        UNION ALL SELECT 'segment_bar', count(DISTINCT Segment) FROM clustered
        UNION ALL SELECT 'clv_pie', count(DISTINCT CLV_Tier) FROM business
        UNION ALL SELECT 'risk_bar', count(DISTINCT ChurnRiskTier) FROM business
        UNION ALL SELECT 'priority_map', count(*) FROM business
        UNION ALL SELECT 'top_urgent', least(20, CASE WHEN
            count(*) FILTER (Recommendation = 'URGENT: VIP Win-back') = 0 THEN count(*)
            ELSE count(*) FILTER (Recommendation = 'URGENT: VIP Win-back') END) FROM business""",
}


def oracle_queries() -> dict[str, str]:
    out = {}
    for name, select in {**SELECTS, **model_sql.selects(SPLIT, FEATURE_COLUMNS, PCA_POINTS)}.items():
        # A select with its own CTEs continues the shared list.
        if select.startswith("WITH RECURSIVE "):
            out[name] = f"WITH RECURSIVE {SHARED.strip()}, {select[len('WITH RECURSIVE '):]}"
        elif select.startswith("WITH "):
            out[name] = f"WITH {SHARED.strip()}, {select[len('WITH '):]}"
        else:
            out[name] = f"WITH {SHARED.strip()} {select}"
    return out

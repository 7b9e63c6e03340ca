"""ANSI SQL for the registered queries, written independently of the DataFrame code.

Each statement is a SELECT over named steps; ``compose`` prepends the steps it needs as a WITH list.
"""

from __future__ import annotations

import re

from ledgerloom.config import CATEGORIES, LEDGER_COLUMNS, NUMERIC_FEATURES
from ledgerloom.sources.tables import FIRST_PART_END, SECOND_PART_START, TABLE_CONFIG as CFG

CUTOFF = f"TIMESTAMP '{CFG.cutoff} 00:00:00'"
WINDOW_END = f"({CUTOFF} + INTERVAL {CFG.horizon_days} DAY)"
LEDGER = ", ".join(LEDGER_COLUMNS)


def _days(start: str, end: str) -> str:
    return f"((epoch_us({end}) - epoch_us({start})) / 86400000000.0)"


def _category(text: str) -> str:
    rules = " ".join(f"WHEN regexp_matches({text}, '{p}') THEN '{c}'" for c, p in CFG.category_rules)
    return f"CASE {rules} ELSE 'other' END"


def _outside(column: str) -> str:
    return (
        f"NOT ({column} BETWEEN {column}_q1 - 1.5 * ({column}_q3 - {column}_q1) "
        f"AND {column}_q3 + 1.5 * ({column}_q3 - {column}_q1))"
    )


STEPS: dict[str, str] = {}

STEPS["line_source"] = """
SELECT CASE WHEN l_returnflag = 'R' THEN 'C' ELSE '' END || CAST(o_orderkey AS VARCHAR) AS invoice,
       CASE WHEN p_type = 'PROMO' THEN 'M' || CAST(p_partkey AS VARCHAR)
            ELSE lpad(CAST(p_partkey % 100000 AS VARCHAR), 5, '0') ||
                 CASE WHEN p_partkey < 100000 THEN ''
                      ELSE translate(CAST(p_partkey // 100000 AS VARCHAR), '0123456789', 'ABCDEFGHIJ') END
       END AS stock_code,
       ' ' || p_name || '  ' AS description,
       l_quantity AS quantity,
       o_orderdate AS invoice_date,
       floor(round(l_extendedprice * 100) / l_quantity + 0.5) / 100 AS price,
       CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_custkey AS DOUBLE) END AS customer_id,
       CASE WHEN o_orderkey % 97 <> 0 THEN n_name END AS country
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
     JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey"""
STEPS["raw_ledger"] = f"""
SELECT * FROM line_source WHERE invoice_date < TIMESTAMP '{FIRST_PART_END} 00:00:00'
UNION ALL
SELECT * FROM line_source WHERE invoice_date >= TIMESTAMP '{SECOND_PART_START} 00:00:00'"""
STEPS["distinct_lines"] = "SELECT DISTINCT * FROM raw_ledger"
STEPS["kept_lines"] = f"""
SELECT * FROM distinct_lines
WHERE price > 0 AND quantity <> 0 AND abs(quantity) <= {CFG.max_quantity} AND price <= {CFG.max_price}"""
# White space of any script, at either end of a text.
WHITE = r"[\s\x0B\x1C-\x1F\x85\p{Z}]+"


def stripped(text: str) -> str:
    return f"regexp_replace(upper({text}), '^{WHITE}|{WHITE}$', '', 'g')"


STEPS["named_lines"] = rf"""
SELECT {stripped('invoice')} AS invoice, {stripped('stock_code')} AS stock_code,
       trim(regexp_replace(upper(coalesce(description, '')), '{WHITE}', ' ', 'g')) AS description,
       quantity AS raw_quantity, invoice_date, price,
       CAST(CAST(customer_id AS BIGINT) AS VARCHAR) AS customer_id,
       coalesce(country, 'Unknown') AS country,
       quantity < 0 OR coalesce(starts_with({stripped('invoice')}, 'C'), false) AS is_return
FROM kept_lines"""
STEPS["clean_ledger"] = r"""
SELECT invoice, stock_code, description,
       CASE WHEN is_return THEN -abs(raw_quantity) ELSE raw_quantity END AS quantity,
       invoice_date, price, customer_id, country, is_return,
       CASE WHEN is_return THEN -abs(raw_quantity) ELSE raw_quantity END * price AS amount,
       coalesce(regexp_matches(stock_code, '^\d{5}[A-Z]*$'), false) AS is_product
FROM named_lines"""
STEPS["past"] = f"SELECT * FROM clean_ledger WHERE invoice_date < {CUTOFF} AND customer_id IS NOT NULL"
STEPS["products"] = "SELECT * FROM past WHERE NOT is_return AND is_product"
STEPS["product_names"] = f"""
SELECT stock_code, description, {_category('description')} AS category FROM (
  SELECT stock_code, description,
         row_number() OVER (PARTITION BY stock_code ORDER BY count(*) DESC, description) AS pick
  FROM past WHERE description <> '' GROUP BY stock_code, description) WHERE pick = 1"""
STEPS["history"] = """
SELECT p.* EXCLUDE (description), coalesce(n.description, '') AS description,
       coalesce(n.category, 'other') AS category
FROM past p LEFT JOIN product_names n USING (stock_code)"""
STEPS["invoices"] = """
SELECT customer_id, invoice, min(invoice_date) AS date, sum(CAST(amount AS DECIMAL(18,6))) AS amount,
       sum(quantity) AS units
FROM past WHERE NOT is_return GROUP BY customer_id, invoice"""
STEPS["invoice_gaps"] = f"""
SELECT *, {_days('lag(date) OVER (PARTITION BY customer_id ORDER BY date, invoice)', 'date')} AS gap FROM invoices"""
STEPS["order_features"] = f"""
SELECT customer_id, count(*) AS frequency, CAST(sum(amount) AS DOUBLE) AS monetary,
       CAST(sum(amount) AS DOUBLE) / count(*) AS average_spend, sum(units) / count(*) AS basket_size,
       {_days('max(date)', CUTOFF)} AS recency, {_days('min(date)', CUTOFF)} AS tenure,
       coalesce(var_samp(gap), 0) AS gap_variance,
       CAST(count(*) FILTER (date >= {CUTOFF} - INTERVAL 90 DAY) AS DOUBLE) AS orders_90d,
       coalesce(CAST(sum(amount) FILTER (date >= {CUTOFF} - INTERVAL 90 DAY) AS DOUBLE), 0) AS spend_90d,
       sum(CASE WHEN {_days('date', CUTOFF)} < 180 THEN (2.5 - floor({_days('date', CUTOFF)} / 30)) / 17.5
           ELSE 0 END) AS frequency_trend,
       sum(units) AS purchased_units
FROM invoice_gaps GROUP BY customer_id"""
STEPS["season_features"] = """
SELECT customer_id, CAST(max(n) AS DOUBLE) / sum(n) AS seasonal_concentration FROM (
  SELECT customer_id, month(date) AS m, count(*) AS n FROM invoices GROUP BY ALL) GROUP BY customer_id"""
STEPS["net_features"] = """
SELECT customer_id, CAST(sum(CAST(amount AS DECIMAL(18,6))) AS DOUBLE) AS historical_clv,
       abs(coalesce(sum(quantity) FILTER (is_return), 0)) AS returned_units
FROM past GROUP BY customer_id"""
STEPS["country_features"] = """
SELECT customer_id, country FROM (
  SELECT customer_id, country,
         row_number() OVER (PARTITION BY customer_id ORDER BY invoice_date DESC, country DESC) AS pick
  FROM past WHERE NOT is_return) WHERE pick = 1"""
STEPS["product_prices"] = """
SELECT stock_code, quantile_cont(price, 0.5) AS median_price, count(*) AS product_lines
FROM products GROUP BY stock_code"""
STEPS["product_popularity"] = """
SELECT stock_code, count(*) AS product_lines, CAST(count(*) AS DOUBLE) / sum(count(*)) OVER () AS popularity
FROM products GROUP BY stock_code"""
STEPS["product_features"] = f"""
SELECT customer_id, avg(CAST(l.price < m.median_price * 0.9 AS INTEGER)) AS discount_proxy,
       avg(popularity) AS sku_popularity, CAST(count(DISTINCT stock_code) AS DOUBLE) AS unique_products,
       {', '.join(f"avg(CAST(n.category = '{c}' AS INTEGER)) AS affinity_{c}" for c in CATEGORIES)}
FROM products l JOIN product_prices m USING (stock_code) JOIN product_popularity USING (stock_code)
     JOIN product_names n USING (stock_code)
GROUP BY customer_id"""
STEPS["feature_base"] = f"""
SELECT customer_id, recency, frequency, monetary, average_spend, historical_clv, basket_size, frequency_trend,
       gap_variance, seasonal_concentration, returned_units / purchased_units AS return_rate,
       (exp(-recency / 90) + (1 - exp(-frequency / 10)) + (1 - exp(-monetary / 2500))) / 3 * 100 AS engagement,
       tenure, orders_90d, spend_90d,
       {', '.join(f'coalesce({c}, 0) AS {c}' for c in
                  ['discount_proxy', 'unique_products', 'sku_popularity', *['affinity_' + c for c in CATEGORIES]])},
       country
FROM order_features JOIN season_features USING (customer_id) JOIN net_features USING (customer_id)
     JOIN country_features USING (customer_id) LEFT JOIN product_features USING (customer_id)"""
STEPS["features"] = f"SELECT customer_id, {', '.join(NUMERIC_FEATURES)}, country FROM feature_base"
STEPS["future"] = f"""
SELECT * FROM clean_ledger WHERE invoice_date >= {CUTOFF} AND invoice_date < {WINDOW_END}
AND NOT is_return AND customer_id IS NOT NULL"""
STEPS["future_totals"] = """
SELECT customer_id, CAST(sum(CAST(amount AS DECIMAL(18,6))) AS DOUBLE) AS spend, min(invoice_date) AS first_date
FROM future GROUP BY customer_id"""
STEPS["future_category"] = f"""
SELECT customer_id, {_category('description')} AS category FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id
         ORDER BY invoice_date, invoice, stock_code, description) AS pick
  FROM future WHERE is_product) WHERE pick = 1"""
STEPS["targets"] = f"""
SELECT customer_id, CAST(first_date IS NULL AS INTEGER) AS churn, coalesce(spend, 0) AS clv_90d,
       coalesce({_days(CUTOFF, 'first_date')}, {float(CFG.horizon_days)}) AS next_days,
       coalesce(category, 'no_purchase') AS next_category
FROM features LEFT JOIN future_totals USING (customer_id) LEFT JOIN future_category USING (customer_id)"""
STEPS["modeling"] = "SELECT * FROM features JOIN targets USING (customer_id)"
STEPS["event_base"] = f"""
SELECT customer_id, invoice, min(invoice_date) AS date, CAST(sum(CAST(amount AS DECIMAL(18,6))) AS DOUBLE) AS amount,
       {', '.join(f"avg(CAST(n.category = '{c}' AS INTEGER)) AS {c}" for c in CATEGORIES)}
FROM products JOIN product_names n USING (stock_code) GROUP BY customer_id, invoice"""
STEPS["events_seq"] = f"""
SELECT *, coalesce({_days('lag(date) OVER (PARTITION BY customer_id ORDER BY date, invoice)', 'date')}, 0) AS gap,
       {_days('date', CUTOFF)} AS age,
       row_number() OVER (PARTITION BY customer_id ORDER BY date DESC, invoice DESC) AS recent_rank,
       count(*) OVER (PARTITION BY customer_id) AS events
FROM event_base"""
STEPS["last_events"] = f"""
SELECT *, least(events, {CFG.sequence_length}) - recent_rank AS step
FROM events_seq WHERE recent_rank <= {CFG.sequence_length}"""


def compose(select: str) -> str:
    """``select`` preceded by every step it refers to, directly or through other steps."""
    needed: set[str] = set()
    pending = [select]
    while pending:
        for word in set(re.findall(r"[a-z_]+", pending.pop())):
            if word in STEPS and word not in needed:
                needed.add(word)
                pending.append(STEPS[word])
    steps = [f"{name} AS ({STEPS[name]}\n)" for name in STEPS if name in needed]
    return ("WITH " + ",\n".join(steps) + "\n" if steps else "") + select


# ---- Partitions and rule scores -------------------------------------------------------------------
STEPS["split_rank"] = f"""
SELECT customer_id, churn, count(*) OVER (PARTITION BY churn) AS n,
       row_number() OVER (PARTITION BY churn ORDER BY md5('{CFG.seed}:split:' || customer_id)) AS r
FROM targets"""
STEPS["split"] = f"""
SELECT customer_id, churn,
       CASE WHEN r <= floor(n * {CFG.test_fraction} + 0.5) THEN 'test'
            WHEN r <= floor(n * {CFG.test_fraction} + 0.5) + floor(n * {CFG.validation_fraction} + 0.5)
            THEN 'validation' ELSE 'train' END AS partition
FROM split_rank"""
STEPS["folds"] = f"""
SELECT customer_id, churn,
       CAST((row_number() OVER (PARTITION BY churn ORDER BY md5('{CFG.seed}:fold:' || customer_id)) - 1)
            % {CFG.cv_folds} AS INTEGER) AS fold
FROM split WHERE partition = 'train'"""
STEPS["partitioned"] = "SELECT * FROM modeling JOIN (SELECT customer_id, partition FROM split) USING (customer_id)"
STEPS["train"] = "SELECT * FROM partitioned WHERE partition = 'train'"
_STRONGEST = f"greatest({', '.join('affinity_' + c for c in CATEGORIES)})"
STEPS["base_scores"] = f"""
SELECT *, round(1 - engagement / 100, 6) AS churn_probability, spend_90d AS predicted_clv_90d,
       least(recency, {float(CFG.horizon_days)}) AS predicted_next_days,
       CASE WHEN {_STRONGEST} = 0 THEN 'no_purchase'
            {' '.join(f"WHEN affinity_{c} = {_STRONGEST} THEN '{c}'" for c in CATEGORIES)} END AS predicted_category,
       round(gap_variance, 6) AS anomaly_score,
       CAST(recency > 90 AS INTEGER)
         + 2 * CAST(monetary >= (SELECT quantile_cont(monetary, 0.5) FROM train) AS INTEGER) AS cluster
FROM partitioned"""
STEPS["profiles"] = """
SELECT cluster, median(recency) AS recency, median(frequency) AS frequency, median(monetary) AS monetary,
       median(return_rate) AS return_rate, median(seasonal_concentration) AS seasonal_concentration
FROM base_scores WHERE partition = 'train' GROUP BY cluster"""
STEPS["names"] = """
SELECT cluster, CASE WHEN recency > 90 THEN 'Lapsed' ELSE 'Active' END || ', ' ||
       CASE WHEN monetary >= (SELECT quantile_cont(monetary, 0.5) FROM train)
            THEN 'high value' ELSE 'low value' END || ' · ' || CAST(cluster + 1 AS VARCHAR) AS segment
FROM profiles"""
STEPS["scored"] = f"""
SELECT b.*, round(1 - churn_probability, 6) AS purchase_probability,
       round(churn_probability * predicted_clv_90d, 6) AS priority,
       anomaly_score > (SELECT quantile_cont(anomaly_score, {CFG.anomaly_quantile})
                        FROM base_scores WHERE partition = 'validation') AS anomaly,
       segment,
       CASE WHEN monetary >= (SELECT quantile_cont(monetary, 0.8) FROM train) THEN 'High'
            WHEN monetary >= (SELECT quantile_cont(monetary, 0.5) FROM train) THEN 'Medium'
            ELSE 'Low' END AS value_tier
FROM base_scores b LEFT JOIN names USING (cluster)"""
STEPS["test_scores"] = "SELECT * FROM scored WHERE partition = 'test'"
STEPS["validation_scores"] = "SELECT * FROM scored WHERE partition = 'validation'"
STEPS["catalog"] = """
SELECT stock_code, coalesce(description, '') AS description, coalesce(category, 'other') AS category,
       count(DISTINCT invoice) AS orders, median(price) AS typical_price
FROM (SELECT stock_code, invoice, price FROM products) LEFT JOIN product_names USING (stock_code)
GROUP BY ALL"""
STEPS["transactions"] = """
SELECT customer_id, invoice, min(invoice_date) AS invoice_date,
       CAST(sum(CAST(amount AS DECIMAL(18,6))) AS DOUBLE) AS amount
FROM past WHERE customer_id IN (SELECT customer_id FROM scored) GROUP BY customer_id, invoice"""
STEPS["month_sums"] = """
SELECT CAST(date_trunc('month', invoice_date) AS DATE) AS month,
       CAST(sum(CAST(amount AS DECIMAL(18,6))) AS DOUBLE) AS revenue
FROM transactions GROUP BY 1"""
STEPS["trend"] = """
SELECT CAST(CAST(m AS DATE) AS VARCHAR) AS month, coalesce(revenue, 0) AS revenue
FROM (SELECT unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS m FROM month_sums)
     LEFT JOIN month_sums ON month = CAST(m AS DATE)"""

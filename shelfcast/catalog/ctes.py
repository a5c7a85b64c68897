"""The derived tables of ``sources.retail_views`` as SQL common table expressions."""

CTES = {
    "sale_lines": """
        SELECT CAST(l_shipdate AS DATE) AS date, l_suppkey AS store_nbr, l_partkey AS part, l_orderkey AS ticket,
               CAST(floor(l_extendedprice * (1 - l_discount)) AS BIGINT) AS amount,
               CASE WHEN l_discount >= 0.05 THEN 1 ELSE 0 END AS promoted
        FROM lineitem""",
    "sales_fact": """
        SELECT date, store_nbr, p_type AS family, CAST(sum(amount) AS DOUBLE) AS sales,
               CAST(sum(promoted) AS BIGINT) AS onpromotion
        FROM sale_lines JOIN part ON part = p_partkey GROUP BY date, store_nbr, p_type""",
    "dense_sales": """
        SELECT date, CAST(n_regionkey AS BIGINT) AS store_nbr, CAST(sum(amount) AS DOUBLE) AS sales,
               CAST(sum(promoted) AS BIGINT) AS onpromotion
        FROM sale_lines JOIN supplier ON store_nbr = s_suppkey JOIN nation ON s_nationkey = n_nationkey
        GROUP BY date, n_regionkey""",
    "stores": """
        SELECT s_suppkey AS store_nbr, n_name AS city, r_name AS state,
               CASE WHEN s_acctbal < 1000 THEN 'A' WHEN s_acctbal < 3000 THEN 'B' WHEN s_acctbal < 5000 THEN 'C'
                    WHEN s_acctbal < 8000 THEN 'D' ELSE 'E' END AS type,
               s_suppkey % 17 AS cluster
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "transactions": """
        SELECT date, store_nbr,
               CASE WHEN store_nbr % 5 = 0 AND day(date) = 21 THEN NULL ELSE count(DISTINCT ticket) END AS transactions
        FROM sale_lines WHERE NOT (store_nbr % 7 = 0 AND day(date) = 13) GROUP BY date, store_nbr""",
    "oil": """
        SELECT CAST(o_orderdate AS DATE) AS date,
               CASE WHEN day(CAST(o_orderdate AS DATE)) % 10 <> 3
                    THEN floor(CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) AS DOUBLE) / count(*) / 10) / 100
               END AS dcoilwtico
        FROM orders GROUP BY CAST(o_orderdate AS DATE)""",
    "holidays": """
        SELECT *, type || ' ' || locale_name AS description FROM (
        SELECT DISTINCT CAST(o_orderdate AS DATE) AS date,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'Holiday' WHEN '2-HIGH' THEN 'Event'
                    WHEN '3-MEDIUM' THEN 'Additional' WHEN '4-NOT SPECIFIED' THEN 'Transfer'
                    ELSE CASE WHEN o_custkey % 2 = 0 THEN 'Work Day' ELSE 'Bridge' END END AS type,
               CASE o_orderstatus WHEN 'F' THEN 'National' WHEN 'O' THEN 'Local' ELSE 'Regional' END AS locale,
               CASE o_orderstatus WHEN 'F' THEN 'Ecuador'
                    WHEN 'O' THEN 'NATION_' || CAST(o_custkey % 25 AS VARCHAR)
                    ELSE ['AFRICA','AMERICA','ASIA','EUROPE','MIDDLE EAST'][o_custkey % 5 + 1] END AS locale_name,
               (o_orderpriority = '1-URGENT' AND o_orderkey % 4 = 0) AS transferred
        FROM orders WHERE day(CAST(o_orderdate AS DATE)) IN (1, 15))""",
    "prediction_log": """
        SELECT event_id AS row_id, ts, CAST(ts AS DATE) AS date, event_type AS model,
               CAST(user_id AS VARCHAR) AS run_id, value AS prediction,
               CAST(json_extract_string(props, '$.k') AS DOUBLE) AS actual
        FROM events""",
    "metric_log": """
        SELECT ts, CASE WHEN event_type = 'signup' THEN 'system_metrics' ELSE 'performance_metrics' END AS metric_type,
               ['arima', 'prophet', 'lstm'][user_id % 3 + 1] AS model, CAST(user_id AS VARCHAR) AS series,
               CASE event_type WHEN 'click' THEN 'rmse' WHEN 'view' THEN 'mae' WHEN 'purchase' THEN 'mape'
                    WHEN 'signup' THEN 'cpu' WHEN 'error' THEN 'drift_p' END AS metric,
               value
        FROM events""",
    "days": "SELECT date, sum(sales) AS sales FROM sales_fact GROUP BY date",
    "promo_days": "SELECT date, sum(sales) AS sales, sum(onpromotion) AS promos FROM sales_fact GROUP BY date",
    "oil_calendar": """
        SELECT CAST(d AS DATE) AS date FROM (SELECT unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS d
        FROM oil)""",
    "oil_filled": """
        SELECT date, coalesce(
                 last_value(dcoilwtico IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                 first_value(dcoilwtico IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
               ) AS dcoilwtico
        FROM oil_calendar LEFT JOIN oil USING (date)""",
    "dense_calendar": """
        SELECT store_nbr, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS date FROM (
        SELECT store_nbr, min(date) AS a, max(date) AS b FROM dense_sales GROUP BY store_nbr)""",
    "dense_daily": """
        SELECT store_nbr, date, coalesce(sales, last_value(sales IGNORE NULLS) OVER (
                 PARTITION BY store_nbr ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS sales
        FROM dense_calendar LEFT JOIN dense_sales USING (store_nbr, date)""",
    "calendar_sales": """
        SELECT *, year(date) AS year, month(date) AS month, day(date) AS day, isodow(date) - 1 AS day_of_week,
               week(date) AS week_of_year
        FROM sales_fact""",
}
NEEDS = {
    "sales_fact": ["sale_lines"], "dense_sales": ["sale_lines"], "transactions": ["sale_lines"],
    "days": ["sales_fact"], "promo_days": ["sales_fact"], "oil_calendar": ["oil"],
    "oil_filled": ["oil_calendar"], "dense_calendar": ["dense_sales"], "dense_daily": ["dense_calendar"],
    "calendar_sales": ["sales_fact"],
}


def _ordered(names, seen):
    for name in names:
        _ordered(NEEDS.get(name, []), seen)
        if name not in seen:
            seen.append(name)
    return seen


def with_tables(names: str, body: str) -> str:
    """``body`` after the named derived tables; a body that starts with ``, `` adds its own."""
    parts = ",\n".join(f"{n} AS ({CTES[n].strip()})" for n in _ordered(names.split(), []))
    glue = "" if body.lstrip().startswith(",") else "\n"
    return f"WITH {parts}{glue}{body}"

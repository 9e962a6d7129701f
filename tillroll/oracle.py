"""Independent DuckDB formulations of the registered queries.

Each string runs on the driver's pre-registered views (lineitem, orders, part,
supplier, nation, events, …). Conventions shared with the Spark side:
money as BIGINT cents, rounded values by integer half-up division, DuckDB
weekday numbering Sunday=0…Saturday=6, results cast to DOUBLE / BIGINT / INT.
"""

from __future__ import annotations

from .params import FIXTURE, Params
from .sources.schema import SOURCE_DOCS


def hu(n: str, d: str) -> str:
    """round(n/d) half-up for non-negative integers, as HUGEINT; NULL if d <= 0."""
    return (f"(CASE WHEN ({d}) > 0 THEN (2 * CAST({n} AS HUGEINT) + CAST({d} AS HUGEINT))"
            f" // (2 * CAST({d} AS HUGEINT)) END)")


def amt(cents: str) -> str:
    return f"(CAST({cents} AS DOUBLE) / 100)"


def avg_amt(s: str, n: str) -> str:
    return f"(CAST({hu(s, n)} AS DOUBLE) / 100)"


def pct2(n: str, d: str) -> str:
    return f"(CAST({hu(f'CAST({n} AS HUGEINT) * 10000', d)} AS DOUBLE) / 100)"


def pct0(n: str, d: str) -> str:
    return f"CAST({hu(f'CAST({n} AS HUGEINT) * 100', d)} AS DOUBLE)"


def raw_tx_cte() -> str:
    return """raw_tx AS (
  SELECT concat('TXN', CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR)) AS transaction_id,
         CAST(o_orderdate AS DATE) AS date,
         printf('%02d:%02d', o_orderkey % 24, l_linenumber * 13 % 60) AS time,
         printf('SHOP%06d', s_suppkey) AS shop_id,
         s_name AS shop_name, n_name AS city,
         p_name AS product_name, p_type AS category,
         CAST(l_quantity AS INTEGER) AS quantity,
         p_retailprice AS unit_price,
         CAST(l_extendedprice AS DOUBLE) AS total_amount,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS total_cents,
         printf('CUST%06d', o_custkey) AS customer_id,
         CASE WHEN o_orderkey % 4 = 1 THEN 'cash' ELSE 'card' END AS payment_method
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN part ON l_partkey = p_partkey
       JOIN supplier ON l_suppkey = s_suppkey
       JOIN nation ON s_nationkey = n_nationkey)"""


def dirty_tx_cte() -> str:
    return """dirty_tx AS (
  SELECT CASE WHEN total_cents % 131 = 0 THEN ' ' || transaction_id ELSE transaction_id END
           AS transaction_id,
         CASE WHEN total_cents % 101 = 0 THEN NULL ELSE date END AS date,
         time, shop_id, shop_name, city,
         CASE WHEN total_cents % 103 = 0 THEN NULL ELSE product_name END AS product_name,
         category,
         CASE WHEN total_cents % 107 = 0 THEN 0 ELSE quantity END AS quantity,
         unit_price,
         CASE WHEN total_cents % 109 = 0 THEN -total_amount
              WHEN total_cents % 113 = 0 THEN CAST(0.004 AS DOUBLE)
              WHEN total_cents % 127 = 0 THEN CAST(19999.996 AS DOUBLE)
              ELSE total_amount END AS total_amount,
         total_cents AS c0, customer_id, payment_method
  FROM raw_tx)"""


_ORDER = ["date", "shop_id", "product_name", "category", "quantity", "total_amount",
          "unit_price", "customer_id", "shop_name", "city", "payment_method", "time"]
_CRIT = ["transaction_id", "date", "shop_id", "product_name", "unit_price", "quantity",
         "total_amount"]


def not_null_critical() -> str:
    return " AND ".join(f"{c} IS NOT NULL" for c in _CRIT)


def dedup_cte(src: str = "raw_tx", name: str = "dedup") -> str:
    order = ", ".join(f"{c} ASC NULLS LAST" for c in _ORDER)
    return f"""{name}_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY {order}) AS rn
  FROM {src} WHERE {not_null_critical()}),
{name} AS (SELECT * EXCLUDE (rn) FROM {name}_ranked WHERE rn = 1)"""


def window_pred(p: Params) -> str:
    return f"date >= DATE '{p.min_date.isoformat()}' AND date <= DATE '{p.as_of.isoformat()}'"


def valid_pred() -> str:
    return "unit_price > 0 AND quantity > 0 AND total_amount > 0"


def clean_cte(src: str = "dedup", p: Params = FIXTURE) -> str:
    return f"""clean AS (SELECT * FROM {src} WHERE {valid_pred()} AND {window_pred(p)})"""


def processed_cte(p: Params = FIXTURE, src: str = "clean") -> str:
    return f"""processed AS (
  SELECT transaction_id, date, time, shop_id, shop_name, city, product_name, category,
         quantity, unit_price, total_amount, customer_id,
         payment_method,
         dayname(date) AS day_of_week, monthname(date) AS month_name,
         CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month_number,
         coalesce(dayofweek(date) IN (0, 6), false) AS is_weekend,
         CASE WHEN total_amount < {p.low_below} THEN 'Low'
              WHEN total_amount < {p.medium_below} THEN 'Medium' ELSE 'High' END
           AS revenue_category,
         CAST(round(total_amount * 100) AS BIGINT) AS total_cents
  FROM {src})"""


def stg_cte() -> str:
    return """stg AS (
  SELECT transaction_id, date AS transaction_date, shop_id, shop_name, city,
         product_name, category, quantity, round(unit_price, 2) AS unit_price,
         CAST(total_cents AS DOUBLE) / 100 AS total_amount, customer_id, payment_method, day_of_week, month_name, year,
         month_number, is_weekend, revenue_category,
         CASE WHEN is_weekend = true THEN 'Weekend' ELSE 'Weekday' END AS day_type,
         CASE WHEN month(date) IN (12, 1, 2) THEN 'Summer'
              WHEN month(date) IN (3, 4, 5) THEN 'Autumn'
              WHEN month(date) IN (6, 7, 8) THEN 'Winter'
              WHEN month(date) IN (9, 10, 11) THEN 'Spring' END AS australian_season,
         total_cents
  FROM processed
  WHERE transaction_id IS NOT NULL AND total_amount > 0 AND date IS NOT NULL)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def stg_prefix(p: Params = FIXTURE) -> str:
    return with_ctes(raw_tx_cte(), dedup_cte(), clean_cte(p=p), processed_cte(p), stg_cte())


def daily_cte() -> str:
    return f"""daily AS (
  SELECT transaction_date, shop_id, shop_name, city, day_of_week, day_type,
         australian_season, month_name, month_number, year, is_weekend,
         {amt('sum(total_cents)')} AS daily_revenue,
         count(transaction_id) AS total_transactions,
         {avg_amt('sum(total_cents)', 'count(total_cents)')} AS avg_transaction_value,
         {amt('max(total_cents)')} AS max_transaction_value,
         {amt('min(total_cents)')} AS min_transaction_value,
         count(DISTINCT product_name) AS unique_products_sold,
         count(DISTINCT customer_id) AS unique_customers,
         CAST(sum(CASE WHEN payment_method = 'cash' THEN 1 ELSE 0 END) AS BIGINT) AS cash_transactions,
         CAST(sum(CASE WHEN payment_method = 'card' THEN 1 ELSE 0 END) AS BIGINT) AS card_transactions,
         CAST(sum(total_cents) AS BIGINT) AS revenue_cents
  FROM stg
  GROUP BY transaction_date, shop_id, shop_name, city, day_of_week, day_type,
           australian_season, month_name, month_number, year, is_weekend)"""


def products_cte() -> str:
    return f"""prod_agg AS (
  SELECT shop_id, shop_name, city, product_name, category,
         count(transaction_id) AS total_transactions,
         CAST(sum(quantity) AS BIGINT) AS total_units_sold,
         CAST(sum(total_cents) AS BIGINT) AS s,
         count(total_cents) AS n,
         sum(CAST(round(unit_price * 100) AS BIGINT)) AS ps,
         count(unit_price) AS pn,
         sum(CASE WHEN is_weekend = true THEN total_cents ELSE 0 END) AS we,
         sum(CASE WHEN is_weekend = false THEN total_cents ELSE 0 END) AS wd
  FROM stg GROUP BY shop_id, shop_name, city, product_name, category),
top_products AS (
  SELECT shop_id, shop_name, city, product_name, category, total_transactions,
         total_units_sold, {amt('s')} AS total_revenue, {avg_amt('s', 'n')} AS avg_sale_value,
         {avg_amt('ps', 'pn')} AS avg_unit_price,
         CAST(rank() OVER (PARTITION BY shop_id ORDER BY s DESC) AS INTEGER) AS revenue_rank_in_shop,
         CAST(rank() OVER (PARTITION BY shop_id ORDER BY total_transactions DESC) AS INTEGER)
           AS popularity_rank_in_shop,
         {amt('we')} AS weekend_revenue, {amt('wd')} AS weekday_revenue,
         {pct2('s', 'sum(s) OVER (PARTITION BY shop_id)')} AS pct_of_shop_revenue,
         s AS revenue_cents
  FROM prod_agg)"""


def shops_cte() -> str:
    return f"""shop_agg AS (
  SELECT shop_id, shop_name, city,
         CAST(sum(total_cents) AS BIGINT) AS s, count(transaction_id) AS total_transactions,
         count(total_cents) AS n, max(total_cents) AS mx, min(total_cents) AS mn,
         count(DISTINCT customer_id) AS unique_customers,
         count(DISTINCT product_name) AS unique_products,
         count(DISTINCT category) AS unique_categories,
         sum(CASE WHEN is_weekend = true THEN total_cents ELSE 0 END) AS we,
         sum(CASE WHEN is_weekend = false THEN total_cents ELSE 0 END) AS wd,
         count(CASE WHEN is_weekend = true THEN 1 END) AS weekend_transactions,
         count(CASE WHEN is_weekend = false THEN 1 END) AS weekday_transactions,
         count(CASE WHEN payment_method = 'cash' THEN 1 END) AS cash_transactions,
         count(CASE WHEN payment_method = 'card' THEN 1 END) AS card_transactions,
         count(CASE WHEN revenue_category = 'High' THEN 1 END) AS high_value_transactions,
         count(CASE WHEN revenue_category = 'Medium' THEN 1 END) AS medium_value_transactions,
         count(CASE WHEN revenue_category = 'Low' THEN 1 END) AS low_value_transactions
  FROM stg GROUP BY shop_id, shop_name, city),
shop_performance AS (
  SELECT shop_id, shop_name, city, {amt('s')} AS total_revenue, total_transactions,
         {avg_amt('s', 'n')} AS avg_transaction_value,
         {amt('mx')} AS highest_sale, {amt('mn')} AS lowest_sale, unique_customers,
         {avg_amt('s', 'unique_customers')} AS revenue_per_customer,
         unique_products, unique_categories,
         {amt('we')} AS weekend_revenue, {amt('wd')} AS weekday_revenue,
         weekend_transactions, weekday_transactions, cash_transactions, card_transactions,
         {pct2('card_transactions', 'total_transactions')} AS card_payment_pct,
         high_value_transactions, medium_value_transactions, low_value_transactions,
         CAST(rank() OVER (ORDER BY s DESC) AS INTEGER) AS revenue_rank,
         {pct2('s', 'sum(s) OVER ()')} AS pct_of_total_revenue,
         s AS revenue_cents
  FROM shop_agg)"""


def marts_prefix(p: Params = FIXTURE) -> str:
    return with_ctes(raw_tx_cte(), dedup_cte(), clean_cte(p=p), processed_cte(p), stg_cte(),
                     daily_cte(), products_cte(), shops_cte())


def _cols(*names: str) -> str:
    return ", ".join(names)


STG_PUBLIC = _cols(
    "transaction_id", "transaction_date", "shop_id", "shop_name", "city", "product_name",
    "category", "quantity", "unit_price", "total_amount", "customer_id", "payment_method",
    "day_of_week", "month_name", "year", "month_number", "is_weekend", "revenue_category",
    "day_type", "australian_season")


def _labeled_cte(p: Params, src: str = "dirty_tx") -> str:
    order = ", ".join(f"{c} ASC NULLS LAST" for c in _ORDER)
    bad = " OR ".join(f"{c} IS NULL" for c in _CRIT)
    return f"""base AS (SELECT *, ({bad}) AS bad FROM {src}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY {order}) AS rn
           FROM base WHERE NOT bad),
labeled AS (
  SELECT 'null_critical' AS reason FROM base WHERE bad
  UNION ALL
  SELECT CASE WHEN rn > 1 THEN 'duplicate'
              WHEN NOT ({valid_pred()}) THEN 'impossible_value'
              WHEN NOT ({window_pred(p)}) THEN 'date_out_of_range'
              ELSE 'ok' END FROM ranked),
reason_counts AS (
  SELECT r.reason AS reject_reason, CAST(count(l.reason) AS BIGINT) AS n_rows
  FROM (VALUES ('null_critical'), ('duplicate'), ('impossible_value'),
               ('date_out_of_range'), ('ok')) AS r(reason)
  LEFT JOIN labeled l ON l.reason = r.reason GROUP BY r.reason)"""


def oracle_sql(p: Params = FIXTURE) -> dict[str, str]:
    proc = with_ctes(raw_tx_cte(), dedup_cte(), clean_cte(p=p), processed_cte(p))
    stg = stg_prefix(p)
    mp = marts_prefix(p)
    dirty = with_ctes(raw_tx_cte(), dirty_tx_cte(), _labeled_cte(p))
    q = {}
    q["revenue_by_shop"] = proc + f"""SELECT shop_name, {amt('sum(total_cents)')} AS total_revenue,
  {avg_amt('sum(total_cents)', 'count(total_cents)')} AS avg_sale_value,
  count(transaction_id) AS total_transactions
FROM processed GROUP BY shop_name ORDER BY total_revenue DESC, shop_name"""
    q["revenue_by_weekday_raw"] = proc + f"""SELECT day_of_week, {amt('sum(total_cents)')} AS revenue,
  count(transaction_id) AS transactions
FROM processed GROUP BY day_of_week ORDER BY revenue DESC"""
    q["clean_transactions"] = with_ctes(
        raw_tx_cte(), dirty_tx_cte(), dedup_cte("dirty_tx"), clean_cte(p=p)) + f"""
SELECT transaction_id, date, time, shop_id, shop_name, city, product_name, category, quantity,
       unit_price, total_amount, customer_id, payment_method
FROM clean"""
    q["dedup_transactions"] = with_ctes(raw_tx_cte(), dedup_cte()) + f"""
SELECT transaction_id, date, time, shop_id, shop_name, city, product_name, category, quantity,
       unit_price, customer_id, payment_method, total_amount
FROM dedup"""
    q["reject_reasons"] = dirty + "SELECT reject_reason, n_rows FROM reason_counts"
    q["row_audit"] = dirty + """SELECT
  CAST(sum(n_rows) AS BIGINT) AS raw_rows,
  CAST(sum(n_rows) FILTER (WHERE reject_reason <> 'null_critical') AS BIGINT) AS non_null_rows,
  CAST(sum(n_rows) FILTER (WHERE reject_reason NOT IN ('null_critical', 'duplicate')) AS BIGINT)
    AS deduplicated_rows,
  CAST(sum(n_rows) FILTER (WHERE reject_reason = 'ok') AS BIGINT) AS clean_rows,
  CAST(sum(n_rows) FILTER (WHERE reject_reason <> 'ok') AS BIGINT) AS removed_rows
FROM reason_counts"""
    q["enriched_transactions"] = proc + """SELECT transaction_id, date, day_of_week, month_name,
  year, month_number, is_weekend, revenue_category, total_amount FROM processed"""
    q["stg_transactions"] = stg + f"SELECT {STG_PUBLIC} FROM stg"
    q["daily_revenue"] = mp + "SELECT * EXCLUDE (revenue_cents) FROM daily"
    q["top_products"] = mp + "SELECT * EXCLUDE (revenue_cents) FROM top_products"
    q["shop_performance"] = mp + "SELECT * EXCLUDE (revenue_cents) FROM shop_performance"
    for model in ("daily_revenue", "top_products", "shop_performance"):
        q[f"refreshed_{model}"] = q[model]
    q["customers_approx"] = mp + """SELECT CASE WHEN grouping(year) = 0 THEN 'month'
  WHEN grouping(shop_id) = 0 THEN 'shop' ELSE 'all' END AS level, shop_id, year, month_number,
  count(DISTINCT customer_id) AS exact_customers, true AS within_error
FROM stg GROUP BY GROUPING SETS ((shop_id, year, month_number), (shop_id), ())"""
    return q


def _factor(d: str) -> str:
    return (f"(CASE dayofweek({d}) WHEN 6 THEN 14 WHEN 0 THEN 13 ELSE 10 END"
            f" * CASE WHEN month({d}) = 12 AND day({d}) >= 15 THEN 18 ELSE 10 END"
            f" * CASE WHEN month({d}) = 4 THEN 12 ELSE 10 END)")


def _weekday_values() -> str:
    days = ["Saturday", "Sunday", "Wednesday", "Friday", "Tuesday", "Thursday", "Monday"]
    return ", ".join(f"('{d}', {i + 1})" for i, d in enumerate(days))


def _spine_ctes() -> str:
    return """bounds AS (SELECT min(transaction_date) AS lo, max(transaction_date) AS hi FROM daily),
days AS (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP),
                INTERVAL 1 DAY)) AS DATE) AS transaction_date FROM bounds),
spine AS (
  SELECT d.transaction_date, s.shop_id, dayname(d.transaction_date) AS day_of_week,
         coalesce(x.revenue_cents, 0) AS revenue_cents,
         CAST(coalesce(x.total_transactions, 0) AS BIGINT) AS total_transactions
  FROM (SELECT DISTINCT shop_id FROM daily) s CROSS JOIN days d
  LEFT JOIN daily x ON x.shop_id = s.shop_id AND x.transaction_date = d.transaction_date)"""


def serving_oracle_sql(p: Params = FIXTURE) -> dict[str, str]:
    mp = marts_prefix(p)
    spine = mp.rstrip() + ",\n" + _spine_ctes() + "\n"
    q = {}
    q["shops"] = mp + """SELECT shop_id, shop_name, city, total_revenue, total_transactions,
  avg_transaction_value, unique_customers, revenue_per_customer, weekend_revenue,
  weekday_revenue, card_payment_pct, revenue_rank, pct_of_total_revenue
FROM shop_performance ORDER BY revenue_rank, shop_id"""
    q["report_shops"] = mp + """SELECT shop_name, city, total_revenue, total_transactions,
  avg_transaction_value, unique_customers, revenue_per_customer, weekend_revenue,
  weekday_revenue, card_payment_pct, high_value_transactions, medium_value_transactions,
  low_value_transactions, revenue_rank, pct_of_total_revenue
FROM shop_performance ORDER BY revenue_rank, shop_name"""
    q["shop_by_id"] = mp + """SELECT * EXCLUDE (revenue_cents) FROM shop_performance
WHERE shop_id = upper('shop000007')"""
    q["recent_daily"] = mp + """SELECT transaction_date, shop_id, shop_name, daily_revenue,
  total_transactions, avg_transaction_value, day_of_week, is_weekend
FROM daily ORDER BY transaction_date DESC, shop_id LIMIT 100"""
    wk = f"""SELECT day_of_week,
  {avg_amt('sum(revenue_cents)', 'count(revenue_cents)')} AS avg_revenue,
  {amt('sum(revenue_cents)')} AS total_revenue,
  CAST(sum(total_transactions) AS BIGINT) AS total_transactions
FROM daily GROUP BY day_of_week"""
    q["revenue_by_weekday"] = mp + wk + " ORDER BY avg_revenue DESC"
    q["weekday_reindexed"] = mp + f"""SELECT d.day_of_week, d.display_order,
  coalesce(w.avg_revenue, 0.0) AS avg_revenue
FROM (VALUES {_weekday_values()}) AS d(day_of_week, display_order)
LEFT JOIN ({wk}) w ON w.day_of_week = d.day_of_week ORDER BY d.display_order"""
    plist = """SELECT shop_name, product_name, category, total_revenue, total_units_sold,
  avg_sale_value, revenue_rank_in_shop, pct_of_shop_revenue FROM top_products
WHERE revenue_rank_in_shop <= {k} ORDER BY shop_name, revenue_rank_in_shop, product_name"""
    q["top5_products_per_shop"] = mp + plist.format(k=5)
    q["top_products_from_sums"] = q["top5_products_per_shop"]
    q["top3_products_per_shop"] = mp + plist.format(k=3)
    q["portfolio_summary"] = mp + f"""SELECT count(*) AS total_shops,
  {amt('sum(revenue_cents)')} AS total_revenue,
  CAST(sum(total_transactions) AS BIGINT) AS total_transactions,
  {avg_amt('sum(avg_cents)', 'count(avg_cents)')} AS avg_transaction_value,
  CAST(sum(unique_customers) AS BIGINT) AS total_customers
FROM (SELECT *, CAST(round(avg_transaction_value * 100) AS BIGINT) AS avg_cents
      FROM shop_performance)"""
    q["portfolio_summary_true"] = mp + f"""SELECT count(DISTINCT shop_id) AS total_shops,
  {amt('sum(total_cents)')} AS total_revenue, count(transaction_id) AS total_transactions,
  {avg_amt('sum(total_cents)', 'count(total_cents)')} AS avg_transaction_value,
  count(DISTINCT customer_id) AS total_customers
FROM stg"""
    q["shop_bars"] = mp + f"""SELECT shop_id, shop_name, total_revenue, revenue_rank,
  {pct0('revenue_cents', 'max(revenue_cents) OVER ()')} AS bar_pct,
  CASE WHEN revenue_rank <= 3 THEN 'rank-' || CAST(revenue_rank AS VARCHAR)
       ELSE 'rank-other' END AS badge_class
FROM shop_performance"""
    q["formatted_shops"] = mp + f"""SELECT shop_id,
  regexp_replace(shop_name, '^([^ ]*) ', '\\1' || chr(10)) AS chart_label,
  '$' || format('{{:,}}', CAST({hu('revenue_cents', '100')} AS BIGINT)) AS revenue_text,
  format('{{:,}}', total_transactions) AS transactions_text,
  '$' || format('{{:,}}', CAST({hu('CAST(round(avg_transaction_value * 100) AS BIGINT)', '100')} AS BIGINT))
    AS avg_sale_text,
  '$' || CAST(CAST({hu('revenue_cents', '100000')} AS BIGINT) AS VARCHAR) || 'K' AS axis_label,
  CAST(CAST(CAST({hu('CAST(round(pct_of_total_revenue * 100) AS BIGINT)', '10')} AS DECIMAL(20,0)) / 10
       AS DECIMAL(20,1)) AS VARCHAR) || '%' AS share_text
FROM shop_performance"""
    q["value_mix"] = mp + f"""SELECT shop_id, shop_name,
  {pct2('high_value_transactions', 'total_transactions')} AS high_value_pct,
  {pct2('medium_value_transactions', 'total_transactions')} AS medium_value_pct,
  {pct2('low_value_transactions', 'total_transactions')} AS low_value_pct
FROM shop_performance"""
    q["weekend_share"] = mp + f"""SELECT shop_id, shop_name,
  {pct2('CAST(round(weekend_revenue * 100) AS BIGINT)', 'revenue_cents')} AS weekend_revenue_pct,
  {pct2('weekend_transactions', 'total_transactions')} AS weekend_transactions_pct
FROM shop_performance"""
    q["peer_ratio"] = mp + f"""SELECT shop_id, shop_name, avg_transaction_value,
  (CAST({hu('avg_cents * 100', 'max(avg_cents) OVER ()')} AS DOUBLE) / 100) AS ratio_to_top_avg
FROM (SELECT *, CAST(round(avg_transaction_value * 100) AS BIGINT) AS avg_cents
      FROM shop_performance)"""
    q["bottom_products"] = mp + """SELECT shop_id, shop_name, product_name, category, total_revenue
FROM (SELECT *, rank() OVER (PARTITION BY shop_id ORDER BY revenue_cents ASC) AS r
      FROM top_products) WHERE r = 1"""
    q["top_products_overall"] = mp + """SELECT shop_id, shop_name, product_name, category,
  total_revenue, overall_rank
FROM (SELECT *, CAST(rank() OVER (ORDER BY revenue_cents DESC) AS INTEGER) AS overall_rank
      FROM top_products) WHERE overall_rank <= 5"""
    q["customers_per_shop"] = mp + f"""SELECT count(unique_customers) AS shops,
  (CAST({hu('sum(unique_customers) * 100', 'count(unique_customers)')} AS DOUBLE) / 100)
    AS avg_customers_per_shop,
  (SELECT count(DISTINCT customer_id) FROM stg) AS distinct_customers
FROM shop_performance"""
    q["insight_context"] = mp + f""", wk AS (
  SELECT day_of_week, {avg_amt('sum(revenue_cents)', 'count(revenue_cents)')} AS avg_revenue
  FROM daily GROUP BY day_of_week)
SELECT 'shop' AS section, shop_id, revenue_rank AS position,
  to_json(struct_pack(shop_name := shop_name, city := city,
    total_revenue := CAST(total_revenue AS DECIMAL(20,2)),
    avg_transaction_value := CAST(avg_transaction_value AS DECIMAL(20,2)),
    revenue_rank := revenue_rank,
    pct_of_total_revenue := CAST(pct_of_total_revenue AS DECIMAL(20,2)))) AS json
FROM shop_performance
UNION ALL
SELECT 'product', shop_id, revenue_rank_in_shop,
  to_json(struct_pack(product_name := product_name, category := category,
    total_revenue := CAST(total_revenue AS DECIMAL(20,2))))
FROM top_products WHERE revenue_rank_in_shop <= 3
UNION ALL
SELECT 'weekday', NULL, d.display_order,
  to_json(struct_pack(day_of_week := wk.day_of_week,
    avg_revenue := CAST(avg_revenue AS DECIMAL(20,2))))
FROM wk JOIN (VALUES {_weekday_values()}) AS d(day_of_week, display_order)
  ON d.day_of_week = wk.day_of_week"""
    q["calendar_spine_daily"] = spine + f"""SELECT transaction_date, shop_id, day_of_week,
  {amt('revenue_cents')} AS daily_revenue, total_transactions FROM spine"""
    q["revenue_by_weekday_filled"] = spine + f"""SELECT day_of_week,
  {avg_amt('sum(revenue_cents)', 'count(revenue_cents)')} AS avg_revenue,
  count(revenue_cents) AS shop_days
FROM spine GROUP BY day_of_week"""
    q["seasonally_adjusted_daily"] = mp + f"""SELECT transaction_date, shop_id, daily_revenue,
  (CAST({_factor('transaction_date')} AS DOUBLE) / 1000) AS demand_factor,
  {amt(hu('revenue_cents * 1000', _factor('transaction_date')))} AS adjusted_revenue
FROM daily"""
    return q


def io_oracle_sql(p: Params = FIXTURE) -> dict[str, str]:
    proc = with_ctes(raw_tx_cte(), dedup_cte(), clean_cte(p=p), processed_cte(p))
    mp = marts_prefix(p)
    pub = ("transaction_id, date, time, shop_id, shop_name, city, product_name, category,"
           " quantity, unit_price, total_amount, customer_id, payment_method, day_of_week,"
           " month_name, year, month_number, is_weekend, revenue_category,"
           " true AS processed_timestamp")
    q = {}
    q["quality_unique"] = with_ctes(raw_tx_cte()) + """SELECT transaction_id, count(*) AS n_rows
FROM raw_tx WHERE transaction_id IS NOT NULL GROUP BY transaction_id HAVING count(*) > 1"""
    q["quality_not_null"] = with_ctes(raw_tx_cte(), dirty_tx_cte()) + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_null,"
        f" count(*) AS n_rows FROM dirty_tx" for c in _CRIT)
    q["quality_amount"] = proc + """SELECT transaction_id, unit_price, quantity,
  CAST(total_cents AS DOUBLE) / 100 AS total_amount,
  CAST(CAST(round(unit_price * 100) AS BIGINT) * quantity AS DOUBLE) / 100 AS expected_amount
FROM processed
WHERE CAST(round(unit_price * 100) AS BIGINT) * CAST(quantity AS BIGINT) <> total_cents"""
    q["variant_load"] = proc + f"SELECT {pub} FROM processed"
    q["csv_roundtrip"] = with_ctes(
        raw_tx_cte(), dirty_tx_cte(), dedup_cte("dirty_tx"), clean_cte(p=p)) + f"""
SELECT transaction_id, date, time, shop_id, shop_name, city, product_name, category, quantity,
       unit_price, total_amount, customer_id, payment_method
FROM clean"""
    q["parquet_roundtrip"] = proc + f"SELECT {pub} FROM processed"
    q["shop_partitioned"] = with_ctes(raw_tx_cte(), dirty_tx_cte()) + """SELECT transaction_id, date,
  time, shop_id, shop_name, city, product_name, category, quantity, unit_price, total_amount,
  customer_id, payment_method FROM dirty_tx"""
    q["idempotent_load"] = proc + f"""SELECT year, month_number, count(*) AS n_rows,
  {amt('sum(total_cents)')} AS total_amount FROM processed
WHERE NOT (year = 1997 AND month_number = 7)
  AND NOT (year = 1998 AND month_number = 5 AND quantity <= 10)
GROUP BY year, month_number"""
    q["json_load"] = proc + f"SELECT {pub} FROM processed WHERE total_cents % 10 <> 7"
    q["json_load_audit"] = proc + """SELECT count(*) AS n_lines,
  count(*) FILTER (WHERE total_cents % 10 <> 7) AS n_loaded,
  count(*) FILTER (WHERE total_cents % 10 = 7) AS n_rejected FROM processed"""
    q["load_record"] = proc + """SELECT CAST(CASE WHEN year <= 1997 THEN 1 ELSE 2 END AS BIGINT) AS load_id,
  CAST(year AS INTEGER) AS landed, 'loaded' AS status,
  count(*) FILTER (WHERE total_cents % 10 <> 7) AS rows_loaded,
  count(*) FILTER (WHERE total_cents % 10 = 7) AS rows_rejected
FROM processed WHERE year <= 1998 GROUP BY year
UNION ALL SELECT 2, 0, 'skipped', 0, 0"""
    q["load_rows"] = proc + f"SELECT {pub} FROM processed WHERE year <= 1998 AND total_cents % 10 <> 7"
    messy = """messy_tx AS (
  SELECT * EXCLUDE (date, quantity),
         CASE WHEN c0 % 137 = 0 THEN NULL ELSE date END AS date,
         CASE WHEN c0 % 139 = 0 THEN NULL ELSE quantity END AS quantity
  FROM dirty_tx WHERE c0 % 149 <> 0)"""
    q["csv_messy"] = with_ctes(raw_tx_cte(), dirty_tx_cte(), messy,
                               _labeled_cte(p, "messy_tx")) + """
SELECT reject_reason AS outcome, n_rows FROM reason_counts
UNION ALL
SELECT 'malformed', count(*) FROM dirty_tx WHERE c0 % 149 = 0"""
    q["json_sink"] = serving_oracle_sql(p)["shops"]
    q["column_contract"] = "SELECT * FROM (VALUES " + ", ".join(
        f"('{c}', '{d}', CAST(NULL AS VARCHAR))" for c, d in SOURCE_DOCS.items()) + \
        ") AS t(column_name, expected_comment, problem)"
    q["shops_json"] = mp + """SELECT shop_id, to_json(struct_pack(
  shop_id := shop_id, shop_name := shop_name, city := city,
  total_revenue := CAST(total_revenue AS DECIMAL(20,2)),
  total_transactions := total_transactions,
  avg_transaction_value := CAST(avg_transaction_value AS DECIMAL(20,2)),
  unique_customers := unique_customers,
  revenue_per_customer := CAST(revenue_per_customer AS DECIMAL(20,2)),
  weekend_revenue := CAST(weekend_revenue AS DECIMAL(20,2)),
  weekday_revenue := CAST(weekday_revenue AS DECIMAL(20,2)),
  card_payment_pct := CAST(card_payment_pct AS DECIMAL(20,2)),
  revenue_rank := revenue_rank,
  pct_of_total_revenue := CAST(pct_of_total_revenue AS DECIMAL(20,2)))) AS json
FROM shop_performance"""
    q["warehouse_revenue_by_shop"] = proc + f"""SELECT shop_name,
  {amt('sum(total_cents)')} AS total_revenue,
  {avg_amt('sum(total_cents)', 'count(total_cents)')} AS avg_sale_value,
  count(transaction_id) AS total_transactions
FROM processed GROUP BY shop_name"""
    q["warehouse_shop_performance"] = mp + "SELECT * EXCLUDE (revenue_cents) FROM shop_performance"
    q["warehouse_shop_reconciliation"] = mp + f"""SELECT s.shop_id, d.days, p.products,
  {amt('s.revenue_cents')} AS shop_revenue, {amt('d.cents')} AS revenue_by_day,
  {amt('p.cents')} AS revenue_by_product
FROM shop_performance s
JOIN (SELECT shop_id, count(*) AS days, sum(revenue_cents) AS cents FROM daily GROUP BY 1) d USING (shop_id)
JOIN (SELECT shop_id, count(*) AS products, sum(revenue_cents) AS cents FROM top_products GROUP BY 1) p
  USING (shop_id)"""
    q["customer_history"] = proc + f"""SELECT transaction_id, date, shop_id, product_name,
  {amt('total_cents')} AS total_amount FROM processed WHERE customer_id = 'CUST000007'"""
    q["report_lines"] = mp + f"""SELECT shop_id, concat_ws(' | ', '#' || CAST(revenue_rank AS VARCHAR),
  shop_name, city,
  '$' || format('{{:,}}', CAST({hu('revenue_cents', '100')} AS BIGINT)),
  CAST(CAST(CAST({hu('CAST(round(pct_of_total_revenue * 100) AS BIGINT)', '10')} AS DECIMAL(20,0)) / 10
       AS DECIMAL(20,1)) AS VARCHAR) || '%') AS line
FROM shop_performance"""
    q["text_sink"] = f"SELECT line FROM ({q['report_lines']})"
    return q


def stream_oracle_sql() -> dict[str, str]:
    ev = f"""WITH ev AS (
  SELECT CAST(event_id AS VARCHAR) AS transaction_id, CAST(ts AS DATE) AS date, event_id, ts,
         event_type AS shop_id, CAST(user_id AS VARCHAR) AS customer_id,
         CAST(round(value * 100) AS BIGINT) AS total_cents
  FROM events)
"""
    q = {}
    q["stream_dedup"] = ev + f"""SELECT transaction_id, date, shop_id, customer_id,
  {amt('total_cents')} AS total_amount, dayname(date) AS day_of_week,
  coalesce(dayofweek(date) IN (0, 6), false) AS is_weekend
FROM ev WHERE total_cents > 0 AND shop_id IS NOT NULL"""
    q["stream_daily"] = ev + f"""SELECT date AS window_date, shop_id,
  {amt('sum(total_cents)')} AS revenue, count(*) AS transactions,
  {amt('min(total_cents)')} AS min_transaction_value,
  {amt('max(total_cents)')} AS max_transaction_value
FROM ev WHERE total_cents > 0 AND shop_id IS NOT NULL GROUP BY date, shop_id"""
    # the first landing's newest event, in whole milliseconds, sets the watermark; later
    # rows of the second landing whose id is not in the first are lost to silver
    q["stream_late"] = ev.rstrip() + f""",
ok AS (SELECT * FROM ev WHERE total_cents > 0 AND shop_id IS NOT NULL),
mark AS (SELECT epoch_ms(max(ts)) - 86400000 AS ms FROM ok WHERE event_id % 10 < 9)
SELECT transaction_id, date, shop_id, customer_id, {amt('total_cents')} AS total_amount
FROM ok, mark WHERE event_id % 10 = 9 AND epoch_us(ts) <= ms * 1000"""
    # copies (ids ending in 8) have twice the value, so the event itself is the first in the
    # fixed order; a session of one hour is out once the watermark has passed it
    first = ev.rstrip() + """,
ok AS (SELECT * FROM ev WHERE total_cents > 0 AND shop_id IS NOT NULL),
mark AS (SELECT epoch_ms(max(ts)) - 11 * 86400000 AS ms FROM ok),
silver AS (SELECT ok.* FROM ok, mark WHERE epoch_us(ts) + 3600000000 <= ms * 1000)
"""
    q["stream_ordered_dedup"] = first + f"""SELECT transaction_id, date, shop_id, customer_id,
  {amt('total_cents')} AS total_amount FROM silver"""
    q["stream_customers"] = first + """SELECT date AS window_date, shop_id,
  count(DISTINCT customer_id) AS customers
FROM silver
WHERE epoch_ms(CAST(date AS TIMESTAMP)) + 86400000
      <= (SELECT epoch_ms(max(ts)) - 11 * 86400000 FROM silver)
GROUP BY date, shop_id HAVING count(DISTINCT customer_id) > 0"""
    return q

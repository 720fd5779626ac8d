"""The same results as DuckDB SQL over the driver's tables, as an independent check."""

from orderloom.plans.queries import BRIDGE_CATEGORY, FIRST_LATE_DAY, GATE_LIMIT, METRICS

RAW = """
b_orders AS (
  SELECT CASE WHEN l_orderkey % 97 = 0 THEN 'bad id' ELSE 'A-' || CAST(l_orderkey AS VARCHAR) END AS order_id,
         CASE WHEN l_orderkey % 53 = 0 THEN '' WHEN l_orderkey % 59 = 0 THEN NULL
              ELSE CAST(o_custkey AS VARCHAR) END AS cust_id,
         CASE WHEN l_orderkey % 61 = 0 THEN 'n/a'
              ELSE month(o_orderdate) || '/' || day(o_orderdate) || '/' || year(o_orderdate)
                   || ' ' || l_linenumber || ':05' END AS order_date,
         CASE WHEN l_orderkey % 83 = 0 THEN 'x' ELSE CAST(l_partkey AS VARCHAR) END AS prod_id,
         CASE WHEN l_orderkey % 67 = 0 THEN '0.1' WHEN l_orderkey % 71 = 0 THEN '-1'
              WHEN l_orderkey % 73 = 0 THEN 'x' ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS quantity,
         CASE o_orderstatus WHEN 'F' THEN ' Paid' WHEN 'O' THEN 'created' ELSE 'SHIPPED' END AS status
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  CROSS JOIN (VALUES (1), (2)) copies(copy)
  WHERE copy = 1 OR l_orderkey % 41 = 0
),
b_product AS (
  SELECT CAST(p_partkey AS INTEGER) AS prod_id, CAST(p_partkey % 25 AS INTEGER) AS cat_id,
         p_name AS prod_name, p_retailprice AS price,
         CASE p_partkey % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'Yen' ELSE ' eur' END AS currency
  FROM part
),
b_edges AS (
  SELECT CAST(n_nationkey AS INTEGER) AS cat_id, n_name AS child, r_name AS parent
  FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL
  SELECT CAST(100 + r_regionkey AS INTEGER), r_name, 'all' FROM region WHERE r_name <> 'MIDDLE EAST'
),
b_rates AS (
  SELECT CAST(date_trunc('week', o_orderdate) AS DATE) AS fx_date,
         CASE o_orderkey % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'YEN' ELSE 'EUR' END AS currency,
         COUNT(*) * 0.5e0 + 1.0e0 AS conversion
  FROM orders GROUP BY 1, 2
),
b_customer AS (
  SELECT CASE WHEN o_custkey % 103 = 0 THEN ' ' ELSE o_custkey || ' ' END AS cust_id,
         CASE WHEN (o_custkey + y) % 29 = 0 THEN 'n/a'
              ELSE month(since) || '/' || day(since) || '/' || year(since) END AS created_at,
         n_name AS country, r_name AS region, c_mktsegment AS type,
         CAST(o_custkey % 90000 + 10000 AS VARCHAR) AS zip,
         CASE WHEN (y + copy) % 2 = 0 THEN 'Y' ELSE 'n' END AS active
  FROM (SELECT o_custkey, year(o_orderdate) AS y, MIN(o_orderdate) AS since FROM orders GROUP BY 1, 2) v
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON (c_nationkey + y) % 25 = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  CROSS JOIN (VALUES (0), (1)) copies(copy)
  WHERE copy = 0 OR o_custkey % 37 = 0
)"""

ORDERS = """
flagged AS (
  SELECT *, CASE WHEN cust IS NULL OR cust = '' THEN 'orphan_customer'
                 WHEN q IS NULL THEN 'bad_quantity'
                 WHEN q <= 0 THEN 'non_positive_quantity'
                 WHEN q <> floor(q) THEN 'fractional_quantity'
                 WHEN ts IS NULL THEN 'bad_timestamp'
                 WHEN digits = '' THEN 'bad_order_id'
                 WHEN pid IS NULL THEN 'missing_product' END AS dq_reason
  FROM (SELECT *, trim(cust_id) AS cust, TRY_CAST(quantity AS DOUBLE) AS q,
               try_strptime(order_date, '%m/%d/%Y %H:%M') AS ts,
               regexp_extract(order_id, '^([A-Za-z]+)-([0-9]+)$', 1) AS prefix,
               ltrim(regexp_extract(order_id, '^([A-Za-z]+)-([0-9]+)$', 2), '0') AS significant,
               regexp_extract(order_id, '^([A-Za-z]+)-([0-9]+)$', 2) AS digits,
               TRY_CAST(prod_id AS INTEGER) AS pid, lower(trim(status)) AS st
        FROM b_orders) typed
),
clean AS (
  SELECT prefix || '-' || CASE WHEN length(significant) >= 3 THEN significant
                               ELSE lpad(significant, 3, '0') END AS order_id,
         cust AS cust_id, pid AS prod_id, ts AS order_ts, CAST(ts AS DATE) AS order_day,
         q AS quantity, st AS status
  FROM flagged WHERE dq_reason IS NULL
),
lines AS (
  SELECT order_id, MIN(cust_id) AS cust_id, prod_id, order_ts, CAST(order_ts AS DATE) AS order_day,
         quantity, status
  FROM clean GROUP BY order_id, prod_id, order_ts, quantity, status
)"""

CUSTOMERS = """
versions AS (
  SELECT *, row_number() OVER (
           PARTITION BY cust_id, valid_from
           ORDER BY CASE WHEN is_active THEN 0 ELSE 1 END, country, region, type, zip) AS pick
  FROM (SELECT trim(cust_id) AS cust_id, CAST(try_strptime(created_at, '%m/%d/%Y') AS DATE) AS valid_from,
               country, lower(trim(region)) AS region, lower(trim(type)) AS type, zip,
               lower(trim(active)) = 'y' AS is_active
        FROM b_customer) c
  WHERE cust_id <> '' AND valid_from IS NOT NULL
),
dim_customer AS (
  SELECT sha256(cust_id || '|' || CAST(valid_from AS VARCHAR)) AS customer_sk, cust_id, country, region,
         type, zip, is_active, valid_from,
         COALESCE(following - 1, DATE '9999-12-31') AS valid_to, following IS NULL AS is_current
  FROM (SELECT *, lead(valid_from) OVER (PARTITION BY cust_id ORDER BY valid_from) AS following
        FROM versions WHERE pick = 1) chained
)"""

PRODUCTS = """
walk(cat_id, category_name, node, depth) AS (
  SELECT cat_id, child, child, 0 FROM b_edges
  UNION ALL
  SELECT w.cat_id, w.category_name, e.parent, w.depth + 1
  FROM walk w JOIN b_edges e ON w.node = e.child
  WHERE e.parent <> 'all' AND w.depth <= 10
),
dim_category AS (
  SELECT cat_id, category_name, arg_max(node, depth) AS root_category FROM walk GROUP BY 1, 2
),
dim_product AS (
  SELECT prod_id, p.cat_id, trim(prod_name) AS prod_name, price, upper(trim(currency)) AS currency,
         category_name, root_category
  FROM b_product p LEFT JOIN dim_category c ON p.cat_id = c.cat_id
),
priced AS (
  SELECT l.*, p.cat_id, p.root_category, p.currency, p.price
  FROM lines l LEFT JOIN dim_product p ON l.prod_id = p.prod_id
)"""

FACT = """
converted AS (
  SELECT p.*, r.conversion FROM priced p
  ASOF LEFT JOIN b_rates r ON p.currency = r.currency AND p.order_day >= r.fx_date
),
fact AS (
  SELECT order_id, cust_id, prod_id, cat_id, root_category, order_ts, order_day, quantity, status,
         COALESCE(status IN ('paid', 'shipped'), false) AS is_revenue_status, currency, conversion, price,
         price * quantity * conversion AS revenue_usd
  FROM converted
)"""


def _with(*parts: str, select: str) -> str:
    return f"WITH RECURSIVE {','.join(parts)}\n{select}"


_ORDERS = (RAW, ORDERS)
_CUSTOMERS = (RAW, CUSTOMERS)
_PRODUCTS = (RAW, ORDERS, PRODUCTS)
_FACT = (RAW, ORDERS, PRODUCTS, FACT)
_ALL = (RAW, ORDERS, CUSTOMERS, PRODUCTS, FACT)

_CONVERTED = """SELECT order_id, cust_id, prod_id, order_ts, order_day, quantity, status, cat_id,
  root_category, currency, price, conversion FROM converted"""


_FIXED = {"quantity": "18,2", "conversion": "18,8", "price": "18,2", "revenue_usd": "18,4"}


def _mart() -> str:
    cast = _FIXED
    fixed = ", ".join(f"CAST(CAST({c} AS DECIMAL({t})) AS DOUBLE) AS {c}" for c, t in cast.items())
    return f"SELECT * REPLACE ({fixed}) FROM fact"


def _merged() -> str:
    late = f"DATE '{FIRST_LATE_DAY}'"
    return _with(
        *_CUSTOMERS,
        f"""
target AS (SELECT * FROM dim_customer WHERE valid_from < {late}),
delta AS (SELECT * REPLACE (zip || '-0' AS zip) FROM dim_customer
          WHERE valid_from >= {late} OR zip LIKE '____7'),
merged AS (SELECT * FROM delta UNION ALL
           SELECT * FROM target t WHERE NOT EXISTS (
             SELECT 1 FROM delta d WHERE d.cust_id = t.cust_id AND d.valid_from = t.valid_from))""",
        select="""SELECT customer_sk, cust_id, country, region, type, zip, is_active, valid_from,
       COALESCE(following - 1, DATE '9999-12-31') AS valid_to, following IS NULL AS is_current
FROM (SELECT *, lead(valid_from) OVER (PARTITION BY cust_id ORDER BY valid_from) AS following FROM merged) c""",
    )


# Events whose product ends in 99 arrive with text after the JSON object.
_EVENTS = """
arrived AS (SELECT *, CASE WHEN prod_id LIKE '%99' THEN 'decode' ELSE dq_reason END AS verdict FROM flagged)"""

_GOOD_EVENTS = """
SELECT prefix || '-' || CASE WHEN length(significant) >= 3 THEN significant
                                     ELSE lpad(significant, 3, '0') END AS order_id,
       cust AS cust_id, strftime(ts, '%-m/%-d/%Y %H:%M') AS order_date, pid AS prod_id,
       CAST(q AS BIGINT) AS quantity, st AS status
FROM arrived WHERE verdict IS NULL"""

_MANIFEST = """
notified AS (
  SELECT *, 'bronze/raw/' || dataset || '/day 1/' || CASE WHEN p_partkey % 13 = 0 THEN '_' ELSE '' END
            || p_name || '-' || p_partkey || CASE WHEN p_partkey % 5 = 0 THEN '.json' ELSE '.csv' END AS key,
         CASE WHEN p_partkey % 11 = 0 THEN 0 ELSE p_partkey * 10 END AS size
  FROM (SELECT *, ['customer', 'orders', 'product', 'prod_cat_tree', 'currency_conversion', 'surprise']
                  [p_partkey % 6 + 1] AS dataset FROM part) placed
),
manifest AS (
  SELECT key, dataset, size, CASE WHEN reason IS NULL THEN 'accepted' ELSE 'rejected' END AS status, reason
  FROM (SELECT *, CASE WHEN dataset = 'surprise' THEN 'unexpected_dataset:surprise'
                       WHEN p_partkey % 13 = 0 THEN 'hidden_name' WHEN p_partkey % 11 = 0 THEN 'empty_file'
                       WHEN p_partkey % 7 = 0 AND p_partkey % 5 <> 0 THEN 'missing_or_malformed_header' END AS reason
        FROM notified) judged
)"""

_CONVERSION = f"""
SELECT ROUND(SUM(earned) FILTER (realised), 4) AS revenue_usd,
       COUNT(*) FILTER (realised) AS realized_orders,
       COUNT(*) AS total_orders,
       ROUND(COUNT(*) FILTER (realised) / NULLIF(COUNT(*), 0), 4) AS conversion_rate,
       CAST(SUM(units) FILTER (realised) AS DOUBLE) AS quantity_sold
FROM (SELECT order_id, bool_or(is_revenue_status) AS realised,
             SUM(revenue_usd) FILTER (is_revenue_status) AS earned,
             SUM(quantity) FILTER (is_revenue_status) AS units
      FROM fact WHERE root_category = '{BRIDGE_CATEGORY}' GROUP BY order_id) per_order"""

_TOP = """
SELECT region, prod_name, ROUND(SUM(usd), 4) AS revenue_usd,
       CAST(rank() OVER (PARTITION BY region ORDER BY ROUND(SUM(usd), 4) DESC NULLS LAST) AS INTEGER) AS rnk
FROM (SELECT cust_id, order_day, prod_id, SUM(revenue_usd) AS usd
      FROM fact WHERE is_revenue_status GROUP BY ALL) sold
JOIN dim_customer v ON v.cust_id = sold.cust_id AND order_day >= valid_from AND order_day <= valid_to
JOIN dim_product p ON p.prod_id = sold.prod_id
GROUP BY region, prod_name
QUALIFY rnk <= 3 ORDER BY region, rnk"""

_LIFETIME = """
SELECT spent.cust_id, c.is_active AS currently_active, lifetime_value_usd, realized_orders
FROM (SELECT cust_id, ROUND(SUM(earned), 4) AS lifetime_value_usd, COUNT(*) FILTER (realised) AS realized_orders
      FROM (SELECT cust_id, order_id, bool_or(is_revenue_status) AS realised,
                   SUM(revenue_usd) FILTER (is_revenue_status) AS earned
            FROM fact GROUP BY ALL) per_order
      GROUP BY cust_id) spent
LEFT JOIN dim_customer c ON c.is_current AND c.cust_id = spent.cust_id
ORDER BY lifetime_value_usd DESC NULLS LAST"""

_DAU = """
SELECT seen.order_day, v.region, COUNT(*) AS daily_active_users
FROM (SELECT DISTINCT order_day, cust_id FROM lines) seen
JOIN dim_customer v ON v.cust_id = seen.cust_id AND seen.order_day >= v.valid_from AND seen.order_day <= v.valid_to
GROUP BY ALL ORDER BY ALL"""

_CALENDAR = """
SELECT d AS date_key, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
       CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
       CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, dayofweek(d) IN (0, 6) AS is_weekend
FROM (SELECT CAST(unnest(generate_series(MIN(order_day), MAX(order_day), INTERVAL 1 DAY)) AS DATE) AS d
      FROM clean) days"""

_QUARANTINE = """
SELECT order_id, cust AS cust_id, pid AS prod_id, st AS status, dq_reason, quantity, order_date,
       prod_id AS prod_id_text FROM flagged WHERE dq_reason IS NOT NULL"""

_STAGES = """
SELECT 'orders_raw' AS stage, COUNT(*) AS "rows" FROM b_orders
UNION ALL SELECT 'orders_quarantine', COUNT(*) FROM flagged WHERE dq_reason IS NOT NULL
UNION ALL SELECT 'orders_deduped', COUNT(*) FROM lines
UNION ALL SELECT 'fact_orders', COUNT(*) FROM fact
UNION ALL SELECT 'dim_customer', COUNT(*) FROM dim_customer
UNION ALL SELECT 'customer_quarantine', COUNT(*) FROM b_customer WHERE trim(cust_id) = '' OR created_at = 'n/a'
UNION ALL SELECT 'dim_category', COUNT(*) FROM dim_category
UNION ALL SELECT 'dim_product', COUNT(*) FROM dim_product
UNION ALL SELECT 'unknown_customers', COUNT(DISTINCT cust_id) FROM lines
  WHERE cust_id NOT IN (SELECT cust_id FROM dim_customer)
UNION ALL SELECT 'unknown_products', COUNT(DISTINCT prod_id) FROM lines
  WHERE prod_id NOT IN (SELECT prod_id FROM dim_product)"""



def _figures(name: str, sql: str) -> str:
    """A metric as one row per figure."""
    keys, numbers = METRICS[name]
    item = " || '|' || ".join(f"CAST({k} AS VARCHAR)" for k in keys) or "''"
    return " UNION ALL ".join(
        f"SELECT '{name}' AS metric, {item} AS item, '{n}' AS figure, CAST({n} AS DOUBLE) AS value FROM ({sql})" for n in numbers
    )


_GOLD = " UNION ALL ".join(
    _figures(name, sql)
    for name, sql in {
        "dau_by_region": _DAU,
        "category_conversion": _CONVERSION,
        "top_products_by_region": _TOP,
        "customer_lifetime_value": _LIFETIME,
        "dq_reason_counts": "SELECT dq_reason, COUNT(*) AS faulty_count FROM flagged WHERE dq_reason IS NOT NULL GROUP BY 1",
    }.items()
)

# The fact in the mart's fixed-point types.
_FIXED_FACT = (
    FACT.replace("\nfact AS (", "\nlanded AS (")
    + ",\nfact AS (SELECT * REPLACE ("
    + ", ".join(f"CAST({c} AS DECIMAL({t})) AS {c}" for c, t in _FIXED.items())
    + ") FROM landed)"
)

_KEPT_DAILY = " UNION ALL ".join(
    _figures(name, sql)
    for name, sql in {
        "dau_by_region": _DAU,
        "category_conversion": _CONVERSION,
        "top_products_by_region": _TOP,
        "customer_lifetime_value": _LIFETIME,
    }.items()
)

# Nation and dataset decide together whether a file has a comma.
_LANDED = """
SELECT dataset, 'c_nationkey=' || c_nationkey AS folder,
       CASE WHEN reason IS NULL THEN 'accepted' ELSE 'rejected' END AS status, reason,
       CAST(1 AS BIGINT) AS files, CAST(bytes AS BIGINT) AS bytes
FROM (SELECT dataset, c_nationkey,
             CASE WHEN dataset = 'surprise' THEN 'unexpected_dataset:surprise'
                  WHEN (c_nationkey + number) % 7 = 0 THEN 'missing_or_malformed_header' END AS reason,
             SUM(strlen(CAST(c_custkey AS VARCHAR)) + strlen(c_name) + 2) AS bytes
      FROM customer CROSS JOIN (VALUES ('customer', 0), ('orders', 1), ('product', 2), ('prod_cat_tree', 3),
                                       ('currency_conversion', 4), ('surprise', 5)) d(dataset, number)
      GROUP BY dataset, number, c_nationkey) placed"""

_REJECTS = """
SELECT 'product' AS dataset, 'duplicate_product' AS reason, COUNT(*) AS copies FROM b_product WHERE prod_id % 17 = 0
UNION ALL SELECT 'product', 'corrupt_record', COUNT(*) FROM b_product WHERE prod_id % 23 = 0
UNION ALL SELECT 'prod_cat_tree', 'duplicate_category', COUNT(*) FROM b_edges WHERE cat_id % 5 = 0
UNION ALL SELECT 'customer', 'blank_customer', COUNT(*) FROM b_customer WHERE trim(cust_id) = ''
UNION ALL SELECT 'customer', 'bad_created_at', COUNT(*) FROM b_customer WHERE trim(cust_id) <> '' AND created_at = 'n/a'
UNION ALL SELECT 'customer', 'superseded_version', COUNT(*) FROM versions WHERE pick > 1
UNION ALL SELECT 'currency_conversion', 'unusable_rate', COUNT(*) FROM b_rates WHERE currency = 'USD'
UNION ALL SELECT 'currency_conversion', 'duplicate_rate', COUNT(*) FROM b_rates WHERE currency = 'EUR'"""

_LINES = "SELECT order_id, cust_id, prod_id, order_ts, order_day, quantity, status FROM lines"


def all_oracles() -> dict[str, str]:
    fact_rows = _with(*_FACT, select="SELECT * FROM fact")
    converted = _with(*_FACT, select=_CONVERTED)
    dim_customer = _with(*_CUSTOMERS, select="SELECT * FROM dim_customer")
    lines = _with(*_ORDERS, select=_LINES)
    return {
        "dau_by_region": _with(*_ORDERS, CUSTOMERS, select=_DAU),
        "category_conversion": _with(*_FACT, select=_CONVERSION),
        "order_buckets": _with(*_FACT, select=_CONVERSION),
        "top_products_by_region": _with(*_ALL, select=_TOP),
        "customer_lifetime_value": _with(*_ALL, select=_LIFETIME),
        "metrics_from_gold": _with(*_ALL, select=_GOLD),
        "metrics_kept_daily": _with(RAW, ORDERS, CUSTOMERS, PRODUCTS, _FIXED_FACT, select=_KEPT_DAILY),
        "duplicate_orders": _with(
            *_ORDERS,
            select="""SELECT order_id, prod_id, order_ts, quantity, status, COUNT(*) AS dup_count FROM clean
GROUP BY 1, 2, 3, 4, 5 HAVING COUNT(*) > 1 ORDER BY dup_count DESC""",
        ),
        "dq_reason_counts": _with(
            *_ORDERS,
            select="""SELECT dq_reason, COUNT(*) AS faulty_count FROM flagged
WHERE dq_reason IS NOT NULL GROUP BY 1 ORDER BY 2 DESC""",
        ),
        "clean_orders": _with(*_ORDERS, select="SELECT * FROM clean"),
        "quarantine_orders": _with(*_ORDERS, select=_QUARANTINE),
        "dedup_orders": lines,
        "scd2_customer": dim_customer,
        "quarantine_customers": _with(
            RAW,
            select="""SELECT trim(cust_id) AS cust_id, created_at, lower(region) AS region,
       CASE WHEN trim(cust_id) = '' THEN 'blank_customer' ELSE 'bad_created_at' END AS dq_reason
FROM b_customer WHERE trim(cust_id) = '' OR created_at = 'n/a'""",
        ),
        "category_rollup": _with(*_PRODUCTS, select="SELECT * FROM dim_category"),
        "dim_product": _with(*_PRODUCTS, select="SELECT * FROM dim_product"),
        "dim_date": _with(*_ORDERS, select=_CALENDAR),
        "fx_exact": _with(
            *_PRODUCTS,
            "\nconverted AS (SELECT p.*, r.conversion FROM priced p LEFT JOIN b_rates r"
            " ON p.currency = r.currency AND p.order_day = r.fx_date)",
            select=_CONVERTED,
        ),
        "fx_asof": converted,
        "fx_forward_fill": converted,
        "fact_orders": fact_rows,
        "salted_join": _with(
            *_PRODUCTS,
            select="""SELECT order_id, cust_id, prod_id, order_ts, order_day, quantity, status, price, currency
FROM priced""",
        ),
        "idempotent_append": _with(*_ORDERS, select=f"{_LINES} WHERE order_day >= DATE '{FIRST_LATE_DAY}'"),
        "scd2_merge": _merged(),
        "stage_counts": _with(*_ALL, select=_STAGES),
        "dq_gate": _with(
            *_ORDERS,
            select=f"""SELECT COUNT(*) AS total_rows, COUNT(dq_reason) AS rejected_rows,
       ROUND(COUNT(dq_reason) / COUNT(*), 6) AS reject_share,
       COUNT(dq_reason) / COUNT(*) <= {GATE_LIMIT} AS passed FROM flagged""",
        ),
        # CSV holds no difference between empty text and null, so Spark reads both as null.
        "scan_csv": _with(RAW, select="SELECT * REPLACE (NULLIF(cust_id, '') AS cust_id) FROM b_orders"),
        "scan_rates": _with(RAW, select="SELECT * FROM b_rates"),
        "scan_table": dim_customer,
        "write_table": fact_rows,
        "compact_table": lines,
        "stream_validate": _with(*_ORDERS, _EVENTS, select=_GOOD_EVENTS),
        "stream_dead_letters": _with(
            *_ORDERS,
            _EVENTS,
            select="""SELECT verdict AS dq_reason, COUNT(*) AS dead_letters, CAST(SUM(copies) AS BIGINT) AS events
FROM (SELECT verdict, order_id, cust_id, order_date, prod_id, quantity, status, COUNT(*) AS copies
      FROM arrived WHERE verdict IS NOT NULL GROUP BY 1, 2, 3, 4, 5, 6, 7) distinct_events GROUP BY 1""",
        ),
        "stream_counts": _with(
            *_ORDERS, _EVENTS, select="SELECT COUNT(*) - COUNT(verdict) AS good, COUNT(verdict) AS bad FROM arrived"
        ),
        # Late lines come as events only, so broken events leave no line.
        "unified_orders": _with(
            *_ORDERS,
            select=f"""SELECT order_id, MIN(cust_id) AS cust_id, prod_id, order_ts, order_day, quantity, status FROM clean
WHERE order_day < DATE '{FIRST_LATE_DAY}' OR NOT suffix(CAST(prod_id AS VARCHAR), '99')
GROUP BY order_id, prod_id, order_ts, order_day, quantity, status""",
        ),
        "landing_manifest": _with(_MANIFEST, select="SELECT * FROM manifest"),
        "landing_summary": _with(
            _MANIFEST,
            select="""SELECT dataset, status, COUNT(*) AS files, CAST(SUM(size) AS BIGINT) AS bytes
FROM manifest GROUP BY dataset, status""",
        ),
        "stream_incremental_load": _with(*_FACT, select=_mart()),
        "landing_scan": _LANDED,
        "bronze_by_manifest": lines,
        "input_rejects": _with(*_CUSTOMERS, select=_REJECTS),
        "stream_customer_merge": _merged(),
        "stream_product_upsert": _with(
            *_PRODUCTS, select="SELECT * REPLACE (CAST(CAST(price AS DECIMAL(18, 2)) AS DOUBLE) AS price) FROM dim_product"
        ),
        "stream_category_upsert": _with(*_PRODUCTS, select="SELECT * FROM dim_category"),
        "stream_date_upsert": _with(*_ORDERS, select=_CALENDAR),
        "stream_quarantine_load": _with(*_ORDERS, select=_QUARANTINE),
        "stream_dedup": "SELECT * FROM events",
    }

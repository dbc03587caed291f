"""Independent DuckDB statements for every registered query.

The driver runs these next to the Spark queries at sf0.01 and compares
row count, schema and values.  They are written from the operator
bug in an operator shows up as a mismatch.

Each view below is one SQL body plus the views it reads.  ``sql_for``
assembles a ``WITH`` chain holding exactly the views a statement needs.

Numeric conventions shared with the Spark side:

* money is computed in whole numbers (HUGEINT): prices in millionths, rates in
  1e-14, rounded half up to four decimals; outputs are cast to DOUBLE at the end;
* averages of money use integer arithmetic in 1e-4 units, rounded half up;
* counts are BIGINT, calendar parts and ranks INTEGER.
"""

from __future__ import annotations

import re

from orderlake import constants as K

_ERR_MSG = {code: msg.replace("'", "''") for code, msg in K.ERROR_MESSAGES.items()}

# name -> SQL body.  Dependencies are found by scanning for view names.
VIEWS: dict[str, str] = {}


def _view(name: str, body: str) -> None:
    VIEWS[name] = body.strip()


# ---------------------------------------------------------------- fixtures
_view("order_lines", """
    SELECT o.o_orderkey AS k, o.o_custkey, o.o_orderstatus, o.o_orderdate,
           l.l_partkey, l.l_quantity
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
""")

_view("raw_orders", """
    SELECT 'A-' || CAST(k AS VARCHAR) AS order_id,
           CASE WHEN k % 97 = 0 THEN NULL
                WHEN k % 97 = 1 THEN ' '
                ELSE CAST(o_custkey AS VARCHAR) END AS cust_id,
           strftime(o_orderdate, '%-m/%-d/%Y %-H:%M') AS order_date_raw,
           CASE WHEN k % 131 = 7 THEN '999999999' ELSE CAST(l_partkey AS VARCHAR) END AS prod_id,
           CASE WHEN k % 89 = 0 THEN '0.1'
                WHEN k % 7 = 0 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || '.0'
                ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS quantity_raw,
           CASE o_orderstatus WHEN 'F' THEN ' Shipped' WHEN 'O' THEN 'PAID'
                ELSE 'created ' END AS status
    FROM order_lines, (SELECT 1 AS copy UNION ALL SELECT 2) c
    WHERE c.copy = 1 OR k % 53 = 0
""")

_view("raw_fx", """
    SELECT strftime(o_orderdate, '%Y-%m-%d') AS date,
           CASE WHEN o_orderkey % 10 = 9 THEN 'Idr' WHEN o_orderkey % 3 = 0 THEN 'USD'
                WHEN o_orderkey % 3 = 2 THEN 'Pound' WHEN o_orderkey % 11 = 3 THEN 'YEN '
                ELSE 'Yen' END AS currency,
           CASE WHEN o_orderkey % 10 = 9 THEN (1 + o_orderkey % 7) * 3.95123e-8
                ELSE 0.5 + (o_orderkey % 1000) / 1000 END AS conversion,
           o_orderkey AS seq
    FROM orders
    WHERE year(o_orderdate) <> 1999
""")

_view("leaf_categories", """
    SELECT * FROM (VALUES
        ('1', 'ECONOMY', 'Sweet'), ('2', 'LARGE', 'Sweet'), ('3', 'MEDIUM', 'Sweet'),
        ('4', 'PROMO', 'salt'), ('5', 'SMALL', 'salt'), ('6', 'STANDARD', 'salt'))
        t(cat_id, child, parent)
""")

_view("cat_tree", """
    WITH used AS (SELECT DISTINCT p_type FROM part),
         leaves AS (SELECT l.cat_id, l.child, l.parent
                    FROM leaf_categories l JOIN used u ON l.child = u.p_type),
         roots AS (SELECT * FROM (VALUES ('7', 'Sweet', 'all'), ('8', 'salt', 'all'))
                       t(cat_id, child, parent))
    SELECT * FROM leaves
    UNION ALL
    SELECT r.* FROM roots r WHERE r.child IN (SELECT parent FROM leaves)
""")

_view("raw_product", """
    SELECT CAST(p.p_partkey AS VARCHAR) AS prod_id,
           c.cat_id,
           p.p_name AS prod_name,
           CASE WHEN p.p_partkey % 101 = 5 THEN '150000000.00'
                ELSE CAST(CAST(p.p_retailprice AS DECIMAL(12,2)) AS VARCHAR) END AS price,
           CASE WHEN p.p_partkey % 10 = 9 THEN 'IDR' WHEN p.p_partkey % 3 = 0 THEN 'USD'
                WHEN p.p_partkey % 3 = 1 THEN 'Yen' ELSE 'POUND' END AS currency
    FROM part p LEFT JOIN leaf_categories c ON p.p_type = c.child
""")

_view("raw_customer", """
    SELECT CAST(c.c_custkey AS VARCHAR) AS cust_id,
           strftime(DATE '1994-01-01' + CAST((c.c_custkey * 37 + s.n * 211) % 1000 AS INTEGER),
                    '%-m/%-d/%Y') AS created_at,
           n.n_name AS country,
           r.r_name AS region,
           c.c_mktsegment AS type,
           lpad(CAST((c.c_custkey * 7 + s.n) % 100000 AS VARCHAR), 5, '0') AS zip,
           CASE WHEN c.c_acctbal >= 0 THEN 'y' WHEN c.c_acctbal > -500 THEN 'n' END
               AS active
    FROM customer c
    JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey
    CROSS JOIN (SELECT unnest([0, 1, 2]) AS n) s
""")

_view("customer_snapshots", """
    SELECT user_id, ts, event_id, event_type FROM events
""")

# ------------------------------------------------------------------ bronze
_view("classified_orders", f"""
    SELECT *,
           CASE WHEN cust_id IS NULL OR trim(cust_id) = '' THEN '{K.NULL_CUST_ID}'
                WHEN TRY_CAST(quantity_raw AS DOUBLE) % 1 <> 0 THEN '{K.INVALID_QTY}'
           END AS _error_code
    FROM raw_orders
""")

_view("err_orders", f"""
    SELECT order_id, cust_id, order_date_raw, prod_id, quantity_raw, status,
           _error_code,
           CASE _error_code WHEN '{K.NULL_CUST_ID}' THEN '{_ERR_MSG[K.NULL_CUST_ID]}'
                            ELSE '{_ERR_MSG[K.INVALID_QTY]}' END AS _error_message,
           'raw_orders' AS _source_file
    FROM classified_orders
    WHERE _error_code IS NOT NULL
""")

_view("clean_orders", """
    SELECT DISTINCT order_id, cust_id, order_date_raw, prod_id, quantity_raw, status
    FROM classified_orders
    WHERE _error_code IS NULL AND TRY_CAST(quantity_raw AS DOUBLE) % 1 = 0
""")

_view("bronze_fx", """
    SELECT date, currency, conversion, seq FROM (
        SELECT *, row_number() OVER (PARTITION BY date, upper(trim(currency))
                                     ORDER BY seq DESC) AS rn
        FROM raw_fx) WHERE rn = 1
""")

_view("bronze_customer", """
    SELECT cust_id, created_at, country, region, type, zip, active FROM (
        SELECT *, row_number() OVER (
            PARTITION BY cust_id
            ORDER BY try_strptime(trim(created_at), '%m/%d/%Y') DESC NULLS LAST,
                     created_at DESC NULLS LAST, country DESC NULLS LAST,
                     region DESC NULLS LAST, type DESC NULLS LAST, zip DESC NULLS LAST,
                     active DESC NULLS LAST) AS rn
        FROM raw_customer) WHERE rn = 1
""")

_view("bronze_product", f"""
    SELECT *, CASE WHEN currency <> upper(currency) THEN '{K.CURRENCY_NOTE}' END
                  AS _currency_note
    FROM raw_product
""")

# ------------------------------------------------------------------ silver
_view("silver_customer", """
    SELECT TRY_CAST(cust_id AS BIGINT) AS cust_id,
           CAST(try_strptime(trim(created_at), '%m/%d/%Y') AS DATE) AS created_at,
           country, region,
           lower(trim(type)) AS customer_type,
           trim(zip) AS zip,
           CASE WHEN lower(trim(active)) = 'y' THEN TRUE
                WHEN lower(trim(active)) = 'n' THEN FALSE END AS is_active
    FROM bronze_customer
""")

_view("silver_orders", """
    SELECT order_id,
           TRY_CAST(cust_id AS BIGINT) AS cust_id,
           TRY_CAST(prod_id AS BIGINT) AS prod_id,
           try_strptime(trim(order_date_raw), '%m/%d/%Y %H:%M') AS order_timestamp,
           CAST(try_strptime(trim(order_date_raw), '%m/%d/%Y %H:%M') AS DATE) AS order_date,
           CASE WHEN TRY_CAST(quantity_raw AS DOUBLE) % 1 = 0
                THEN TRY_CAST(TRY_CAST(quantity_raw AS DOUBLE) AS INTEGER) END AS quantity,
           lower(trim(status)) AS status
    FROM clean_orders
""")

_view("category_tree", """
    SELECT TRY_CAST(c.cat_id AS INTEGER) AS cat_id,
           c.child AS category_name,
           COALESCE(p.child, c.child) AS top_category
    FROM cat_tree c
    LEFT JOIN (SELECT DISTINCT child FROM cat_tree) p ON c.parent = p.child
""")

_view("silver_product", """
    SELECT TRY_CAST(r.prod_id AS BIGINT) AS prod_id,
           TRY_CAST(r.cat_id AS INTEGER) AS cat_id,
           r.prod_name,
           TRY_CAST(r.price AS DOUBLE) AS price,
           upper(trim(r.currency)) AS currency,
           t.category_name, t.top_category
    FROM raw_product r
    LEFT JOIN category_tree t ON TRY_CAST(r.cat_id AS INTEGER) = t.cat_id
""")

_view("typed_fx", """
    SELECT CAST(try_strptime(date, '%Y-%m-%d') AS DATE) AS rate_date,
           upper(trim(currency)) AS currency,
           CAST(conversion AS DOUBLE) AS rate_to_usd
    FROM bronze_fx
""")

_view("fx_bounds", """
    SELECT min(rate_date) AS min_date, max(rate_date) AS max_date FROM typed_fx
""")

_view("fx_spine", """
    SELECT CAST(d.rate_date AS DATE) AS rate_date, c.currency
    FROM (SELECT unnest(generate_series(CAST(min_date AS TIMESTAMP),
                                        CAST(max_date AS TIMESTAMP),
                                        INTERVAL 1 DAY)) AS rate_date
          FROM fx_bounds) d,
         (SELECT DISTINCT currency FROM typed_fx) c
""")

_view("fx_rates", f"""
    WITH j AS (
        SELECT s.rate_date, s.currency, t.rate_to_usd AS known_rate
        FROM fx_spine s LEFT JOIN typed_fx t
          ON s.rate_date = t.rate_date AND s.currency = t.currency),
    f AS (
        SELECT rate_date, currency,
               last_value(known_rate IGNORE NULLS) OVER (
                   PARTITION BY currency ORDER BY rate_date
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS rate_to_usd
        FROM j)
    SELECT rate_date, currency, rate_to_usd,
           CASE WHEN rate_to_usd IS NULL THEN '{K.FILL_NONE}'
                WHEN rate_date IN (SELECT rate_date FROM typed_fx) THEN '{K.FILL_ACTUAL}'
                ELSE '{K.FILL_FORWARD}' END AS _fx_fill_method
    FROM f
""")

_view("order_items", """
    SELECT o.order_id, o.cust_id, o.prod_id, p.prod_name, o.order_timestamp,
           o.order_date, o.quantity, o.status, p.price, p.currency, p.cat_id,
           p.category_name, p.top_category, f.rate_to_usd,
           CAST((CAST(round(p.price * 1e6) AS HUGEINT) * o.quantity
                 * CAST(round(f.rate_to_usd * 1e14) AS HUGEINT)
                 + 5000000000000000) // 10000000000000000 AS DECIMAL(28,0))
               * CAST(0.0001 AS DECIMAL(5,4)) AS revenue_usd,
           f._fx_fill_method
    FROM silver_orders o
    JOIN silver_product p ON o.prod_id = p.prod_id
    LEFT JOIN fx_rates f ON o.order_date = f.rate_date AND p.currency = f.currency
""")

# -------------------------------------------------------------------- gold
_view("dim_customer", """
    SELECT cust_id AS cust_key, cust_id, country, region, customer_type, zip,
           is_active, created_at
    FROM silver_customer
""")

_view("latest_rates", """
    SELECT currency, arg_max(rate_to_usd, rate_date) AS latest_rate
    FROM fx_rates WHERE rate_to_usd IS NOT NULL GROUP BY currency
""")

_view("dim_product", """
    SELECT p.prod_id AS prod_key, p.prod_id, p.prod_name, p.category_name,
           p.top_category,
           CAST((CAST(round(p.price * 1e6) AS HUGEINT)
                 * CAST(round(l.latest_rate * 1e14) AS HUGEINT)
                 + 5000000000000000) // 10000000000000000 AS DECIMAL(28,0))
               * CAST(0.0001 AS DECIMAL(5,4)) AS price_usd
    FROM silver_product p LEFT JOIN latest_rates l ON p.currency = l.currency
""")

_view("dim_date", """
    SELECT full_date,
           CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key,
           CAST(year(full_date) AS INTEGER) AS year,
           CAST(quarter(full_date) AS INTEGER) AS quarter,
           CAST(month(full_date) AS INTEGER) AS month,
           strftime(full_date, '%B') AS month_name,
           CAST(day(full_date) AS INTEGER) AS day,
           strftime(full_date, '%A') AS day_of_week,
           dayofweek(full_date) IN (0, 6) AS is_weekend
    FROM (SELECT DISTINCT order_date AS full_date FROM order_items)
""")

_view("fact_orders", """
    SELECT i.order_id, i.cust_id AS cust_key, i.prod_id AS prod_key, d.date_key,
           i.quantity, i.revenue_usd, i.status
    FROM order_items i LEFT JOIN dim_date d ON i.order_date = d.full_date
""")

# ----------------------------------------------------------------- metrics
_view("metric_category_sales_dec", f"""
    SELECT d.year, d.month_name, p.top_category,
           COUNT(DISTINCT f.order_id) AS order_count,
           CAST(SUM(f.quantity) AS BIGINT) AS total_quantity,
           ROUND(SUM(f.revenue_usd), 2) AS total_revenue_usd
    FROM fact_orders f
    JOIN dim_date d ON f.date_key = d.date_key
    JOIN dim_product p ON f.prod_key = p.prod_key
    WHERE lower(p.top_category) = '{K.HEADLINE_CATEGORY}'
    GROUP BY d.year, d.month_name, d.month, p.top_category
""")


def _deps(body: str) -> list[str]:
    words = set(re.findall(r"[A-Za-z_][A-Za-z0-9_]*", body))
    return [v for v in VIEWS if v in words]


def sql_for(select: str) -> str:
    """Prefix ``select`` with the chain of views it (transitively) reads."""
    order: list[str] = []

    def visit(name: str, stack: tuple[str, ...]) -> None:
        if name in order:
            return
        for dep in _deps(VIEWS[name]):
            if dep != name and dep not in stack:
                visit(dep, stack + (name,))
        order.append(name)

    for name in _deps(select):
        visit(name, ())
    if not order:
        return select.strip()
    ctes = ",\n".join(f"{n} AS (\n{VIEWS[n]}\n)" for n in order)
    body = select.strip()
    if body[:4].upper() == "WITH":
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"

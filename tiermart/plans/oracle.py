"""The registered queries as plain SQL over the benchmark tables.

Written independently of the DataFrame code and run by another engine, so that
both have to agree. Division and averages are taken as doubles of exact sums,
amounts stay decimal, every ordering that decides a row is total.
"""

from __future__ import annotations

from tiermart.plans import analytics
from tiermart.plans.registry import LOADS
from tiermart.plans.retail_views import BUILT, LOADED


def _ts(value: str) -> str:
    return f"TIMESTAMP '{value}'"


_LINE_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]


def _latest(source: str, keys: list[str], first: list[str], columns: list[str]) -> str:
    """Latest row per key; all remaining columns, descending, break ties."""
    order = first + [c for c in columns if c not in keys and c not in first]
    ranked = ", ".join(f"{c} DESC NULLS LAST" for c in order)
    listed = ", ".join(columns)
    return (
        f"SELECT {listed} FROM (SELECT {listed}, row_number() OVER "
        f"(PARTITION BY {', '.join(keys)} ORDER BY {ranked}) AS nth FROM {source}) ranked "
        f"WHERE nth = 1"
    )


_LINES = _latest("lineitem", ["l_orderkey", "l_linenumber"], ["l_shipdate"], _LINE_COLUMNS)

# ---- commerce entities ------------------------------------------------------

_ORDERS = """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
       CASE o_orderstatus WHEN 'F' THEN 'Delivered' WHEN 'O' THEN 'Pending' ELSE 'Shipped' END
         AS order_status,
       CAST(o_totalprice AS DECIMAL(10,2)) AS total_value, 2 * o_custkey AS address_id
FROM orders
"""

_ITEMS = """
SELECT l_orderkey * 10 + l_linenumber AS order_item_id, l_orderkey AS order_id,
       l_partkey AS product_id, CAST(l_quantity AS DECIMAL(10,2)) AS quantity,
       CAST(l_extendedprice AS DECIMAL(10,2)) AS price_per_unit
FROM latest_lines
"""

_DELIVERIES = """
SELECT l_orderkey AS delivery_id, l_orderkey AS order_id, CAST(l_shipdate AS DATE) AS delivery_date,
       CASE WHEN l_linestatus = 'F' THEN 'Delivered' ELSE 'In Transit' END AS delivery_status,
       CASE WHEN l_linestatus = 'F' THEN CAST(l_suppkey AS VARCHAR) END AS delivery_partner_id,
       'T' || CAST(l_orderkey AS VARCHAR) AS tracking_number
FROM latest_lines AS l
WHERE l_linenumber = (SELECT min(x.l_linenumber) FROM latest_lines AS x
                      WHERE x.l_orderkey = l.l_orderkey)
"""

_RETURNS = """
SELECT l_orderkey * 10 + l_linenumber AS return_id, l_orderkey AS order_id,
       l_partkey AS product_id, CAST(l_shipdate AS DATE) AS return_date,
       CASE WHEN l_linestatus = 'F' THEN 'Damaged' ELSE 'Wrong Item' END AS return_reason
FROM latest_lines WHERE l_returnflag = 'R'
"""

_PRODUCTS = """
SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
       CAST(p_retailprice AS DECIMAL(10,2)) AS price, CAST(p_size AS BIGINT) AS stock_quantity
FROM part
"""

_PRODUCT_HISTORY = f"""{_PRODUCTS}
UNION ALL
SELECT p_partkey, p_name, p_type,
       CAST(CAST(p_retailprice AS DECIMAL(10,2)) - 1 AS DECIMAL(10,2)), CAST(p_size AS BIGINT)
FROM part WHERE p_type = 'SMALL'
"""

_CUSTOMERS = """
SELECT c_custkey AS customer_id, c_name AS name,
       CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 'Female' ELSE 'Male' END AS gender,
       c_name || '@example.com' AS email, DATE '1990-01-01' AS dob,
       '0' || CAST(c_custkey AS VARCHAR) AS phone_number, DATE '2020-01-01' AS joining_date
FROM customer
"""

_ADDRESSES = """
SELECT 2 * c_custkey AS address_id, c_custkey AS customer_id,
       'Unit ' || CAST(c_custkey AS VARCHAR) || chr(10) || '"Main" Road' AS address,
       n_name AS city, r_name AS state, CAST(c_nationkey AS VARCHAR) AS zip_code,
       r_name AS country
FROM customer
JOIN nation ON n_nationkey = c_nationkey
JOIN region ON r_regionkey = n_regionkey
UNION ALL
SELECT 2 * c_custkey + 1, c_custkey,
       'Unit ' || CAST(c_custkey AS VARCHAR) || chr(10) || '"Main" Road',
       r_name, r_name, CAST(c_nationkey AS VARCHAR), r_name
FROM customer
JOIN nation ON n_nationkey = c_nationkey
JOIN region ON r_regionkey = n_regionkey
WHERE c_mktsegment = 'BUILDING'
"""

_PARTNERS = """
SELECT s_suppkey AS delivery_partner_id, s_name AS partner_name,
       '0' || CAST(s_suppkey AS VARCHAR) AS contact_number
FROM supplier
"""

_PAYMENTS = """
SELECT o_orderkey AS payment_id, o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS payment_date,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Credit Card'
            WHEN o_orderpriority = '3-MEDIUM' THEN 'UPI' ELSE 'Cash on Delivery' END
         AS payment_method,
       CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Pending' ELSE 'Failed' END
         AS payment_status,
       CAST(o_totalprice AS DECIMAL(10,2)) AS payment_amount
FROM orders
"""


def _master_select(address_join: str, where: str) -> str:
    return f"""
SELECT o.order_id, o.customer_id, o.order_date, o.order_status, o.total_value, o.address_id,
       i.product_id, i.quantity, i.price_per_unit,
       p.product_name, p.category, p.price, p.stock_quantity,
       c.name AS customer_name, c.gender, c.dob AS customer_dob, c.phone_number,
       c.joining_date AS customer_joining_date,
       a.city AS customer_city, a.state AS customer_state, a.country AS customer_country,
       dp.partner_name AS delivery_partner, dp.contact_number AS delivery_partner_contact,
       d.delivery_date, d.delivery_status, r.return_date, r.return_reason,
       CAST(p.price * i.quantity AS DECIMAL(21,4)) AS product_revenue,
       {_ts(BUILT)} AS data_insert_ts, r.return_id
FROM r_orders AS o
INNER JOIN r_customers AS c ON c.customer_id = o.customer_id
INNER JOIN r_addresses AS a ON {address_join}
INNER JOIN r_items AS i ON i.order_id = o.order_id
INNER JOIN r_products AS p ON p.product_id = i.product_id
INNER JOIN r_deliveries AS d ON d.order_id = o.order_id
LEFT JOIN r_partners AS dp ON dp.delivery_partner_id = CAST(d.delivery_partner_id AS BIGINT)
LEFT JOIN r_returns AS r ON r.product_id = i.product_id AND r.order_id = i.order_id
WHERE {where}
"""


def _on_master(
    query: str,
    products: str = _PRODUCTS,
    address_join: str = "a.customer_id = o.customer_id",
    where: str = "o.order_status = 'Delivered'",
) -> str:
    return f"""
WITH latest_lines AS ({_LINES}),
r_orders AS ({_ORDERS}), r_items AS ({_ITEMS}), r_deliveries AS ({_DELIVERIES}),
r_returns AS ({_RETURNS}), r_products AS ({products}), r_customers AS ({_CUSTOMERS}),
r_addresses AS ({_ADDRESSES}), r_partners AS ({_PARTNERS}),
r_master AS ({_master_select(address_join, where)}),
r_order AS (SELECT DISTINCT order_id, customer_id, total_value FROM r_master)
{query}
"""


# ---- reports ----------------------------------------------------------------

_SUM = "CAST(sum({}) AS DECIMAL(20,2))"
_SALE = "CAST(sum(quantity * price_per_unit) AS DECIMAL(31,4))"


def _rounded_mean(source: str) -> str:
    """Mean in cents, rounded half up by integer arithmetic."""
    return f"""
SELECT CAST(CAST((2 * cents + n) // (2 * n) AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2))
            AS DECIMAL(20,2)) AS average_order_value
FROM (SELECT sum(CAST(total_value * 100 AS BIGINT)) AS cents, count(total_value) AS n
      FROM {source}) AS totals
"""


def _per_customer(count: str) -> str:
    return f"(SELECT customer_id, {count} AS n FROM r_master GROUP BY customer_id) AS per_customer"


def _mean_orders(count: str) -> str:
    return f"""
SELECT CAST(sum(n) AS DOUBLE) / count(n) AS avg_order_frequency_per_customer
FROM {_per_customer(count)}
"""


def _retention(count: str) -> str:
    return f"""
SELECT CAST(count(CASE WHEN n > 1 THEN 1 END) AS DOUBLE) / count(*) * 100
         AS customer_retention_rate
FROM {_per_customer(count)}
"""


def _by(key: str, columns: str) -> str:
    return f"SELECT {key}, {columns} FROM r_master GROUP BY {key}"


_REPORTS = {
    "sales_total_revenue": f"SELECT {_SUM.format('total_value')} AS total_sales_revenue FROM r_master",
    "sales_average_order_value": _rounded_mean("r_master"),
    "sales_monthly_growth": f"""
, months AS (
  SELECT CAST(month(order_date) AS INTEGER) AS month, CAST(year(order_date) AS INTEGER) AS year,
         {_SUM.format('total_value')} AS monthly_sales
  FROM r_master GROUP BY 1, 2),
compared AS (
  SELECT months.*, lag(monthly_sales) OVER (ORDER BY year, month) AS previous_month_sales
  FROM months)
SELECT month, year, monthly_sales, previous_month_sales,
       CAST(monthly_sales - previous_month_sales AS DOUBLE)
         / CAST(previous_month_sales AS DOUBLE) * 100 AS sales_growth_percentage
FROM compared
""",
    "sales_units_sold": f"SELECT {_SUM.format('quantity')} AS total_units_sold FROM r_master",
    "sales_by_category": f"""
SELECT category AS product_category, {_SALE} AS total_sales_by_category
FROM r_master GROUP BY category
""",
    "sales_by_city": _by("customer_city", f"{_SUM.format('total_value')} AS total_sales_by_city"),
    "sales_conversion_rate": """
SELECT CAST(count(DISTINCT order_id) AS DOUBLE) / count(DISTINCT customer_id) * 100
         AS sales_conversion_rate
FROM r_master
""",
    "sales_return_rate": """
SELECT CAST(count(return_id) AS DOUBLE) / count(order_id) * 100 AS sales_return_rate FROM r_master
""",
    "sales_by_delivery_partner": _by(
        "delivery_partner", f"{_SUM.format('total_value')} AS total_sales_by_partner"
    ),
    "sales_top_products": f"""
SELECT product_name, {_SUM.format('quantity')} AS total_units_sold, {_SALE} AS total_sales
FROM r_master GROUP BY product_name
ORDER BY total_sales DESC NULLS LAST, product_name NULLS LAST LIMIT 10
""",
    "cust_unique": "SELECT count(DISTINCT customer_id) AS total_unique_customers FROM r_master",
    "cust_avg_orders": _mean_orders("count(order_id)"),
    "cust_avg_orders_distinct": _mean_orders("count(DISTINCT order_id)"),
    "cust_top_spenders": f"""
SELECT customer_id, customer_name, {_SUM.format('total_value')} AS total_spending
FROM r_master GROUP BY customer_id, customer_name
ORDER BY total_spending DESC NULLS LAST, customer_id NULLS LAST, customer_name NULLS LAST LIMIT 10
""",
    "cust_avg_order_value": _by(
        "customer_id", "CAST(sum(total_value) AS DOUBLE) / count(total_value) AS avg_order_value"
    ),
    "cust_lifetime_value": _by(
        "customer_id", f"{_SUM.format('total_value')} AS customer_lifetime_value"
    ),
    "cust_peak_purchase_day": """
SELECT CAST(day(order_date) AS INTEGER) AS daily_order, count(order_id) AS orders_count
FROM r_master GROUP BY 1 ORDER BY orders_count DESC, daily_order LIMIT 1
""",
    "cust_by_city": _by(
        "customer_city",
        f"count(DISTINCT customer_id) AS unique_customers, {_SUM.format('total_value')} AS total_sales",
    ),
    "cust_by_gender": _by(
        "gender",
        f"count(DISTINCT customer_id) AS unique_customers, {_SUM.format('total_value')} AS total_sales",
    ),
    "cust_retention_rate": _retention("count(order_id)"),
    "cust_retention_rate_distinct": _retention("count(DISTINCT order_id)"),
    "sales_total_revenue_by_order": f"""
SELECT {_SUM.format('total_value')} AS total_sales_revenue FROM r_order
""",
    "sales_total_revenue_by_order_renamed": f"""
SELECT {_SUM.format('total_value')} AS total_sales_revenue FROM r_order
""",
    "sales_average_order_value_by_order": _rounded_mean("r_order"),
    "master_orders": "SELECT * FROM r_master",
}

# ---- de-duplication, typing -------------------------------------------------

_EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
_ORDER_COLUMNS = [
    "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
]
_OPEN_PRIORITY = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       nullif(o_orderpriority, '4-NOT SPECIFIED') AS o_orderpriority
FROM orders
"""


def _latest_by_priority(where: str) -> str:
    latest = _latest("kept", ["o_orderpriority"], ["o_orderdate"], _ORDER_COLUMNS)
    return f"""
WITH prepared AS ({_OPEN_PRIORITY}), kept AS (SELECT * FROM prepared WHERE {where}) {latest}
"""


# ---- merges -----------------------------------------------------------------


def _load_filter(number: int, loads: int = 2) -> str:
    bounds = []
    if number > 0:
        bounds.append(f"o_orderdate >= {_ts(LOADS[number - 1])}")
    if number < loads - 1:
        bounds.append(f"(o_orderdate < {_ts(LOADS[number])} OR o_orderdate IS NULL)")
    return " AND ".join(bounds)


def _state(number: int, loads: int = 2) -> str:
    rows = f"(SELECT * FROM prepared WHERE {_load_filter(number, loads)}) AS load_{number}"
    latest = _latest(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"], _ORDER_COLUMNS)
    return f"""
SELECT o_custkey AS customer_id, o_orderkey AS last_order_id, o_orderpriority AS priority,
       o_orderstatus AS status, {_ts(LOADS[number])} AS last_updated_ts
FROM ({latest}) AS latest_{number}
"""


_STATES = f"""
prepared AS ({_OPEN_PRIORITY}), state_0 AS ({_state(0)}), state_1 AS ({_state(1)}),
middle_of_3 AS ({_state(1, 3)}), last_of_3 AS ({_state(2, 3)}),
dim_0 AS (
  SELECT customer_id, last_order_id, priority, status, {_ts(LOADS[0])} AS effective_start_date,
         CAST(NULL AS TIMESTAMP) AS effective_end_date, true AS is_current, last_updated_ts
  FROM state_0)
"""


def _changed(null_safe: bool) -> str:
    if null_safe:
        return "(d.priority IS DISTINCT FROM s.priority OR d.status IS DISTINCT FROM s.status)"
    return "coalesce(d.priority <> s.priority OR d.status <> s.status, false)"


def _versions(dim: str, source: str, ts: str, successors: bool, null_safe: bool = False) -> str:
    """The dimension after one merge; with `successors` closed rows are followed up."""
    closes = f"(d.is_current AND s.customer_id IS NOT NULL AND {_changed(null_safe)})"
    held = "d.is_current AND d.customer_id = s.customer_id"
    if successors:
        held += f" AND NOT {_changed(null_safe)}"
    return f"""
SELECT d.customer_id, d.last_order_id, d.priority, d.status, d.effective_start_date,
       CASE WHEN {closes} THEN {ts} ELSE d.effective_end_date END AS effective_end_date,
       d.is_current AND NOT {closes} AS is_current,
       CASE WHEN {closes} THEN s.last_updated_ts ELSE d.last_updated_ts END AS last_updated_ts
FROM {dim} AS d LEFT JOIN {source} AS s ON s.customer_id = d.customer_id
UNION ALL
SELECT s.customer_id, s.last_order_id, s.priority, s.status, {ts}, NULL, true, s.last_updated_ts
FROM {source} AS s
WHERE NOT EXISTS (SELECT 1 FROM {dim} AS d WHERE {held})
"""


_T1, _T2, _T3 = (_ts(x) for x in LOADS)
_THREE_LOADS = f"""
WITH {_STATES},
dim_1 AS ({_versions('dim_0', 'middle_of_3', _T2, True)}),
dim_2 AS ({_versions('dim_1', 'last_of_3', _T3, True)})
"""

_LINE_KEYS = ["l_orderkey", "l_linenumber"]


def _line_state(comparison: str) -> str:
    rows = f"(SELECT * FROM lineitem WHERE coalesce(l_shipdate, {_ts('1900-01-01 00:00:00')}) {comparison} {_T2}) AS shipped"
    return _latest(rows, _LINE_KEYS, ["l_shipdate"], _LINE_COLUMNS)


_FACT_COLUMNS = "order_id, customer_id, order_date, order_status, total_value, address_id"

_OPERATORS = {
    "dedupe_latest_lineitem": _LINES,
    "dedupe_latest_events": _latest("events", ["user_id"], ["ts"], _EVENT_COLUMNS),
    "dedupe_null_key_group": _latest_by_priority("true"),
    "dedupe_drop_null_keys": _latest_by_priority("o_orderpriority IS NOT NULL"),
    "conform_orders_types": _ORDERS,
    "conform_quarantine": """
SELECT o_orderkey AS order_id,
       CASE WHEN o_orderstatus IN ('F', 'O') THEN CAST(o_orderdate AS DATE) END AS order_date,
       CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 'order_date' END AS bad
FROM orders
""",
    "order_item_totals": f"""
WITH latest_lines AS ({_LINES}), r_items AS ({_ITEMS})
SELECT r_items.*, CAST(quantity * price_per_unit AS DECIMAL(10,2)) AS total_value FROM r_items
""",
    "timezone_shift_events": """
SELECT event_id, ts, ts + INTERVAL '5 hours 30 minutes' AS local_ts FROM events
""",
    "scd1_upsert_orders": f"""
WITH {_STATES}
SELECT t.customer_id,
       CASE WHEN s.customer_id IS NULL THEN t.last_order_id ELSE s.last_order_id END AS last_order_id,
       CASE WHEN s.customer_id IS NULL THEN t.priority ELSE s.priority END AS priority,
       CASE WHEN s.customer_id IS NULL THEN t.status ELSE s.status END AS status,
       CASE WHEN s.customer_id IS NULL THEN t.last_updated_ts ELSE {_T2} END AS last_updated_ts,
       'yes' AS is_active, 'first' AS first_load
FROM state_0 AS t LEFT JOIN state_1 AS s ON s.customer_id = t.customer_id
UNION ALL
SELECT customer_id, last_order_id, priority, status, {_T2}, 'yes', NULL
FROM state_1 WHERE customer_id NOT IN (SELECT customer_id FROM state_0)
""",
    "scd1_ambiguous_keys": f"""
WITH {_STATES}
SELECT o_custkey AS customer_id, count(*) AS source_rows
FROM prepared
WHERE {_load_filter(1)} AND o_custkey IN (SELECT customer_id FROM state_0)
GROUP BY o_custkey HAVING count(*) > 1
""",
    "scd2_pass_orders": f"WITH {_STATES} {_versions('dim_0', 'state_1', _T2, False)}",
    "scd2_pass_null_safe_orders": f"""
WITH {_STATES} {_versions('dim_0', 'state_1', _T2, False, null_safe=True)}
""",
    "scd2_second_pass_orders": f"""
WITH {_STATES}, dim_1 AS ({_versions('dim_0', 'state_1', _T2, False)})
{_versions('dim_1', 'state_1', _T3, False)}
""",
    "scd2_apply_orders": f"{_THREE_LOADS} SELECT * FROM dim_2",
    "scd2_composite_key": f"""
WITH early AS ({_line_state('<')}), late AS ({_line_state('>=')}),
paired AS (
  SELECT e.l_orderkey, e.l_linenumber, e.l_returnflag, e.l_linestatus,
         e.l_returnflag <> n.l_returnflag OR e.l_linestatus <> n.l_linestatus AS differs
  FROM early AS e LEFT JOIN late AS n
    ON n.l_orderkey = e.l_orderkey AND n.l_linenumber = e.l_linenumber)
SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus,
       CASE WHEN differs THEN {_T3} ELSE {_T2} END AS last_updated_ts,
       {_T2} AS effective_start_date, CASE WHEN differs THEN {_T3} END AS effective_end_date,
       coalesce(NOT differs, true) AS is_current
FROM paired
UNION ALL
SELECT n.l_orderkey, n.l_linenumber, n.l_returnflag, n.l_linestatus, {_T3}, {_T3}, NULL, true
FROM late AS n LEFT JOIN paired AS p
  ON p.l_orderkey = n.l_orderkey AND p.l_linenumber = n.l_linenumber
WHERE p.l_orderkey IS NULL OR p.differs
""",
    "scd2_point_in_time": f"""
{_THREE_LOADS}
SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id, o.o_orderdate AS ordered_at,
       v.last_order_id, v.priority
FROM orders AS o LEFT JOIN dim_2 AS v
  ON v.customer_id = o.o_custkey AND o.o_orderdate >= v.effective_start_date
  AND (v.effective_end_date IS NULL OR o.o_orderdate < v.effective_end_date)
""",
    "merge_insert_only_orders": f"""
WITH r_orders AS ({_ORDERS})
SELECT {_FACT_COLUMNS},
       CASE WHEN order_date < CAST({_T2} AS DATE) THEN {_T1} ELSE {_T3} END AS last_updated_ts
FROM r_orders
""",
    "append_orders_double_load": f"""
WITH r_orders AS ({_ORDERS})
SELECT {_FACT_COLUMNS}, {_T1} AS last_updated_ts FROM r_orders
WHERE order_date < CAST({_T2} AS DATE)
UNION ALL
SELECT {_FACT_COLUMNS}, {_T3} FROM r_orders
""",
    "quality_not_null": f"""
WITH latest_lines AS ({_LINES}), r_deliveries AS ({_DELIVERIES})
SELECT 'delivery_id' AS column_name, count(*) - count(delivery_id) AS null_count FROM r_deliveries
UNION ALL SELECT 'order_id', count(*) - count(order_id) FROM r_deliveries
UNION ALL SELECT 'delivery_date', count(*) - count(delivery_date) FROM r_deliveries
UNION ALL SELECT 'delivery_status', count(*) - count(delivery_status) FROM r_deliveries
UNION ALL SELECT 'delivery_partner_id', count(*) - count(delivery_partner_id) FROM r_deliveries
UNION ALL SELECT 'tracking_number', count(*) - count(tracking_number) FROM r_deliveries
""",
    "quality_unique_lineitem": """
SELECT l_orderkey, l_linenumber, count(*) AS row_count
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""",
    "quality_orphans": """
SELECT o_orderkey, count(*) AS row_count FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) GROUP BY o_orderkey
""",
    "quality_orphan_rows": """
SELECT customer.* FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)
""",
    "surrogate_keys": """
SELECT row_number() OVER (ORDER BY o_orderkey) AS order_sk, o_orderkey, o_custkey FROM orders
""",
    "surrogate_keys_sparse": """
SELECT row_number() OVER (ORDER BY place NULLS LAST, o_orderkey) AS order_sk, place, o_orderkey
FROM (SELECT CASE WHEN o_orderstatus <> 'O' THEN o_custkey * 1000003 END AS place, o_orderkey FROM orders) AS o
""",
    "quality_checks_items": f"""
WITH latest_lines AS ({_LINES}), r_items AS ({_ITEMS})
SELECT 'unique' AS "check", CAST(0 AS BIGINT) AS violations
UNION ALL
SELECT 'not_null', CAST(max(CASE WHEN order_id % 97 = 0 THEN 1 ELSE 0 END) AS BIGINT) FROM r_items
UNION ALL
SELECT 'foreign_key_orders', CAST(0 AS BIGINT)
UNION ALL
SELECT 'foreign_key_products', CAST(max(CASE WHEN order_id % 89 = 0 THEN 1 ELSE 0 END) AS BIGINT) FROM r_items
""",
    "csv_file_keys": """
WITH lines AS (
  SELECT o_orderstatus, concat_ws(',', o_orderkey, o_custkey, o_orderstatus) AS value,
         row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1 AS nth
  FROM orders
),
digests AS (
  SELECT o_orderstatus, value, nth, CAST('0x' || substr(md5(value), 1, 15) AS HUGEINT) AS one,
         CAST('0x' || substr(md5(value), 16, 15) AS HUGEINT) AS two
  FROM lines
)
SELECT o_orderstatus AS order_status,
       md5(concat_ws('|', CAST(sum(strlen(value) + 1) AS BIGINT), count(*), sum(one), sum(two),
                     sum(one * nth), sum(two * nth))) AS content_key,
       CAST(sum(strlen(value) + 1) AS BIGINT) AS file_size
FROM digests GROUP BY o_orderstatus
""",
    "csv_roundtrip": f"""
SELECT CAST(address_id AS VARCHAR) AS address_id, CAST(customer_id AS VARCHAR) AS customer_id,
       address, city, state, zip_code, country
FROM ({_ADDRESSES}) AS a
""",
    "csv_audit_columns": f"""
SELECT country, count(*) AS audited_rows, {_T1} AS copied_at FROM ({_ADDRESSES}) AS a GROUP BY country
""",
    "csv_inline_cast": f"""
WITH latest_lines AS ({_LINES}), r_returns AS ({_RETURNS})
SELECT CAST(return_id AS VARCHAR) AS return_id, CAST(order_id AS VARCHAR) AS order_id,
       CAST(product_id AS VARCHAR) AS product_id, return_date, return_reason
FROM r_returns
""",
    "csv_null_tokens": """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
       CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '' END AS order_status
FROM orders
""",
    "csv_quarantine": """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
       CASE WHEN o_orderstatus = 'P' THEN
         CAST(o_orderkey AS VARCHAR) || ',' || CAST(o_custkey AS VARCHAR) || ','
         || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || ',P,1.00,1,surplus' END AS refused_line
FROM orders
""",
    "stage_listing": "SELECT DISTINCT o_orderstatus AS order_status, true AS all_filled FROM orders",
    "load_clean_customers": f"""
SELECT customer_id, gender,
       CASE gender WHEN 'Female' THEN '1' || phone_number ELSE phone_number END AS phone_number,
       dob, {_T2} AS last_updated_ts, 'yes' AS is_active, {_T2} AS _copy_data_ts
FROM ({_CUSTOMERS}) AS c
""",
    "load_dim_customers": f"""
WITH r_customers AS ({_CUSTOMERS})
SELECT r_customers.*, {_T1} AS effective_start_date,
       CASE WHEN gender = 'Female' THEN {_T2} END AS effective_end_date,
       gender <> 'Female' AS is_current,
       CASE WHEN gender = 'Female' THEN {_T2} ELSE {_T1} END AS last_updated_ts
FROM r_customers
UNION ALL
SELECT customer_id, name, gender, email, dob, '1' || phone_number, joining_date,
       {_T2}, NULL, true, {_T2}
FROM r_customers WHERE gender = 'Female'
""",
    "load_dim_customers_two_step": f"""
WITH r_customers AS ({_CUSTOMERS})
SELECT r_customers.*, {_T1} AS effective_start_date,
       CASE WHEN gender = 'Female' THEN {_T2} END AS effective_end_date,
       gender <> 'Female' AS is_current,
       CASE WHEN gender = 'Female' THEN {_T2} ELSE {_T1} END AS last_updated_ts
FROM r_customers
""",
    "load_fact_orders": f"""
SELECT r_orders.*, {_T1} AS last_updated_ts, 'Cancelled' AS clean_status
FROM ({_ORDERS}) AS r_orders
""",
    "load_clean_orders_log": f"""
SELECT order_id, customer_id, order_date,
       CASE order_status WHEN 'Pending' THEN 'Delivered' ELSE order_status END AS order_status,
       total_value, address_id,
       CASE order_status WHEN 'Pending' THEN {_T2} ELSE {_T1} END AS last_updated_ts
FROM ({_ORDERS}) AS r_orders
""",
    **{
        f"load_clean_orders_late_file{mode}": f"""
SELECT order_id, customer_id, order_date, order_status, total_value, address_id
FROM ({_ORDERS}) AS r_orders
"""
        for mode in ("", "_incremental", "_log")
    },
    "load_fact_returns_twice": f"""
WITH latest_lines AS ({_LINES}), r_returns AS ({_RETURNS})
SELECT return_id, order_id, product_id, return_date, return_reason, {_T1} AS last_updated_ts
FROM r_returns
""",
    "load_fact_payments": f"""
SELECT p.*, {_T1} AS last_updated_ts FROM ({_PAYMENTS}) AS p
""",
    "stream_after_batch_customers": f"""
WITH r_customers AS ({_CUSTOMERS})
SELECT r_customers.*, CASE WHEN gender = 'Female' THEN {_T1} ELSE {_T2} END AS effective_start_date,
       CAST(NULL AS TIMESTAMP) AS effective_end_date, true AS is_current,
       CASE WHEN gender = 'Female' THEN {_T1} ELSE {_T2} END AS last_updated_ts
FROM r_customers
""",
    "batch_between_streams": f"""
WITH r_customers AS ({_CUSTOMERS})
SELECT r_customers.*, CASE WHEN gender = 'Female' THEN {_T1} ELSE {_T2} END AS effective_start_date,
       CASE WHEN gender = 'Female' THEN {_T3} END AS effective_end_date,
       gender <> 'Female' AS is_current,
       CASE WHEN gender = 'Female' THEN {_T3} ELSE {_T2} END AS last_updated_ts
FROM r_customers
UNION ALL
SELECT customer_id, name, gender, email, dob, '1' || phone_number, joining_date, {_T3}, NULL, true, {_T3}
FROM r_customers WHERE gender = 'Female'
""",
    "load_master_orders": _on_master("SELECT * FROM r_master"),
    # orders of the second load, and those with a product that it changed, are joined at its time
    "refresh_master_by_orders": _on_master(
        f"""
SELECT * REPLACE (
  CASE WHEN order_date >= DATE '1997-01-01'
            OR bool_or(category = 'SMALL') OVER (PARTITION BY order_id)
       THEN {_ts(BUILT)} ELSE {_ts(LOADED)} END AS data_insert_ts)
FROM r_master
""",
        products=_PRODUCT_HISTORY,
    ),
    "stream_raw_ingest": f"""
SELECT CAST(payment_id AS VARCHAR) AS payment_id, CAST(order_id AS VARCHAR) AS order_id,
       CAST(payment_date AS VARCHAR) AS payment_date, payment_method, payment_status,
       CAST(payment_amount AS VARCHAR) AS payment_amount, {_T1} AS _copy_data_ts
FROM ({_PAYMENTS}) AS p
""",
    "stream_upsert_customers": f"""
WITH r_customers AS ({_CUSTOMERS})
SELECT r_customers.*, {_T1} AS effective_start_date, {_T2} AS effective_end_date,
       false AS is_current, {_T2} AS last_updated_ts
FROM r_customers
UNION ALL
SELECT customer_id, name, gender, email, dob, '1' || phone_number, joining_date,
       {_T2}, NULL, true, {_T2}
FROM r_customers
""",
    "purchases_by_hour": """
SELECT CAST(hour(ts) AS INTEGER) AS hour_of_day, count(*) AS purchases
FROM events WHERE event_type = 'purchase' GROUP BY 1
""",
    "visitor_conversion": """
SELECT count(DISTINCT user_id) AS visitors,
       count(DISTINCT CASE WHEN event_type = 'purchase' THEN user_id END) AS buyers,
       CAST(count(DISTINCT CASE WHEN event_type = 'purchase' THEN user_id END) AS DOUBLE)
         / count(DISTINCT user_id) * 100 AS conversion_rate
FROM events
""",
    "payments_by_method": f"""
SELECT payment_method, payment_status, count(*) AS payments,
       CAST(sum(payment_amount) AS DECIMAL(20,2)) AS total_amount
FROM ({_PAYMENTS}) AS p GROUP BY payment_method, payment_status
""",
    "master_orders_all_versions": _on_master("SELECT * FROM r_master", products=_PRODUCT_HISTORY),
    "master_orders_current_only": _on_master("SELECT * FROM r_master"),
    "master_orders_by_address": _on_master(
        "SELECT * FROM r_master", address_join="a.address_id = o.address_id"
    ),
    "master_orders_every_status": _on_master(
        """
SELECT order_status, count(*) AS item_rows, CAST(sum(total_value) AS DECIMAL(20,2)) AS total_value,
       CAST(sum(product_revenue) AS DECIMAL(31,4)) AS product_revenue
FROM r_master GROUP BY order_status
""",
        where="true",
    ),
}


# other ways to find and to store the same results
_REPORTS |= {
    f"{name}_bitmap": _REPORTS[name]
    for name in ("cust_unique", "cust_by_city", "cust_by_gender", "sales_conversion_rate")
}
_REPORTS |= {f"{name}_by_state": _REPORTS[name] for name in analytics.REPORTS}
_OPERATORS |= {
    **{
        f"{name}_by_load": _OPERATORS[name]
        for name in ("quality_checks_items", "quality_unique_lineitem", "quality_orphans")
    },
    "csv_roundtrip_by_blocks": _OPERATORS["csv_roundtrip"],
    "scd2_point_in_time_sweep": _OPERATORS["scd2_point_in_time"],
    "load_clean_customers_by_bucket": _OPERATORS["load_clean_customers"],
    "load_dim_customers_by_segment": _OPERATORS["load_dim_customers"],
    "stream_upsert_customers_by_bucket": _OPERATORS["stream_upsert_customers"],
    "load_raw_after_failure": f"""
SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id,
       CAST(order_date AS VARCHAR) AS order_date, order_status, CAST(total_value AS VARCHAR) AS total_value,
       CAST(address_id AS VARCHAR) AS address_id, {_T2} AS _copy_data_ts
FROM ({_ORDERS}) AS r_orders
""",
}


def all_sql() -> dict[str, str]:
    return {**{name: _on_master(sql) for name, sql in _REPORTS.items()}, **_OPERATORS}

"""Independent SQL statements of every registered query, for DuckDB.

Written from the definitions, not from the Spark plans: lines are joined to
orders and summed per order, the item mart groups its line fact by all
eleven descriptive columns with COUNT(DISTINCT order_id), and so on — so a
match also checks the pre-aggregation rewrites the Spark plans use.

Exact arithmetic: line numerators are DECIMAL products, scaled by a
DECIMAL 0.0001 after summing; averages and percentages are rounded half
away from zero with HUGEINT floor division (DuckDB's decimal division is
DOUBLE).  The final SELECT of each query casts to engine-neutral types.
"""

from __future__ import annotations

import re

from shopmart.functions.text import SERVICE_FAULT_PATTERN, UNKNOWN_CITY

# ---------------------------------------------------------------- helpers

def _ratio(num: str, num_scale: int, den: str, out_scale: int) -> str:
    """ROUND(num / NULLIF(den, 0), out_scale), half away from zero, exact."""
    p = f"(CAST(abs({num}) * {10 ** num_scale} AS HUGEINT) * {10 ** out_scale})"
    q = f"(CAST({den} AS HUGEINT) * {10 ** num_scale})"
    quotient = f"sign({num}) * ((2 * {p} + {q}) // (2 * {q}))"
    unit = f"CAST({1 / 10 ** out_scale:.{out_scale}f} AS DECIMAL({out_scale + 1},{out_scale}))" \
        if out_scale else "1"
    return (f"CASE WHEN {den} IS NULL OR {den} = 0 THEN NULL ELSE "
            f"CAST(CAST({quotient} AS DECIMAL(38,0)) * {unit} AS DECIMAL(18,{out_scale})) END")


def _amount(numerator: str) -> str:
    """Money from a two-discount numerator (money × 10^4), exact."""
    return f"(CAST({numerator} AS DECIMAL(28,6)) * CAST(0.0001 AS DECIMAL(5,4)))"


def _pct(d: str) -> str:
    return f"CAST(100 - {d} AS DECIMAL(6,2))"


def _qp(q: str, p: str) -> str:
    return f"(CAST({q} AS DECIMAL(10,0)) * CAST({p} AS DECIMAL(12,2)))"


def _part(address: str, index: int) -> str:
    return f"CASE WHEN {address} IS NOT NULL THEN trim(string_split({address}, ',')[{index + 1}]) END"


# ---------------------------------------------------------------- chain

FIXTURE = """
SELECT o.o_orderkey AS order_id,
 CASE WHEN o.o_orderkey % 97 = 0 THEN NULL ELSE o.o_custkey END AS user_id,
 CASE WHEN o.o_orderkey % 97 = 0 THEN NULL ELSE c.c_name END AS user_phone,
 CASE WHEN o.o_orderkey % 53 = 0 THEN NULL ELSE CAST(c.c_nationkey AS BIGINT) END AS store_id,
 CASE WHEN o.o_orderkey % 53 = 0 THEN NULL WHEN c.c_nationkey % 10 = 3 THEN n.n_name ELSE concat('Main st, ', r.r_name, ' , ', n.n_name) END AS store_address,
 CASE WHEN o.o_orderkey % 11 < 2 THEN NULL WHEN o.o_orderkey % 11 = 2 THEN c.c_mktsegment ELSE concat(c.c_mktsegment, ', house ', CAST(o.o_custkey AS VARCHAR(20))) END AS address_text,
 CASE WHEN o.o_orderkey % 101 = 0 THEN NULL ELSE o.o_orderdate END AS created_at,
 o.o_orderdate + INTERVAL 1 HOUR AS paid_at,
 o.o_orderdate + INTERVAL 1 DAY AS delivery_started_at,
 CASE WHEN o.o_orderstatus = 'O' THEN NULL ELSE o.o_orderdate + INTERVAL 2 DAY END AS delivered_at,
 CASE WHEN o.o_orderstatus <> 'F' AND o.o_orderkey % 2 = 0 THEN o.o_orderdate + INTERVAL 3 DAY END AS canceled_at,
 c.c_mktsegment AS payment_type,
 CASE WHEN o.o_orderpriority = '1-URGENT' THEN NULL WHEN o.o_orderkey % 83 = 0 THEN 105.0 WHEN o.o_orderpriority = '2-HIGH' THEN 10.0 ELSE 0.0 END AS order_discount,
 CASE WHEN o.o_orderstatus <> 'F' AND o.o_orderkey % 2 = 0 THEN CASE o.o_orderkey % 5 WHEN 0 THEN 'КУРЬЕР опоздал' WHEN 1 THEN 'Customer changed mind' WHEN 2 THEN 'Store closed' WHEN 3 THEN 'Другое' END END AS order_cancellation_reason,
 CASE WHEN o.o_orderkey % 89 = 0 THEN -5.0 WHEN o.o_orderstatus = 'P' THEN NULL ELSE 99.5 END AS delivery_cost,
 CASE WHEN l.l_linenumber = 6 THEN NULL ELSE l.l_suppkey END AS driver_id,
 CASE WHEN l.l_linenumber = 6 THEN NULL ELSE s.s_name END AS driver_phone,
 l.item AS item_id,
 CASE WHEN l.item % 50 = 49 THEN NULL ELSE p.p_name END AS item_title,
 p.p_type AS item_category,
 CAST(l.l_quantity AS INT) AS item_quantity,
 p.p_retailprice AS item_price,
 CASE WHEN l.l_linenumber = 5 AND l.l_returnflag = 'R' THEN CAST(l.l_quantity AS INT) + 1 WHEN l.l_returnflag = 'R' THEN CAST(l.l_quantity AS INT) WHEN l.l_returnflag = 'A' THEN 1 END AS item_canceled_quantity,
 CASE WHEN l.l_linenumber = 7 THEN NULL WHEN l.l_linenumber = 4 AND l.item % 40 = 7 THEN 120.0 ELSE ROUND(l.l_discount * 100, 0) END AS item_discount,
 CASE WHEN l.l_returnflag = 'R' AND l.l_linenumber = 1 THEN l.item + 1 END AS item_replaced_id
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
LEFT JOIN (SELECT *, CASE WHEN l_linenumber = 2 THEN l_partkey - l_partkey % 20 ELSE l_partkey END AS item FROM lineitem) l ON l.l_orderkey = o.o_orderkey LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey LEFT JOIN part p ON p.p_partkey = l.item
"""

NUM_LINE = (f"(CAST(GREATEST(item_quantity - item_canceled_quantity, 0) AS DECIMAL(10,0)) "
            f"* CAST(item_price AS DECIMAL(12,2)) * {_pct('item_discount')} "
            f"* {_pct('order_discount')})")
NUM_ITEM = (f"(CAST(item_quantity AS DECIMAL(10,0)) * CAST(item_price AS DECIMAL(12,2)) "
            f"* {_pct('item_discount')} * {_pct('order_discount')})")
FAULT = SERVICE_FAULT_PATTERN

CTES: dict[str, str] = {
    "raw_src": FIXTURE,
    "raw": """SELECT order_id, user_id, user_phone, store_id, store_address, address_text,
 created_at, paid_at, delivery_started_at, delivered_at, canceled_at, payment_type,
 CAST(order_discount AS DECIMAL(5,2)) AS order_discount, order_cancellation_reason,
 CAST(delivery_cost AS DECIMAL(12,2)) AS delivery_cost, driver_id, driver_phone, item_id,
 item_title, item_category, item_quantity, CAST(item_price AS DECIMAL(12,2)) AS item_price,
 item_canceled_quantity, CAST(item_discount AS DECIMAL(5,2)) AS item_discount, item_replaced_id
FROM raw_src""",
    "filled": """SELECT * REPLACE (
 CAST(COALESCE(item_discount, 0) AS DECIMAL(5,2)) AS item_discount,
 CAST(COALESCE(order_discount, 0) AS DECIMAL(5,2)) AS order_discount,
 CAST(COALESCE(delivery_cost, 0) AS DECIMAL(12,2)) AS delivery_cost,
 CAST(COALESCE(item_canceled_quantity, 0) AS INT) AS item_canceled_quantity)
FROM raw""",
    "users": """SELECT user_id, max(user_phone) AS user_phone FROM filled
WHERE user_id IS NOT NULL GROUP BY user_id""",
    "stores": f"""SELECT store_id, max(store_address) AS store_address,
 max({_part('store_address', 1)}) AS store_city
FROM filled WHERE store_id IS NOT NULL GROUP BY store_id""",
    "drivers": """SELECT driver_id, max(driver_phone) AS driver_phone FROM filled
WHERE driver_id IS NOT NULL GROUP BY driver_id""",
    "items": """SELECT item_id, max(item_title) AS item_title, max(item_category) AS item_category
FROM filled WHERE item_id IS NOT NULL AND item_title IS NOT NULL GROUP BY item_id""",
    "orders": f"""SELECT order_id, max(user_id) AS user_id, max(store_id) AS store_id,
 max(address_text) AS address_text, max({_part('address_text', 0)}) AS delivery_city,
 max(created_at) AS created_at, max(paid_at) AS paid_at,
 max(delivery_started_at) AS delivery_started_at, max(delivered_at) AS delivered_at,
 max(canceled_at) AS canceled_at, max(payment_type) AS payment_type,
 max(order_discount) AS order_discount,
 max(order_cancellation_reason) AS order_cancellation_reason,
 max(delivery_cost) AS delivery_cost
FROM filled WHERE order_id IS NOT NULL AND user_id IS NOT NULL GROUP BY order_id""",
    "order_items": """SELECT order_id, item_id, item_quantity, item_price, item_canceled_quantity,
 item_discount, item_replaced_id FROM filled
WHERE order_id IS NOT NULL AND item_id IS NOT NULL AND item_quantity IS NOT NULL
 AND item_price IS NOT NULL""",
    "order_drivers": """SELECT DISTINCT order_id, driver_id FROM filled
WHERE order_id IS NOT NULL AND driver_id IS NOT NULL""",
    "order_items_sk": """SELECT row_number() OVER (ORDER BY order_id NULLS FIRST,
 item_id NULLS FIRST, item_quantity NULLS FIRST, item_price NULLS FIRST,
 item_canceled_quantity NULLS FIRST, item_discount NULLS FIRST,
 item_replaced_id NULLS FIRST) AS order_item_sk, * FROM order_items""",
    "order_drivers_sk": """SELECT row_number() OVER (ORDER BY order_id NULLS FIRST,
 driver_id NULLS FIRST) AS order_driver_sk, * FROM order_drivers""",
    "orders_enriched": f"""SELECT o.order_id, o.user_id, o.store_id, s.store_address,
 COALESCE(o.delivery_city, s.store_city, '{UNKNOWN_CITY}') AS city, o.created_at, o.delivered_at,
 o.canceled_at, o.order_cancellation_reason,
 CAST(COALESCE(o.order_discount, 0) AS DECIMAL(5,2)) AS order_discount,
 CAST(COALESCE(o.delivery_cost, 0) AS DECIMAL(12,2)) AS delivery_cost,
 CAST(o.created_at AS DATE) AS report_date, year(o.created_at) AS report_year,
 month(o.created_at) AS report_month, day(o.created_at) AS report_day
FROM orders o LEFT JOIN stores s ON o.store_id = s.store_id
WHERE o.created_at IS NOT NULL""",
    "items_filled": """SELECT order_id, item_id,
 COALESCE(item_quantity, 0) AS item_quantity,
 CAST(COALESCE(item_price, 0) AS DECIMAL(12,2)) AS item_price,
 COALESCE(item_canceled_quantity, 0) AS item_canceled_quantity,
 CAST(COALESCE(item_discount, 0) AS DECIMAL(5,2)) AS item_discount
FROM order_items""",
    "order_lines": f"""SELECT i.order_id, i.item_id, i.item_quantity, i.item_price,
 i.item_canceled_quantity, i.item_discount, o.order_discount, o.report_date, o.city, o.store_id,
 {_qp('i.item_quantity', 'i.item_price')} AS gross_line_amount,
 GREATEST(i.item_quantity - i.item_canceled_quantity, 0) AS net_quantity,
 {NUM_LINE} AS revenue_numerator
FROM items_filled i JOIN orders_enriched o ON i.order_id = o.order_id""",
    "order_financials": f"""SELECT order_id, sum(gross_line_amount) AS gross_amount_items,
 {_amount('sum(revenue_numerator)')} AS revenue_amount_items
FROM order_lines GROUP BY order_id""",
    "driver_stats": """SELECT order_id, count(DISTINCT driver_id) AS driver_count,
 CASE WHEN count(DISTINCT driver_id) > 1 THEN 1 ELSE 0 END AS has_driver_change
FROM order_drivers GROUP BY order_id""",
    "active_drivers": """SELECT o.report_date, o.city, o.store_id,
 count(DISTINCT d.driver_id) AS active_drivers_cnt
FROM order_drivers d JOIN orders_enriched o ON d.order_id = o.order_id
GROUP BY o.report_date, o.city, o.store_id""",
    "orders_fact": f"""SELECT o.*,
 COALESCE(f.gross_amount_items, 0) AS gross_amount_order,
 COALESCE(f.revenue_amount_items, 0) + o.delivery_cost AS revenue_amount_order,
 COALESCE(f.revenue_amount_items, 0) AS profit_amount_order,
 COALESCE(d.has_driver_change, 0) AS has_driver_change,
 CASE WHEN o.delivered_at IS NOT NULL THEN 1 ELSE 0 END AS is_delivered,
 CASE WHEN o.canceled_at IS NOT NULL THEN 1 ELSE 0 END AS is_canceled,
 CASE WHEN o.canceled_at IS NOT NULL AND o.delivered_at IS NOT NULL THEN 1 ELSE 0 END
  AS is_canceled_after_delivery,
 CASE WHEN regexp_matches(lower(COALESCE(o.order_cancellation_reason, '')), '{FAULT}')
  THEN 1 ELSE 0 END AS is_canceled_service_fault
FROM orders_enriched o LEFT JOIN order_financials f ON o.order_id = f.order_id
LEFT JOIN driver_stats d ON o.order_id = d.order_id""",
    "dm_orders_agg": """SELECT report_date, report_year, report_month, report_day, city, store_id,
 store_address, sum(gross_amount_order) AS gross, sum(revenue_amount_order) AS revenue,
 sum(profit_amount_order) AS profit, count(DISTINCT order_id) AS orders_created_cnt,
 sum(is_delivered) AS orders_delivered_cnt, sum(is_canceled) AS orders_canceled_cnt,
 sum(is_canceled_after_delivery) AS orders_canceled_after_delivery_cnt,
 sum(is_canceled_service_fault) AS orders_canceled_service_fault_cnt,
 count(DISTINCT user_id) AS buyers_cnt, count(*) AS n_orders,
 sum(has_driver_change) AS orders_with_driver_change_cnt
FROM orders_fact
GROUP BY report_date, report_year, report_month, report_day, city, store_id, store_address""",
    "dm_orders": f"""SELECT b.report_date, b.report_year, b.report_month, b.report_day, b.city,
 b.store_id, b.store_address,
 CAST(b.gross AS DECIMAL(18,2)) AS gross_amount,
 CAST(b.revenue AS DECIMAL(18,2)) AS revenue_amount,
 CAST(b.profit AS DECIMAL(18,2)) AS profit_amount,
 b.orders_created_cnt, b.orders_delivered_cnt, b.orders_canceled_cnt,
 b.orders_canceled_after_delivery_cnt, b.orders_canceled_service_fault_cnt, b.buyers_cnt,
 {_ratio('b.revenue', 10, 'b.n_orders', 2)} AS avg_check_amount,
 CASE WHEN b.buyers_cnt > 0 THEN {_ratio('b.orders_created_cnt', 0, 'b.buyers_cnt', 4)}
  ELSE 0 END AS orders_per_buyer,
 CASE WHEN b.buyers_cnt > 0 THEN {_ratio('b.revenue', 10, 'b.buyers_cnt', 2)}
  ELSE 0 END AS revenue_per_buyer,
 b.orders_with_driver_change_cnt, COALESCE(a.active_drivers_cnt, 0) AS active_drivers_cnt
FROM dm_orders_agg b LEFT JOIN active_drivers a
 ON b.report_date = a.report_date AND b.city = a.city AND b.store_id = a.store_id
WHERE b.store_id IS NOT NULL""",
    "item_fact": f"""SELECT i.order_id, i.item_id, it.item_title, it.item_category, o.store_id,
 o.store_address, o.city, o.report_date, o.report_year, o.report_month, o.report_day,
 weekofyear(o.report_date) AS report_week, i.item_quantity, i.item_canceled_quantity,
 {_amount(NUM_ITEM.replace('order_discount', 'o.order_discount'))} AS item_gross_amount_calc,
 CASE WHEN i.item_canceled_quantity > 0 THEN 1 ELSE 0 END AS has_item_cancellation
FROM items_filled i JOIN orders_enriched o ON i.order_id = o.order_id
LEFT JOIN items it ON i.item_id = it.item_id""",
    "dm_items_base": """SELECT report_date, report_year, report_month, report_day, report_week,
 city, store_id, store_address, item_category, item_id, item_title,
 CAST(sum(item_gross_amount_calc) AS DECIMAL(18,2)) AS item_gross_amount,
 sum(item_quantity) AS ordered_quantity, sum(item_canceled_quantity) AS canceled_quantity,
 count(DISTINCT order_id) AS orders_with_item_cnt,
 sum(has_item_cancellation) AS orders_with_item_cancellation_cnt
FROM item_fact WHERE store_id IS NOT NULL
GROUP BY report_date, report_year, report_month, report_day, report_week, city, store_id,
 store_address, item_category, item_id, item_title""",
    "dm_items": """SELECT *,
 row_number() OVER (PARTITION BY report_date, city, store_id
  ORDER BY ordered_quantity DESC, item_id ASC) AS daily_popularity_rank,
 row_number() OVER (PARTITION BY report_date, city, store_id
  ORDER BY ordered_quantity ASC, item_id ASC) AS daily_reverse_popularity_rank,
 row_number() OVER (PARTITION BY report_year, report_week, city, store_id
  ORDER BY ordered_quantity DESC, item_id ASC, report_date ASC) AS weekly_popularity_rank,
 row_number() OVER (PARTITION BY report_year, report_week, city, store_id
  ORDER BY ordered_quantity ASC, item_id ASC, report_date ASC) AS weekly_reverse_popularity_rank,
 row_number() OVER (PARTITION BY report_year, report_month, city, store_id
  ORDER BY ordered_quantity DESC, item_id ASC, report_date ASC) AS monthly_popularity_rank,
 row_number() OVER (PARTITION BY report_year, report_month, city, store_id
  ORDER BY ordered_quantity ASC, item_id ASC, report_date ASC) AS monthly_reverse_popularity_rank
FROM dm_items_base""",
}

STORE_KEY = "city, store_id, store_address"
STORE_ORDER = "city ASC NULLS FIRST, store_id ASC NULLS FIRST, store_address ASC NULLS FIRST"
ITEM_KEY = "item_id, item_title, item_category"
ITEM_ORDER = "item_id ASC NULLS FIRST, item_title ASC NULLS FIRST, item_category ASC NULLS FIRST"


def _mean2(col: str, scale: int) -> str:
    return _ratio(f"sum({col})", scale, f"count({col})", 2)


def _percent(part: str, whole: str) -> str:
    return _ratio(f"100 * {part}", 0, whole, 2)


REPORTS = {
    "q1_weekday_totals": """SELECT dayofweek(report_date) AS day_of_week_num,
 dayname(report_date) AS day_of_week, sum(gross_amount) AS total_gross,
 sum(revenue_amount) AS total_revenue, sum(profit_amount) AS total_profit
FROM dm_orders GROUP BY 1, 2 ORDER BY 1""",
    "q2_monthly_buyers": f"""SELECT report_year, report_month,
 {_mean2('avg_check_amount', 2)} AS avg_check,
 {_mean2('orders_per_buyer', 4)} AS avg_orders_per_buyer,
 {_mean2('revenue_per_buyer', 2)} AS avg_revenue_per_buyer
FROM dm_orders GROUP BY report_year, report_month ORDER BY report_year, report_month""",
    "q3_best_check_stores": f"""SELECT {STORE_KEY}, {_mean2('avg_check_amount', 2)} AS avg_check
FROM dm_orders GROUP BY {STORE_KEY}
ORDER BY avg_check DESC NULLS FIRST, {STORE_ORDER} LIMIT 10""",
    "q4_driver_change_rate": f"""SELECT {STORE_KEY}, sum(orders_created_cnt) AS total_orders,
 sum(orders_with_driver_change_cnt) AS driver_changed_orders,
 {_percent('sum(orders_with_driver_change_cnt)', 'sum(orders_created_cnt)')}
  AS driver_change_rate_pct
FROM dm_orders GROUP BY {STORE_KEY} HAVING sum(orders_created_cnt) > 0
ORDER BY driver_change_rate_pct DESC NULLS FIRST, driver_changed_orders DESC NULLS FIRST,
 {STORE_ORDER} LIMIT 10""",
    "q5_category_turnover": """SELECT item_category, sum(item_gross_amount) AS total_gross
FROM dm_items GROUP BY item_category
ORDER BY total_gross DESC NULLS FIRST, item_category ASC NULLS FIRST""",
    "q6_most_canceled_items": f"""SELECT {ITEM_KEY},
 sum(canceled_quantity) AS total_canceled_quantity
FROM dm_items GROUP BY {ITEM_KEY}
ORDER BY total_canceled_quantity DESC NULLS FIRST, {ITEM_ORDER} LIMIT 10""",
    "q7_item_cancel_rate": f"""SELECT {ITEM_KEY}, sum(ordered_quantity) AS total_ordered,
 sum(canceled_quantity) AS total_canceled,
 {_percent('sum(canceled_quantity)', 'sum(ordered_quantity)')} AS cancel_rate_pct
FROM dm_items GROUP BY {ITEM_KEY} HAVING sum(ordered_quantity) >= 100
ORDER BY cancel_rate_pct DESC NULLS FIRST, total_canceled DESC NULLS FIRST, {ITEM_ORDER}
LIMIT 10""",
    "q8_item_order_cancel_rate": f"""SELECT {ITEM_KEY},
 sum(orders_with_item_cnt) AS total_orders_with_item,
 sum(orders_with_item_cancellation_cnt) AS canceled_orders_with_item,
 {_percent('sum(orders_with_item_cancellation_cnt)', 'sum(orders_with_item_cnt)')}
  AS cancellation_rate_pct
FROM dm_items GROUP BY {ITEM_KEY} HAVING sum(orders_with_item_cnt) >= 50
ORDER BY cancellation_rate_pct DESC NULLS FIRST, {ITEM_ORDER} LIMIT 10""",
}

# Columns of each core table and mart, in contract order.
CORE_COLUMNS = {
    "users": ["user_id", "user_phone"],
    "stores": ["store_id", "store_address", "store_city"],
    "drivers": ["driver_id", "driver_phone"],
    "items": ["item_id", "item_title", "item_category"],
    "orders": ["order_id", "user_id", "store_id", "address_text", "delivery_city", "created_at",
               "paid_at", "delivery_started_at", "delivered_at", "canceled_at", "payment_type",
               "order_discount", "order_cancellation_reason", "delivery_cost"],
    "order_items": ["order_id", "item_id", "item_quantity", "item_price",
                    "item_canceled_quantity", "item_discount", "item_replaced_id"],
    "order_drivers": ["order_id", "driver_id"],
}
REQUIRED = {  # NOT NULL columns incl. primary key, in contract order
    "users": ["user_id"], "stores": ["store_id"], "drivers": ["driver_id"],
    "items": ["item_id", "item_title"], "orders": ["order_id", "user_id"],
    "order_items": ["order_item_sk", "order_id", "item_id", "item_quantity", "item_price"],
    "order_drivers": ["order_driver_sk", "order_id", "driver_id"],
    "dm_orders": ["report_date", "city", "store_id", "report_year", "report_month", "report_day",
                  "gross_amount", "revenue_amount", "profit_amount", "orders_created_cnt",
                  "orders_delivered_cnt", "orders_canceled_cnt",
                  "orders_canceled_after_delivery_cnt", "orders_canceled_service_fault_cnt",
                  "buyers_cnt", "avg_check_amount", "orders_per_buyer", "revenue_per_buyer",
                  "orders_with_driver_change_cnt", "active_drivers_cnt"],
    "dm_items": ["report_date", "city", "store_id", "item_id", "report_year", "report_month",
                 "report_day", "report_week", "item_title", "item_gross_amount",
                 "ordered_quantity", "canceled_quantity", "orders_with_item_cnt",
                 "orders_with_item_cancellation_cnt"],
}
SK_TABLE = {"order_items": "order_items_sk", "order_drivers": "order_drivers_sk"}


def _not_null(tables) -> str:
    parts = []
    for t in tables:
        src = SK_TABLE.get(t, t)
        for c in REQUIRED[t]:
            parts.append(f"SELECT '{t}' AS table_name, '{c}' AS column_name, "
                         f"count(*) FILTER (WHERE {c} IS NULL) AS null_rows FROM {src}")
    return "\nUNION ALL\n".join(parts)


def _unique(table: str, key: list[str], allow_null: bool = False) -> str:
    k = ", ".join(key)
    cond = "count(*) > 1"
    if not allow_null:
        cond += "".join(f" OR {c} IS NULL" for c in key)
    return f"SELECT {k}, count(*) AS n_rows FROM {table} GROUP BY {k} HAVING {cond}"


FKS = {
    "fk_orders_user": ("orders", "user_id", "users", "user_id"),
    "fk_orders_store": ("orders", "store_id", "stores", "store_id"),
    "fk_order_items_order": ("order_items", "order_id", "orders", "order_id"),
    "fk_order_items_item": ("order_items", "item_id", "items", "item_id"),
    "fk_order_items_replaced_item": ("order_items", "item_replaced_id", "items", "item_id"),
    "fk_order_drivers_order": ("order_drivers", "order_id", "orders", "order_id"),
    "fk_order_drivers_driver": ("order_drivers", "driver_id", "drivers", "driver_id"),
}

RULES = {
    "order_items": [
        ("chk_order_items_quantity_nonnegative", "item_quantity >= 0"),
        ("chk_order_items_canceled_quantity_nonnegative", "item_canceled_quantity >= 0"),
        ("chk_order_items_canceled_lte_quantity", "item_canceled_quantity <= item_quantity"),
        ("chk_order_items_price_nonnegative", "item_price >= 0"),
        ("chk_order_items_discount_range", "item_discount >= 0 AND item_discount <= 100"),
    ],
    "orders": [
        ("chk_orders_discount_range",
         "order_discount IS NULL OR (order_discount >= 0 AND order_discount <= 100)"),
        ("chk_orders_delivery_cost_nonnegative", "delivery_cost IS NULL OR delivery_cost >= 0"),
    ],
}


def _rules(table: str) -> str:
    cols = ", ".join(CORE_COLUMNS[table])
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS check_name, {cols} FROM {table} WHERE NOT COALESCE(({rule}), TRUE)"
        for name, rule in RULES[table])


def _bodies() -> dict[str, str]:
    b: dict[str, str] = {}
    b["fill_defaults"] = "SELECT * FROM filled"
    for t, cols in CORE_COLUMNS.items():
        b[t] = f"SELECT {', '.join(cols)} FROM {t}"
    b["order_items_sk"] = "SELECT * FROM order_items_sk"
    b["order_drivers_sk"] = "SELECT * FROM order_drivers_sk"
    b["orders_enriched"] = "SELECT * FROM orders_enriched"
    b["order_lines"] = ("SELECT * EXCLUDE (revenue_numerator), "
                        f"{_amount('revenue_numerator')} AS revenue_line_amount FROM order_lines")
    for name in ("order_financials", "driver_stats", "active_drivers", "orders_fact",
                 "dm_orders", "item_fact", "dm_items_base", "dm_items"):
        b[name] = f"SELECT * FROM {name}"
    b.update(REPORTS)
    b["check_not_null_core"] = _not_null(CORE_COLUMNS)
    b["check_not_null_marts"] = _not_null(["dm_orders", "dm_items"])
    for t, key in (("users", ["user_id"]), ("stores", ["store_id"]), ("drivers", ["driver_id"]),
                   ("items", ["item_id"]), ("orders", ["order_id"])):
        b[f"check_unique_{t}"] = _unique(t, key)
    b["check_unique_order_items_sk"] = _unique("order_items_sk", ["order_item_sk"])
    b["check_unique_order_drivers_sk"] = _unique("order_drivers_sk", ["order_driver_sk"])
    b["check_unique_order_drivers_pair"] = _unique("order_drivers", ["order_id", "driver_id"])
    for name, (table, key) in {
            "raw_order_item": ("filled", ["order_id", "item_id"]), "raw_user": ("filled", ["user_id"]),
            "raw_store": ("filled", ["store_id"]), "raw_driver": ("filled", ["driver_id"]),
            "raw_item": ("filled", ["item_id"]), "raw_order": ("filled", ["order_id"]),
            "raw_order_driver": ("filled", ["order_id", "driver_id"]),
            "order_items_line": ("order_items", ["order_id", "item_id"]),
            "dm_orders_day_city": ("dm_orders", ["report_date", "city"]),
            "dm_items_day_item": ("dm_items", ["report_date", "item_id"])}.items():
        b[f"check_unique_{name}"] = _unique(table, key, True)
    for name, (child, col, parent, known) in {
            "orders_store_with_city": ("orders", "store_id", "stores", "store_city"),
            "order_drivers_delivered": ("order_drivers", "order_id", "orders", "delivered_at"),
            }.items():
        cols = ", ".join(f"c.{c}" for c in CORE_COLUMNS[child])
        b[f"check_fk_{name}"] = (
            f"SELECT {cols} FROM {child} c LEFT JOIN {parent} p ON p.{col} = c.{col} "
            f"WHERE c.{col} IS NOT NULL AND p.{known} IS NULL")
    b["check_unique_dm_orders"] = _unique("dm_orders", ["report_date", "city", "store_id"])
    b["check_unique_dm_items"] = _unique("dm_items",
                                         ["report_date", "city", "store_id", "item_id"])
    for name, (child, col, parent, pk) in FKS.items():
        cols = ", ".join(f"c.{c}" for c in CORE_COLUMNS[child])
        b[f"check_{name}"] = (f"SELECT {cols} FROM {child} c WHERE c.{col} IS NOT NULL AND NOT "
                              f"EXISTS (SELECT 1 FROM {parent} p WHERE p.{pk} = c.{col})")
    b["check_rules_order_items"] = _rules("order_items")
    b["check_rules_orders"] = _rules("orders")
    return b


# Output types shared with ``shopmart.contracts.present``.
_DOUBLE = {"order_discount", "delivery_cost", "item_price", "item_discount", "avg_check",
           "avg_orders_per_buyer", "avg_revenue_per_buyer", "orders_per_buyer",
           "revenue_per_buyer", "total_gross", "total_revenue", "total_profit"}
_TIMESTAMP = {"created_at", "paid_at", "delivery_started_at", "delivered_at", "canceled_at",
              "report_date"}
_VARCHAR = {"user_phone", "store_address", "address_text", "payment_type",
            "order_cancellation_reason", "driver_phone", "item_title", "item_category",
            "store_city", "delivery_city", "city", "day_of_week", "table_name", "column_name",
            "check_name"}


def _kind(col: str) -> str:
    if col in _DOUBLE or "amount" in col or col.endswith("_pct"):
        return "DOUBLE"
    if col in _TIMESTAMP:
        return "TIMESTAMP"
    if col in _VARCHAR:
        return "VARCHAR"
    return "BIGINT"


def _deps(sql: str) -> list[str]:
    """CTE names a statement refers to, transitively, in definition order."""
    names = list(CTES)
    need: set[str] = set()
    todo = [sql]
    while todo:
        text = todo.pop()
        for n in names:
            if n not in need and re.search(rf"\b{n}\b", text):
                need.add(n)
                todo.append(CTES[n])
    return [n for n in names if n in need]


def _with_output_types(body: str, columns: list[str]) -> str:
    cast = ", ".join(f"CAST({c} AS {_kind(c)}) AS {c}" for c in columns)
    return f"SELECT {cast} FROM ({body}) AS result"


def statement(name: str, columns: list[str]) -> str:
    body = _bodies()[name]
    deps = _deps(body)
    with_ = ",\n".join(f"{n} AS (\n{CTES[n]}\n)" for n in deps)
    return f"WITH {with_}\n{_with_output_types(body, columns)}"


def oracle_sql(columns_by_query: dict[str, list[str]]) -> dict[str, str]:
    """One SQL statement per query; ``columns_by_query`` gives each output's columns."""
    bodies = _bodies()
    return {n: statement(n, cols) for n, cols in columns_by_query.items() if n in bodies}

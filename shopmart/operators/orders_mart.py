"""The daily store mart ``dm_orders`` and its building blocks.

Plan shape (see README "Scale"): order lines are summed per order *before*
they meet the orders, so every join on ``order_id`` is one-row-per-order on
both sides and all of them share one hash partitioning on ``order_id``; the
mart aggregate and the courier count are then both grouped on
(report_date, city, store_id) and join without another shuffle.  Map-side
partial aggregation runs before every shuffle, so a hot order, store or
courier costs one row per map task, not one task for all its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmart.contracts import DM_ORDERS, conform
from shopmart.functions import money
from shopmart.functions.dates import report_date
from shopmart.functions.text import UNKNOWN_CITY, is_service_fault

ENRICHED_COLUMNS = (
    "order_id", "user_id", "store_id", "store_address", "city", "created_at",
    "delivered_at", "canceled_at", "order_cancellation_reason", "order_discount",
    "delivery_cost", "report_date", "report_year", "report_month", "report_day",
)


def fill_line_defaults(order_items: DataFrame) -> DataFrame:
    """Null quantities, prices and discounts count as 0 in amounts."""
    return order_items.withColumns({
        "item_discount": money.zero_if_null("item_discount", money.PCT),
        "item_canceled_quantity": F.coalesce("item_canceled_quantity", F.lit(0)),
        "item_quantity": F.coalesce("item_quantity", F.lit(0)),
        "item_price": money.zero_if_null("item_price", money.PRICE),
    })


def orders_enriched(orders: DataFrame, stores: DataFrame) -> DataFrame:
    """Dated orders with the store's address and the reporting city.

    Orders without ``created_at`` are dropped (a plain ``IS NOT NULL``, so
    it reaches the scan); city = delivery city, else store city, else
    'UNKNOWN'.  ``stores`` is a dimension: Spark broadcasts it when its
    measured size is under the broadcast threshold and shuffles otherwise.
    """
    o = (orders.filter(F.col("created_at").isNotNull())
         .withColumns({
             "order_discount": money.zero_if_null("order_discount", money.PCT),
             "delivery_cost": money.zero_if_null("delivery_cost", money.PRICE),
             "report_date": report_date("created_at"),
         }))
    s = stores.select("store_id", "store_address", "store_city")
    d = F.col("report_date")
    return (o.join(s, "store_id", "left")
            .withColumns({
                "city": F.coalesce("delivery_city", "store_city", F.lit(UNKNOWN_CITY)),
                "report_year": F.year(d), "report_month": F.month(d),
                "report_day": F.dayofmonth(d),
            })
            .select(*ENRICHED_COLUMNS))


def order_lines(order_items: DataFrame, orders_enriched: DataFrame) -> DataFrame:
    """Line-level amounts for lines of dated orders.

    gross_line_amount = qty·price; net_quantity = max(qty − cancelled, 0);
    revenue_line_amount = net·price·(1 − d_item/100)·(1 − d_order/100), exact.
    """
    oi = fill_line_defaults(order_items)
    o = orders_enriched.select("order_id", "order_discount", "report_date", "city", "store_id")
    j = oi.join(o, "order_id")
    net = money.net_quantity("item_quantity", "item_canceled_quantity")
    return j.select(
        "order_id", "item_id", "item_quantity", "item_price", "item_canceled_quantity",
        "item_discount", "order_discount", "report_date", "city", "store_id",
        money.gross_line("item_quantity", "item_price").alias("gross_line_amount"),
        net.alias("net_quantity"),
        money.numerator_to_amount(money.discounted_numerator(
            net, "item_price", "item_discount", "order_discount")).alias("revenue_line_amount"),
    )


def order_item_totals(order_items: DataFrame) -> DataFrame:
    """Per order: Σ qty·price and Σ net·price·(100 − d_item) (money × 100).

    The order discount is the same for every line of an order, so it is
    applied after this sum — exact in decimals — and the lines never have
    to travel to the orders.
    """
    oi = fill_line_defaults(order_items)
    net = money.net_quantity("item_quantity", "item_canceled_quantity")
    return oi.groupBy("order_id").agg(
        F.sum(money.gross_line("item_quantity", "item_price")).alias("gross_amount_items"),
        F.sum(money.discounted_numerator(net, "item_price", "item_discount"))
        .cast("decimal(26,4)").alias("_revenue_x100"),
    )


def order_financials(order_items: DataFrame, orders_enriched: DataFrame) -> DataFrame:
    """Per dated order: gross and revenue of its lines."""
    totals = order_item_totals(order_items)
    o = orders_enriched.select("order_id", "order_discount")
    return totals.join(o, "order_id").select(
        "order_id", "gross_amount_items",
        money.numerator_to_amount(F.col("_revenue_x100") * money.pct_factor("order_discount"))
        .alias("revenue_amount_items"),
    )


def driver_stats(order_drivers: DataFrame, pairs_distinct: bool = True) -> DataFrame:
    """Per order: number of couriers and whether it changed hands.

    Core ``order_drivers`` holds distinct (order, courier) pairs, so a plain
    count is the distinct count; pass ``pairs_distinct=False`` otherwise.
    """
    n = F.count("driver_id") if pairs_distinct else F.countDistinct("driver_id")
    return (order_drivers.groupBy("order_id").agg(n.alias("driver_count"))
            .withColumn("has_driver_change",
                        F.when(F.col("driver_count") > 1, F.lit(1)).otherwise(F.lit(0))))


def active_drivers(order_drivers: DataFrame, orders_enriched: DataFrame) -> DataFrame:
    """Distinct couriers per (report_date, city, store_id)."""
    o = orders_enriched.select("order_id", "report_date", "city", "store_id")
    return (order_drivers.select("order_id", "driver_id").join(o, "order_id")
            .groupBy("report_date", "city", "store_id")
            .agg(F.countDistinct("driver_id").alias("active_drivers_cnt")))


def _fact(orders_enriched: DataFrame, financials: DataFrame, driver_stats: DataFrame,
          revenue_items) -> DataFrame:
    zero = F.lit(0).cast("decimal(1,0)")
    j = (orders_enriched
         .join(financials, "order_id", "left")
         .join(driver_stats.select("order_id", "has_driver_change"), "order_id", "left"))
    gross = F.coalesce("gross_amount_items", zero)
    revenue = F.coalesce(revenue_items, zero)
    delivered = F.col("delivered_at").isNotNull()
    canceled = F.col("canceled_at").isNotNull()
    flag = lambda c: F.when(c, F.lit(1)).otherwise(F.lit(0))
    return j.select(
        *ENRICHED_COLUMNS,
        gross.alias("gross_amount_order"),
        (revenue + F.col("delivery_cost")).alias("revenue_amount_order"),
        revenue.alias("profit_amount_order"),
        F.coalesce("has_driver_change", F.lit(0)).alias("has_driver_change"),
        flag(delivered).alias("is_delivered"),
        flag(canceled).alias("is_canceled"),
        flag(canceled & delivered).alias("is_canceled_after_delivery"),
        is_service_fault("order_cancellation_reason").alias("is_canceled_service_fault"),
    )


def orders_fact(orders_enriched: DataFrame, order_financials: DataFrame,
                driver_stats: DataFrame) -> DataFrame:
    """One row per dated order with money and status flags (K15), from K12 and K13."""
    return _fact(orders_enriched, order_financials, driver_stats,
                 F.col("revenue_amount_items"))


def orders_fact_from_totals(orders_enriched: DataFrame, totals: DataFrame,
                            driver_stats: DataFrame) -> DataFrame:
    """``orders_fact`` from ``order_item_totals``: the orders are joined once.

    The order discount is applied here, after the per-order line sums,
    instead of in a separate join of the totals with the orders.
    """
    revenue = money.numerator_to_amount(
        F.col("_revenue_x100") * money.pct_factor("order_discount"))
    return _fact(orders_enriched, totals, driver_stats, revenue)


MART_KEY = ("report_date", "city", "store_id")


def dm_orders(orders_fact: DataFrame, active_drivers: DataFrame,
              stores: DataFrame | None = None) -> DataFrame:
    """Daily store mart, one row per (report_date, city, store_id).

    Grouped on the three key columns only — year/month/day follow from the
    date — so the courier counts, grouped on the same key, join without
    re-shuffling either side.  Every aggregate has a fixed-width buffer, so
    Spark hash-aggregates; the store address (a string, which would force a
    sort-based aggregate) is joined from ``stores`` afterwards, one row per
    store-day.  Without ``stores`` it is carried as ``max(store_address)``.
    Orders are unique per row here, so the order count is a plain count;
    buyers stay distinct.  Money is exact until the final rounding into
    NUMERIC(18,2)/(18,4).
    """
    fact = orders_fact.filter(F.col("store_id").isNotNull())
    measures = [
        F.sum("gross_amount_order").alias("_gross"),
        F.sum("revenue_amount_order").alias("_revenue"),
        F.sum("profit_amount_order").alias("_profit"),
        F.count(F.lit(1)).alias("orders_created_cnt"),
        F.sum("is_delivered").alias("orders_delivered_cnt"),
        F.sum("is_canceled").alias("orders_canceled_cnt"),
        F.sum("is_canceled_after_delivery").alias("orders_canceled_after_delivery_cnt"),
        F.sum("is_canceled_service_fault").alias("orders_canceled_service_fault_cnt"),
        F.countDistinct("user_id").alias("buyers_cnt"),
        F.sum("has_driver_change").alias("orders_with_driver_change_cnt"),
    ]
    if stores is None:
        measures.append(F.max("store_address").alias("store_address"))
    agg = fact.groupBy(*MART_KEY).agg(*measures)
    ad = active_drivers.filter(F.col("store_id").isNotNull())
    joined = agg.join(ad, list(MART_KEY), "left")
    if stores is not None:
        joined = joined.join(stores.select("store_id", "store_address"), "store_id", "left")
    d = F.col("report_date")
    buyers = F.col("buyers_cnt")
    out = joined.select(
        "report_date", F.year(d).alias("report_year"), F.month(d).alias("report_month"),
        F.dayofmonth(d).alias("report_day"), "city", "store_id", "store_address",
        money.to_money("_gross").alias("gross_amount"),
        money.to_money("_revenue").alias("revenue_amount"),
        money.to_money("_profit").alias("profit_amount"),
        "orders_created_cnt", "orders_delivered_cnt", "orders_canceled_cnt",
        "orders_canceled_after_delivery_cnt", "orders_canceled_service_fault_cnt",
        "buyers_cnt",
        money.round_ratio("_revenue", 10, "orders_created_cnt", 2).alias("avg_check_amount"),
        F.when(buyers > 0, money.round_ratio("orders_created_cnt", 0, buyers, 4))
        .otherwise(F.lit(0)).alias("orders_per_buyer"),
        F.when(buyers > 0, money.round_ratio("_revenue", 10, buyers, 2))
        .otherwise(F.lit(0)).alias("revenue_per_buyer"),
        "orders_with_driver_change_cnt",
        F.coalesce("active_drivers_cnt", F.lit(0)).alias("active_drivers_cnt"),
    )
    return conform(out, DM_ORDERS)


def build_dm_orders(orders: DataFrame, order_items: DataFrame, order_drivers: DataFrame,
                    stores: DataFrame) -> DataFrame:
    """Core tables → ``dm_orders``; store-less orders leave before any shuffle."""
    oe = orders_enriched(orders.filter(F.col("store_id").isNotNull()), stores)
    fact = orders_fact_from_totals(oe, order_item_totals(order_items), driver_stats(order_drivers))
    return dm_orders(fact, active_drivers(order_drivers, oe), stores)

"""The eight business reports over the marts.

Each report is one grouped aggregate (partial + final) over a mart.  Top-10
reports end in ``orderBy(...).limit(10)``, which Spark runs as a per-task
top-k plus a bounded merge.  Ties at the cut are broken by the group key so
the ten rows do not depend on partitioning.  Averages and percentages are
exact and rounded half away from zero to two places.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmart.functions.dates import weekday_name, weekday_number
from shopmart.functions.money import round_ratio

TOP_K = 10
STORE_KEY = ("city", "store_id", "store_address")
ITEM_KEY = ("item_id", "item_title", "item_category")


def _tie_break(cols):
    return [F.col(c).asc_nulls_first() for c in cols]


def _percent(part: str, whole: str, whole_digits: int = 18):
    """ROUND(100.0 · part / NULLIF(whole, 0), 2), exact."""
    return round_ratio(F.col(part) * F.lit(100), 0, F.col(whole), 2, den_digits=whole_digits)


def _mean2(column: str, scale: int):
    """ROUND(AVG(column), 2) of an exact, NOT NULL column with ``scale`` decimals."""
    return round_ratio(F.sum(column), scale, F.count(column), 2)


def q1_weekday_totals(dm_orders: DataFrame) -> DataFrame:
    """Gross, revenue and profit by day of week (0 = Sunday)."""
    d = F.col("report_date")
    return (dm_orders.groupBy(weekday_number(d).alias("day_of_week_num"),
                              weekday_name(d).alias("day_of_week"))
            .agg(F.sum("gross_amount").alias("total_gross"),
                 F.sum("revenue_amount").alias("total_revenue"),
                 F.sum("profit_amount").alias("total_profit"))
            .orderBy("day_of_week_num"))


def q2_monthly_buyers(dm_orders: DataFrame) -> DataFrame:
    """Mean of daily average checks, orders per buyer and revenue per buyer, by month.

    An unweighted mean of the store-day values, as the mart is queried.
    """
    return (dm_orders.groupBy("report_year", "report_month")
            .agg(_mean2("avg_check_amount", 2).alias("avg_check"),
                 _mean2("orders_per_buyer", 4).alias("avg_orders_per_buyer"),
                 _mean2("revenue_per_buyer", 2).alias("avg_revenue_per_buyer"))
            .orderBy("report_year", "report_month"))


def q3_best_check_stores(dm_orders: DataFrame) -> DataFrame:
    """Top-10 stores by mean daily average check."""
    return (dm_orders.groupBy(*STORE_KEY)
            .agg(_mean2("avg_check_amount", 2).alias("avg_check"))
            .orderBy(F.col("avg_check").desc_nulls_first(), *_tie_break(STORE_KEY))
            .limit(TOP_K))


def q4_driver_change_rate(dm_orders: DataFrame) -> DataFrame:
    """Top-10 stores by share of orders whose courier changed."""
    return (dm_orders.groupBy(*STORE_KEY)
            .agg(F.sum("orders_created_cnt").alias("total_orders"),
                 F.sum("orders_with_driver_change_cnt").alias("driver_changed_orders"))
            .filter(F.col("total_orders") > 0)
            .withColumn("driver_change_rate_pct",
                        _percent("driver_changed_orders", "total_orders"))
            .orderBy(F.col("driver_change_rate_pct").desc_nulls_first(),
                     F.col("driver_changed_orders").desc_nulls_first(), *_tie_break(STORE_KEY))
            .limit(TOP_K))


def q5_category_turnover(dm_items: DataFrame) -> DataFrame:
    """Discounted turnover by item category."""
    return (dm_items.groupBy("item_category")
            .agg(F.sum("item_gross_amount").alias("total_gross"))
            .orderBy(F.col("total_gross").desc_nulls_first(),
                     F.col("item_category").asc_nulls_first()))


def q6_most_canceled_items(dm_items: DataFrame) -> DataFrame:
    """Top-10 items by cancelled units."""
    return (dm_items.groupBy(*ITEM_KEY)
            .agg(F.sum("canceled_quantity").alias("total_canceled_quantity"))
            .orderBy(F.col("total_canceled_quantity").desc_nulls_first(), *_tie_break(ITEM_KEY))
            .limit(TOP_K))


def q7_item_cancel_rate(dm_items: DataFrame, min_units: int = 100) -> DataFrame:
    """Top-10 items by cancelled share of units, among items with ≥ ``min_units`` ordered."""
    return (dm_items.groupBy(*ITEM_KEY)
            .agg(F.sum("ordered_quantity").alias("total_ordered"),
                 F.sum("canceled_quantity").alias("total_canceled"))
            .filter(F.col("total_ordered") >= min_units)
            .withColumn("cancel_rate_pct", _percent("total_canceled", "total_ordered"))
            .orderBy(F.col("cancel_rate_pct").desc_nulls_first(),
                     F.col("total_canceled").desc_nulls_first(), *_tie_break(ITEM_KEY))
            .limit(TOP_K))


def q8_item_order_cancel_rate(dm_items: DataFrame, min_orders: int = 50) -> DataFrame:
    """Top-10 items by flagged lines per order containing them (may pass 100 %)."""
    return (dm_items.groupBy(*ITEM_KEY)
            .agg(F.sum("orders_with_item_cnt").alias("total_orders_with_item"),
                 F.sum("orders_with_item_cancellation_cnt").alias("canceled_orders_with_item"))
            .filter(F.col("total_orders_with_item") >= min_orders)
            .withColumn("cancellation_rate_pct",
                        _percent("canceled_orders_with_item", "total_orders_with_item"))
            .orderBy(F.col("cancellation_rate_pct").desc_nulls_first(), *_tie_break(ITEM_KEY))
            .limit(TOP_K))


REPORTS = {
    "q1_weekday_totals": ("dm_orders", q1_weekday_totals),
    "q2_monthly_buyers": ("dm_orders", q2_monthly_buyers),
    "q3_best_check_stores": ("dm_orders", q3_best_check_stores),
    "q4_driver_change_rate": ("dm_orders", q4_driver_change_rate),
    "q5_category_turnover": ("dm_items", q5_category_turnover),
    "q6_most_canceled_items": ("dm_items", q6_most_canceled_items),
    "q7_item_cancel_rate": ("dm_items", q7_item_cancel_rate),
    "q8_item_order_cancel_rate": ("dm_items", q8_item_order_cancel_rate),
}

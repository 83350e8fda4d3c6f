"""The wide raw order-line table, derived from the driver's TPC-H-style tables.

Customer nation plays the store, supplier the courier, ``part`` the item,
lineitem the order line.  Every order, line and part is kept; the ``% n``
conditions below only inject the defects the cleaning rules exist for
(missing users, stores, dates, titles, couriers; out-of-range discounts;
cancelled > ordered; Cyrillic reasons; copies that disagree), deterministically.
Second lines buy one of the popular items, every twentieth part, so items
differ in popularity at every scale.

Join plan at scale: orders ⋈ customer and orders ⟕ (lineitem ⟕ supplier ⟕ part)
are shuffle joins on well-spread keys (AQE splits a hot key); nation and region
are fixed-size.  Spark broadcasts what it measures small.  Lines meet their orders last, so
what is summed per order next needs no further exchange.  A caller that names the columns it reads gets
only the joins that these columns, or the number of rows, depend on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopmart.contracts import RAW, conform

POPULAR_EVERY = 20  # every so many parts, one is popular
COURIER_COLUMNS = {"driver_phone"}
ITEM_COLUMNS = {"item_title", "item_category", "item_price"}
# Raw columns of a courier or an item → what they follow from in a line.
LINE_KEYS = ({c: ("l_suppkey", "courier", "driver_id") for c in ("driver_id", *COURIER_COLUMNS)}
             | {c: ("item",) for c in ("item_id", *ITEM_COLUMNS)})
LINE_COLUMNS = {"item_quantity", "item_canceled_quantity", "item_discount", "item_replaced_id", *LINE_KEYS}


def source_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _repeats(df: DataFrame, key: str) -> bool:
    """Does a key occur twice?  A small job over the one column."""
    return not (df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
                .where(F.col("n") > 1).isEmpty())


def raw_order_lines(spark: SparkSession, sf_dir: str, columns: Sequence[str] | None = None,
                    copies: bool = True) -> DataFrame:
    """One row per (order, line), 25 columns of the RAW contract, or ``columns`` of them.

    With ``copies=False`` the caller takes each row once, however often it comes: then a left join that gives
    none of the columns is left out.  Otherwise only couriers are, and only when their keys are unique, as
    a repeated key repeats the lines.
    """
    t = lambda name: source_table(spark, sf_dir, name)
    wanted = set(RAW.names if columns is None else columns)
    # What an order or a line alone says is worked out before the joins, as narrow columns: exchanges carry them.
    k = F.col("o_orderkey")
    discount = (F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(None))
                .when(k % 83 == 0, F.lit(105.0))
                .when(F.col("o_orderpriority") == "2-HIGH", F.lit(10.0))
                .otherwise(F.lit(0.0)))
    o = t("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
                           discount.cast(RAW.dtype("order_discount")).alias("order_discount"))
    c = t("customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = t("nation").select("n_nationkey", "n_name", "n_regionkey")
    r = t("region").select("r_regionkey", "r_name")
    li = t("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                              "l_quantity", "l_discount", "l_returnflag")
    s = t("supplier").select("s_suppkey", "s_name")
    p = t("part").select("p_partkey", "p_name", "p_type", "p_retailprice")
    part, line, flag = F.col("l_partkey"), F.col("l_linenumber"), F.col("l_returnflag")
    qty = F.col("l_quantity").cast("int")
    item = F.when(line == 2, part - part % POPULAR_EVERY).otherwise(part)
    courier = ~F.coalesce(line == 6, F.lit(False))
    narrow = {
        "driver_id": F.when(courier, F.col("l_suppkey")),
        "item_quantity": qty,
        "item_canceled_quantity": F.when((line == 5) & (flag == "R"), qty + 1)
        .when(flag == "R", qty)
        .when(flag == "A", F.lit(1)),
        "item_discount": F.when(line == 7, F.lit(None))
        .when((line == 4) & (item % 40 == 7), F.lit(120.0))
        .otherwise(F.round(F.col("l_discount") * 100, 0)),
        "item_replaced_id": F.when((flag == "R") & (line == 1), item + 1),
    }
    li = li.select("l_orderkey", "l_suppkey", courier.alias("courier"), item.alias("item"),
                   *(v.cast(RAW.dtype(c)).alias(c) for c, v in narrow.items()))
    item = F.col("item")
    couriers = bool(wanted & COURIER_COLUMNS) or copies and _repeats(s, "s_suppkey")
    items = copies or bool(wanted & ITEM_COLUMNS)

    def named(df: DataFrame) -> DataFrame:
        if couriers:
            df = df.join(s, s.s_suppkey == df.l_suppkey, "left")
        return df.join(p, p.p_partkey == df.item, "left") if items else df

    joined = (
        o.join(c, o.o_custkey == c.c_custkey)
        .join(n, c.c_nationkey == n.n_nationkey)
        .join(r, n.n_regionkey == r.r_regionkey)
    )
    with_lines = li.l_orderkey == o.o_orderkey
    if not copies and wanted <= LINE_KEYS.keys():  # couriers or items alone: each once, then its names
        keys = dict.fromkeys(key for c in sorted(wanted) for key in LINE_KEYS[c])
        joined = named(joined.join(li, with_lines, "left").select(*keys).distinct())
    elif copies or wanted & LINE_COLUMNS:
        joined = joined.join(named(li), with_lines, "left")
    elif "order_id" in wanted:  # dealt by order while it is short: its texts and times are worked out after
        joined = joined.repartition("o_orderkey")

    status = F.col("o_orderstatus")
    day = F.col("o_orderdate")
    cancelled = (status != "F") & (k % 2 == 0)

    def plus(interval: str):
        return day + F.expr(f"INTERVAL {interval}")

    columns_of_raw = [
        k.alias("order_id"),
        F.when(k % 97 != 0, F.col("o_custkey")).alias("user_id"),
        F.when(k % 97 != 0, F.col("c_name")).alias("user_phone"),
        F.when(k % 53 != 0, F.col("c_nationkey").cast("bigint")).alias("store_id"),
        F.when(k % 53 == 0, F.lit(None))
        .when(F.col("c_nationkey") % 10 == 3, F.col("n_name"))
        .otherwise(F.concat(F.lit("Main st, "), F.col("r_name"), F.lit(" , "), F.col("n_name")))
        .alias("store_address"),
        F.when(k % 11 < 2, F.lit(None))
        .when(k % 11 == 2, F.col("c_mktsegment"))
        .otherwise(F.concat(F.col("c_mktsegment"), F.lit(", house "),
                            F.col("o_custkey").cast("string")))
        .alias("address_text"),
        F.when(k % 101 != 0, day).alias("created_at"),
        plus("1 HOUR").alias("paid_at"),
        plus("1 DAY").alias("delivery_started_at"),
        F.when(status != "O", plus("2 DAYS")).alias("delivered_at"),
        F.when(cancelled, plus("3 DAYS")).alias("canceled_at"),
        F.col("c_mktsegment").alias("payment_type"),
        F.col("order_discount"),
        F.when(cancelled, F.when(k % 5 == 0, "КУРЬЕР опоздал")
               .when(k % 5 == 1, "Customer changed mind")
               .when(k % 5 == 2, "Store closed")
               .when(k % 5 == 3, "Другое")).alias("order_cancellation_reason"),
        F.when(k % 89 == 0, F.lit(-5.0))
        .when(status == "P", F.lit(None))
        .otherwise(F.lit(99.5)).alias("delivery_cost"),
        F.col("driver_id"),
        F.when(F.coalesce("courier", F.lit(True)), F.col("s_name")).alias("driver_phone"),
        item.alias("item_id"),
        F.when(~F.coalesce(item % 50 == 49, F.lit(False)), F.col("p_name"))
        .alias("item_title"),
        F.col("p_type").alias("item_category"),
        F.col("item_quantity"),
        F.col("p_retailprice").alias("item_price"),
        *(F.col(c) for c in ("item_canceled_quantity", "item_discount", "item_replaced_id")),
    ]
    raw = conform(joined.select(*(v for c, v in zip(RAW.names, columns_of_raw) if c in wanted)), RAW)
    return raw if columns is None else raw.select(*columns)

"""Table contracts: column types, NOT NULL columns, keys, references, checks.

A contract is plain data.  ``conform`` applies one to a DataFrame (column
list and order, casts, defaults, audit column) in a single ``select``;
column, key and constraint names are the database's identifiers (fixed values);
``shopmart.operators.quality`` turns the same data into distributed checks.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LONG = T.LongType()
INT = T.IntegerType()
STR = T.StringType()
TS = T.TimestampNTZType()
DATE = T.DateType()
PCT = T.DecimalType(5, 2)        # percent, NUMERIC(5,2)
MONEY = T.DecimalType(12, 2)     # core money, NUMERIC(12,2)
MART_MONEY = T.DecimalType(18, 2)
MART_RATIO = T.DecimalType(18, 4)


@dataclass(frozen=True)
class Contract:
    name: str
    columns: tuple[tuple[str, T.DataType], ...]
    not_null: tuple[str, ...] = ()
    key: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    defaults: dict = field(default_factory=dict)
    audit_column: str | None = None

    @property
    def names(self) -> list[str]:
        return [c for c, _ in self.columns]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, t, True) for c, t in self.columns])

    def dtype(self, column: str) -> T.DataType:
        return dict(self.columns)[column]

    @property
    def required(self) -> tuple[str, ...]:
        """NOT NULL columns, including the primary key columns."""
        out = list(self.key)
        out += [c for c in self.not_null if c not in out]
        return tuple(out)


# The wide raw table (one row per order line and courier); types are those
# of the core columns the values end up in.
RAW = Contract("raw", (
    ("order_id", LONG), ("user_id", LONG), ("user_phone", STR),
    ("store_id", LONG), ("store_address", STR), ("address_text", STR),
    ("created_at", TS), ("paid_at", TS), ("delivery_started_at", TS),
    ("delivered_at", TS), ("canceled_at", TS), ("payment_type", STR),
    ("order_discount", PCT), ("order_cancellation_reason", STR),
    ("delivery_cost", MONEY), ("driver_id", LONG), ("driver_phone", STR),
    ("item_id", LONG), ("item_title", STR), ("item_category", STR),
    ("item_quantity", INT), ("item_price", MONEY),
    ("item_canceled_quantity", INT), ("item_discount", PCT),
    ("item_replaced_id", LONG),
))

USERS = Contract("users", (("user_id", LONG), ("user_phone", STR)), key=("user_id",))
STORES = Contract("stores", (("store_id", LONG), ("store_address", STR), ("store_city", STR)),
                  key=("store_id",))
DRIVERS = Contract("drivers", (("driver_id", LONG), ("driver_phone", STR)), key=("driver_id",))
ITEMS = Contract("items", (("item_id", LONG), ("item_title", STR), ("item_category", STR)),
                 not_null=("item_title",), key=("item_id",))
ORDERS = Contract("orders", (
    ("order_id", LONG), ("user_id", LONG), ("store_id", LONG), ("address_text", STR),
    ("delivery_city", STR), ("created_at", TS), ("paid_at", TS),
    ("delivery_started_at", TS), ("delivered_at", TS), ("canceled_at", TS),
    ("payment_type", STR), ("order_discount", PCT), ("order_cancellation_reason", STR),
    ("delivery_cost", MONEY),
), not_null=("user_id",), key=("order_id",))
ORDER_ITEMS = Contract("order_items", (
    ("order_item_sk", LONG), ("order_id", LONG), ("item_id", LONG), ("item_quantity", INT),
    ("item_price", MONEY), ("item_canceled_quantity", INT), ("item_discount", PCT),
    ("item_replaced_id", LONG),
), not_null=("order_id", "item_id", "item_quantity", "item_price"), key=("order_item_sk",),
    defaults={"item_canceled_quantity": 0, "item_discount": 0})
ORDER_DRIVERS = Contract("order_drivers", (
    ("order_driver_sk", LONG), ("order_id", LONG), ("driver_id", LONG),
), not_null=("order_id", "driver_id"), key=("order_driver_sk",),
    unique=(("order_id", "driver_id"),))

CORE = {c.name: c for c in (USERS, STORES, DRIVERS, ITEMS, ORDERS, ORDER_ITEMS, ORDER_DRIVERS)}

# Parents are loaded before children (and truncated after them).
LOAD_ORDER = ("users", "stores", "drivers", "items", "orders", "order_items", "order_drivers")


@dataclass(frozen=True)
class ForeignKey:
    name: str
    child: str
    column: str
    parent: str
    parent_key: str


FOREIGN_KEYS = (
    ForeignKey("fk_orders_user", "orders", "user_id", "users", "user_id"),
    ForeignKey("fk_orders_store", "orders", "store_id", "stores", "store_id"),
    ForeignKey("fk_order_items_order", "order_items", "order_id", "orders", "order_id"),
    ForeignKey("fk_order_items_item", "order_items", "item_id", "items", "item_id"),
    ForeignKey("fk_order_items_replaced_item", "order_items", "item_replaced_id", "items", "item_id"),
    ForeignKey("fk_order_drivers_order", "order_drivers", "order_id", "orders", "order_id"),
    ForeignKey("fk_order_drivers_driver", "order_drivers", "driver_id", "drivers", "driver_id"),
)


def _between(c: str, lo: int, hi: int) -> Column:
    return (F.col(c) >= lo) & (F.col(c) <= hi)


# Row rules: a row violates a rule only when the rule is FALSE (UNKNOWN passes).
# Each rule is a function returning a Column, so contracts load without a session.
CHECKS = {
    "order_items": (
        ("chk_order_items_quantity_nonnegative", lambda: F.col("item_quantity") >= 0),
        ("chk_order_items_canceled_quantity_nonnegative",
         lambda: F.col("item_canceled_quantity") >= 0),
        ("chk_order_items_canceled_lte_quantity",
         lambda: F.col("item_canceled_quantity") <= F.col("item_quantity")),
        ("chk_order_items_price_nonnegative", lambda: F.col("item_price") >= 0),
        ("chk_order_items_discount_range", lambda: _between("item_discount", 0, 100)),
    ),
    "orders": (
        ("chk_orders_discount_range",
         lambda: F.col("order_discount").isNull() | _between("order_discount", 0, 100)),
        ("chk_orders_delivery_cost_nonnegative",
         lambda: F.col("delivery_cost").isNull() | (F.col("delivery_cost") >= 0)),
    ),
}

DM_ORDERS = Contract("dm_orders", (
    ("report_date", DATE), ("report_year", INT), ("report_month", INT), ("report_day", INT),
    ("city", STR), ("store_id", LONG), ("store_address", STR),
    ("gross_amount", MART_MONEY), ("revenue_amount", MART_MONEY), ("profit_amount", MART_MONEY),
    ("orders_created_cnt", INT), ("orders_delivered_cnt", INT), ("orders_canceled_cnt", INT),
    ("orders_canceled_after_delivery_cnt", INT), ("orders_canceled_service_fault_cnt", INT),
    ("buyers_cnt", INT), ("avg_check_amount", MART_MONEY), ("orders_per_buyer", MART_RATIO),
    ("revenue_per_buyer", MART_MONEY), ("orders_with_driver_change_cnt", INT),
    ("active_drivers_cnt", INT),
), not_null=("report_year", "report_month", "report_day", "gross_amount", "revenue_amount",
             "profit_amount", "orders_created_cnt", "orders_delivered_cnt",
             "orders_canceled_cnt", "orders_canceled_after_delivery_cnt",
             "orders_canceled_service_fault_cnt", "buyers_cnt", "avg_check_amount",
             "orders_per_buyer", "revenue_per_buyer", "orders_with_driver_change_cnt",
             "active_drivers_cnt"),
    key=("report_date", "city", "store_id"),
    audit_column="created_at")

DM_ITEMS = Contract("dm_items", (
    ("report_date", DATE), ("report_year", INT), ("report_month", INT), ("report_day", INT),
    ("report_week", INT), ("city", STR), ("store_id", LONG), ("store_address", STR),
    ("item_category", STR), ("item_id", LONG), ("item_title", STR),
    ("item_gross_amount", MART_MONEY), ("ordered_quantity", INT), ("canceled_quantity", INT),
    ("orders_with_item_cnt", INT), ("orders_with_item_cancellation_cnt", INT),
    ("daily_popularity_rank", INT), ("daily_reverse_popularity_rank", INT),
    ("weekly_popularity_rank", INT), ("weekly_reverse_popularity_rank", INT),
    ("monthly_popularity_rank", INT), ("monthly_reverse_popularity_rank", INT),
), not_null=("report_year", "report_month", "report_day", "report_week", "item_title",
             "item_gross_amount", "ordered_quantity", "canceled_quantity",
             "orders_with_item_cnt", "orders_with_item_cancellation_cnt"),
    key=("report_date", "city", "store_id", "item_id"),
    audit_column="created_at")

MARTS = {c.name: c for c in (DM_ORDERS, DM_ITEMS)}

# Mart money and counters default to 0 when the column is missing.
_MART_ZERO = ("gross_amount", "revenue_amount", "profit_amount", "orders_created_cnt",
              "orders_delivered_cnt", "orders_canceled_cnt", "orders_canceled_after_delivery_cnt",
              "orders_canceled_service_fault_cnt", "buyers_cnt", "avg_check_amount",
              "orders_per_buyer", "revenue_per_buyer", "orders_with_driver_change_cnt",
              "active_drivers_cnt", "item_gross_amount", "ordered_quantity", "canceled_quantity",
              "orders_with_item_cnt", "orders_with_item_cancellation_cnt")
for _mart in MARTS.values():
    _mart.defaults.update({c: 0 for c in _mart.names if c in _MART_ZERO})


def conform(df: DataFrame, contract: Contract, audit: bool = False) -> DataFrame:
    """Project ``df`` onto ``contract`` in one ``select``.

    Columns come out in contract order and type (decimals round half away
    from zero on the cast, as a NUMERIC column does on insert); a column
    the frame lacks takes its default or NULL; ``audit`` appends the
    write-time audit column.  A default fills an absent column only, as in a
    database: an explicit NULL stays and is reported by the NOT NULL check.
    """
    present = set(df.columns)
    cols = []
    for name, dtype in contract.columns:
        if name in present:
            cols.append(F.col(name).cast(dtype).alias(name))
        elif name in contract.defaults:
            cols.append(F.lit(contract.defaults[name]).cast(dtype).alias(name))
        else:
            cols.append(F.lit(None).cast(dtype).alias(name))
    if audit and contract.audit_column:
        cols.append(F.current_timestamp().cast(TS).alias(contract.audit_column))
    return df.select(*cols)


def present(df: DataFrame) -> DataFrame:
    """Engine-neutral output types for comparisons and reports.

    DECIMAL → DOUBLE (after exact computation), small integers → BIGINT,
    DATE → midnight TIMESTAMP; everything else unchanged.  Applied only at
    the edge, never inside a computation.
    """
    cols = []
    for f in df.schema.fields:
        t = f.dataType
        if isinstance(t, T.DecimalType) or isinstance(t, T.FloatType):
            cols.append(F.col(f.name).cast("double").alias(f.name))
        elif isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            cols.append(F.col(f.name).cast("bigint").alias(f.name))
        elif isinstance(t, T.DateType):
            cols.append(F.col(f.name).cast(TS).alias(f.name))
        elif isinstance(t, T.BooleanType):
            cols.append(F.col(f.name).cast("bigint").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)

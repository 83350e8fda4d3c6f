"""Named queries over the driver's tables: one per operator, plus the reports.

``Lineage`` wires the operators lazily from one raw frame; each registered
query builds its own lineage, so every query reads the whole source tables
and Catalyst prunes what it does not need.  Outputs pass through
``present`` (engine-neutral types) for comparison against the SQL oracle.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopmart.contracts import CORE, DM_ITEMS, DM_ORDERS, FOREIGN_KEYS, present
from shopmart.operators import items_mart, normalize, orders_mart, quality, reports
from shopmart.operators.cleaning import RAW_ZERO_DEFAULTS, fill_defaults
from shopmart.plans.pipeline import SEQUENCE_KEYS, core_table
from shopmart.session import sized_session
from shopmart.sources.fixture import raw_order_lines, source_table


FEW_STORES = 1000  # that look-ups broadcast; of more, Spark broadcasts what it measures small


class Lineage:
    """Lazily built frames of the whole pipeline for one source folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, raw: DataFrame | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self._raw = raw
        self._filled: dict[str, DataFrame] = {}

    @cached_property
    def raw(self) -> DataFrame:
        return self._raw if self._raw is not None else raw_order_lines(self.spark, self.sf_dir)

    @cached_property
    def filled(self) -> DataFrame:
        return fill_defaults(self.raw)

    def filled_for(self, name: str) -> DataFrame:
        """The raw rows as core table ``name`` reads them: its columns, and copies only where it keeps them."""
        if self._raw is not None:
            return self.filled
        if name not in self._filled:
            columns = normalize.RAW_COLUMNS[name]
            raw = raw_order_lines(self.spark, self.sf_dir, columns, name in normalize.KEEPS_COPIES)
            self._filled[name] = fill_defaults(raw, [c for c in RAW_ZERO_DEFAULTS if c in columns])
        return self._filled[name]

    def core(self, name: str) -> DataFrame:
        return normalize.CORE_BUILDERS[name](self.filled_for(name))

    def core_with_keys(self, name: str) -> DataFrame:
        """Core table in contract shape, with its sequence key when it has one (K9)."""
        return core_table(self.filled_for(name), name)

    @cached_property
    def stores(self) -> DataFrame:
        """Core stores for look-ups.  A store is a nation of the source, so few nations make few stores."""
        few = self._raw is None and source_table(self.spark, self.sf_dir, "nation").count() <= FEW_STORES
        return F.broadcast(self.core("stores")) if few else self.core("stores")

    @cached_property
    def orders_enriched(self) -> DataFrame:
        return orders_mart.orders_enriched(self.core("orders"), self.stores)

    @cached_property
    def dm_orders(self) -> DataFrame:
        return orders_mart.build_dm_orders(self.core("orders"), self.core("order_items"),
                                           self.core("order_drivers"), self.stores)

    @cached_property
    def dm_items_base(self) -> DataFrame:
        oe = self.orders_enriched.filter(F.col("store_id").isNotNull())
        return items_mart.dm_items_base(self.core("order_items"), oe, self.core("items"))

    @cached_property
    def dm_items(self) -> DataFrame:
        return items_mart.build_dm_items(self.orders_enriched, self.core("order_items"),
                                         self.core("items"), self.stores)

    @cached_property
    def dm_items_read(self) -> DataFrame:
        """``dm_items`` for readers that take no rank: what only the ranks need leaves their plans."""
        return items_mart.build_dm_items(self.orders_enriched, self.core("order_items"),
                                         self.core("items"), self.stores, method="dealt")

    def mart(self, name: str) -> DataFrame:
        """A mart for reports and checks, none of which takes a rank."""
        return {"dm_orders": lambda: self.dm_orders, "dm_items": lambda: self.dm_items_read}[name]()


def _core_query(name):
    return lambda L: L.core(name)


def _report_query(fn, mart):
    return lambda L: fn(L.mart(mart))


def _unique_query(table, key, allow_null=False):
    def build(L):
        if table.startswith("dm_"):
            df = L.mart(table)
        elif table == "raw":
            df = L.filled
        elif table in SEQUENCE_KEYS and key == (SEQUENCE_KEYS[table][0],):
            df = L.core_with_keys(table)
        else:
            df = L.core(table)
        return quality.check_unique(df, key, allow_null)
    return build


def _fk_query(fk):
    return lambda L: quality.check_foreign_key(L.core(fk.child), fk.column,
                                               L.core(fk.parent), fk.parent_key)


# Keys that rows of the raw table and of the marts share: the uniqueness check at work.
SHARED_KEYS = {
    "check_unique_raw_order_item": ("raw", ("order_id", "item_id")),
    "check_unique_raw_user": ("raw", ("user_id",)),
    "check_unique_raw_store": ("raw", ("store_id",)),
    "check_unique_raw_driver": ("raw", ("driver_id",)),
    "check_unique_raw_item": ("raw", ("item_id",)),
    "check_unique_raw_order": ("raw", ("order_id",)),
    "check_unique_raw_order_driver": ("raw", ("order_id", "driver_id")),
    "check_unique_order_items_line": ("order_items", ("order_id", "item_id")),
    "check_unique_dm_orders_day_city": ("dm_orders", ("report_date", "city")),
    "check_unique_dm_items_day_item": ("dm_items", ("report_date", "item_id")),
}


def _fk_to_known(child, column, parent, key, known):
    """References to parents that lack a value count as broken."""
    return lambda L: quality.check_foreign_key(
        L.core(child), column, L.core(parent).filter(F.col(known).isNotNull()), key)


# References that some rows of the driver's data break: to stores whose city is known, to
# orders that were delivered.
KNOWN_PARENTS = {
    "check_fk_orders_store_with_city": ("orders", "store_id", "stores", "store_id", "store_city"),
    "check_fk_order_drivers_delivered": ("order_drivers", "order_id", "orders", "order_id",
                                         "delivered_at"),
}


def _not_null_core(L):
    frames = [quality.check_not_null(L.core_with_keys(n), c) for n, c in CORE.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _not_null_marts(L):
    return quality.check_not_null(L.dm_orders, DM_ORDERS).unionByName(
        quality.check_not_null(L.mart("dm_items"), DM_ITEMS))


def _build_registry() -> dict[str, Callable[[Lineage], DataFrame]]:
    r: dict[str, Callable[[Lineage], DataFrame]] = {}
    r["fill_defaults"] = lambda L: L.filled
    for name in ("users", "stores", "drivers", "items", "orders", "order_items", "order_drivers"):
        r[name] = _core_query(name)
    r["order_items_sk"] = lambda L: L.core_with_keys("order_items")
    r["order_drivers_sk"] = lambda L: L.core_with_keys("order_drivers")
    r["orders_enriched"] = lambda L: L.orders_enriched
    r["order_lines"] = lambda L: orders_mart.order_lines(L.core("order_items"), L.orders_enriched)
    r["order_financials"] = lambda L: orders_mart.order_financials(L.core("order_items"),
                                                                   L.orders_enriched)
    r["driver_stats"] = lambda L: orders_mart.driver_stats(L.core("order_drivers"))
    r["active_drivers"] = lambda L: orders_mart.active_drivers(L.core("order_drivers"),
                                                               L.orders_enriched)
    r["orders_fact"] = lambda L: orders_mart.orders_fact(
        L.orders_enriched,
        orders_mart.order_financials(L.core("order_items"), L.orders_enriched),
        orders_mart.driver_stats(L.core("order_drivers")))
    r["dm_orders"] = lambda L: L.dm_orders
    r["item_fact"] = lambda L: items_mart.item_fact(L.core("order_items"), L.orders_enriched,
                                                    L.core("items"))
    r["dm_items_base"] = lambda L: L.dm_items_base
    r["dm_items"] = lambda L: L.dm_items
    for name, (mart, fn) in reports.REPORTS.items():
        r[name] = _report_query(fn, mart)
    r["check_not_null_core"] = _not_null_core
    r["check_not_null_marts"] = _not_null_marts
    for table in ("users", "stores", "drivers", "items", "orders"):
        r[f"check_unique_{table}"] = _unique_query(table, CORE[table].key)
    r["check_unique_order_items_sk"] = _unique_query("order_items", ("order_item_sk",))
    r["check_unique_order_drivers_sk"] = _unique_query("order_drivers", ("order_driver_sk",))
    r["check_unique_order_drivers_pair"] = _unique_query("order_drivers", ("order_id", "driver_id"))
    for name, (table, key) in SHARED_KEYS.items():
        r[name] = _unique_query(table, key, allow_null=True)
    for name, spec in KNOWN_PARENTS.items():
        r[name] = _fk_to_known(*spec)
    r["check_unique_dm_orders"] = _unique_query("dm_orders", DM_ORDERS.key)
    r["check_unique_dm_items"] = _unique_query("dm_items", DM_ITEMS.key)
    for fk in FOREIGN_KEYS:
        r[f"check_{fk.name}"] = _fk_query(fk)
    r["check_rules_order_items"] = lambda L: quality.check_rules(L.core("order_items"),
                                                                 "order_items")
    r["check_rules_orders"] = lambda L: quality.check_rules(L.core("orders"), "orders")
    return r


REGISTRY = _build_registry()


def run(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Build query ``name`` over the tables in ``sf_dir``, in presentation types.

    The number of raw lines (from the files' footers) decides how many partitions its exchanges have.
    """
    sized = sized_session(spark, source_table(spark, sf_dir, "lineitem").count())
    return present(REGISTRY[name](Lineage(sized, sf_dir)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda spark, sf_dir, _n=name: run(spark, sf_dir, _n)) for name in REGISTRY}

"""The daily item mart ``dm_items`` with popularity ranks.

Plan shape: lines are first summed per (order, item) — map-side, so a hot
order or item collapses before any shuffle — then meet their order (one
row per order) on ``order_id`` and are summed per (report_date, city,
store, item).  Those narrow rows are ranked, and only then pick up the
item's title and category and the store address, so the rank sorts do not
carry long strings.  A store-year too large for a task is ranked from counts of cells (one quantity,
a range of items) and places within cells.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopmart.contracts import DM_ITEMS, conform
from shopmart.functions import money
from shopmart.functions.dates import iso_week
from shopmart.functions.dates import iso_year as iso_year_of
from shopmart.operators.orders_mart import fill_line_defaults
from shopmart.operators.ranges import MOST_CELLS, with_cell
from shopmart.session import shuffles_removed

ORDER_ATTRS = ("order_id", "store_id", "store_address", "city", "report_date", "report_year",
               "report_month", "report_day", "order_discount")
BASE_KEY = ("report_date", "city", "store_id", "item_id")


def item_fact(order_items: DataFrame, orders_enriched: DataFrame, items: DataFrame) -> DataFrame:
    """Line-level item fact (K17): ISO week, discounted amount, cancellation flag."""
    oi = fill_line_defaults(order_items)
    j = (oi.join(orders_enriched.select(*ORDER_ATTRS), "order_id")
         .join(items.select("item_id", "item_title", "item_category"), "item_id", "left"))
    return j.select(
        "order_id", "item_id", "item_title", "item_category", "store_id", "store_address",
        "city", "report_date", "report_year", "report_month", "report_day",
        iso_week("report_date").alias("report_week"),
        "item_quantity", "item_canceled_quantity",
        money.numerator_to_amount(money.discounted_numerator(
            "item_quantity", "item_price", "item_discount", "order_discount"))
        .alias("item_gross_amount_calc"),
        F.when(F.col("item_canceled_quantity") > 0, F.lit(1)).otherwise(F.lit(0))
        .alias("has_item_cancellation"),
    )


def order_item_pairs(order_items: DataFrame) -> DataFrame:
    """Per (order, item): units, cancelled units, Σ qty·price·(100 − d_item), flagged lines."""
    oi = fill_line_defaults(order_items)
    return oi.groupBy("order_id", "item_id").agg(
        F.sum("item_quantity").alias("ordered_quantity"),
        F.sum("item_canceled_quantity").alias("canceled_quantity"),
        F.sum(money.discounted_numerator("item_quantity", "item_price", "item_discount"))
        .cast("decimal(26,4)").alias("_gross_x100"),
        F.count_if(F.col("item_canceled_quantity") > 0).alias("cancel_lines"),
    )


def order_rows(order_items: DataFrame, orders_enriched: DataFrame) -> DataFrame:
    """The per-(order, item) sums with the attributes of their order."""
    return order_item_pairs(order_items).join(orders_enriched.select(*ORDER_ATTRS), "order_id")


def item_totals(order_items: DataFrame, orders_enriched: DataFrame,
                with_address: bool = False) -> DataFrame:
    """Measures per (report_date, city, store_id, item_id), no item or store labels.

    After the per-(order, item) sum an order appears once per item, so
    ``orders_with_item_cnt`` is a count; ``orders_with_item_cancellation_cnt``
    counts flagged *lines*, as defined.  All buffers are fixed-width, so the
    aggregate hashes; ``with_address`` adds ``store_address`` as a group key
    (it follows from ``store_id``) for callers without a stores table.
    """
    return _sum_rows(order_rows(order_items, orders_enriched), with_address)


def _sum_rows(rows: DataFrame, with_address: bool, dealt: bool = False) -> DataFrame:
    """``item_totals`` of ``order_rows``; of ``dealt`` ones the year is a group column too, as they are dealt by it."""
    key = list(BASE_KEY)
    if with_address:
        key.insert(3, "store_address")
    if dealt:
        key.insert(1, "report_year")
    agg = (rows.groupBy(*key)
           .agg(F.sum(F.col("_gross_x100") * money.pct_factor("order_discount"))
                .alias("_gross_x10000"),
                F.sum("ordered_quantity").alias("ordered_quantity"),
                F.sum("canceled_quantity").alias("canceled_quantity"),
                F.count(F.lit(1)).alias("orders_with_item_cnt"),
                F.sum("cancel_lines").alias("orders_with_item_cancellation_cnt")))
    d = F.col("report_date")
    return agg.select(
        "report_date", "report_year" if dealt else F.year(d).alias("report_year"), F.month(d).alias("report_month"),
        F.dayofmonth(d).alias("report_day"), iso_week(d).alias("report_week"),
        *[c for c in key if not c.startswith("report_")],
        money.to_money(money.numerator_to_amount("_gross_x10000")).alias("item_gross_amount"),
        "ordered_quantity", "canceled_quantity", "orders_with_item_cnt",
        "orders_with_item_cancellation_cnt")


def attach_labels(df: DataFrame, items: DataFrame, stores: DataFrame | None = None) -> DataFrame:
    """Item title/category (and the store address) by key lookup.

    Both are dimensions: Spark broadcasts them when measured small and
    shuffle-joins otherwise (AQE splits a hot item).
    """
    out = df.join(items.select("item_id", "item_title", "item_category"), "item_id", "left")
    if stores is not None:
        out = out.join(stores.select("store_id", "store_address"), "store_id", "left")
    return out


def dm_items_base(order_items: DataFrame, orders_enriched: DataFrame,
                  items: DataFrame) -> DataFrame:
    """Item totals per (report_date, city, store_id, item_id) before ranking.

    Equal to grouping the line fact by its eleven descriptive columns: the
    others follow from these keys.
    """
    labeled = attach_labels(item_totals(order_items, orders_enriched, with_address=True), items)
    return labeled.select(*[c for c in DM_ITEMS.names if not c.endswith("_rank")])


# Period of a rank → the columns that, with the store, make its group.
RANK_PERIODS = {"daily": ("report_date",), "weekly": ("report_week",),
                "monthly": ("report_month",)}
RANK_GROUP = ("report_year", "city", "store_id")
RANK_CELL_ROWS = 4096     # rows of a store-year that a range of items aims at
WINDOW_ROWS = 1 << 18     # a store-year of more rows is ranked by cells; a task may get several smaller ones
RANK_SALTS = 64     # parts that rows are spread over while only one row per cell counts


def _period_group(period: str, iso_year: bool) -> list[str]:
    """Group columns of a period's ranks; the year of an ISO week may be the ISO year."""
    group = list(RANK_GROUP)
    if period == "weekly" and iso_year:
        group[0] = "_iso_year"
    return [*RANK_PERIODS[period], *group]


def _ranks_by_window(df: DataFrame, iso_year: bool) -> DataFrame:
    """Six windows over one exchange on the store-year: simple, one task per store-year."""
    return _windows(df.repartition(*RANK_GROUP), iso_year)


def _windows(df: DataFrame, iso_year: bool) -> DataFrame:
    """The six windows, over rows that are dealt by store-year; if not, with exchanges of their own.

    Nothing of them, exchanges included, is left in the plan of a reader that takes no rank.
    """
    q, ties = F.col("ordered_quantity"), [F.col("item_id").asc(), F.col("report_date").asc()]
    return df.withColumns({
        f"{period}_{name}": F.row_number().over(
            Window.partitionBy(*_period_group(period, iso_year)).orderBy(order, *ties))
        for period in RANK_PERIODS
        for name, order in (("popularity_rank", q.desc()), ("reverse_popularity_rank", q.asc()))})


def _ranks_by_cell(df: DataFrame, iso_year: bool) -> DataFrame:
    """The six ranks as the rows in earlier cells plus the place within the cell.

    A cell is one quantity and a range of item ids (``ranges.with_cell``) of a rank group; its rows are ordered
    (item, day) in rising and falling order of quantity alike.  First every row gets
    its place in its cell and the cell's size; then the first row of each cell sums
    the sizes of the cells before (the other rows are salted away meanwhile);
    then the cell takes that sum over.  So a task holds a cell, or one row per cell of a
    group, never a group or a store-year, and the mart below is computed once.
    """
    # Ranges of items by each store-year's own bounds and size, twice where ids crowd.
    rows = with_cell(df, "_r1", RANK_GROUP, "item_id", RANK_CELL_ROWS)
    rows = with_cell(rows, "_r2", [*RANK_GROUP, "_r1"], "item_id", RANK_CELL_ROWS)
    rows = rows.withColumn("_range", F.col("_r1") * (MOST_CELLS + 1) + F.col("_r2"))
    cell = [*RANK_GROUP, "ordered_quantity", "_range"]
    periods = {p: _period_group(p, iso_year) for p in RANK_PERIODS}
    cells = {p: Window.partitionBy(*dict.fromkeys([*g, "ordered_quantity", "_range"]))
             for p, g in periods.items()}
    q, tie = F.col("ordered_quantity"), F.col("_range").asc()
    rows = rows.repartition(*cell)
    for p in periods:
        rows = rows.withColumns({
            f"_{p}_place": F.row_number().over(cells[p].orderBy("item_id", "report_date")),
            f"_{p}_size": F.count(F.lit(1)).over(cells[p])})
    for p, group in periods.items():
        first = F.col(f"_{p}_place") == 1
        rows = rows.withColumn("_salt", F.when(first, F.lit(0)).otherwise(
            F.lit(1) + F.pmod(F.xxhash64("item_id", "report_date"), F.lit(RANK_SALTS))))
        size = F.when(first, F.col(f"_{p}_size"))
        before = (Window.unboundedPreceding, -1)
        rows = rows.withColumns({
            f"_{p}_{name}": F.when(first, F.coalesce(F.sum(size).over(
                Window.partitionBy(*group, "_salt").orderBy(order, tie).rowsBetween(*before)),
                F.lit(0)))
            for name, order in (("falling", q.desc()), ("rising", q.asc()))})
    rows = rows.repartition(*cell)
    for p in periods:
        rows = rows.withColumns({
            rank: F.max(f"_{p}_{name}").over(cells[p]) + F.col(f"_{p}_place")
            for name, rank in (("falling", f"{p}_popularity_rank"),
                               ("rising", f"{p}_reverse_popularity_rank"))})
    ranks = [f"{p}_{r}" for p in periods for r in ("popularity_rank", "reverse_popularity_rank")]
    return rows.select(*df.columns, *ranks)


def _large_store_years(rows: DataFrame, limit: int) -> DataFrame | None:
    """The store-years of more than ``limit`` rows, found by a small job; None when there are none.

    The job's shuffle files go when it ends, so they do not add up with those of the query.
    """
    large = (rows.groupBy(*RANK_GROUP).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > limit)
             .select(*(F.col(c).alias(f"_large_{c}") for c in RANK_GROUP)))
    with shuffles_removed(rows.sparkSession):
        return None if large.isEmpty() else large


def _of_large(rows: DataFrame, large: DataFrame, how: str) -> DataFrame:
    same = F.lit(True)
    for c in RANK_GROUP:
        same = same & F.col(c).eqNullSafe(F.col(f"_large_{c}"))
    return rows.join(large, same, how)


def _ranks_by_size(df: DataFrame, iso_year: bool, window_rows: int | None = None) -> DataFrame:
    """Plain windows for store-years that a task can hold, cells for the others.

    One small job counts the large store-years first; when there are none, as usual, the windows alone are
    planned, and the mart below once.  The count picks the plan only: either gives the same ranks.
    """
    large = _large_store_years(df, WINDOW_ROWS if window_rows is None else window_rows)
    if large is None:
        return _ranks_by_window(df, iso_year)
    return _ranks_by_window(_of_large(df, large, "left_anti"), iso_year).unionByName(
        _ranks_by_cell(_of_large(df, large, "left_semi"), iso_year))


RANK_METHODS = {"sized": _ranks_by_size, "cells": _ranks_by_cell, "windows": _ranks_by_window,
                "dealt": _windows}


def with_ranks(df: DataFrame, iso_year: bool = False, method: str = "sized") -> DataFrame:
    """The six popularity ranks over item rows of dated, store-bound orders.

    Ranks are by ``ordered_quantity`` within (period, report_year, city,
    store); ties → item_id, then day.  Weekly ranks group by calendar
    ``report_year`` and ISO ``report_week`` (so 2024-12-30, ISO week 1 of 2025,
    joins week 1 of 2024), with ``iso_year=True`` by the ISO week-numbering year.

    All methods give the same ranks: ``"windows"`` from six plain windows, with all rows of a
    store-year in one task; ``"cells"`` holds no rank group in one task, whatever the spread of the item
    ids; ``"sized"`` takes windows for store-years of up to ``WINDOW_ROWS`` rows, cells for larger ones;
    ``"dealt"`` takes windows without an exchange, for rows that are dealt by store-year or ranks that nobody reads.
    """
    ranked = df.filter(F.col("store_id").isNotNull())
    if iso_year:
        ranked = ranked.withColumn("_iso_year", iso_year_of("report_date"))
    return RANK_METHODS[method](ranked, iso_year)


def dm_items(base: DataFrame, iso_year: bool = False, method: str = "sized") -> DataFrame:
    """Add the six popularity ranks to ``dm_items_base`` and conform."""
    return conform(with_ranks(base, iso_year, method), DM_ITEMS)


def build_dm_items(orders_enriched: DataFrame, order_items: DataFrame, items: DataFrame,
                   stores: DataFrame | None = None, **options) -> DataFrame:
    """Dated orders + lines + items (+ stores) → ``dm_items``.

    Ranks are computed on the narrow measure rows; titles, categories and
    the store address are looked up afterwards, so the rank sorts do
    not carry the long strings.
    """
    oe = orders_enriched.filter(F.col("store_id").isNotNull())
    ranked = _ranked_totals(order_rows(order_items, oe), stores is None, **options)
    d = F.col("report_date")  # what follows from the date is not exchanged with it
    parts = {"report_year": F.year(d), "report_month": F.month(d), "report_day": F.dayofmonth(d),
             "report_week": iso_week(d)}
    return conform(attach_labels(ranked.drop(*parts), items, stores).withColumns(parts), DM_ITEMS)


def _ranked_totals(rows: DataFrame, with_address: bool, iso_year: bool = False,
                   method: str = "sized") -> DataFrame:
    """Totals and ranks of ``order_rows``.

    Where windows rank, the rows are dealt by store-year before they are summed: sums and ranks then share one
    exchange, and the lines of an order stay together in it, which a hash of the item would scatter.
    The rows of a store-year are counted before the sum, so a count may only be too large.
    """
    if method not in ("sized", "windows"):
        if method == "dealt":
            rows = rows.repartition("report_date", "city", "store_id")
        return with_ranks(_sum_rows(rows, with_address), iso_year, method)

    def windows(part: DataFrame) -> DataFrame:
        return with_ranks(_sum_rows(part.repartition(*RANK_GROUP), with_address, dealt=True), iso_year, "dealt")

    large = _large_store_years(rows, WINDOW_ROWS) if method == "sized" else None
    if large is None:
        return windows(rows)
    cells = with_ranks(_sum_rows(_of_large(rows, large, "left_semi"), with_address), iso_year, "cells")
    return windows(_of_large(rows, large, "left_anti")).unionByName(cells)

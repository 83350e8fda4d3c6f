"""Hand-made rows for the rules that bite (address parts, nulls, clamps, ranks, flags)."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shopmart.contracts import RAW
from shopmart.operators import items_mart, normalize, orders_mart
from shopmart.operators.cleaning import fill_defaults
from shopmart.plans.pipeline import core_tables, marts


def raw_rows(spark, rows):
    base = {c: None for c in RAW.names}
    data = []
    for r in rows:
        row = dict(base)
        row.update(r)
        data.append(tuple(row[c] for c in RAW.names))
    return spark.createDataFrame(data, RAW.schema)


def line(order_id, item_id=1, **kw):
    row = dict(order_id=order_id, user_id=10, user_phone="u", store_id=1,
               store_address="Main st, Metro , Springfield", address_text="Springfield, 1",
               created_at=datetime(2024, 3, 4, 10), item_id=item_id, item_title=f"t{item_id}",
               item_category="c", item_quantity=2, item_price=Decimal("10.00"),
               item_discount=Decimal("0"), order_discount=Decimal("0"),
               delivery_cost=Decimal("5.00"), driver_id=7, driver_phone="d")
    row.update(kw)
    return row


def test_address_parts(spark):
    raw = raw_rows(spark, [
        line(1, store_id=1, store_address="Street only", address_text=None),
        line(2, store_id=2, store_address=",Leading", address_text=",x"),
        line(3, store_id=3, store_address="a,  Town  ,b", address_text="  City ,rest"),
    ])
    stores = {r.store_id: r.store_city for r in normalize.stores(raw).collect()}
    assert stores == {1: None, 2: "Leading", 3: "Town"}
    cities = {r.order_id: r.delivery_city for r in normalize.orders(raw).collect()}
    assert cities == {1: None, 2: "", 3: "City"}


def test_city_fallback_and_null_user_store(spark):
    raw = fill_defaults(raw_rows(spark, [
        line(1, address_text=None, store_id=9, store_address="OneWord"),  # → UNKNOWN
        line(2, address_text=None),                                # → store city
        line(3, address_text=",x"),                                 # '' wins the coalesce
        line(4, user_id=None),                                      # order dropped
        line(5, store_id=None, store_address=None),                 # kept, no store
        line(6, created_at=None),                                   # not dated
    ]))
    orders = normalize.orders(raw)
    stores = normalize.stores(raw)
    oe = {r.order_id: r.city for r in orders_mart.orders_enriched(orders, stores).collect()}
    assert oe == {1: "UNKNOWN", 2: "Metro", 3: "", 5: "Springfield"}


def test_line_amounts_clamp_and_discounts(spark):
    raw = fill_defaults(raw_rows(spark, [
        line(1, item_quantity=3, item_canceled_quantity=5, item_price=Decimal("9.99")),
        line(1, item_id=2, item_quantity=2, item_price=Decimal("10.01"),
             item_discount=Decimal("12.50"), order_discount=Decimal("10.00")),
        line(1, item_id=3, item_quantity=1, item_price=Decimal("1.00"),
             item_discount=Decimal("120.00"), order_discount=Decimal("10.00")),
    ]))
    t = core_tables(raw)
    oe = orders_mart.orders_enriched(t["orders"], t["stores"])
    fin = orders_mart.order_financials(t["order_items"], oe).first()
    assert fin.gross_amount_items == Decimal("3") * Decimal("9.99") + Decimal("20.02") + 1
    # revenue: clamp to 0 units; 2·10.01·0.875·0.9; 1·1·(−0.2)·0.9
    expect = Decimal("2") * Decimal("10.01") * Decimal("0.875") * Decimal("0.9") \
        + Decimal("-0.2") * Decimal("0.9")
    assert fin.revenue_amount_items == expect
    lines = orders_mart.order_lines(t["order_items"], oe)
    assert lines.agg(F.sum("revenue_line_amount")).first()[0] == expect


def test_service_fault_regex(spark):
    reasons = ["КУРЬЕР опоздал", "restored later", "Store closed", "Доставку задержали",
               "Customer changed mind", None]
    raw = fill_defaults(raw_rows(spark, [line(i + 1, order_cancellation_reason=r)
                                         for i, r in enumerate(reasons)]))
    t = core_tables(raw)
    oe = orders_mart.orders_enriched(t["orders"], t["stores"])
    fact = orders_mart.orders_fact(oe, orders_mart.order_financials(t["order_items"], oe),
                                   orders_mart.driver_stats(t["order_drivers"]))
    flags = {r.order_id: r.is_canceled_service_fault for r in fact.collect()}
    assert flags == {1: 1, 2: 1, 3: 1, 4: 0, 5: 0, 6: 0}


def test_dm_orders_counts_and_ratios(spark):
    raw = fill_defaults(raw_rows(spark, [
        line(1, user_id=10, driver_id=7),
        line(1, user_id=10, driver_id=8),                      # courier change; line repeated
        line(2, user_id=10, item_id=None, item_title=None, driver_id=None),  # no items, no courier
        line(3, user_id=11, delivered_at=datetime(2024, 3, 5), canceled_at=datetime(2024, 3, 6)),
    ]))
    dm = marts(core_tables(raw))["dm_orders"].collect()
    assert len(dm) == 1
    r = dm[0]
    assert (r.orders_created_cnt, r.buyers_cnt, r.orders_with_driver_change_cnt,
            r.active_drivers_cnt, r.orders_delivered_cnt, r.orders_canceled_after_delivery_cnt) \
        == (3, 2, 1, 2, 1, 1)
    # order 1: two identical lines (fan-out kept) = 40 + 5; order 2: 0 + 5; order 3: 20 + 5
    assert r.revenue_amount == Decimal("75.00")
    assert r.avg_check_amount == Decimal("25.00")
    assert r.orders_per_buyer == Decimal("1.5000")
    assert r.revenue_per_buyer == Decimal("37.50")
    assert (r.report_year, r.report_month, r.report_day) == (2024, 3, 4)


def test_item_mart_flags_weeks_and_ranks(spark):
    raw = fill_defaults(raw_rows(spark, [
        # same item twice in one order, both lines cancelled → 1 order, 2 flagged lines
        line(1, item_id=1, item_quantity=3, item_canceled_quantity=1),
        line(1, item_id=1, item_quantity=3, item_canceled_quantity=1, driver_id=8),
        line(2, item_id=2, item_quantity=5),
        line(3, item_id=3, item_quantity=5),                    # tie with item 2
        # 2024-12-30 is ISO week 1, paired with calendar year 2024
        line(4, item_id=1, item_quantity=1, created_at=datetime(2024, 12, 30, 9)),
    ]))
    dm = {(r.report_date, r.item_id): r for r in marts(core_tables(raw))["dm_items"].collect()}
    a = dm[(date(2024, 3, 4), 1)]
    assert (a.ordered_quantity, a.canceled_quantity, a.orders_with_item_cnt,
            a.orders_with_item_cancellation_cnt) == (6, 2, 1, 2)
    assert a.daily_popularity_rank == 1 and a.daily_reverse_popularity_rank == 3
    b, c = dm[(date(2024, 3, 4), 2)], dm[(date(2024, 3, 4), 3)]
    assert (b.daily_popularity_rank, c.daily_popularity_rank) == (2, 3)
    assert (b.daily_reverse_popularity_rank, c.daily_reverse_popularity_rank) == (1, 2)
    late = dm[(date(2024, 12, 30), 1)]
    assert (late.report_year, late.report_week) == (2024, 1)
    assert late.monthly_popularity_rank == 1


def test_items_without_title_and_pairs_distinct(spark):
    raw = fill_defaults(raw_rows(spark, [
        line(1, item_id=5, item_title=None), line(1, item_id=6), line(1, item_id=6),
    ]))
    assert [r.item_id for r in normalize.items(raw).collect()] == [6]
    assert normalize.order_items(raw).count() == 3
    assert normalize.order_items(raw, line_key=["order_id", "item_id"]).count() == 2
    assert normalize.order_drivers(raw).count() == 1


@pytest.mark.parametrize("n", [1, 3, 7])
def test_marts_invariant_under_partitioning(spark, n):
    from tests.conftest import SF_SMALL
    from shopmart.sources.fixture import raw_order_lines
    raw = raw_order_lines(spark, SF_SMALL)
    base = marts(core_tables(raw))
    shuffled = marts(core_tables(raw.repartition(n)))
    for name in ("dm_orders", "dm_items"):
        assert base[name].exceptAll(shuffled[name]).count() == 0
        assert shuffled[name].exceptAll(base[name]).count() == 0


def test_item_fact_matches_base(spark):
    from tests.conftest import SF_SMALL
    from shopmart.plans.catalog import Lineage
    L = Lineage(spark, SF_SMALL)
    fact = items_mart.item_fact(L.core("order_items"), L.orders_enriched, L.core("items"))
    fact = fact.filter(F.col("store_id").isNotNull())
    via_lines = (fact.groupBy("report_date", "city", "store_id", "item_id")
                 .agg(F.sum("item_gross_amount_calc").cast("decimal(18,2)").alias("g"),
                      F.countDistinct("order_id").alias("n")))
    base = L.dm_items_base.select("report_date", "city", "store_id", "item_id",
                                  F.col("item_gross_amount").alias("g"),
                                  F.col("orders_with_item_cnt").cast("bigint").alias("n"))
    assert via_lines.exceptAll(base).count() == 0 and base.exceptAll(via_lines).count() == 0


def test_hot_order_store_and_item(spark):
    """A third of all lines on one order, store and item: same marts as the line-level fact."""
    rows = [line(1, item_id=1, item_quantity=1 + i % 3, item_canceled_quantity=i % 2,
                 item_price=Decimal("3.35"), item_discount=Decimal("12.50"),
                 order_discount=Decimal("10.00"), driver_id=100 + i % 5) for i in range(300)]
    rows += [line(2 + i, item_id=2 + i % 40, store_id=2 + i % 7,
                  store_address=f"Main st, R , S{i % 7}", address_text=None,
                  item_quantity=1 + i % 4, item_price=Decimal("1.99") + i,
                  created_at=datetime(2024, 1 + i % 12, 1 + i % 28, 8),
                  user_id=20 + i % 50, driver_id=7 + i % 9) for i in range(600)]
    raw = fill_defaults(raw_rows(spark, rows)).repartition(5)
    t = core_tables(raw)
    got = marts(t)
    oe = orders_mart.orders_enriched(t["orders"], t["stores"]).filter(F.col("store_id").isNotNull())
    fact = items_mart.item_fact(t["order_items"], oe, t["items"])
    brute = (fact.groupBy("report_date", "city", "store_id", "item_id")
             .agg(F.sum("item_quantity").cast("int").alias("q"),
                  F.countDistinct("order_id").cast("int").alias("n"),
                  F.sum("has_item_cancellation").cast("int").alias("c"),
                  F.sum("item_gross_amount_calc").cast("decimal(18,2)").alias("g")))
    mart = got["dm_items"].select("report_date", "city", "store_id", "item_id",
                                  F.col("ordered_quantity").alias("q"),
                                  F.col("orders_with_item_cnt").alias("n"),
                                  F.col("orders_with_item_cancellation_cnt").alias("c"),
                                  F.col("item_gross_amount").alias("g"))
    assert brute.exceptAll(mart).count() == 0 and mart.exceptAll(brute).count() == 0
    hot = got["dm_orders"].filter("store_id = 1").first()
    assert hot.active_drivers_cnt == 5 + 0 and hot.orders_created_cnt == 1
    lines = orders_mart.order_lines(t["order_items"], oe).filter("order_id = 1")
    revenue = lines.agg(F.sum("revenue_line_amount")).first()[0] + Decimal("5.00")
    assert hot.revenue_amount == revenue.quantize(Decimal("0.01"), rounding="ROUND_HALF_UP")


def test_weekly_rank_iso_year_option(spark):
    raw = fill_defaults(raw_rows(spark, [
        line(1, item_id=1, item_quantity=1, created_at=datetime(2024, 12, 30, 9)),  # ISO 2025-W01
        line(2, item_id=2, item_quantity=5, created_at=datetime(2024, 1, 2, 9)),    # ISO 2024-W01
    ]))
    t = core_tables(raw)
    oe = orders_mart.orders_enriched(t["orders"], t["stores"])
    base = items_mart.dm_items_base(t["order_items"], oe, t["items"])
    calendar = {r.item_id: r.weekly_popularity_rank for r in items_mart.dm_items(base).collect()}
    iso = {r.item_id: r.weekly_popularity_rank
           for r in items_mart.dm_items(base, iso_year=True).collect()}
    assert calendar == {2: 1, 1: 2}      # both in (2024, week 1)
    assert iso == {2: 1, 1: 1}           # different ISO years


def test_top10_tie_at_the_cut_is_broken_by_key(spark):
    from shopmart.operators import reports
    rows = [(date(2024, 1, 1), "c", i, f"s{i}", Decimal("10.00")) for i in range(12, 0, -1)]
    dm = spark.createDataFrame(rows, "report_date date, city string, store_id bigint, "
                                     "store_address string, avg_check_amount decimal(18,2)")
    for n in (1, 4):
        top = reports.q3_best_check_stores(dm.repartition(n)).collect()
        assert [r.store_id for r in top] == list(range(1, 11))


def test_fill_defaults_replaces_nan_in_float_columns(spark):
    df = spark.createDataFrame([(float("nan"), None, 1.5)], "item_discount double, "
                               "item_canceled_quantity int, delivery_cost double")
    out = fill_defaults(df, ["item_discount", "item_canceled_quantity", "delivery_cost"]).first()
    assert (out.item_discount, out.item_canceled_quantity, out.delivery_cost) == (0.0, 0, 1.5)


def test_marts_invariant_under_aqe_off(spark):
    from tests.conftest import SF_SMALL
    from shopmart.sources.fixture import raw_order_lines
    raw = raw_order_lines(spark, SF_SMALL)
    with_aqe = {k: v.collect() for k, v in marts(core_tables(raw)).items()}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        without = {k: v.collect() for k, v in marts(core_tables(raw)).items()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    for name in with_aqe:
        assert sorted(map(repr, with_aqe[name])) == sorted(map(repr, without[name])), name

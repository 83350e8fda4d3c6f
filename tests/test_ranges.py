"""Sequence keys and ranks for ids of any spread."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shopmart.operators import items_mart
from shopmart.operators.cleaning import with_surrogate_key
from shopmart.operators.ranges import plan_cells, with_cell

ROWS = 12000


def spread(spark, kind):
    """(a, b) rows whose first column is spread in different ways; b tells rows of one a apart."""
    ids = spark.range(ROWS).repartition(5)
    a = {"dense": F.col("id"),
         "hashed": F.xxhash64("id"),
         "crowded": F.when(F.col("id") % 2 == 0, F.col("id")).otherwise(F.xxhash64("id")),
         "hot": F.when(F.col("id") % 3 == 0, F.lit(777)).otherwise(F.xxhash64("id")),
         "hot among neighbours": F.when(F.col("id") % 3 == 0, F.lit(2 ** 62 + 5)).otherwise(
             2 ** 62 + F.col("id") % 2048),
         "text": F.concat(F.lit("https://shop.example/"), F.hex(F.xxhash64("id"))),
         "time": F.timestamp_seconds(F.col("id") * F.col("id")).cast("timestamp_ntz"),
         "nulls": F.when(F.col("id") % 3 > 0, F.xxhash64("id")),
         "decimal": (F.xxhash64("id") / 1000).cast("decimal(20,3)")}[kind]
    return ids.select(a.alias("a"), (F.col("id") * 7919 % 100003).alias("b"))


@pytest.mark.parametrize("kind", ["dense", "hashed", "crowded", "hot", "hot among neighbours", "text", "time",
                                  "nulls", "decimal"])
def test_keys_are_dense_ordered_and_no_cell_is_large(spark, kind):
    df = spread(spark, kind)
    got = with_surrogate_key(df, "sk", ["a", "b"], cell_rows=300)
    order = Window.orderBy(F.col("a").asc_nulls_first(), F.col("b").asc_nulls_first())
    want = df.withColumn("sk", F.row_number().over(order).cast("long"))
    assert got.exceptAll(want.select(*got.columns)).count() == 0 == want.select(*got.columns).exceptAll(got).count()
    planned = plan_cells(df, "a", "b", 300)
    largest = planned.add(df).groupBy(*planned.names).count().agg(F.max("count")).first()[0]
    assert largest <= 600 < ROWS / 10


def test_one_column_and_strings_that_share_their_beginning(spark):
    long = "x" * 30
    rows = [(f"{long}{i:05d}",) for i in random.Random(1).sample(range(99999), 900)] + [(None,)] * 3 + [("",)] * 2
    df = spark.createDataFrame(rows, "a string").repartition(4)
    got = sorted(with_surrogate_key(df, "sk", ["a"], cell_rows=50).collect(), key=lambda r: r.sk)
    assert [r.sk for r in got] == list(range(1, len(rows) + 1))
    assert [r.a for r in got] == [None] * 3 + sorted(a for a, in rows if a is not None)
    two = spark.createDataFrame([(f"{long}{i % 7}", i) for i in range(700)], "a string, b int")
    got = sorted(with_surrogate_key(two, "sk", ["a", "b"], cell_rows=50).collect(), key=lambda r: r.sk)
    assert [(r.a, r.b) for r in got] == sorted((f"{long}{i % 7}", i) for i in range(700))


def test_windows_over_cells_have_a_fixed_bound(spark):
    """The only window without a partition runs over the cells of the first step."""
    df = spread(spark, "hashed")
    got = with_surrogate_key(df, "sk", ["a", "b"], cell_rows=300)
    text = got._jdf.queryExecution().optimizedPlan().toString()
    windows = re.findall(r"windowspecdefinition\(([^,]*)", text)
    alone = [w for w in windows if "ASC" in w]      # an order where the partition columns would stand
    assert len(windows) >= 2
    planned = plan_cells(df, "a", "b", 300)
    assert planned.first[2] == ROWS // 300 and not planned.steps and len(alone) <= 1


def test_keys_follow_a_given_mark(spark):
    df = spread(spark, "hashed").limit(50)
    assert sorted(r.sk for r in with_surrogate_key(df, "sk", ["a", "b"], after=1000).collect()) == list(
        range(1001, 1051))


@pytest.fixture(scope="module")
def hashed_items(spark):
    """One large store with hashed item ids among small ones."""
    item = F.xxhash64(F.col("id") % 4000)
    day = F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 40).cast("int"))
    rows = spark.range(16000).select(
        day.alias("report_date"), F.year(day).alias("report_year"), F.month(day).alias("report_month"),
        F.weekofyear(day).alias("report_week"), F.lit("a city").alias("city"),
        F.when(F.col("id") % 8 > 0, 1).when(F.col("id") % 16 > 0, 2).otherwise(3).cast("long").alias("store_id"),
        item.alias("item_id"), (F.col("id") % 5).alias("ordered_quantity"))
    return rows.groupBy(*[c for c in rows.columns if c != "ordered_quantity"]).agg(
        F.sum("ordered_quantity").alias("ordered_quantity"))


def test_hashed_item_ids_of_one_store_are_ranked_in_many_cells(spark, hashed_items, monkeypatch):
    monkeypatch.setattr(items_mart, "RANK_CELL_ROWS", 200)
    windows = items_mart.with_ranks(hashed_items, method="windows")
    cells = items_mart.with_ranks(hashed_items, method="cells")
    assert cells.exceptAll(windows).count() == 0 and cells.count() == windows.count()
    own = hashed_items.where("store_id = 1")
    ranged = with_cell(own, "_range", items_mart.RANK_GROUP, "item_id", 200)
    sizes = [r["count"] for r in ranged.groupBy("_range").count().collect()]
    assert len(sizes) > own.count() / 400 and max(sizes) < 600


def test_store_years_are_ranked_by_their_size(spark, hashed_items, monkeypatch):
    want = items_mart.with_ranks(hashed_items, method="windows")
    for limit in (1, 3000, 1 << 20):     # all, the largest, none by cells
        monkeypatch.setattr(items_mart, "WINDOW_ROWS", limit)
        got = items_mart.with_ranks(hashed_items)
        assert got.exceptAll(want).count() == 0 and got.count() == want.count()
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert ("Union" in plan) == (limit < 1 << 20)     # without large ones the windows alone are planned

"""Plan shape guards: pushdown, pruning, pre-aggregation, shared exchanges."""

import io
import re
from contextlib import redirect_stdout

import pytest

from shopmart.contracts import CORE
from shopmart import session
from shopmart.plans import catalog, pipeline
from shopmart.sources.fixture import raw_order_lines
from shopmart.sources.io import Target, read_table
from tests.conftest import SF_SMALL


def plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def core(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("plans")
    stage = Target.parquet(str(base / "stage"), versioned=False)
    from shopmart.sources.io import write_table
    write_table(raw_order_lines(spark, SF_SMALL), stage, "raw")
    target = Target.parquet(str(base / "core"))
    pipeline.run_etl(spark, stage, target)
    return {n: read_table(spark, target, n, schema=CORE[n].schema) for n in CORE}


def test_dm_orders_plan(spark, core):
    p = plan(pipeline.marts(core)["dm_orders"])
    # store-less and undated orders leave at the scan
    assert re.search(r"PushedFilters: \[[^\]]*IsNotNull\(store_id\)[^\]]*IsNotNull\(created_at\)", p)
    # only one distinct aggregate per grouping: no Expand
    assert "Expand" not in p
    # order lines are read without the columns the mart does not use
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", p)
    assert not any("item_replaced_id" in s or "order_item_sk" in s for s in schemas)
    # lines are aggregated per order before any shuffle on order_id
    assert re.search(r"HashAggregate.*\n(?:.*\n)*?.*Keys \[1\]: \[order_id", p)


def test_dm_items_windows_plan_one_rank_exchange(spark, core):
    p = plan(pipeline.marts(core, method="windows")["dm_items"])
    assert p.count("REPARTITION_BY_COL") == 1
    assert len(re.findall(r"\n\(\d+\) Window\n", p)) == 6
    assert "Expand" not in p


def test_fixture_reads_the_whole_part_table(spark):
    parts = spark.read.parquet(f"{SF_SMALL}/part.parquet").count()
    raw = raw_order_lines(spark, SF_SMALL)
    assert raw.select("item_id").distinct().count() > 0.9 * parts
    assert "Filter : p_partkey" not in plan(raw)


def test_required_columns_reach_the_scan(spark, core, tmp_path):
    from shopmart.operators.normalize import orders
    raw_order_lines(spark, SF_SMALL).write.parquet(str(tmp_path / "raw"))
    p = plan(orders(spark.read.parquet(str(tmp_path / "raw"))))
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", p)[1]
    assert "IsNotNull(order_id)" in pushed and "IsNotNull(user_id)" in pushed


def test_foreign_key_check_splits_a_hot_reference(spark):
    from pyspark.sql import functions as F

    from shopmart.operators.quality import check_foreign_key
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        child = spark.range(0, 400000, numPartitions=8).select(
            F.when(F.col("id") % 5 < 4, F.lit(1)).otherwise(F.col("id")).alias("ref"))
        parents = spark.range(0, 1000).withColumnRenamed("id", "pk")
        bad = check_foreign_key(child, "ref", parents, "pk")
        assert bad.count() == bad.collect().__len__() == 80000 - 200
        assert "skew=true" in bad._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_cli_jobs(spark, tmp_path):
    import json
    from contextlib import redirect_stdout
    from shopmart.cli import main
    raw = tmp_path / "raw"
    raw_order_lines(spark, SF_SMALL).write.parquet(str(raw))
    outs = []
    for argv in (["extract", "--raw", f"{raw}/*.parquet", "--stage", str(tmp_path / "st")],
                 ["etl", "--stage", str(tmp_path / "st"), "--core", str(tmp_path / "core"),
                  "--violations", str(tmp_path / "violations")],
                 ["marts", "--core", str(tmp_path / "core"), "--dm", str(tmp_path / "dm"),
                  "--partition-by-month"],
                 ["report", "q1_weekday_totals", "--dm", str(tmp_path / "dm")]):
        buf = io.StringIO()
        with redirect_stdout(buf):
            assert main(argv) == 0
        outs.append([json.loads(line) for line in buf.getvalue().strip().splitlines()])
    assert outs[0][0]["rows"] == {"raw": 6027}
    assert outs[2][0]["rows"]["dm_orders"] == 1437
    assert len(outs[3]) == 7
    orphans = read_table(spark, Target.parquet(str(tmp_path / "violations")),
                         "fk_order_items_order")
    assert orphans.count() == 67


def test_cli_report_prints_every_row(spark, tmp_path):
    import json

    from pyspark.sql import functions as F

    from shopmart.cli import main
    from shopmart.contracts import DM_ITEMS, conform
    from shopmart.sources.io import write_table
    many = spark.range(0, 1500).select(F.format_string("category %s", "id").alias("item_category"),
                                       F.lit(1).alias("item_gross_amount"))
    write_table(conform(many, DM_ITEMS), Target.parquet(str(tmp_path / "dm")), "dm_items")
    buf = io.StringIO()
    with redirect_stdout(buf):
        assert main(["report", "q5_category_turnover", "--dm", str(tmp_path / "dm")]) == 0
    rows = [json.loads(line) for line in buf.getvalue().strip().splitlines()]
    assert len({r["item_category"] for r in rows}) == 1500


@pytest.mark.parametrize("iso_year", [False, True])
def test_rank_methods_agree(spark, core, iso_year):
    cells = pipeline.marts(core, iso_year=iso_year)["dm_items"]
    windows = pipeline.marts(core, iso_year=iso_year, method="windows")["dm_items"]
    assert cells.exceptAll(windows).count() == 0
    assert windows.exceptAll(cells).count() == 0


def test_ranks_of_one_big_store_are_spread(spark, monkeypatch):
    """Nine tenths of all rows in one store: its rows are ranked in many tasks."""
    from pyspark.sql import functions as F

    from shopmart.operators import items_mart
    from shopmart.operators.items_mart import with_ranks
    monkeypatch.setattr(items_mart, "WINDOW_ROWS", 10_000)  # what a task may hold
    rows = spark.range(0, 60000).select(
        F.lit("2024-03-05").cast("date").alias("report_date"), F.lit(2024).alias("report_year"),
        F.lit(3).alias("report_month"), F.lit(10).alias("report_week"), F.lit("c").alias("city"),
        F.when(F.col("id") % 10 == 0, F.lit(2)).otherwise(F.lit(1)).alias("store_id"),
        F.col("id").alias("item_id"), (F.col("id") % 4 + 1).alias("ordered_quantity"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # tiny data
    try:
        ranked = with_ranks(rows)
        tasks = (ranked.filter("store_id = 1").groupBy(F.spark_partition_id().alias("p")).count()
                 .collect())
        assert len(tasks) >= 4 and max(t["count"] for t in tasks) < 0.5 * 54000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    top = ranked.filter("store_id = 1 and monthly_popularity_rank <= 2").orderBy("monthly_popularity_rank")
    assert [r.item_id for r in top.collect()] == [3, 7]
    assert ranked.filter("store_id = 1").select("daily_reverse_popularity_rank").distinct().count() == 54000


def test_a_report_builds_its_own_mart_only(monkeypatch):
    lineage = catalog.Lineage(None, "")
    monkeypatch.setattr(catalog.Lineage, "dm_orders", "orders")
    monkeypatch.setattr(catalog.Lineage, "dm_items", property(lambda self: pytest.fail("dm_items built")))
    assert lineage.mart("dm_orders") == "orders"


def exchanges(df) -> list[int]:
    return [int(n) for n in re.findall(r"hashpartitioning\([^\n]*, (\d+)\)", plan(df))]


@pytest.mark.parametrize("name", ["q5_category_turnover", "q1_weekday_totals", "order_drivers_sk", "active_drivers",
                                  "check_unique_order_items_sk", "check_not_null_core"])
def test_partitions_follow_the_rows(spark, monkeypatch, name):
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    small = catalog.run(spark, SF_SMALL, name)
    assert max(exchanges(small)) == usual
    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    monkeypatch.setattr(session, "TASK_ROWS", -(-lines // 31))
    fine = catalog.run(spark, SF_SMALL, name)
    assert min(exchanges(fine)) == max(exchanges(fine)) == 31
    assert int(spark.conf.get("spark.sql.shuffle.partitions")) == usual  # the caller's stays
    assert sorted(map(str, fine.collect())) == sorted(map(str, small.collect()))


def test_a_sized_session_keeps_the_settings(spark):
    sized = session.sized_session(spark, 10 ** 7)
    assert sized.conf.get("spark.sql.session.timeZone") == "UTC"
    assert int(sized.conf.get("spark.sql.shuffle.partitions")) == -(-10 ** 7 // session.TASK_ROWS)
    assert sized.conf.get("spark.sql.adaptive.coalescePartitions.enabled") == "false"
    assert session.sized_session(spark, 1000) is spark
    assert int(session.sized_session(spark, 10 ** 12).conf.get("spark.sql.shuffle.partitions")) == 1 << 13


def test_many_partitions_of_the_caller_are_not_merged_into_large_tasks(spark):
    from pyspark.sql import functions as F

    rows, caller = 16 * session.TASK_ROWS, spark.newSession()
    caller.conf.set("spark.sql.shuffle.partitions", "400")
    caller.conf.set("spark.sql.adaptive.enabled", "true")
    caller.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sized = session.sized_session(caller, rows)
    tasks = (sized.range(0, rows, 1, 8).groupBy(F.xxhash64("id").alias("key")).count()
             .groupBy(F.spark_partition_id().alias("p")).agg(F.sum("count").alias("n")).collect())
    assert sum(t.n for t in tasks) == rows and max(t.n for t in tasks) < 1.1 * session.TASK_ROWS
    assert caller.conf.get("spark.sql.shuffle.partitions") == "400"
    assert session.sized_session(caller, session.MERGED_TASKS * session.TASK_ROWS) is caller
    for key in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.coalescePartitions.enabled"):
        caller.conf.set(key, "false")       # nothing merges: the caller's number stands
        assert session.sized_session(caller, rows) is caller
        caller.conf.set(key, "true")


def test_scans_of_a_sized_session_follow_the_rows(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(0, 400_000, 1, 1).write.option("parquet.block.size", 1 << 17).parquet(path)
    spark.conf.set("spark.sql.files.openCostInBytes", "65536")
    try:
        pieces = [s.read.parquet(path).rdd.getNumPartitions()
                  for s in (spark, session.sized_session(spark, 16 * session.TASK_ROWS))]
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert pieces[1] >= 12 > pieces[0]


def test_a_store_year_of_300_000_rows_is_no_single_task(spark):
    from pyspark.sql import functions as F

    from shopmart.operators.items_mart import with_ranks
    rows = spark.range(0, 300_000).select(
        F.lit("2024-03-05").cast("date").alias("report_date"), F.lit(2024).alias("report_year"),
        F.lit(3).alias("report_month"), F.lit(10).alias("report_week"), F.lit("c").alias("city"),
        F.lit(1).alias("store_id"), F.col("id").alias("item_id"), (F.col("id") % 40 + 1).alias("ordered_quantity"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as a sized session has it
    try:
        tasks = with_ranks(rows).groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(t["count"] for t in tasks) == 300_000 and max(t["count"] for t in tasks) < 150_000

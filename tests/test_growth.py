"""What the order queries exchange, run and keep as their tables grow."""
import pytest
from pyspark.sql import functions as F

from shopmart import session
from shopmart.operators import items_mart, normalize
from shopmart.operators.cleaning import fill_defaults
from shopmart.plans import catalog
from shopmart.sources.fixture import raw_order_lines
from tests.conftest import SF_SMALL
from tests.test_plans import plan

TABLES = ("orders", "customer", "nation", "region", "lineitem", "supplier", "part")


@pytest.fixture(scope="module")
def repeated(spark, tmp_path_factory):
    """Tables with repeated and null keys: every twentieth row again, some of it otherwise, and rows of nulls."""
    top = str(tmp_path_factory.mktemp("repeated"))
    for name in TABLES:
        df = spark.read.parquet(f"{SF_SMALL}/{name}.parquet")
        key = df.columns[0]
        again = df.where(F.col(key) % 20 == 0).withColumn(
            df.columns[1], F.lit(None).cast(df.dtypes[1][1])) if name != "lineitem" else df.where("l_orderkey % 20 = 0")
        empty = df.limit(2).withColumns({c: F.lit(None).cast(t) for c, t in df.dtypes})
        df.unionByName(again).unionByName(again).unionByName(empty).write.parquet(f"{top}/{name}.parquet")
    return top


@pytest.mark.parametrize("name", sorted(normalize.CORE_BUILDERS))
def test_a_core_table_of_its_own_columns_is_that_of_all(spark, repeated, name):
    lineage = catalog.Lineage(spark, repeated)
    got = lineage.core(name)
    want = normalize.CORE_BUILDERS[name](fill_defaults(raw_order_lines(spark, repeated)))
    assert got.schema == want.schema and got.count() > 0
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


@pytest.mark.parametrize("name,left_out", [
    ("users", {"lineitem", "supplier", "part"}), ("stores", {"lineitem", "supplier", "part"}),
    ("orders", {"lineitem", "supplier", "part"}), ("items", {"supplier"}), ("drivers", {"part"}),
    ("order_drivers", {"supplier", "part"}), ("order_items", {"supplier"})])
def test_a_core_table_joins_what_it_needs(spark, name, left_out):
    p = plan(catalog.Lineage(spark, SF_SMALL).core(name))
    read = {t for t in TABLES if f"{t}.parquet" in p}
    assert read == set(TABLES) - left_out


@pytest.mark.parametrize("name", ["q5_category_turnover", "q7_item_cancel_rate", "q8_item_order_cancel_rate",
                                  "check_unique_dm_items_day_item", "check_not_null_marts"])
def test_readers_of_no_rank_plan_none(spark, monkeypatch, name):
    monkeypatch.setattr(items_mart, "_large_store_years", lambda *_: pytest.fail("a job for the ranks"), raising=False)
    p = plan(catalog.run(spark, SF_SMALL, name))
    assert "Window" not in p and "hashpartitioning(report_year" not in p


def test_totals_and_ranks_of_the_mart_share_an_exchange(spark):
    p = plan(catalog.run(spark, SF_SMALL, "dm_items"))
    assert p.count("REPARTITION_BY_COL") == 2     # of the orders and of the rows to sum and rank
    assert "hashpartitioning(report_date" not in p


def test_marts_of_large_store_years_keep_their_rows(spark, monkeypatch):
    lineage = catalog.Lineage(spark, SF_SMALL)
    want = lineage.dm_items
    monkeypatch.setattr(items_mart, "WINDOW_ROWS", 30)
    got = catalog.Lineage(spark, SF_SMALL).dm_items
    assert "Union" in got._jdf.queryExecution().optimizedPlan().toString()
    assert got.exceptAll(want).count() == 0 and got.count() == want.count() > 0


def test_shuffle_files_of_a_deciding_job_go_when_it_ends(spark):
    def files():
        manager = spark._jsc.sc().env().blockManager().diskBlockManager()
        return manager.getAllFiles().mkString(" ").count("shuffle_")

    query = spark.range(10_000).groupBy((F.col("id") % 7).alias("k")).count()
    before = files()
    with session.shuffles_removed(spark):
        assert query.where("count > 5").count() == 7
    assert files() <= before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"


def test_a_task_of_many_rows_costs_the_driver_few_sizes(spark):
    """216 million lines (6 GB of tables): an exchange's sizes, tasks times tasks, stay under a MB."""
    parts = int(session.sized_session(spark, 216_000_000).conf.get("spark.sql.shuffle.partitions"))
    assert parts ** 2 < 1 << 20
